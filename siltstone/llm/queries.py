"""Queries of the training-data operators, each over its whole tables with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.io import shared_dir, table, tune
from siltstone.llm import leaks, markup, mixing, neardup, pairs, pieces, quality, scans, sentences, splits
from siltstone.llm.sql import SQL  # noqa: F401


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_pairs(table(tune(spark), d, "qa_pairs", "pair_id", "question", "answer"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_groups(table(tune(spark), d, "qa_pairs", "pair_id", "question", "answer"))


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """Of each record, its copies and links, without the group's name (a hash)."""
    return p1_groups(spark, d).select("pair_id", "copies", "links")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.kinds_of(table(tune(spark), d, "docs", "doc_id", "content"))


def _docs_once(spark: SparkSession, d: str) -> DataFrame:
    docs = table(tune(spark), d, "docs", "doc_id", "source", "content", "loaded_at")
    return docs.groupBy("doc_id").agg(F.max_by(F.struct("source", "content"), "loaded_at").alias("d")).select("doc_id", "d.source", "d.content")


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean_documents(_docs_once(spark, d))


def p2_templates(spark: SparkSession, d: str) -> DataFrame:
    return markup.host_templates(_docs_once(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.spelling_pairs(table(tune(spark), d, "qa_pairs", "source"))


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_records(table(tune(spark), d, "qa_pairs", "pair_id", "source"), table(spark, d, "split_shares", "split", "share"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.defects(table(tune(spark), d, "qa_pairs", "pair_id", "question", "answer", "instruction"))


def _limited_docs(spark: SparkSession, d: str) -> DataFrame:
    return pieces.limited(table(tune(spark), d, "docs", "doc_id", "format", "content"), table(spark, d, "piece_limits"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pieces.cut_kinds(_limited_docs(spark, d))


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.pieces(_limited_docs(spark, d))


def p5_files(spark: SparkSession, d: str) -> DataFrame:
    """The contents of ``docs``, written to text files by format, as giant files."""
    docs = _limited_docs(spark, d).where("content is not null").select(F.coalesce(F.lower(F.trim("format")), F.lit("none")).alias("format"), "doc_id", "content").distinct()
    path = f"{shared_dir(spark)}/siltstone/files-{uuid.uuid4().hex}"
    docs.repartition(8, "format").sortWithinPartitions("format", "doc_id").select("content").write.text(path)
    found = pieces.file_pieces(spark, path, 4000, 200)
    return found.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("file_no"), "piece_no", "start_pos", "end_pos", "piece")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.Noise(table(tune(spark), d, "scanned_pages")).found()


def p6_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return scans.Noise(table(tune(spark), d, "scanned_pages")).paragraphs()


def _texts(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(tune(spark), d, "chunks", "doc_id", "chunk_ix", "content").select(F.lit("chunks").alias("origin"), F.col("doc_id").alias("row_id"), F.col("chunk_ix").alias("ix"), F.col("content").alias("text"))
    contexts = table(spark, d, "qa_pairs", "pair_id", "context").select(F.lit("qa_pairs").alias("origin"), F.col("pair_id").alias("row_id"), F.lit(0).alias("ix"), F.col("context").alias("text"))
    return chunks.union(contexts)


def _quality(spark: SparkSession, d: str, stats: bool) -> DataFrame:
    return quality.verdicts(_texts(spark, d), ["origin", "row_id", "ix"], stats=stats)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _quality(spark, d, False).where("kind <> 'prose'").select("origin", "row_id", "ix", "kind")


def p7_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _quality(spark, d, True)


def p7_numbers(spark: SparkSession, d: str) -> DataFrame:
    """The five numbers of each text alone."""
    return quality.numbers(_texts(spark, d), ["origin", "row_id", "ix"])


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked(table(tune(spark), d, "documents", "doc_id", "text"), table(spark, d, "eval_items"))


def p8_near(spark: SparkSession, d: str) -> DataFrame:
    """Also passages with one edit."""
    return leaks.find_leaks(table(tune(spark), d, "documents", "doc_id", "text"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """By the rows that have a source: those without one belong to none."""
    _, report = mixing.mix(table(tune(spark), d, "documents", "doc_id", "source", "text"), table(spark, d, "mix_targets"), use_unlabelled=False)
    return report.where("not reachable").select("source")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    mixed, _ = mixing.mix(table(tune(spark), d, "documents", "doc_id", "source", "text"), table(spark, d, "mix_targets"))
    return mixed.where("repeats > 0").select("doc_id", "source", "tokens", "repeats")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    _, report = mixing.mix(table(tune(spark), d, "documents", "doc_id", "source", "text"), table(spark, d, "mix_targets"))
    return report


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_units(table(tune(spark), d, "documents", "doc_id", "text", "lang"))


QUERIES = {k: f for k, f in dict(globals()).items() if k[0] == "p" and k[1].isdigit()}
