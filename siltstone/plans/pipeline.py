"""The whole pipeline: documents to accepted and failed triplets.

Stages that call a model write their replies to a table first; everything between is one plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.config import Config
from siltstone.functions.arrow import chunked
from siltstone.functions.parse import density, parse_qa_lines, parse_triplets, parse_verdicts
from siltstone.functions.text import clean_text
from siltstone.io import cut
from siltstone.models.clients import Retry, Template, generate, verdict_ok
from siltstone.models.prompts import Prompts, format_examples
from siltstone.operators.filters import content_ok, dense_enough, lengths_fit, pair_valid, route, supported
from siltstone.operators.similarity import chunk_scores, merge_chunks, near_dup_flags


def chunks_of(docs: DataFrame, config: Config = Config()) -> DataFrame:
    """Cleaned whole texts (null and empty ones dropped) in pieces by characters; ``cleaning.max_chars`` doesn't cut them."""
    c = config.cleaning
    text = clean_text(F.col("content"), c.min_chars, None, c.remove_whitespace, c.remove_urls, c.keep_paragraphs)
    return chunked(docs.select("doc_id", text.alias("content")).where("content <> ''"), "doc_id", "content", "chars", config.chunking.chars, config.chunking.overlap_chars)


def kept_chunks(chunks: DataFrame, model: Callable, config: Config = Config(), prompts: Prompts | None = None) -> DataFrame:
    """Chunks that are dense and coherent enough, merged where they say the same."""
    prompts = prompts or Prompts()
    asked = generate(chunks.withColumn("prompt", prompts.column("density", text=F.col("content"))), model, ["doc_id", "chunk_ix"])
    scored = chunk_scores(chunks.join(asked.select("doc_id", "chunk_ix", density(F.col("reply")).alias("score")), ["doc_id", "chunk_ix"]), single=config.chunking.single_chunk_coherence)
    return merge_chunks(scored.where(dense_enough(F.col("relevance"), config.chunking.threshold)), config.chunking.merge_similarity)


def triplets_of(chunks: DataFrame, model: Callable, prompts: Prompts | None = None) -> DataFrame:
    """``doc_id, seq, question, answer, instruction, context`` in order of chunk and triplet."""
    prompts = prompts or Prompts()
    asked = generate(chunks.withColumn("prompt", prompts.column("triplets", text=F.col("content"))).withColumn("at", F.struct("doc_id", "chunk_ix")), model, ["doc_id", "chunk_ix"])
    found = parse_triplets(asked.withColumn("at", F.struct("doc_id", "chunk_ix")), "at", "reply")
    rows = found.select("at.doc_id", "at.chunk_ix", "triplet_no", "question", "answer", "instruction").join(chunks.select("doc_id", "chunk_ix", F.col("content").alias("context")), ["doc_id", "chunk_ix"])
    return rows.withColumn("seq", F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk_ix", "triplet_no"))).drop("chunk_ix", "triplet_no")


def judged(pairs: DataFrame, model: Callable, prompts: Prompts | None = None) -> DataFrame:
    """Pairs with ``validation_scores`` (null for replies that aren't well-formed after three tries)."""
    prompts = prompts or Prompts()
    p = prompts.column("judge", question=F.col("question"), answer=F.col("answer"), instruction=F.col("instruction"), text=F.col("context"))
    patient = model if isinstance(model, Template) else Retry(model, verdict_ok)
    replies = parse_verdicts(generate(pairs.withColumn("prompt", p), patient, ["doc_id", "seq"]), "reply")
    names = ("answer_validity", "question_quality", "instruction_quality")
    scores = F.when(F.col("well_formed"), F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))]))
    return pairs.join(replies.select("doc_id", "seq", scores.alias("validation_scores")), ["doc_id", "seq"])


def run(docs: DataFrame, model: Callable | None = None, config: Config = Config(), prompts: Prompts | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, failed): accepted triplets, and failed ones with their ``reason``."""
    model = model or Template()
    chunks = cut(chunks_of(docs, config), "chunks")
    kept = cut(kept_chunks(chunks, model, config, prompts), "kept")
    made = cut(triplets_of(kept, model, prompts), "triplets")
    unique = made.join(near_dup_flags(made, "doc_id", "seq", "question", config.quality.duplicate_similarity).where("kept").drop("kept"), ["doc_id", "seq"])
    routed = cut(route(judged(unique, model, prompts), config.quality.judge_threshold), "routed")
    q = config.quality
    ok = routed.where("reason is null").join(docs.select("doc_id", "source", F.col("content").alias("document")), "doc_id")
    fit = ok.where(lengths_fit(F.col("question"), F.col("answer"), q)).where(content_ok(F.col("question"), F.col("answer"), q.content_filters))
    # Support and relevance are measured against the whole document.
    final = supported(fit.withColumnRenamed("context", "passage").withColumnRenamed("document", "context"), q).where("ok")
    accepted = final.select("doc_id", "seq", "question", "answer", "instruction", F.col("passage").alias("context"), "validation_scores", "source")
    return accepted, routed.where("reason is not null").select("doc_id", "seq", "question", "answer", "instruction", "reason", "validation_scores")


def self_instruct(docs: DataFrame, seeds: list[tuple[str, str]], model: Callable, count: int = 5, prompts: Prompts | None = None) -> DataFrame:
    """``doc_id, record, question, answer``: valid generated pairs, the first ``count`` of each document."""
    prompts = prompts or Prompts()
    p = prompts.column("self_instruct", examples=F.lit(format_examples(seeds)), count=F.lit(count), text=F.col("content"))
    pairs = parse_qa_lines(generate(docs.withColumn("prompt", p), model, ["doc_id"]), "doc_id", "reply").join(docs.select("doc_id", "content"), "doc_id")
    valid = pairs.where(pair_valid(F.col("question"), F.col("answer"), F.col("content")))
    return valid.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("record"))).where(F.col("n") <= count).select("doc_id", "record", "question", "answer")


def with_variations(pairs: DataFrame, model: Callable, count: int = 2, prompts: Prompts | None = None) -> DataFrame:
    """Pairs (``pair_id, question, answer, context``) and up to ``count`` valid rewordings of each, ``variation`` from 0."""
    prompts = prompts or Prompts()
    p = prompts.column("variation", question=F.col("question"), answer=F.col("answer"), text=F.col("context"))
    made = parse_qa_lines(generate(pairs.withColumn("prompt", p), model, ["pair_id"]), "pair_id", "reply").join(pairs.select("pair_id", "context"), "pair_id")
    ok = made.where(pair_valid(F.col("question"), F.col("answer"), F.col("context"))).withColumn("variation", F.row_number().over(Window.partitionBy("pair_id").orderBy("record"))).where(F.col("variation") <= count)
    return pairs.select("pair_id", F.lit(0).alias("variation"), "question", "answer", "context").union(ok.select("pair_id", "variation", "question", "answer", "context"))
