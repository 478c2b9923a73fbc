"""Predicates, routers and the final quality filter over question-answer pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.config import Quality
from siltstone.functions.arrow import bow_cosine
from siltstone.functions.text import split_words, strip, word_count

# Patterns of the content filters (RE2-safe).
PROFANITY = r"(?i)\b(?:damn|damned|hell|crap|bastard|bloody hell|shit|fuck\w*|bitch|asshole)\b"
PERSONAL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|\b\d{3}-\d{2}-\d{4}\b|\+\d{1,3}[ -]?\(?\d{2,4}\)?[ -]?\d{3,4}[ -]?\d{3,4}\b"
CODE = r"```|(?m)^\s*(?:def|class|import|from|function|var|const|public|private)\s+\w+|[{};]\s*$|</?[a-zA-Z][^>]*>"
CONTENT = {"profanity": PROFANITY, "personal_info": PERSONAL, "code_snippets": CODE}


def dense_enough(score: Column, threshold: float = 0.6) -> Column:
    """Strictly above the threshold; null and NaN fail."""
    return F.coalesce(~F.isnan(score) & (score > threshold), F.lit(False))


def lengths_fit(question: Column, answer: Column, q: Quality = Quality()) -> Column:
    return word_count(question).between(q.min_question_words, q.max_question_words) & word_count(answer).between(q.min_answer_words, q.max_answer_words)


def content_ok(question: Column, answer: Column, filters: tuple[str, ...] = tuple(CONTENT)) -> Column:
    """No pattern of the named filters occurs; unknown filters pass."""
    text = F.concat_ws(" ", F.coalesce(question, F.lit("")), F.coalesce(answer, F.lit("")))
    out = F.lit(True)
    for name in filters:
        if name in CONTENT:
            out = out & ~text.rlike(CONTENT[name])
    return out


def missing_fields(*names: str) -> Column:
    """Names of the fields that are null or blank, joined by commas."""
    return F.concat_ws(",", *[F.when(F.coalesce(strip(F.col(n)), F.lit("")) == "", F.lit(n)) for n in names])


def judged_valid(scores: Column, threshold: float = 0.7) -> Column:
    """All three judge scores reach the threshold; missing and NaN scores count as 0."""
    out = F.lit(True)
    for name in ("answer_validity", "question_quality", "instruction_quality"):
        s = F.coalesce(F.try_element_at(scores, F.lit(name)), F.lit(0.0))
        out = out & (F.when(F.isnan(s), 0.0).otherwise(s) >= threshold)
    return out


def route(pairs: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Adds ``missing`` and ``reason``: null for accepted pairs, else why one fails."""
    x = pairs.withColumn("missing", missing_fields("question", "answer", "instruction"))
    judged = F.col("validation_scores").isNotNull()
    return x.withColumn("reason", F.when(F.col("missing") != "", "missing_fields").when(~judged, "no_verdict").when(~judged_valid(F.col("validation_scores"), threshold), "low_scores"))


def supported(pairs: DataFrame, q: Quality = Quality()) -> DataFrame:
    """Adds ``support`` (answer against context) and ``relevance`` (question against context), and ``ok``."""
    x = pairs.withColumn("support", bow_cosine("answer", "context")).withColumn("relevance", bow_cosine("question", "context"))
    # Support implies relevance of the answer where its threshold is the higher one.
    return x.withColumn("ok", (F.col("support") >= max(q.answer_support, q.relevance)) & (F.col("relevance") >= q.relevance))


def quality_filter(pairs: DataFrame, q: Quality = Quality()) -> DataFrame:
    """Pairs that pass lengths, contents, support and relevance; the cheap predicates are pushed below the cosines."""
    cheap = pairs.where(lengths_fit(F.col("question"), F.col("answer"), q)).where(content_ok(F.col("question"), F.col("answer"), q.content_filters))
    return supported(cheap, q).where("ok").drop("support", "relevance", "ok")


def pair_valid(question: Column, answer: Column, context: Column) -> Column:
    """A question mark at the end, and the answer in the context: short ones whole, of longer ones 80 % of the words."""
    q, a, c = strip(F.coalesce(question, F.lit(""))), F.lower(strip(F.coalesce(answer, F.lit("")))), F.lower(F.coalesce(context, F.lit("")))
    w = split_words(a)
    share = F.size(F.filter(w, lambda x: c.contains(x))) / F.greatest(F.size(w), F.lit(1))
    return (q != "") & (a != "") & q.endswith("?") & F.when(F.size(w) <= 3, c.contains(a)).otherwise(share >= 0.8)


def with_documents(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs joined with the latest document of their source (``document``); pairs without one keep null.

    Sources are compared as written. Documents are reduced to one a source before the join.
    """
    latest = docs.groupBy("source").agg(F.max_by("content", F.struct("loaded_at", "doc_id")).alias("document"))
    return pairs.join(latest, "source", "left")


def image_ok(width: Column, height: Column, edge_density: Column, colours: Column, area_ratio: Column) -> Column:
    """Whether an image of a page is worth annotating."""
    return (width >= 100) & (height >= 100) & (edge_density >= 0.01) & (colours >= 5) & (F.coalesce(area_ratio, F.lit(1.0)) >= 0.01)
