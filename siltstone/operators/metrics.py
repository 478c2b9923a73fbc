"""Quality of pairs and diversity of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.arrow import ngram_overlap, overlap_metrics
from siltstone.functions.text import words

WH = ("what", "who", "where", "when", "why", "how", "which", "whose", "whom")
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def relevance(answer: Column, context: Column) -> Column:
    """0.7 of the answer's words in the context, 0.3 of the ratio of lengths; empty answers or contexts give 0."""
    a, c = F.array_distinct(words(answer)), F.array_distinct(words(context))
    shared = F.size(F.array_intersect(a, c)) / F.greatest(F.size(a), F.lit(1))
    lengths = F.least(F.lit(1.0), F.length(answer) / F.greatest(F.length(context), F.lit(1)))
    return F.when((F.size(a) == 0) | (F.coalesce(F.length(context), F.lit(0)) == 0), 0.0).otherwise(0.7 * shared + 0.3 * lengths)


def question_quality(question: Column) -> Column:
    """Penalties for fewer than 5 or more than 25 tokens, no question word in front, and no question mark at the end."""
    n = F.size(F.regexp_extract_all(F.coalesce(question, F.lit("")), F.lit(f"({TOKEN})"), 1))
    wh = F.lower(question).rlike("^(?:" + "|".join(WH) + ")")
    mark = F.rtrim(question).endswith("?")
    return F.when(n < 5, 0.7).when(n > 25, 0.8).otherwise(1.0) * F.when(wh, 1.0).otherwise(0.9) * F.when(mark, 1.0).otherwise(0.8)


def pair_metrics(pairs: DataFrame) -> DataFrame:
    """Pairs with all metrics; overall is the mean of BLEU, METEOR, ROUGE-L, relevance and question quality."""
    m = pairs.withColumn("m", overlap_metrics("answer", "context")).select("*", "m.*").drop("m")
    m = m.withColumn("relevance", relevance(F.col("answer"), F.col("context"))).withColumn("question_quality", question_quality(F.col("question")))
    return m.withColumn("overall_quality", (F.col("bleu") + F.col("meteor") + F.col("rougeL") + F.col("relevance") + F.col("question_quality")) / 5)


def diversity(texts: DataFrame, group: str, order: str, text: str) -> DataFrame:
    """``group, diversity``: half lexical (distinct words by words), half one minus the mean overlap of pairs.

    Groups of one text are only lexical. Pairs are formed within a group by a join on it.
    """
    t = texts.select(group, order, F.col(text).alias("t"))
    lexical = t.select(group, F.explode(words(F.col("t"))).alias("w")).groupBy(group).agg((F.count_distinct("w") / F.count("w")).alias("lexical"))
    size = t.groupBy(group).agg(F.count("*").alias("n"))
    b = t.select(group, F.col(order).alias("o2"), F.col("t").alias("t2"))
    overlap = t.join(b, group).where(F.col(order) < F.col("o2")).groupBy(group).agg(F.avg(ngram_overlap("t", "t2")).alias("overlap"))
    x = size.join(lexical, group, "left").join(overlap, group, "left")
    value = F.when(F.col("n") < 2, F.coalesce("lexical", F.lit(0.0))).otherwise(0.5 * F.coalesce("lexical", F.lit(0.0)) + 0.5 * (1 - F.coalesce("overlap", F.lit(0.0))))
    return x.select(group, value.alias("diversity"))


def pair_diversity(pairs: DataFrame, group: str, order: str, question: str = "question", answer: str = "answer") -> DataFrame:
    """``group, question_diversity, answer_diversity, overall_diversity`` (the mean of both)."""
    q = diversity(pairs, group, order, question).withColumnRenamed("diversity", "question_diversity")
    a = diversity(pairs, group, order, answer).withColumnRenamed("diversity", "answer_diversity")
    return q.join(a, group).withColumn("overall_diversity", (F.col("question_diversity") + F.col("answer_diversity")) / 2)


#: Metrics by name, for configurations that list them.
REGISTRY = {"relevance": lambda q, a, c: relevance(a, c), "question_quality": lambda q, a, c: question_quality(q), "ngram_overlap": lambda q, a, c: ngram_overlap(a, c), **{n: (lambda q, a, c, n=n: overlap_metrics(a, c)[n]) for n in ("bleu", "meteor", "rouge1", "rouge2", "rougeL")}}


def named_metrics(pairs: DataFrame, names: list[str]) -> DataFrame:
    """Pairs with the metrics of ``names`` that are known; others are left out."""
    return pairs.select("*", *[REGISTRY[n](F.col("question"), F.col("answer"), F.col("context")).alias(n) for n in names if n in REGISTRY])


def validate_against_source(pairs: DataFrame, docs: DataFrame, support: float = 0.8) -> DataFrame:
    """Pairs (with ``source``) that their document supports, with where the answer was found in it."""
    from siltstone.functions.arrow import bow_cosine
    from siltstone.functions.markers import all_text
    from siltstone.operators.answers import located
    from siltstone.operators.filters import with_documents

    x = with_documents(pairs, docs).where("document is not null")
    ok = x.where(bow_cosine(F.col("answer"), all_text(F.col("document"))) >= support)
    return located(ok, "answer", "document")
