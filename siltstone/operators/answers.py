"""Answer candidates: extraction by rules, verification, ranking."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import arrow
from siltstone.functions.markers import visual_answers
from siltstone.functions.text import strip, word_count
from siltstone.io import cut
from siltstone.operators.similarity import near_dup_flags

SENTENCE = re.compile(r"(?<=[.!?])\s+(?=[^\W\d_a-z])")
NAME = re.compile(r"(?<![.!?] )(?<!^)\b[A-Z][\w-]+(?: [A-Z][\w-]+)*")
NUMBER = re.compile(r"\d")
QUANTITY = re.compile(r"\b(?:1[89]|20)\d\d\b|\d+(?:[.,]\d+)?\s?(?:%|percent|Prozent|pour cent|por ciento|€|\$|£)", re.I)
VERB = re.compile(r"\b(?:is|are|was|were|has|have|had|keeps?|asks?|lists?|\w+ed)\b", re.I)
PHRASE = re.compile(r"\b(?:the|a|an|der|die|das|le|la|el)\s+(\w+(?: \w+)?)", re.I)
# Weights of candidate types.
TYPE_WEIGHTS = {"combined": 1.2, "fact": 1.1, "visual": 1.0, "entity": 0.9, "phrase": 0.8}


def candidates_of(text: str) -> list[tuple[str, str, str, float, int]]:
    """(text, type, subtype, score, start) by rules: names, numbered or verbal fact sentences, noun phrases."""
    out = [(m[0], "entity", "name", 0.7, m.start()) for m in NAME.finditer(text)]
    seen = set()
    for m in PHRASE.finditer(text):
        p = m[1].strip()
        if " " in p and p.lower() not in seen:
            seen.add(p.lower())
            out.append((p, "phrase", "noun_chunk", 0.8, m.start(1)))
    at = 0
    for s in SENTENCE.split(text):
        at = text.find(s, at)
        score = fact_score(s)
        if score >= 0.6:
            out.append((s.strip(), "fact", "sentence", score, at))
        at += len(s)
    return out


def fact_score(sentence: str) -> float:
    """0.5, and 0.1 each for a number, a quantity or date, a name with a verb, and a finite verb; at most 1."""
    verb = VERB.search(sentence) is not None
    return min(1.0, round(0.5 + 0.1 * bool(NUMBER.search(sentence)) + 0.1 * bool(QUANTITY.search(sentence)) + 0.1 * bool(NAME.search(sentence) and verb) + 0.1 * verb, 6))


def text_answers(docs: DataFrame, key: str = "doc_id", text: str = "content", margin: int = 100) -> DataFrame:
    """``key, n, text, type, subtype, score, context``: rule-based candidates with ``margin`` characters around them."""
    kind = dict(docs.dtypes)[key]

    def make():
        def f(keys, texts):
            out = [[] for _ in range(7)]
            for k, t in zip(keys, texts):
                for n, (a, kind_, sub, score, at) in enumerate(candidates_of(t)):
                    for column, value in zip(out, (k, n, a, kind_, sub, score, t[max(0, at - margin) : at + len(a) + margin])):
                        column.append(value)
            return out

        return f

    return arrow.map_rows(docs.select(key, text).where(F.col(text).isNotNull()), make, f"{key} {kind}, n int, text string, type string, subtype string, score double, context string")


def all_answers(docs: DataFrame, key: str = "doc_id", text: str = "content", combined: bool = True) -> DataFrame:
    """Union of text, visual and combined candidates with ``seq``, their order within the document."""
    none = F.lit(None).cast("string")
    t = text_answers(docs, key, text).select(key, F.lit(0).alias("kind_no"), "n", "text", "type", "subtype", "score", none.alias("question"), "context")
    u = t.unionByName(visual_answers(docs, key, text).withColumn("context", none))
    if combined:
        u = u.unionByName(combined_answers(docs, key, text).withColumn("kind_no", F.lit(9)).withColumn("question", none))
    return u.withColumn("seq", F.row_number().over(Window.partitionBy(key).orderBy("kind_no", "n")))


def related_paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "content", reach: int = 3) -> DataFrame:
    """``key, n, place, context, related``: each visual context (``n``, in order) with the ``reach`` paragraphs around every
    paragraph that holds its text."""
    p = docs.select(key, F.split(text, "\n\n").alias("p"), F.posexplode(F.regexp_extract_all(text, F.lit(r"\[Visual Context:([^\]]+)\]"), 1)).alias("n", "c"))
    p = p.select(key, "n", "p", strip(F.col("c")).alias("context"))
    found = p.select(key, "n", "p", "context", F.posexplode("p").alias("place", "para")).where(F.col("para").contains(F.col("context")))
    lo = F.greatest(F.col("place") - reach, F.lit(0))
    return found.select(key, "n", "place", "context", F.array_join(F.slice("p", lo + 1, F.col("place") + reach + 1 - lo), "\n\n").alias("related"))


def combined_answers(docs: DataFrame, key: str = "doc_id", text: str = "content") -> DataFrame:
    """``key, n, text, type, subtype, score, context``: visual answers tied to the visual contexts they stand near.

    A visual answer belongs to a context if its marker stands within three paragraphs of the context's text; its score is
    the mean of its own and 0.9. Equal texts are told apart by their kind and number.
    """
    near = related_paragraphs(docs, key, text).select(key, F.col("n").alias("context_no"), "place", F.col("context").alias("visual_context"), "related")
    v = visual_answers(docs, key, text).select(key, "kind_no", F.col("n").alias("answer_no"), "text", "subtype", "score")
    met = near.join(v, key).where(F.col("related").contains(F.col("text")))
    order = F.row_number().over(Window.partitionBy(key).orderBy("context_no", "place", "kind_no", "answer_no"))
    said = F.concat("text", F.lit(" (Visual) - Related to: "), "visual_context")
    return met.select(key, (order - 1).alias("n"), said.alias("text"), F.lit("combined").alias("type"), F.concat(F.lit("text_"), "subtype").alias("subtype"), ((F.col("score") + 0.9) / 2).alias("score"), F.col("related").alias("context"))


def verified(answer: Column, text: Column) -> Column:
    """Whether the answer stands in the text, without regard to case and white space, or a window of as many words is
    much like it (cosine of word counts over 0.8). The windows are only looked at where the first test fails."""
    norm = lambda c: F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")))
    found = norm(text).contains(norm(answer))
    return found | arrow.window_found(F.when(~found, norm(answer)), F.when(~found, norm(text)))


def answer_rank(score: Column, kind: Column, text: Column) -> Column:
    weight = F.lit(1.0)
    for name, w in TYPE_WEIGHTS.items():
        weight = F.when(kind == name, w).otherwise(weight)
    return score * weight * F.when(word_count(text).between(5, 15), 1.1).otherwise(1.0)


def filtered(answers: DataFrame, key: str = "doc_id", min_words: int = 3, max_words: int = 100, min_score: float = 0.6, similarity: float = 0.85) -> DataFrame:
    """Candidates within the bounds that are near copies of no earlier kept one of the document."""
    fit = cut(answers.where(word_count(F.col("text")).between(min_words, max_words) & (F.col("score") >= min_score)), "fit")
    return fit.join(near_dup_flags(fit, key, "seq", "text", similarity).where("kept").drop("kept"), [key, "seq"])


def ranked(answers: DataFrame, key: str = "doc_id", top: int = 50) -> DataFrame:
    """Adds ``ranking_score`` and ``place``; keeps the ``top`` of each document, ties by ``seq``."""
    x = answers.withColumn("ranking_score", answer_rank(F.col("score"), F.col("type"), F.col("text")))
    return x.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("ranking_score"), "seq"))).where(F.col("place") <= top)


def located(pairs: DataFrame, answer: str = "answer", content: str = "content", least: float = 0.6) -> DataFrame:
    """Adds ``main_text``, ``ocr_text`` and ``image_caption``: where the answer's like is found.

    The main text is compared as one; of the OCR and caption sections any may be like the answer.
    """
    paragraphs = F.split(F.coalesce(content, F.lit("")), "\n\n")
    ocr, caption = (lambda p: p.startswith("[OCR Text:")), (lambda p: p.startswith("[Image Caption:"))
    main = F.array_join(F.filter(paragraphs, lambda p: ~ocr(p) & ~caption(p)), "\n\n")

    def body(name: str, marked):
        return F.transform(F.filter(paragraphs, marked), lambda p: F.regexp_extract(p, rf"\[{name}: (.*?)\]", 1))

    x = pairs.withColumn("main_text", arrow.bow_cosine(F.col(answer), main) >= least)
    x = x.withColumn("ocr_text", arrow.best_cosine(F.col(answer), body("OCR Text", ocr)) >= least)
    return x.withColumn("image_caption", arrow.best_cosine(F.col(answer), body("Image Caption", caption)) >= least)


def extracted_by_model(docs: DataFrame, model, key: str = "doc_id", text: str = "content", prompts=None) -> DataFrame:
    """``key, record, text, reasoning, score, type``: answers that a model finds in the text and that are verified there."""
    from siltstone.functions.parse import parse_answers
    from siltstone.models.clients import generate
    from siltstone.models.prompts import Prompts

    asked = generate(docs.withColumn("prompt", (prompts or Prompts()).column("answers", text=F.col(text))), model, [key])
    found = parse_answers(asked, key, "reply").join(docs.select(key, F.col(text).alias("source_text")), key)
    return found.where(verified(F.col("text"), F.col("source_text"))).drop("source_text")
