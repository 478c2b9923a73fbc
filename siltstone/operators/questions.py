"""Questions from answers: templates, ranking, confidence, self-instruction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.functions.arrow import bow_cosine
from siltstone.functions.text import word_count
from siltstone.operators.similarity import near_dup_flags

# Three templates for each kind of answer, made from what the kind holds: the thing itself for names and phrases, the
# statement for facts, the sign, line, thing, place or detail for images, and for text with image the sentence {context}.
TEMPLATES = {
    ("text", "entity"): ("Name the one that the passage calls {answer}: who or what is it?", "In which connection does the passage mention {answer}?", "Why does {answer} come up here?"),
    ("text", "fact"): ("Is it said, and if so how, that {answer}", "On what grounds can one claim: {answer}", "Which sentence of {context} settles this point?"),
    ("text", "phrase"): ("How would you put {answer} in other words?", "Where does the passage speak of {answer}?", "Which role does {answer} have in the passage?"),
    ("visual", "caption"): ("Sum up the picture in one line: what is on it?", "Which caption would suit the picture?", "What would you tell someone who cannot see the picture?"),
    ("visual", "ocr_text"): ("Which letters and figures are printed on the picture?", "How does the sign in the picture read?", "Copy the lettering: what does it say?"),
    ("visual", "objects"): ("Make a list: which things are on the picture?", "Which things did the detector mark?", "What would you count on the picture?"),
    ("visual", "scene"): ("At which kind of place was the picture taken?", "Indoors or outdoors, and where exactly?", "What surrounds the things on the picture?"),
    ("visual", "analysis"): ("Which single detail answers a close look?", "What becomes clear at second sight?", "What did the examination of the picture find?"),
    ("combined", "text_ocr"): ("Which words on the picture bear out this sentence: {context}", "Does the lettering agree with the text that says: {context}", "What do sign and sentence have in common, given: {context}"),
    ("combined", "text_caption"): ("Which part of the picture proves this sentence: {context}", "Would the picture do as an example of: {context}", "What does the picture add to the statement: {context}"),
    ("combined", "text_objects"): ("Which of the things shown does this sentence need: {context}", "Which thing on the picture is meant by: {context}", "Which things shown are not covered by: {context}"),
    ("combined", "text_scene"): ("Could this have happened at the place shown: {context}", "What at the place shown fits the sentence: {context}", "Which sentence on the place follows from: {context}"),
}
DEFAULTS = {"text": "fact", "visual": "caption", "combined": "text_caption"}
# Weights of question classes and of answer types.
CLASS_WEIGHTS = {"DESCRIPTION": 1.2, "ENTITY": 1.1, "HUMAN": 1.0, "LOCATION": 1.0, "NUMERIC": 0.9, "ABBREVIATION": 0.8}
TYPE_WEIGHTS = {"combined": 1.2, "visual": 1.1, "text": 1.0}


def template_table(spark: SparkSession, custom: dict[tuple[str, str], tuple[str, ...]] | None = None) -> DataFrame:
    """``category, subtype, ix, template``; ``custom`` replaces or adds kinds."""
    rows = [(c, s, i, t) for (c, s), ts in {**TEMPLATES, **(custom or {})}.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "category string, subtype string, ix int, template string")


def category(kind: Column) -> Column:
    return F.when(kind == "visual", "visual").when(kind == "combined", "combined").otherwise("text")


def from_templates(answers: DataFrame, key: str = "doc_id", custom: dict | None = None) -> DataFrame:
    """``key, seq, ix, question, answer, category``: three questions an answer, one for an analysis (its own).

    Subtypes without templates take those of their category's default. Text kinds are looked up by type. ``{context}`` is
    the sentence of the answer's ``context`` that is most like it, or the passage if there is none.
    """
    t = F.broadcast(template_table(answers.sparkSession, custom))
    text_kind = F.when(F.col("subtype") == "text_ocr_text", "text_ocr").otherwise(F.col("subtype"))
    x = answers.withColumn("category", category(F.col("type"))).withColumn("wanted", F.when(category(F.col("type")) == "text", F.col("type")).otherwise(text_kind))
    known = t.select("category", F.col("subtype").alias("wanted")).distinct().withColumn("known", F.lit(True))
    default = F.create_map(*[F.lit(v) for kv in DEFAULTS.items() for v in kv])
    x = x.join(F.broadcast(known), ["category", "wanted"], "left").withColumn("subtype_used", F.when(F.col("known"), F.col("wanted")).otherwise(default[F.col("category")]))
    sentence = F.lit("this passage")
    if "context" in answers.columns:
        # Only for kinds with a template that names it.
        asks = [F.concat_ws(" ", "category", "subtype_used") == f"{c} {k}" for (c, k), ts in {**TEMPLATES, **(custom or {})}.items() if any("{context}" in one for one in ts)]
        some = asks[0] if asks else F.lit(False)
        for a in asks[1:]:
            some = some | a
        best = best_sentence(x.where(some).withColumn("at", F.struct(key, "seq")), "at", "text", "context").select(f"at.{key}", "at.seq", "sentence")
        x, sentence = x.join(best, [key, "seq"], "left"), F.coalesce("sentence", F.lit("this passage"))
    own = (F.col("subtype") == "analysis") & F.col("question").isNotNull()
    made = x.where(~F.coalesce(own, F.lit(False))).join(t.select("category", F.col("subtype").alias("subtype_used"), "ix", "template"), ["category", "subtype_used"])
    filled = F.replace(F.replace("template", F.lit("{answer}"), F.col("text")), F.lit("{context}"), sentence)
    one = made.select(key, "seq", "ix", filled.alias("question"), F.col("text").alias("answer"), "category")
    two = x.where(own).select(key, "seq", F.lit(0).alias("ix"), "question", F.col("text").alias("answer"), "category")
    return one.union(two)


def from_model(answers: DataFrame, model, key: str = "doc_id", prompts=None) -> DataFrame:
    """``key, seq, ix, question, answer, category``: templates and what a model asks about text answers, refined by the model.

    ``answers`` has ``key, seq, text, type, subtype, question, context``. Refinements replace questions of the same answer.
    """
    from siltstone.functions.parse import parse_questions, parse_refinements, refine_questions
    from siltstone.models.clients import generate
    from siltstone.models.prompts import Prompts

    prompts = prompts or Prompts()
    texts = answers.where(category(F.col("type")) == "text")
    asked = generate(texts.withColumn("prompt", prompts.column("questions", answer=F.col("text"), kind=F.col("type"), text=F.col("context"))), model, [key, "seq"])
    replies = parse_questions(asked.withColumn("at", F.struct(key, "seq")), "at", "reply").select(f"at.{key}", "at.seq", F.col("record").cast("int").alias("record"), "question")
    said = replies.join(texts.select(key, "seq", F.col("text").alias("answer")), [key, "seq"])
    ix = F.row_number().over(Window.partitionBy(key, "seq").orderBy("record")) + 99
    first = from_templates(texts, key).unionByName(said.select(key, "seq", ix.alias("ix"), "question", "answer", F.lit("text").alias("category")))
    listed = first.groupBy(key, "seq").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ix", "question"))), lambda q: q["question"]), "\n").alias("questions"), F.first("answer").alias("answer"))
    better = generate(listed.withColumn("prompt", prompts.column("refine", answer=F.col("answer"), questions=F.col("questions"))), model, [key, "seq"])
    decisions = parse_refinements(better.withColumn("at", F.struct(key, "seq")), "at", "reply")
    refined = refine_questions(first.withColumn("at", F.struct(key, "seq")), decisions, "at", "ix")
    return refined.select(key, "seq", "ix", "question", "answer", "category")


def generated(answers: DataFrame, model=None, key: str = "doc_id", top: int = 50, min_score: float = 0.6, similarity: float = 0.85) -> DataFrame:
    """The whole way from answers (``key, seq, text, type, subtype, score, question, context``) to ranked questions.

    Text, visual and combined questions, those of a model if there is one; then bounds, near copies, rank and top.
    """
    q = from_templates(answers, key)
    if model:
        q = q.where("category <> 'text'").unionByName(from_model(answers, model, key))
    scored = q.join(answers.select(key, "seq", "score"), [key, "seq"])
    numbered = scored.withColumn("seq", F.row_number().over(Window.partitionBy(key).orderBy("seq", "ix")))
    return ranked_questions(numbered, key, min_score, similarity, top)


def question_class(question: Column) -> Column:
    """Class of a question by its first word, a stand-in for a trained classifier."""
    q = F.lower(F.trim(question))
    return F.when(q.rlike(r"^(?:who|whose|whom|wer|qui|quién)\b"), "HUMAN").when(q.rlike(r"^(?:where|wo|où|dónde)\b"), "LOCATION").when(q.rlike(r"^(?:when|how many|how much|wann|wie oft|combien|quand|cuándo|cuántas)\b"), "NUMERIC").when(q.rlike(r"^(?:why|how|describe|explain|warum|beschreibe|pourquoi|cómo)\b"), "DESCRIPTION").otherwise("ENTITY")


def question_rank(score: Column, cls: Column, kind: Column) -> Column:
    w, t = F.lit(1.0), F.lit(1.0)
    for name, x in CLASS_WEIGHTS.items():
        w = F.when(cls == name, x).otherwise(w)
    for name, x in TYPE_WEIGHTS.items():
        t = F.when(kind == name, x).otherwise(t)
    return score * w * t


def confidence(score: Column, classified: Column, relevance: Column) -> Column:
    """The score, a tenth more if classified, averaged with the relevance of the context where there is one; at most 1."""
    s = score * F.when(classified, 1.1).otherwise(1.0)
    return F.least(F.lit(1.0), F.when(relevance.isNull(), s).otherwise((s + relevance) / 2))


def context_relevance(question: Column, answer: Column, context: Column) -> Column:
    return bow_cosine(F.concat_ws(" ", question, answer), context)


def best_sentence(pairs: DataFrame, key: str = "pair_id", answer: str = "answer", context: str = "context") -> DataFrame:
    """``key, sentence``: the context's sentence most like the answer, the first of equals; ``this content`` without one."""
    s = pairs.select(key, answer, F.posexplode_outer(F.filter(F.split(F.coalesce(context, F.lit("")), r"(?<=[.!?])\s+"), lambda x: x != "")).alias("i", "s"))
    c = s.withColumn("cos", bow_cosine(F.col(answer), F.col("s")))
    return c.groupBy(key).agg(F.coalesce(F.max_by("s", F.struct("cos", -F.col("i"))), F.lit("this content")).alias("sentence"))


def grouped(answers: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, kind, answers``: answers by type and subtype, in order."""
    return answers.groupBy(key, F.concat_ws("_", "type", "subtype").alias("kind")).agg(F.array_sort(F.collect_list(F.struct("seq", "text", "score"))).alias("answers"))


def ranked_questions(questions: DataFrame, key: str = "doc_id", min_score: float = 0.6, similarity: float = 0.85, top: int = 50) -> DataFrame:
    """Bounds, near copies, rank and top of each document over ``question, answer, score, category, seq``."""
    fit = questions.where((F.col("score") >= min_score) & word_count(F.col("question")).between(3, 50))
    kept = fit.join(near_dup_flags(fit, key, "seq", "question", similarity).where("kept").drop("kept"), [key, "seq"])
    x = kept.withColumn("ranking_score", question_rank(F.col("score"), question_class(F.col("question")), F.col("category")))
    return x.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("ranking_score"), "seq"))).where(F.col("place") <= top)
