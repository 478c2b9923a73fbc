"""Structured replies of models, parsed into rows with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.text import strip

# Delimiters of the reply format.
TRIPLET_START, TRIPLET_END = "---START_TRIPLET---", "---END_TRIPLET---"
NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def last_field(body: Column, name: str) -> Column:
    """The value of the last line that begins with ``name:``; null without one."""
    found = F.regexp_extract_all(body, F.lit(rf"(?m)^[ \t]*{name}:[ \t]*([^\n]*)$"), 1)
    return F.when(F.size(found) > 0, strip(F.element_at(found, -1)))


def parse_triplets(replies: DataFrame, key: str = "pair_id", reply: str = "reply") -> DataFrame:
    """``key, triplet_no, question, answer, instruction``: complete triplets of each reply.

    Triplets need their end mark; an instruction goes on until a blank line or another field; all three must be
    non-empty. White space before a field is accepted.
    """
    parts = replies.select(key, F.posexplode(F.split(F.coalesce(reply, F.lit("")), TRIPLET_START)).alias("triplet_no", "part")).where(F.col("part").contains(TRIPLET_END))
    body = parts.withColumn("body", strip(F.substring_index("part", TRIPLET_END, 1)))
    more = F.regexp_extract_all("body", F.lit(r"(?m)^[ \t]*INSTRUCTION:([^\n]*(?:\n(?![ \t]*\n)(?!QUESTION:|ANSWER:|INSTRUCTION:)[^\n]+)*)"), 1)
    instruction = F.when(F.size(more) > 0, strip(F.array_join(F.transform(F.split(F.element_at(more, -1), "\n"), strip), "\n")))
    fields = body.select(key, "triplet_no", last_field(F.col("body"), "QUESTION").alias("question"), last_field(F.col("body"), "ANSWER").alias("answer"), instruction.alias("instruction"))
    return fields.where("question <> '' and answer <> '' and instruction <> ''")


def records(replies: DataFrame, key: str, reply: str, starts: str, blank_ends: bool) -> DataFrame:
    """Lines of each reply, numbered by record: a record begins at a ``starts`` line, or behind a blank one."""
    lines = replies.select(key, F.posexplode(F.split(F.coalesce(reply, F.lit("")), "\n")).alias("line_no", "raw")).withColumn("line", strip(F.col("raw")))
    begins = F.col("line").startswith(starts) | (F.col("line") == "" if blank_ends else F.lit(False))
    w = Window.partitionBy(key).orderBy("line_no")
    return lines.withColumn("record", F.sum(begins.cast("int")).over(w)).where("line <> ''")


def field(name: str, kind: str = "last") -> Column:
    """The value of the last (or first) line of a record that begins with ``name``."""
    value = F.when(F.col("line").startswith(name), strip(F.expr(f"substring(line, {len(name) + 1})")))
    at = F.when(F.col("line").startswith(name), F.col("line_no"))
    return (F.max_by if kind == "last" else F.min_by)(value, at)


def parse_qa_lines(replies: DataFrame, key: str = "pair_id", reply: str = "reply") -> DataFrame:
    """``key, record, question, answer`` of ``Q:`` and ``A:`` lines; of several answers the last wins; both must be filled."""
    g = records(replies, key, reply, "Q:", False).groupBy(key, "record").agg(field("Q:").alias("question"), field("A:").alias("answer"))
    return g.where("question <> '' and answer <> ''")


def parse_answers(replies: DataFrame, key: str = "pair_id", reply: str = "reply") -> DataFrame:
    """``key, record, text, reasoning, score, type``: blank lines and ``Answer:`` lines end a record; bad scores give 0.8."""
    g = records(replies, key, reply, "Answer:", True).groupBy(key, "record").agg(field("Answer:").alias("text"), field("Reasoning:").alias("reasoning"), field("Confidence:").alias("c"), F.lower(field("Type:")).alias("type"))
    score = F.when(F.col("c").isNotNull(), F.coalesce(F.when(F.col("c").rlike(NUMBER), F.col("c").try_cast("double")), F.lit(0.8)))
    return g.where("text <> ''").select(key, "record", "text", "reasoning", score.alias("score"), "type")


def parse_questions(replies: DataFrame, key: str = "pair_id", reply: str = "reply") -> DataFrame:
    """``key, record, question, type, verification, score`` of question records."""
    g = records(replies, key, reply, "Question Type:", True).groupBy(key, "record").agg(field("Question:").alias("question"), F.lower(field("Question Type:")).alias("type"), field("Verification:").alias("verification"), field("Complexity:").alias("c"))
    score = F.when(F.col("c").isNotNull(), F.coalesce(F.when(F.col("c").rlike(NUMBER), F.col("c").try_cast("double")), F.lit(0.8)))
    return g.where("question <> ''").select(key, "record", "question", "type", "verification", score.alias("score"))


def parse_refinements(replies: DataFrame, key: str = "pair_id", reply: str = "reply") -> DataFrame:
    """``key, record, original, improved, reasoning, decision`` of complete refinement records."""
    g = records(replies, key, reply, "Original:", True).groupBy(key, "record").agg(field("Original:").alias("original"), field("Improved:").alias("improved"), field("Reasoning:").alias("reasoning"), F.lower(field("Keep/Replace:")).alias("decision"))
    return g.where("original <> '' and improved <> ''")


def refine_questions(questions: DataFrame, refinements: DataFrame, key: str = "pair_id", seq: str = "seq") -> DataFrame:
    """``questions`` with the first equal question of each replaced refinement exchanged; ``refinement_reason`` added."""
    replaced = refinements.where("decision = 'replace'").groupBy(key, F.col("original").alias("question")).agg(F.max_by("improved", "record").alias("improved"), F.max_by("reasoning", "record").alias("refinement_reason"))
    first = F.row_number().over(Window.partitionBy(key, "question").orderBy(seq)) == 1
    x = questions.withColumn("first", first).join(replaced, [key, "question"], "left")
    take = F.col("first") & F.col("improved").isNotNull()
    return x.withColumn("question", F.when(take, F.col("improved")).otherwise(F.col("question"))).withColumn("refinement_reason", F.when(take, F.col("refinement_reason"))).drop("first", "improved")


def boolean_verdict(reply: Column) -> Column:
    """Whether the first line that begins with ``Valid:`` says true; without one false."""
    return F.coalesce(F.lower(F.regexp_extract(reply, r"(?m)^[ \t]*Valid:[ \t]*(\S*)", 1)) == "true", F.lit(False))


def density(reply: Column) -> Column:
    """A number clamped to [0, 1]; anything else gives 0.5."""
    s = strip(reply)
    return F.coalesce(F.when(s.rlike(NUMBER), F.greatest(F.lit(0.0), F.least(F.lit(1.0), s.try_cast("double")))), F.lit(0.5))


SCORES = ("answer_validity", "question_quality", "instruction_quality")


def parse_verdicts(replies: DataFrame, reply: str = "response") -> DataFrame:
    """Adds ``json`` (from the first to the last brace), ``well_formed`` and the three scores.

    Well-formed: valid JSON with a boolean ``valid``, arrays ``issues`` and ``improvements``, and ``scores`` with the three
    names, each score a number (no string, no boolean) in [0, 1]. Scores of replies that aren't are null.
    """
    body = F.regexp_extract(F.coalesce(reply, F.lit("")), r"(?s)\{.*\}", 0)
    v = replies.withColumn("json", F.nullif(body, F.lit(""))).withColumn("v", F.try_parse_json("json"))

    def of(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get("v", path, "variant"))

    number = lambda t: t.isin("BIGINT", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT") | t.startswith("DECIMAL")
    raw = F.try_variant_get("v", "$.scores", "map<string,variant>")
    named = F.lit(True)
    for name in SCORES:
        named = named & F.coalesce(number(of(f"$.scores.{name}")), F.lit(False))
    within = F.coalesce(F.forall(F.map_values(raw), lambda x: number(F.schema_of_variant(x)) & F.coalesce(F.try_variant_get(x, "$", "double").between(0, 1), F.lit(False))), F.lit(False))
    array = lambda p: F.coalesce(of(p).startswith("ARRAY"), F.lit(False))
    ok = F.coalesce(of("$.valid") == "BOOLEAN", F.lit(False)) & array("$.issues") & array("$.improvements") & named & within
    out = v.withColumn("well_formed", ok)
    for name in SCORES:
        out = out.withColumn(name, F.when(F.col("well_formed"), F.try_variant_get("v", f"$.scores.{name}", "double")))
    return out.withColumn("valid", F.when(F.col("well_formed"), F.try_variant_get("v", "$.valid", "boolean"))).drop("v")
