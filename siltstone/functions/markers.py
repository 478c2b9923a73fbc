"""Image knowledge in text: bracketed markers are written and read again here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.text import strip

# The marker grammar.
OCR, CAPTION, OBJECTS, SCENE, ANALYSIS, VISUAL = "OCR Text", "Image Caption", "Detected Objects", "Scene Description", "Visual Analysis", "Visual Context"
MARKERS = (OCR, CAPTION, OBJECTS, SCENE, ANALYSIS, VISUAL)
UNSURE = ("unknown", "none", "not sure")
TEXT_TITLE, VISUAL_TITLE = "=== Document Text ===", "=== Visual Content ==="


def bodies(text: Column, marker: str) -> Column:
    """The stripped bodies of all markers of one kind, also of those with a place (`` at …:``)."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"\[{marker}(?: at [^:\]]*)?:([^\]]+)\]"), 1), strip)


def confident_objects(body: Column, least: float = 0.7) -> Column:
    """Labels of ``label (0.93), …`` whose confidence exceeds ``least``, joined by commas; entries of other forms are left out."""
    entries = F.transform(F.split(body, ","), strip)
    good = F.filter(entries, lambda e: F.coalesce(F.regexp_extract(e, r"\(([0-9]*\.?[0-9]+)\)$", 1).try_cast("double"), F.lit(0.0)) > least)
    return F.array_join(F.transform(good, lambda e: strip(F.regexp_replace(e, r"\([^()]*\)$", ""))), ", ")


def visual_answers(docs: DataFrame, key: str = "doc_id", text: str = "content", min_length: int = 3) -> DataFrame:
    """Answer candidates from markers: ``key, kind_no, n, text, type, subtype, score, question``, in order of kind and place.

    Null texts yield none. An analysis is split at ``|``, then at its first ``->``.
    """
    def found(no: int, subtype: str, score: float, items: Column) -> Column:
        return F.transform(items, lambda b, n: row(no, n, b, subtype, score, F.lit(None).cast("string")))

    def row(no: int, n: Column, body: Column, subtype: str, score: float, question: Column) -> Column:
        return F.struct(F.lit(no).alias("kind_no"), n.alias("n"), body.alias("text"), F.lit("visual").alias("type"), F.lit(subtype).alias("subtype"), F.lit(score).alias("score"), question.alias("question"))

    t = F.col(text)
    at = lambda p: F.instr(p, "->")
    pairs = F.filter(F.flatten(F.transform(bodies(t, ANALYSIS), lambda b: F.split(b, r"\|"))), lambda p: p.contains("->"))
    kinds = (
        found(1, "ocr_text", 0.8, F.filter(bodies(t, OCR), lambda b: F.length(b) >= min_length)),
        found(2, "caption", 0.9, bodies(t, CAPTION)),
        found(3, "objects", 0.85, F.filter(F.transform(bodies(t, OBJECTS), lambda b: confident_objects(b)), lambda b: b != "")),
        found(4, "scene", 0.9, bodies(t, SCENE)),
        F.transform(pairs, lambda p, n: row(5, n, strip(F.substring(p, at(p) + 2, F.length(p))), "analysis", 0.85, strip(F.substring(p, F.lit(1), at(p) - 1)))),
    )
    return docs.where(t.contains("[")).select(key, F.explode(F.concat(*kinds)).alias("a")).select(key, "a.*")


def sections(docs: DataFrame, key: str = "doc_id", text: str = "content") -> DataFrame:
    """``key, section_no, type, text``: runs of lines by marker lines and titles; blank lines are dropped.

    A marker line begins a ``visual`` section and is its first line; a ``===`` line begins a ``visual`` (if it names
    visual content) or ``text`` section; an inline visual context makes a ``text`` section ``combined``. Lines of one
    document are ordered within the document.
    """
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).where(strip(F.col("line")) != "")
    starts_marker = F.col("line").startswith("[") & F.col("line").rlike("|".join(f"{m}:" for m in MARKERS))
    title = ~starts_marker & F.col("line").startswith("===")
    w = Window.partitionBy(key).orderBy("line_no")
    flagged = lines.withColumn("marker", starts_marker).withColumn("title", title)
    numbered = flagged.withColumn("section_no", F.sum((F.col("marker") | F.col("title")).cast("int")).over(w))
    visual = F.max(F.col("marker") | (F.col("title") & F.col("line").contains("Visual Content")))
    combined = F.max(~F.col("marker") & ~F.col("title") & F.col("line").contains("[Visual Context:"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("title"), F.struct("line_no", "line")))), lambda x: x["line"]), "\n")
    grouped = numbered.groupBy(key, "section_no").agg(visual.alias("v"), combined.alias("c"), body.alias("text"), F.count_if(~F.col("title")).alias("kept"))
    return grouped.where("kept > 0").select(key, "section_no", F.when(F.col("v"), "visual").when(F.col("c"), "combined").otherwise("text").alias("type"), "text")


def all_text(text: Column) -> Column:
    """Paragraphs that aren't OCR or caption markers, and the first OCR and caption bodies of each paragraph."""
    def parts(p: Column) -> Column:
        marked = p.startswith(f"[{OCR}:") | p.startswith(f"[{CAPTION}:")
        ocr, cap = (F.regexp_extract(p, rf"\[{m}: (.*?)\]", 1) for m in (OCR, CAPTION))
        has_ocr, has_cap = (p.rlike(rf"\[{m}: (.*?)\]") for m in (OCR, CAPTION))
        return F.array_compact(F.array(F.when(~marked, p), F.when(has_ocr, ocr), F.when(has_cap, cap)))

    return F.array_join(F.flatten(F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), parts)), "\n\n")


def combine_annotations(images: Column, location: bool = False) -> Column:
    """Marker text of an array of annotations; images without any result are left out. ``location``: name it in markers."""
    def one(r: Column) -> Column:
        at = F.coalesce(F.concat(F.lit(" at "), r["location"]), F.lit("")) if location else F.lit("")
        filled = lambda c: c.isNotNull() & (c != "")
        objects = F.transform(r["context"]["objects"], lambda o: F.format_string("%s (%.2f)", o["label"], o["confidence"]))
        qa = r["context"]["visual_qa"]
        if location:
            qa = F.filter(qa, lambda q: ~F.lower(q["answer"]).isin(*UNSURE))
        asked = F.transform(qa, lambda q: F.concat(q["question"], F.lit(" -> "), q["answer"]))
        mark = lambda name, body: F.concat(F.lit(f"[{name}"), at, F.lit(": "), body, F.lit("]"))
        return F.concat_ws(
            "\n",
            F.when(filled(r["ocr_text"]), mark(OCR, r["ocr_text"])),
            F.when(filled(r["caption"]), mark(CAPTION, r["caption"])),
            F.when(F.size(objects) > 0, mark(OBJECTS, F.array_join(objects, ", "))),
            F.when(filled(r["context"]["scene_description"]), mark(SCENE, r["context"]["scene_description"])),
            F.when(F.size(asked) > 0, mark(ANALYSIS, F.array_join(asked, " | "))),
        )

    return F.array_join(F.filter(F.transform(images, one), lambda s: s != ""), "\n\n")


def image_context(annotation: Column, questions: tuple[str, ...] = ("Describe the picture in one line.", "Name the thing it is about.")) -> Column:
    """A one-line summary of an annotation; ``Visual content`` if it says nothing."""
    objects = F.transform(F.filter(annotation["context"]["objects"], lambda o: o["confidence"] > 0.7), lambda o: o["label"])
    answers = F.transform(F.filter(annotation["context"]["visual_qa"], lambda q: q["question"].isin(*questions) & ~F.lower(q["answer"]).isin(*UNSURE)), lambda q: q["answer"])
    joined = F.concat_ws(" | ", F.when(F.size(objects) > 0, F.concat(F.lit("Contains: "), F.array_join(objects, ", "))), F.when(annotation["context"]["scene_description"] != "", annotation["context"]["scene_description"]), F.when(F.size(answers) > 0, F.array_join(answers, " | ")))
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("Visual content"))


def merge_images(text: Column, images: Column, relationships: Column, keep_all: bool = False) -> Column:
    """Text and image sections in one: titled parts without relationships, else each image after its paragraph.

    ``images``: array<struct<target, section>>; a relationship's ``source`` names a paragraph or page (``paragraph_3``).
    ``keep_all``: images of paragraphs that aren't there follow the last one; else they are left out.
    """
    shown = F.array_join(F.transform(images, lambda i: i["section"]), "\n\n")
    apart = F.concat_ws("\n\n", F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.lit(TEXT_TITLE + "\n"), text)), F.concat(F.lit(VISUAL_TITLE + "\n"), shown))
    paragraphs = F.split(F.coalesce(text, F.lit("")), "\n\n")

    def placed(p: Column, i: Column) -> Column:
        def meant(r: Column) -> Column:
            n = F.regexp_extract(r["source"], r"^(?:paragraph|page)_(\d+)$", 1)
            if not keep_all:
                return n == i.cast("string")
            last = F.size(paragraphs) - 1
            return F.least(F.coalesce(n.try_cast("int"), last), last) == i

        here = F.filter(relationships, meant)

        def lines(r: Column) -> Column:
            section = F.get(F.transform(F.filter(images, lambda m: m["target"] == r["target"]), lambda m: m["section"]), F.lit(0))
            note = F.when(r["context"].isNotNull() & section.contains(OBJECTS), "\n[This visual content provides additional context for the surrounding text]")
            return F.when(section.isNotNull(), F.concat_ws("\n\n", F.when(r["context"].isNotNull(), F.concat(F.lit(f"\n[{VISUAL}: "), r["context"], F.lit("]"))), section, note))

        return F.concat(F.array(p), F.array_compact(F.transform(here, lines)))

    inside = F.array_join(F.flatten(F.transform(paragraphs, placed)), "\n\n")
    nothing = images.isNull() | (F.size(images) == 0)
    return F.when(nothing, text).when(relationships.isNull() | (F.size(relationships) == 0), apart).otherwise(inside)
