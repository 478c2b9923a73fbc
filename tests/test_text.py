import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.functions import arrow, markers
from siltstone.functions import text as fn


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


def test_clean(spark):
    assert one(spark, "hello   world\nfoo", fn.clean_text) == "hello world foo"
    assert one(spark, "  a\n\n b  ", fn.clean_text) == ""
    assert one(spark, None, fn.clean_text) == "" and one(spark, "", fn.clean_text) == ""
    assert one(spark, "x y and some more", fn.clean_text) == "x y and some more"
    assert one(spark, "see https://a.b/c for all of it", lambda c: fn.clean_text(c, urls=True)) == "see  for all of it"
    assert len(one(spark, "word " * 50_000, fn.clean_text)) == 100_000
    assert one(spark, "one  two\n\n\nthree   four", lambda c: fn.clean_text(c, keep_paragraphs=True)) == "one two\n\nthree four"


def test_tokens_and_types(spark):
    assert one(spark, "0123456789", fn.token_estimate) == 2 and one(spark, None, fn.token_estimate) is None
    assert one(spark, "A/b.PDF", fn.file_type) == "text" and one(spark, "x.png", fn.file_type) == "image" and one(spark, "x", fn.file_type) is None
    assert one(spark, " a  b ", fn.split_words) == ["a", "b"] and one(spark, None, fn.split_words) == [] and one(spark, "", fn.split_words) == []
    assert one(spark, "a b c d", lambda c: fn.ngrams(fn.words(c), 3)) == ["a b c", "b c d"] and one(spark, "a b", lambda c: fn.ngrams(fn.words(c), 3)) == []
    assert one(spark, "<p>a < b</p>", fn.strip_tags) == "a "


def test_layout(spark):
    assert one(spark, [1.0, 20.04, 20.0, 40.0], fn.is_table_block, "array<double>")
    assert not one(spark, [1.0, 3.0, 40.0], fn.is_table_block, "array<double>") and not one(spark, [1.0], fn.is_table_block, "array<double>") and not one(spark, [], fn.is_table_block, "array<double>")
    assert one(spark, (13.0, 8), fn.is_heading, "struct<size:double,flags:int>") and not one(spark, (13.0, 0), fn.is_heading, "struct<size:double,flags:int>") and one(spark, (15.0, 0), fn.is_heading, "struct<size:double,flags:int>")
    assert one(spark, "2. x", fn.is_list_item) and one(spark, "• x", fn.is_list_item) and not one(spark, "x", fn.is_list_item)


def test_word_chunks():
    assert arrow.word_chunks("a  b", 4) == ["a  b"] and arrow.word_chunks("", 4) == [""]
    text = " ".join(f"w{i}" for i in range(1200))
    pieces = arrow.word_chunks(text)
    assert [len(p.split()) for p in pieces] == [512, 512, 276] and pieces[1].split()[:50] == pieces[0].split()[-50:]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["", ".", "!", ","]), max_size=90), st.integers(2, 12), st.integers(0, 12))
def test_word_chunks_cover(ends, size, overlap):
    w = [f"w{i}{e}" for i, e in enumerate(ends)]
    pieces = [p.split() for p in arrow.word_chunks(" ".join(w), size, min(overlap, size - 1), 3)]
    at = 0
    for p in pieces:  # every piece goes on within or right behind what is covered
        start = next(s for s in range(max(0, at - size - 3), at + 1) if w[s : s + len(p)] == p)
        at = max(at, start + len(p))
    assert at == len(w)


@settings(max_examples=60, deadline=None)
@given(st.text("ab .,\n", max_size=200), st.integers(8, 40))
def test_char_chunks_bound(t, size):
    for p in arrow.char_chunks(t, size, size // 4):
        assert len(p) <= size or not any(s in p for s in ("\n\n", "\n", ". ", ", ", " "))
    assert "".join(t.split()) == "".join("".join(arrow.char_chunks(t, size, 0)).replace(",", "").split()) or "," in t or "." in t


def test_markers(spark):
    text = "Intro\n[OCR Text: AB 12]\n[OCR Text at page 1: x]\n[Image Caption: a cat]\n[Detected Objects: cat (0.93), cup (0.55), odd]\n[Scene Description: a room]\n[Visual Analysis: q? -> a | r -> s -> t | none]"
    got = markers.visual_answers(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, content string")).orderBy("kind_no", "n").collect()
    assert [(r.text, r.subtype, r.score, r.question) for r in got] == [("AB 12", "ocr_text", 0.8, None), ("a cat", "caption", 0.9, None), ("cat", "objects", 0.85, None), ("a room", "scene", 0.9, None), ("a", "analysis", 0.85, "q?"), ("s -> t", "analysis", 0.85, "r")]


def test_sections(spark):
    text = "a\n\nb\n[OCR Text: x]\nmore\n=== Visual Content ===\nv\n=== Document Text ===\nw [Visual Context: y]"
    got = markers.sections(spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, content string")).orderBy("section_no").collect()
    assert [(r.type, r.text) for r in got] == [("text", "a\nb"), ("visual", "[OCR Text: x]\nmore"), ("visual", "v"), ("combined", "w [Visual Context: y]")]


def test_combine_and_merge(spark):
    kind = "struct<ocr_text:string,caption:string,context:struct<objects:array<struct<label:string,confidence:double>>,scene_description:string,visual_qa:array<struct<question:string,answer:string>>>>"
    rows = [([("t", "", ([("cat", 0.934)], "room", [("q", "a"), ("r", "Unknown")])), ("", None, ([], "", []))],)]
    df = spark.createDataFrame(rows, f"x array<{kind}>")
    assert df.select(markers.combine_annotations(F.col("x")).alias("y")).first()["y"] == "[OCR Text: t]\n[Detected Objects: cat (0.93)]\n[Scene Description: room]\n[Visual Analysis: q -> a | r -> Unknown]"
    assert markers.UNSURE and df.select(markers.image_context(F.col("x")[1]).alias("y")).first()["y"] == "Visual content"
    m = spark.createDataFrame([("p0\n\np1", [("i", "[Detected Objects: z]")], [("paragraph_0", "i", "near")]), ("p", [("i", "s")], []), ("p", [], [])], "t string, i array<struct<target:string,section:string>>, r array<struct<source:string,target:string,context:string>>")
    got = [r[0] for r in m.select(markers.merge_images(F.col("t"), F.col("i"), F.col("r"))).collect()]
    assert got[0].startswith("p0\n\n\n[Visual Context: near]\n\n[Detected Objects: z]\n\n\n[This visual") and got[0].endswith("\n\np1")
    assert got[1] == "=== Document Text ===\np\n\n=== Visual Content ===\ns" and got[2] == "p"


def test_sheet_and_parsers():
    import io
    import zipfile

    from siltstone.sources.files import PARSERS, sheet_text

    assert sheet_text("S", [["a", "b"], ["", ""], ["1", "2"]]) == "Sheet: S\n| a | b |\n|---|---|\n| 1 | 2 |"
    assert PARSERS[".md"](b"# T\n\n* a **b** [c](d.md) <i>e</i>") == "T a b c e"
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="u"><w:p><w:r><w:t>one</w:t></w:r></w:p><w:p><w:r><w:t>two</w:t></w:r></w:p></w:document>')
    assert PARSERS[".docx"](raw.getvalue()) == "one\ntwo"
    random.seed(1)
