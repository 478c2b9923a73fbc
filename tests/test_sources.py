import io
import os
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone import operations
from siltstone.functions import embed, layout
from siltstone.models import clients, images, pixels
from siltstone.models.prompts import Prompts
from siltstone.sources import files, pdf


def png(pixels_: np.ndarray, filters: list[int] | None = None) -> bytes:
    """A PNG of RGB pixels; each row may have a filter of its own."""
    h, w, _ = pixels_.shape
    rows, up = b"", np.zeros((w, 3), np.int64)
    for y in range(h):
        f = (filters or [0])[y % len(filters or [0])]
        line = pixels_[y].astype(np.int64)
        left, corner = np.vstack([np.zeros((1, 3), np.int64), line[:-1]]), np.vstack([np.zeros((1, 3), np.int64), up[:-1]])
        p = left + up - corner
        a, b, c = abs(p - left), abs(p - up), abs(p - corner)
        guess = [0, left, up, (left + up) // 2, np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))][f]
        rows += bytes([f]) + ((line - guess) % 256).astype(np.uint8).tobytes()
        up = line
    part = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


NOISE = np.random.default_rng(1).integers(0, 256, (120, 130, 3)).astype(np.uint8)


def test_png_filters():
    assert (pixels.decode(png(NOISE, [0, 1, 2, 3, 4])) == NOISE).all()
    with pytest.raises(ValueError):
        pixels.decode(b"GIF89a" + b"x" * 40) if not _pillow() else pixels.decode_bmp(b"BM" + b"\0" * 60)


def _pillow() -> bool:
    try:
        import PIL  # noqa: F401
    except ImportError:
        return False
    return True


def test_features(spark):
    flat = np.full((100, 110, 3), 200, np.uint8)
    square = flat.copy()
    square[30:70, 30:70] = 0
    df = spark.createDataFrame([(1, bytearray(png(NOISE))), (2, bytearray(png(flat))), (3, bytearray(png(square))), (4, bytearray(b"no image")), (5, None)], "image_id int, bytes binary")
    got = {r.image_id: r for r in images.with_features(df).collect()}
    assert (got[1].width, got[1].height) == (130, 120) and got[1].edge_density > 0.01 and got[1].colours == 257
    assert got[2].edge_density == 0 and got[2].colours == 1 and got[3].colours == 2 and 0.01 < got[3].edge_density < 0.05
    assert got[4].width is None and got[5].width is None
    edges = pixels.edge_map(pixels.grey(square))
    assert edges.sum() > 120 and not edges[45:55, 45:55].any()


def test_scan_pixels():
    page = np.full((80, 200), 230, np.uint8)
    page[20:24, 20:180] = page[40:44, 20:180] = 30
    assert 30 <= pixels.otsu(page) < 230
    tilted = pixels.turned(np.where(page < 100, 0, 255).astype(np.uint8), 3.0)
    assert abs(pixels.skew(tilted)) >= 2 and abs(pixels.skew(pixels.turned(tilted, pixels.skew(tilted)))) <= 1
    assert set(np.unique(pixels.enhanced(page))) <= {0, 255}


def test_annotator_parts(spark):
    def ocr(items):
        if any(b == b"bad" for b in items):
            raise RuntimeError
        return [b.decode() for b in items]

    a = images.Annotator(ocr=ocr, detect=lambda x: [[{"label": "cat", "confidence": 0.9, "box": []}, {"label": "cup", "confidence": 0.4, "box": []}] for _ in x], answer=lambda qs: [[(q.upper(), 0.8), ("x", 0.1)] for _, q in qs], questions=("a?", "b?"))
    df = spark.createDataFrame([(1, bytearray(b"one")), (2, bytearray(b"bad")), (3, bytearray(b"two"))], "image_id int, bytes binary")
    got = {r.image_id: r.annotation for r in images.annotate(df, a).collect()}
    assert [got[i].ocr_text for i in (1, 2, 3)] == ["one", "", "two"] and [o.label for o in got[2].context.objects] == ["cat"] and [q.answer for q in got[3].context.visual_qa] == ["A?", "B?"]
    assert images.asked(df, ("a?", "b?")).count() == 6


def docx(picture: bytes) -> bytes:
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="u" xmlns:a="b" xmlns:r="c"><w:p><w:r><w:t>one</w:t></w:r></w:p><w:p><w:r><w:t>two</w:t><a:blip r:embed="r1"/></w:r></w:p></w:document>')
        z.writestr("word/_rels/document.xml.rels", '<Relationships><Relationship Id="r1" Target="media/i.png"/><Relationship Id="r2" Target="http://x" TargetMode="External"/></Relationships>')
        z.writestr("word/media/i.png", picture)
    return raw.getvalue()


def test_pictures_of_documents(spark, tmp_path):
    small = png(NOISE[:4, :5])
    (tmp_path / "a.docx").write_bytes(docx(small))
    (tmp_path / "b.png").write_bytes(small)
    (tmp_path / "c.doc").write_bytes(docx(small))
    (tmp_path / "d.xls").write_bytes(b"legacy")
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("ppt/slides/slide1.xml", '<p:sld xmlns:p="u" xmlns:a="b" xmlns:r="c"><p:pic><a:blip r:embed="r1"/></p:pic><p:txBody><a:p><a:r><a:t>hi</a:t></a:r></a:p></p:txBody></p:sld>')
        z.writestr("ppt/slides/_rels/slide1.xml.rels", '<Relationships><Relationship Id="r1" Target="../media/i.png"/></Relationships>')
        z.writestr("ppt/media/i.png", small)
    assert files.images_in(raw.getvalue(), ".pptx") == [("slide_0", small)] and files.PARSERS[".ppt"](raw.getvalue()) == "hi"
    got = {r.source.rpartition("/")[2]: r for r in files.read_with_images(spark, str(tmp_path)).collect()}
    assert got["a.docx"].content.count("a PNG image of 5 by 4 pixels") == 1 and got["a.docx"].relationships[0].source == "paragraph_1" and got["b.png"].content.count("PNG") == 1
    assert got["c.doc"].content.startswith("one two") and got["d.xls"].error


def pdf_file() -> bytes:
    text = b"BT /F1 18 Tf 72 700 Td (Pump \\(old\\) report) Tj /F1 10 Tf 0 -30 Td (First) Tj 60 0 Td [( li) 5 (ne) -300 (here)] TJ -60 -14 Td (- an item) Tj ET"
    second = b"BT /F2 10 Tf 1 0 0 1 72 700 Tm <00010002> Tj ET"
    cmap = b"1 beginbfchar <0001> <0041> endbfchar 1 beginbfrange <0002> <0003> <00E4> endbfrange"
    deflated = zlib.compress(text)
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [3 0 R 4 0 R] /Count 2 /Resources << /Font << /F1 7 0 R /F2 8 0 R >> >> >>", b"<< /Type /Page /Parent 2 0 R /Contents 5 0 R >>", b"<< /Type /Page /Parent 2 0 R /Contents [6 0 R] >>",
        b"<< /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(deflated), deflated), b"<< /Length %d >>\nstream\n%s\nendstream" % (len(second), second), b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>", b"<< /Type /Font /Subtype /Type0 /BaseFont /X-Bold /ToUnicode 9 0 R >>",
        b"<< /Length %d >>\nstream\n%s\nendstream" % (len(cmap), cmap),
    ]
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (i, o) for i, o in enumerate(objects, 1)) + b"trailer << /Root 1 0 R >>"


def test_pdf(spark):
    assert files.PARSERS[".pdf"](pdf_file()) == "## Pump (old) report ##\nFirst line here\n• - an item\n\nAä"
    with pytest.raises(ValueError):
        pdf.pdf_text(b"%PDF /Encrypt")
    df = spark.createDataFrame([("a.PDF", bytearray(pdf_file())), ("b.pdf", bytearray(b"x")), ("c.txt", bytearray(b"x"))], "path string, content binary")
    lines = layout.line_texts(files.pdf_spans(df), ["source", "page"]).orderBy("page", "line").collect()
    assert [r.text for r in lines] == ["## Pump (old) report ##", "First line here", "• - an item", "Aä"]


def test_clients(spark):
    seen = []

    def flaky(prompts):
        seen.append(len(prompts))
        if "bad" in prompts:
            raise RuntimeError
        return ["{}" if len(seen) < 6 else '{"valid": true, "scores": {"answer_validity": 1, "question_quality": 1, "instruction_quality": 1}, "issues": [], "improvements": []}' for _ in prompts]

    assert clients.each(flaky, ["a", "bad", "b"]) == ["{}", "", "{}"] and seen == [3, 1, 1, 1]
    assert all(clients.verdict_ok(r) for r in clients.Retry(flaky, clients.verdict_ok, pause=0)(["p", "q"])) and not clients.verdict_ok("x {1")
    config = {"llm_models": {"a": {"name": "m-8b", "type": "vllm", "parameters": {"max_tokens": 5}}, "b": {"name": "local", "type": "transformers"}, "c": {"name": "c", "type": "odd"}}, "default_model": "a", "serving": {"vllm": {"url": "http://x"}}}
    assert clients.client_of(config) == clients.Http("http://x", max_tokens=5) and clients.model_info(config, "a")["memory_gb"] == 19.2
    for name in ("b", "c", "d"):
        with pytest.raises(ValueError):
            clients.client_of(config, name)
    loads = []
    clients.LOADERS["local"] = lambda parameters: loads.append(1) or (lambda prompts: [p + "!" for p in prompts])
    try:
        assert clients.client_of(config, "b")(["x"]) == clients.client_of(config, "b")(["x"]) == ["x!"] and loads == [1]
    finally:
        clients.LOADERS.clear()
        clients.forget_shared()
    got = {r.k: r.reply for r in clients.generate(spark.createDataFrame([(1, "a"), (2, "bad"), (3, "b")], "k int, prompt string").coalesce(1), lambda ps: [p.upper() if p != "bad" else 1 / 0 for p in ps], ["k"]).collect()}
    assert got == {1: "A", 2: "", 3: "B"}


def test_prompt_files(tmp_path):
    p = Prompts()
    p.add("own", "Say {x}: ü")
    p.save(str(tmp_path / "p.yaml"))
    assert Prompts.load(str(tmp_path / "p.yaml")).templates == p.templates


def test_operations(tmp_path, monkeypatch):
    monkeypatch.delenv("SILT_A", raising=False)
    monkeypatch.setenv("SILT_B", "kept")
    (tmp_path / ".env").write_text("# x\nexport SILT_A='one'\nSILT_B=two\n")
    assert operations.load_env(tmp_path / "none", (str(tmp_path / ".env"),)) == tmp_path / ".env" and os.environ["SILT_A"] == "one" and os.environ["SILT_B"] == "kept"
    assert operations.load_env(None, ()) is None and operations.system_info()["cpus"]
    with operations.timed("x") as t:
        pass
    assert t["seconds"] >= 0 and operations.log_to("INFO", str(tmp_path / "l")).name == "siltstone"


def test_embedders(spark):
    df = embed.embedded(spark.createDataFrame([(1, "a b a", "x"), (2, None, "y"), (3, "b a a", "z")], "k int, t string, vector string"), "t")
    got = {r.k: r.vector for r in df.collect()}
    assert got[1] == got[3] and got[2] == [0.0] * 64 and sum(map(abs, got[1])) == 3
    c = df.select(embed.cosine(F.col("vector"), F.col("vector")).alias("c"), "k").collect()
    assert {r.k: round(r.c, 9) for r in c} == {1: 1.0, 2: 0.0, 3: 1.0}
    assert embed.Encoder("e", lambda: lambda ts: [[len(t)] for t in ts])([None, "ab"]) == [[0.0], [2.0]]
