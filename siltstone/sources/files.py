"""Reading documents from files: enumeration, parsers by suffix, JSON lines.

Files are read as binary by Spark and parsed in Arrow batches; a file that cannot be parsed gives a row with an error,
never a failed job. Office formats and the text layer of PDF are read with the standard library; files of the legacy
binary formats give an error row (their suffixes are accepted for files of the newer formats) unless a plug-in is
registered (``register``).
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.config import Config
from siltstone.functions.arrow import map_rows
from siltstone.functions.text import suffix
from siltstone.operators.state import unprocessed

PARSERS: dict[str, Callable[[bytes], str]] = {}
SPACE = re.compile(r"\s+")


def register(*suffixes: str):
    """Registers a parser (bytes to text) for suffixes; later registrations replace earlier ones."""

    def add(f: Callable[[bytes], str]) -> Callable[[bytes], str]:
        for s in suffixes:
            PARSERS[s] = f
        return f

    return add


def cleaned(text: str) -> str:
    return SPACE.sub(" ", text).strip()


@register(".txt")
def parse_text(data: bytes) -> str:
    return cleaned(data.decode("utf-8"))


@register(".md")
def parse_markdown(data: bytes) -> str:
    """Markdown marks that renderers turn into tags are dropped; entities stay as they are."""
    t = data.decode("utf-8")
    t = re.sub(r"(?m)^\s{0,3}#{1,6}\s+|^\s{0,3}>\s?|^\s*[-*+]\s+|^\s{0,3}(?:-{3,}|={3,}|\*{3,})\s*$|^```.*$", "", t)
    t = re.sub(r"!\[([^\]]*)\]\([^)]*\)|\[([^\]]*)\]\([^)]*\)", lambda m: m[2] or "", t)
    t = re.sub(r"(\*\*|__|\*|_|`)(\S(?:.*?\S)?)\1", r"\2", t)
    return cleaned(re.sub(r"<[^>]+>", "", t))


def _xml(z: zipfile.ZipFile, name: str) -> ElementTree.Element:
    return ElementTree.fromstring(z.read(name))


def _local(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


@register(".docx")
def parse_docx(data: bytes) -> str:
    """Paragraphs joined by line breaks, as they are."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = _xml(z, "word/document.xml")
    return "\n".join("".join(t.text or "" for t in p.iter() if _local(t) == "t") for p in root.iter() if _local(p) == "p")


@register(".doc")
def parse_doc(data: bytes) -> str:
    """A Word file under the old suffix, cleaned as one line."""
    return cleaned(re.sub(r"<[^>]+>", "", parse_docx(data)))


@register(".pdf")
def parse_pdf(data: bytes) -> str:
    from siltstone.sources.pdf import pdf_text

    return pdf_text(data)


def related_parts(z: zipfile.ZipFile, part: str) -> dict[str, str]:
    """Names of the parts that ``part`` relates to, by their ids."""
    folder, _, name = part.rpartition("/")
    rels = f"{folder}/_rels/{name}.rels"
    if rels not in z.namelist():
        return {}
    return {r.attrib["Id"]: posixpath.normpath(posixpath.join(folder, r.attrib["Target"])).lstrip("/") for r in _xml(z, rels) if r.attrib.get("TargetMode") != "External"}


def _blips(e: ElementTree.Element) -> list[str]:
    return [next(v for k, v in b.attrib.items() if k.rpartition("}")[2] == "embed") for b in e.iter() if _local(b) == "blip" and any(k.rpartition("}")[2] == "embed" for k in b.attrib)]


def images_in(data: bytes, suffix_: str) -> list[tuple[str, bytes]]:
    """(place, bytes) of the pictures of a Word (``paragraph_3``) or PowerPoint (``slide_2``) file, in order."""
    out: list[tuple[str, bytes]] = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        if suffix_ in (".docx", ".doc"):
            parts = related_parts(z, "word/document.xml")
            paragraphs = [p for p in _xml(z, "word/document.xml").iter() if _local(p) == "p"]
            found = [(f"paragraph_{i}", parts.get(r)) for i, p in enumerate(paragraphs) for r in _blips(p)]
        elif suffix_ in (".pptx", ".ppt"):
            found = []
            for i, name in enumerate(_slides(z)):
                parts = related_parts(z, name)
                found += [(f"slide_{i}", parts.get(r)) for s in _xml(z, name).iter() if _local(s) == "pic" for r in _blips(s)]
        else:
            found = []
        names = set(z.namelist())
        out = [(place, z.read(name)) for place, name in found if name in names]
    return out


def _slides(z: zipfile.ZipFile) -> list[str]:
    return sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))


@register(".pptx", ".ppt")
def parse_pptx(data: bytes) -> str:
    """Text of the shapes of all slides, in order, joined by line breaks."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shapes = [s for n in _slides(z) for s in _xml(z, n).iter() if _local(s) == "txBody"]
    lines = ("\n".join("".join(t.text or "" for t in p.iter() if _local(t) == "t") for p in s.iter() if _local(p) == "p") for s in shapes)
    return "\n".join(x for x in lines if x.strip())


def sheet_text(title: str, rows: list[list[str]], markdown: bool = True) -> str:
    """A titled sheet as a Markdown table (a rule after the first row) or tab-separated lines; empty rows are skipped."""
    out = [f"Sheet: {title}"]
    for cells in rows:
        if not any(c.strip() for c in cells):
            continue
        out.append("| " + " | ".join(cells) + " |" if markdown else "\t".join(cells))
        if markdown and len(out) == 2:
            out.append("|" + "|".join(["---"] * len(cells)) + "|")
    return "\n".join(out)


@register(".xlsx", ".xls")
def parse_xlsx(data: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter() if _local(t) == "t") for si in _xml(z, "xl/sharedStrings.xml") if _local(si) == "si"]
        titles = [s.attrib.get("name", "") for s in _xml(z, "xl/workbook.xml").iter() if _local(s) == "sheet"]
        names = sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
        sheets = []
        for title, name in zip(titles, names):
            rows = []
            for row in (r for r in _xml(z, name).iter() if _local(r) == "row"):
                cells: list[str] = []
                for c in (c for c in row if _local(c) == "c"):
                    letters = re.match(r"[A-Z]+", c.attrib.get("r", ""))
                    at = 0
                    for ch in letters[0] if letters else "":
                        at = at * 26 + ord(ch) - 64
                    cells += [""] * (at - 1 - len(cells))
                    value = next((v.text or "" for v in c.iter() if _local(v) in ("v", "t")), "")
                    cells.append(shared[int(value)] if c.attrib.get("t") == "s" and value else value)
                rows.append(cells)
            sheets.append(sheet_text(title, rows))
    return "\n\n".join(sheets)


def files_in(spark: SparkSession, folder: str, config: Config = Config(), images: bool = False) -> DataFrame:
    """``path, format, bytes, modified`` of the supported files below ``folder``, without their contents."""
    kept = config.text_suffixes + (config.image_suffixes if images else ())
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "modificationTime")
    return found.withColumn("format", F.ltrim(F.lit("."), suffix(F.col("path")))).where(suffix(F.col("path")).isin(*kept)).select("path", "format", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def parsed(files: DataFrame) -> DataFrame:
    """``source, type, format, content, error`` of files with ``path`` and ``content`` (binary)."""

    def make():
        def f(paths, contents):
            out = [[] for _ in range(5)]
            for p, data in zip(paths, contents):
                ext = "." + p.rpartition(".")[2].lower() if "." in p.rpartition("/")[2] else ""
                text = error = None
                try:
                    text = PARSERS[ext](bytes(data))
                except KeyError:
                    error = f"no parser for {ext or 'files without a suffix'}"
                except Exception as e:  # noqa: BLE001 - any broken file becomes an error row
                    error = f"{type(e).__name__}: {e}"[:500]
                for column, value in zip(out, (p, "document", ext[1:], text, error)):
                    column.append(value)
            return out

        return f

    return map_rows(files.select("path", "content"), make, "source string, type string, format string, content string, error string")


def pictures(files: DataFrame) -> DataFrame:
    """``source, image_no, place, bytes``: the pictures inside Word and PowerPoint files; broken files have none."""

    def make():
        def f(paths, contents):
            out = [[] for _ in range(4)]
            for p, data in zip(paths, contents):
                try:
                    found = images_in(bytes(data), "." + p.rpartition(".")[2].lower())
                except Exception:  # noqa: BLE001 - reported as an error row by ``parsed``
                    found = []
                for i, (place, b) in enumerate(found):
                    for column, value in zip(out, (p, i, place, b)):
                        column.append(value)
            return out

        return f

    return map_rows(files.select("path", "content"), make, "source string, image_no int, place string, bytes binary")


def pdf_spans(files: DataFrame) -> DataFrame:
    """``source, page, line, x, text, size, flags`` of PDF files, for the layout rules of ``functions.layout``."""
    from siltstone.sources.pdf import spans

    def make():
        def f(paths, contents):
            out = [[] for _ in range(7)]
            for p, data in zip(paths, contents):
                try:
                    found = spans(bytes(data))
                except Exception:  # noqa: BLE001
                    found = []
                for row in found:
                    for column, value in zip(out, (p, *row)):
                        column.append(value)
            return out

        return f

    return map_rows(files.where(F.lower("path").endswith(".pdf")).select("path", "content"), make, "source string, page int, line int, x double, text string, size double, flags int")


def read_with_images(spark: SparkSession, folder: str, annotator: Callable | None = None, config: Config = Config()) -> DataFrame:
    """As ``read_documents``, with what the pictures in the files show merged into their texts, and image files as documents."""
    from siltstone.models.images import header_annotator, with_images

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    texts = files.where(suffix(F.col("path")).isin(*config.text_suffixes))
    images = files.where(suffix(F.col("path")).isin(*config.image_suffixes))
    alone = images.select(F.col("path").alias("source"), F.lit("image").alias("type"), F.ltrim(F.lit("."), suffix(F.col("path"))).alias("format"), F.lit("").alias("content"), F.lit(None).cast("string").alias("error"))
    held = pictures(texts).union(images.select(F.col("path").alias("source"), F.lit(0).alias("image_no"), F.lit(None).cast("string").alias("place"), F.col("content").alias("bytes")))
    return with_images(parsed(texts).union(alone), held, annotator or header_annotator, "source")


def read_documents(spark: SparkSession, folder: str, state: DataFrame | None = None, config: Config = Config(), first: int | None = None) -> DataFrame:
    """Documents of all supported files below ``folder`` that ``state`` doesn't hold as done; ``first``: only so many, by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    files = files.where(suffix(F.col("path")).isin(*config.text_suffixes))
    if state is not None:
        files = unprocessed(files, state, "path")
    if first is not None:
        files = files.orderBy("path").limit(first)
    return parsed(files)


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines by schema; blank lines are skipped, a broken line raises."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
