"""Image annotation behind an adapter: bytes to OCR text, caption, objects, scene and visual answers."""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.functions.arrow import map_rows
from siltstone.functions.markers import combine_annotations, image_context, merge_images
from siltstone.io import cut
from siltstone.models.pixels import features

# What images are asked unless the caller asks otherwise: one question for each thing a marker or summary can use.
QUESTIONS = ("Describe the picture in one line.", "Name the thing it is about.", "Name the place it shows.", "Count the persons on it.", "List the things on it.", "Put its mood in one word.")
EMPTY = {"ocr_text": "", "caption": "", "context": {"objects": [], "scene_description": "", "visual_qa": []}}


@dataclass
class Annotator:
    """An annotator made of parts; each takes a list of images (bytes) and gives a result for each. Missing parts give nothing.

    ``ocr``: texts, of images made black and white (``binary``); ``detect``: lists of objects (label, confidence, box), of
    which those under ``least`` are dropped; ``caption``, ``scene``: texts; ``answer``: takes (image, question) pairs and
    gives lists of (answer, confidence), of which the first counts. A part that fails for an image leaves only that
    image's result empty.
    """

    ocr: Callable | None = None
    detect: Callable | None = None
    caption: Callable | None = None
    scene: Callable | None = None
    answer: Callable | None = None
    questions: tuple[str, ...] = QUESTIONS
    least: float = 0.5
    binary: Callable[[bytes], object] | None = None

    def __call__(self, images: list[bytes]) -> list[dict]:
        binary = [x for b in images for x in one_by_one(lambda one: [self.binary(one[0])], [b], b)] if self.binary else images
        texts = one_by_one(self.ocr, binary, "")
        objects = one_by_one(self.detect, images, [])
        captions, scenes = one_by_one(self.caption, images, ""), one_by_one(self.scene, images, "")
        asked = one_by_one(self.answer, [(b, q) for b in images for q in self.questions], []) if self.answer else []
        out = []
        for i in range(len(images)):
            n = len(self.questions)
            qa = [{"question": q, "answer": found[0][0], "confidence": float(found[0][1])} for q, found in zip(self.questions, asked[i * n : (i + 1) * n]) if found]
            sure = [o for o in objects[i] if o["confidence"] >= self.least]
            out.append({"ocr_text": texts[i], "caption": captions[i], "context": {"objects": sure, "scene_description": scenes[i], "visual_qa": qa}})
        return out


def one_by_one(f: Callable | None, items: list, empty) -> list:
    """Results for all items at once; if that fails, item by item, and ``empty`` for those that fail alone."""
    if f is None or not items:
        return [empty] * len(items)
    try:
        found = list(f(items))
        if len(found) == len(items):
            return found
    except Exception:  # noqa: BLE001 - one bad image must not spoil the others
        pass
    if len(items) == 1:
        return [empty]
    return [x for item in items for x in one_by_one(f, [item], empty)]


def asked(images: DataFrame, questions: tuple[str, ...] = QUESTIONS, key: str = "image_id") -> DataFrame:
    """``key, question_no, question``: every image with every question (a short list)."""
    return images.select(key, F.posexplode(F.array(*[F.lit(q) for q in questions])).alias("question_no", "question"))


def header_annotator(images: list[bytes]) -> list[dict]:
    """A stand-in without models: names the format and size that the first bytes tell."""
    out = []
    for b in images:
        b = bytes(b or b"")
        caption = ""
        if b[:8] == b"\x89PNG\r\n\x1a\n" and len(b) >= 24:
            w, h = struct.unpack(">II", b[16:24])
            caption = f"a PNG image of {w} by {h} pixels"
        out.append({"ocr_text": "", "caption": caption, "context": {"objects": [], "scene_description": "", "visual_qa": []}})
    return out


def annotate(images: DataFrame, annotator: Callable[[list[bytes]], list[dict]] = header_annotator, key: str = "image_id", data: str = "bytes") -> DataFrame:
    """``key, annotation``; an image that fails gives an empty annotation."""
    kind = dict(images.dtypes)[key]

    def make():
        def f(keys, blobs):
            return keys, one_by_one(annotator, [bytes(b or b"") for b in blobs], EMPTY)

        return f

    return map_rows(images.select(key, data), make, f"{key} {kind}, annotation struct<{schemas.ANNOTATION.replace(' string', ':string').replace(' struct', ':struct')}>")


def with_features(images: DataFrame, data: str = "bytes") -> DataFrame:
    """Adds ``width, height, edge_density, colours`` of the pixels; null for images that cannot be decoded."""
    kinds = dict(images.dtypes)
    names = images.columns

    def make():
        def f(*columns):
            out = [[], [], [], []]
            for b in columns[names.index(data)]:
                try:
                    found = features(bytes(b))
                except Exception:  # noqa: BLE001 - any broken image
                    found = {}
                for column, name in zip(out, ("width", "height", "edge_density", "colours")):
                    column.append(found.get(name))
            return *columns, *out

        return f

    return map_rows(images, make, ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", width int, height int, edge_density double, colours int")


def with_images(docs: DataFrame, images: DataFrame, annotator: Callable = header_annotator, key: str = "doc_id", text: str = "content") -> DataFrame:
    """``docs`` with what their images show merged into ``text``: annotated, summed up, and put behind their paragraphs.

    ``images`` has ``key, image_no, bytes, place`` (``paragraph_3``, ``page_2``; null: the paragraph of the image's number).
    Equal images are annotated once. The images of one document come together in one row, as its text does.
    """
    held = images.withColumn("image_id", F.sha2("bytes", 256))
    notes = cut(annotate(held.groupBy("image_id").agg(F.first("bytes").alias("bytes")), annotator, "image_id"), "annotations")
    each = held.drop("bytes").join(notes, "image_id")
    target, place = F.concat(F.lit("img_"), F.col("image_no").cast("string")), F.coalesce("place", F.concat(F.lit("paragraph_"), F.col("image_no").cast("string")))
    shown = F.struct("image_no", F.struct(target.alias("target"), combine_annotations(F.array("annotation")).alias("section")).alias("image"), F.struct(F.lit("embedded_content").alias("type"), place.alias("source"), target.alias("target"), image_context(F.col("annotation")).alias("context")).alias("relationship"))
    by_doc = each.select(key, shown.alias("s")).groupBy(key).agg(F.array_sort(F.collect_list("s")).alias("s"))
    x = docs.join(by_doc, key, "left")
    merged = merge_images(F.col(text), F.transform("s", lambda s: s["image"]), F.transform("s", lambda s: s["relationship"]), keep_all=True)
    return x.withColumn(text, merged).withColumn("relationships", F.transform("s", lambda s: s["relationship"])).drop("s")


def with_ids(images: DataFrame, data: str = "bytes") -> DataFrame:
    """Adds ``image_id``, the SHA-256 of the bytes, so equal images share one annotation."""
    return images.withColumn("image_id", F.sha2(data, 256))
