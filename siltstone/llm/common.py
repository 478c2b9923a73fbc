"""Helpers of the training-data operators."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A word is a maximal run of Unicode letters and digits.
WORD = re.compile(r"[^\W_]+")


def map_rows(df: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` for functions over columns.

    ``make()`` runs once a task and returns ``f(batch) -> tuple of column lists`` in the order of ``schema``, or ``f`` and
    ``rest() -> tuple``, which gives what ``f`` held back when the task ends.
    """
    out = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make()
        f, rest = made if isinstance(made, tuple) else (made, None)

        def rows(columns):
            if columns is not None and len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=field.type) for c, field in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            if batch.num_rows:
                yield from rows(f(batch))
        if rest:
            yield from rows(rest())

    return df.mapInArrow(run, out)


def word_hash(word: str) -> int:
    """A 32-bit hash of a word, the same on every machine."""
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))
