"""Writing results: JSON lines, one JSON array, Parquet, processing state and usage."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object a line, nulls included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_array(df: DataFrame, path: str) -> int:
    """One indented JSON array in a local file, streamed row by row; for small results. Returns the rows written."""
    n = 0
    with Path(path).open("w", encoding="utf-8") as h:
        h.write("[")
        for row in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator():
            h.write((",\n" if n else "\n") + json.dumps(json.loads(row["j"]), indent=2, ensure_ascii=False))
            n += 1
        h.write("\n]\n")
    return n


def write_if_any(df: DataFrame, path: str) -> bool:
    """Writes JSON lines unless ``df`` is empty."""
    if df.isEmpty():
        return False
    write_jsonl(df, path)
    return True


def state_rows(parsed: DataFrame) -> DataFrame:
    """State rows of parsed files: failures are recorded, too."""
    return parsed.select(F.col("source").alias("path"), F.col("error").isNull().alias("success"), F.current_timestamp().alias("ts"), "error")


def append(df: DataFrame, path: str) -> None:
    """Appends to a Parquet table (state, usage, image metadata)."""
    df.write.mode("append").parquet(path)
