"""Laid-out pages: spans with places become text, headings, lists and tables, with built-in expressions.

Spans: ``key`` columns, ``line``, ``x``, ``text``, ``size``, ``flags``, ordered by ``line`` and ``x``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.text import is_heading, is_list_item, is_table_block


def block_kinds(spans: DataFrame, key: list[str]) -> DataFrame:
    """``key, table``: whether the places of a block's spans make it a table."""
    return spans.groupBy(*key).agg(is_table_block(F.collect_list("x")).alias("table"))


def line_texts(spans: DataFrame, key: list[str]) -> DataFrame:
    """``key, line, text``: headings as ``## … ##``, list items behind a bullet, other lines as they are."""
    span = F.struct("size", "flags")
    lines = spans.groupBy(*key, "line").agg(F.max(is_heading(span)).alias("heading"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", "text"))), lambda s: s["text"]), "").alias("text"))
    mark = F.when(F.col("heading"), F.concat(F.lit("## "), F.trim("text"), F.lit(" ##"))).when(is_list_item(F.col("text")), F.concat(F.lit("• "), F.trim("text"))).otherwise(F.col("text"))
    return lines.select(*key, "line", mark.alias("text"))


def table_lines(spans: DataFrame, key: list[str]) -> DataFrame:
    """``key, row, text``: Markdown rows of table blocks, under a blank header row and a rule (rows -2 and -1).

    A span belongs to the first column at or right of its place (columns: the distinct places, to 0.1); texts of one
    cell are concatenated; empty rows are dropped.
    """
    s = spans.withColumn("at", F.round("x", 1))
    columns = s.groupBy(*key).agg(F.array_sort(F.collect_set("at")).alias("columns"))
    cells = s.groupBy(*key, "line", "at").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", "text"))), lambda t: t["text"]), "").alias("cell"))
    rows = cells.groupBy(*key, "line").agg(F.map_from_entries(F.collect_list(F.struct("at", "cell"))).alias("m"))
    full = rows.join(columns, key).withColumn("c", F.transform("columns", lambda c: F.coalesce(F.try_element_at("m", c), F.lit(""))))
    body = full.where(F.exists("c", lambda c: F.trim(c) != "")).select(*key, F.col("line").alias("row"), F.concat(F.lit("| "), F.array_join("c", " | "), F.lit(" |")).alias("text"))
    head = columns.select(*key, F.lit(-2).alias("row"), F.concat(F.lit("|"), F.array_join(F.transform("columns", lambda c: F.lit("   ")), "|"), F.lit("|")).alias("text"))
    rule = columns.select(*key, F.lit(-1).alias("row"), F.concat(F.lit("|"), F.array_join(F.transform("columns", lambda c: F.lit("---")), "|"), F.lit("|")).alias("text"))
    return head.union(rule).union(body)


def page_text(lines: DataFrame, key: list[str]) -> DataFrame:
    """``key, text``: lines joined in order."""
    return lines.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda t: t["text"]), "\n").alias("text"))


def reading_order(spans: DataFrame, key: list[str]) -> DataFrame:
    """Spans with ``seq``, their place in the block."""
    return spans.withColumn("seq", F.row_number().over(Window.partitionBy(*key).orderBy("line", "x", "text")))
