"""Similarity within groups: coherence, near-duplicate removal and merging of chunks.

The usual group is one document (or conversation): its items are gathered, in order, into one row. Groups of more than
``BLOCK`` items are never gathered: their items are compared block by block in tasks of their own, and what the order
of items demands is worked out on the near pairs. Texts are compared by the cosine of their word counts, vectors by
their cosine; null texts count as empty, and empty texts are similar to nothing. Items of one group with equal order
values count once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from siltstone.functions import arrow
from siltstone.io import cut

#: Items of a group that are gathered into one row.
BLOCK = 2048


def _cosines(items: list, dense: bool):
    return arrow.VectorCosines(items) if dense else arrow.TextCosines(items)


def _grouped(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    return df.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("items")).select(group, F.col("items.o").alias("o"), F.col("items.v").alias("v"))


def _is_dense(df: DataFrame, value: str) -> bool:
    return dict(df.dtypes)[value].startswith("array")


def near_dup_flags(df: DataFrame, group: str, order: str, value: str, threshold: float = 0.85, mode: str = "greedy") -> DataFrame:
    """``group, order, kept``: whether an item stays, in order; ``mode`` is ``greedy`` or ``reference``."""
    if mode not in ("greedy", "reference"):
        raise ValueError(mode)
    kinds, dense = dict(df.dtypes), _is_dense(df, value)

    def make():
        def f(groups, orders, values):
            out = [[], [], []]
            for g, o, v in zip(groups, orders, values):
                cos = _cosines(v, dense)
                for x, k in zip(o, arrow.greedy_kept(lambda i: cos.row(i) > threshold, len(o), mode == "reference")):
                    for column, item in zip(out, (g, x, k)):
                        column.append(item)
            return out

        return f

    small, large, sizes = by_size(df.select(group, order, value), group)
    out = arrow.map_rows(_grouped(small, group, order, value), make, f"{group} {kinds[group]}, `{order}` {kinds[order]}, kept boolean")
    if large is None:
        return out
    edges = near_edges(large, sizes, group, order, value, threshold)
    if mode == "greedy":
        removed = greedy_heads(edges).where("head is not null").select(group, F.col("j").alias(order), F.lit(False).alias("kept"))
    else:
        removed = reference_removed(large.select(group, order).distinct(), edges, group, order).withColumn("kept", F.lit(False))
    return out.union(large.select(group, order).distinct().join(removed, [group, order], "left").select(group, order, F.coalesce("kept", F.lit(True)).alias("kept")))


def merge_heads(df: DataFrame, group: str, order: str, value: str, threshold: float = 0.8) -> DataFrame:
    """``group, order, head``: the order value of the item that absorbs each item (itself for heads)."""
    kinds, dense = dict(df.dtypes), _is_dense(df, value)

    def make():
        def f(groups, orders, values):
            out = [[], [], []]
            for g, o, v in zip(groups, orders, values):
                cos = _cosines(v, dense)
                for x, h in zip(o, arrow.star_heads(lambda i: cos.row(i) > threshold, len(o))):
                    for column, item in zip(out, (g, x, o[h])):
                        column.append(item)
            return out

        return f

    small, large, sizes = by_size(df.select(group, order, value), group)
    out = arrow.map_rows(_grouped(small, group, order, value), make, f"{group} {kinds[group]}, `{order}` {kinds[order]}, head {kinds[order]}")
    if large is None:
        return out
    # An item that is near a head that comes before it is absorbed by the first of them, so heads are the greedily kept.
    heads = greedy_heads(near_edges(large, sizes, group, order, value, threshold)).select(group, F.col("j").alias(order), "head")
    return out.union(large.select(group, order).distinct().join(heads, [group, order], "left").select(group, order, F.coalesce("head", order).alias("head")))


# --- groups that are too large to gather ----------------------------------------------------------------------------


def by_size(df: DataFrame, group: str) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Rows of groups of at most ``BLOCK`` items, those of larger groups, and these groups with their number of ``blocks``.

    The rows are read twice, so they are written first, whatever makes them.
    """
    df = cut(df, "items")
    sizes = cut(df.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select(group, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "sizes")
    if sizes.isEmpty():
        return df, None, None
    return df.join(sizes, group, "left_anti"), df.join(sizes.select(group), group, "left_semi"), sizes


def near_edges(df: DataFrame, sizes: DataFrame, group: str, order: str, value: str, threshold: float) -> DataFrame:
    """``group, i, j``: order values (i before j) of near items, as a table. Every pair of blocks is compared in a place of its own."""
    kinds, dense = dict(df.dtypes), _is_dense(df, value)
    block = F.pmod(F.xxhash64(order), F.col("blocks")).cast("int")
    rows = df.select(group, order, value).join(sizes, group).withColumn("b", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(group, F.least("b", "other").alias("x"), F.greatest("b", "other").alias("y"), "b", order, value)
    schema = f"{group} {kinds[group]}, i {kinds[order]}, j {kinds[order]}"
    out = to_arrow_schema(T._parse_datatype_string(schema))

    def compare(batches):
        held: list[tuple] = []
        now = None

        def pairs():
            g, x, y = now
            cos = _cosines([v for _, _, v in held], dense)
            blocks = np.array([b for b, _, _ in held])
            orders = [o for _, o, _ in held]
            found: list[list] = [[], [], []]
            for p in range(len(held)):
                near = cos.row(p) > threshold
                near &= blocks > blocks[p] if x != y else True
                for q in np.flatnonzero(near):
                    if x != y or orders[p] < orders[q]:
                        for column, item in zip(found, (g, min(orders[p], orders[q]), max(orders[p], orders[q]))):
                            column.append(item)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, out)], schema=out)

        for batch in batches:
            for g, x, y, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (g, x, y) != now:
                    if held:
                        yield from pairs()
                    held, now = [], (g, x, y)
                held.append(tuple(row))
        if held:
            yield from pairs()

    found = rows.repartition(group, "x", "y").sortWithinPartitions(group, "x", "y").mapInArrow(compare, schema)
    return cut(found.where("i <> j").distinct(), "near")


def greedy_heads(edges: DataFrame) -> DataFrame:
    """``edges`` of the removed: ``group, j, head`` (the first kept item near it); items without a row stay.

    An item stays if all near items before it are removed. Each round decides all whose near items before are decided; the
    first undecided item of each group always is one of them, so the rounds end.
    """
    group = edges.columns[0]
    kept_edges, open_ = None, edges
    while not open_.isEmpty():
        later = open_.select(group, F.col("j").alias("i")).distinct()
        sure = open_.select(group, "i").distinct().join(later, [group, "i"], "left_anti")
        taken = cut(open_.join(sure, [group, "i"], "left_semi"), "taken")
        gone = taken.select(group, "j").distinct()
        kept_edges = taken if kept_edges is None else kept_edges.union(taken)
        rest = open_.join(sure, [group, "i"], "left_anti").join(gone, [group, "j"], "left_anti").join(gone.withColumnRenamed("j", "i"), [group, "i"], "left_anti")
        open_ = cut(rest, "open")
    if kept_edges is None:
        return edges.limit(0).withColumn("head", F.col("i")).select(group, "j", "head")
    return kept_edges.groupBy(group, "j").agg(F.min("i").alias("head"))


def reference_removed(items: DataFrame, edges: DataFrame, group: str, order: str) -> DataFrame:
    """``group, order`` of the removed by the index rule: item i is compared with the first min(i, kept so far) items.

    Only an item's place and the first place near it are needed; one task a group reads these in order.
    """
    kinds = dict(items.dtypes)
    placed = cut(items.withColumn("at", F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1), "places")
    both = edges.union(edges.select(group, F.col("j").alias("i"), F.col("i").alias("j")))
    first = both.groupBy(group, F.col("i").alias(order)).agg(F.min("j").alias("j")).join(placed.select(group, F.col(order).alias("j"), F.col("at").alias("first")), [group, "j"])
    rows = placed.join(first.select(group, order, "first"), [group, order], "left").select(group, "at", order, "first")
    schema = f"{group} {kinds[group]}, `{order}` {kinds[order]}"
    out = to_arrow_schema(T._parse_datatype_string(schema))

    def scan(batches):
        now, kept, at_first = object(), 0, 0
        for batch in batches:
            found: list[list] = [[], []]
            for g, at, o, first_ in zip(*(c.to_pylist() for c in batch.columns)):
                if g != now:
                    now, kept, at_first = g, 0, at
                if first_ is not None and first_ < min(at - at_first, kept):
                    found[0].append(g)
                    found[1].append(o)
                else:
                    kept += 1
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, out)], schema=out)

    return rows.repartition(group).sortWithinPartitions(group, "at").mapInArrow(scan, schema)


# --- chunks ---------------------------------------------------------------------------------------------------------


def merge_chunks(chunks: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``doc_id, chunk_ix, content``: heads with what they absorb, joined by line breaks."""
    heads = merge_heads(chunks, "doc_id", "chunk_ix", "content", threshold)
    joined = chunks.join(heads, ["doc_id", "chunk_ix"]).groupBy("doc_id", "head").agg(F.array_sort(F.collect_list(F.struct("chunk_ix", "content"))).alias("parts"))
    return joined.select("doc_id", F.col("head").alias("chunk_ix"), F.array_join("parts.content", "\n").alias("content"))


def coherence(chunks: DataFrame, group: str = "doc_id", order: str = "chunk_ix", value: str = "content", top: int = 3, alone: float = 0.0) -> DataFrame:
    """``group, order, coherence``: mean of the ``top`` cosines to the other items of the group; ``alone`` without others."""
    kinds, dense = dict(chunks.dtypes), _is_dense(chunks, value)

    def make():
        def f(groups, orders, values):
            out = [[], [], []]
            for g, o, v in zip(groups, orders, values):
                cos = _cosines(v, dense)
                for i, x in enumerate(o):
                    best = np.sort(np.delete(cos.row(i), i))[::-1][:top]
                    for column, item in zip(out, (g, x, float(best.mean()) if len(best) else alone)):
                        column.append(item)
            return out

        return f

    return arrow.map_rows(_grouped(chunks, group, order, value), make, f"{group} {kinds[group]}, `{order}` {kinds[order]}, coherence double")


def chunk_scores(chunks: DataFrame, density: str = "score", single: float = 0.0) -> DataFrame:
    """Chunks with ``coherence`` and ``relevance`` = 0.6 density + 0.4 coherence; null and NaN densities count as 0.5."""
    d = F.when(F.col(density).isNull() | F.isnan(density), 0.5).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(density))))
    return chunks.join(coherence(chunks, alone=single), ["doc_id", "chunk_ix"]).withColumn("relevance", 0.6 * d + 0.4 * F.col("coherence"))
