"""Splits that keep related records together.

Spellings of a file are linked to a canonical key; a distributed union-find (forests local to a partition, merged in
levels, then contracted by minima until stable) gives the groups; whole groups go, largest first, to the split
furthest below its target.

Null and empty keys form groups of one record each. Repeated rows count once (callers drop them by record id). Ties
between groups of one size are broken by a hash of the group, so the result does not depend on partitioning.
"""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.io import cut
from siltstone.llm.common import map_rows

SCHEME = re.compile(r"file:(?://(?:localhost(?=/))?)?", re.I)
PLACE_QUERY = re.compile(r"\?(?:page|p|line|l|sheet|slide|section|pos|t)=?\w*$", re.I)
#: Nodes that one local forest holds before it is sent on and begun anew; bounds a task's memory.
FOREST_NODES = 1_000_000
#: Buckets in which groups of one size are ranked, so that a size shared by most groups is not one task.
RANK_BUCKETS = 256


def canonical_path(spelling: str) -> str:
    """One key for all spellings of a file: case, space, encodings, path steps and places inside do not matter."""
    s = unicodedata.normalize("NFKC", spelling).strip("﻿​ \t\r\n\f\v ")
    s = PLACE_QUERY.sub("", s.partition("#")[0].rstrip())
    if "%" in s:
        s = unicodedata.normalize("NFKC", unquote(s))
    s = SCHEME.sub("", s.strip(), count=1).replace("\\", "/")
    steps: list[str] = []
    for step in s.split("/"):
        step = step.strip()
        if step == ".." and steps and steps[-1] != "..":
            steps.pop()
        elif step not in ("", "."):
            steps.append(step)
    return unicodedata.normalize("NFKC", "/".join(steps).casefold())


def forest(batches):
    """Union-find over the edges of one partition: every node but the roots, with its root (the least node)."""
    parent: dict = {}

    def find(x):
        root = x
        while (p := parent.get(root, root)) != root:
            root = p
        while (p := parent.get(x, x)) != root and x != root:
            parent[x] = root
            x = p
        return root

    def grown():
        nodes = [x for x in parent if find(x) != x]
        for i in range(0, len(nodes), 10_000):
            part = nodes[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                low, high = (ra, rb) if ra < rb else (rb, ra)
                parent[high] = low
                parent.setdefault(low, low)
        if len(parent) > FOREST_NODES:
            yield from grown()
            parent.clear()
    yield from grown()


def connected_components(edges: DataFrame, levels: int = 2, fan_in: int = 4, max_rounds: int = 40) -> DataFrame:
    """``node, component`` (the least node) for the ends of ``edges`` (``a``, ``b`` bigint).

    Forests of single partitions first, then of ``fan_in`` merged partitions, ``levels`` times: each level leaves at
    most one edge a node and forest. What spans more partitions is contracted by joins with the least neighbour,
    which never gathers the neighbours of a node; each round shortens all chains by half, and components that have not
    settled in ``max_rounds`` raise. ``edges`` should be a table read, so that its partitions are known.
    """
    partitions = edges.rdd.getNumPartitions()
    self_loops = edges.where("a = b").select("a").distinct()
    e = edges.where("a <> b").mapInArrow(forest, "a bigint, b bigint")
    for _ in range(levels):
        partitions = max(1, partitions // fan_in)
        e = e.coalesce(partitions).mapInArrow(forest, "a bigint, b bigint")
    e = cut(e, "forest")
    for done in range(max_rounds + 1):
        # Stable when every node hangs on exactly one root, and no root hangs on anything.
        per_node = e.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("x"))
        loose = per_node.where("m <> x").select("a").union(per_node.join(e.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a"))
        if loose.isEmpty():
            break
        if done == max_rounds:
            raise RuntimeError(f"components have not settled in {max_rounds} rounds")
        least = per_node.select("a", "m")
        # Large and small star: each child hangs on its least parent, other parents hang on it, roots are followed once.
        linked = e.join(least, "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b")))
        up = least.select(F.col("a").alias("p"), F.col("m").alias("top"))
        jumped = linked.join(up, linked.b == up.p, "left").select(linked.a, F.coalesce("top", "b").alias("b")).where("a <> b").union(linked.join(up, linked.b == up.p).select(F.col("b").alias("a"), F.col("top").alias("b"))).distinct()
        e = cut(jumped.mapInArrow(forest, "a bigint, b bigint"), "star")
    found = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    alone = self_loops.select(F.col("a").alias("node"), F.col("a").alias("component")).join(found.select("node").union(roots.select("node")), "node", "left_anti")
    return found.union(roots).union(alone)


def same_file(sources: DataFrame) -> DataFrame:
    """``source, component`` for the distinct non-null spellings of ``sources``."""
    spellings = sources.select("source").where(F.col("source").isNotNull()).distinct()

    def make():
        def f(batch):
            names = batch.column(0).to_pylist()
            return names, [canonical_path(s) for s in names]

        return f

    keyed = map_rows(spellings, make, "source string, file string").select("source", F.xxhash64(F.lit("spelling"), "source").alias("a"), F.xxhash64(F.lit("file"), "file").alias("b"))
    nodes = cut(keyed, "spellings")
    return nodes.join(connected_components(nodes.select("a", "b")), F.col("a") == F.col("node")).select("source", "component")


def greedy_counts(classes: list[tuple[int, int]], shares: list[float]) -> list[tuple[int, list[int]]]:
    """For each (group size, number of such groups), largest first: how many go to each split.

    Equal to giving one group after another to the split furthest below target; many groups of one size are poured
    in at once to a common level and only the last few one by one.
    """
    total = sum(size * n for size, n in classes)
    missing = [share * total for share in shares]
    out = []
    for size, n in sorted(classes, reverse=True):
        counts = [0] * len(shares)
        left = n
        if left > 4 * len(shares):
            order = sorted(range(len(shares)), key=lambda k: -missing[k])
            for used in range(len(order), 0, -1):
                level = (sum(missing[k] for k in order[:used]) - left * size) / used
                if used == 1 or missing[order[used - 1]] > level:
                    break
            for k in order[:used]:
                counts[k] = max(0, min(left, int((missing[k] - level) // size)))
                left -= counts[k]
                missing[k] -= counts[k] * size
        for _ in range(left):
            k = max(range(len(shares)), key=lambda k: (missing[k], -k))
            counts[k] += 1
            missing[k] -= size
        out.append((size, counts))
    return out


def assign_splits(groups: DataFrame, shares: dict[str, float]) -> DataFrame:
    """``component, split`` for groups (``component`` bigint, ``size`` bigint), largest first.

    The driver sees one number a distinct group size (fewer than the square root of twice the records).
    """
    spark = groups.sparkSession
    names = sorted(shares)
    classes = [(r["size"], r["n"]) for r in groups.groupBy("size").agg(F.count("*").alias("n")).collect()]
    ranges = []
    for size, counts in greedy_counts(classes, [shares[k] for k in names]):
        at = 0
        for name, n in zip(names, counts):
            if n:
                ranges.append((size, name, at, at + n))
            at += n
    plan = spark.createDataFrame(ranges, "size bigint, split string, lo bigint, hi bigint")
    g = groups.withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(RANK_BUCKETS)))
    offsets = g.groupBy("size", "bucket").agg(F.count("*").alias("n"))
    offsets = offsets.select("size", "bucket", (F.sum("n").over(Window.partitionBy("size").orderBy("bucket")) - F.col("n")).alias("before"))
    ranked = g.join(offsets, ["size", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("size", "bucket").orderBy("component")) - 1)
    return ranked.join(plan, (ranked["size"] == plan["size"]) & (ranked["rank"] >= plan["lo"]) & (ranked["rank"] < plan["hi"])).select("component", "split")


def split_records(records: DataFrame, shares: DataFrame, key: str = "pair_id") -> DataFrame:
    """``key, source, split`` for every record; records whose ``source`` denotes one file share a split."""
    rows = cut(records.select(key, "source").groupBy(key).agg(F.min("source").alias("source")), "records")
    files = cut(same_file(rows), "files")
    named, single = rows.where(F.col("source").isNotNull()), rows.where(F.col("source").isNull()).withColumn("component", F.xxhash64(F.lit("record"), key))
    # Records are counted by source before files are joined, and meet their split through a table with a row a source.
    sized = named.groupBy("source").agg(F.count("*").alias("n")).join(files, "source").groupBy("component").agg(F.sum("n").alias("size"))
    groups = cut(sized.union(single.select("component", F.lit(1).cast("bigint").alias("size"))), "groups")
    dealt = cut(assign_splits(groups, {r["split"]: float(r["share"]) for r in shares.collect()}), "dealt")
    by_source = files.join(dealt, "component").select("source", "split")
    return named.join(by_source, "source").select(key, "source", "split").union(single.join(dealt, "component").select(key, "source", "split"))


def spelling_pairs(records: DataFrame) -> DataFrame:
    """``source_a, source_b``: different spellings of one file, smaller first by code point."""
    files = cut(same_file(records), "files")
    a, b = files.select(F.col("source").alias("source_a"), "component"), files.select(F.col("source").alias("source_b"), "component")
    return a.join(b, "component").where("source_a < source_b").select("source_a", "source_b")
