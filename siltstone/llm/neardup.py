"""Near-duplicate records: groups of question-answer pairs whose sets of words share at least 0.8 of their union.

Records of one set of words are collapsed first. Every set gets a fingerprint, a bitmap in which each word sets one
bit, and its Hamming distances to ``PIVOTS`` fixed reference fingerprints. Two sets that are similar enough differ in
at most (|A| + |B|) (1 - s) / (1 + s) words, so their fingerprints, and by the triangle inequality all their pivot
distances, differ by no more: candidates whose largest coordinate difference exceeds this are discarded, survivors are
verified on the words themselves.

Candidates come from keys that both sets must share:

* words in at most ``RARE`` sets, as far as the prefix filter needs them: the first |A| - ceil(s |A|) + 1 words in order
  of frequency. Frequencies are counted over all sets in a table with a cell or more for each set (at most 2^24 cells),
  whose counts are never too low;
* sets that share no rare word differ in all of theirs, so at most ``left`` differences remain for their frequent words.
  These are dealt by hash into parts of four; if there are parts enough, one of them holds at most two differences, so
  two of its four quarters are equal, and all six ways to choose them are keys. A key then stands for as many words at
  every size of the collection. Sets have keys for all numbers of parts up to their own; two sets are compared where
  that number is the least they need. Sets of less than eight words have one part, and keys for three of its quarters.

No pair is lost, whatever the words. Keys shared by more than ``BLOCK`` sets are spread over tasks by blocks of sets,
most of them already in the shuffle (they are found by the keys of every 64th set), the rest behind it.

Nulls count as empty texts; sets without words have no partners. Repeated rows count once.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.io import cut
from siltstone.llm.common import WORD, map_rows
from siltstone.llm.splits import connected_components

SIMILARITY = 0.8
#: Words in at most so many sets are rare.
RARE = 128
BITS, PIVOTS = 256, 16
#: By bit and pivot: whether a bit of a record adds to or takes from its distance to the pivot.
_PIVOT_BITS = np.random.default_rng(7).integers(0, 2, (BITS, PIVOTS))
#: Sets whose keys tell which ones are hot: one of so many.
HOT_SHARE = 64


class Ids(dict):
    """32-bit hashes of words, kept for the words seen."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return h


def word_sets(records: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key, sig, words``: the sorted 32-bit hashes of the distinct words of ``columns``, and a hash of them."""
    kind = dict(records.dtypes)[key]

    def make():
        ids = Ids()

        def f(batch):
            keys, *texts = (c.to_pylist() for c in batch.columns)
            sigs, sets = [], []
            for parts in zip(*texts):
                text = " ".join(p for p in parts if p).lower()
                words = np.array(sorted({ids[w] for w in set(WORD.findall(text))}), np.uint32).tobytes()
                sets.append(words)
                sigs.append(int.from_bytes(hashlib.blake2b(words, digest_size=8).digest(), "little", signed=True))
            return keys, sigs, sets

        return f

    return map_rows(records.select(key, *columns), make, f"{key} {kind}, sig bigint, words binary")


def frequencies(sets: DataFrame) -> bytes:
    """For each cell of hashed words, the logarithm of its count over all sets, and 255 beyond ``RARE``.

    The cells (one byte each) are as many as the next power of two behind eight times the sets, from 2^16 to 2^24.
    """
    cells = 1 << min(24, max(16, (8 * sets.count()).bit_length()))

    def make():
        total = np.zeros(cells, np.int64)

        def f(batch):
            words = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32)
            at, n = np.unique(words % np.uint32(cells), return_counts=True)
            total[at] += n

        def rest():
            at = np.flatnonzero(total)
            return at, total[at]

        return f, rest

    total = np.zeros(cells, np.int64)
    sums = map_rows(sets.select("words"), make, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    level = np.minimum(254, np.ceil(16 * np.log2(np.maximum(total, 1))))
    return np.where(total > RARE, 255, level).astype(np.uint8).tobytes()


def pivot_distances(rows: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Hamming distances (n sets × pivots) of the fingerprints to the pivots, at most 255."""
    bit = ((words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.int64)
    at = np.unique(rows * BITS + bit)
    r, b = at // BITS, at % BITS
    out = np.empty((n, PIVOTS), np.int64)
    for k in range(PIVOTS):
        ones = _PIVOT_BITS[:, k]
        out[:, k] = ones.sum() + np.bincount(r, weights=1 - 2 * ones[b], minlength=n)
    return np.clip(out, 0, 255)


def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Numbers of parts, and how many differences each bears: some part has at most two.
PARTS = [1, 2, 3, *sorted(n << k for n in (2, 3) for k in range(1, 31))]
BEARS = np.array([3 * n - 1 for n in PARTS])
PAIRS_OF_QUARTERS, TRIPLES_OF_QUARTERS = tuple(combinations(range(4), 2)), tuple(combinations(range(4), 3))
#: Sets of fewer words have keys for three quarters of one part, which bear one difference; sets up to SMALL words meet them there.
FEW, SMALL = 8, 8


def keys_of(words: np.ndarray, rows: np.ndarray, size: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys by which sets meet all their partners: (key, row, whether pairs of which this is one are compared here).

    ``words`` of all sets one behind the other, ``rows`` their sets' numbers, ``size`` the sets' sizes.
    """
    n = len(size)
    rank = level[words % np.uint32(len(level))]
    rare = rank < 255
    prefix = size - np.ceil(SIMILARITY * size - 1e-9).astype(np.int64) + 1
    w, r, k = words[rare], rows[rare], rank[rare]
    order = np.lexsort((w, k, r))
    w, r = w[order], r[order]
    count = np.bincount(r, minlength=n)
    place = np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)
    first = place < prefix[r]
    keys, at, meets = [w[first].astype(np.int64)], [r[first]], [np.ones(int(first.sum()), bool)]
    # Of all partners, the largest difference that is left for frequent words if no rare word is shared.
    left = np.floor(size * (1 / SIMILARITY - 1) + 1e-9).astype(np.int64) - count
    open_ = (left >= 0) & (size >= 4)
    top = np.where(size < FEW, -1, np.searchsorted(BEARS, np.maximum(left, 0)))
    w, r = words[~rare].astype(np.uint64), rows[~rare]
    value = mixed(w + np.uint64(0x9E3779B97F4A7C15))
    spread = mixed(value)

    def of_level(index: int, parts: int, chosen: tuple, some: np.ndarray) -> None:
        ids = np.flatnonzero(some)
        if not len(ids):
            return
        number = np.full(n, -1)
        number[ids] = np.arange(len(ids))
        here = number[r] >= 0
        cell = (number[r[here]] * parts + (spread[here] >> np.uint64(8)).astype(np.int64) % parts) * 4 + (spread[here] & np.uint64(3)).astype(np.int64)
        sums = np.zeros(len(ids) * parts * 4, np.uint64)
        np.add.at(sums, cell, value[here])
        sums = sums.reshape(len(ids) * parts, 4)
        for c, quarters in enumerate(chosen):
            tag = mixed(np.uint64(c) + (np.uint64(8) * np.arange(parts, dtype=np.uint64)) + np.uint64(index + 2) * np.uint64(1 << 40))
            total = sums[:, list(quarters)].sum(1, dtype=np.uint64).reshape(len(ids), parts) + tag
            keys.append((mixed(total).view(np.int64) | np.int64(1 << 62)).ravel())
            at.append(np.repeat(ids, parts))
            meets.append(np.repeat(top[ids] == index, parts))

    of_level(-1, 1, TRIPLES_OF_QUARTERS, open_ & (size <= SMALL))
    for index in range(int(top[open_].max(initial=-1)) + 1):
        of_level(index, PARTS[index], PAIRS_OF_QUARTERS, open_ & (top >= index))
    return np.concatenate(keys), np.concatenate(at), np.concatenate(meets)


def keyed(sets: DataFrame, level: bytes) -> DataFrame:
    """``key, sig, n, p0, p1``: each set under all its keys, with its pivot distances in the bytes of two numbers.

    ``n`` is twice the size, plus one where pairs of the set are compared.
    """

    def make():
        levels = np.frombuffer(level, np.uint8)

        def f(batch):
            sigs, raw = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            size = np.array([len(w) // 4 for w in raw])
            words, rows = np.frombuffer(b"".join(raw), np.uint32), np.repeat(np.arange(len(raw)), size)
            packed = pivot_distances(rows, words, len(raw)).astype(np.uint8)
            p0, p1 = packed[:, :8].copy().view("<i8")[:, 0], packed[:, 8:].copy().view("<i8")[:, 0]
            keys, at, meets = keys_of(words, rows, size, levels)
            return keys, sigs[at], 2 * size[at] + meets, p0[at], p1[at]

        return f

    return map_rows(sets.where(F.length("words") > 0).select("sig", "words"), make, "key bigint, sig bigint, n int, p0 bigint, p1 bigint")


def near_rows(i: np.ndarray, j: np.ndarray, n: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Which of the row pairs (i, j) may be similar enough, by sizes and by the largest difference of pivot distances."""
    ok = np.flatnonzero((n[i] | n[j]) & 1)
    a, b = n[i[ok]] >> 1, n[j[ok]] >> 1
    ok = ok[np.minimum(a, b) >= SIMILARITY * np.maximum(a, b) - 1e-9]
    most = ((n[i[ok]] >> 1) + (n[j[ok]] >> 1)) * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-9
    for lo, hi in ((0, 4), (4, PIVOTS)):
        near = np.abs(pivots[i[ok], lo:hi] - pivots[j[ok], lo:hi]).max(1) <= most
        ok, most = ok[near], most[near]
    return ok


def pairs_within(group: np.ndarray, sig: np.ndarray, n: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates among rows sorted by group: rows one, two, … places apart while their groups are equal."""
    out_a, out_b = [], []
    i = np.flatnonzero(group[:-1] == group[1:]) if len(group) > 1 else np.zeros(0, np.int64)
    d = 1
    while len(i):
        for k in range(0, len(i), 200_000):
            x = i[k : k + 200_000]
            x = x[near_rows(x, x + d, n, pivots)]
            out_a.append(sig[x])
            out_b.append(sig[x + d])
        d += 1
        i = i[i + d < len(group)]
        i = i[group[i] == group[i + d]]
    if not out_a:
        return sig[:0], sig[:0]
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    return np.minimum(a, b), np.maximum(a, b)


#: Rows of one key that are compared within a task; larger keys are compared block by block, in as many tasks.
BLOCK = 4096


def _pivots(p0: np.ndarray, p1: np.ndarray) -> np.ndarray:
    return np.hstack([np.ascontiguousarray(p).view(np.uint8).reshape(-1, 8) for p in (p0, p1)]).astype(np.int16)


_OUT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("sig", pa.int64()), ("n", pa.int32()), ("p0", pa.int64()), ("p1", pa.int64()), ("block", pa.int32())])


def compare_sorted(batches):
    """Over rows sorted by key: candidates (``a``, ``b``), and the rows of keys larger than ``BLOCK`` with block numbers."""
    held, rows, hot_key, hot_rows = [], 0, None, 0

    def batch_of(**columns):
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _OUT], schema=_OUT)

    def process(last: bool):
        """Compare all complete keys of what is held; keep the rows of the last key unless it is the last batch."""
        nonlocal held, rows, hot_key, hot_rows
        key, sig, n, p0, p1 = (np.concatenate(c) for c in zip(*held))
        start = 0
        if hot_key is not None:  # more rows of a key that is already too large
            stop = int(np.searchsorted(key, hot_key, "right")) if key[0] == hot_key else 0
            if stop:
                yield batch_of(key=key[:stop], sig=sig[:stop], n=n[:stop], p0=p0[:stop], p1=p1[:stop], block=(hot_rows + np.arange(stop)) // BLOCK)
                hot_rows += stop
            start = stop
            if stop < len(key):
                hot_key = None
        end = len(key) if last else max(start, int(np.searchsorted(key, key[-1], "left")))
        if end > start:
            cuts = np.flatnonzero(np.diff(key[start:end])) + 1 + start
            edges = np.concatenate([[start], cuts, [end]])
            size = np.diff(edges)
            big = np.flatnonzero(size > BLOCK)
            keep = np.ones(end - start, bool)
            for k in big:
                x = slice(edges[k], edges[k + 1])
                keep[x.start - start : x.stop - start] = False
                yield batch_of(key=key[x], sig=sig[x], n=n[x], p0=p0[x], p1=p1[x], block=np.arange(size[k]) // BLOCK)
            at = np.flatnonzero(keep) + start
            a, b = pairs_within(key[at], sig[at], n[at], _pivots(p0[at], p1[at]))
            for k in range(0, len(a), 50_000):
                yield batch_of(a=a[k : k + 50_000], b=b[k : k + 50_000])
        tail = len(key) - end
        if tail > BLOCK and not last and hot_key is None:
            hot_key, hot_rows = key[-1], tail
            yield batch_of(key=key[end:], sig=sig[end:], n=n[end:], p0=p0[end:], p1=p1[end:], block=np.arange(tail) // BLOCK)
            tail = 0
        held = [(key[len(key) - tail :], sig[len(key) - tail :], n[len(key) - tail :], p0[len(key) - tail :], p1[len(key) - tail :])] if tail else []
        rows = tail

    for batch in batches:
        held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        rows += batch.num_rows
        if rows > 65_536:
            yield from process(False)
    if rows:
        yield from process(True)


def compare_blocks(batches):
    """Over rows sorted by (key, x, y) with ``block`` x or y: candidates between the two blocks, or within one."""
    held: list = []
    now = None

    def flush():
        block, sig, n, p0, p1 = (np.concatenate(c) for c in zip(*held))
        piv = _pivots(p0, p1)
        left, right = np.flatnonzero(block == now[1]), np.flatnonzero(block == now[2])
        for i in left:
            j = right[right > i] if now[1] == now[2] else right
            ok = near_rows(np.full(len(j), i), j, n, piv)
            if len(ok):
                a, b = np.full(len(ok), sig[i]), sig[j[ok]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    for batch in batches:
        key, x, y, *rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        change = np.flatnonzero((np.diff(key) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)) + 1
        for lo, hi in zip([0, *change], [*change, len(key)]):
            this = (key[lo], x[lo], y[lo])
            if this != now:
                if held:
                    yield from flush()
                held, now = [], this
            held.append(tuple(c[lo:hi] for c in rest))
    if held:
        yield from flush()


def by_blocks(hot: DataFrame, most: DataFrame) -> DataFrame:
    """Candidates of rows with their ``block``; ``most`` has the last block of each key. Every pair of blocks is a group of its own."""
    spread = hot.join(most, "key").withColumn("other", F.explode(F.sequence(F.lit(0), "most")))
    spread = spread.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "sig", "n", "p0", "p1")
    return spread.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(compare_blocks, "a bigint, b bigint")


def candidates(sets: DataFrame, level: bytes) -> DataFrame:
    """``a, b`` (``a`` < ``b``): different sets under one key whose sizes and pivot distances allow the similarity."""
    rows = keyed(sets, level)
    some = keyed(sets.where(F.pmod("sig", F.lit(HOT_SHARE)) == 0), level)
    known = cut(some.groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") * HOT_SHARE > BLOCK).select("key", F.ceil(F.col("k") * HOT_SHARE / BLOCK).cast("int").alias("most")), "hot")
    pairs = []
    if not known.isEmpty():
        # Keys known to be hot are spread by blocks at once, so no task gets all rows of one.
        rows = cut(rows.join(known, "key", "left"), "keyed")
        hot = rows.where("most is not null").withColumn("block", F.pmod(F.xxhash64("sig"), F.col("most") + 1).cast("int")).drop("most")
        pairs.append(by_blocks(hot, known))
        rows = rows.where("most is null").drop("most")
    found = cut(rows.repartition("key").sortWithinPartitions("key").mapInArrow(compare_sorted, "a bigint, b bigint, key bigint, sig bigint, n int, p0 bigint, p1 bigint, block int"), "compared")
    pairs.append(found.where("a is not null").select("a", "b"))
    hot = found.where("key is not null").select("key", "sig", "n", "p0", "p1", "block")
    if not hot.isEmpty():
        pairs.append(by_blocks(hot, hot.groupBy("key").agg(F.max("block").alias("most"))))
    out = pairs[0]
    for p in pairs[1:]:
        out = out.union(p)
    return out.where("a < b").distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) of sets that share at least ``SIMILARITY`` of their union."""
    used = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()
    words = cut(sets.join(used, "sig", "left_semi"), "candidates")
    both = pairs.join(words.select(F.col("sig").alias("a"), F.col("words").alias("wa")), "a").join(words.select(F.col("sig").alias("b"), F.col("words").alias("wb")), "b")

    def make():
        def f(batch):
            out_a, out_b = [], []
            for a, b, wa, wb in zip(*(c.to_pylist() for c in batch.columns)):
                shared = len(np.intersect1d(np.frombuffer(wa, np.uint32), np.frombuffer(wb, np.uint32), assume_unique=True))
                if shared * 5 >= 4 * ((len(wa) + len(wb)) // 4 - shared) if SIMILARITY == 0.8 else shared >= SIMILARITY * ((len(wa) + len(wb)) / 4 - shared):
                    out_a.append(a)
                    out_b.append(b)
            return out_a, out_b

        return f

    return map_rows(both.select("a", "b", "wa", "wb"), make, "a bigint, b bigint")


def similar_sets(records: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Members (``key, sig``) and links between different sets (``a, b``), both tables."""
    all_sets = word_sets(records, key, columns)
    members = cut(all_sets.select(key, "sig").distinct(), "members")
    sets = cut(all_sets.groupBy("sig").agg(F.first("words").alias("words")), "sets")
    pairs = cut(candidates(sets, frequencies(sets)), "pairs")
    return members, cut(verified(pairs, sets), "links")


def near_pairs(records: DataFrame, key: str = "pair_id", columns: tuple[str, ...] = ("question", "answer")) -> DataFrame:
    """``<key>_a, <key>_b``: all pairs of different records that are near copies, smaller first."""
    members, links = similar_sets(records, key, list(columns))
    one, two = members.select(F.col("sig").alias("a"), F.col(key).alias("x")), members.select(F.col("sig").alias("b"), F.col(key).alias("y"))
    empty = int.from_bytes(hashlib.blake2b(b"", digest_size=8).digest(), "little", signed=True)
    equal = one.where(F.col("a") != empty).join(two, (F.col("a") == F.col("b")) & (F.col("x") < F.col("y"))).select("x", "y")
    near = links.join(one, "a").join(two, "b").where("x <> y").select("x", "y")
    return equal.union(near).select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b")).distinct()


def near_groups(records: DataFrame, key: str = "pair_id", columns: tuple[str, ...] = ("question", "answer")) -> DataFrame:
    """A row a record: ``key, group, copies, links``.

    ``group`` joins everything linked; ``copies`` counts the records of the same set of words, ``links`` the other
    sets it is linked with. Copies are not expanded into pairs.
    """
    members, links = similar_sets(records, key, list(columns))
    both = links.select(F.col("a").alias("sig")).union(links.select(F.col("b").alias("sig"))).groupBy("sig").agg(F.count("*").alias("links"))
    groups = connected_components(links).select(F.col("node").alias("sig"), F.col("component").alias("group"))
    copies = members.groupBy("sig").agg(F.count("*").alias("copies"))
    info = copies.join(both, "sig", "left").join(groups, "sig", "left").select("sig", F.coalesce("group", "sig").alias("group"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
    return members.join(info, "sig").select(key, "group", "copies", "links")
