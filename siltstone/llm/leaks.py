"""Evaluation texts leaking into training text.

Pigeonhole edit matching: a passage is a run of ``WORDS`` words of a test item, cut into ``errors + 1`` pieces; where it
occurs with at most ``errors`` edits, one of its pieces occurs unchanged. The pieces of all passages form one
Aho-Corasick automaton, each document is scanned once, and around every hit Myers' bit-parallel distance tells the edits
of the whole passage. Documents and items are compared without case, accents, punctuation and spacing.

Runs that stand in several items are told by a distributed count over all items and are no passages. The items go to
the tasks in blocks of at most ``MAX_ITEMS``; every block is compared with all documents.

Null and empty texts match nothing; items shorter than ``WORDS`` words yield no passage; repeated items share their
passages, which then do not count; repeated documents are reported under each of their ids.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.io import cut
from siltstone.llm.common import WORD, map_rows

#: Consecutive words of a passage.
WORDS = 8
#: Items that go to the tasks at a time.
MAX_ITEMS = 200_000
ASCII_DROP = bytes(c for c in range(128) if not chr(c).isalnum())
DROP = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Letters and digits only, without case and accents."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.casefold())
    if text.isascii():
        return text.lower().encode().translate(None, ASCII_DROP).decode()
    return DROP.sub("", text)


def words_of(text: str) -> list[str]:
    t = "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))
    return WORD.findall(t)


def myers(pattern: str, text: str, most: int) -> tuple[int, int]:
    """Least edits of ``pattern`` against a substring of ``text`` and the end of that substring (first of the best)."""
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m + 1, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
            if best == 0:
                break
    return (best, end) if best <= most else (most + 1, 0)


def one_edit_possible(s: str, p: str, a: int, before: int, size: int) -> bool:
    """Pigeonhole once more: one edit leaves a side of the piece unchanged, and of the other side one half."""
    after = before + size
    if s[a + before : a + len(p)] == p[before:] if a + before >= 0 else False:
        half = before // 2
        return a >= 0 and s.startswith(p[half:before], a + half) or s.find(p[:half], max(0, a - 1), max(0, a + 1 + half)) >= 0
    if a >= 0 and s.startswith(p[:after], a):
        half = after + (len(p) - after) // 2
        return s.startswith(p[after:half], a + after) or s.find(p[half:], max(0, a + half - 1), a + len(p) + 1) >= 0
    return False


def runs_of(text: str | None) -> list[str]:
    """The runs of ``WORDS`` words of an item, by their first word, without spaces."""
    w = words_of(text or "")
    return ["".join(w[k : k + WORDS]) for k in range(len(w) - WORDS + 1)]


class Matcher:
    """Passages of the items (``item_id``, text, numbers of the runs that are no passages), their pieces, and the automaton over these."""

    def __init__(self, items: list[tuple[int, str, list[int]]], errors: int):
        if not 0 <= errors < WORDS:
            raise ValueError("the budget must be less than the words of a passage")
        self.errors = errors
        cuts = [WORDS * j // (errors + 1) for j in range(errors + 2)]
        places: dict[str, dict] = defaultdict(dict)
        self.passages: dict[tuple[int, int], str] = {}
        for i, item_text, skip in items:
            w, skipped = words_of(item_text or ""), set(skip or ())
            at = [0]
            for x in w:
                at.append(at[-1] + len(x))
            text = "".join(w)
            for k in range(len(w) - WORDS + 1):
                if k in skipped:
                    continue
                self.passages[i, k] = text[at[k] : at[k + WORDS]]
                for lo, hi in zip(cuts, cuts[1:]):
                    places[text[at[k + lo] : at[k + hi]]][i, k, at[k + lo] - at[k]] = None
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), list(where)))
        if places:
            self.automaton.make_automaton()
        self.any = bool(places)

    def find(self, text: str) -> dict[int, tuple[int, int]]:
        """Of each item found: least edits of a passage, and how many of its passages occur unchanged."""
        if not text or not self.any:
            return {}
        s = fold(text)
        found: dict[int, int] = {}
        tried: set = set()
        exact: dict[int, set] = defaultdict(set)
        e = self.errors
        for end, (size, where) in self.automaton.iter(s):
            for i, k, before in where:
                a = end + 1 - size - before
                if (i, k, a) in tried:
                    continue
                tried.add((i, k, a))
                p = self.passages[i, k]
                if a >= 0 and s.startswith(p, a):  # distance 0
                    exact[i].add(k)
                    found[i] = 0
                elif e and found.get(i, e + 1) > 1:
                    if e == 1 and not one_edit_possible(s, p, a, before, size):
                        continue
                    edits, _ = myers(p, s[max(0, a - e) : a + len(p) + e], e)
                    if edits <= e:
                        found[i] = min(found.get(i, e + 1), edits)
        return {i: (edits, len(exact.get(i, ()))) for i, edits in found.items()}


def with_shared_runs(items: DataFrame) -> DataFrame:
    """``item_id, text, skip``: the items with the numbers of those of their runs that stand in several items."""
    kind = dict(items.dtypes)["item_id"]

    def make():
        def f(batch):
            out = [[], [], []]
            for i, t in zip(*(c.to_pylist() for c in batch.columns)):
                for k, run in enumerate(runs_of(t)):
                    for column, value in zip(out, (i, k, run)):
                        column.append(value)
            return out

        return f

    items = items.select("item_id", "text").where(F.col("text").isNotNull())
    runs = cut(map_rows(items, make, f"item_id {kind}, k int, run string"), "runs")
    shared = runs.groupBy("run").agg(F.min("item_id").alias("one"), F.max("item_id").alias("two")).where("one <> two").select("run")
    skip = runs.join(shared, "run").groupBy("item_id").agg(F.collect_set("k").alias("skip"))
    return items.join(skip, "item_id", "left")


def find_leaks(docs: DataFrame, items: DataFrame, errors: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, item_id, edits, passages``: documents that hold a passage of an item with at most ``errors`` edits.

    ``passages`` counts the passages that occur unchanged (letters and digits compared).
    """
    kind = dict(docs.dtypes)[key]
    schema = f"{key} {kind}, item_id bigint, edits int, passages int"
    ready = cut(with_shared_runs(items), "items")
    blocks = -(-ready.count() // MAX_ITEMS)
    docs = docs.select(key, text).where(F.col(text).isNotNull())

    def block(rows) -> DataFrame:
        def make():
            matcher = Matcher(rows, errors)

            def f(batch):
                out = [[], [], [], []]
                for k, t in zip(*(c.to_pylist() for c in batch.columns)):
                    for i, (edits, n) in matcher.find(t).items():
                        for column, value in zip(out, (k, i, edits, n)):
                            column.append(value)
                return out

            return f

        return map_rows(docs, make, schema)

    found = None
    # Twice as many blocks as are needed, so that no block is too large, whatever the hash deals; with one there is none.
    parts = 1 if blocks <= 1 else 2 * blocks
    for b in range(parts):
        part = ready if parts == 1 else ready.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == b)
        one = block([(r["item_id"], r["text"], r["skip"]) for r in part.collect()])
        found = one if found is None else found.union(cut(one, "block"))
    return found.groupBy(key, "item_id").agg(F.min("edits").alias("edits"), F.max("passages").alias("passages"))


def leaked(docs: DataFrame, items: DataFrame, errors: int = 1) -> DataFrame:
    """``doc_id, item_id`` with at least one whole passage: the found leaks after the exact check."""
    return find_leaks(docs, items, errors).where("passages > 0").select("doc_id", "item_id").distinct()
