"""Per-document text quality statistics and a verdict: prose, list, table or junk.

Every line is observed by a few coarse statistics (how it begins and ends, its length, cells, function words, signs of
garbling); a hidden Markov model with the states prose, list, table and junk labels the lines (Viterbi), and the shares
of the labels give the verdict. Emissions and transitions start from the fixed beliefs below and are re-estimated by
Viterbi training over the lines of all texts: each round is a distributed sum of as many numbers as the model has. What
was counted enters as shares, so the model does not depend on the number of texts, but for collections of few lines,
where the beliefs prevail.

Lines are observed once; training and verdicts work on their codes (two bytes a line).

Null texts yield nothing. Empty and blank texts have no words, shares of zero and the verdict ``junk``. Very long lines
are observed whole. Repeated rows (by key) count once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.io import cut
from siltstone.llm.common import WORD, map_rows
from siltstone.llm.pairs import LANGUAGE_OF

KINDS = ("prose", "list", "table", "junk")
COMMON = frozenset(LANGUAGE_OF)
#: Rounds of training, and the weights of the fixed beliefs and, at most, of what was counted, for each state.
ROUNDS, BELIEF, COUNTED = 2, 400.0, 1000.0
MARK = re.compile(r"\s*(?:[-*•‣◦▪–·]\s|\[[ xX]?\]\s|\(?\d{1,3}[.)]\s|\(?[a-zA-Z]\)\s|\d+(?:\.\d+)+\.?\s)")
LEADER = re.compile(r"(?:\.{4,}|(?: \.){4,}|…{2,}|_{4,})\s*\d+\s*$")
SEPARATOR = re.compile(r"[\s|:+=\-]{3,}$")
GAP = re.compile(r"\S {2,}(?=\S)|\S\t+(?=\S)|\t")
CLOSED = re.compile(r"[.!?…。！？؟।][\"'”’»“」』）)\]]*\s*$")
ENCODED = re.compile(r"[A-Za-z0-9+/=_]{40,}|(?:%[0-9A-Fa-f]{2}){6,}|(?:\\[ux][0-9a-fA-F]{2,4}){4,}|(?:&#?\w+;){6,}")
HEX_DUMP = re.compile(r"\s*(?:[0-9a-fA-F]{4,8}:?\s+)?(?:[0-9a-fA-F]{2,4}\s+){4,}[0-9a-fA-F]{0,4}")
GARBLED = re.compile("[\ufffd\x80-\x9fÃÂÐÑâ¤¥¦¨ª¬\xad¯±²³´µ¶·¸¹º¼½¾]")
_LATIN1 = [chr(c) for c in range(256)]
NOT_LATIN = bytes(c for c in range(256) if not _LATIN1[c].isalpha())
NOT_VOWEL = bytes(c for c in range(256) if _LATIN1[c].lower() not in "aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýÿ")
UNSPACED = re.compile("[฀-๿぀-ヿ㐀-鿿]")


def observe(line: str) -> tuple[int, int, int, int, int, int]:
    """(beginning, cells, length, ending, function words, garbling) of a line, each a small number."""
    s = line.strip()
    words = WORD.findall(s.lower())
    mark = 1 if MARK.match(line) else 2 if s[-1].isdigit() and LEADER.search(s[-120:]) else 0
    bars = s.count("|")
    tight = s.count(";") - s.count("; ") - (s[-1] == ";")
    gaps = line.count("\t") or (len(GAP.findall(s)) if "  " in s else 0)
    if bars >= 2 or tight >= 2 or gaps >= 2 or (bars and SEPARATOR.match(s)):
        cells = 2
    elif bars == 1 or gaps == 1 or tight == 1:
        cells = 1
    else:
        cells = 0
    n = len(words)
    if not s.isascii() and (u := len(UNSPACED.findall(s))):
        n += u // 2
    length = 0 if n < 3 else 1 if n < 9 else 2 if n < 14 else 3
    ending = 0 if CLOSED.search(s[-8:]) else 1 if s[-1] in ";,." else 2 if s[-1] in ":：" else 3
    common = 0
    if words:
        share = sum(w in COMMON for w in words) / len(words)
        common = 0 if share < 0.1 else 1 if share < 0.25 else 2
        if not common and length > 1 and not s.isascii() and sum(map(len, words)) > 2 * len(s.encode("latin-1", "ignore").translate(None, NOT_LATIN)):
            common = 1  # no list of function words for the script
    return mark, cells, length, ending, common, garbled(s, words)


def garbled(s: str, words: list[str]) -> int:
    """0: readable, 1: doubtful, 2: garbled, encoded, random or repeated within the line."""
    size = len(s)
    dense = s.replace(" ", "").replace("\t", "")
    alnum = sum(map(len, words))
    if dense and alnum < 0.5 * len(dense) and not SEPARATOR.fullmatch(s) and not (s[-1].isdigit() and LEADER.search(s[-120:])):
        marks = sum(c in "|;-\t" for c in dense)
        cellular = marks >= 2 and alnum >= 0.5 * max(1, len(dense) - marks) and alnum
        thai = any("ऀ" <= c <= "๿" for c in dense[:40])
        if not cellular and not thai and len(dense) > 5:
            return 2
    if max(map(len, s.split())) >= 18 and ENCODED.search(s):
        return 2
    if size > 12 and HEX_DUMP.match(s) and len(words) >= 6:
        return 2
    if not s.isascii():
        bad = len(GARBLED.findall(s))
        if bad > 3 and bad > 0.08 * size:
            return 2
    n = len(words)
    if n >= 12 and len(set(words)) < 0.2 * n:
        return 2
    if n >= 12 and len(letters := [w for w in words if w.isalpha()]) >= 12 and sum(map(len, letters)) < 2 * len(letters) and letters[0].isascii():
        return 2  # strewn letters
    raw = s.encode("latin-1", "ignore")
    latin = len(raw.translate(None, NOT_LATIN))
    if latin >= 12 and latin > 0.5 * alnum:
        vowels = len(raw.translate(None, NOT_VOWEL)) / latin
        if vowels < 0.2:
            return 2
        if vowels < 0.27 and latin >= 25:
            return 1
        long = max(words, key=len, default="")
        if len(long) > 34 and long.isascii():
            return 2
    return 0


# Fixed beliefs: for each statistic, the share of its values in lines of prose, list, table and junk.
BELIEFS = (
    ((0.96, 0.02, 0.02), (0.48, 0.42, 0.10), (0.96, 0.03, 0.01), (0.90, 0.07, 0.03)),  # beginning: plain, marked, leader
    ((0.965, 0.03, 0.005), (0.94, 0.05, 0.01), (0.02, 0.10, 0.88), (0.50, 0.15, 0.35)),  # cells: none, one, more separators
    ((0.02, 0.12, 0.31, 0.55), (0.35, 0.60, 0.04, 0.01), (0.30, 0.50, 0.18, 0.02), (0.30, 0.25, 0.15, 0.30)),  # words: < 3, < 9, < 14, more
    ((0.66, 0.02, 0.02, 0.30), (0.08, 0.20, 0.04, 0.68), (0.02, 0.06, 0.01, 0.91), (0.10, 0.10, 0.05, 0.75)),  # ending: closed, comma, colon, open
    ((0.13, 0.20, 0.67), (0.55, 0.10, 0.35), (0.95, 0.03, 0.02), (0.85, 0.08, 0.07)),  # function words: few, some, many
    ((0.985, 0.013, 0.002), (0.96, 0.035, 0.005), (0.96, 0.035, 0.005), (0.03, 0.07, 0.90)),  # garbling: none, doubtful, sure
)
START = (0.7, 0.12, 0.1, 0.08)
STAY = 0.9


#: Values of each statistic; a line's code is one number of this mixed base.
BASES = tuple(len(b[0]) for b in BELIEFS)


def code_of(observed: tuple) -> int:
    code = 0
    for value, base in zip(observed, BASES):
        code = code * base + value
    return code


def parts_of(code: int) -> tuple[int, ...]:
    out = []
    for base in reversed(BASES):
        code, value = divmod(code, base)
        out.append(value)
    return tuple(reversed(out))


PARTS = np.array([parts_of(c) for c in range(int(np.prod(BASES)))])


def codes_of(text: str) -> bytes:
    """The codes of all lines that aren't blank, two bytes each."""
    lines = [x for x in text.split("\n") if x.strip()]
    observed = [observe(x) for x in lines]
    # Lines that come again and again say nothing new.
    if len(lines) >= 6 and len({x.strip() for x in lines}) <= 0.34 * len(lines):
        observed = [(*o[:5], 2) for o in observed]
    return np.array([code_of(o) for o in observed], np.uint16).tobytes()


class LineModel:
    """The hidden Markov model; ``emissions`` (by statistic) and ``go`` (transitions) are shares like ``BELIEFS``."""

    def __init__(self, emissions: list | None = None, go: list | None = None):
        self.emissions = [np.array(b) for b in emissions or BELIEFS]
        if go is None:
            go = np.full((4, 4), (1 - STAY) / 3)
            np.fill_diagonal(go, STAY)
        self.shares = np.array(go)
        self.go, self.start = np.log(self.shares).tolist(), np.log(START).tolist()
        self.emit = sum(np.log(e)[:, PARTS[:, k]] for k, e in enumerate(self.emissions)).T.tolist()
        self.path = lru_cache(100_000)(self._path)

    def _path(self, codes: bytes) -> bytes:
        """The labels of lines with ``codes``, a byte each."""
        codes = np.frombuffer(codes, np.uint16).tolist()
        if not codes:
            return b""
        score = [s + e for s, e in zip(self.start, self.emit[codes[0]])]
        back = []
        for code in codes[1:]:
            emit, new, came = self.emit[code], [], []
            for k in range(4):
                j = max(range(4), key=lambda j: score[j] + self.go[j][k])
                came.append(j)
                new.append(score[j] + self.go[j][k] + emit[k])
            back.append(came)
            score = new
        k = max(range(4), key=score.__getitem__)
        out = [k]
        for came in reversed(back):
            k = came[k]
            out.append(k)
        return bytes(reversed(out))

    def verdict(self, codes: bytes) -> tuple[list[float], str]:
        """Shares of the labels among the lines, and the verdict."""
        labels = self.path(codes)
        if not labels:
            return [0.0] * 4, "junk"
        n = [labels.count(k) for k in range(4)]
        total = len(labels)
        kind = max(range(1, 4), key=n.__getitem__)
        # One or two entries behind prose leave it prose; one line of introduction leaves a list a list.
        other = n[kind] >= 3 and n[kind] > 1.5 * n[0] or n[0] == 0 or kind == 3 and n[3] > n[0]
        return [x / total for x in n], KINDS[kind] if other else "prose"

    def judge(self, text: str) -> tuple[list[float], str]:
        return self.verdict(codes_of(text))


def statistics(text: str) -> tuple[int, float, float, float, float]:
    """Words, mean word length, share of symbols among characters that aren't space, of closed lines, of common words."""
    words = WORD.findall(text.lower())
    letters = sum(map(len, words))
    dense = len("".join(text.split()))
    lines = [x for x in text.split("\n") if x.strip()]
    n = len(words)
    return (
        n,
        letters / n if n else 0.0,
        max(0, dense - letters) / dense if dense else 0.0,
        sum(1 for x in lines if CLOSED.search(x.rstrip()[-8:])) / len(lines) if lines else 0.0,
        sum(w in COMMON for w in words) / n if n else 0.0,
    )


def observed(texts: DataFrame, keys: list[str], text: str = "text", stats: bool = False) -> DataFrame:
    """``keys, codes`` and, if asked for, the statistics of every text that isn't null, a row a key, as a table."""
    kinds = dict(texts.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", codes binary"
    numbers = ", word_count int, mean_word_length double, symbol_share double, closed_line_share double, common_word_share double" if stats else ""

    def make():
        def f(batch):
            columns = [c.to_pylist() for c in batch.columns]
            counted = list(zip(*map(statistics, columns[-1]))) if stats else []
            return [*columns[:-1], [codes_of(t) for t in columns[-1]], *counted]

        return f

    return cut(map_rows(texts.select(*keys, text).where(F.col(text).isNotNull()), make, schema + numbers).dropDuplicates(keys), "observed")


def numbers(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and the five statistics of every text that isn't null, a row a key, rounded to six places."""
    rows = observed(texts, keys, text, stats=True).drop("codes")
    return rows.select(*[F.round(c, 6).alias(c) if c.endswith(("length", "share")) else c for c in rows.columns])


def trained(codes: DataFrame, rounds: int = ROUNDS) -> LineModel:
    """The model after Viterbi training over all rows of ``codes``: the lines are labelled, and what is observed under each label counted."""
    model = LineModel()
    for _ in range(rounds):
        model = reestimated(model, codes)
    return model


def reestimated(model: LineModel, codes: DataFrame) -> LineModel:
    emissions, go = [e.tolist() for e in model.emissions], model.shares.tolist()

    def make():
        now = LineModel(emissions, go)
        seen, steps = np.zeros((4, len(PARTS)), np.int64), np.zeros((4, 4), np.int64)

        def f(batch):
            for c in batch.column(0).to_pylist():
                labels = np.frombuffer(now.path(c), np.uint8)
                np.add.at(seen, (labels, np.frombuffer(c, np.uint16)), 1)
                np.add.at(steps, (labels[:-1], labels[1:]), 1)

        def rest():
            k, v = np.nonzero(seen)
            i, j = np.nonzero(steps)
            return [0] * len(k) + [1] * len(i), [*k, *i], [*v, *j], [*seen[k, v], *steps[i, j]]

        return f, rest

    rows = map_rows(codes.select("codes"), make, "what int, k int, v int, n bigint").groupBy("what", "k", "v").agg(F.sum("n").alias("n")).collect()
    seen, steps = np.zeros((4, len(PARTS))), np.zeros((4, 4))
    for r in rows:
        (steps if r["what"] else seen)[r["k"], r["v"]] += r["n"]

    def mixed(belief: np.ndarray, counts: np.ndarray) -> list:
        """The belief and the counted shares, row by row, by their weights."""
        n = counts.sum(1, keepdims=True)
        weight = COUNTED * n / (n + BELIEF)
        return ((BELIEF * belief + weight * counts / np.maximum(n, 1)) / (BELIEF + weight)).tolist()

    of = lambda k, size: np.stack([seen[:, PARTS[:, k] == v].sum(1) for v in range(size)], 1)
    return LineModel([mixed(np.array(b), of(k, len(b[0]))) for k, b in enumerate(BELIEFS)], mixed(LineModel().shares, steps))


def verdicts(texts: DataFrame, keys: list[str], text: str = "text", stats: bool = True, train: bool = True) -> DataFrame:
    """``keys``, the statistics (if ``stats``), label shares and ``kind`` of every text that isn't null, a row a key."""
    rows = observed(texts, keys, text, stats)
    model = trained(rows) if train else LineModel()
    emissions, go = [e.tolist() for e in model.emissions], model.shares.tolist()
    kept = [c for c in rows.columns if c != "codes"]
    kinds = dict(rows.dtypes)

    def make():
        now = LineModel(emissions, go)

        def f(batch):
            found = [now.verdict(c) for c in batch.column(len(kept)).to_pylist()]
            return [*batch.columns[: len(kept)], *zip(*(shares for shares, _ in found)), [kind for _, kind in found]]

        return f

    schema = ", ".join(f"{k} {kinds[k]}" for k in kept)
    return map_rows(rows.select(*kept, "codes"), make, f"{schema}, prose_share double, list_share double, table_share double, junk_share double, kind string")
