"""Arrow-batched functions for what built-in expressions cannot say (or only at quadratic cost)."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

WORDS = re.compile(r"\w+")


def map_rows(df: DataFrame, make: Callable, schema: str, profile=None) -> DataFrame:
    """``mapInArrow`` over columns: ``make()`` runs once a task and gives ``f(*columns as lists) -> tuple of lists``."""
    out = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            if batch.num_rows:
                columns = f(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=field.type) for c, field in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, out, profile=profile)


def tokens(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def bow(text: str | None) -> Counter:
    return Counter(tokens(text))


def cosine_of(a: Counter, b: Counter) -> float:
    """Cosine of two bags of words; 0 if either is empty."""
    if len(a) > len(b):
        a, b = b, a
    dot = sum(n * b[w] for w, n in a.items() if w in b)
    return dot / math.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values())) if dot else 0.0


@F.pandas_udf(T.BooleanType())
def window_found(answer: pd.Series, text: pd.Series) -> pd.Series:
    """Whether some window of as many words as the answer has a cosine of word counts over 0.8 with it; null counts as empty.

    White space parts the words of windows; the sums slide along, in whole numbers.
    """

    def one(a, t) -> bool:
        want, n = bow(a), len((a or "").split())
        words = [tokens(x) for x in (t or "").split()]
        norm = sum(x * x for x in want.values())
        if not norm or len(words) < n:
            return False
        have: Counter = Counter()
        dot = square = 0
        for i, new in enumerate(words):
            for w in new:
                dot += want.get(w, 0)
                square += 2 * have[w] + 1
                have[w] += 1
            for w in words[i - n] if i >= n else ():
                have[w] -= 1
                square -= 2 * have[w] + 1
                dot -= want.get(w, 0)
            if i >= n - 1 and 25 * dot * dot > 16 * norm * square:
                return True
        return False

    return pd.Series([one(a, t) for a, t in zip(answer, text)], dtype="bool")


@F.pandas_udf(T.DoubleType())
def bow_cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    """Cosine of the word counts of two texts; null counts as empty."""
    seen: dict[str, Counter] = {}

    def bag(t):
        if not t:
            return Counter()
        if t not in seen:
            if len(seen) > 2000:
                seen.clear()
            seen[t] = bow(t)
        return seen[t]

    return pd.Series([cosine_of(bag(x), bag(y)) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def best_cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    """The largest cosine of a text's word counts to those of an array of texts; 0 for an empty array."""
    return pd.Series([max((cosine_of(bow(x), bow(t)) for t in ts), default=0.0) if ts is not None and len(ts) else 0.0 for x, ts in zip(a, b)], dtype="float64")


# --- chunks -----------------------------------------------------------------------------------------------------


def word_chunks(text: str, size: int = 512, overlap: int = 50, reach: int = 20) -> list[str]:
    """Runs of about ``size`` words that overlap and end at a sentence end within ``reach`` words if there is one.

    A text of at most ``size`` words stays as it is. Every chunk begins behind the beginning of the one before. The ends
    of sentences are listed once; each chunk takes the last of them in its reach, by bisection.
    """
    w = text.split()
    if len(w) <= size:
        return [text]
    closed = [i for i, x in enumerate(w, 1) if x.endswith((".", "!", "?"))]
    spans: list[tuple[int, int]] = []
    start = 0
    while start + size < len(w):
        hard = start + size
        k = bisect_right(closed, min(hard + reach + 1, len(w)))
        end = closed[k - 1] if k and closed[k - 1] > max(hard - reach, start) + 1 else hard
        spans.append((start, end))
        start = max(end - overlap, start + 1)
    if start < len(w):
        spans.append((start, len(w)))
    return [" ".join(w[a:b]) for a, b in spans]


def char_chunks(text: str, size: int = 1500, overlap: int = 150, separators: tuple[str, ...] = ("\n\n", "\n", ". ", ", ", " ")) -> list[str]:
    """Pieces of at most ``size`` characters, split at the first separator that occurs, larger parts at later ones.

    Parts are merged again up to ``size``, carrying over at most ``overlap`` characters of whole parts; a single long
    word stays whole.
    """
    if len(text) <= size:
        return [text.strip()] if text.strip() else []
    at = next((k for k, s in enumerate(separators) if s in text), None)
    if at is None:
        return [text.strip()]
    sep, rest = separators[at], separators[at + 1 :]
    out: list[str] = []
    held: list[str] = []

    def length(parts: list[str]) -> int:
        return sum(map(len, parts)) + len(sep) * max(0, len(parts) - 1)

    def flush() -> None:
        piece = sep.join(held).strip()
        if piece:
            out.append(piece)

    for part in text.split(sep):
        if len(part) > size:
            flush()
            held = []
            out += char_chunks(part, size, overlap, rest) if rest else [part.strip()]
            continue
        if held and length(held) + len(sep) + len(part) > size:
            flush()
            while held and (length(held) > overlap or length(held) + len(sep) + len(part) > size):
                held.pop(0)
        held.append(part)
    flush()
    return out


def chunked(docs: DataFrame, key: str = "doc_id", text: str = "content", how: str = "words", size: int | None = None, overlap: int | None = None) -> DataFrame:
    """``key, chunk_ix, content`` of every text that isn't null; ``how`` is ``words`` or ``chars``."""
    kind = dict(docs.dtypes)[key]
    default = (512, 50) if how == "words" else (1500, 150)
    size, overlap = size or default[0], default[1] if overlap is None else overlap
    if overlap >= size:
        raise ValueError("chunks must be longer than their overlap")
    cut = word_chunks if how == "words" else char_chunks

    def make():
        def f(keys, texts):
            out = [[], [], []]
            for k, t in zip(keys, texts):
                for i, piece in enumerate(cut(t, size, overlap)):
                    for column, value in zip(out, (k, i, piece)):
                        column.append(value)
            return out

        return f

    return map_rows(docs.select(key, text).where(F.col(text).isNotNull()), make, f"{key} {kind}, chunk_ix int, content string")


# --- metrics ----------------------------------------------------------------------------------------------------


def ngram_counts(t: list[str], n: int) -> Counter:
    return Counter(zip(*(t[k:] for k in range(n))))


def bleu(candidate: list[str], reference: list[str]) -> float:
    """Sentence BLEU of one to four words with equal weights; zero matches count 0.1; 0 without a common word."""
    if not candidate or not reference:
        return 0.0
    total = 0.0
    for n in range(1, 5):
        have, want = ngram_counts(candidate, n), ngram_counts(reference, n)
        matched = sum((have & want).values())
        if n == 1 and not matched:
            return 0.0
        total += math.log((matched or 0.1) / max(1, sum(have.values())))
    brevity = 1.0 if len(candidate) > len(reference) else math.exp(1 - len(reference) / len(candidate))
    return brevity * math.exp(total / 4)


VOWELS = "aeiou"


@lru_cache(200_000)
def stem(word: str) -> str:
    """Porter's algorithm (1980), for words longer than three letters."""
    if len(word) <= 3 or not word.isascii() or not word.isalpha():
        return word
    w = word

    def consonant(s: str, i: int) -> bool:
        return s[i] not in VOWELS and not (s[i] == "y" and i and consonant(s, i - 1))

    def form(s: str) -> str:
        return re.sub(r"(.)\1+", r"\1", "".join("c" if consonant(s, i) else "v" for i in range(len(s))))

    def measure(s: str) -> int:
        return form(s).count("vc")

    def has_vowel(s: str) -> bool:
        return "v" in form(s)

    def double(s: str) -> bool:
        return len(s) > 1 and s[-1] == s[-2] and consonant(s, len(s) - 1)

    def cvc(s: str) -> bool:
        n = len(s)
        return n > 2 and consonant(s, n - 1) and not consonant(s, n - 2) and consonant(s, n - 3) and s[-1] not in "wxy"

    def replace(rules: str, least: int) -> str:
        # Rules are "suffix>replacement"; only the longest suffix that fits is tried.
        for rule in sorted(rules.split(), key=lambda r: -len(r.partition(">")[0])):
            old, _, new = rule.partition(">")
            if w.endswith(old):
                head = w[: len(w) - len(old)]
                return head + new if measure(head) > least else w
        return w

    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if measure(w[:-3]) > 0 else w
    else:
        for ending in ("ed", "ing"):
            if w.endswith(ending) and has_vowel(w[: -len(ending)]):
                w = w[: -len(ending)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif double(w) and w[-1] not in "lsz":
                    w = w[:-1]
                elif measure(w) == 1 and cvc(w):
                    w += "e"
                break
    if w.endswith("y") and has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # The suffix tables of steps 2 to 4.
    w = replace("ational>ate tional>tion enci>ence anci>ance izer>ize abli>able alli>al entli>ent eli>e ousli>ous ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive biliti>ble", 0)
    w = replace("icate>ic ative> alize>al iciti>ic ical>ic ful> ness>", 0)
    if w.endswith("ion") and w[-4:-3] in ("s", "t") and measure(w[:-3]) > 1:
        w = w[:-3]
    elif not w.endswith("ion"):
        w = replace("al> ance> ence> er> ic> able> ible> ant> ement> ment> ent> ou> ism> ate> iti> ous> ive> ize>", 1)
    if w.endswith("e") and (measure(w[:-1]) > 1 or measure(w[:-1]) == 1 and not cvc(w[:-1])):
        w = w[:-1]
    if measure(w) > 1 and double(w) and w.endswith("l"):
        w = w[:-1]
    return w


def meteor(candidate: list[str], reference: list[str]) -> float:
    """METEOR with the exact and stem stages: harmonic mean (recall nine to one) less a penalty for broken order."""
    used: set[int] = set()
    match: dict[int, int] = {}
    for form in (lambda w: w, stem):
        places: dict[str, list[int]] = {}
        for j, w in enumerate(reference):
            if j not in used:
                places.setdefault(form(w), []).append(j)
        for i, w in enumerate(candidate):
            if i not in match and places.get(form(w)):
                match[i] = places[form(w)].pop(0)
                used.add(match[i])
    if not match:
        return 0.0
    m = len(match)
    p, r = m / len(candidate), m / len(reference)
    chunks = sum(1 for i in match if match.get(i - 1) is None or match[i - 1] != match[i] - 1)
    return p * r / (0.9 * p + 0.1 * r) * (1 - 0.5 * (chunks / m) ** 3)


def rouge_tokens(text: str | None, stemmed: bool = True) -> list[str]:
    t = re.sub(r"[^a-z0-9]+", " ", (text or "").lower()).split()
    return [stem(w) for w in t] if stemmed else t


def f_measure(matched: float, have: int, want: int) -> float:
    return 2 * matched / (have + want) if matched else 0.0


def rouge_n(candidate: list[str], reference: list[str], n: int) -> float:
    a, b = ngram_counts(candidate, n), ngram_counts(reference, n)
    return f_measure(sum((a & b).values()), sum(a.values()), sum(b.values()))


def rouge_l(candidate: list[str], reference: list[str]) -> float:
    """F of the longest common subsequence, bit-parallel over the candidate."""
    masks: dict[str, int] = {}
    for i, w in enumerate(candidate):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(candidate)) - 1
    row = full
    for w in reference:
        m = row & masks.get(w, 0)
        row = (row + m | row - m) & full
    return f_measure((full & ~row).bit_count(), len(candidate), len(reference))


METRICS = T.StructType([T.StructField(n, T.DoubleType()) for n in ("bleu", "meteor", "rouge1", "rouge2", "rougeL")])


@F.pandas_udf(METRICS)
def overlap_metrics(answer: pd.Series, context: pd.Series) -> pd.DataFrame:
    """BLEU, METEOR and ROUGE of answers against contexts; null counts as empty."""
    rows = []
    stems: dict[str, list[str]] = {}
    for a, c in zip(answer, context):
        ta, tc = tokens(a), tokens(c)
        key = c or ""
        if key not in stems:
            if len(stems) > 500:
                stems.clear()
            stems[key] = rouge_tokens(key)
        ra, rc = rouge_tokens(a), stems[key]
        rows.append((bleu(ta, tc), meteor(ta, tc), rouge_n(ra, rc, 1), rouge_n(ra, rc, 2), rouge_l(ra, rc)))
    return pd.DataFrame(rows, columns=["bleu", "meteor", "rouge1", "rouge2", "rougeL"])


@F.pandas_udf(T.DoubleType())
def ngram_overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    """0.4 of the Jaccard similarity of word pairs and 0.6 of that of word triples; 0 where a text has none."""
    seen: dict[str, tuple[set, set]] = {}

    def grams(t):
        t = t or ""
        if t not in seen:
            if len(seen) > 2000:
                seen.clear()
            w = tokens(t)
            seen[t] = set(zip(w, w[1:])), set(zip(w, w[1:], w[2:]))
        return seen[t]

    def one(x, y):
        total = 0.0
        for share, p, q in zip((0.4, 0.6), grams(x), grams(y)):
            if p and q:
                both = len(p & q)
                total += share * both / (len(p) + len(q) - both)
        return total

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


# --- greedy folds over one group ---------------------------------------------------------------------------------


def greedy_kept(near: Callable[[int], np.ndarray], n: int, reference: bool = False) -> list[bool]:
    """Which of ``n`` items stay: none may be near a kept one. ``near(i)`` tells for all items whether they are near i.

    ``reference``: compare item i with the first min(i, number kept) items instead, kept or not.
    """
    kept = np.zeros(n, bool)
    out = []
    for i in range(n):
        row = near(i)
        ok = not (row[: min(i, int(kept.sum()))].any() if reference else (row & kept).any())
        out.append(ok)
        kept[i] = ok
    return out


def star_heads(near: Callable[[int], np.ndarray], n: int) -> list[int]:
    """For each item the head that absorbs it: heads take all later free items that are near them."""
    head = np.full(n, -1)
    for i in range(n):
        if head[i] < 0:
            head[i] = i
            free = (head < 0) & near(i)
            free[:i] = False
            head[free] = i
    return head.tolist()


class TextCosines:
    """Cosines of one text's word counts to those of all others, by an inverted index."""

    def __init__(self, texts: list):
        bags = [bow(t) for t in texts]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, b in enumerate(bags):
            for w, n in b.items():
                places.setdefault(w, []).append((i, n))
        self.bags, self.n = bags, len(texts)
        self.places = {w: (np.array([i for i, _ in p]), np.array([float(n) for _, n in p])) for w, p in places.items()}
        self.norms = np.array([float(sum(n * n for n in b.values())) for b in bags])

    def row(self, i: int) -> np.ndarray:
        dot = np.zeros(self.n)
        for w, n in self.bags[i].items():
            at, counts = self.places[w]
            dot[at] += n * counts
        scale = np.sqrt(self.norms[i] * self.norms)
        return np.divide(dot, scale, out=np.zeros(self.n), where=scale > 0)


class VectorCosines:
    """The same for dense vectors."""

    def __init__(self, vectors: list):
        self.n = len(vectors)
        self.gram = gram(vectors) if vectors else np.zeros((0, 0))

    def row(self, i: int) -> np.ndarray:
        return self.gram[i]


def gram(rows: list) -> np.ndarray:
    """Cosines of all pairs of dense vectors; zero vectors give 0."""
    m = np.array(rows, dtype=np.float64)
    norm = np.sqrt((m * m).sum(1))
    m = m / np.where(norm > 0, norm, 1)[:, None]
    return m @ m.T
