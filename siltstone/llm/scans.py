"""Noise in text from scanned pages: furniture, broken words, misread characters, and their repair.

* **Furniture.** The two top and two bottom lines of a page are compared with those of the pages around it and with all
  equal lines of the document and of other documents; what comes again, with few edits, is a running header or footer.
  Page numbers stand alone there.
* **Skip-gram vectors.** Over all pages it is counted how often words stand within ``WINDOW`` places of the ``CONTEXTS``
  most frequent words. The positive pointwise mutual information of these counts, factored by its leading eigenvectors,
  is what skip-gram learning with negative samples converges to (Levy and Goldberg, 2014): the product of a word's
  vector with that of a context estimates how much more often they meet than by chance.
* **Candidates.** A rare word is linked with the far more frequent words that plausible glyph edits make of it. Names are
  rare even if read well: for them, an edit counts that turns a letter triple found in no other word into usual ones.
* **Correction in context.** Where several candidates fit, or one that is not frequent enough to be sure, each place is
  judged by itself: the candidate wins whose frequency and products with the vectors of the place's own neighbours are
  the highest; a word that is no certain misreading must be beaten by ``CHANNEL``.

Lines are repaired with these corrections, joined over broken words and reflowed to paragraphs.

Counts, pairs, candidates and places stay distributed. Tasks get two bitmaps of fixed size (which words matter; false
hits fall out in the join behind) and the vectors of ``CONTEXTS`` words. Null and empty pages have no noise. Pages
delivered twice count once. Words of more than ``LONGEST`` characters are codes or unspaced text and are never judged.
Ties between corrections go to the more frequent, then to the greater word.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.io import cut
from siltstone.llm.common import map_rows

PAGE_NO = re.compile(r"[^\w]*(?:(?:page|pag|pg|p|seite|s|página|pág|стр)\b\.?\s*)?(?:\d{1,4}|[ivxlc]{1,7}|[\dOolI|]{1,4}(?<=\d)|\d[\dOolI|]{0,3})(?:\s*(?:/|of|von|de|sur)\s*\d{1,4})?[^\w.]*", re.I)
EDGE_NUMBER = re.compile(r"^\W*\d{1,4}\b\W+|[\s|–—\-]*\b[\dOolI]{0,3}\d[\dOolI]{0,3}\W*$")
BREAK_SIGNS = "-‐‑¬\xad"
STRIP = ".,;:()\"“”„?!«»…[]{}‘’'"
CODE = re.compile(r"[A-Za-z]{1,4}-?\d[\d.,]*[a-z]?|[\d.,%°/:-]+[a-zA-Z°%]{0,3}|[A-Z]{2,5}s?|[IVXLC]+|\d+(?:st|nd|rd|th)")
# How scanners misread glyphs, as (read, true); several signs may stand for several.
GLYPHS = (
    ("c", "e"), ("†", "t"), ("|", "i"), ("|", "l"), ("á", "a"), ("l", "i"), ("i", "l"), ("1", "l"), ("1", "i"), ("1", "t"), ("0", "o"), ("5", "s"), ("9", "g"), ("y", "v"), ("6", "b"),
    ("8", "b"), ("a", "ä"), ("o", "ö"), ("u", "ü"), ("e", "é"), ("e", "è"), ("ri", "n"), ("cl", "d"), ("ii", "u"), ("ii", "ü"), ("li", "h"), ("rn", "m"), ("vv", "w"), ("rm", "nn"),
    ("lc", "k"), ("lr", "h"), ("nn", "m"), ("fi", "ﬁ"), ("!", "l"), ("!", "i"), ("$", "s"), ("€", "e"), ("3", "e"), ("4", "a"), ("7", "t"), ("2", "z"), ("à", "a"), ("â", "a"), ("ó", "o"), ("ò", "o"), ("í", "i"), ("ì", "i"), ("ú", "u"),
)
ODD = re.compile(r"[^\W\d_][†|!$€¤§]|[†|!$€¤§][^\W\d_]|[^\W\d_A-Z][0-9]|[0-9][^\W\d_A-Z]")
ODD_SIGN = re.compile(r"[†|!$€¤§0-9]")
LONGEST = 64
#: A correction must be so many times as frequent as the word it corrects, and occur so often; from ``MAYBE`` times on, places decide.
TIMES, MAYBE, LEAST = 8, 3, 5
#: Width of the window, words that serve as contexts, length of the vectors, and negative samples (the shift of the information).
WINDOW, CONTEXTS, DIMENSIONS, NEGATIVES = 2, 512, 32, 1
#: What a candidate's score must be above that of the word as it was read.
CHANNEL = 3.0
#: Bits of the maps of words that matter, and sums that a task holds before it hands them on.
BITS, HELD = 1 << 23, 500_000


# --- furniture ------------------------------------------------------------------------------------------------------


def header_key(line: str) -> str:
    s = EDGE_NUMBER.sub("", " ".join(line.split()))
    if not s.isascii():
        s = "".join(c for c in unicodedata.normalize("NFKD", s.casefold()) if not unicodedata.combining(c))
    return s.casefold().strip(" |–—-")


def edges(text: str) -> tuple[list[int], list[tuple[str, int, str, bool]]]:
    """Lines that hold only a page number, and the two top and bottom lines: (place, line, key, heading-like).

    Lines that begin small or end like a sentence are text, even if they come again; so are second lines that are full.
    """
    lines = text.split("\n")
    at = [i for i, x in enumerate(lines) if x.strip()]
    numbers = [i for i in dict.fromkeys([*at[:2], *at[-2:]]) if PAGE_NO.fullmatch(lines[i].strip())]
    rest = [i for i in at if i not in numbers] if numbers else at
    width = max((len(lines[i].rstrip()) for i in rest), default=0)
    out = []
    for place, k in (("top", 0), ("bottom", len(rest) - 1), ("top2", 1), ("bottom2", len(rest) - 2)):
        if not 0 <= k < len(rest) or place == "bottom" and len(rest) < 2 or place[-1] == "2" and len(rest) < 4:
            continue
        s = lines[rest[k]].strip()
        if s[-1] in ".,;!?" or s[0].islower():
            continue
        if place[-1] == "2" and len(s) + 1 + len(lines[rest[k + 1]].split()[0]) > width:
            continue  # a full line of text: the next word had no room on it
        like = False
        if s[0].isupper() and place == "top":
            like = len(s) + 1 + len(lines[rest[1]].split()[0] if len(rest) > 1 else "") <= width
        elif s[0].isupper() and place == "bottom":
            like = " | " in s
        if key := header_key(s):
            out.append((place, rest[k], key, like))
    return numbers, out


#: Pages before and behind with whose lines a line is compared; headers may alternate and be misread.
AROUND = (-3, -2, -1, 1, 2, 3)


def prepared(scanned: DataFrame) -> DataFrame:
    """``page_id, doc_id, page_no, text, skip, headers, numbers``, a row a page, as a table."""
    pages = scanned.where(F.col("text").isNotNull()).groupBy("page_id").agg(F.max_by(F.struct("doc_id", "page_no", "text"), F.struct("scanned_at", F.xxhash64("text"))).alias("p")).select("page_id", "p.*")

    def make():
        def f(batch):
            texts = batch.column(3).to_pylist()
            numbers, lines = [], []
            for t in texts:
                n, found = edges(t)
                numbers.append(n)
                lines.append([{"place": p, "line_no": i, "key": k, "like": like} for p, i, k, like in found])
            return *batch.columns[:3], texts, numbers, lines

        return f

    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, doc_id {kinds['doc_id']}, page_no {kinds['page_no']}, text string, numbers array<int>, edges array<struct<place: string, line_no: int, key: string, `like`: boolean>>"
    pages = cut(map_rows(pages.select("page_id", "doc_id", "page_no", "text"), make, schema), "pages")
    joined = pages.drop("edges").join(headers_of(pages.select("page_id", "doc_id", "page_no", F.explode("edges").alias("e")).select("page_id", "doc_id", "page_no", "e.*")), "page_id", "left")
    headers = F.coalesce("headers", F.array().cast("array<int>"))
    return cut(joined.select("page_id", "doc_id", "page_no", "text", "numbers", headers.alias("headers"), F.concat(headers, "numbers").alias("skip")), "prepared")


def headers_of(lines: DataFrame) -> DataFrame:
    """``page_id, headers`` from edge lines: which of them come again, as running headers and footers do.

    No document's lines are gathered: equal lines are counted, and pages are joined with those around them by number.
    """
    counted = lines.groupBy("key", "doc_id", "place").agg(F.count("*").alias("n"), F.max("like").alias("like"))
    everywhere = counted.where("place in ('top', 'bottom')").groupBy("key").agg(F.count_distinct("doc_id").alias("docs"), F.max("like").alias("like")).where("docs >= 3 and like").select("key", F.lit(True).alias("common"))
    false = F.lit(False)
    same = counted.where("n >= 2").select("key", "doc_id", "place", F.lit(True).alias("again"))
    lines = cut(lines.join(same, ["key", "doc_id", "place"], "left").withColumn("again", F.coalesce("again", false)), "edges")
    # Lines without an equal are compared with those of the same place on the pages around.
    alone = lines.where("not again").select("doc_id", "place", "page_id", "line_no", "key", F.explode(F.array(*[F.col("page_no") + k for k in AROUND])).alias("page_no"))
    close = F.levenshtein("key", "other", 3) <= F.when(F.length("key") < 12, 1).when(F.length("key") < 28, 2).otherwise(3)
    close = close & (F.levenshtein("key", "other", 3) >= 0)
    near = alone.join(lines.select("doc_id", "place", "page_no", F.col("key").alias("other")), ["doc_id", "place", "page_no"]).where(close)
    around = near.select("page_id", "line_no", F.lit(True).alias("near")).distinct()
    found = lines.join(everywhere, "key", "left").join(around, ["page_id", "line_no"], "left")
    found = found.withColumn("own", F.col("again") | F.coalesce("near", false))
    # Some line of the place repeats in the document, so a heading-like line there is furniture, too.
    has = found.where("own").select("doc_id", "place").distinct().withColumn("has", F.lit(True))
    found = cut(found.select("page_id", "doc_id", "place", "line_no", "like", "own", F.coalesce("common", false).alias("common")), "furniture").join(has, ["doc_id", "place"], "left")
    is_header = F.col("own") | F.col("common") & ~F.col("place").endswith("2") | F.coalesce("has", false) & F.col("like")
    rows = found.where(is_header).groupBy("page_id").agg(F.collect_set(F.struct("place", "line_no")).alias("h"))
    # A second line is furniture only beside a first one.
    first = lambda h: F.exists("h", lambda o: F.concat(o["place"], F.lit("2")) == h["place"])
    kept = F.filter("h", lambda h: ~h["place"].endswith("2") | first(h))
    return rows.select("page_id", F.transform(kept, lambda h: h["line_no"]).alias("headers"))


# --- words ----------------------------------------------------------------------------------------------------------


def text_lines(text: str, skip) -> list[tuple[int, str]]:
    if not skip:
        return [(i, s) for i, x in enumerate(text.split("\n")) if (s := x.strip())]
    skip = set(skip)
    return [(i, s) for i, x in enumerate(text.split("\n")) if (s := x.strip()) and i not in skip]


def token_of(word: str) -> str:
    """The bare word, or nothing if it has no letters, is too long, or is a code, number or capital abbreviation."""
    w = word.strip(STRIP)
    if not 2 <= len(w) <= LONGEST or not any(c.isalpha() for c in w) or CODE.fullmatch(w):
        return ""
    return w.lower()


class Tokens(dict):
    """Bare words by words as they stand; bounded."""

    def __missing__(self, word: str) -> str:
        if len(self) > 400_000:
            self.clear()
        t = self[word] = token_of(word)
        return t


def broken(line: str) -> str:
    """The word that breaks off at the end of ``line``, without its sign, or nothing."""
    if line[-1] not in BREAK_SIGNS or len(line) < 2 or not line[-2].isalpha():
        return ""
    return line.rsplit(None, 1)[-1][:-1].lstrip(STRIP)


def parsed(lines: list[tuple[int, str]]) -> tuple[list[tuple[int, int, list[str]]], list[tuple[int, str, str, int, str]]]:
    """Lines as (line, number of the first word, words) without broken parts; the breaks: (line, sign, part, next line or -1, its first word)."""
    out, breaks, after_break = [], [], False
    for k, (i, s) in enumerate(lines):
        words = s.split()
        a = broken(s) if s[-1] in BREAK_SIGNS else ""
        if a:
            j, rest = (lines[k + 1][0], lines[k + 1][1].split(None, 1)[0]) if k + 1 < len(lines) else (-1, "")
            breaks.append((i, s[-1], a, j, rest))
            words.pop()
        if after_break and words:
            del words[0]
        out.append((i, int(after_break), words))
        after_break = bool(a)
    return out, breaks


def words_and_breaks(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``token, n`` over all pages, and all breaks: ``page_id, line_no, sign, a, b, page_b, line_b``. One pass over the texts."""
    kinds = dict(pages.dtypes)
    names = ("token", "n", "page_id", "doc_id", "page_no", "line_no", "sign", "a", "b", "line_b")

    def make():
        tokens = Tokens()
        raw: Counter = Counter()

        def counted():
            counts: Counter = Counter()
            for w, n in raw.items():
                if t := tokens[w]:
                    counts[t] += n
            raw.clear()
            return list(counts), list(counts.values()), *[[None] * len(counts)] * 8

        def f(batch):
            out = {k: [] for k in names}

            def row(**values):
                for k in names:
                    out[k].append(values.get(k))

            for p, d, no, t, skip in zip(*(c.to_pylist() for c in batch.columns)):
                lines = text_lines(t, skip)
                if not lines:
                    continue
                inner, breaks = parsed(lines)
                for _, _, words in inner:
                    raw.update(words)
                # What a word broken on the page before goes on with.
                row(page_id=p, doc_id=d, page_no=no, line_no=lines[0][0], sign="", b=lines[0][1].split(None, 1)[0])
                for i, sign, a, j, rest in breaks:
                    row(page_id=p, doc_id=d, page_no=no, line_no=i, sign=sign, a=a, b=rest if j >= 0 else None, line_b=j)
            if len(raw) > HELD:
                for column, values in zip(out.values(), counted()):
                    column += values
            return tuple(out.values())

        return f, counted

    schema = f"token string, n bigint, page_id {kinds['page_id']}, doc_id {kinds['doc_id']}, page_no {kinds['page_no']}, line_no int, sign string, a string, b string, line_b int"
    rows = cut(map_rows(pages.select("page_id", "doc_id", "page_no", "text", "skip"), make, schema), "parsed")
    words = cut(rows.where("token is not null").groupBy("token").agg(F.sum("n").alias("n")), "words")
    rows = rows.where("token is null")
    inside = rows.where("sign <> '' and b is not null").select("page_id", "line_no", "sign", "a", "b", F.col("page_id").alias("page_b"), "line_b")
    over = rows.where("sign <> '' and b is null").select("page_id", "doc_id", "page_no", "line_no", "sign", "a")
    nxt = rows.where("sign = ''").select("doc_id", (F.col("page_no") - 1).alias("page_no"), "b", F.col("page_id").alias("page_b"), F.col("line_no").alias("line_b"))
    return words, inside.union(over.join(nxt, ["doc_id", "page_no"]).select("page_id", "line_no", "sign", "a", "b", "page_b", "line_b"))


def judged_breaks(breaks: DataFrame, words: DataFrame) -> DataFrame:
    """``breaks`` with ``joined`` and ``own``: whether the hyphen belongs to the word itself. The words are looked up in one join."""
    rest = F.lower(F.regexp_replace("b", r"^[^\p{L}\d|†]+|[^\p{L}\d|†]+$", ""))
    x = breaks.withColumn("rest", rest).where(F.col("rest").rlike(r"^[\p{L}†|\d]")).withColumn("head", F.lower("a"))
    x = x.withColumn("joined", F.concat("head", "rest"))
    asked = {"n_joined": F.col("joined"), "n_linked": F.concat("head", F.lit("-"), "rest"), "n_rest": F.col("rest"), "n_head": F.col("head"), "n_first": F.concat("head", F.lit("-*"))}
    looked = x.select("page_id", "line_no", F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in asked]), F.array(*asked.values()))).alias("role", "token"))
    firsts = words.where(F.col("token").contains("-")).groupBy(F.concat(F.substring_index("token", "-", 1), F.lit("-*")).alias("token")).agg(F.sum("n").alias("n"))
    known = looked.join(words.select("token", "n").union(firsts), "token")
    counts = known.groupBy("page_id", "line_no").agg(*[F.coalesce(F.max(F.when(F.col("role") == k, F.col("n"))), F.lit(0)).alias(k) for k in asked])
    x = x.join(counts, ["page_id", "line_no"], "left").fillna(0, list(asked))
    own = F.col("sign").isin("-", "‐", "‑") & (F.col("n_joined") <= F.col("n_linked")) & ((F.col("n_linked") > 0) | ((F.col("n_rest") >= LEAST) & ((F.col("n_head") >= LEAST) | (F.col("n_first") >= LEAST))) | F.col("rest").isin("und", "oder", "bzw", "and", "or", "et", "ou", "y", "o"))
    return x.withColumn("own", own).select("page_id", "line_no", "a", "page_b", "line_b", "rest", "joined", "own", "n_joined")


# --- candidates -----------------------------------------------------------------------------------------------------


def edited(word: str, only_odd: bool = False) -> list[str]:
    """What one glyph edit makes of ``word``; ``only_odd``: of signs that belong in no word."""
    out = []
    for read, true in GLYPHS:
        if only_odd and not ODD_SIGN.match(read):
            continue
        at = word.find(read)
        while at >= 0:
            out.append(word[:at] + true + word[at + len(read) :])
            at = word.find(read, at + 1)
    return out


def variants(token: str) -> list[str]:
    """What ``token`` may have been: one glyph edit; with signs that belong in no word up to two edits, which leave none of them."""
    if not ODD.search(token):
        return [x for x in dict.fromkeys(edited(token)) if x != token]
    odd = len(ODD_SIGN.findall(token))
    once = list(dict.fromkeys(edited(token, True))) if odd <= 2 else []
    out = [*once, *(y for x in once for y in edited(x, odd == 2))] if odd else [*(x for x in edited(token)), *(y for x in dict.fromkeys(edited(token)) for y in edited(x))]
    return [x for x in dict.fromkeys(out) if x != token]


def candidates(asked: DataFrame, words: DataFrame) -> DataFrame:
    """``token, variant, n, m, sure``: what the misread of ``asked`` (``token, n``) may have been; variant null: beyond repair.

    Letters read as other letters need a far more frequent neighbour (``sure``, else the places decide), or a neighbour
    that makes an unheard-of sequence of three letters usual; signs and digits inside a word are misread in any case.
    """

    def make():
        def f(batch):
            tokens, counts, found, odd = [], [], [], []
            for t, n in zip(*(c.to_pylist() for c in batch.columns)):
                strange = ODD.search(t) is not None
                for v in variants(t) + [""] * strange:
                    tokens.append(t)
                    counts.append(n)
                    found.append(v)
                    odd.append(strange)
            return tokens, counts, found, odd

        return f

    guesses = map_rows(asked.select("token", "n"), make, "token string, n bigint, variant string, odd boolean")
    guesses = cut(guesses.join(words.select(F.col("token").alias("variant"), F.col("n").alias("m")), "variant", "left").fillna(0, ["m"]), "guesses")
    frequent = (F.col("m") >= LEAST) & (F.col("m") >= MAYBE * F.col("n"))
    good = guesses.where("m > 0").where(F.col("odd") | frequent).select("token", "variant", "n", "m", (F.col("odd") | (F.col("m") >= TIMES * F.col("n"))).alias("sure"))
    # Names are rare: compare the rarest letter sequence of the word and of what it may have been.
    rare = guesses.where("not odd and length(token) >= 5 and (n <= 3 or m >= 2 * n)").join(good.where("sure").select("token").distinct(), "token", "left_anti").select("token", "variant", "n", "m")
    grams = lambda c: F.explode(F.expr(f"transform(sequence(1, length({c})), i -> substring(concat('^', {c}, '$'), i, 3))")).alias("g")
    letters = r"^\p{L}+$"
    triples = cut(words.where(F.col("token").rlike(letters)).select(grams("token")).groupBy("g").agg(F.count("*").alias("types")), "triples")

    def least(x: DataFrame, c: str) -> DataFrame:
        """``c, least``: of each form made of letters, in how many words its rarest sequence occurs."""
        return x.select(c).distinct().where(F.col(c).rlike(letters)).select(c, grams(c)).join(triples, "g", "left").groupBy(c).agg(F.min(F.coalesce("types", F.lit(0))).alias("least"))

    # A word lends each of its own sequences one type.
    strangers = cut(rare.join(least(rare, "token").where("least <= 1").select("token"), "token"), "strangers")
    names = strangers.join(least(strangers, "variant").where("least >= 6"), "variant")
    names = names.groupBy("token").agg(F.max_by(F.struct("variant", "n", "m"), F.struct("least", "variant")).alias("v")).select("token", "v.variant", "v.n", "v.m", F.lit(True).alias("sure"))
    strange = guesses.where("odd and variant = ''").join(good.select("token").distinct(), "token", "left_anti").select("token", F.lit(None).cast("string").alias("variant"), "n", F.lit(0).cast("bigint").alias("m"), F.lit(True).alias("sure"))
    return cut(good.union(names).union(strange), "candidates")


# --- places and vectors ---------------------------------------------------------------------------------------------


def bitmap(words: DataFrame) -> bytes:
    """A map of ``BITS`` bits in which each of ``words`` (one column) sets one."""
    at = words.select((F.crc32(words[0].cast("binary")) % BITS + 1).alias("b"))
    rows = at.groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m")).collect()
    out = bytearray(BITS // 8)
    for r in rows:
        out[(r["k"] - 1) * 4096 : r["k"] * 4096] = r["m"]
    return bytes(out)


def in_map(bits: bytes, word: str) -> bool:
    b = zlib.crc32(word.encode("utf-8", "surrogatepass")) % BITS
    return bool(bits[b >> 3] >> (b & 7) & 1)


def places_and_pairs(pages: DataFrame, judged: bytes, learnt: bytes, contexts: list[str]) -> DataFrame:
    """One pass over the texts: places of words that may be misread, and how often words meet contexts.

    Places: ``token, page_id, line_no, word_no, near`` (numbers of the context words around it). Pairs: ``token, row, context, n``
    (``row``: the word's own number as a context, or -1) for words of the map ``learnt`` and the contexts themselves, summed by task.
    """
    kinds = dict(pages.dtypes)
    size = max(1, len(contexts))

    def make():
        number = {w: k for k, w in enumerate(contexts)}
        seen: dict[str, tuple[int, str]] = {}  # by word as it stands: number, and the token if it may be misread
        tokens = Tokens()
        names, ids = list(contexts), dict(number)
        held: list = [np.zeros(0, np.int64), np.zeros(0, np.int64)]

        def pairs():
            """The sums held, which are begun anew."""
            key, n = held
            held[:] = np.zeros(0, np.int64), np.zeros(0, np.int64)
            none = [None] * len(key)
            words = (key // size).tolist()
            rows = [names[x] for x in words], none, none, none, none, (key % size).tolist(), n.tolist(), [x if x < size else -1 for x in words]
            names[size:] = []
            ids.clear()
            ids.update(number)
            seen.clear()
            return rows

        def f(batch):
            if len(seen) > HELD:
                seen.clear()
            out = [[] for _ in range(8)]
            sequence: list[int] = []

            def look(w: str) -> tuple[int, str]:
                t = tokens[w]
                k = ids.get(t, -1) if t else -1
                if k < 0 and t and in_map(learnt, t):
                    k = ids[t] = len(names)
                    names.append(t)
                x = seen[w] = (k, t if t and in_map(judged, t) else "")
                return x

            for p, text, skip in zip(*(c.to_pylist() for c in batch.columns)):
                found = []
                for i, first, words in parsed(text_lines(text, skip))[0]:
                    for k, w in enumerate(words, first):
                        x = seen.get(w) or look(w)
                        if x[1]:
                            found.append((x[1], i, k, len(sequence)))
                        sequence.append(x[0])
                end = len(sequence)
                for t, i, k, at in found:
                    near = [c for j in (at - 2, at - 1, at + 1, at + 2) if end > j >= 0 and 0 <= (c := sequence[j]) < size]
                    for column, value in zip(out, (t, p, i, k, near, None, None, None)):
                        column.append(value)
                sequence += [-1] * WINDOW
            s = np.array(sequence, np.int64)
            keys = []
            for d in range(1, WINDOW + 1):
                a, b = s[:-d], s[d:]
                both = (a >= 0) & (b >= 0)
                for x, y in ((a, b), (b, a)):
                    ok = both & (y < size)
                    keys.append(x[ok] * size + y[ok])
            keys, n = np.unique(np.concatenate(keys), return_counts=True)
            key, at = np.unique(np.concatenate([held[0], keys]), return_inverse=True)
            held[:] = key, np.bincount(at, weights=np.concatenate([held[1], n]), minlength=len(key)).astype(np.int64)
            if len(key) > HELD or len(names) > HELD:
                for column, values in zip(out, pairs()):
                    column += values
            return out

        return f, pairs

    return cut(map_rows(pages.select("page_id", "text", "skip"), make, f"token string, page_id {kinds['page_id']}, line_no int, word_no int, near array<int>, context int, n bigint, row int"), "places")


def information(n: np.ndarray, row: np.ndarray, column: np.ndarray, total: float) -> np.ndarray:
    """Positive pointwise mutual information, shifted by the negative samples."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.maximum(np.nan_to_num(np.log(n * total / (row * column)), nan=0.0, neginf=0.0) - math.log(NEGATIVES), 0.0)


class Vectors:
    """Skip-gram vectors: those of the contexts here, those of words as a table (``token, v``)."""

    def __init__(self, pairs: DataFrame, contexts: list[str]):
        size = len(contexts)
        pairs = cut(pairs.groupBy("token", "row", "context").agg(F.sum("n").alias("n")), "pairs")
        n = np.zeros((size, size))
        known = pairs.where("row >= 0").select("row", "context", "n").toArrow()
        n[known.column("row").to_numpy(), known.column("context").to_numpy()] = known.column("n").to_numpy()
        self.total, self.column = n.sum(), n.sum(0)
        values, vectors = np.linalg.eigh(information((n + n.T) / 2, n.sum(1)[:, None], self.column[None, :], self.total)) if size else (np.zeros(0), np.zeros((0, 0)))
        best = np.argsort(-values)[:DIMENSIONS]
        best = best[values[best] > 1e-9]
        root = np.sqrt(values[best])
        self.contexts = vectors[:, best] * root
        fold, column, total = vectors[:, best] / root, self.column, self.total

        def make():
            def f(batch):
                out = []
                for cs, ns in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    cs, ns = np.array(cs, np.int64), np.array(ns, float)
                    out.append((information(ns, np.array(ns.sum()), column[cs], total) @ fold[cs]).tolist())
                return batch.column(0), out

            return f

        rows = pairs.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("context", "n"))).alias("x"))
        self.words = map_rows(rows.select("token", "x.context", "x.n"), make, "token string, v array<double>")


class Noise:
    """All that is known of the noise of some pages, as tables."""

    def __init__(self, scanned: DataFrame):
        self.pages = prepared(scanned)
        self.words, breaks = words_and_breaks(self.pages)
        self.breaks = cut(judged_breaks(breaks, self.words), "judged")
        joined = self.breaks.where("not own and n_joined = 0").select(F.col("joined").alias("token"), F.lit(1).cast("bigint").alias("n")).distinct()
        most = self.words.agg(F.max("n")).first()[0] or 0
        # A word that no other can be frequent enough to correct is only judged by its signs.
        asked = self.words.where((F.col("n") * MAYBE <= most) | F.col("token").rlike(r"[†|!$€¤§0-9]")).union(joined)
        self.candidates = candidates(asked, self.words)
        self._places()

    def _places(self) -> None:
        """``corrections`` (token, correction for words with one certain candidate, best by frequency) and ``places``."""
        best = self.candidates.groupBy("token").agg(F.max("sure").alias("sure"), F.count("*").alias("fits"), F.max_by("variant", F.struct("sure", "m", "variant")).alias("correction"), F.first("n").alias("n"))
        self.best = cut(best, "best")
        contexts = [r["token"] for r in self.words.orderBy(F.desc("n"), "token").limit(CONTEXTS).collect()]
        open_ = self.best.where("fits > 1 or not sure").select("token")
        wanted = self.candidates.where("variant is not null").join(open_, "token", "left_semi").select(F.explode(F.array("token", "variant")).alias("token"))
        rows = places_and_pairs(self.pages, bitmap(self.best.select("token")), bitmap(wanted), contexts)
        places = rows.where("page_id is not null").select("token", "page_id", "line_no", "word_no", "near").join(self.best, "token")
        settled = places.where("fits = 1 and sure").select("page_id", "line_no", "word_no", "correction")
        vectors = Vectors(rows.where("page_id is null").select("token", "row", "context", "n"), contexts)
        v = cut(vectors.words.join(wanted.distinct(), "token", "left_semi"), "vectors")
        each = self.candidates.where("variant is not null").join(open_, "token", "left_semi").join(v.select(F.col("token").alias("variant"), "v"), "variant", "left")
        each = each.groupBy("token").agg(F.collect_list(F.struct("variant", "m", "sure", "v")).alias("each")).join(v.select("token", F.col("v").alias("own")), "token", "left")
        context = vectors.contexts
        kinds = dict(places.dtypes)

        def make():
            def score(n, vector, place):
                return math.log(max(n, 1)) + (float(np.dot(vector, place)) if vector is not None and len(vector) else 0.0)

            def f(batch):
                out = [[], [], [], []]
                for p, i, k, near, n, own, each_ in zip(*(c.to_pylist() for c in batch.columns)):
                    place = context[near].sum(0) if near else np.zeros(context.shape[1])
                    kept = score(n, own, place)
                    fit = [(score(x["m"], x["v"], place), x["m"], x["variant"]) for x in each_]
                    ok = [s for s, x in zip(fit, each_) if x["sure"] or s[0] >= kept + CHANNEL]
                    if ok:
                        for column, value in zip(out, (p, i, k, max(ok)[2])):
                            column.append(value)
                return out

            return f

        judged = map_rows(places.where("fits > 1 or not sure").join(each, "token").select("page_id", "line_no", "word_no", "near", "n", "own", "each"), make, f"page_id {kinds['page_id']}, line_no int, word_no int, correction string")
        self.places = cut(settled.union(judged), "corrected")

    def found(self) -> DataFrame:
        """``page_id, line_no, noise``."""
        header = self.pages.select("page_id", F.explode("headers").alias("line_no"), F.lit("header").alias("noise"))
        number = self.pages.select("page_id", F.explode("numbers").alias("line_no"), F.lit("page_no").alias("noise"))
        hyphen = self.breaks.where("not own").select("page_id", "line_no", F.lit("hyphen").alias("noise"))
        split = self.breaks.where("not own and n_joined = 0").join(self.best.where("sure").select(F.col("token").alias("joined"), "correction"), "joined")
        # The first difference tells which part of a broken word was misread.
        same = F.expr("aggregate(sequence(1, length(a)), true, (s, i) -> s and substring(lower(a), i, 1) = substring(coalesce(correction, ''), i, 1))")
        odd = r"[†|!$€]|\d"
        first = split.where(F.when(F.col("correction").isNull(), F.col("a").rlike(odd)).otherwise(~same)).select("page_id", "line_no")
        second = split.where(F.when(F.col("correction").isNull(), F.col("rest").rlike(odd)).otherwise(same)).select(F.col("page_b").alias("page_id"), F.col("line_b").alias("line_no"))
        misread = self.places.select("page_id", "line_no").union(first).union(second).select("page_id", "line_no", F.lit("misread").alias("noise"))
        return header.union(number).union(hyphen).union(misread).distinct()

    def paragraphs(self) -> DataFrame:
        """``doc_id, paragraph_no, text``: the repaired paragraphs of each document, counted from 0.

        A paragraph that goes on over pages is joined; no document is gathered.
        """
        fixes = self.places.where("correction is not null").select("page_id", F.struct(F.concat_ws(" ", "line_no", "word_no").alias("at"), "correction").alias("x"))
        fixes = fixes.groupBy("page_id").agg(F.map_from_entries(F.collect_list("x")).alias("fixes"))
        joins = self.breaks.where("not own").join(self.best.where("sure").select(F.col("token").alias("joined"), "correction"), "joined", "left").groupBy("page_id").agg(F.map_from_entries(F.collect_set(F.struct("line_no", F.coalesce("correction", "joined")))).alias("joins"))
        heads = self.breaks.where("not own and page_b <> page_id").select(F.col("page_b").alias("page_id"), F.lit(True).alias("continued")).distinct()
        rows = self.pages.join(fixes, "page_id", "left").join(joins, "page_id", "left").join(heads, "page_id", "left")
        kinds = dict(self.pages.dtypes)

        def make():
            def f(batch):
                out = [[] for _ in range(5)]
                for d, no, t, skip, fix, join, continued in zip(*(c.to_pylist() for c in batch.columns)):
                    parts = repaired(t, skip, dict(fix or ()), dict(join or ()), bool(continued))
                    for k, (text, glued, closed) in enumerate(parts):
                        for column, value in zip(out, (d, no, k, text, (k > 0, glued, closed))):
                            column.append(value)
                return out[0], out[1], out[2], out[3], [x[0] for x in out[4]], [x[1] for x in out[4]], [x[2] for x in out[4]]

            return f

        parts = cut(map_rows(rows.select("doc_id", "page_no", "text", "skip", "fixes", "joins", "continued"), make, f"doc_id {kinds['doc_id']}, page_no {kinds['page_no']}, k int, text string, inner boolean, glued boolean, closed boolean"), "parts")
        # A page that ends within a sentence goes on in the next page that has text.
        block = (F.col("page_no") / 256).cast("bigint")
        last = parts.groupBy("doc_id", "page_no").agg(F.max_by("closed", "k").alias("closed"))
        by_block = last.groupBy("doc_id", block.alias("block")).agg(F.max_by("closed", "page_no").alias("last"))
        before_block = by_block.withColumn("before_block", F.lag("last").over(Window.partitionBy("doc_id").orderBy("block"))).select("doc_id", "block", "before_block")
        w = Window.partitionBy("doc_id", "block").orderBy("page_no")
        before = last.withColumn("block", block).withColumn("before", F.lag("closed").over(w)).join(before_block, ["doc_id", "block"]).select("doc_id", "page_no", F.coalesce("before", "before_block", F.lit(True)).alias("before"))
        x = parts.join(before, ["doc_id", "page_no"]).withColumn("block", block).withColumn("new", (F.col("inner") | F.col("before") & ~F.col("glued")).cast("bigint"))
        totals = x.groupBy("doc_id", "block").agg(F.sum("new").alias("n")).withColumn("offset", F.sum("n").over(Window.partitionBy("doc_id").orderBy("block")) - F.col("n")).select("doc_id", "block", "offset")
        numbered = x.withColumn("own", F.sum("new").over(Window.partitionBy("doc_id", "block").orderBy("page_no", "k"))).join(totals, ["doc_id", "block"]).withColumn("paragraph_no", F.greatest(F.col("own") + F.col("offset") - 1, F.lit(0)))
        piece = F.struct("page_no", "k", F.when(F.col("glued"), F.col("text")).otherwise(F.concat(F.lit(" "), "text")).alias("t"))
        text = F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["t"]), "")
        return numbered.groupBy("doc_id", "paragraph_no").agg(F.trim(text).alias("text")).where("text <> ''")


def recased(word: str, fixed: str) -> str:
    return fixed.upper() if word.isupper() and len(word) > 1 else fixed[:1].upper() + fixed[1:] if word[:1].isupper() else fixed


CLOSING = ".!?:\"”»…。！？"


def repaired(text: str, skip, fixes: dict[str, str], joins: dict[int, str], continued: bool) -> list[tuple[str, bool, bool]]:
    """The paragraphs of one page: furniture dropped, words corrected and joined, lines reflowed.

    With each, whether it goes on from the page before without a space (the sign behind a word that was broken there),
    and whether it ends like a sentence. ``fixes`` are by line and word (``"3 7"``), ``joins`` by line.
    """
    skip, out, para = set(skip or ()), [], []
    drop_first, glue = continued, False

    def close():
        nonlocal para, glue
        if para:
            t = " ".join(para)
            out.append((t, glue and not out, t[-1] in CLOSING))
        para, glue = [], glue and not out

    for i, line in enumerate(text.split("\n")):
        if i in skip:
            continue
        s = line.strip()
        if not s:
            if para and para[-1][-1] in CLOSING:
                close()
            continue
        if line[:2] == "  " and para:
            close()
        words = s.split()
        if drop_first:  # the rest of a word that the line before already holds whole
            tail = words[0][len(words[0].rstrip(STRIP)) :]
            if tail:
                if para:
                    para[-1] += tail
                else:
                    para.append(tail)
                    glue = True
            words[0] = ""
            drop_first = False
        fixed = []
        for k, w in enumerate(words):
            if not w:
                continue
            if k == len(words) - 1 and i in joins:
                lead = w[: len(w) - len(w.lstrip(STRIP))]
                fixed.append(lead + recased(w.strip(STRIP), joins[i]))
                drop_first = True
                continue
            if right := fixes.get(f"{i} {k}"):
                core = w.strip(STRIP)
                w = w.replace(core, recased(core, right), 1)
            fixed.append(w)
        if fixed:
            para.append(" ".join(fixed))
    close()
    return out
