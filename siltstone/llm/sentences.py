"""Sentence boundaries across languages and scripts.

Document-centred disambiguation: whether a short word before a full stop is an abbreviation, and whether the
capitalised word behind it is a name, is decided by the unambiguous occurrences of both in the same document.
Where the document is silent, counts over the whole corpus decide (``corpus_evidence``). Scripts without capital
letters have rules of their own: full-width and Devanagari stops always end a sentence, Thai uses spaces.

Null and empty texts yield no unit; repeated rows yield the same units again (callers drop repeats by key);
extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.io import cut
from siltstone.llm.common import map_rows

# Titles and references that never end a sentence, by language.
NEVER_LAST = frozenset(
    """dr prof mr mrs ms st sr sra dra srta mme mlle hr fr frau no nr n° fig figs abb tab sec sect vol p pp pag pág s art
    vgl cf ca env approx aprox z d u b vs bzw ggf inkl rd см рис стр г гл ул проф им डॉ श्री""".split()
)
# Words before a German ordinal number.
ORDINAL_BEFORE = frozenset("am dem der den vom zum im des die das ab bis seit".split())

CLOSERS = "\"'”’»“‘」』）)]"
CANDIDATE = re.compile(r"[.!?…。！？؟।॥۔｡]+")
FULL = ".!?…。！？؟।:;" + CLOSERS
STOP_ALWAYS = frozenset("。！？।॥｡")
LIST_LINE = re.compile(r"(?:[-*•‣◦·–▪]|\(?\d{1,3}[.)]|\(?[a-zA-Z]\)|\d+(?:\.\d+)+\.?)[ \t]+\S")
MARKER_LINE = re.compile(r"\[[^\[\]\n]*\]$|={2,}[^=\n]+={2,}$")
QUOTES = re.compile("[\"“”„«»「」『』()（）\\[\\]]")
THAI = re.compile("(?<=[ก-๎])[ \n]+(?=[ก-๎])")
THAI_LETTER, LETTER = re.compile("[ก-๎]"), re.compile(r"[^\W\d_]")
OPEN = {"“": "”", "„": "“", "«": "»", "「": "」", "『": "』", "(": ")", "（": "）", "[": "]"}
CLOSE = {v: k for k, v in OPEN.items()} | {"“": "„"}
CJK = re.compile("[぀-ヿ㐀-鿿]")
CAPITALS = re.compile(r"[^\W\d_a-z]{1,3}\.")
#: Evidence for the corpus tables: a stop, the short word before it, and what follows.
STOP = re.compile(r"[.!?](?: +|[ \n]+)")
SHORT_WORD, NEXT_WORD = re.compile(r"(?<![^\W_])[^\W\d_]{1,6}\Z"), re.compile(r"([\"“„«(]?)([^\W_]+)")
#: Of a word with a full stop, the share of occurrences before a small letter that makes it an abbreviation.
ABBREVIATION_SHARE = 0.3
#: Of all short words with a full stop, the share that must be one word for the corpus to know it as an abbreviation.
KNOWN_SHARE = 1e-5
#: Of all sentences, the share (counted once a document) that must start with a word for it to count as a usual beginning.
STARTER_SHARE = 2e-4


def open_marks(text: str) -> list[str]:
    """The quotation marks and brackets that are open at the end of ``text``."""
    stack: list[str] = []
    for m in QUOTES.finditer(text):
        c = m[0]
        if c == '"':
            if '"' in stack:
                while stack.pop() != '"':
                    pass
            else:
                stack.append(c)
        elif c == "“" and "„" in stack:
            while stack.pop() != "„":
                pass
        elif c in OPEN:
            stack.append(c)
        elif (o := CLOSE[c]) in stack:
            while stack.pop() != o:
                pass
    return stack


def mostly_thai(text: str) -> bool:
    """Whether ``text`` has as many Thai letters as others, so that spaces are its boundaries; a Thai name is not enough."""
    n = len(THAI_LETTER.findall(text))
    return n > 0 and 2 * n >= n + sum(not "ก" <= c <= "๎" for c in LETTER.findall(text))


class Splitter:
    """Splits one text after another; ``abbreviations`` and ``starters`` are the corpus fallback."""

    def __init__(self, abbreviations: frozenset[str] = frozenset(), starters: frozenset[str] = frozenset()):
        self.abbreviations, self.starters = abbreviations, starters

    def blocks(self, text: str) -> list[tuple[int, int]]:
        """Spans whose inside line breaks are no boundary."""
        if "\n" not in text:
            return [(0, len(text))]
        lines, at = [], 0
        for line in text.split("\n"):
            lines.append((at, at + len(line), line.strip()))
            at += len(line) + 1
        n = len(lines)
        whole = [bool(s) and (LIST_LINE.match(s) is not None) for _, _, s in lines]
        marker = [bool(s) and s[0] in "[=" and MARKER_LINE.match(s) is not None for _, _, s in lines]
        # Wrapped text shows in lines that stop inside a sentence although another line follows.
        # The first line of a block may be a heading, unless the next one goes on in small letters.
        inner = [
            len(s)
            for i, (_, _, s) in enumerate(lines[:-1])
            if s and (nxt := lines[i + 1][2]) and not marker[i] and not whole[i] and s[-1] not in FULL and (nxt[0].islower() or i and lines[i - 1][2] and not marker[i - 1] and not whole[i - 1] and lines[i - 1][2][-1] not in FULL)
        ]
        width = max((x for x in inner if x <= 130), default=0)
        out: list[tuple[int, int]] = []
        start = None
        soft = False
        for i in range(n):
            a, b, s = lines[i]
            if not s:
                if start is not None:
                    out.append((start, a))
                start, soft = None, False
                continue
            if marker[i] or (whole[i] and not soft):
                if start is not None:
                    out.append((start, a))
                out.append((a, -b - 1))  # one unit
                start, soft = None, False
                continue
            if start is not None and not soft:
                out.append((start, a))
                start = None
            if start is None:
                start = a
            soft = False
            if i + 1 < n and width and (nxt := lines[i + 1][2]):
                first = nxt.split(" ", 1)[0]
                soft = len(s) + 1 + len(first) > width and len(s) <= width + 25 and not marker[i + 1]
                if soft and whole[i + 1] and s[-1] in ".!?:;。" and i and len(s) < width - 25:
                    soft = False
        if start is not None:
            out.append((start, len(text)))
        return out

    def units(self, text: str, lang: str | None = None) -> list[tuple[int, int]]:
        """Start and end of every unit, in characters."""
        out: list[tuple[int, int]] = []
        some = THAI_LETTER.search(text) is not None
        thai = some and ((lang or "").lower().startswith("th") or mostly_thai(text))
        seen: dict[tuple[str, str], bool] = {}
        cuts = [m.end() for m in CANDIDATE.finditer(text)]
        quotes = [m.start() for m in QUOTES.finditer(text)]
        quotes.append(len(text) + 1)
        q = 0
        for a, b in self.blocks(text):
            if b < 0:
                self.emit(text, a, -b - 1, out)
                continue
            at = a
            for k in range(bisect_left(cuts, a + 1), bisect_left(cuts, b + 1)):
                e = cuts[k]
                if e <= at:
                    continue
                while quotes[q] < at:
                    q += 1
                if quotes[q] > e and text[e - 1 : e + 1] == ". " and e + 1 < b and text[e + 1].isupper():
                    # The usual case: a long word, one full stop, a space and a capital letter.
                    word = text[text.rfind(" ", at, e - 1) + 1 : e - 1]
                    if len(word) > 6 and word.isalpha():
                        self.emit(text, at, e, out)
                        at = e
                        continue
                if e := self.ends(text, at, e, b, seen, quotes[q] < e):
                    if thai or some and mostly_thai(text[at:e]):
                        at = self.spaces(text, at, e, out)
                    else:
                        self.emit(text, at, e, out)
                        at = e
            if thai or some and mostly_thai(text[at:b]):
                at = self.spaces(text, at, b, out)
            self.emit(text, at, b, out)
        return out

    def spaces(self, text: str, a: int, b: int, out: list) -> int:
        for m in THAI.finditer(text, a, b):
            self.emit(text, a, m.start(), out)
            a = m.end()
        self.emit(text, a, b, out)
        return b

    @staticmethod
    def emit(text: str, a: int, b: int, out: list) -> None:
        piece = text[a:b]
        if s := piece.strip():
            a += len(piece) - len(piece.lstrip())
            out.append((a, a + len(s)))

    def ends(self, text: str, at: int, e: int, limit: int, seen: dict, quoted: bool) -> int:
        """Where the unit that began at ``at`` ends if the terminator before ``e`` ends it, else 0."""
        last = text[e - 1]
        c = text[e] if e < limit else ""
        mark = e
        closed = ""
        while c and c in CLOSERS:
            if c == "“" and "„" not in text[at:e]:
                break  # opens the next sentence
            if c == '"' and text.count('"', at, e) % 2 == 0:
                break
            if c in "'’" and e + 1 < limit and text[e + 1].isalnum():
                break
            closed += c
            e += 1
            c = text[e] if e < limit else ""
        if not text[e:limit].strip() if e >= limit - 2 else False:
            return limit
        if (quoted or closed) and any(self.closes(text, m, e, limit, seen) for m in open_marks(text[at:e])):
            return 0
        spaced = not c or c.isspace()
        i = e
        while i < limit and text[i].isspace():
            i += 1
        n = text[i] if i < limit else ""
        if not n:
            return limit
        if last in STOP_ALWAYS:
            if closed and closed[-1] not in ")）]":
                # Speech at the beginning is followed by its speaker; speech at the end closes the sentence.
                first = text[at:e].lstrip()[:1]
                if not spaced and first in OPEN:
                    return 0
            return e
        if n in ",;:，；、":
            return 0
        if not spaced:
            if closed and not CJK.match(n):
                return 0
            if last in "!?…؟" and (n.isupper() or not n.isascii()) and n.isalpha():
                return e
            if last == "." and n.isupper() and i + 1 < limit and text[i + 1].islower():
                j = mark - 1
                word = text[max(at, j - 40) : j].rpartition(" ")[2].rpartition("\n")[2]
                if len(word) > 2 and word.isalpha() and word[1:].islower() and word.lower() not in self.abbreviations and word.lower() not in NEVER_LAST:
                    return e
                if not closed and word.replace(".", "").replace(",", "").isdigit() and text[at:j].count(" ") > 2:
                    return e
            return 0
        lead = n
        if n in "\"“„«‘'(¿¡「『[":
            lead = text[i + 1 : i + 3].strip()[:1] or n
        if lead.islower() and not (lead == n and text[i + 1 : i + 2].isupper()):  # pH begins a sentence
            # Whole passages in small letters occur; a word that elsewhere stands without a full stop is no abbreviation.
            if closed or lead != n or last == "…":
                return 0
            if last != ".":
                return e if spaced else 0
            j = mark - 1
            word = text[max(at, j - 40) : j].rpartition(" ")[2].rpartition("\n")[2]
            ordinary = len(word) > 3 and word.isalpha() and word.lower() not in self.abbreviations and word.lower() not in NEVER_LAST
            return e if ordinary and (f" {word} " in text or f" {word}," in text) else 0
        if last != ".":
            return e
        j = mark - 1
        if mark - 2 >= at and text[mark - 2] == ".":  # an ellipsis in full stops
            return e
        k = j
        while k > at and not text[k - 1].isspace():
            k -= 1
        token = text[k:j].strip("(\"“„«[‘'¿¡")
        if not token:
            return e
        if "ऀ" <= token[-1] <= "ॿ" and (lead.isascii() or len(token) <= 4):
            return 0  # Devanagari ends sentences with a danda; a full stop abbreviates
        word = token.lower()
        if token.isdigit():
            if len(token) <= 2 and lead.isupper() and 0 < int(token) <= 31:
                before = text[max(at, k - 8) : k].split()
                if before and before[-1].lower() in ORDINAL_BEFORE:
                    return 0
            return e
        if closed:
            return e
        if token.isupper() and len(token) <= 3 and (m := CAPITALS.match(text, i)):
            return 0  # EE. UU., U. S.
        if len(token) == 1 and token.isalpha():
            if token.lower() == token.upper():
                return 0  # scripts without capitals abbreviate to one letter
            if not lead.isupper() and not lead.isdigit():
                return 0
            if token.isupper():
                return self.by_name(text, i, limit, e, seen, token)
        if word in NEVER_LAST and not word[-1:].isdigit() and not self.ordinary(text, token, seen):
            if len(word) > 1 or lead.isdigit() or lead.isupper():
                return 0
        inner = "." in token
        if lead.isdigit():
            return 0 if inner and not token.replace(".", "").isdigit() or self.abbreviation(text, token, seen) else e
        if inner and token.replace(".", "").replace(",", "").isdigit():
            return e
        if inner and len(token) > 7:
            return e
        if inner or len(token) <= 6 and self.abbreviation(text, token, seen):
            return self.by_name(text, i, limit, e, seen, token)
        return e

    @staticmethod
    def closes(text: str, mark: str, e: int, limit: int, seen: dict) -> bool:
        """Whether an open mark is closed in the rest of the block; one that isn't holds nothing together."""
        key = (mark, limit)
        if key not in seen:
            ends = '"' if mark == '"' else "”“" if mark == "„" else OPEN[mark]
            seen[key] = max(text.rfind(c, e, limit) for c in ends)
        return seen[key] >= e

    def abbreviation(self, text: str, token: str, seen: dict) -> bool:
        """Document first: the word with a full stop before a small letter, a digit or a comma; then the corpus."""
        key = ("a", token)
        if key not in seen:
            found = False
            if token.isalpha():
                at = text.find(token + ".")
                while at >= 0:
                    after = text[at + len(token) + 1 : at + len(token) + 4]
                    if (at == 0 or not text[at - 1].isalnum()) and after and (after[0] in ",;" or after[0].isspace() and after[1:2].islower() and not after[2:].isupper()):
                        found = True
                        break
                    at = text.find(token + ".", at + 1)
            seen[key] = found or token.lower() in self.abbreviations
        return seen[key]

    def ordinary(self, text: str, token: str, seen: dict) -> bool:
        """Document before list: whether a listed abbreviation is a word of its own here, which stands without a full stop
        and never as an abbreviation."""
        key = ("o", token)
        if key not in seen:
            found, at = False, text.find(f" {token} ", 1) if len(token) > 1 else -1
            while at >= 0 and not found:
                found = text[at - 1].isalpha() and text[at + len(token) + 2 : at + len(token) + 3].islower()
                at = text.find(f" {token} ", at + 1)
            seen[key] = found and not self.abbreviation(text, token, seen)
        return seen[key]

    @staticmethod
    def inside(text: str, word: str) -> bool:
        """Whether ``word`` stands behind a word in small letters somewhere."""
        at = text.find(f" {word}", 1)
        while at >= 0:
            end = at + 1 + len(word)
            a = at - 1 if text[at - 1] == "," else at
            if text[max(0, a - 3) : a].isalpha() and text[max(0, a - 3) : a].islower() and not text[end : end + 1].isalnum():
                return True
            at = text.find(f" {word}", end)
        return False

    def by_name(self, text: str, i: int, limit: int, e: int, seen: dict, token: str) -> int:
        """After an abbreviation: a name goes on with the sentence, an ordinary word begins another."""
        while i < limit and not text[i].isalnum():
            i += 1
        j = i
        while j < limit and text[j].isalnum():
            j += 1
        word = text[i:j]
        if j < limit and text[j] == "." and len(word) <= 4:
            return 0  # another abbreviation or initial
        if not word[:1].isupper():
            return e if word and not word[0].isdigit() and word[0].lower() == word[0].upper() and len(token) > 1 else 0
        key = ("n", word)
        if key not in seen:
            low = word.lower()
            if f" {low} " in text or f" {low}," in text:
                seen[key] = False
            else:
                # A capital letter in the middle of a sentence tells a name, whatever sentences begin with elsewhere.
                seen[key] = word not in self.starters or self.inside(text, word)
        return 0 if seen[key] else e


def corpus_evidence(df: DataFrame, text: str = "text") -> tuple[frozenset[str], frozenset[str]]:
    """Abbreviations and usual sentence beginnings, counted over all rows of ``df``.

    Each task sends sums; the result keeps only abbreviations of at least ``KNOWN_SHARE`` of all short words with a full
    stop, and beginnings of at least ``STARTER_SHARE`` of all sentences, so it has at most 1 / KNOWN_SHARE + 1 /
    STARTER_SHARE words.
    """

    def make():
        def count(batch: pa.RecordBatch):
            c: Counter = Counter()
            for t in batch.column(0).to_pylist():
                begins = set()
                for m in STOP.finditer(t):
                    at = m.start()
                    follows = NEXT_WORD.match(t, m.end())
                    if not follows:
                        continue
                    quote, nxt = follows.groups()
                    if m[0][0] == "." and "\n" not in m[0] and (short := SHORT_WORD.search(t[max(0, at - 7) : at])):
                        c["a", short[0].lower(), not quote and (nxt[0].islower() and not nxt[1:2].isupper() or nxt[0].isdigit())] += 1
                    if not quote and nxt[0].isupper() and t[max(0, at - 3) : at].isalpha() and at > 2:
                        begins.add(nxt)
                for w in begins:
                    c["s", w, True] += 1
            return [k[0] for k in c], [k[1] for k in c], [k[2] for k in c], list(c.values())

        return count

    sums = cut(map_rows(df.select(text).where(F.col(text).isNotNull()), make, "kind string, word string, open boolean, n bigint").groupBy("kind", "word").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("open"), F.col("n")).otherwise(0)).alias("n_open")), "evidence")
    totals = {r["kind"]: r["n"] for r in sums.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    total = totals.get("s", 0)
    kept = sums.where(((F.col("kind") == "a") & (F.col("n") >= max(3.0, KNOWN_SHARE * totals.get("a", 0))) & (F.col("n_open") >= ABBREVIATION_SHARE * F.col("n"))) | ((F.col("kind") == "s") & (F.col("n") >= max(4.0, STARTER_SHARE * total))))
    rows = kept.select("kind", "word").collect()
    return frozenset(r.word for r in rows if r.kind == "a"), frozenset(r.word for r in rows if r.kind == "s")


def sentence_units(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """Every unit of every text: ``key``, ``start_pos``, ``end_pos`` (exclusive), in characters."""
    abbreviations, starters = corpus_evidence(df, text)

    def make():
        splitter = Splitter(abbreviations, starters)

        def split(batch: pa.RecordBatch):
            ids, starts, ends = [], [], []
            for k, t, g in zip(*(c.to_pylist() for c in batch.columns)):
                units = splitter.units(t, g)
                ids += [k] * len(units)
                starts += [a for a, _ in units]
                ends += [b for _, b in units]
            return ids, starts, ends

        return split

    lang_col = F.col(lang) if lang else F.lit(None).cast("string")
    kind = dict(df.dtypes)[key]
    return map_rows(df.select(F.col(key), F.col(text), lang_col.alias("lang")).where(F.col(text).isNotNull()), make, f"{key} {kind}, start_pos int, end_pos int")
