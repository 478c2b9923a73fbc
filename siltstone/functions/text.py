"""Text expressions. All are built-in column expressions; null texts follow the rules named at each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_CHARS = r"[\p{L}\p{N}_]+"
URL = r"https?://\S+|www\.\S+"


def strip(text: Column) -> Column:
    """``text`` without Unicode white space at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def clean_text(text: Column, min_chars: int = 10, max_chars: int | None = 100_000, whitespace: bool = True, urls: bool = False, keep_paragraphs: bool = False) -> Column:
    """White space collapsed, URLs dropped on demand, texts under ``min_chars`` emptied, cut at ``max_chars`` if given; null gives ''."""
    t = F.coalesce(text, F.lit(""))
    if whitespace:
        if keep_paragraphs:
            t = strip(F.regexp_replace(F.regexp_replace(t, r"(?U)[ \t\x0B\f\r ]+", " "), r"\s*\n\s*\n\s*", "\n\n"))
        else:
            t = F.trim(F.regexp_replace(t, r"(?U)\s+", " "))
    if urls:
        t = F.regexp_replace(t, URL, "")
    return F.when(F.length(t) < min_chars, "").otherwise(t if max_chars is None else F.substring(t, 1, max_chars))


def strip_tags(text: Column) -> Column:
    """``text`` without tags."""
    return F.regexp_replace(text, "<[^>]+>", "")


def token_estimate(text: Column) -> Column:
    """A quarter of the characters, whole; null gives null."""
    return F.floor(F.length(text) / 4)


def words(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores; null gives an empty array."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD_CHARS})"), 1)


def split_words(text: Column) -> Column:
    """Words between white space; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(split_words(text))


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` tokens, joined by spaces; fewer tokens give an empty array."""
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1)))


def suffix(path: Column) -> Column:
    """The lower-case suffix with its dot, or ''."""
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))


# Suffixes by kind of file.
TEXT_SUFFIXES = (".txt", ".md", ".pdf", ".doc", ".docx", ".json", ".jsonl", ".csv", ".html")
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".webp")


def file_type(path: Column) -> Column:
    """``text``, ``image`` or null by suffix."""
    return F.when(suffix(path).isin(*TEXT_SUFFIXES), "text").when(suffix(path).isin(*IMAGE_SUFFIXES), "image")


def around(text: Column, start: Column, end: Column, margin: int = 100) -> Column:
    """``margin`` characters on both sides of the span [start, end), counted from 0."""
    lo = F.greatest(F.lit(0), start - margin)
    return F.substring(text, lo + 1, end + margin - lo)


# Rules over laid-out pages; spans are struct<text, font, size, flags, origin array<double>>.


def is_heading(span: Column) -> Column:
    return ((span["size"] > 12) & (span["flags"].bitwiseAND(8) != 0)) | (span["size"] > 14)


def is_list_item(text: Column) -> Column:
    return F.ltrim(text).rlike(r"^(?:[•●○▪◦\-]|\d+\.)")


def is_table_block(xs: Column) -> Column:
    """More than two distinct columns (places to 0.1), each more than 5 apart."""
    s = F.array_sort(F.array_distinct(F.transform(xs, lambda x: F.round(x, 1))))
    gaps = F.when(F.size(s) > 1, F.zip_with(F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(1))), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(1))), lambda b, a: b - a)).otherwise(F.array().cast("array<double>"))
    return (F.size(s) > 2) & F.forall(gaps, lambda g: g > 5)
