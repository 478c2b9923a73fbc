"""Text to vectors behind one interface, and cosines of vectors as column expressions.

An embedder maps a list of texts to one vector each. ``Hashing`` needs no model; ``Encoder`` runs one that the caller
loads, once a process. Vectors are ``array<double>`` columns, so everything that takes vectors takes them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.arrow import map_rows, tokens

Embedder = Callable[[list], list]


@dataclass(frozen=True)
class Hashing:
    """Signed sums of hashed words: the first seven hex digits of a word's MD5 give its place, the eighth its sign."""

    dimensions: int = 64

    def __call__(self, texts: list) -> list:
        return [self.one(t) for t in texts]

    def one(self, text: str | None) -> list[float]:
        v = [0.0] * self.dimensions
        for w in tokens(text):
            h = hashlib.md5(w.encode(), usedforsecurity=False).hexdigest()
            v[int(h[:7], 16) % self.dimensions] += 1.0 if int(h[7], 16) % 2 == 0 else -1.0
        return v


@dataclass(frozen=True)
class Encoder:
    """A sentence encoder: ``load()`` gives a function from texts to vectors, once a process."""

    name: str
    load: Callable[[], Callable[[list], list]]

    def __call__(self, texts: list) -> list:
        from siltstone.models.clients import shared

        return [list(map(float, v)) for v in shared(self.name, self.load)(["" if t is None else t for t in texts])]


def embedded(df: DataFrame, text: str, embedder: Embedder = Hashing(), into: str = "vector") -> DataFrame:
    """``df`` with the vector of ``text``; null texts are embedded like empty ones."""
    kept = [c for c in df.columns if c != into]
    kinds = dict(df.dtypes)

    def make():
        def f(*columns):
            return *columns, embedder(columns[kept.index(text)])

        return f

    return map_rows(df.select(*kept), make, ", ".join(f"`{c}` {kinds[c]}" for c in kept) + f", `{into}` array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 if one is zero."""
    return F.coalesce(dot(a, b) / F.nullif(F.sqrt(dot(a, a) * dot(b, b)), F.lit(0.0)), F.lit(0.0))
