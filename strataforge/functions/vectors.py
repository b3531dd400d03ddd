"""Vectors: a deterministic hash vector, cosine similarity and checks."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

SIZE = 64
MODEL = "hash-v1"


def hash_vector(text: Column, size: int = SIZE) -> Column:
    """Bytes of the text's SHA-256, of that digest's and so on, each divided by 255 and rounded to six digits. A lambda's
    variable holds the digests, so each is computed once a row (measured faster than 64 written-out elements)."""
    digests = [F.sha2(text, 256)]
    while len(digests) * 32 < size:
        digests.append(F.sha2(F.unhex(digests[-1]), 256))

    def values(hexes: Column) -> Column:
        byte = lambda i: F.conv(F.substring(hexes, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
        return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.round(byte(i) / F.lit(255.0), 6))

    return F.transform(F.array(F.concat(*digests)), values)[0]


def hash_vector_of(text: str, size: int = SIZE) -> list[float]:
    """The same for a text at hand."""
    digest, out = hashlib.sha256(text.encode()).digest(), []
    while len(out) < size:
        out += [round(b / 255, 6) for b in digest]
        digest = hashlib.sha256(digest).digest()
    return out[:size]


def cosine_to(vector: Column, query: list[float]) -> Column:
    """The cosine to a query that is at hand: a literal on one side, its norm a constant."""
    norm = sum(q * q for q in query) ** 0.5
    if not norm:
        return F.lit(0.0)
    own = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    usable = (F.size(vector) == len(query)) & (own > 0)
    return F.when(usable, dot(vector, F.array(*(F.lit(float(q)) for q in query))) / (own * F.lit(norm))).otherwise(F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 for empty vectors, unequal lengths and zero norms."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    usable = (F.size(a) == F.size(b)) & (F.size(a) > 0)
    return F.when(usable & (norms > 0), dot(a, b) / norms).otherwise(F.lit(0.0))


def not_finite(vector: Column) -> Column:
    """Whether any value is null, not a number or infinite."""
    return F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
