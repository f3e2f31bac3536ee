"""Vector column functions: feature hashing and dot products (V2).

Vectors are sparse pairs ``dims ARRAY<INT>`` (sorted, unique) and ``ws
ARRAY<DOUBLE>`` (unit length). Dense products run in numpy inside tasks
(see operators/blocks.py).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed hashing rule (also written in the DuckDB oracle): the first 7 hex
# digits of md5(feature) give the dimension (mod size); the 8th hex digit
# gives the sign (0-7 -> +1, 8-f -> -1).


def hash_dim(feature: Column, size: int) -> Column:
    h = F.conv(F.substring(F.md5(feature), 1, 7), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(size)).cast("int")


def hash_sign(feature: Column) -> Column:
    return F.when(F.substring(F.md5(feature), 8, 1) < F.lit("8"), F.lit(1.0)).otherwise(F.lit(-1.0))


def dense_dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """V2 on raw dense vectors (e.g. ARRAY<FLOAT>): accumulate in DOUBLE,
    zero norm gives 0."""
    a = F.transform(a, lambda x: x.cast("double"))
    b = F.transform(b, lambda x: x.cast("double"))
    na = F.sqrt(dense_dot(a, a))
    nb = F.sqrt(dense_dot(b, b))
    return F.when((na > 0) & (nb > 0), dense_dot(a, b) / (na * nb)).otherwise(F.lit(0.0))


def trigrams(term: Column) -> Column:
    """Character trigrams of '#' + term + '#'; '' gives none."""
    p = F.concat(F.lit("#"), term, F.lit("#"))
    n = F.length(p) - 2
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(p, i, 3))).otherwise(
        F.array().cast("array<string>"))
