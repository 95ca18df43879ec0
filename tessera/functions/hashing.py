"""Reproducible hashing and pseudo-random numbers as column expressions.

Every random number in an exactly-checked job comes from ``md5`` of a
string key, so the same value can be recomputed by any SQL engine
(``('0x' || substr(md5(s), 1, k))::BIGINT`` in DuckDB).  ``rand()`` is never
used: it depends on partitioning and is not reproducible after a retry.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Shingle / element ids are 60 bits (15 hex digits of md5): non-negative in a
# bigint, and apart for any number of distinct shingles that a cluster can hold.
ID_DIGITS = 15
# MinHash values are the top 61 bits of a 64-bit multiply-add.
HASH_MAX = (1 << 61) - 1


def _key(*parts) -> Column:
    return F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def hex_int(s: Column, digits: int) -> Column:
    """First ``digits`` hex digits of md5(s) as a non-negative bigint."""
    return F.conv(F.substring(F.md5(s), 1, digits), 16, 10).cast("bigint")


def id60(s: Column) -> Column:
    """60-bit id of a string (shingle ids)."""
    return hex_int(s, ID_DIGITS)


def uniform(*parts) -> Column:
    """U(0,1), open interval, from md5 of ``seed:...`` (52 bits of mantissa)."""
    return (hex_int(_key(*parts), 13).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def gaussian(*parts) -> Column:
    """Standard normal by Box-Muller from two md5 uniforms."""
    u1 = uniform(*parts, "g1")
    u2 = uniform(*parts, "g2")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


# ---- driver-side twins (for model-sized constants only) -------------------

def py_hex_int(s: str, digits: int) -> int:
    return int(hashlib.md5(s.encode("utf-8")).hexdigest()[:digits], 16)


def py_uniform(*parts) -> float:
    return (py_hex_int(":".join(str(p) for p in parts), 13) + 0.5) / float(2 ** 52)


def py_gaussian(*parts) -> float:
    u1 = py_uniform(*parts, "g1")
    u2 = py_uniform(*parts, "g2")
    return math.sqrt(-2.0 * math.log(u1)) * math.cos(2 * math.pi * u2)


def hash_coefficients(n: int, seed: int, tag: str = "mh") -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of n hashes h_i(x) = ((a_i x + b_i) mod 2^64) >> 3, a_i odd.

    SQL twin: ``a = 2 * hex15(seed:tag:a:i) + 1``, ``b = hex15(seed:tag:b:i)``.
    """
    a = np.array([2 * py_hex_int(f"{seed}:{tag}:a:{i}", ID_DIGITS) + 1 for i in range(n)], dtype=np.uint64)
    b = np.array([py_hex_int(f"{seed}:{tag}:b:{i}", ID_DIGITS) for i in range(n)], dtype=np.uint64)
    return a, b


def gaussian_matrix(rows: int, cols: int, seed: int, tag: str) -> np.ndarray:
    """rows x cols standard normals keyed by (seed, tag, i, j); SQL-reproducible."""
    return np.array([[py_gaussian(seed, tag, i, j) for j in range(cols)] for i in range(rows)])


def uniform_vector(n: int, seed: int, tag: str) -> np.ndarray:
    return np.array([py_uniform(seed, tag, i) for i in range(n)])
