"""MinHash family and hash expressions.

A hash function is a triple ``(a, b, p)`` applied to a dense user index ``x``
as ``((a * x + b) mod p) mod m`` where ``m`` is the size of the user universe.
The family is data: every LSH operator takes it as a parameter.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default LSH shape and family parameters.
# 120 hash functions in 40 bands of 3 rows; family drawn from random.Random(42)
# with prime p = 2**31 - 1, a in [1, p), b in [0, p).
DEFAULT_NUM_HASHES = 120
DEFAULT_BANDS = 40
DEFAULT_ROWS = 3
DEFAULT_SEED = 42
DEFAULT_PRIME = 2**31 - 1

# Most hash functions that ``lsh_shape`` spends, and signature columns of one aggregation (``codegen.maxFields``).
MAX_HASHES = 800
CHUNK_HASHES = 120

# a * x + b stays inside BIGINT while x < 2**32 (with a, b < 2**31).
MAX_INDEX = 2**32


def hash_family(
    num_hashes: int = DEFAULT_NUM_HASHES, seed: int = DEFAULT_SEED, prime: int = DEFAULT_PRIME
) -> list[tuple[int, int, int]]:
    """``num_hashes`` triples ``(a, b, p)`` from a seeded generator."""
    rng = random.Random(seed)
    family = []
    for _ in range(num_hashes):
        a = rng.randrange(1, prime)
        b = rng.randrange(0, prime)
        family.append((a, b, prime))
    return family


@dataclass(frozen=True)
class Shape:
    """Bands of rows of a signature.  Two items of similarity s share a band with probability 1 - (1 - s**rows)**bands."""

    bands: int
    rows: int

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def recall(self, similarity: float) -> float:
        return 1 - (1 - similarity**self.rows) ** self.bands


def lsh_shape(min_sim: float, recall: float = 0.98, max_hashes: int = MAX_HASHES) -> Shape:
    """The shape with the most rows a band, so the fewest candidates, that finds a pair at ``min_sim`` with probability ``recall``.

    Each row more divides the chance of an unrelated pair and asks for about 1 / min_sim times as many hashes;
    more than ``max_hashes`` are not spent.  One row a band always does.
    """
    if not 0 < min_sim <= 1 or not 0 < recall < 1:
        raise ValueError("min_sim must be in (0, 1] and recall in (0, 1)")
    rows, best = 1, None
    while True:
        miss = 1 - min_sim**rows
        bands = 1 if miss <= 0 else math.ceil(math.log(1 - recall) / math.log(miss))
        if best is not None and (bands * rows > max_hashes or min_sim == 1):
            return best
        best, rows = Shape(bands, rows), rows + 1


def signature_columns(index_col: str, family, m: int) -> list[Column]:
    """One ``min`` aggregate per hash function, named ``h0 .. h{n-1}``.

    Built from SQL expression text: one call per column instead of a dozen
    Column operations each, which keeps plan construction fast for 120 hashes.
    """
    return [
        F.expr(
            f"min(((CAST({a} AS BIGINT) * {index_col} + CAST({b} AS BIGINT)) % CAST({p} AS BIGINT))"
            f" % CAST({m} AS BIGINT))"
        ).alias(f"h{i}")
        for i, (a, b, p) in enumerate(family)
    ]


def band_array(num_hashes: int, bands: int, rows: int) -> Column:
    """Array of ``bands`` structs ``(r0 .. r{rows-1})`` over the signature columns."""
    if bands * rows > num_hashes:
        raise ValueError(f"{bands} bands x {rows} rows needs {bands * rows} hashes, have {num_hashes}")
    structs = ", ".join(
        "struct(" + ", ".join(f"h{band * rows + r} AS r{r}" for r in range(rows)) + ")" for band in range(bands)
    )
    return F.expr(f"array({structs})")


def band_hashes(bands: int, rows: int, first: int = 0) -> Column:
    """Array of one 64-bit hash a band, of its number (from ``first`` on) and its rows of the signature columns."""
    keys = (", ".join(f"h{band * rows + r}" for r in range(rows)) for band in range(bands))
    return F.expr("array(" + ", ".join(f"xxhash64({first + b}, {k})" for b, k in enumerate(keys)) + ")")
