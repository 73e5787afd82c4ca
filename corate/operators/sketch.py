"""Parity bitmaps of baskets: bounds of an intersection from two rows of a few words.

A user flips one of ``64 * words`` bits of its item's bitmap.  Where two bitmaps differ, at least one user is in one
basket only, so ``bit_count(a ^ b)`` never exceeds the symmetric difference and
``(n1 + n2 - bit_count(a ^ b)) / 2`` never falls below the intersection.  Where every user has a bit of
its own, the bound is the intersection.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of a bitmap: constants of the plan.  Fewer are used where the users are fewer than the bits.
SKETCH_WORDS = 8


def sketch_words(universe: int | None, most: int = SKETCH_WORDS) -> int:
    """Words of a bitmap for ``universe`` users (None: not known)."""
    return most if universe is None else max(1, min(most, -(-universe // 64)))


def parity(bit: str, words: int, prefix: str = "w") -> list[Column]:
    """The words of the bitmap, aggregates over the column ``bit``; a null flips nothing."""
    return [F.expr(f"bit_xor(IF({bit} div 64 = {w}, shiftleft(1L, CAST({bit} % 64 AS INT)), 0L))").alias(f"{prefix}{w}") for w in range(words)]


def sketches(d: DataFrame, words: int, index: Column | None = None) -> DataFrame:
    """``item, n, w0 ..``: the size and the bitmap of each item of the distinct ``item, user``.

    ``index`` is a dense index of the user, if there is one; else a hash decides on the bit.
    """
    at = F.xxhash64("user") if index is None else index
    return d.withColumn("_bit", F.pmod(at, F.lit(64 * words))).groupBy("item").agg(F.count(F.lit(1)).alias("n"), *parity("_bit", words))


def sizes_allow(n1: Column, n2: Column, min_sim: float) -> Column:
    return F.least(n1, n2) >= F.lit(float(min_sim)) * F.greatest(n1, n2) - F.lit(1e-9)


def enough(shared: Column, n1: Column, n2: Column, min_sim: float) -> Column:
    """May ``shared`` common users make the pair similar enough?"""
    return shared >= F.lit(min_sim / (1 + min_sim)) * (n1 + n2) - F.lit(1e-9)


def shared_bound(a: str, b: str, words: int, size: str = "n", prefix: str = "w") -> Column:
    """Most users that the items of the two sides (prefixes ``a`` and ``b`` of the columns) can share."""
    differ = reduce(add, [F.bit_count(F.col(f"{a}{prefix}{w}").bitwiseXOR(F.col(f"{b}{prefix}{w}"))) for w in range(words)])
    most = F.shiftright(F.col(f"{a}{size}") + F.col(f"{b}{size}") - differ, 1)
    return F.least(most, F.col(f"{a}{size}"), F.col(f"{b}{size}"))


def may_be_similar(a: str, b: str, words: int, min_sim: float) -> Column:
    n1, n2 = F.col(f"{a}n"), F.col(f"{b}n")
    return sizes_allow(n1, n2, min_sim) & enough(shared_bound(a, b, words), n1, n2, min_sim)


def sketched_candidates(candidates: DataFrame, sk: DataFrame, words: int, min_sim: float) -> DataFrame:
    """The pairs ``id1, id2`` that the sketches ``sk`` leave open."""
    x = sk.select([F.col("item").alias("id1")] + [F.col(c).alias(f"x_{c}") for c in sk.columns if c != "item"])
    y = sk.select([F.col("item").alias("id2")] + [F.col(c).alias(f"y_{c}") for c in sk.columns if c != "item"])
    return candidates.join(x, "id1").join(y, "id2").where(may_be_similar("x_", "y_", words, min_sim)).select("id1", "id2")
