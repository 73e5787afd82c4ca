"""Closed-form co-rating similarity from pair moments.

For a target ``a`` and a neighbour ``o`` rated by ``n`` common raters, with
``sa = sum a``, ``so = sum o``, ``sao = sum a*o``, ``saa = sum a^2``,
``soo = sum o^2``::

    N  = n*sao - sa*so
    D1 = n*saa - sa^2
    D2 = n*soo - 2*sa*so + sa^2   (center="active": both deviations from mean(a))
    D2 = n*soo - so^2             (center="own": Pearson correlation)
    sim = N / (sqrt(D1) * sqrt(D2))

The similarity is undefined (NULL) when ``n < 2``, ``N = 0`` or a
denominator is 0.  The zero tests are exact on the moments, not on the
quotient.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTERS = ("active", "own")


def corated_similarity(
    n: Column, sa: Column, so: Column, sao: Column, saa: Column, soo: Column, center: str = "active"
) -> Column:
    if center not in CENTERS:
        raise ValueError(f"center must be one of {CENTERS}, got {center!r}")
    num = n * sao - sa * so
    d1 = n * saa - sa * sa
    if center == "active":
        d2 = n * soo - F.lit(2.0) * sa * so + sa * sa
    else:
        d2 = n * soo - so * so
    value = num / (F.sqrt(d1) * F.sqrt(d2))
    return F.when((n >= 2) & (num != 0) & (d1 > 0) & (d2 > 0), value)


def jaccard(intersection: Column, size1: Column, size2: Column) -> Column:
    """``|A n B| / |A u B|`` from the intersection and the two set sizes."""
    return intersection.cast("double") / (size1 + size2 - intersection).cast("double")
