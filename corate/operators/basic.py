"""Role swap, the validation leak guard and the rule for repeated ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def swap_roles(df: DataFrame, user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Exchange the user and item columns (user-based CF is item-based CF on swapped input)."""
    rest = [c for c in df.columns if c not in (user_col, item_col)]
    return df.select(F.col(item_col).alias(user_col), F.col(user_col).alias(item_col), *rest)


def exclude_pairs(
    train: DataFrame, other: DataFrame, user_col: str = "user_id", item_col: str = "item_id"
) -> DataFrame:
    """Training rows whose ``(user, item)`` does not occur in ``other`` (anti equi-join)."""
    keys = other.select(user_col, item_col)
    return train.join(keys, [user_col, item_col], "left_anti")


def one_rating(
    ratings: DataFrame, user_col: str = "user_id", item_col: str = "item_id", rating_col: str = "rating"
) -> DataFrame:
    """One rating per ``(user, item)``: of repeated ones the highest, whatever their order.  Other columns go."""
    return ratings.groupBy(user_col, item_col).agg(F.max(rating_col).alias(rating_col))
