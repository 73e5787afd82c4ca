"""Rating prediction for ``(user, item)`` test keys from a training table.

Each predictor is aggregations plus a ``CASE`` ladder over joins; no
per-row Python.  Output: one row per distinct test key,
``user_id, item_id, prediction``.

Repeated training ratings of one ``(user, item)`` count once (``one_rating``);
``unique=True`` declares that there are none.

Fallback ladder shared by the predictors (first match wins):

1. user unknown in training -> mean rating of the item, else the global mean;
2. no usable neighbour (or only the placeholder) -> mean of the user;
3. weighted sum is 0 (|num| < 1e-9) or weights sum to 0 -> mean of the user;
4. otherwise the method's formula.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.operators.basic import one_rating
from corate.operators.index import attach_index, dense_index
from corate.operators.spread import dealt
from corate.session import materialize

ZERO = 1e-9


def user_stats(train: DataFrame, user_col: str = "user_id", rating_col: str = "rating") -> DataFrame:
    """``user_id, user_mean, user_n, user_sum``."""
    return train.groupBy(F.col(user_col).alias("user_id")).agg(
        F.avg(rating_col).alias("user_mean"),
        F.count(F.lit(1)).alias("user_n"),
        F.sum(rating_col).alias("user_sum"),
    )


def item_stats(train: DataFrame, item_col: str = "item_id", rating_col: str = "rating") -> DataFrame:
    """``item_id, item_mean``."""
    return train.groupBy(F.col(item_col).alias("item_id")).agg(F.avg(rating_col).alias("item_mean"))


def global_mean(train: DataFrame, rating_col: str = "rating") -> Column:
    """Mean training rating as a scalar subquery (computed once by Spark)."""
    return train.select(F.avg(rating_col)).scalar()


def test_keys(test: DataFrame) -> DataFrame:
    return test.select("user_id", "item_id").distinct()


def _cold_start(keys: DataFrame, train: DataFrame) -> DataFrame:
    """Keys with ``user_mean`` (NULL if unknown user) and ``cold`` = item mean, else global mean."""
    with_user = keys.join(user_stats(train).select("user_id", "user_mean"), "user_id", "left")
    with_item = with_user.join(item_stats(train), "item_id", "left")
    return with_item.withColumn("cold", F.coalesce(F.col("item_mean"), global_mean(train))).drop("item_mean")


def predict_item_based(train: DataFrame, test: DataFrame, neighbours: DataFrame, unique: bool = False) -> DataFrame:
    """Weighted average ``|sum w*r(u,j) / sum |w||`` over neighbours ``j`` of the item that ``u`` rated.

    ``neighbours`` is ``target_id, neighbour_id, weight`` (see
    ``neighbour_table``).  The placeholder ``(t, t, 1)`` counts with weight 1
    when ``u`` rated ``t`` in training.  A list holding only the placeholder
    gives the user's mean.
    """
    train = train if unique else one_rating(train)
    # The test rows of an item that very many ask for are dealt, and its list is copied to each bucket.
    nb = neighbours.select(F.col("target_id").alias("item_id"), "neighbour_id", "weight")
    keys, nb = dealt(test_keys(test), nb, ["item_id"], "user_id")
    lists = keys.join(nb, ["item_id", "_bucket"], "left")
    ratings = train.select("user_id", F.col("item_id").alias("neighbour_id"), F.col("rating").alias("_r"))
    rated = lists.join(ratings, ["user_id", "neighbour_id"], "left")
    usable = F.col("_r").isNotNull()
    agg = rated.groupBy("user_id", "item_id").agg(
        F.count("neighbour_id").alias("n_entries"),
        F.max(F.when(F.col("neighbour_id") == F.col("item_id"), 1).otherwise(0)).alias("has_self"),
        F.sum(F.when(usable, F.col("weight") * F.col("_r"))).alias("num"),
        F.sum(F.when(usable, F.abs("weight"))).alias("den"),
    )
    base = _cold_start(agg, train)
    num, den = F.col("num"), F.col("den")
    only_self = (F.col("n_entries") == 1) & (F.col("has_self") == 1)
    prediction = (
        F.when(F.col("user_mean").isNull(), F.col("cold"))
        .when((F.col("n_entries") == 0) | only_self, F.col("user_mean"))
        .when(den.isNull() | (den == 0) | (F.abs(num) < ZERO), F.col("user_mean"))
        .otherwise(F.abs(num / den))
    )
    return base.select("user_id", "item_id", prediction.alias("prediction"))


def predict_user_based(
    train: DataFrame, test: DataFrame, neighbours: DataFrame, include_active: bool = False, unique: bool = False
) -> DataFrame:
    """``mean(u) + sum w*(r(v,i) - mean(v)) / sum |w|`` over neighbours ``v`` of ``u`` who rated ``i``.

    ``neighbours`` is ``target_id`` (a user), ``neighbour_id`` (a user),
    ``weight``.  ``mean(v)`` leaves out ``v``'s rating of ``i``
    (``include_active=True`` keeps it); a neighbour whose only rating is
    ``i`` is then skipped.
    """
    train = train if unique else one_rating(train)
    keys = test_keys(test)
    # Items as codes: a neighbour is a row with those that are asked for, and then with the ratings of them that it has.
    codes = dense_index(keys, "item_id")
    coded = attach_index(keys, codes, "item_id", "_i")
    asked = coded.groupBy("user_id").agg(F.collect_list("_i").alias("_asked"))
    have = attach_index(train, codes, "item_id", "_i").groupBy(F.col("user_id").alias("neighbour_id"))
    have = have.agg(F.collect_list(F.struct("_i", F.col("rating").alias("_r"))).alias("_v"))
    have = have.select("neighbour_id", F.col("_v._i").alias("_items"), F.col("_v._r").alias("_ratings"))
    stats = user_stats(train).select(
        F.col("user_id").alias("neighbour_id"), F.col("user_n").alias("_vn"), F.col("user_sum").alias("_vs")
    )
    nb = neighbours.select(F.col("target_id").alias("user_id"), "neighbour_id", "weight")
    met = nb.join(materialize(asked, "asked"), "user_id").join(materialize(have.join(stats, "neighbour_id"), "have"), "neighbour_id")
    met = met.select("user_id", "weight", "_vn", "_vs", "_items", "_ratings", F.explode("_asked").alias("_i"))
    place = F.expr("CAST(array_position(_items, _i) AS INT)")
    rated = met.withColumn("_place", place).where("_place > 0").withColumn("_r", F.expr("_ratings[_place - 1]"))
    if include_active:
        v_mean = F.col("_vs") / F.col("_vn")
    else:
        v_mean = F.when(F.col("_vn") > 1, (F.col("_vs") - F.col("_r")) / (F.col("_vn") - 1))
    dev = F.col("_r") - v_mean
    usable = v_mean.isNotNull()
    agg = rated.groupBy("user_id", "_i").agg(
        F.sum(F.when(usable, F.col("weight") * dev)).alias("num"),
        F.sum(F.when(usable, F.abs("weight"))).alias("den"),
    )
    agg = agg.join(codes.frame.select(F.col("idx").alias("_i"), F.col("id").alias("item_id")), "_i").drop("_i")
    # Every key, also one without any neighbour that rated the item.
    base = _cold_start(keys.join(agg, ["user_id", "item_id"], "left"), train)
    num, den = F.col("num"), F.col("den")
    prediction = (
        F.when(F.col("user_mean").isNull(), F.col("cold"))
        .when(den.isNull() | (den == 0) | (F.abs(num) < ZERO), F.col("user_mean"))
        .otherwise(F.col("user_mean") + num / den)
    )
    return base.select("user_id", "item_id", prediction.alias("prediction"))


def predict_mean(train: DataFrame, test: DataFrame, unique: bool = False) -> DataFrame:
    """Mean baseline: the item's mean, else the user's mean, else the global mean.

    This is what the reference's user-based case outputs in practice.
    """
    train = train if unique else one_rating(train)
    keys = test_keys(test)
    with_item = keys.join(item_stats(train), "item_id", "left")
    with_user = with_item.join(user_stats(train).select("user_id", "user_mean"), "user_id", "left")
    prediction = F.coalesce(F.col("item_mean"), F.col("user_mean"), global_mean(train))
    return with_user.select("user_id", "item_id", prediction.alias("prediction"))
