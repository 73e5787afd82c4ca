"""Rating and pair tables derived from the driver's parquet tables.

The reference reads a ``user,business,stars`` CSV that is not shipped;
these fixtures give the same shapes from the TPC-H-like tables so that every
query grows with the data.  Definitions mirror ``FIXTURES.md``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _item_key(brand: str = "p_brand", ptype: str = "p_type"):
    return F.concat_ws("|", F.col(brand), F.col(ptype))


def ratings_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-R: customer x (brand|type) ratings 1..5 with a validation flag.

    ``rating = ceil(avg(quantity) / 10)`` in integer arithmetic; ``val = 1``
    for every 50th customer, for the smallest brand|type of ``part`` (a cold
    item) and for about 10 % of the groups by order keys.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")

    cold_item = part.select(F.min(_item_key())).scalar()
    joined = orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey).join(
        part, lineitem.l_partkey == part.p_partkey
    )
    grouped = joined.groupBy("o_custkey", "p_brand", "p_type").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("_qty"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("l_orderkey").alias("_okeys"),
    )
    item = _item_key()
    return grouped.select(
        F.col("o_custkey").alias("user_id"),
        item.alias("item_id"),
        F.expr("CAST((_qty + 10 * _n - 1) div (10 * _n) AS INT)").alias("rating"),
        F.when(
            (F.col("o_custkey") % 50 == 0) | (item == cold_item) | (F.col("_okeys") % 10 == 0), 1
        )
        .otherwise(0)
        .alias("val"),
    )


def split_ratings(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, validation) from a fixture with a ``val`` flag; rating as DOUBLE."""
    cols = ["user_id", "item_id", F.col("rating").cast("double").alias("rating")]
    train = ratings.where(F.col("val") == 0).select(*cols)
    validation = ratings.where(F.col("val") == 1).select(*cols)
    return train, validation


def repeated_ratings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(lines, validation): a rating per purchase line, many of one (user, item), and F-R's validation part.

    A line's rating is its quantity in tens, rounded up.  Lines of validation keys are among them.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    lines = (
        orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
        .select(
            F.col("o_custkey").alias("user_id"),
            _item_key().alias("item_id"),
            F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"),
        )
    )
    return lines, split_ratings(ratings_fixture(spark, sf_dir))[1]


def purchases_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-P: customer x part ratings, same rating rule, for ALS at scale."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    grouped = (
        orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey)
        .groupBy("o_custkey", "l_partkey")
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("_qty"),
            F.count(F.lit(1)).alias("_n"),
            F.sum("l_orderkey").alias("_okeys"),
        )
    )
    return grouped.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.expr("CAST((_qty + 10 * _n - 1) div (10 * _n) AS INT)").alias("rating"),
        F.when((F.col("o_custkey") % 50 == 0) | (F.col("_okeys") % 10 == 0), 1)
        .otherwise(0)
        .alias("val"),
    )


def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-D: distinct ``(token, doc_id)`` pairs; token = a run of letters and digits of any script, lower-cased.

    The whole text of every document is tokenised.  Where no id comes twice, the tokens of a text are told apart in its row
    and none is shuffled.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # maximal runs of letters and digits: split on everything else, drop the empty edges
    words = F.split(F.lower("text"), r"[^\p{L}\p{N}]+")
    rows, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    once = rows == ids
    tokens = docs.select(F.col("doc_id").alias("item_id"), F.explode(F.array_distinct(words)).alias("user_id")).where(F.col("user_id") != "")
    tokens = tokens.select("user_id", "item_id")
    return tokens if once else tokens.distinct()


def event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-E: distinct ``(k, user_id)`` pairs from the ``events`` JSON props (dense baskets)."""
    events = table(spark, sf_dir, "events").select("user_id", "props")
    return (
        events.select(
            F.get_json_object("props", "$.k").cast("bigint").alias("user_id"),
            F.col("user_id").alias("item_id"),
        )
        .where(F.col("user_id").isNotNull())
        .distinct()
    )
