"""Joins whose keys a few values dominate, dealt over more keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.session import materialize

# Members of a group that meet in one task, and rows of a key that stay together: constants of the plan, not limits.
TILE = 1024
PIECE_ROWS = 50_000


def pairs_within(
    rows: DataFrame,
    group: list[str],
    id_col: str,
    tile: int = TILE,
    keep: Callable[[str, str], Column] | None = None,
    carry: tuple[str, ...] = (),
    emit: Mapping[str, Callable[[str, str], Column]] | None = None,
    notes: DataFrame | None = None,
) -> DataFrame:
    """Distinct unordered pairs ``(id1, id2)``, ``id1 < id2``, of ids that share a group.

    ``keep``, a symmetric condition on the ``carry`` columns of both sides (given the
    prefixes of their names), drops pairs inside the join.  ``emit`` names symmetric
    functions of the two sides that become columns of the pair.  ``notes``, one row of an ``id_col`` each, adds
    columns to ``carry``: only members of groups of more than one are joined with it.

    A group's members are dealt over chunks of about ``tile`` by a hash of the id,
    and each pair of chunks is a join key of its own: a group of any size is
    many small joins, none of more than about ``tile`` squared pairs, and a group
    of one is none.  A member is copied once per chunk of its group.  The
    pair ``distinct`` is a partial + final aggregation.
    """
    if not carry:
        # One shuffle for the sizes and for the join with them: both read the same columns.
        rows = rows.select(id_col, *group).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *group)
    ids = [F.min(id_col).alias("_least"), F.max(id_col).alias("_most")]
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"), *ids).where("_least < _most").drop("_least", "_most")
    member = (
        rows.join(sizes, group)  # the first of the joins: most groups are of one
        .withColumn("_chunks", F.ceil(F.col("_size") / F.lit(float(tile))).cast("int"))
        .withColumn("_chunk", F.pmod(F.xxhash64(id_col), "_chunks").cast("int"))
    )
    if notes is not None:
        member = member.join(notes, id_col)
        carry = (*carry, *[c for c in notes.columns if c != id_col])
    # Both sides of the join read it.
    member = materialize(member.select(id_col, *group, *carry, "_chunks", "_chunk"), "members")
    left = member.select(
        F.col(id_col).alias("_a"), *group, *[F.col(c).alias(f"_a_{c}") for c in carry], F.col("_chunk").alias("_i"),
        F.explode(F.sequence("_chunk", F.col("_chunks") - 1)).alias("_j"),
    )
    right = member.select(
        F.col(id_col).alias("_b"), *group, *[F.col(c).alias(f"_b_{c}") for c in carry], F.col("_chunk").alias("_j"),
        F.explode(F.sequence(F.lit(0), "_chunk")).alias("_i"),
    )
    met = spread_join(left, right, [*group, "_i", "_j"]).where(
        (F.col("_a") != F.col("_b")) & ((F.col("_i") != F.col("_j")) | (F.col("_a") < F.col("_b")))
    )
    if keep is not None:
        met = met.where(keep("_a_", "_b_"))
    also = [made("_a_", "_b_").alias(name) for name, made in (emit or {}).items()]
    return met.select(F.least("_a", "_b").alias("id1"), F.greatest("_a", "_b").alias("id2"), *also).distinct()


def spread_join(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """The equi-join of tiles on ``key``, in as many tasks as the session has shuffle partitions.

    Its work grows with the rows it makes, so small sides must not be put together into few tasks by their bytes.
    """
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return left.repartition(n, *key).join(right.repartition(n, *key), key)


def bucketed(rows: DataFrame, user_col: str, buckets: int) -> DataFrame:
    """``rows`` with ``_bucket``, a hash of the user."""
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(user_col), F.lit(buckets)).cast("int"))


def _heavy(rows: DataFrame, key: list[str], piece_rows: int) -> DataFrame:
    """``key, _buckets``: the keys with more than ``piece_rows`` rows, and how many buckets their rows are dealt over."""
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > piece_rows)
    buckets = F.ceil(F.col("_n") / F.lit(float(piece_rows))).cast("int").alias("_buckets")
    return materialize(counts.select(*key, buckets), "heavy-keys")


def spotted(rows: DataFrame, key: str, by: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``rows`` with ``_bucket``: 0, or for keys of more than ``piece_rows`` rows a hash of ``by``.

    ``repartition(key, "_bucket")`` then brings the rows of a key together, of a heavy one in pieces, so that aggregations by
    key make a partial row for each key or piece and not for each key and task.
    """
    spot = F.pmod(F.xxhash64(by), F.col("_buckets")).cast("int")
    return rows.join(_heavy(rows, [key], piece_rows), key, "left").withColumn("_bucket", F.coalesce(spot, F.lit(0))).drop("_buckets")


def dealt(
    rows: DataFrame, lists: DataFrame, key: list[str], by: str, piece_rows: int = PIECE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``key``, with ``_bucket`` as one more column to join on.

    Only heavy keys, those with more than ``piece_rows`` of ``rows``, are dealt: their rows over buckets by a hash of
    ``by``, each of about ``piece_rows``, and what ``lists`` has for them is copied to each.  For all others the bucket is 0, and
    nothing is copied.  The heavy keys are counted (partial + final) and written: a table of at most
    one row per ``piece_rows`` rows, which Spark broadcasts only if its file is small.
    """
    heavy = _heavy(rows, key, piece_rows)
    spot = F.pmod(F.xxhash64(by), F.col("_buckets")).cast("int")
    left = rows.join(heavy, key, "left").withColumn("_bucket", F.coalesce(spot, F.lit(0))).drop("_buckets")
    every = F.sequence(F.lit(0), F.coalesce(F.col("_buckets"), F.lit(1)) - 1)
    right = lists.join(heavy, key, "left").withColumn("_bucket", F.explode(every)).drop("_buckets")
    return left, right
