"""Dense, sorted ``id -> 0..n-1`` index without a single-partition window.

The ids are range-partitioned and sorted, each row gets its position inside
its partition, and the per-partition row counts (one number per partition,
not per row) turn positions into global offsets.  The numbered table is
written once under the checkpoint directory (see ``materialize``) so the
numbering is computed once and survives executor loss; a re-run of the sort
could place partition boundaries differently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.session import ensure_checkpoint_dir, materialize

_PART = "_part"
_ROW = "_row"


@dataclass(frozen=True)
class Numbered:
    """A table with a gap-free ``pos`` column and its row count."""

    frame: DataFrame
    size: int


def number_rows(
    df: DataFrame, order_cols: list[str], pos_col: str = "pos", num_partitions: int | None = None
) -> Numbered:
    """Add ``pos`` = 0-based rank of each row in the total order ``order_cols``.

    ``order_cols`` must be unique per row (ties get arbitrary but distinct
    positions).  Rows of one key may span several range partitions, so no
    group is forced into one task.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(num_partitions, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_ROW, F.monotonically_increasing_id())
    )
    ranged = materialize(ranged, "numbered")
    counts = sorted(
        (r[_PART], r["count"]) for r in ranged.groupBy(_PART).count().collect()
    )  # one row per partition
    if not counts:
        empty = ranged.drop(_PART, _ROW).withColumn(pos_col, F.lit(None).cast("bigint")).limit(0)
        return Numbered(empty, 0)
    offsets = [0] * (max(p for p, _ in counts) + 1)
    total = 0
    for part, count in counts:
        offsets[part] = total
        total += count
    offset = F.element_at(F.lit(offsets).cast("array<bigint>"), F.col(_PART) + 1)
    local = F.col(_ROW) - F.shiftleft(F.col(_PART).cast("bigint"), 33)
    numbered = ranged.withColumn(pos_col, offset + local).drop(_PART, _ROW)
    return Numbered(numbered, total)


@dataclass(frozen=True)
class DenseIndex:
    """``frame`` has columns ``id, idx``; ``size`` is the number of ids."""

    frame: DataFrame
    size: int


def dense_index(ids: DataFrame, id_col: str, priority: Column | None = None) -> DenseIndex:
    """Distinct values of ``id_col`` numbered ``0..n-1`` in sorted order.

    With ``priority`` (a column of ``ids``, smaller first), ids are ordered by
    ``(min priority, id)``: e.g. training ids first, then ids that only occur
    in validation.
    """
    if priority is None:
        keys = ids.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()).distinct()
        order = ["id"]
    else:
        keys = (
            ids.select(F.col(id_col).alias("id"), priority.alias("_prio"))
            .where(F.col("id").isNotNull())
            .groupBy("id")
            .agg(F.min("_prio").alias("_prio"))
        )
        order = ["_prio", "id"]
    numbered = number_rows(keys, order, pos_col="idx")
    return DenseIndex(numbered.frame.select("id", "idx"), numbered.size)


def union_index(train: DataFrame, other: DataFrame, id_col: str) -> DenseIndex:
    """Index over ``train`` ids first (sorted), then ids only in ``other`` (sorted)."""
    both = train.select(F.col(id_col), F.lit(0).alias("_src")).unionByName(
        other.select(F.col(id_col), F.lit(1).alias("_src"))
    )
    return dense_index(both, id_col, priority=F.col("_src"))


def attach_index(df: DataFrame, index: DenseIndex, id_col: str, idx_col: str = "idx") -> DataFrame:
    """Inner equi-join ``df.id_col = index.id``; adds ``idx_col``.

    The index is a shuffle-join side sized by the data; AQE turns it into a
    broadcast only when its runtime size is under the broadcast threshold.
    """
    idx = index.frame.select(F.col("id").alias(id_col), F.col("idx").alias(idx_col))
    return df.join(idx, id_col)


def rank_within(df: DataFrame, group_cols: list[str], order: list[Column], rank_col: str = "rank") -> DataFrame:
    """1-based rank of each row inside its group under ``order``, for groups of any size.

    Rows are numbered in the global order ``(group_cols, order)`` by a range
    sort, so a huge group spans several tasks; the rank is the row's number
    minus the first number of its group.  ``order`` must make rows unique
    within a group.
    """
    numbered = number_rows(df, [F.col(c) for c in group_cols] + list(order), pos_col="_gpos")
    starts = numbered.frame.groupBy(*group_cols).agg(F.min("_gpos").alias("_gstart"))
    ranked = numbered.frame.join(starts, group_cols)
    return ranked.withColumn(rank_col, F.col("_gpos") - F.col("_gstart") + 1).drop("_gpos", "_gstart")
