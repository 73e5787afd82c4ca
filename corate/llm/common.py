"""Helpers shared by the corpus operators.

Conventions that hold for every operator:

* A null text counts as an empty one.
* Extra input columns pass through or are ignored; where an operator adds
  columns to its input, an input column of the same name is replaced.
* Rows that repeat an id and its text are one document and get the same result.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corate.operators.index import number_rows
from corate.session import materialize

# White space of the contracts, as a regular expression of both engines.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no column of ``frames`` is called so (in any case)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_columns_last(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns, replacing any of the same name (in any case) in ``df``."""
    names = {c.lower() for c in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    return df.select(*kept, *[c.alias(n) for n, c in columns.items()])


def bounded_sample(df: DataFrame, label: str, per_label: int, key: str, seed: int) -> DataFrame:
    """At most ``per_label`` rows of each label, the same ones in every run.

    A count of the labels (which are few) sets the range of a hash of the key that
    holds about twice as many rows as wanted; only those are ranked.  So no
    task sees more than some 2 * per_label rows of a label, however many there are.
    """
    counts = {k: n for k, n in df.groupBy(label).count().collect() if k is not None}
    if not counts:
        return df.where(F.lit(False))
    spot = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 24)  # 40 bits
    parts = [F.struct(F.lit(k), F.lit(min(1 << 40, (2 * per_label + 100 << 40) // n))) for k, n in sorted(counts.items())]
    limits = F.map_from_entries(F.array(*parts))
    order = Window.partitionBy(label).orderBy("_spot", F.col(key))
    return (
        df.withColumn("_spot", spot)
        .where(F.col("_spot") < F.element_at(limits, F.col(label)))
        .withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") <= per_label)
        .drop("_nth", "_spot")
    )


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within the block jobs hand Python at most ``rows`` rows at once, so that a batch of texts is small on both sides.

    For steps that run inside the block (those that are written), not for plans that outlive it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df``, written and counted: marked for broadcast if it has at most ``rows`` rows, else left to a shuffle join."""
    df = materialize(df, "small-side")
    return F.broadcast(df) if df.count() <= rows else df


def without_ids(docs: DataFrame, id_col: str, gone: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows whose id is in the one column of ``gone`` (null is an id too).

    Up to ``broadcast_rows`` ids go to every task, so that the texts stay where
    they are; more are joined by a shuffle.
    """
    name = fresh("_gone", docs)
    gone = small_side(gone.toDF(name).distinct(), broadcast_rows)
    return docs.join(gone, docs[id_col].eqNullSafe(F.col(name)), "left_anti")


def keyed_rows(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """``docs`` and the column that tells its rows apart: ``id_col``, or a new one if ids repeat or are null.

    Row keys follow the ids, null ones last, then a hash of the row.  Only a table that needs
    them is written with them; of the others the ids alone are shuffled.
    """
    found = docs.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_rows"))
    if found.where("_id IS NULL OR _rows > 1").isEmpty():
        return docs, id_col
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    # The row as one column, so that no name of the numbering can clash with one of its own.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).isNull().alias("no_id"),
        F.col(id_col).alias("id"),
        F.xxhash64(*hashed).alias("hash"),
        F.monotonically_increasing_id().alias("at"),
    )
    rows = materialize(rows, "rows")
    key = fresh("_row_key", docs)
    keyed = number_rows(rows, ["no_id", "id", "hash", "at"], "place").frame
    return keyed.select("row.*", F.col("place").alias(key)), key


# --- texts of an Arrow batch as flat byte arrays ---------------------------

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, limit: int = 1 << 18):
    """Yield (first row, bytes, offsets) for runs of rows of about ``limit`` bytes.

    A run holds whole texts, at least one; a null text has no bytes.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


class Words:
    """The words (runs of non-space bytes) of several texts.

    ``start``, ``length``: position of each word in the bytes; ``doc``: its
    text; ``first``: for each text the index of its first word, plus the total.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACES):
        """``between``: which of the 256 bytes part words."""
        self.data, self.n_docs = data, len(offsets) - 1
        inside = ~between[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edge = offsets[1:-1]
        edge = edge[edge < len(data)]
        begins[edge] = inside[edge]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        last = edge[edge > 0] - 1
        ends[last] = inside[last]
        self.start = np.flatnonzero(begins)
        self.length = np.flatnonzero(ends) + 1 - self.start
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(self.first))

    def hashes(self, fold: np.ndarray = LOWER, upto: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first ``upto`` bytes, after mapping its bytes by ``fold``."""
        if len(self.start) == 0:
            return np.empty(0, np.uint64)
        length = self.length if upto is None else np.minimum(self.length, upto)
        begin = np.cumsum(length) - length
        within = np.arange(length.sum()) - np.repeat(begin, length)
        at = within + np.repeat(self.start, length)
        power = np.multiply.accumulate(np.full(int(length.max()), _STEP, np.uint64))
        return mix(np.add.reduceat(_BYTE[fold[self.data[at]]] * power[within], begin))


def distinct_per_doc(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (doc, key) pairs, by doc and key."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return doc[new], key[new]
