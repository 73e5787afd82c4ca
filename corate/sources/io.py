"""CSV sources and sinks for rating and pair files.

Input files are ``user,item,stars`` with one header line.  The sinks write a
directory of CSV part files (distributed), never a single file on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corate.session import materialize

RATING_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("item_id", T.StringType(), False),
        T.StructField("rating", T.DoubleType(), False),
    ]
)

PAIR_SCHEMA = T.StructType(
    [
        T.StructField("id1", T.StringType(), False),
        T.StructField("id2", T.StringType(), False),
    ]
)

# Output headers of the reference's files.
PAIR_HEADER = ("business_id_1", "business_id_2", "similarity")
PREDICTION_HEADER = ("user_id", "business_id", "prediction")


def _csv(spark: SparkSession, mode: str):
    return (
        spark.read.option("header", True)
        .option("mode", mode)
        .option("quote", '"')
        .option("escape", '"')
    )


def _without_header_lines(raw: DataFrame) -> DataFrame:
    """Drop every row equal to the header (files concatenated with their headers)."""
    same = None
    for name in raw.columns:
        cond = F.col(f"`{name}`") == F.lit(name)
        same = cond if same is None else same & cond
    return raw.where(~same) if same is not None else raw


def _raw(spark: SparkSession, path: str, mode: str) -> DataFrame:
    """All columns as strings (no inference pass), header lines removed."""
    return _without_header_lines(_csv(spark, mode).csv(path))


def read_ratings(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """``user_id, item_id, rating`` from the first three columns of a CSV with header.

    Quoted fields keep embedded commas (one id, not two columns).  Lines equal
    to the header are dropped wherever they occur.  A rating that is not a
    number fails the job (whatever the session's ANSI setting).
    """
    raw = _raw(spark, path, mode)
    user, item, stars = raw.columns[0], raw.columns[1], raw.columns[2]
    parsed = F.col(f"`{stars}`").try_cast("double")
    rating = F.when(
        F.col(f"`{stars}`").isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit("malformed rating: "), F.col(f"`{stars}`"))),
    ).otherwise(parsed)
    return raw.select(
        F.col(f"`{user}`").alias("user_id"), F.col(f"`{item}`").alias("item_id"), rating.cast("double").alias("rating")
    )


def read_pairs(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """First two columns of a CSV with header, as ``user_id, item_id`` strings.

    Further columns are ignored; lines equal to the header are dropped.  Every
    column is read as a string, so no schema inference pass runs over the data.
    """
    raw = _raw(spark, path, mode)
    first, second = raw.columns[0], raw.columns[1]
    return raw.select(F.col(f"`{first}`").alias("user_id"), F.col(f"`{second}`").alias("item_id"))


# Why a line of a file is set aside.
BAD_FIELDS, BAD_ID, BAD_RATING = "fields", "id", "rating"


@dataclass(frozen=True)
class Ingest:
    """What a tolerant read kept, and its counts: of all lines (headers apart), and of those set aside by reason."""

    rows: DataFrame
    n_lines: int
    n_bad: dict[str, int]


def _tagged(spark: SparkSession, path: str, names: list[str], rated: bool) -> DataFrame:
    """The first columns of every line as ``names``, with ``reason`` (null: good) and ``line`` (the text of a bad one).

    A line is bad if it has more or fewer fields than the header, if one of ``names`` is missing, or if
    the rating is not a number.  Spark hands over the text of a line only where the number of fields is off; for the others it
    is put together again from the fields.
    """
    header = _csv(spark, "PERMISSIVE").csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, "_line"]])
    raw = _csv(spark, "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").option("enforceSchema", False).schema(schema).csv(path)
    again = F.col("_line").isNull()
    for name in header:
        again = again & F.col(f"`{name}`").eqNullSafe(F.lit(name))
    fields = [F.col(f"`{c}`") for c in header]
    columns = [f.alias(n) for f, n in zip(fields, names, strict=False)]
    missing = F.coalesce(F.trim(fields[0]), F.lit("")) == ""
    missing = missing | (F.coalesce(F.trim(fields[1]), F.lit("")) == "")
    reason = F.when(F.col("_line").isNotNull(), BAD_FIELDS).when(missing, BAD_ID)
    if rated:
        columns[2] = fields[2].try_cast("double").alias(names[2])
        reason = reason.when(fields[2].try_cast("double").isNull(), BAD_RATING)
    line = F.coalesce(F.col("_line"), F.array_join(F.array(*fields), ",", ""))
    return raw.where(~again).select(*columns, reason.alias("reason"), F.when(reason.isNotNull(), line).alias("line"))


def _ingest(spark: SparkSession, path: str, quarantine: str, names: list[str], rated: bool) -> Ingest:
    seen = Observation()
    reasons = [BAD_FIELDS, BAD_ID, *([BAD_RATING] if rated else [])]
    tagged = _tagged(spark, path, names, rated).observe(
        seen, F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("reason") == r).alias(r) for r in reasons]
    )
    tagged = materialize(tagged, "ingested")  # the file is parsed once; the counts are taken on the way
    tagged.where("reason IS NOT NULL").select("reason", "line").write.mode("overwrite").json(quarantine)
    counts = seen.get
    return Ingest(tagged.where("reason IS NULL").select(*names), counts["n"], {r: counts[r] for r in reasons})


def ingest_ratings(spark: SparkSession, path: str, quarantine: str) -> Ingest:
    """``read_ratings`` that bad lines do not end: they are written to ``quarantine`` as JSON (reason, line).

    One pass over the file.  The counts are observed by the tasks that write the parsed table; nothing is
    collected but them.
    """
    return _ingest(spark, path, quarantine, ["user_id", "item_id", "rating"], True)


def ingest_pairs(spark: SparkSession, path: str, quarantine: str) -> Ingest:
    """``read_pairs`` in the same way."""
    return _ingest(spark, path, quarantine, ["user_id", "item_id"], False)


def read_truth_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Ground-truth pair file ``id1, id2`` (header, extra columns ignored)."""
    pairs = read_pairs(spark, path)
    return pairs.select(F.col("user_id").alias("id1"), F.col("item_id").alias("id2"))


def write_pairs(pairs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scored pairs sorted by ``(id1, id2)`` under the reference's header."""
    out = pairs.orderBy("id1", "id2").select(
        F.col("id1").alias(PAIR_HEADER[0]),
        F.col("id2").alias(PAIR_HEADER[1]),
        F.col("similarity").alias(PAIR_HEADER[2]),
    )
    out.write.mode(mode).option("header", True).csv(path)


def write_predictions(predictions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Predictions rounded to two decimals under the reference's header."""
    out = predictions.select(
        F.col("user_id").alias(PREDICTION_HEADER[0]),
        F.col("item_id").alias(PREDICTION_HEADER[1]),
        F.round("prediction", 2).alias(PREDICTION_HEADER[2]),
    )
    out.write.mode(mode).option("header", True).csv(path)
