"""Exact deduplication by salted combining.

Texts are equal when they are identical after deleting white space.  The work
goes through three stages, each of which compares the full normalised text
beside its SHA-256 digest:

1. Every task combines its own rows (the partial aggregation).
2. Rows of one digest are spread over ``salts`` groups by a hash of the id, so
   that a text which makes up a third of all rows meets in many tasks.
3. The salt winners of a digest, at most ``salts`` per text, are combined.

Then each row learns its group from a join on the digest alone.  A digest
under which stage 3 found several texts is joined on digest and text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import SPACE, keyed_rows, text_of, without_ids
from corate.session import materialize


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _normal(text_col: str) -> Column:
    return F.regexp_replace(text_of(text_col), SPACE, "")


def text_groups(docs: DataFrame, id_col: str, text_col: str, salts: int, digest: Callable[[Column], Column]) -> DataFrame:
    """One row per distinct text: digest, text (null if alone under its digest), keep, group_size."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        _normal(text_col).alias("norm"),
        F.char_length(text_of(text_col)).alias("chars"),
    ).select("*", digest(F.col("norm")).alias("digest"))
    # The least of these is the longest original, then a row with an id, then the smallest id.
    rank = F.struct((-F.col("chars")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("id"))
    salted = (
        rows.withColumn("salt", F.pmod(F.xxhash64("id", "chars"), F.lit(salts)).cast("int"))
        .groupBy("digest", "salt", "norm")
        .agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("size"))
    )
    texts = (
        salted.repartition("digest")
        .groupBy("digest", "norm")
        .agg(F.min("best").alias("best"), F.sum("size").alias("size"))
    )
    alone = F.struct(F.col("best.id").alias("keep"), F.col("size").alias("group_size"), F.col("norm").alias("text"))
    return (
        texts.groupBy("digest")
        .agg(F.collect_list(alone).alias("texts"))
        .select("digest", (F.size("texts") > 1).alias("several"), F.explode("texts").alias("t"))
        .select("digest", "t.keep", "t.group_size", F.when(F.col("several"), F.col("t.text")).alias("text"))
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 64,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, digest.

    Of equal texts the row with the most code points in its original text
    stays, then the smallest id; null ids come last.  A null text is an empty
    one, and all empty texts are equal.  Rows that repeat an id and a text count
    each in group_size and are all kept or all dropped; rows of the keeper's id
    with an equal but shorter text are kept too.  An empty table gives an empty
    result.  Other columns of the input are ignored.
    """
    groups = materialize(text_groups(docs, id_col, text_col, salts, digest), "exact-groups")
    rows = docs.select(F.col(id_col).alias("id"), _normal(text_col).alias("norm")).select(
        "id", digest(F.col("norm")).alias("digest"), "norm"
    )
    several = groups.where("text IS NOT NULL")
    found = rows.select("id", "digest").join(groups.where("text IS NULL").drop("text"), "digest")
    if not several.isEmpty():
        same = (F.col("r.digest") == F.col("g.digest")) & (F.col("r.norm") == F.col("g.text"))
        found = found.unionByName(
            rows.alias("r").join(several.alias("g"), same).select("r.id", "r.digest", "g.keep", "g.group_size")
        )
    return found.select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        "digest",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each text, with all its columns: the keeper's, and of its rows with that text the first by a row key."""
    keyed, key = keyed_rows(docs, id_col)
    rows = exact_groups(keyed, key, text_col, **options)
    return without_ids(keyed, key, rows.where("NOT kept").select(key)).select(*[F.col(f"`{c}`") for c in docs.columns])
