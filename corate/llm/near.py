"""MinHash near-deduplication by bottom-k sketches from one hash function.

A document's set is its distinct word shingles; one hash function gives each
shingle a 64-bit value, and the sketch retains the ``k`` smallest.

1. Documents with equal sets form a class, which goes on as one node.
2. Each retained value has an inverted list of the classes that retain it.  Two
   sets of the similarity sought share at least ``o`` retained values; so they share
   one among the k - o + 1 of either sketch that come first in any common order
   (the prefix principle).  The order is by list length, then value: values of
   common passages come last, and a value that only one class retains needs no list.
3. Each list compares its members with one of them, its pivot: the one whose
   retained values are the most common, so in a group of near copies the text that
   they were made from.  That links most of them, however many they are.
4. Near copies that are not linked to their pivot may still be linked to each other
   or to one that is.  They are found by how they differ from the pivot: let D_x be the symmetric
   difference of the sets of x and the pivot.  The one of x and y is |D_x| + |D_y| - 2 |D_x & D_y|, so
   a link asks for a large common part of D_x and D_y; independent edits share
   little.  The prefix principle is applied once more, to the differences.
5. Members far from the pivot are compared with each other if they share a list.  Jaccard
   distance is a metric: their distances to the pivot must be about equal.
   In 4 and 5 a pair leaves the join only if its profiles allow it: a profile has a bit for each retained value that
   some other class retains, so common bits bound the common values, and documents that merely share passages make no row.
6. Candidates of 4 and 5 are filtered by their sizes and by the estimate of the union's
   sketch (the k smallest values of both sketches together), then checked on full sets.
7. Links give connected components.

``o`` and the estimate's margin are ``sigmas`` standard deviations off the
threshold, so a pair at the threshold is lost with a probability of some 1e-8
(sets of up to similarity * k shingles lie wholly in their sketches: none is lost).
No list, partner or candidate is capped.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import Words, distinct_per_doc, mix, text_of, text_slices, without_ids
from corate.llm.components import connected_components
from corate.session import materialize

# Distance to its pivot up to which a member is known by how it differs from it.
REACH = 0.9
PROFILE_BITS = 512
SET = "struct<n: bigint, key: binary, sketch: array<bigint>>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of several texts, and where each text's begin.

    A text of fewer words has one shingle, all of it; one without words has none.
    """
    found = Words(data, offsets)
    key, per_doc = found.hashes(), np.diff(found.first)
    n = np.where(per_doc == 0, 0, np.maximum(1, per_doc - words + 1))
    doc = np.repeat(np.arange(len(n)), n)
    at = found.first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    end = found.first[doc + 1]
    value = np.full(len(doc), np.uint64(words))
    for k in range(words):
        there = at + k < end
        value[there] = mix(value[there] * np.uint64(0x9E3779B97F4A7C15) + key[at[there] + k])
    doc, value = distinct_per_doc(doc, value.view(np.int64))
    return value, np.searchsorted(doc, np.arange(len(n) + 1))


def describe_sets(texts: Column, words: int, k: int) -> Column:
    """n (set size), key (128-bit digest of the set) and sketch (its k smallest hashes)."""

    @F.arrow_udf(SET)
    def describe(column: pa.Array) -> pa.Array:
        n, keys, sketches = [], [], []
        for _, data, offsets in text_slices(column):
            value, first = shingle_sets(data, offsets, words)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                n.append(b - a)
                keys.append(xxhash.xxh3_128_digest(value[a:b].tobytes()))
                sketches.append(value[a : min(b, a + k)])
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.list_(pa.int64()))],
            names=["n", "key", "sketch"],
        )

    return describe(texts)


def full_sets(texts: Column, words: int) -> Column:
    @F.arrow_udf("array<bigint>")
    def full(column: pa.Array) -> pa.Array:
        parts = []
        for _, data, offsets in text_slices(column):
            value, first = shingle_sets(data, offsets, words)
            parts.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(value, pa.int64())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return full(texts)


def _allowed(x: str, y: str) -> Column:
    """May two nodes share as many retained values as a link asks for?  Values that share a bit with another of their own are conceded."""
    both = [F.bit_count(F.col(f"{x}.b{w}").bitwiseAND(F.col(f"{y}.b{w}"))) for w in range(PROFILE_BITS // 64)]
    least = F.greatest(f"{x}.overlap", f"{y}.overlap") - F.least(f"{x}.lost", f"{y}.lost")
    return reduce(add, both) >= least


class NearDuplicates:
    """The steps above over one table of documents; ``percent``: least similarity in hundredths."""

    def __init__(self, percent: int, words: int, k: int, sigmas: float):
        self.percent, self.words, self.k, self.sigmas = percent, words, k, sigmas
        t = percent / 100
        self.margin = sigmas * math.sqrt(t * (1 - t) / k)
        self.whole = percent * k // 100  # sets up to this size, and all that are as similar, lie in their sketches

    def describe(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """id, n, key, sketch of every document."""
        found = docs.select(F.col(id_col).alias("id"), describe_sets(text_of(text_col), self.words, self.k).alias("s"))
        return materialize(found.select("id", "s.n", "s.key", "s.sketch"), "near-sets")

    def classes(self, sets: DataFrame) -> DataFrame:
        """key, node (the smallest id), n and sketch of each class of equal sets."""
        rows = sets.where("id IS NOT NULL AND n > 0")
        found = rows.groupBy("key").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        return materialize(found, "near-classes")

    def postings(self, classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The lists to look into (value, node, n), the sketches of their nodes (node, n, sketch), and their profiles (node, profile)."""
        entries = classes.select("node", "n", F.explode("sketch").alias("value"))
        shared = entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        kept = F.least(F.col("n"), F.lit(self.k))
        # The union's k smallest values are a sample of the union, which has n / t values at most.  A union of
        # fewer than k values, which only a set of fewer has, lies in the sketches whole: the intersection is shared.
        t, union = self.percent / 100, F.col("n") * (100 / self.percent)
        spread = self.sigmas * F.sqrt(self.k * t * (1 - t) * F.greatest(F.lit(0), union - self.k) / (union - 1))
        sampled = F.greatest(F.lit(1), F.floor(self.k * t - spread))
        entire = F.expr(f"({self.percent} * n + 99) div 100")
        overlap = (
            F.when(F.col("n") <= self.whole, entire)
            .when(F.col("n") < self.k, F.least(sampled, entire))
            .otherwise(sampled)
        )
        words = range(PROFILE_BITS // 64)
        bits = [F.expr(f"bit_or(IF((value >> 6 & {len(words) - 1}) = {w}, shiftleft(1L, CAST(value & 63 AS INT)), 0L))").alias(f"b{w}") for w in words]
        listed = (
            entries.join(shared, "value")
            .groupBy("node", "n")
            .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"), F.sum("df").alias("weight"), *bits)
            .withColumn("overlap", overlap.cast("int"))
            .withColumn("lost", F.size("shared") - reduce(add, [F.bit_count(f"b{w}") for w in words]))
            .withColumn("prefix", kept - F.col("overlap") + 1 - (kept - F.size("shared")))
            .where("prefix > 0")
            .select("node", "n", "weight", F.struct("overlap", "lost", *[f"b{w}" for w in words]).alias("profile"), F.transform(F.slice("shared", 1, F.col("prefix").cast("int")), lambda x: x["value"]).alias("values"))
        )
        listed = materialize(listed, "near-lists")
        values = listed.select("node", "n", "weight", F.explode("values").alias("value"))
        central = F.min(F.struct((-F.col("weight")).alias("weight"), F.col("node")))
        lists = values.groupBy("value").agg(F.count(F.lit(1)).alias("members"), central.alias("central")).where("members > 1")
        values = materialize(values.join(lists.select("value", F.col("central.node").alias("pivot")), "value"), "near-postings")
        nodes = values.select("node", "n").distinct()
        sketches = materialize(classes.select("node", "n", "sketch").join(nodes, ["node", "n"]), "near-sketches")
        # An id with several texts is one node: any of them may be linked, so it is let through.
        open_ = F.struct(F.lit(0).alias("overlap"), F.lit(0).alias("lost"), *[F.lit(-1).cast("bigint").alias(f"b{w}") for w in words])
        own = F.when(F.count(F.lit(1)) == 1, F.first("profile")).otherwise(open_)
        return values, sketches, materialize(listed.groupBy("node").agg(own.alias("profile")), "near-profiles")

    def to_pivots(self, values: DataFrame, sets: DataFrame) -> DataFrame:
        """pivot, node, n, n_pivot, linked, distance and, up to REACH, diff (the sets' symmetric difference)."""
        pairs = values.where("node <> pivot").select("pivot", "node").distinct()
        both = F.size(F.array_intersect("x", "y"))
        found = (
            pairs.join(sets.select(F.col("node").alias("pivot"), F.col("set").alias("x")), "pivot")
            .join(sets.select("node", F.col("set").alias("y")), "node")
            .select("pivot", "node", "x", "y", both.alias("shared"))
            .withColumn("total", F.size("x") + F.size("y") - F.col("shared"))
            .select(
                "pivot",
                "node",
                F.struct(
                    (1 - F.col("shared") / F.col("total")).alias("distance"),
                    F.size("y").alias("n"),
                    F.size("x").alias("n_pivot"),
                    (100 * F.col("shared") >= self.percent * F.col("total")).alias("linked"),
                    F.when(
                        F.col("shared") >= (1 - REACH) * F.col("total"),
                        F.concat(F.array_except("x", "y"), F.array_except("y", "x")),
                    ).alias("diff"),
                ).alias("found"),
            )
        )
        # An id with several texts is one node: of its distances the least counts.
        found = found.groupBy("pivot", "node").agg(F.min("found").alias("found"))
        return materialize(found.select("pivot", "node", "found.*"), "near-pivots")

    def by_difference(self, star: DataFrame, profiles: DataFrame) -> DataFrame:
        """Pairs a < b around one pivot, at least one of them not linked to it, that may be linked."""
        ratio = (100 - self.percent) / (100 + self.percent)  # sets are linked if |x ^ y| <= ratio * (|x| + |y|)
        near = star.where("diff IS NOT NULL")
        entries = near.select("pivot", "node", F.explode("diff").alias("value"))
        shared = entries.groupBy("pivot", "value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        size = F.size("diff")
        # Least common part of the differences: with a partner that is not linked, and of a node that is not, with one that is.
        excess = F.greatest(F.lit(0), F.col("n") - F.col("n_pivot"))
        half = F.ceil((size - ratio * excess) / 2 - 1e-9)
        long = F.ceil(size - ratio * F.col("n") * (1 + 100 / self.percent) - 1e-9)
        nodes = (
            entries.join(shared, ["pivot", "value"])
            .groupBy("pivot", "node")
            .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"))
            .join(near, ["pivot", "node"])
            .select("pivot", "node", "n", "linked", size.alias("size"), F.size("shared").alias("common"), "shared",
                    F.greatest(F.lit(1), half).alias("half"), F.greatest(F.lit(1), long).alias("long"))
            .join(profiles, "node")
        )
        nodes = materialize(nodes.where("common >= least(half, long)"), "near-differences")

        def lists(rows: DataFrame, least: str, name: str) -> DataFrame:
            take = (F.col("common") - F.col(least) + 1).cast("int")
            values = F.transform(F.slice("shared", 1, take), lambda x: x["value"])
            cut = rows.where(take > 0).withColumn("value", F.explode(values))
            return cut.select("pivot", "value", "node", "n", "size", "common", "profile").alias(name)

        loose, tied = nodes.where("NOT linked"), nodes.where("linked")
        need = (F.col("x.size") + F.col("y.size") - ratio * (F.col("x.n") + F.col("y.n"))) / 2 - 1e-9
        maybe = (
            (F.col("x.pivot") == F.col("y.pivot"))
            & (F.col("x.value") == F.col("y.value"))
            & (100 * F.col("x.n") >= self.percent * F.col("y.n"))
            & (100 * F.col("y.n") >= self.percent * F.col("x.n"))
            & (need <= F.least("x.common", "y.common"))
            & _allowed("x.profile", "y.profile")
        )
        first = lists(loose, "half", "x").join(lists(loose, "half", "y"), maybe & (F.col("x.node") < F.col("y.node")))
        second = lists(loose, "long", "x").join(lists(tied, "half", "y"), maybe)
        pair = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
        return first.select(*pair).unionByName(second.select(*pair)).distinct()

    def far_apart(self, values: DataFrame, star: DataFrame, profiles: DataFrame) -> DataFrame:
        """Pairs a < b of a list, at least one of them beyond REACH of its pivot, that may be linked."""
        far = 1 - self.percent / 100 + 1e-9
        away = star.where(F.col("distance") >= REACH - far).select("pivot", "node", "n", "distance")
        known = (
            values.select("value", "pivot", "node")
            .join(away.join(profiles, "node"), ["pivot", "node"])
            .select("value", "node", "n", "distance", "profile")
        )
        x, y = known.alias("x"), known.alias("y")
        maybe = (
            (F.col("x.value") == F.col("y.value"))
            & (F.col("x.node") < F.col("y.node"))
            & (100 * F.col("x.n") >= self.percent * F.col("y.n"))
            & (100 * F.col("y.n") >= self.percent * F.col("x.n"))
            & (F.greatest("x.distance", "y.distance") >= REACH - 1e-9)
            & (F.abs(F.col("x.distance") - F.col("y.distance")) <= far)
            & _allowed("x.profile", "y.profile")
        )
        return x.join(y, maybe).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()

    def check(self, pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
        """The linked ones of some pairs: by the estimate of the union's sketch, then on full sets."""
        side = lambda x: sketches.select(F.col("node").alias(x), F.col("sketch").alias(f"s_{x}"))
        union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, self.k)
        estimate = F.size(F.array_intersect("union", F.array_intersect("s_a", "s_b"))) / F.size("union")
        likely = (
            pairs.join(side("a"), "a")
            .join(side("b"), "b")
            .withColumn("union", union)
            .where(estimate >= self.percent / 100 - self.margin)
            .select("a", "b")
        )
        shared = F.size(F.array_intersect("x", "y"))
        return (
            materialize(likely, "near-likely")
            .join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
            .where(100 * shared >= self.percent * (F.size("x") + F.size("y") - shared))
            .select("a", "b")
        )

    def components(self, docs: DataFrame, sets: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """node, component for the nodes that are not their own component."""
        values, sketches, profiles = self.postings(classes)
        texts = docs.select(F.col(id_col).alias("node"), text_of(text_col).alias("text"))
        wanted = sketches.select("node").distinct()
        full = texts.join(wanted, "node").select("node", full_sets(F.col("text"), self.words).alias("set"))
        full = materialize(full.distinct(), "near-full")
        star = self.to_pivots(values, full)
        links = star.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        more = self.by_difference(star, profiles).unionByName(self.far_apart(values, star, profiles))
        return connected_components(links.unionByName(self.check(more.distinct(), sketches, full)))


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    words: int = 5,
    k: int = 64,
    sigmas: float = 7.0,
) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id, kept.

    Words are runs of non-space bytes, A-Z lower-cased.  Documents are linked if
    100 * shared >= percent * union of their shingles; component_id is the smallest id
    reachable.  A text without words, or null, is linked with nothing.  Rows with a null id
    are linked with nothing, have a null component_id and are kept.  Rows that repeat an id are
    one node, linked if any of its texts is.  Other columns are ignored; an empty table
    gives an empty result.
    """
    task = NearDuplicates(percent, words, k, sigmas)
    sets = task.describe(docs, id_col, text_col)
    classes = task.classes(sets)
    parts = task.components(docs, sets, classes, id_col, text_col)
    named = classes.select("key", "node").join(parts, "node", "left").select(
        F.col("key").alias("_key"), F.coalesce("component", "node").alias("component")
    )
    linked = F.col("id").isNotNull() & (F.col("n") > 0)
    return (
        sets.select("id", "n", "key")
        .join(named, F.when(linked, F.col("key")) == F.col("_key"), "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(linked, F.col("component")).otherwise(F.col("id")).alias("component_id"),
        )
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns."""
    return without_ids(docs, id_col, near_groups(docs, id_col, text_col, **options).where("NOT kept").select(id_col))
