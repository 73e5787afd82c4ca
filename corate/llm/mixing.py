"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is counted in blocks of ``block_words`` words.  Blocks are allocated by
the highest quotients, target / (2 k + 1) for the k-th block: first to sources,
then from each source to bands of shards, and from each band to its shards, so
that no step ranks more than a bounded number of rows in one task (the sources themselves, where they are more than ``CHUNK``,
are ranked by range sorts and summed up in two levels).  A shard
holds about ``shard_words`` words of one source in a seeded order of documents.
Its integer quota is met by whole passes over its blocks and one further run of
blocks from a seeded start, wrapping round; since the order is random, so is the
run.  At most ``most`` passes are made over any block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import WORD, fresh, keyed_rows, text_of, with_columns_last
from corate.operators.index import number_rows
from corate.session import materialize

WEIGHTS = (5, 2, 1)
# Sources that one task ranks; more are ranked by range sorts.
CHUNK = 4096


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def running_sums(rows: DataFrame, order: list[str], columns: list[str], chunk: int = CHUNK) -> DataFrame:
    """``rows`` with place (from 0, in a total order) and, for each column c, c_before: its sum over the rows before.

    A range sort numbers the rows; they are summed up in chunks, and the chunks' sums, one row for ``chunk`` rows,
    in one more level.
    """
    numbered = number_rows(rows, order, "place").frame.withColumn("chunk", F.floor(F.col("place") / chunk))
    before = lambda key, *part: Window.partitionBy(*part).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    totals = numbered.groupBy("chunk").agg(*[F.sum(c).alias(c) for c in columns])
    starts = totals.select("chunk", *[F.coalesce(F.sum(c).over(before("chunk")), F.lit(0)).alias(f"{c}_start") for c in columns])
    inner = [F.coalesce(F.sum(c).over(before("place", "chunk")), F.lit(0)).alias(f"{c}_inner") for c in columns]
    found = numbered.select("*", *inner).join(starts, "chunk")
    found = found.withColumns({f"{c}_before": F.col(f"{c}_start") + F.col(f"{c}_inner") for c in columns})
    return found.drop("chunk", *[f"{c}_{x}" for c in columns for x in ("start", "inner")])


def many_targets(sizes: DataFrame, weights: tuple[int, ...], most: int, chunk: int = CHUNK) -> DataFrame:
    """``source_targets`` for any number of sources: no task ranks more than ``chunk`` of them."""
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    named = number_rows(sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "nth").frame.drop("last")
    ranked = named.withColumn("weight", F.element_at(cycle, (F.col("nth") % len(weights) + 1).cast("int")))
    ranked = materialize(ranked.withColumn("cap", F.col("source_size") / F.col("weight")), "mix-ranked")
    filled = running_sums(ranked, ["cap", "nth"], ["source_size", "weight"], chunk)
    total = ranked.select(F.struct(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))).scalar()
    level = (total["size"] - most * F.col("source_size_before")) / (total["weight"] - F.col("weight_before"))
    levels = filled.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") < most * F.col("source_size"))
    levels = materialize(levels, "mix-levels")
    at = levels.where("free").select(F.max("level")).scalar()
    target = F.when(F.col("free"), at * F.col("weight")).otherwise(F.col("source_size") * F.lit(float(most)))
    return levels.select("source", "nth", "source_size", target.cast("double").alias("target"))


def many_quotas(rows: DataFrame, item: str, weight: str, seats: int, name: str) -> DataFrame:
    """``sainte_lague`` of one group of any number of items: the open quotients are ranked by a range sort."""
    whole = rows.agg(F.sum(weight).cast("double"), F.count(F.lit(1))).first()
    total, n = whole[0] or 0.0, whole[1]
    if total <= 0:
        return rows.withColumn(name, F.lit(0).cast("long"))
    share = lambda s: F.col(weight) * F.lit(s) / F.lit(total)
    low = F.greatest(F.lit(0), F.ceil(share(seats - n / 2.0) - 0.5) - 1).cast("long")
    high = F.floor(share(seats + n / 2.0) + 0.5).cast("long") + 1
    sure = rows.withColumn("low", low)
    left = seats - (sure.agg(F.sum("low")).first()[0] or 0)
    open_ = sure.where(F.col(weight) > 0).select(item, weight, F.explode(F.sequence("low", high)).alias("k"))
    open_ = open_.select(item, "k", (-F.col(weight) / (2 * F.col("k") + 1)).alias("q"))
    won = number_rows(open_, ["q", item, "k"], "place").frame.where(F.col("place") < left).groupBy(item).agg(F.count(F.lit(1)).alias("won"))
    return sure.join(won, item, "left").withColumn(name, F.col("low") + F.coalesce("won", F.lit(0))).drop("low", "won")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """source, source_size, target: weights by rank, none above ``most`` times its size.

    ``sizes`` has a row per source.  Filling by weight with caps ends at one level:
    each target is the lesser of its cap and level * weight.  Sources reach their
    caps in the order of cap / weight.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = sizes.withColumn("nth", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(cycle, (F.col("nth") % len(weights) + 1).cast("int"))
    )
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "nth")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    capped = F.col("level") * F.col("weight") >= most * F.col("source_size")
    levels = ranked.withColumn("level", level).withColumn("free", ~capped)
    return levels.withColumn("at", F.max(F.when(F.col("free"), F.col("level"))).over(everything)).select(
        "source",
        "nth",
        "source_size",
        F.when(F.col("free"), F.col("at") * F.col("weight"))
        .otherwise(F.col("source_size") * F.lit(float(most)))
        .cast("double")
        .alias("target"),
    )


def sainte_lague(rows: DataFrame, group: list[str], item: str, weight: str, seats: str, name: str) -> DataFrame:
    """Allocate ``seats`` of each group to its items by the highest weight / (2 k + 1).

    The last quotient that wins lies between W / (2 (S + n / 2)) and W / (2 (S - n / 2))
    for S seats, n items and total weight W.  So all but about n seats are certain
    beforehand, and only some three quotients per item are ranked.  Ties go to the
    first item.
    """
    whole = Window.partitionBy(*[F.col(g) for g in group])
    total = F.sum(weight).over(whole)
    n = F.count(F.lit(1)).over(whole)
    share = lambda s: F.col(weight) * s / F.col("_total")
    low = F.greatest(F.lit(0), F.ceil(share(F.col(seats) - F.col("_n") / 2.0) - 0.5) - 1).cast("long")
    high = F.floor(share(F.col(seats) + F.col("_n") / 2.0) + 0.5).cast("long") + 1
    sure = (
        rows.withColumn("_total", total.cast("double"))
        .withColumn("_n", n)
        .withColumn("_low", F.when(F.col("_total") > 0, low).otherwise(F.lit(0).cast("long")))
        .withColumn("_high", F.when(F.col("_total") > 0, high).otherwise(F.lit(0).cast("long")))
        .withColumn("_left", F.col(seats) - F.sum("_low").over(whole))
    )
    open_ = sure.select(
        *group, item, weight, "_left", F.explode(F.sequence("_low", F.col("_high"))).alias("_k")
    ).withColumn("_q", F.col(weight) / (2 * F.col("_k") + 1))
    order = Window.partitionBy(*[F.col(g) for g in group]).orderBy(F.col("_q").desc(), F.col(item), F.col("_k"))
    won = (
        open_.where(F.col(weight) > 0)
        .withColumn("_r", F.row_number().over(order))
        .where(F.col("_r") <= F.col("_left"))
        .groupBy(*group, item)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    return (
        sure.join(won, [*group, item], "left")
        .withColumn(name, F.col("_low") + F.coalesce("_won", F.lit(0)))
        .drop("_total", "_n", "_low", "_high", "_left", "_won")
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = 3,
    block_words: int = 16,
    shard_words: int = 250_000,
    shards_per_band: int = 1024,
    seed: int = 42,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per document: its id and source, size, source_size, target (its source's) and taken.

    size is the number of words; taken the words that the mix reads of the
    document, repeats counted, at most ``most`` times its size.  Sources by code
    point, null last, have ``weights`` in turn.  A source without words gets
    nothing.  Rows that repeat an id or have none are separate rows of the mix, spread like others by a row key; equal rows are
    interchangeable.  An empty table gives an empty result.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), text_of(text_col).alias("text"))
    rows, key = keyed_rows(own, "id")  # so that rows without an id, or with one id, do not share a spot
    spread = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    sized = rows.select("id", "source", word_count(F.col("text")).alias("size"), spread.alias("spot"))
    sized = materialize(sized, "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = materialize(sizes, "mix-source-sizes")
    n, words = sizes.agg(F.count(F.lit(1)), F.sum("source_size")).first()
    if n <= chunk:
        targets = source_targets(sizes, weights, most)
        whole = Window.partitionBy()
        targets = targets.withColumn("blocks", F.round(F.sum("source_size").over(whole) / block_words).cast("long"))
        sources = sainte_lague(targets, ["blocks"], "nth", "target", "blocks", "quota").drop("blocks")
    else:
        blocks = int((words or 0) / block_words + 0.5)  # as round() of the other way, half up
        sources = many_quotas(many_targets(sizes, weights, most, chunk), "nth", "target", blocks, "quota")
    sources = sources.withColumn("n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"))
    sources = materialize(sources, "mix-sources")

    # A document's shard comes from the leading digits of its spot, its place in the shard from all of it.
    near = F.conv(F.substring("spot", 1, 12), 16, 10).cast("long")
    placed = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        sized["id"], sized["source"], sized["size"], "spot", "nth", "source_size", "target", "quota", F.pmod(near, F.col("n_shards")).alias("shard")
    )
    shards = (
        placed.groupBy("nth", "shard")
        .agg(F.sum("size").alias("words"), F.first("quota").alias("quota"))
        .withColumn("band", F.floor(F.col("shard") / shards_per_band))
    )
    bands = shards.groupBy("nth", "band").agg(F.sum("words").alias("words"), F.first("quota").alias("quota"))
    bands = sainte_lague(bands, ["nth"], "band", "words", "quota", "band_quota").select("nth", "band", "band_quota")
    quotas = sainte_lague(
        shards.drop("quota").join(bands, ["nth", "band"]), ["nth", "band"], "shard", "words", "band_quota", "shard_quota"
    ).select("nth", "shard", "words", "shard_quota")

    order = Window.partitionBy("nth", "shard").orderBy("spot", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    laid = placed.drop("quota").withColumn("upto", F.sum("size").over(order)).join(quotas, ["nth", "shard"])
    n_blocks = F.ceil(F.col("words") / block_words)
    start = F.pmod(
        F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "nth", "shard")), 1, 12), 16, 10).cast("long"),
        F.greatest(F.col("blocks"), F.lit(1)),
    )
    laid = (
        laid.withColumn("blocks", n_blocks)
        .withColumn("reads", F.least(F.col("shard_quota"), most * F.col("blocks")))
        .withColumn("passes", F.when(F.col("blocks") > 0, F.floor(F.col("reads") / F.col("blocks"))).otherwise(F.lit(0)))
        .withColumn("extra", F.col("reads") - F.col("passes") * F.col("blocks"))
        .withColumn("first", start)
    )

    def overlap(begin: Column, end: Column) -> Column:
        """Words of the document between two positions of its shard."""
        return F.greatest(
            F.lit(0), F.least(F.col("upto"), end) - F.greatest(F.col("upto") - F.col("size"), begin)
        )

    begin, stop = F.col("first") * block_words, (F.col("first") + F.col("extra")) * block_words
    wrapped = (F.col("first") + F.col("extra") - F.col("blocks")) * block_words
    taken = F.col("passes") * F.col("size") + overlap(begin, stop) + overlap(F.lit(0), wrapped)
    return laid.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents that the mix reads, with their columns, size, source_size, target and taken.

    Rows with equal id, source and size get the highest ``taken`` among them.
    Input columns named like the added ones are replaced.
    """
    plan = mix_sources(docs, id_col, text_col, source_col, **options)
    of, found, size = (fresh(c, docs) for c in ("_of", "_found", "_words"))
    plan = (
        plan.where("taken > 0")
        .groupBy(F.struct(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col("size").alias("size")).alias(of))
        .agg(F.struct(F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.max("taken").alias("taken")).alias(found))
    )
    own = docs.withColumn(size, word_count(text_of(text_col)))
    same = (
        own[id_col].eqNullSafe(F.col(f"{of}.id"))
        & own[source_col].eqNullSafe(F.col(f"{of}.source"))
        & (F.col(size) == F.col(f"{of}.size"))
    )
    added = {c: F.col(f"{found}.{c}") for c in ("source_size", "target", "taken")}
    return with_columns_last(own.join(plan, same), {"size": F.col(size), **added}).drop(of, found, size)
