"""Exact similar pairs: all pairs of items with Jaccard >= t of their sets of users.

Two ways to a pair, by how frequent its common users are:

* **Rare users, by prefix.**  Users are ordered rarest first, and of each item only the first
  ``n - ceil(t*n) + 1`` users in that order, its prefix, are looked at: two items with Jaccard >= t
  share a user in both prefixes (Bayardo et al., "Scaling up all pairs similarity search", WWW 2007).  Items meet
  in the lists of their rare prefix users.
* **The core, by bitmaps.**  The at most ``CORE`` most frequent users (of those in more than ``FREQUENT``
  items) have no lists.  They come last in the order, so a prefix holds one of them only if an item has few other users: such an item is
  *dense*.  A pair that shares no rare prefix user is a pair of dense items.  Those are kept as
  bitmaps of their core users, sorted by size and dealt over chunks; chunks whose sizes differ too much never meet,
  and within two chunks ``bit_count(a & b)`` plus a bound of the common rare users (``sketch``) bounds the intersection.
  Where one of the two has core users only, the bound is the intersection.

Where the lists of users would make more pairs than there are, or few enough are there, all pairs of items of like size are compared by their bitmaps
instead, within the tasks where two chunks of items meet (``tiles``); no pair of them is shuffled.

Nothing is paired through a frequent user.  (Of few items with large baskets, all pairs are counted by user instead.)  Pairs that the bounds leave open are checked with the exact Jaccard.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.functions.similarity import jaccard
from corate.operators.index import attach_index, dense_index, number_rows, rank_within
from corate.operators.similarity import all_jaccard, candidate_jaccard, few_items, item_users, threshold
from corate.operators.sketch import SKETCH_WORDS, enough, may_be_similar, parity, shared_bound, sizes_allow, sketch_words, sketches
from corate.operators.spread import TILE, pairs_within, spread_join
from corate.operators.tiles import LOOKUP, near_pairs, tile_shared
from corate.session import materialize

# Users of the core, a bitmap of four words; and items that a user must be in to be of it.
CORE = 256
FREQUENT = 256
WORDS = CORE // 64
# Words of the bitmaps by which all pairs are compared, and pairs for each row of the baskets that always are.
BITMAP_WORDS = 32
ORDERED_PAIRS = 1000


def prefix_size(n: Column, min_sim: float) -> Column:
    """Users of an item of ``n`` that a similar item must share one of, in any common order."""
    # a slightly longer prefix (the epsilon) never loses a pair; the checks are exact
    return n - F.ceil(F.lit(float(min_sim)) * n - F.lit(1e-9)) + 1


def core_users(d: DataFrame, core: int = CORE, frequent: int = FREQUENT) -> DataFrame:
    """``user, _bit``: the at most ``core`` users in the most items, of those in more than ``frequent``."""
    often = d.groupBy("user").agg(F.count(F.lit(1)).alias("_df")).where(F.col("_df") > frequent)
    first = often.orderBy(F.col("_df").desc(), "user").limit(core)
    order = Window.orderBy(F.col("_df").desc(), "user")  # of at most ``core`` rows
    return materialize(first.select("user", (F.row_number().over(order) - 1).alias("_bit")), "core")


def prefix_candidates(d: DataFrame, min_sim: float, core: DataFrame | None = None) -> DataFrame:
    """Unordered pairs ``id1 < id2`` of items whose prefixes share a user that is not in the core.

    ``d`` holds distinct ``item, user``.
    """
    rare = d if core is None else d.join(F.broadcast(core.select("user")), "user", "left_anti")
    freq = rare.groupBy("user").agg(F.count(F.lit(1)).alias("_df"))
    order = dense_index(freq, "user", priority=F.col("_df"))  # rarest first, ties by id
    ranked = attach_index(rare, order, "user", "_rank").select("item", "_rank")
    sk = materialize(sketches(d, SKETCH_WORDS), "sketches")
    bits = [c for c in sk.columns if c not in ("item", "n")]
    ranked = rank_within(ranked, ["item"], [F.col("_rank")], rank_col="_pos")
    # The bitmaps join the few rows of the prefixes only.
    positioned = ranked.join(sk.select("item", "n"), "item").where(F.col("_pos") <= prefix_size(F.col("n"), min_sim))
    prefix = positioned.join(sk.drop("n"), "item").select("item", "_rank", "_pos", "n", *bits)

    def may_reach(a: str, b: str) -> Column:
        """At the first shared user of a pair all later ones may be shared, and that must be enough."""
        n1, n2 = F.col(f"{a}n"), F.col(f"{b}n")
        rest = 1 + F.least(n1 - F.col(f"{a}_pos"), n2 - F.col(f"{b}_pos"))
        return sizes_allow(n1, n2, min_sim) & enough(rest, n1, n2, min_sim) & may_be_similar(a, b, SKETCH_WORDS, min_sim)

    return pairs_within(prefix, ["_rank"], "item", keep=may_reach, carry=("_pos", "n", *bits))


def dense_items(d: DataFrame, core: DataFrame, min_sim: float) -> DataFrame:
    """``item, n, rare, b0 .. b3, r0 .. r3``: the items whose prefix reaches into the core, their users outside of it, their bitmaps.

    ``r0 ..`` is the parity bitmap (``sketch``) of the users outside.
    """
    marked = d.join(F.broadcast(core), "user", "left").withColumn(
        "_hashed", F.when(F.col("_bit").isNull(), F.pmod(F.xxhash64("user"), F.lit(64 * WORDS)))
    )
    words = [F.expr(f"bit_or(IF(_bit div 64 = {w}, shiftleft(1L, _bit % 64), 0L))").alias(f"b{w}") for w in range(WORDS)]
    sets = marked.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_bit").isNull()).alias("rare"), *words, *parity("_hashed", WORDS, "r"))
    return sets.where(F.col("rare") < prefix_size(F.col("n"), min_sim))


def _partner_chunks(sizes: list[tuple[int, int, int]], min_sim: float, chunk: int) -> list[tuple[int, int, int]]:
    """Of each size the first and the last chunk that may hold a partner.

    ``sizes``: (size, first and last place) in ascending order.  A dense item has no more than (CORE + 1) / min_sim users,
    so these are few whatever the table.
    """
    found = []
    for n, _, _ in sizes:
        near = [s for s in sizes if min(n, s[0]) >= min_sim * max(n, s[0]) - 1e-9]
        found.append((n, near[0][1] // chunk, near[-1][2] // chunk))
    return found


def dense_pairs(items: DataFrame, min_sim: float, chunk: int = TILE) -> DataFrame:
    """``id1, id2, n1, n2, shared, exact``: pairs of dense items that may be similar enough.

    ``shared`` is the intersection if ``exact``, else a bound of it.  Items are numbered by size, so a
    chunk holds items of about one size; an item is copied only to the chunks whose sizes allow a pair.
    """
    numbered = materialize(number_rows(items, ["n", "item"], "_at").frame, "dense-items")
    found = numbered.groupBy("n").agg(F.min("_at"), F.max("_at"), F.max("rare")).collect()
    sizes = sorted(tuple(r)[:3] for r in found)
    outside = any(r[3] for r in found)  # else the bitmaps of the core are the whole items
    reach = items.sparkSession.createDataFrame(_partner_chunks(sizes, min_sim, chunk), "n bigint, _first bigint, _last bigint")
    sides = numbered.withColumn("_chunk", F.expr(f"_at div {chunk}")).join(F.broadcast(reach), "n")
    columns = ["item", "n", "rare", *[f"b{w}" for w in range(WORDS)], *[f"r{w}" for w in range(WORDS)]]
    left = sides.select(
        *[F.col(c).alias(f"x_{c}") for c in columns], F.col("_chunk").alias("_i"), F.explode(F.sequence("_chunk", "_last")).alias("_j")
    )
    right = sides.select(
        *[F.col(c).alias(f"y_{c}") for c in columns], F.col("_chunk").alias("_j"), F.explode(F.sequence("_first", "_chunk")).alias("_i")
    )
    bits = reduce(add, [F.bit_count(F.col(f"x_b{w}").bitwiseAND(F.col(f"y_b{w}"))) for w in range(WORDS)])
    shared = ((bits + shared_bound("x_", "y_", WORDS, "rare", "r")) if outside else bits).cast("bigint")
    n1, n2 = F.col("x_n"), F.col("y_n")
    once = (F.col("_i") != F.col("_j")) | (F.col("x_item") < F.col("y_item"))
    met = spread_join(left, right, ["_i", "_j"]).where(once & sizes_allow(n1, n2, min_sim) & enough(shared, n1, n2, min_sim))
    return met.select(
        F.least("x_item", "y_item").alias("id1"),
        F.greatest("x_item", "y_item").alias("id2"),
        n1.alias("n1"),
        n2.alias("n2"),
        shared.alias("shared"),
        (F.least("x_rare", "y_rare") == 0).alias("exact"),
    )


def _all_in_order(d: DataFrame, sizes: DataFrame, min_sim: float) -> bool:
    """Do all pairs of items cost less, compared by their bitmaps in order, than what lists of rare users make?

    The lists hold about the ``1 - min_sim`` of all rows that belong to the rarest users.
    """
    items, rows = sizes.agg(F.count(F.lit(1)), F.sum("n")).first()
    pairs = items * (items - 1) / 2
    if pairs <= ORDERED_PAIRS * (rows or 0):
        return True
    often = d.groupBy("user").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.sum("n").alias("rows"))
    met, held = 0.0, 0
    for n, in_lists in sorted(tuple(r) for r in often.collect()):  # the square root of the rows at most
        if held > (1 - min_sim) * rows:
            break
        met, held = met + in_lists * (n - 1) / 2, held + in_lists
    return pairs <= LOOKUP * met


def _bitmap_pairs(d: DataFrame, min_sim: float) -> DataFrame:
    """``id1, id2, similarity`` of the pairs that the bitmaps of all items leave open.

    A null user counts for the size of a basket, but is common to no two.
    """
    nulls = d.where("user IS NULL").select("item")
    d = d.where("user IS NOT NULL")
    users = d.agg(F.approx_count_distinct("user")).first()[0]
    index = dense_index(d, "user") if users <= 2 * 64 * BITMAP_WORDS else None
    exact = index is not None and index.size <= 64 * BITMAP_WORDS
    words = sketch_words(index.size, BITMAP_WORDS) if exact else BITMAP_WORDS
    if exact:
        coded = attach_index(d, index, "user", "_u").select("item", F.col("_u").alias("user"))
        sk = sketches(coded, words, F.col("user"))
    else:
        sk = sketches(d, words)
    found = near_pairs(materialize(sk, "sketches"), words, min_sim, exact=exact)
    found = found if exact else tile_shared(found, d)
    if not nulls.isEmpty():
        for k in (1, 2):
            found = found.join(nulls.select(F.col("item").alias(f"id{k}"), F.lit(1).alias("_null")), f"id{k}", "left")
            found = found.withColumn(f"n{k}", F.col(f"n{k}") + F.coalesce("_null", F.lit(0))).drop("_null")
    return found.select("id1", "id2", jaccard(F.col("shared"), F.col("n1"), F.col("n2")).alias("similarity"))


def exact_similar_pairs(
    pairs: DataFrame,
    min_sim: float,
    strict: bool = False,
    user_col: str = "user_id",
    item_col: str = "item_id",
    pairs_distinct: bool = False,
) -> DataFrame:
    """All item pairs ``id1 < id2`` with Jaccard >= ``min_sim`` (``>`` if ``strict``), exactly.

    ``min_sim`` must be positive: at 0 every co-rated pair qualifies and the
    prefix is the whole basket.  ``pairs_distinct=True`` declares that ``pairs`` is a written table without repeated rows.
    """
    if not 0 < min_sim <= 1:
        raise ValueError("min_sim must be in (0, 1]")
    if pairs_distinct:
        d = pairs.select(F.col(item_col).alias("item"), F.col(user_col).alias("user"))
    else:
        d = materialize(item_users(pairs, user_col, item_col), "item_users")
    sizes = d.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    if few_items(sizes):
        return threshold(all_jaccard(d, sizes), min_sim, strict)
    if _all_in_order(d, sizes, min_sim):
        return threshold(_bitmap_pairs(d, min_sim), min_sim, strict)
    core = core_users(d)
    dense = materialize(dense_pairs(dense_items(d, core, min_sim), min_sim), "dense-pairs")
    open_ = dense.where("NOT exact").select("id1", "id2")
    candidates = prefix_candidates(d, min_sim, core).unionByName(open_).distinct()
    checked = candidate_jaccard(candidates, d, "user", "item", pairs_distinct=True, min_sim=min_sim)
    known = dense.where("exact").select("id1", "id2", jaccard(F.col("shared"), F.col("n1"), F.col("n2")).alias("similarity"))
    return threshold(checked.unionByName(known), min_sim, strict)
