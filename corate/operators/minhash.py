"""MinHash signatures and LSH banding as DataFrame operators.

``baskets``  -> distinct ``(item_id, idx)`` (the characteristic matrix, long form)
``signatures`` -> one row per item with ``h0 .. h{n-1}`` (a partial + final hash
aggregation: ``min`` is combined map-side, so a hot item never ships its
rows through the shuffle)
``band_keys`` -> ``(item_id, band, key)`` with ``key`` the struct of the band's rows
``lsh_candidates`` -> unordered pairs ``id1 < id2`` sharing a band key, and their Jaccard if asked for
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corate.functions.hashing import (
    CHUNK_HASHES,
    DEFAULT_BANDS,
    DEFAULT_ROWS,
    MAX_INDEX,
    band_array,
    band_hashes,
    hash_family,
    signature_columns,
)
from corate.operators.index import DenseIndex, attach_index
from corate.functions.similarity import jaccard
from corate.operators.spread import PIECE_ROWS, spotted
from corate.session import materialize

# Items of one chunk, and entries of their lists: two chunks meet in a task.  Few items still make so many chunks.
CHUNK_ITEMS = 65_536
CHUNK_ENTRIES = 20_000_000
LEAST_CHUNKS = 8
# Pairs, and entries of the baskets that are looked up for them, that a task lays out at once.
SLICE_ROWS = 1_000_000


def baskets(pairs: DataFrame, index: DenseIndex, user_col: str = "user_id", item_col: str = "item_id"):
    """Distinct ``(item_id, idx)``: the users of each item as dense indexes, the rows of an item together."""
    with_idx = attach_index(spotted(pairs.select(user_col, item_col), item_col, user_col), index, user_col)
    return _gathered(with_idx.select(F.col(item_col).alias("item_id"), "idx", "_bucket"), "idx")


def _gathered(rows: DataFrame, user_col: str, distinct: bool = True) -> DataFrame:
    """``item_id, user`` of ``spotted`` rows, shuffled once: the distinct needs no exchange of its own."""
    together = rows.repartition("item_id", "_bucket")
    return (together.dropDuplicates(["item_id", "_bucket", user_col]) if distinct else together).drop("_bucket")


def signatures(basket_df: DataFrame, family=None, universe: int | None = None) -> DataFrame:
    """Wide MinHash signature: ``item_id, h0 .. h{len(family)-1}`` (BIGINT).

    ``h_k = min over users of ((a_k * idx + b_k) mod p_k) mod universe``.
    """
    family = family or hash_family()
    if universe is None or universe < 0:
        raise ValueError("universe (number of indexed users) must be given and non-negative")
    if universe > MAX_INDEX:
        raise ValueError(f"universe {universe} exceeds {MAX_INDEX}: a*idx+b would overflow BIGINT")
    # an empty universe means an empty basket table; modulus 1 keeps the plan valid
    return basket_df.groupBy("item_id").agg(*signature_columns("idx", family, max(universe, 1)))


def signature_long(signature_df: DataFrame, num_hashes: int) -> DataFrame:
    """``item_id, h, minhash``: the wide signature unpivoted, one row per hash."""
    return signature_df.unpivot(
        "item_id", [f"h{i}" for i in range(num_hashes)], "h_name", "minhash"
    ).select("item_id", F.substring("h_name", 2, 10).cast("int").alias("h"), "minhash")


def band_keys(signature_df: DataFrame, num_hashes: int, bands: int = DEFAULT_BANDS, rows: int = DEFAULT_ROWS):
    """``item_id, band, key``: one row per item and band; ``key`` = struct of the band's values."""
    return signature_df.select(
        "item_id", F.posexplode(band_array(num_hashes, bands, rows)).alias("band", "key")
    )


def all_band_keys(
    basket_df: DataFrame,
    family,
    universe: int,
    bands: int = DEFAULT_BANDS,
    rows: int = DEFAULT_ROWS,
    chunk: int = CHUNK_HASHES,
    write: bool = True,
) -> DataFrame:
    """``item_id, key`` for any number of hash functions: signatures of at most about ``chunk`` at a time.

    ``key`` is a 64-bit hash of a band and its rows: two bands that share one by chance are one candidate more, which the
    exact check drops.

    Bands do not depend on each other, so a chunk of whole bands is an aggregation of its own, small enough for
    whole-stage codegen.  Where no basket is large, the rows of the baskets are shuffled once for all chunks, and no
    signature is.  With ``write`` the keys are written once, for readers that need them more than once.
    """
    if bands * rows > len(family):
        raise ValueError(f"{bands} bands x {rows} rows needs {bands * rows} hashes, have {len(family)}")
    step = max(1, chunk // rows)
    # A row of a signature becomes a row of each band: spread them first, where their bytes alone would be few tasks.
    partitions = int(basket_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = bands > step and not _any_large(basket_df)
    if together:
        basket_df = basket_df.repartition(partitions, "item_id")
    parts = []
    for first in range(0, bands, step):
        n = min(step, bands - first)
        part = signatures(basket_df, family[first * rows : (first + n) * rows], universe)
        part = part.repartition(partitions) if bands > step and not together else part
        parts.append(part.select("item_id", F.explode(band_hashes(n, rows, first)).alias("key")))
    keys = reduce(DataFrame.unionByName, parts)
    return materialize(keys, "bands") if write else keys


def _any_large(basket_df: DataFrame) -> bool:
    sizes = basket_df.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
    return not sizes.where(F.col("_n") > PIECE_ROWS).isEmpty()


def basket_classes(coded: DataFrame) -> DataFrame:
    """``item_id, class_id``: the smallest item with the same users, by size and 192 bits that do not depend on their order."""
    bits = [F.expr(f"bit_xor(xxhash64(user_id, {k}))").alias(f"_x{k}") for k in range(3)]
    sets = coded.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"), *bits)
    key = ["_n", "_x0", "_x1", "_x2"]
    return sets.join(sets.groupBy(*key).agg(F.min("item_id").alias("class_id")), key).select("item_id", "class_id")


def lsh_candidates(band_df: DataFrame, tile: int = CHUNK_ITEMS, basket_df: DataFrame | None = None) -> DataFrame:
    """Distinct unordered pairs ``(id1, id2)``, ``id1 < id2``, equal in at least one band.

    With ``basket_df`` (distinct ``item_id, idx``) also ``similarity``, the exact Jaccard of their baskets.

    The pairs, whose number may grow with the square of the items, are made and told apart within the tasks and are
    never shuffled or written.  Items are dealt over chunks of about ``tile`` by a hash; every two chunks
    meet in a task, so that each pair is made in one task only, whatever the sizes of its buckets and however many it shares.  What is
    shuffled is an item's list of buckets of more than one (and its basket) once a chunk.
    """
    group = [c for c in band_df.columns if c != "item_id"]
    partitions = int(band_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One shuffle for the buckets and for the join with them, whose rows are written: their numbers stay what they are.
    rows = band_df.where("item_id IS NOT NULL").repartition(partitions, *group)
    ends = [F.min("item_id").alias("_least"), F.max("item_id").alias("_most")]
    buckets = rows.groupBy(*group).agg(*ends).where("_least < _most").withColumn("_code", F.monotonically_increasing_id())
    members = materialize(rows.join(buckets, group).select("item_id", "_code"), "members")
    items, entries = members.agg(F.count_distinct("item_id"), F.count(F.lit(1))).first()
    lists = members.groupBy("item_id").agg(F.collect_set("_code").alias("codes"))
    if basket_df is not None:
        paired = basket_df.join(members.select("item_id").distinct(), "item_id", "left_semi")
        most, held = paired.agg(F.max("idx"), F.count(F.lit(1))).first()
        narrow = "int" if (most or 0) < 2**31 else "bigint"
        entries += held
        lists = lists.join(paired.groupBy("item_id").agg(F.collect_list(F.col("idx").cast(narrow)).alias("users")), "item_id")
    chunks = max(LEAST_CHUNKS, -(-items // tile), -(-entries // CHUNK_ENTRIES))
    chunk, other = F.pmod(F.xxhash64("item_id"), F.lit(chunks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    sent = lists.withColumn("_chunk", chunk).withColumn("_other", other)
    sent = sent.withColumns({"_i": F.least("_chunk", "_other"), "_j": F.greatest("_chunk", "_other")}).drop("_other")
    sent = sent.repartition(max(partitions, chunks), "_i", "_j").sortWithinPartitions("_i", "_j")
    item = band_df.schema["item_id"].dataType
    schema = T.StructType([T.StructField("a", item), T.StructField("b", item)])
    if basket_df is not None:
        schema = T.StructType([*schema, *[T.StructField(c, T.LongType()) for c in ("n1", "n2", "shared")]])
    met = sent.mapInArrow(_chunks_meet(basket_df is not None), schema)
    ids = [F.least("a", "b").alias("id1"), F.greatest("a", "b").alias("id2")]
    return met.select(*ids, *([] if basket_df is None else [jaccard(F.col("shared"), F.col("n1"), F.col("n2")).alias("similarity")]))


def _chunks_meet(with_users: bool):
    """A function of batches sorted by ``_i, _j``: the pairs of items of chunks ``_i`` and ``_j`` that share a code.

    It refers to no name of this module, so that tasks need not import it.
    """
    slice_rows, columns = SLICE_ROWS, ["item_id", "codes", "_chunk"] + ["users"] * with_users

    def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers ``start .. start + size - 1`` of all spans, one after the other."""
        return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)

    def slices(size: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of rows of together about ``slice_rows``."""
        ends, first = np.cumsum(size), 0
        while first < len(size):
            done = ends[first] - size[first]
            last = max(first + 1, int(np.searchsorted(ends, done + slice_rows, "right")))
            yield first, last
            first = last

    def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """All values one after the other, and the length of each row's list."""
        whole = column.combine_chunks()
        whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
        return whole.flatten().to_numpy(), np.diff(whole.offsets.to_numpy())

    def shared(users: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Common users of the rows ``a`` and ``b``, in order of ``a``: the users of a row are marked once for all its partners."""
        start, found = np.cumsum(size) - size, np.empty(len(a), np.int64)
        cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1], True])
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            row = a[first]
            mine = users[start[row] : start[row] + size[row]]
            mark[mine] = 1
            for low, high in slices(size[b[first:last]]):
                with_ = b[first + low : first + high]
                hits = mark[users[spans(start[with_], size[with_])]]
                found[first + low : first + high] = np.add.reduceat(hits, np.cumsum(size[with_]) - size[with_], dtype=np.int64)
            mark[mine] = 0
        return found

    def pairs(tile: pa.Table, same: bool) -> Iterator[pa.RecordBatch]:
        item, chunk = tile["item_id"], tile["_chunk"].to_numpy()
        codes, size = lists(tile["codes"])
        row = np.repeat(np.arange(len(chunk)), size)
        left = chunk[row] == chunk.min()
        right = np.ones_like(left) if same else ~left
        if not left.any() or not right.any():
            return
        order = np.argsort(codes[right], kind="stable")
        known, owner = codes[right][order], row[right][order]
        asked, of = codes[left], row[left]
        low, high = np.searchsorted(known, asked, "left"), np.searchsorted(known, asked, "right")
        # Pairs of one row must come in one slice, to be told apart.
        begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        if with_users:
            users, held = lists(tile["users"])
            mark = np.zeros(int(users.max()) + 1, np.uint8)
        for first, last in slices(np.add.reduceat(high - low, begin)):
            at = slice(begin[first], begin[last] if last < len(begin) else len(of))
            count = (high - low)[at]
            a, b = np.repeat(of[at], count), owner[spans(low[at], count)]
            a, b = np.divmod(np.unique((a * len(chunk) + b)[a < b] if same else a * len(chunk) + b), len(chunk))
            if not len(a):
                continue
            out = [item.take(pa.array(a)), item.take(pa.array(b))]
            if with_users:
                out += [pa.array(held[a].astype(np.int64)), pa.array(held[b].astype(np.int64)), pa.array(shared(users, held, a, b, mark))]
            yield from pa.table(out, names=["a", "b", "n1", "n2", "shared"][: len(out)]).to_batches(max_chunksize=100_000)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            where = np.stack([batch["_i"].to_numpy(), batch["_j"].to_numpy()])
            cuts = np.flatnonzero(np.r_[True, (where[:, 1:] != where[:, :-1]).any(axis=0), True]) if batch.num_rows else [0]
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                here = tuple(where[:, first].tolist())
                if here != key and held:
                    yield from pairs(pa.Table.from_batches(held), key[0] == key[1])
                    held = []
                key = here
                held.append(batch.slice(first, last - first).select(columns))
        if held:
            yield from pairs(pa.Table.from_batches(held), key[0] == key[1])

    return meet


def encode_pairs(
    pairs: DataFrame,
    users: DenseIndex,
    items: DenseIndex | None,
    user_col: str = "user_id",
    item_col: str = "item_id",
    pairs_distinct: bool = False,
) -> DataFrame:
    """Distinct ``(item_id, user_id)`` with dense BIGINT codes, written once.

    Joins, shuffles and aggregations downstream then move 8-byte keys instead
    of id strings.  Codes follow the sorted id order, so ``id1 < id2`` on
    codes is ``id1 < id2`` on ids.  With ``items=None`` the item ids are kept
    (they are integers already).  ``pairs_distinct=True`` skips the
    de-duplication shuffle when the input has no repeated ``(user, item)``.
    """
    spots = spotted(pairs.select(user_col, item_col), item_col, user_col)
    # Items first: what the join with the users, who may be many, shuffles are codes and not item ids.
    if items is not None:
        coded = attach_index(spots, items, item_col, "_i").drop(item_col)
    else:
        coded = spots.withColumnRenamed(item_col, "_i")
    coded = attach_index(coded, users, user_col, "_u")
    coded = coded.select(F.col("_i").alias("item_id"), F.col("_u").alias("user_id"), "_bucket")
    # codes are one-to-one with ids, so distinct input pairs give distinct codes
    return materialize(_gathered(coded, "user_id", not pairs_distinct), "coded")


def decode_pairs(scored: DataFrame, items: DenseIndex) -> DataFrame:
    """Replace the item codes ``id1, id2`` by the item ids (two joins with the item index)."""
    rest = [c for c in scored.columns if c not in ("id1", "id2")]
    rev = items.frame
    out = scored.join(rev.select(F.col("idx").alias("id1"), F.col("id").alias("_id1")), "id1").join(
        rev.select(F.col("idx").alias("id2"), F.col("id").alias("_id2")), "id2"
    )
    return out.select(F.col("_id1").alias("id1"), F.col("_id2").alias("id2"), *rest)
