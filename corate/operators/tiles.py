"""Pairs of similar items, made and told apart in the tasks where two chunks of items meet.

No pair that a bound drops is shuffled or written: an item, with its bitmap (``sketch``) and the codes that it must share one of
with a partner, if there are such, is sent once to each chunk.  Within two chunks pairs are looked up by code, or, where that
would make more of them, all pairs of sizes that allow it are compared by their bitmaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corate.functions.similarity import jaccard
from corate.session import materialize

# Items of one chunk, and entries of their lists of codes: two chunks meet in a task.  Few items still make so many chunks.
CHUNK_ITEMS = 262_144
CHUNK_ENTRIES = 20_000_000
LEAST_CHUNKS = 8
# Ranges of sizes of the items whose baskets are compared.
LEAST_RANGES = 4
# Pairs that a task lays out at once, and entries of the baskets that are looked up for them.
CELLS = 131_072
SLICE_ROWS = 1_000_000
# A pair that shares a code costs about as much as so many that are compared by their bitmaps in order.
LOOKUP = 8
# A word of a bitmap tells items of about so many users apart.
USERS_A_WORD = 24


def near_pairs(sk: DataFrame, words: int, min_sim: float, lists: DataFrame | None = None, exact: bool = False) -> DataFrame:
    """Pairs ``id1 < id2`` of items whose bitmaps ``sk`` (``item, n, w0 ..``) leave open that their Jaccard is ``min_sim``.

    Columns ``id1, id2, n1, n2``, the sizes.  With ``lists`` (``item, codes``) only those that share a code.  ``exact`` says that
    every user has a bit of its own: then also ``shared``, the intersection.
    """
    partitions = int(sk.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = [f"w{k}" for k in range(words)]
    rows = sk.where("item IS NOT NULL").select("item", "n", *bits)
    if lists is not None:
        rows = materialize(rows.join(lists, "item"), "coded-items")
    items, entries = rows.agg(F.count(F.lit(1)), F.sum(F.lit(0) if lists is None else F.size("codes"))).first()
    chunks = max(LEAST_CHUNKS, -(-items // CHUNK_ITEMS), -(-(entries or 0) // CHUNK_ENTRIES))
    chunk, other = F.pmod(F.xxhash64("item"), F.lit(chunks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    sent = rows.withColumn("_chunk", chunk).withColumn("_other", other)
    sent = sent.withColumns({"_i": F.least("_chunk", "_other"), "_j": F.greatest("_chunk", "_other")}).drop("_other")
    sent = sent.repartition(max(partitions, chunks * (chunks + 1) // 2), "_i", "_j").sortWithinPartitions("_i", "_j")
    ids = [T.StructField(c, sk.schema["item"].dataType) for c in ("a", "b")]
    counts = [T.StructField(c, T.LongType()) for c in ["n1", "n2"] + ["shared"] * exact]
    met = sent.mapInArrow(_tiles(words, float(min_sim), lists is not None, exact), T.StructType([*ids, *counts]))
    n1, n2 = (F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (("n1", "n2"), ("n2", "n1")))
    return met.select(F.least("a", "b").alias("id1"), F.greatest("a", "b").alias("id2"), n1, n2, *["shared"] * exact)


def code_lists(band_df: DataFrame) -> DataFrame:
    """``item, codes``: of each item the buckets (``band_df`` holds ``item_id`` and the columns of a bucket) that it shares with another."""
    group = [c for c in band_df.columns if c != "item_id"]
    buckets = band_df.where("item_id IS NOT NULL").groupBy(*group).agg(F.collect_set("item_id").alias("_items")).where("size(_items) > 1")
    members = materialize(buckets.select(F.monotonically_increasing_id().alias("_code"), "_items"), "buckets")
    # Codes of four bytes where these are enough: the task and the row in it are both below them.
    row, task = F.col("_code").bitwiseAND(F.lit(2**33 - 1)), F.shiftright("_code", 33)
    most_row, tasks = members.agg(F.max(row), F.max(task) + 1).first()
    code = row * F.lit(tasks or 1) + task
    code = code.cast("int") if ((most_row or 0) + 1) * (tasks or 1) < 2**31 else code
    return members.select(code.alias("_code"), F.explode("_items").alias("item")).groupBy("item").agg(F.collect_list("_code").alias("codes"))


def _tiles(words: int, min_sim: float, coded: bool, exact: bool):
    """A function of batches sorted by ``_i, _j``: the pairs of items of chunks ``_i`` and ``_j``.

    It refers to no name of this module, so that tasks need not import it.
    """
    cells, slice_rows, lookup, users_a_word = CELLS, SLICE_ROWS, LOOKUP, USERS_A_WORD
    columns = ["item", "n", "_chunk", *[f"w{k}" for k in range(words)]] + ["codes"] * coded
    share = (1 - min_sim) / (1 + min_sim)  # of both sizes, at most so many users are in one basket only

    def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers ``start .. start + size - 1`` of all spans, one after the other."""
        return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)

    def slices(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
        """Runs of rows of together about ``most``."""
        ends, first = np.cumsum(size), 0
        while first < len(size):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] - size[first] + most, "right")))
            yield first, last
            first = last

    def folded(bits: np.ndarray, w: int) -> np.ndarray:
        """The bitmaps of ``w`` words: a hash modulo a divisor."""
        return np.bitwise_xor.reduce(bits.reshape(words // w, w, -1), axis=0) if w < words else bits

    class Tile:
        def __init__(self, table: pa.Table, same: bool):
            self.item, self.same = table["item"], same
            self.n = table["n"].to_numpy().astype(np.int64)
            # Words first, for the comparison of many with many; rows first, for that of pairs.
            self.bits = np.stack([table[f"w{k}"].to_numpy().view(np.uint64) for k in range(words)])
            self.rows = np.ascontiguousarray(self.bits.T)
            chunk = table["_chunk"].to_numpy()
            order = np.argsort(self.n, kind="stable")
            left = chunk[order] == chunk.min()
            self.left = order[left]
            self.right = self.left if same else order[~left]
            if coded:
                whole = table["codes"].combine_chunks()
                whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
                self.codes, self.size = whole.flatten().to_numpy(), np.diff(whole.offsets.to_numpy())

        def open(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Which of the pairs may be similar, by their sizes and all words of their bitmaps."""
            n1, n2 = self.n[a], self.n[b]
            fine = np.flatnonzero(np.minimum(n1, n2) >= min_sim * np.maximum(n1, n2) - 1e-9)
            for w in dict.fromkeys((min(words, 8), words)):
                kept = [fine[:0]]
                for first in range(0, len(fine), cells):
                    part = fine[first : first + cells]
                    # Any words give a bound.
                    differ = np.bitwise_count(self.rows[a[part], :w] ^ self.rows[b[part], :w]).sum(axis=1, dtype=np.int64)
                    kept.append(part[differ <= share * (n1[part] + n2[part]) + 1e-6])
                fine = np.concatenate(kept)
            return fine

        def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            if not len(self.left) or not len(self.right):
                return
            if not coded:
                yield from self.by_size()
                return
            row = np.repeat(np.arange(len(self.n)), self.size)
            mine = np.zeros(len(self.n), bool)
            mine[self.left] = True
            asked, of = self.codes[mine[row]], row[mine[row]]
            theirs = mine[row] if self.same else ~mine[row]
            known, owner = self.codes[theirs], row[theirs]
            order = np.argsort(known, kind="stable")
            known, owner = known[order], owner[order]
            low, high = np.searchsorted(known, asked, "left"), np.searchsorted(known, asked, "right")
            if (high - low).sum() * lookup > len(self.left) * len(self.right):
                yield from self.sharing(self.by_size())
                return
            # Pairs of one row come in one slice, to be told apart.
            begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
            if not len(begin):
                return
            for first, last in slices(np.add.reduceat(high - low, begin), slice_rows):
                at = slice(begin[first], begin[last] if last < len(begin) else len(of))
                count = (high - low)[at]
                a, b = np.repeat(of[at], count), owner[spans(low[at], count)]
                if self.same:
                    once = a < b
                    a, b = a[once], b[once]
                fine = self.open(a, b)
                a, b = np.divmod(np.unique(a[fine] * len(self.n) + b[fine]), len(self.n))
                yield a, b

        def by_size(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """All pairs that sizes and bitmaps leave open: rows are in order of their size, so those of fitting size are a run."""
            n1, n2, known = self.n[self.left], self.n[self.right], {}
            least, most = np.searchsorted(n2, min_sim * n1 - 1e-9, "left"), np.searchsorted(n2, n1 / min_sim + 1e-9, "right")
            limit1, limit2 = share * n1 + 0.01, share * n2 + 0.01
            first = 0
            while first < len(n1):
                low = max(first, int(least[first])) if self.same else int(least[first])
                last = min(len(n1), first + max(1, cells // max(1, int(most[first]) - low)))
                high = int(most[last - 1])
                w = words
                while not exact and w % 2 == 0 and w // 2 * users_a_word >= n1[last - 1]:
                    w //= 2
                if w not in known:
                    bits = folded(self.bits, w)
                    known[w] = np.ascontiguousarray(bits[:, self.left]), np.ascontiguousarray(bits[:, self.right])
                x, y = known[w]
                differ = np.zeros((last - first, max(0, high - low)), np.uint8 if w < 4 else np.uint16)
                for k in range(w):
                    differ += np.bitwise_count(x[k, first:last, None] ^ y[k, None, low:high])
                i, j = np.nonzero(differ <= limit1[first:last, None] + limit2[None, low:high])
                if self.same:
                    once = first + i < low + j
                    i, j = i[once], j[once]
                a, b = self.left[first + i], self.right[low + j]
                fine = self.open(a, b)
                yield a[fine], b[fine]
                first = last

        def sharing(self, found) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Those that share a code: the codes of a row are marked once for all its partners."""
            known, codes = np.unique(self.codes, return_inverse=True)
            start, mark = np.cumsum(self.size) - self.size, np.zeros(len(known), np.uint8)
            for a, b in found:
                order = np.argsort(a, kind="stable")
                a, b = a[order], b[order]
                cuts, hit = np.flatnonzero(np.r_[True, a[1:] != a[:-1], True]) if len(a) else [0], np.zeros(len(a), bool)
                for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                    mine = codes[start[a[first]] : start[a[first]] + self.size[a[first]]]
                    mark[mine] = 1
                    for low, high in slices(self.size[b[first:last]], slice_rows):
                        with_ = b[first + low : first + high]
                        size = self.size[with_]
                        hit[first + low : first + high] = np.maximum.reduceat(mark[codes[spans(start[with_], size)]], np.cumsum(size) - size) > 0
                    mark[mine] = 0
                yield a[hit], b[hit]

        def batches(self) -> Iterator[pa.RecordBatch]:
            for a, b in self.pairs():
                for first in range(0, len(a), 100_000):
                    x, y = a[first : first + 100_000], b[first : first + 100_000]
                    out = [self.item.take(pa.array(x)), self.item.take(pa.array(y)), pa.array(self.n[x]), pa.array(self.n[y])]
                    if exact:
                        differ = np.bitwise_count(self.rows[x] ^ self.rows[y]).sum(axis=1, dtype=np.int64)
                        out.append(pa.array((self.n[x] + self.n[y] - differ) // 2))
                    yield from pa.table(out, names=["a", "b", "n1", "n2", "shared"][: len(out)]).to_batches()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            where = np.stack([batch["_i"].to_numpy(), batch["_j"].to_numpy()])
            cuts = np.flatnonzero(np.r_[True, (where[:, 1:] != where[:, :-1]).any(axis=0), True]) if batch.num_rows else [0]
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                here = tuple(where[:, first].tolist())
                if here != key and held:
                    yield from Tile(pa.Table.from_batches(held), key[0] == key[1]).batches()
                    held = []
                key = here
                held.append(batch.slice(first, last - first).select(columns))
        if held:
            yield from Tile(pa.Table.from_batches(held), key[0] == key[1]).batches()

    return meet


def _step(n: str) -> Column:
    """A size in steps of a twentieth."""
    return F.floor(F.log(n) * F.lit(20.5)).cast("bigint")


def tile_jaccard(pairs: DataFrame, d: DataFrame, chunk_entries: int = CHUNK_ENTRIES) -> DataFrame:
    """``id1, id2, similarity``: the exact Jaccard of distinct pairs ``id1, id2, n1, n2``, of the distinct ``item, user``."""
    counted = tile_shared(pairs, d, chunk_entries)
    return counted.select("id1", "id2", jaccard(F.col("shared"), F.col("n1"), F.col("n2")).alias("similarity"))


def tile_shared(pairs: DataFrame, d: DataFrame, chunk_entries: int = CHUNK_ENTRIES) -> DataFrame:
    """``id1, id2, n1, n2, shared`` of distinct pairs ``id1, id2, n1, n2``: the sizes and the intersection of their baskets.

    Items are dealt over chunks of like size, large ones of one size by a hash; a basket is sent once to each chunk that it has a
    partner in, not once for each pair.
    """
    pairs = materialize(pairs, "open-pairs")
    ends = pairs.select(F.inline(F.array(*[F.struct(F.col(f"id{k}").alias("item"), F.col(f"n{k}").alias("n")) for k in (1, 2)]))).distinct()
    ends = materialize(ends, "open-items")
    # Of so many ranges of sizes each holds about as many users; a range of one size only may hold more, and is cut by a hash.
    by_size = sorted(tuple(r) for r in ends.groupBy(_step("n").alias("_n")).agg(F.sum("n")).collect())
    entries = sum(held for _, held in by_size)
    ranges, room = [], max(1, min(chunk_entries, entries // LEAST_RANGES))
    for least, held in by_size:
        if not ranges or ranges[-1][1] + held > room:
            ranges.append([least, 0])
        ranges[-1][1] += held
    cuts = [-(-held // chunk_entries) for _, held in ranges]
    most = max([*cuts, 1])

    def chunk(item: str, n: str):
        """The number of the range of a size, and of the cut in it."""
        at = sum((_step(n) >= F.lit(int(least))).cast("int") for least, _ in ranges[1:]) if ranges[1:] else F.lit(0)
        cut = F.pmod(F.xxhash64(item), F.element_at(F.array(*[F.lit(int(c)) for c in cuts or [1]]), at + 1)).cast("int")
        return at * most + cut

    asked = pairs.select("id1", "id2", chunk("id1", "n1").alias("_x"), chunk("id2", "n2").alias("_y"))
    asked = asked.select("id1", "id2", F.least("_x", "_y").alias("_i"), F.greatest("_x", "_y").alias("_j"))
    tiles = asked.select(F.explode(F.array("id1", "id2")).alias("item"), F.struct("_i", "_j").alias("_t")).distinct()
    tiles = tiles.groupBy("item").agg(F.collect_list("_t").alias("_tiles"))
    held = d.join(ends.select("item"), "item", "left_semi").groupBy("item").agg(F.collect_list("user").alias("users"))
    sent = held.join(tiles, "item").select("item", "users", F.explode("_tiles").alias("_t")).select("item", "users", F.col("_t._i").alias("_k"), F.col("_t._j").alias("_l"))
    ids = [T.StructField(c, pairs.schema[c].dataType) for c in ("id1", "id2")]
    schema = T.StructType([*ids, *[T.StructField(c, T.LongType()) for c in ("n1", "n2", "shared")]])
    return asked.groupBy("_i", "_j").cogroup(sent.groupBy("_k", "_l")).applyInArrow(_shared_users(), schema)


def _shared_users():
    """A function of the pairs of two chunks and of their baskets; it refers to no name of this module, so that tasks need not import it."""
    slice_rows = SLICE_ROWS

    def counted(pairs: pa.Table, sent: pa.Table) -> pa.Table:
        if not pairs.num_rows or not sent.num_rows:
            empty = pa.array([], pa.int64())
            return pa.table({"id1": pairs["id1"].slice(0, 0), "id2": pairs["id2"].slice(0, 0), "n1": empty, "n2": empty, "shared": empty})
        whole = sent["users"].combine_chunks()
        whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
        users, size = whole.flatten().dictionary_encode(), np.diff(whole.offsets.to_numpy())
        start, mark, known = np.cumsum(size) - size, np.zeros(len(users.dictionary), np.uint8), sent["item"].combine_chunks()
        users = users.indices.to_numpy()
        a, b = (pc.index_in(pairs[c], known).to_numpy() for c in ("id1", "id2"))
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        shared, cuts = np.zeros(len(a), np.int64), np.flatnonzero(np.r_[True, a[1:] != a[:-1], True])
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            mine = users[start[a[first]] : start[a[first]] + size[a[first]]]
            mark[mine] = 1
            ends, low = np.cumsum(size[b[first:last]]), 0
            while low < last - first:
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + slice_rows, "right")))
                with_ = b[first + low : first + high]
                n = size[with_]
                at = np.arange(n.sum()) + np.repeat(start[with_] - np.cumsum(n) + n, n)
                shared[first + low : first + high] = np.add.reduceat(mark[users[at]], np.cumsum(n) - n, dtype=np.int64)
                low = high
            mark[mine] = 0
        out = pairs.select(["id1", "id2"]).take(pa.array(order))
        return pa.table([out["id1"], out["id2"], pa.array(size[a].astype(np.int64)), pa.array(size[b].astype(np.int64)), pa.array(shared)], names=["id1", "id2", "n1", "n2", "shared"])

    return counted
