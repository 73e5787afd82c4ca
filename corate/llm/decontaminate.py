"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are normalised (A-Z lower-cased, every run of other
ASCII signs one space; a pattern of up to 32 signs that repeats over more than 512 signs is
shortened to about 512, in texts and items alike).  If a stretch of ``w`` signs of an item occurs in a text with at
most e edits, at least w + 1 - q (e + 1) of its q-grams occur there on nearly
one diagonal (position in the text less position in the item).  So:

1. Each text's q-grams are looked up in the index of the benchmark's.
2. Hits are counted per item in overlapping bands of diagonals, a hit in two
   bands, such that any e + 1 neighbouring diagonals lie in one band.
3. A band keeps the regions in which a window of ``w`` signs has as many distinct
   q-grams as the lemma asks for.
4. The region's stretch of the item is aligned with the text within the band; it
   counts if its edit distance is within the rate allowed.

Items of fewer than ``least`` signs are found whole, on word borders, if they have ``short_words`` words or more;
still shorter ones only where a text consists of nothing else.

The benchmark comes to the driver in blocks of bounded size, one after another; each block's index is written to the shared
folder, and Spark hands the file to every executor, whose workers map it into memory.  Nothing is
broadcast, and the benchmark may be of any size.  The documents, which may be any number, are never shuffled.  Long texts
are looked through in pieces that overlap by more than a match can span, so that a task holds a bounded number of hits.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, fields
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import LOWER, Words, fresh, mix, text_of, text_slices, with_columns_last
from corate.llm.substrings import BASE, RunHashes
from corate.llm.url_rules import share_file

_SPACE = np.ones(256, bool)
_SPACE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
MATCH = "array<struct<item: bigint, begin: int, end: int, item_begin: int, item_end: int, edits: int>>"


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The normalised bytes of several texts, without space at their ends, and their offsets."""
    space = _SPACE[data]
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    edge = offsets[1:-1]
    last = edge[(edge > 0)] - 1
    after[last] = True
    keep = ~space | ~after  # of a run of spaces the last, if a letter follows
    first = offsets[:-1][np.diff(offsets) > 0]
    lead = space.copy()  # a text's leading space goes too
    begins = np.zeros(len(data), bool)
    begins[first] = True
    if len(data):
        word_seen = np.cumsum(~space)
        base = np.zeros(len(data), np.int64)
        base[first] = np.diff(np.concatenate([[0], word_seen[first] - ~space[first]]))
        lead &= word_seen == np.cumsum(base)
        keep &= ~lead
    out = LOWER[np.where(space, np.uint8(32), data)][keep]
    upto = np.concatenate([[0], np.cumsum(keep)])
    return out, upto[offsets]


PERIOD, REPEATED = 32, 512
PIECE = 1 << 15  # signs of a text that are looked through at once


def shorten_repeats(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with every pattern of up to PERIOD signs that repeats over more than REPEATED signs cut to about as many.

    Whole patterns go from the end of the run, so what follows it keeps its place in the pattern.
    """
    for p in range(1, PERIOD + 1):
        if len(data) <= REPEATED:
            break
        same = data[p:] == data[:-p]
        half = len(same) // (REPEATED // 2) * (REPEATED // 2)
        if not same[:half].reshape(-1, REPEATED // 2).all(1).any():  # a long run fills such a stretch
            continue
        inner = offsets[1:-1]
        border = (inner[:, None] - np.arange(1, p + 1)).ravel()  # pairs of signs of different texts
        same[border[(border >= 0) & (border < len(same))]] = False
        step = np.diff(np.concatenate([[0], same, [0]]).astype(np.int8))
        begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        surplus = np.maximum(0, end + p - begin - REPEATED) // p * p
        keep = np.ones(len(data) + 1, np.int64)
        long = surplus > 0
        edge = np.zeros(len(data) + 1, np.int64)
        np.add.at(edge, end[long] + p - surplus[long], 1)
        np.add.at(edge, end[long] + p, -1)
        keep = np.cumsum(edge)[:-1] == 0
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        data = data[keep]
    return data, offsets


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return shorten_repeats(*normalise(data, offsets))


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q bytes (8 to 16) from each position."""
    n = len(data) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    eight = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), 0, (1,))
    return mix(eight[:n] * np.uint64(0x9E3779B97F4A7C15) ^ eight[q - 8 : q - 8 + n])


@dataclass
class GramIndex:
    """Q-grams of a block of items: sorted keys, and for each the positions in the block's joined bytes.

    ``short_*``: the short items apart: their places in ``ids``, words, hash of the words, and bytes.
    """

    q: int
    rate: float
    window: int
    ids: list
    numbers: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    places: np.ndarray
    table: np.ndarray
    short: dict[int, dict[int, list[tuple[int, bytes, bool]]]]

    @classmethod
    def build(cls, ids: list, texts: list[str], q: int, rate: float, window: int, least: int, short_words: int) -> GramIndex:
        parts = [plain(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for t in texts]
        numbers = [k for k, p in enumerate(parts) if len(p) >= max(least, q)]
        long = [parts[k] for k in numbers]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in long])]).astype(np.int64)
        data = np.concatenate([*long, np.zeros(0, np.uint8)])
        found = [(grams(p, q), np.arange(max(0, len(p) - q + 1)) + o) for p, o in zip(long, offsets, strict=False)]
        key = np.concatenate([f[0] for f in found] + [np.empty(0, np.uint64)])
        place = np.concatenate([f[1] for f in found] + [np.empty(0, np.int64)])
        order = np.argsort(key, kind="stable")
        keys, first = np.unique(key[order], return_index=True)
        bits = max(16, int(len(keys)).bit_length() + 4)
        table = np.zeros(1 << bits, bool)
        table[(keys & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
        short: dict = {}
        for k, p in enumerate(parts):
            if 0 < len(p) < max(least, q):
                words = _run_keys(p, np.array([0, len(p)]))
                n = len(words.start)
                hashed = int(RunHashes(words.hashes(_SAME), BASE)(np.array([0]), np.array([n]))[0])
                short.setdefault(n, {}).setdefault(hashed, []).append((k, p.tobytes(), n < short_words))
        return cls(q, rate, window, list(ids), np.array(numbers, np.int64), data, offsets, keys, np.append(first, len(key)), place[order], table, short)

    def packed(self) -> bytes:
        """One file: a pickled head, then the arrays, each from a multiple of 64 bytes on."""
        arrays = {f.name: getattr(self, f.name) for f in fields(self) if isinstance(getattr(self, f.name), np.ndarray)}
        shapes, at = {}, 0
        for name, array in arrays.items():
            shapes[name] = (array.dtype.str, len(array), at)
            at += -(-array.nbytes // 64) * 64
        head = pickle.dumps(({f.name: getattr(self, f.name) for f in fields(self) if f.name not in arrays}, shapes))
        lead = len(head).to_bytes(8, "little") + head
        lead += bytes(-len(lead) % 64)
        return lead + b"".join(a.tobytes() + bytes(-a.nbytes % 64) for a in arrays.values())

    @classmethod
    def mapped(cls, path: str) -> GramIndex:
        file = np.memmap(path, np.uint8, mode="r")
        n = int.from_bytes(file[:8].tobytes(), "little")
        rest, shapes = pickle.loads(file[8 : 8 + n].tobytes())
        base = -(-(8 + n) // 64) * 64
        arrays = {}
        for name, (kind, size, at) in shapes.items():
            arrays[name] = np.frombuffer(file, np.dtype(kind), size, base + at) if size else np.empty(0, np.dtype(kind))
        return cls(**rest, **arrays)

    def hits(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in the text bytes, position in the block) of equal q-grams."""
        key = grams(data, self.q)
        if len(key) == 0 or len(self.keys) == 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        maybe = np.flatnonzero(self.table[(key & np.uint64(len(self.table) - 1)).astype(np.int64)])
        at = np.searchsorted(self.keys, key[maybe])
        at[at == len(self.keys)] = 0
        same = self.keys[at] == key[maybe]
        maybe, at = maybe[same], at[same]
        count = self.first[at + 1] - self.first[at]
        spread = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(maybe, count), self.places[np.repeat(self.first[at], count) + spread]


_SAME = np.arange(256, dtype=np.uint8)


def _run_keys(data: np.ndarray, offsets: np.ndarray) -> Words:
    between = np.zeros(256, bool)
    between[32] = True
    return Words(data, offsets, between)


def find_short(index: GramIndex, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int, int, int]]:
    """The first occurrence of each short item in each text, on word borders; those of few words only as a whole text."""
    if not index.short or len(data) == 0:
        return []
    words = _run_keys(data, offsets)
    hashes, found = RunHashes(words.hashes(_SAME), BASE), {}
    stop = words.start + words.length
    for n, items in index.short.items():
        begin = np.arange(max(0, len(words.start) - n + 1))
        begin = begin[words.doc[begin] == words.doc[begin + n - 1]] if len(begin) else begin
        key = hashes(begin, begin + n)
        for k in np.flatnonzero(np.isin(key, np.array(list(items), np.uint64))).tolist():
            first, last = begin[k], begin[k] + n - 1
            d, a, b = int(words.doc[first]), int(words.start[first]), int(stop[last])
            raw = data[a:b].tobytes()
            for item, text, whole in items[int(key[k])]:
                if text == raw and (not whole or (a == offsets[d] and b == offsets[d + 1])):
                    found.setdefault((d, item), (d, item, a - int(offsets[d]), b - int(offsets[d]), 0, b - a, 0))
    return list(found.values())


def find_pieces(index: GramIndex, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int, int, int]]:
    """``find_regions``, with long texts in overlapping pieces.  A match is given once."""
    if len(index.numbers) == 0:
        return []
    longest = int(np.diff(index.offsets).max())
    overlap = 2 * longest + 4 * index.q
    step = max(PIECE, 2 * overlap)
    short = np.diff(offsets) <= step + overlap
    if short.all():
        runs, out = [], []
        first = 0
        while first < len(short):  # as many texts as make a piece
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + step, side="right")) - 1)
            runs.append((first, min(last, len(short))))
            first = runs[-1][1]
        for a, b in runs:
            part = find_regions(index, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            out += [(d + a, *m) for d, *m in part]
        return out
    out = []
    for d in range(len(short)):
        text, seen = data[offsets[d] : offsets[d + 1]], []
        for at in range(0, max(1, len(text) - overlap), step):
            piece = text[at : at + step + overlap]
            for _, item, begin, end, *rest in find_regions(index, piece, np.array([0, len(piece)])):
                m = (item, begin + at, end + at, *rest)
                if not any(s[0] == item and s[1] <= m[1] and m[2] <= s[2] for s in seen):
                    seen.append(m)
        out += [(d, *m) for m in seen]
    return out


def banded_distance(pattern: np.ndarray, text: np.ndarray, low: int, high: int, limit: int) -> tuple[int, int, int] | None:
    """Least edits that turn ``pattern`` into a stretch of ``text``, on diagonals low to high (text less pattern position).

    Returns (edits, begin, end) of the stretch, or nothing beyond ``limit``.
    """
    width = high - low + 1
    far = limit + 1
    j = np.arange(width) + low  # text position before pattern position 0
    cost = np.where((j >= 0) & (j <= len(text)), 0, far).astype(np.int32)
    begin = j.copy()
    steps = np.arange(width, dtype=np.int32)
    for i in range(1, len(pattern) + 1):
        j = j + 1  # the text position that a diagonal has reached after i signs of the pattern
        inside = (j >= 0) & (j <= len(text))
        sign = text[np.clip(j - 1, 0, max(0, len(text) - 1))] if len(text) else np.zeros(width, np.uint8)
        new = cost + ((sign != pattern[i - 1]) | (j < 1))
        start = begin.copy()
        skip = np.append(cost[1:] + 1, far)  # a sign of the pattern without one of the text
        better = skip < new
        new[better], start[better] = skip[better], np.append(begin[1:], 0)[better]
        new[~inside] = far
        # A sign of the text without one of the pattern: the least of the costs to the left plus the steps.
        level = new - steps
        low_at = np.maximum.accumulate(np.where(level <= np.minimum.accumulate(level), np.arange(width), 0))
        cost = np.minimum(level[low_at] + steps, far)
        begin = start[low_at]
        cost[~inside] = far
        if cost.min() >= far:
            return None
    best = int(cost.argmin())
    return (int(cost[best]), int(begin[best]), int(j[best])) if cost[best] <= limit else None


def find_regions(index: GramIndex, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int, int, int]]:
    """Verified matches in several normalised texts: text, place of the item, begin, end, item begin, item end, edits."""
    at, place = index.hits(data)
    doc = np.searchsorted(offsets, at, side="right") - 1
    whole = at + index.q <= offsets[doc + 1] if len(at) else np.empty(0, bool)
    at, place, doc = at[whole], place[whole], doc[whole]
    if len(at) == 0:
        return []
    item = np.searchsorted(index.offsets, place, side="right") - 1
    length = np.diff(index.offsets)
    q, rate = index.q, index.rate
    # Each item's window: the least stretch that counts, or all of a shorter item; its edits and the lemma's bound.
    window = np.minimum(length, index.window)
    edits = np.minimum((rate * window).astype(np.int64), np.maximum(0, (window - q) // q))
    bound = np.maximum(1, window + 1 - q * (edits + 1))
    most = int((rate * length.max()) + 1)  # edits of a whole item: half a band
    i = at - offsets[doc]
    j = place - index.offsets[item]
    diagonal = i - j + int(length.max())
    band = diagonal // most
    doc, item, band, i, j = (np.concatenate([x, x]) for x in (doc, item, band, i, j))
    band[len(band) // 2 :] -= 1  # a band spans two such strips, so that neighbouring bands overlap by one
    order = np.lexsort((j, band, item, doc))
    doc, item, band, i, j = (x[order] for x in (doc, item, band, i, j))
    fresh = np.ones(len(j), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
    new = fresh.copy()
    new[1:] |= j[1:] != j[:-1]
    doc, item, band, i, j, fresh = (x[new] for x in (doc, item, band, i, j, fresh))
    group = np.cumsum(fresh) - 1
    # Hit k opens a good window if the hit ``bound`` - 1 later is still in its group and near enough.
    ahead = np.arange(len(j)) + bound[item] - 1
    reach = np.minimum(ahead, len(j) - 1)
    good = (ahead < len(j)) & (group[reach] == group) & (j[reach] - j <= window[item] - q)
    opens = np.flatnonzero(good)
    found: dict[tuple[int, int], list[tuple[int, int, int, int, int]]] = {}
    k = 0
    while k < len(opens):
        begin, last = opens[k], reach[opens[k]]
        while k + 1 < len(opens) and opens[k + 1] <= last:
            k += 1
            last = max(last, reach[opens[k]])
        k += 1
        d, t = int(doc[begin]), int(item[begin])
        spread = i[begin : last + 1] - j[begin : last + 1]
        found.setdefault((d, t), []).append((int(j[begin]), int(j[last]) + q, int(spread.min()), int(spread.max()), int(i[begin])))
    matches = []
    for (d, t), regions in found.items():
        text = data[offsets[d] : offsets[d + 1]]
        pattern = index.data[index.offsets[t] : index.offsets[t + 1]]
        done: list[tuple[int, int, int, int, int]] = []
        for j0, j1, low, high, _ in sorted(regions, key=lambda r: (r[0] - r[1], r)):
            if any(x[0] <= j0 + low and j1 + high <= x[1] for x in done):
                continue  # that stretch of the text is a match already
            if match := _verify(pattern, text, j0, j1, low, high, int(window[t]), rate, most):
                if not any(match[0] >= x[0] and match[1] <= x[1] for x in done):
                    done.append(match)
        matches += [(d, int(index.numbers[t]), *m) for m in sorted(done)]
    return matches


def _verify(
    pattern: np.ndarray, text: np.ndarray, j0: int, j1: int, low: int, high: int, window: int, rate: float, slack: int
) -> tuple[int, int, int, int, int] | None:
    """Align a stretch of the item, widened to ``window`` signs, with the text: begin, end, item begin, item end, edits."""
    # All of the item, then the region, then each window that holds the region or lies in it:
    # edits near its ends may hide q-grams of a match, and a long region may match in part.
    spans = [(0, len(pattern)), (j0, j1)]
    starts = range(max(0, min(j0, j1 - window)), min(max(j0, j1 - window), len(pattern) - window) + 1)
    spans += [(a, a + window) for a in starts]
    for a, b in dict.fromkeys(spans):
        if b - a < window:
            continue
        if low == high and 0 <= a + low and b + low <= len(text) and np.array_equal(pattern[a:b], text[a + low : b + low]):
            return a + low, b + low, a, b, 0
        start = max(0, a + low - slack)
        part = text[start : max(start, b + high + slack)]
        got = banded_distance(pattern[a:b], part, a + low - slack - start, a + high + slack - start, int(rate * (b - a)))
        if got:
            return start + got[1], start + got[2], a, b, got[0]
    return None


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """(ids, texts) of the benchmark in blocks of at most ``block_bytes`` bytes, or one item.

    Items come to the driver one partition at a time.
    """
    rows = benchmark.where(F.col(text_col).isNotNull()).select(id_col, text_col)
    ids, texts, size = [], [], 0
    for item, text in rows.toLocalIterator():
        if texts and size + len(text.encode()) > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(text)
        size += len(text.encode())
    if texts:
        yield ids, texts


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    q: int = 12,
    rate: float = 0.05,
    window: int = 64,
    least: int = 32,
    short_words: int = 4,
    block_bytes: int = 2 << 20,
    name: str = "matches",
) -> DataFrame:
    """``docs`` with an array of matches (item, begin, end, item_begin, item_end, edits).

    Positions are bytes of the normalised texts.  Stretches of ``window`` signs of
    an item count, or all of a shorter item.  An item of fewer than ``least`` signs counts where it stands whole between
    words, if it has ``short_words`` words or more, else only where it is the whole text: a word
    alone tells nothing.  An item without letters or digits matches nothing, nor do null texts; an item with a null id
    matches as null; items with equal texts match each.  An empty benchmark leaves every array empty.
    An input column called ``name`` is replaced.
    """
    files = []
    for ids, texts in item_blocks(benchmark, item_id, item_text, block_bytes):
        index = GramIndex.build(ids, texts, q, rate, window, least, short_words)
        files.append(share_file(docs.sparkSession, index.packed(), "benchmark"))
    if not files:
        return with_columns_last(docs, {name: F.array().cast(MATCH)})
    return with_columns_last(docs, {name: _matcher(files)(text_of(text_col))})


@lru_cache(maxsize=4)
def _mapped(file: str) -> GramIndex:
    return GramIndex.mapped(SparkFiles.get(file))


def _matcher(files: list[str]):
    """A function of a text column that finds the matches of all blocks, one block at a time."""
    spot = ("begin", "end", "item_begin", "item_end", "edits")
    kind = pa.list_(pa.struct([("item", pa.int64()), *[(n, pa.int32()) for n in spot]]))

    @F.arrow_udf(MATCH)
    def match(texts: pa.Array) -> pa.Array:
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for at, data, offsets in text_slices(texts):
            normal = plain(data, offsets)
            for file in files:
                index = _mapped(file)
                for d, item, *places in [*find_pieces(index, *normal), *find_short(index, *normal)]:
                    out[at + d].append({"item": index.ids[item], **dict(zip(spot, places, strict=True))})
        return pa.array(out, kind)

    return match


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any match."""
    name = fresh("_matches", docs)
    return find_contamination(docs, benchmark, name=name, **options).where(F.size(name) == 0).drop(name)
