"""Substring deduplication by relative Lempel-Ziv parsing.

A window is ``window`` consecutive words.  A word goes if some window over it also starts in an
earlier document; what goes is judged on the input.

1. Anchors.  Of the grams (runs of ``gram`` words) of a window the one with the least hash is the
   window's own anchor.  Equal windows have equal own anchors, so a window that
   repeats has an anchor that other documents have too.  About one word in 18 starts an anchor.
2. Reference.  The home of an anchor is its first occurrence: least document, then least position.  Homes
   are cut into blocks of ``block`` words with margins; the anchors in a block are its index.  Only
   blocks that a later document asks for are cut, so a document meets the blocks that
   hold something of it and no others.
3. Factors.  A document is parsed against each of its blocks: from the next anchor that is not yet in a
   factor, the longest match with the block to both sides is a factor.  One of ``window`` words or
   more is a duplicate span: its home is an earlier document.
4. Factor boundaries.  A window that reaches over the end of its anchor's factor is not in that home, but may be
   in another earlier document, where it is no match with the home either.  Such
   windows, and those of anchors that a home repeats, are open.  First the surroundings of their anchors, as far as
   a window with the anchor reaches, are looked up by a 128-bit hash: a later document with the same ones has all the
   windows.  The open windows of the others are looked up one by one in the same way.
5. Spans of a document are merged, and their words go.

Whole copies are set aside before: of documents with the same words the first is parsed, and the later
ones go as a whole.  Texts are moved only for documents that share an anchor.  Anchors and windows
are aggregated in each task before the shuffle; the joins are ones that Spark splits when skewed.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corate.llm.common import Words, arrow_rows, keyed_rows, mix, text_of, text_slices, without_ids
from corate.session import materialize

BYTES = np.arange(256, dtype=np.uint8)
# Odd bases of the two run hashes.
BASE, OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
PARSED = "struct<n: bigint, digest: binary, sha: string, pos: array<int>, key: array<bigint>>"
FACTORS = "array<struct<begin: bigint, end: bigint>>"
OPEN = "array<struct<c1: bigint, c2: bigint, windows: array<struct<at: bigint, h1: bigint, h2: bigint>>>>"
ROWS = 256  # segments that are parsed at once: some 50 MB of arrays


class RunHashes:
    """Hashes of runs of words: differences of a running sum, scaled to one power of ``base``."""

    def __init__(self, key: np.ndarray, base: np.uint64):
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.upto = np.append(np.uint64(0), np.cumsum(key * np.multiply.accumulate(np.full(len(key), inverse))))
        self.power = np.multiply.accumulate(np.full(len(key) + 1, base))

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.upto[end] - self.upto[begin]) * self.power[begin])


def own_anchors(gram: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` successive grams is, the leftmost of equal ones."""
    if len(gram) < width:
        return np.empty(0, np.int64)
    at, span = np.arange(len(gram)), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[:-step], at[step:]
        at = np.where(gram[right] < gram[left], right, left)
        span += step
    return at


class Text:
    """Word hashes of several texts laid end to end, and the windows that lie in one of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        words = Words(data, offsets)
        self.key, self.first = words.hashes(BYTES), words.first
        self.hashes = RunHashes(self.key, BASE)
        at = np.arange(max(0, len(self.key) - gram + 1))
        self.gram = self.hashes(at, at + gram)
        n = np.maximum(np.diff(self.first) - window + 1, 0)
        self.doc = np.repeat(np.arange(len(n)), n)
        self.window = self.first[self.doc] + np.arange(len(self.doc)) - np.repeat(np.cumsum(n) - n, n)
        self.own = own_anchors(self.gram, window - gram + 1)[self.window]


def parse_texts(text: Column, window: int, gram: int) -> Column:
    """n (words), digest and sha of the words joined by spaces, pos and key of the anchors."""

    @F.arrow_udf(PARSED)
    def parse(column: pa.Array) -> pa.Array:
        n, digest, sha, pos, key = [], [], [], [], []
        for _, data, offsets in text_slices(column):
            found = Text(data, offsets, window, gram)
            new = np.ones(len(found.own), bool)
            new[1:] = found.own[1:] != found.own[:-1]
            anchor, doc = found.own[new], found.doc[new]
            first = np.searchsorted(doc, np.arange(len(offsets)))
            lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))  # noqa: E731, B023
            pos.append(lists(anchor - found.first[doc], pa.int32()))
            key.append(lists(found.gram[anchor].view(np.int64), pa.int64()))
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                words = data[a:b].tobytes().split()
                joined = b" ".join(words)
                n.append(len(words))
                digest.append(xxhash.xxh3_128_digest(joined))
                sha.append(hashlib.sha256(joined).hexdigest())
        whole = lambda parts, kind: pa.concat_arrays(parts) if parts else pa.array([], pa.list_(kind))
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sha, pa.string()), whole(pos, pa.int32()), whole(key, pa.int64())],
            names=["n", "digest", "sha", "pos", "key"],
        )

    return parse(text)


def kept_words(text: Column, spans: Column) -> Column:
    """n_removed and the SHA-256 of the words outside the spans, joined by spaces."""

    @F.arrow_udf("struct<n_removed: bigint, sha: string>")
    def keep(texts: pa.Array, covered: pa.Array) -> pa.Array:
        removed, sha = [], []
        for raw, parts in zip(texts.cast(pa.binary()), covered, strict=True):
            words = raw.as_py().split()
            edge = np.zeros(len(words) + 1, np.int64)
            flat = parts.values
            np.add.at(edge, flat.field("begin").to_numpy(), 1)
            np.add.at(edge, flat.field("end").to_numpy(), -1)
            stays = np.cumsum(edge)[:-1] == 0
            left = [words[k] for k in np.flatnonzero(stays).tolist()]
            removed.append(len(words) - len(left))
            sha.append(hashlib.sha256(b" ".join(left)).hexdigest())
        return pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(sha, pa.string())], names=["n_removed", "sha"])

    return keep(text, spans)


class RelativeParse:
    """The steps above over one table with columns node (the documents' order, unique) and text."""

    def __init__(self, window: int, gram: int, block: int):
        self.window, self.gram, self.block = window, gram, block
        self.margin = window - gram  # words that a window may have before its anchor

    def asked(self, singles: DataFrame) -> DataFrame:
        """node, pos, home, home_pos: each anchor that is not its own home's but that some other document has."""
        occurrences = singles.select("node", F.explode(F.arrays_zip("pos", "key")).alias("a")).select("node", "a.pos", "a.key")
        homes = (
            occurrences.groupBy("key")
            .agg(F.min(F.struct("node", "pos")).alias("first"), F.max("node").alias("last"))
            .where("first.node <> last")
            .select("key", F.col("first.node").alias("home"), F.col("first.pos").alias("home_pos"))
        )
        homes = materialize(homes, "anchor-homes")
        later = occurrences.join(homes, "key").where("node <> home OR pos <> home_pos")
        return materialize(later.select("node", "pos", "home", "home_pos"), "anchors-asked")

    def texts(self, rows: DataFrame, asked: DataFrame, broadcast_rows: int) -> DataFrame:
        """node, text, asks and blocks of each document that asks or is asked."""
        asks = asked.groupBy("node").agg(F.collect_list(F.struct("pos", "home", "home_pos")).alias("asks"))
        number = F.expr(f"home_pos div {self.block}").cast("int").alias("number")
        parts = asked.where("node <> home").select(F.col("home").alias("node"), number).distinct()
        blocks = parts.groupBy("node").agg(F.collect_list("number").alias("blocks"))
        wanted = materialize(asks.join(blocks, "node", "full_outer"), "texts-wanted")
        if wanted.count() <= broadcast_rows:  # their ids alone go to every task; texts that nobody wants stay where they are
            rows = rows.join(F.broadcast(wanted.select("node")), "node", "left_semi")
        return materialize(rows.select("node", "text").join(wanted, "node"), "texts")

    def segments(self, texts: DataFrame) -> DataFrame:
        """node, home, number, start, words, pos, shift: the surroundings of anchors with one home block and one distance from it.

        Anchors that a home repeats have no home: number is null.
        """
        kind = texts.schema["node"].dataType
        schema = T.StructType(
            [
                T.StructField("node", kind),
                T.StructField("home", kind),
                T.StructField("number", T.IntegerType()),
                T.StructField("start", T.IntegerType()),
                T.StructField("words", T.StringType()),
                T.StructField("pos", T.ArrayType(T.IntegerType())),
                T.StructField("shift", T.IntegerType()),
            ]
        )
        window, margin, block = self.window, self.margin, self.block

        def cut(node, text: bytes, asks: list[dict]) -> Iterator[tuple]:
            words, groups = text.split(), defaultdict(list)
            for a in asks:
                pos, home, home_pos = a["pos"], a["home"], a["home_pos"]
                place = (None, None, 0) if home == node else (home, home_pos // block, home_pos - pos)
                groups[place].append(pos)
            for (home, number, shift), pos in groups.items():
                pos.sort()
                start = max(0, pos[0] - margin)
                yield node, home, number, start, _text(words[start : pos[-1] + window]), pos, shift

        wanted = texts.where("asks IS NOT NULL").select("node", "text", "asks")
        return wanted.mapInArrow(_each_row(cut, schema), schema)

    def blocks(self, texts: DataFrame) -> DataFrame:
        """home, number, home_start and home_words of the reference blocks that are asked for."""
        schema = T.StructType(
            [
                T.StructField("home", texts.schema["node"].dataType),
                T.StructField("number", T.IntegerType()),
                T.StructField("home_start", T.IntegerType()),
                T.StructField("home_words", T.StringType()),
            ]
        )
        window, margin, block = self.window, self.margin, self.block

        def cut(node, text: bytes, numbers: list[int]) -> Iterator[tuple]:
            words = text.split()
            for number in numbers:
                start = max(0, number * block - margin)
                yield node, number, start, _text(words[start : (number + 1) * block + window])

        wanted = texts.where("blocks IS NOT NULL").select("node", "text", "blocks")
        return wanted.mapInArrow(_each_row(cut, schema), schema)

    def parsed(self, segments: DataFrame, blocks: DataFrame) -> DataFrame:
        """node, factors (of a window or more) and open: anchors with open windows, the hash of their surroundings, and the windows."""
        columns = ["node", "start", "words", "pos", "shift", "home_start", "home_words"]
        met = segments.where("number IS NOT NULL").join(blocks, ["home", "number"]).select(*columns)
        alone = segments.where("number IS NULL").withColumns({"home_start": F.lit(0), "home_words": F.lit("")})
        window, gram = self.window, self.gram
        schema = f"node {segments.schema['node'].dataType.simpleString()}, factors {FACTORS}, open {OPEN}"

        def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for top in range(0, len(whole), ROWS):
                    batch = whole.slice(top, ROWS)
                    yield pa.RecordBatch.from_arrays([batch.column("node"), *parse_segments(batch, window, gram)], names=["node", "factors", "open"])

        both = met.unionByName(alone.select(*columns))
        return materialize(both.mapInArrow(parse, schema), "factors")

    def spans(self, parsed: DataFrame) -> DataFrame:
        """node, begin, end of the words that go."""
        factors = parsed.select("node", F.explode("factors").alias("f")).select("node", "f.*")
        open_ = parsed.select("node", F.explode("open").alias("o")).select("node", "o.*")
        seen = open_.groupBy("c1", "c2").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
        seen = materialize(seen.select("c1", "c2", "first"), "surroundings")
        open_ = materialize(open_.join(seen, ["c1", "c2"], "left").select("node", "first", "windows"), "open-anchors")
        reach = [F.array_min("windows.at").alias("begin"), (F.array_max("windows.at") + self.window).alias("end")]
        same = open_.where("node > first").select("node", *reach)

        rest = open_.where("first IS NULL OR node = first").select("node", F.explode("windows").alias("w")).select("node", "w.*")
        first = rest.groupBy("h1", "h2").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
        first = materialize(first.select("h1", "h2", "first"), "open-windows")
        hits = rest.join(first, ["h1", "h2"]).where("node > first")
        hits = hits.select("node", F.col("at").alias("begin"), (F.col("at") + self.window).alias("end"))
        return factors.unionByName(same).unionByName(hits)


def _text(words: list[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "replace")


def _each_row(cut, schema: T.StructType):
    """A function of batches that yields what ``cut`` yields for the node, text (bytes) and third column of each row."""
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = to_arrow_schema(schema)
            out = []
            texts = batch.column(1).cast(pa.binary())
            for node, text, more in zip(batch.column(0).to_pylist(), texts, batch.column(2), strict=True):
                for row in cut(node, text.as_py(), more.as_py()):
                    out.append(row)
                    if len(out) == ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def _lists(row: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """One list for each of ``n`` rows; ``row`` (ascending) tells where each value belongs."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), values)


def _structs(**fields: np.ndarray | pa.Array) -> pa.Array:
    arrays = [pa.array(f.view(np.int64), pa.int64()) if isinstance(f, np.ndarray) else f for f in fields.values()]
    return pa.StructArray.from_arrays(arrays, names=list(fields))


def parse_segments(batch: pa.RecordBatch, window: int, gram: int) -> tuple[pa.Array, pa.Array]:
    """Factors and open anchors of each row, all rows at once.

    Words of all rows lie on one axis, those that are compared with a home word on another one.
    """
    n = len(batch)
    _, data, offsets = next(text_slices(batch.column("words"), 1 << 62))
    mine = Text(data, offsets, window, gram)
    _, data, offsets = next(text_slices(batch.column("home_words"), 1 << 62))
    words = Words(data, offsets)
    home, home_first = words.hashes(BYTES), words.first
    start, shift, home_start = (batch.column(c).to_numpy().astype(np.int64) for c in ("start", "shift", "home_start"))
    pos = batch.column("pos")
    row = np.repeat(np.arange(n), pos.value_lengths().to_numpy())
    origin = mine.first[:-1] - start  # place of a document's word 0 on the axis
    anchor = pos.flatten().to_numpy() + origin[row]

    # Word k of a segment lies on word k + ahead of its home block, for k from begin to end.
    ahead = shift + start - home_start
    begin = np.maximum(0, -ahead)
    size = np.maximum(begin, np.minimum(np.diff(mine.first), np.diff(home_first) - ahead)) - begin
    edge = np.append(0, np.cumsum(size))
    met = np.repeat(np.arange(n), size)
    k = np.arange(edge[-1]) + (begin - edge[:-1])[met]
    differs = np.flatnonzero(mine.key[mine.first[met] + k] != home[(home_first[:-1] + ahead)[met] + k])
    # From each anchor the longest match to both sides.
    back = (mine.first[:-1] + begin - edge[:-1])[row]
    after = np.searchsorted(differs, anchor - back)
    low = np.maximum(np.append(-1, differs)[after] + 1, edge[:-1][row]) + back
    high = np.minimum(np.append(differs, edge[-1])[after], edge[1:][row]) + back
    new = np.ones(len(low), bool)
    new[1:] = low[1:] != low[:-1]
    long = new & (high - low >= window)
    factors = _structs(begin=(low - origin[row])[long], end=(high - origin[row])[long])

    nth = np.minimum(np.searchsorted(anchor, mine.own), max(0, len(anchor) - 1))
    left = (anchor[nth] == mine.own) & ~((mine.window >= low[nth]) & (mine.window + window <= high[nth]))
    at, by = mine.window[left], nth[left]  # both ascending
    which = np.unique(by)
    around = np.maximum(anchor[which] - window + gram, mine.first[row[which]]), np.minimum(anchor[which] + window, mine.first[row[which] + 1])
    place = (anchor[which] - around[0] + window * (around[1] - around[0])).astype(np.uint64)
    second = RunHashes(mine.key, OTHER)
    windows = _structs(at=at - origin[row[by]], h1=mine.hashes(at, at + window), h2=second(at, at + window))
    opened = _structs(
        c1=mix(mine.hashes(*around) + place), c2=mix(second(*around) + place), windows=_lists(np.searchsorted(which, by), len(which), windows)
    )
    return _lists(row[long], n, factors), _lists(row[which], n, opened)


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    gram: int = 16,
    block: int = 256,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """One row per input row: ``id_col``, n_words, n_removed, kept_sha256.

    Words are runs of non-space bytes, compared unchanged.  A null text has none.  Documents are ordered
    by their id.  Where ids repeat or are null, null ones come last and different texts of one id are ordered by a hash of
    the row; rows of one id with the same words are one document and get the same result.  A text of fewer than
    ``window`` words loses nothing.  Other columns are ignored; an empty table gives an empty result.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be in 1 .. window")
    task = RelativeParse(window, gram, block)
    with arrow_rows(docs.sparkSession, ROWS):  # all of these steps are written
        rows, key = keyed_rows(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")), "id")
        rows = rows.select(F.col(key).alias("node"), "id", "text")
        parsed = rows.select("node", "id", parse_texts(F.col("text"), window, gram).alias("p")).select("node", "id", "p.*")
        parsed = materialize(parsed, "anchors")

        first = parsed.where(F.col("n") >= window).groupBy("digest").agg(
            F.min(F.struct("node", "id")).alias("first"), F.count(F.lit(1)).alias("copies")
        )
        first = materialize(first.where("copies > 1").select("digest", "first"), "copied")
        copies = parsed.select("node", "id", "n", "digest").join(first, "digest").where("node <> first.node")
        copies = materialize(
            copies.select("node", F.col("first.node").alias("original"), "n", F.col("id").eqNullSafe(F.col("first.id")).alias("same")), "copies"
        )
        singles = without_ids(parsed, "node", copies.select("node"), broadcast_rows)

        asked = task.asked(singles)
        texts = task.texts(rows, asked, broadcast_rows)
        spans = task.spans(task.parsed(task.segments(texts), task.blocks(texts)))
        spans = spans.groupBy("node").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
        changed = texts.select("node", "text").join(spans, "node").select("node", kept_words(F.col("text"), F.col("spans")).alias("k"))
        changed = materialize(changed.select("node", "k.*"), "changed")

    nothing = F.sha2(F.lit(""), 256)
    whole = copies.where("NOT same").select("node", F.col("n").alias("n_removed"), nothing.alias("sha"))
    alike = copies.where("same").select("node", F.col("original")).join(changed.withColumnRenamed("node", "original"), "original")
    outcome = changed.unionByName(whole).unionByName(alike.select("node", "n_removed", "sha"))
    outcome = outcome.withColumnRenamed("sha", "new_sha")
    return parsed.select("node", "id", "n", "sha").join(outcome, "node", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_words"),
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("new_sha", "sha").alias("kept_sha256"),
    )
