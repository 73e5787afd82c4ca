"""Alignment of two tokenisations of a text by pointer jumping.

Vocabulary A is byte-level BPE (a ``tokenizers`` file), B pieces with byte fallback (a
``sentencepiece`` model).  Both tokenisations of one text cover the same bytes, so a token is a
byte range.

1. In a run of texts every token points to the token that overlaps it and reaches farthest right:
   the one of the other side that holds its last byte, if that one ends later.  Where both end
   together the A token points to itself and the B token to it.
2. All pointers are doubled at once (``next = next[next]``) until they stand still, a number of
   rounds logarithmic in the longest chain.  Tokens with the same terminal are a group.
3. A terminal and the B token that ends with it are a link.

No token of either vocabulary reaches from a non-space over a space (checked when they are read), so a
text falls into units, a word with the space before it, that are encoded and aligned for
themselves: once for all times that a block of texts holds them.

Links are counted corpus-wide.  A task cuts its texts into blocks and keeps a dictionary of each
block's id pairs; documents hold codes of it.  Only the dictionaries are shuffled, by pair, for
the counts, and the counts back to the blocks.  So a pair that a third of all texts hold costs one
row a block, and no table of all pairs has to fit anywhere.

A task holds one block of about ``block_bytes`` of text (whole texts, at least one): its distinct
units with their tokens and a number for each unit of a text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corate.llm.common import arrow_rows, text_slices
from corate.session import materialize

# Before a space between two other characters no token goes on.
UNITS = re.compile(r"(?<=\S) (?=\S)")
SLICE = 1 << 18  # bytes that are aligned at once
BATCH_ROWS = 1024  # rows that a task takes in at once
RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_level_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(others)}


class Side:
    """The tokens of one vocabulary: their bytes, lengths, and decimal ids with what may follow them."""

    def __init__(self, tokens: list[bytes], between: str, last: str):
        self.bytes = tokens
        self.length = np.array([len(t) for t in tokens], np.int64)
        ids = [str(i) for i in range(len(tokens))]
        self.written = np.array([i + between for i in ids] + [i + last for i in ids], object)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Vocabularies:
    """Both tokenizers, from the bytes of their files."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(a_file.decode())
        self._a.encode_special_tokens = True  # their strings in a text are then ordinary text
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        alphabet = byte_level_alphabet()
        n = max(self._a.get_vocab().values()) + 1
        names = [self._a.id_to_token(i) or "" for i in range(n)]
        a = [bytes(map(alphabet.__getitem__, t)) if set(t) <= alphabet.keys() else t.encode() for t in names]
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        b = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a, self.b = Side(a, ",", "|"), Side(b, ",", ";")
        self.by_units = not any(re.search(r"\S ", t.decode("utf-8", "replace")) for t in (*a, *b))

    def units(self, text: str) -> list[str]:
        return UNITS.split(text) if self.by_units else [text]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """The ids of each text on both sides, with the space before it that B adds."""
        first = self._a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return ((x.ids, y) for x, y in zip(first, self._b.encode(texts, num_threads=1), strict=True))


@lru_cache(maxsize=2)
def _vocabularies(a_file: bytes, b_file: bytes) -> Vocabularies:
    """One copy for a worker, whatever the number of its tasks."""
    return Vocabularies(a_file, b_file)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal (an index of A) of each A and each B token, by their ends on one axis of bytes.

    Both sides cover the axis without gaps, and no token is empty.
    """
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the B token with the last byte of each A token
    over_b = np.searchsorted(ends_a, ends_b)
    target = np.where(ends_b[over_a] > ends_a, n + over_a, np.arange(n)) if n else np.empty(0, np.int64)
    target = np.concatenate([target, over_b])
    while True:
        doubled = target[target]
        if np.array_equal(doubled, target):
            return target[:n], target[n:]
        target = doubled


def _gives(side: Side, flat: np.ndarray, count: np.ndarray, wanted: list[bytes]) -> bool:
    """Do the tokens of each text give back its bytes?"""
    ends = np.append(0, np.cumsum(side.length[flat]))[np.cumsum(count)]
    return ends.tolist() == np.cumsum([len(w) for w in wanted]).tolist() and side.joined(flat.tolist()) == b"".join(wanted)


def _apart(vocabularies: Vocabularies, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For both sides the tokens of texts encoded one by one, and each text's number of them: none if they do not give back its bytes."""
    ids = list(vocabularies.encode(texts))
    for k, text in enumerate(texts):
        wanted = [b" " + text.encode()]
        if not all(_gives(s, np.array(i, np.int64), [len(i)], wanted) for s, i in zip((vocabularies.a, vocabularies.b), ids[k], strict=True)):
            ids[k] = ([], [])
    return [(np.array(list(chain.from_iterable(i[k] for i in ids)), np.int64), np.array([len(i[k]) for i in ids], np.int64)) for k in (0, 1)]


def _together(vocabularies: Vocabularies, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same of units without a space at either end, encoded as one text."""
    wanted = [b" " + t.encode() for t in texts]
    until = np.cumsum([len(w) for w in wanted])
    found = []
    for side, ids in zip((vocabularies.a, vocabularies.b), next(vocabularies.encode([" ".join(texts)])), strict=True):
        flat = np.array(ids, np.int64)
        last = np.searchsorted(np.cumsum(side.length[flat]), until)
        found.append((flat, np.diff(last + 1, prepend=0)))
        if last[-1] >= len(flat) or not _gives(side, *found[-1], wanted):
            return _apart(vocabularies, texts)
    return found


def align(vocabularies: Vocabularies, texts: list[str], encode=_apart) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Of several texts: counts (rows of n_a, n_b, n_groups), written groups, and the links as text and pair of ids.

    A text whose bytes the tokens do not give back has no tokens.
    """
    a, b = vocabularies.a, vocabularies.b
    (flat_a, n_a), (flat_b, n_b) = encode(vocabularies, texts)
    ends_a, ends_b = np.cumsum(a.length[flat_a]), np.cumsum(b.length[flat_b])
    to_a, to_b = terminals(ends_a, ends_b)
    closes = to_a == np.arange(len(to_a))
    group = np.cumsum(closes) - closes  # of each A token; a terminal is the last one of its group
    linked_a = np.flatnonzero(closes)
    linked_b = np.searchsorted(ends_b, ends_a[linked_a])
    # Written in order of groups, A before B: a token comes after the other side's tokens of earlier groups.
    upto_a, upto_b = np.append(0, linked_a + 1), np.append(0, linked_b + 1)
    closes_b = np.zeros(len(flat_b), bool)
    closes_b[linked_b] = True
    written = np.empty(len(flat_a) + len(flat_b), object)
    written[np.arange(len(flat_a)) + upto_b[group]] = a.written[flat_a + closes * len(a.bytes)]
    written[np.arange(len(flat_b)) + upto_a[group[to_b] + 1]] = b.written[flat_b + closes_b * len(b.bytes)]
    doc = np.repeat(np.arange(len(texts)), n_a)[linked_a]
    groups, at = [], 0
    for end in np.cumsum(n_a + n_b).tolist():
        groups.append("".join(written[at:end].tolist())[:-1])  # without the last mark
        at = end
    counts = np.stack([n_a, n_b, np.bincount(doc, minlength=len(texts))], 1)
    return counts, groups, doc, flat_a[linked_a] * len(b.bytes) + flat_b[linked_b]


class Block:
    """Documents of a task until they are a block: the numbers of their units, and what is known of each unit."""

    def __init__(self, vocabularies: Vocabularies):
        self.vocabularies = vocabularies
        self.number: dict[str, int] = {}  # of each distinct unit
        self.counts, self.groups, self.links, self.edges = [], [], [], [np.zeros(1, np.int64)]
        self.bad: set[int] = set()  # units without tokens
        self.ids, self.docs, self.bytes, self.known = [], [], 0, 0

    def add(self, ids: pa.Array, raw: list[bytes], size: int) -> None:
        texts = [t.decode("utf-8", "replace") for t in raw]
        docs = [self._numbers(self.vocabularies.units(t)) if t else [] for t in texts]
        self._align_new()
        for k, d in enumerate(docs):
            if self.bad and not self.bad.isdisjoint(d):  # what counts is the whole text
                docs[k] = self._numbers([texts[k]])
            if texts[k].encode() != raw[k]:  # not UTF-8
                docs[k] = []
        self._align_new()
        self.ids.append(ids)
        self.docs += [np.array(d, np.int64) for d in docs]
        self.bytes += size

    def _numbers(self, units: list[str]) -> list[int]:
        put, known = self.number.setdefault, self.number
        return [put(u, len(known)) for u in units]

    def _align_new(self) -> None:
        new = list(islice(self.number, self.known, None))
        self.known = len(self.number)
        at = 0
        while at < len(new):
            end, size = at, 0
            while end < len(new) and size < SLICE:
                size, end = size + len(new[end]), end + 1
            self._align_units(new[at:end])
            at = end

    def _align_units(self, units: list[str]) -> None:
        outer = [u[0].isspace() or u[-1].isspace() for u in units] if self.vocabularies.by_units else [True] * len(units)
        counts, groups = np.zeros((len(units), 3), np.int64), [""] * len(units)
        unit, pair = np.empty(0, np.int64), np.empty(0, np.int64)
        for encode, apart in ((_together, False), (_apart, True)):
            which = [k for k, o in enumerate(outer) if o == apart]
            if which:
                c, written, u, p = align(self.vocabularies, [units[k] for k in which], encode)
                counts[which] = c
                for k, g in zip(which, written, strict=True):
                    groups[k] = g
                unit, pair = np.append(unit, np.array(which)[u]), np.append(pair, p)
        first = len(self.groups)
        self.bad.update(first + k for k, g in enumerate(groups) if not g)
        self.counts.append(counts)
        self.groups += groups
        self.links.append(pair[np.argsort(unit, kind="stable")])
        self.edges.append(self.edges[-1][-1] + np.cumsum(np.bincount(unit, minlength=len(units))))

    def batch(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        """Its rows; the first carries the block's dictionary of pairs with their counts."""
        n = len(self.docs)
        unit = np.concatenate(self.docs)
        upto = np.append(0, np.cumsum([len(d) for d in self.docs]))
        counts = np.concatenate([*self.counts, np.zeros((1, 3), np.int64)])[unit]
        counts = np.append(np.zeros((1, 3), np.int64), np.cumsum(counts, 0), 0)
        counts = counts[upto[1:]] - counts[upto[:-1]]
        digests = []
        for d in self.docs:
            groups = ";".join([self.groups[u] for u in d.tolist()])
            digests.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        # The distinct pairs of each document, as codes of the dictionary.
        edges = np.concatenate(self.edges)
        links = np.concatenate([*self.links, np.empty(0, np.int64)])
        pairs, code = np.unique(links, return_inverse=True)
        many = edges[unit + 1] - edges[unit] if len(unit) else unit
        at = np.arange(many.sum()) + np.repeat((edges[unit] if len(unit) else unit) - (np.cumsum(many) - many), many)
        doc = np.repeat(np.repeat(np.arange(n), np.diff(upto)), many)
        own, times = np.unique(doc * max(1, len(pairs)) + code[at], return_counts=True)
        first = np.searchsorted(own, np.arange(n + 1) * max(1, len(pairs)))
        code = own % max(1, len(pairs))
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, code, times)
        used = total > 0  # not those of units whose texts have no tokens
        code, pairs, total = (np.cumsum(used) - 1)[code], pairs[used], total[used]
        lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))
        once = np.minimum(np.arange(n + 1), 1) * len(pairs)
        dictionary = lambda values: pa.ListArray.from_arrays(pa.array(once, pa.int32()), pa.array(values, pa.int64()))
        columns = [
            pa.array(np.full(n, number), pa.int64()),
            pa.concat_arrays(self.ids),
            *[pa.array(counts[:, k], pa.int64()) for k in range(3)],
            pa.array(digests, pa.string()),
            lists(code, pa.int32()),
            lists(times, pa.int64()),
            dictionary(pairs),
            dictionary(total),
        ]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _encoded(docs: DataFrame, files: tuple[bytes, bytes], block_bytes: int) -> DataFrame:
    """block, id, n_a, n_b, n_groups, groups_sha256, codes, times; and once a block: pairs, counts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(files)
    kind = docs.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("id", kind),
            *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups")],
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("codes", T.ArrayType(T.IntegerType())),
            *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("times", "pairs", "counts")],
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = _vocabularies(*shared.value)
        number = TaskContext.get().partitionId() << 32
        arrow, block = None, Block(vocabularies)
        for batch in batches:
            ids = batch.column(0)
            arrow = arrow or pa.schema(
                [("block", pa.int64()), ("id", ids.type), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64())]
                + [("groups_sha256", pa.string()), ("codes", pa.list_(pa.int32()))]
                + [(c, pa.list_(pa.int64())) for c in ("times", "pairs", "counts")]
            )
            for at, data, offsets in text_slices(batch.column(1)):
                raw = [data[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                block.add(ids.slice(at, len(raw)), raw, len(data))
                if block.bytes >= block_bytes:
                    yield block.batch(number, arrow)
                    number, block = number + 1, Block(vocabularies)
        if block.docs:
            yield block.batch(number, arrow)

    return docs.mapInArrow(encode, schema)


def _weigh(kind: T.DataType):
    """(documents of a block, counts of its pairs) to the rows of the result."""

    def weigh(docs: pa.Table, known: pa.Table) -> pa.Table:
        docs, known = docs.combine_chunks(), known.combine_chunks()
        size = len(known)
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        if size:
            at = known["code"].to_numpy()
            count[at], best[at] = known["count"].to_numpy(), known["is_best"].to_numpy().astype(np.int64)
        codes, times = (pa.concat_arrays(docs[c].chunks) if len(docs) else pa.array([], pa.list_(pa.int64())) for c in ("codes", "times"))
        code, n = (x.flatten().to_numpy(zero_copy_only=False) for x in (codes, times))
        first = np.append(0, np.cumsum(codes.value_lengths().to_numpy(zero_copy_only=False)))

        def total(values: np.ndarray) -> pa.Array:
            upto = np.append(0, np.cumsum(values))
            return pa.array(upto[first[1:]] - upto[first[:-1]], pa.int64())

        return pa.table(
            {
                "id": docs["id"],
                "n_a": docs["n_a"],
                "n_b": docs["n_b"],
                "n_groups": docs["n_groups"],
                "n_links": total(n),
                "n_best": total(n * best[code]) if size else total(n),
                "count_sum": total(n * count[code]) if size else total(n),
                "groups_sha256": docs["groups_sha256"],
            }
        )

    fields = [T.StructField(c, T.LongType()) for c in RESULT[:-1]]
    return weigh, T.StructType([T.StructField("id", kind), *fields, T.StructField("groups_sha256", T.StringType())])


def read_vocabularies(folder: str, a_name: str = "byte_bpe_50k.json", b_name: str = "piece_bpe_32k.model") -> tuple[bytes, bytes]:
    """The files of both vocabularies (some 2 MB), read by the driver and sent to the tasks."""
    return Path(folder, a_name).read_bytes(), Path(folder, b_name).read_bytes()


def pair_counts(encoded: DataFrame, width: int) -> DataFrame:
    """pair, count and is_best (no other pair with its B id counts more), over all blocks."""
    entries = encoded.where(F.size("pairs") > 0).select(F.explode(F.arrays_zip("pairs", "counts")).alias("e"))
    counted = entries.groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.counts").alias("count"))
    counted = materialize(counted, "pair-counts")
    by_b = (F.col("pair") % width).alias("b")
    most = counted.groupBy(by_b).agg(F.max("count").alias("most"))  # as many rows as B has ids at most
    rated = counted.withColumn("b", by_b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("is_best"))
    return materialize(rated, "pairs-rated")


def align_tokens(
    docs: DataFrame, files: tuple[bytes, bytes], id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8 << 20
) -> DataFrame:
    """One row per input row: ``id_col`` and n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text that is null or empty, or whose tokens do not give back its bytes on
    both sides (a text with U+2581, say), has no tokens: zeros, and '' for the digest.  Ids may
    be null or repeat: each row is aligned for itself, and its links count as often as the
    row is there.  Other columns are ignored.  An empty table gives an empty result.
    """
    width = len(_vocabularies(*files).b.bytes)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        encoded = materialize(_encoded(rows, files, block_bytes), "aligned")
    rated = pair_counts(encoded, width)
    asked = encoded.where(F.size("pairs") > 0).select(F.col("block").alias("asked_by"), F.posexplode("pairs").alias("code", "pair"))
    known = asked.join(rated, "pair").select("asked_by", "code", "count", "is_best")
    weigh, schema = _weigh(docs.schema[id_col].dataType)
    kept = encoded.select("block", "id", "n_a", "n_b", "n_groups", "groups_sha256", "codes", "times")
    found = kept.groupBy("block").cogroup(known.groupBy("asked_by")).applyInArrow(weigh, schema)
    return found.withColumnRenamed("id", id_col)
