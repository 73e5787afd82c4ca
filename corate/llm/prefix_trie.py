"""Prefix trie of conversations by adaptive radix trees.

A turn's id is the first 128 bits of the SHA-256 of its role and text; a conversation is the list of
its turns' ids.  Tasks cut their conversations into slices of about ``slice_turns`` turns.  In
a slice the ids are numbered, a conversation's key is its numbers as 4 big-endian bytes each, and the keys go into
an adaptive radix tree: nodes hold 4, 16, 48 or 256 children, growing as they fill, and a run of bytes without a
branch lies on one node (path compression).  Byte depths that end a turn are nodes of the trie,
also those inside a compressed path; the others are not.

A trie node is known by the chained hash of its turns.  What each slice finds out about its nodes is combined by it:

1. members and the least of them are sums and minima over the slices;
2. a node belongs to its least member, so to one slice.  Sums over a subtree count each
   node in the slice that it belongs to: every slice sums what belongs to it, in its own tree, and the slices' sums are added.

So a turn that a third of all conversations start with is one row of each slice.  Texts are hashed where they are read and
never shuffled.  A conversation is one row of 24 bytes a turn; a task holds one slice, some 1 KB a turn.
The members that end at a node are hashed as a stream of sorted pieces, however many they are.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import WORD
from corate.session import materialize

WIDTH = 4  # bytes of a turn's number in a slice
ROOT = bytes(16)
LAYOUTS = (4, 16, 48, 256)
PIECE_IDS = 50_000


class Node:
    """The bytes on the way to a node, what ends there, and its children in one of four layouts.

    4 and 16: ``index`` holds the sorted bytes of the children, in the order of ``children``.
    48: ``index`` holds for each of 256 bytes the place of its child, plus 1.
    256: ``children`` has a place for each byte.
    """

    __slots__ = ("path", "ends", "layout", "index", "children")

    def __init__(self, path: bytes):
        self.path, self.ends = path, []
        self.layout, self.index, self.children = 4, bytearray(), []

    def find(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = bisect_left(self.index, byte)
            return self.children[at] if at < len(self.index) and self.index[at] == byte else None
        if self.layout == 48:
            return self.children[self.index[byte] - 1] if self.index[byte] else None
        return self.children[byte]

    def add(self, byte: int, child: Node) -> None:
        """A child under a byte that has none."""
        if self.layout < 256 and len(self.children) == self.layout:
            self._grow()
        if self.layout <= 16:
            at = bisect_left(self.index, byte)
            self.index.insert(at, byte)
            self.children.insert(at, child)
        elif self.layout == 48:
            self.children.append(child)
            self.index[byte] = len(self.children)
        else:
            self.children[byte] = child

    def _grow(self) -> None:
        children = self.each()
        self.layout = LAYOUTS[LAYOUTS.index(self.layout) + 1]
        if self.layout == 16:
            return
        self.index = bytearray(256) if self.layout == 48 else bytearray()
        self.children = [] if self.layout == 48 else [None] * 256
        for byte, child in children:
            self.add(byte, child)

    def each(self) -> list[tuple[int, Node]]:
        """Bytes and children, in the order of the bytes."""
        if self.layout <= 16:
            return list(zip(self.index, self.children, strict=True))
        if self.layout == 48:
            return [(b, self.children[at - 1]) for b, at in enumerate(self.index) if at]
        return [(b, child) for b, child in enumerate(self.children) if child is not None]


def _matching(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``path`` are those of ``key`` from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    return next(k for k, byte in enumerate(path) if key[at + k : at + k + 1] != path[k : k + 1])


def insert(root: Node, key: bytes, value: int) -> None:
    node, at = root, 0
    while True:
        same = _matching(node.path, key, at)
        if same < len(node.path):  # part the node: its lower part becomes a child of the upper one
            lower = Node(node.path[same + 1 :])
            lower.ends, lower.layout, lower.index, lower.children = node.ends, node.layout, node.index, node.children
            branch = node.path[same]
            node.path, node.ends, node.layout, node.index, node.children = node.path[:same], [], 4, bytearray(), []
            node.add(branch, lower)
        at += same
        if at == len(key):
            node.ends.append(value)
            return
        child = node.find(key[at])
        if child is None:
            child = Node(key[at + 1 :])
            child.ends.append(value)
            node.add(key[at], child)
            return
        node, at = child, at + 1


def turn_nodes(root: Node, width: int = WIDTH) -> Iterator[tuple[int, int, int, list]]:
    """(parent, depth, last turn, what ends there) of each byte depth that ends a turn, parents first.

    A parent is the place of its node in this order; the root's is -1, and so is its last turn.
    """
    yield -1, 0, -1, root.ends
    place = 1
    # node, byte depth above it, its bytes since the last turn that ended, place of that turn's node
    stack = [(child, 0, bytes([byte]), 0) for byte, child in reversed(root.each())]
    while stack:
        node, above, edge, parent = stack.pop()
        edge += node.path
        whole = len(edge) // width
        for k in range(whole):
            turn = int.from_bytes(edge[k * width : (k + 1) * width], "big")
            here = node.ends if (k + 1) * width == len(edge) else []
            yield parent, above // width + k + 1, turn, here
            parent, place = place, place + 1
        rest, depth = edge[whole * width :], above + whole * width
        stack += [(child, depth, rest + bytes([byte]), parent) for byte, child in reversed(node.each())]


NODES = pa.schema(
    [("slice", pa.int64()), ("no", pa.int64()), ("parent", pa.int64()), ("node", pa.binary()), ("above", pa.binary())]
    + [(c, pa.int64()) for c in ("depth", "words", "n", "least", "n_ends")]
    + [("ends", pa.list_(pa.int64()))]
)
NODES_DDL = (
    "slice bigint, no bigint, parent bigint, node binary, above binary, depth bigint, words bigint, n bigint, least bigint, "
    "n_ends bigint, ends array<bigint>"
)


def slice_nodes(convs: list[tuple[int, list[bytes], list[int]]], number: int) -> pa.RecordBatch:
    """The trie nodes of some conversations (id, turns' ids, turns' words), by an adaptive radix tree."""
    names = sorted({t for _, turns, _ in convs for t in turns})
    numbers = {t: k for k, t in enumerate(names)}
    words = [0] * len(names)
    root = Node(b"")
    for conv, turns, sizes in convs:
        ids = [numbers[t] for t in turns]
        for t, size in zip(ids, sizes, strict=True):
            words[t] = size
        insert(root, np.array(ids, f">u{WIDTH}").tobytes(), conv)
    found = list(turn_nodes(root))
    n, least = [len(f[3]) for f in found], [min(f[3], default=None) for f in found]
    hashes = [ROOT]
    for parent, _, turn, _ in found[1:]:
        hashes.append(hashlib.blake2b(hashes[parent] + names[turn], digest_size=16).digest())
    for k in range(len(found) - 1, 0, -1):  # children come after their parents
        parent = found[k][0]
        n[parent] += n[k]
        least[parent] = least[k] if least[parent] is None else min(least[parent], least[k])
    columns = [
        [number] * len(found),
        range(len(found)),
        [f[0] for f in found],
        hashes,
        [None, *(hashes[f[0]] for f in found[1:])],
        [f[1] for f in found],
        [0, *(words[f[2]] for f in found[1:])],
        n,
        least,
        [len(f[3]) for f in found],
        [f[3] for f in found],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, NODES, strict=True)], schema=NODES)


def subtree_sums(rows: pa.Table) -> pa.Table:
    """node, n_children, n_leaves and saved: what the nodes that belong to a slice add to each node over them in it."""
    rows = rows.sort_by("no")
    column = lambda c: rows[c].to_numpy()
    parent, depth, n, words = (column(c) for c in ("parent", "depth", "all_n", "words"))
    own = column("least") == column("all_least")
    children = np.zeros(len(parent), np.int64)
    np.add.at(children, parent[1:], own[1:].astype(np.int64))
    leaves = (own & (n == column("all_ends"))).astype(np.int64)
    saved = own * (n - 1) * words
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts)[:-1]:  # the last level is the root
        for total in (leaves, saved):
            np.add.at(total, parent[level], total[level])
    return pa.table({"node": rows["node"], "n_children": children, "n_leaves": leaves, "saved": saved})


def rebuilt_conversations(
    conversations: DataFrame, family: int, heads: int, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """conv and turns (id and words) of each conversation: it begins with the first turns of its family's first one.

    Conversation c takes h = crc32(c as text) % (heads + 1) turns from c - c % family, then its own from the (h + 1)-th on.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    written = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.unhex(F.substring(F.sha2(written, 256), 1, 32)).alias("id"),
            F.regexp_count(text, F.lit(WORD)).alias("words"),
        ).alias("t"),
    )
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words")))
    convs = materialize(turns.groupBy("conv").agg(ordered.alias("own")), "conversations")
    first = convs.where(F.col("conv") % family == 0).select(F.col("conv").alias("base"), F.slice("own", 1, heads).alias("head"))
    h = (F.crc32(F.col("conv").cast("string")) % (heads + 1)).cast("int")
    none = F.array().cast("array<struct<id:binary,words:int>>")
    head = F.slice(F.coalesce("head", none), F.lit(1), h)
    own = F.slice("own", h + 1, F.size("own"))
    based = convs.withColumn("base", F.col("conv") - F.col("conv") % family)
    return based.join(first, "base", "left").select("conv", F.concat(head, own).alias("turns"))


def _slices(convs: DataFrame, slice_turns: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            turns = batch.column("turns")
            flat, edge = turns.flatten(), [0, *np.cumsum(turns.value_lengths().to_numpy()).tolist()]
            ids, words = flat.field("id").to_pylist(), flat.field("words").to_pylist()
            for conv, a, b in zip(batch.column("conv").to_pylist(), edge[:-1], edge[1:], strict=True):
                held.append((conv, ids[a:b], words[a:b]))
                size += b - a + 1
                if size >= slice_turns:
                    yield slice_nodes(held, number)
                    number, held, size = number + 1, [], 0
        if held:
            yield slice_nodes(held, number)

    return convs.mapInArrow(build, NODES_DDL)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of node and conv to node, first conv and the joined ids, in pieces."""
    node, ids = None, []

    def piece() -> pa.RecordBatch:
        joined = ",".join(map(str, ids))
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([joined])], names=["node", "first", "ids"])

    for batch in batches:
        for name, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if ids and (name != node or len(ids) == PIECE_IDS):
                yield piece()
                ids = []
            node = name
            ids.append(conv)
    if ids:
        yield piece()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to node and the SHA-256 of all its ids, holding one piece at a time."""
    node, digest = None, None
    done: list[tuple[bytes, str]] = []

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "sha"])

    for batch in batches:
        for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids"), strict=True):
            if name != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = name, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_py().encode())
            if len(done) == 10_000:
                yield rows()
                done = []
    if node is not None:
        done.append((node, digest.hexdigest()))
    if done:
        yield rows()


def ends_hashes(nodes: DataFrame) -> DataFrame:
    """node and the SHA-256 of the ids that end there, ascending, joined by commas."""
    ends = nodes.where("n_ends > 0").select("node", F.explode("ends").alias("conv"))
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = ends.repartitionByRange(n, "node", "conv").sortWithinPartitions("node", "conv")
    pieces = pieces.mapInArrow(_pieces, "node binary, first bigint, ids string")
    pieces = pieces.repartition(n, "node").sortWithinPartitions("node", "first")
    return pieces.mapInArrow(_hash_pieces, "node binary, sha string")


def prefix_trie(
    conversations: DataFrame,
    family: int = 20,
    heads: int = 3,
    slice_turns: int = 100_000,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations (``rebuilt_conversations``).

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    Null roles and texts are empty.  Null turns come first; rows of one conversation with the same turn are ordered by
    their id, and a repeated row is one more turn.  Rows without a conversation id are left out.
    Other columns are ignored.  An empty table gives no node, not even a root.
    """
    convs = rebuilt_conversations(conversations, family, heads, conv_col, turn_col, role_col, text_col)
    nodes = materialize(_slices(convs, slice_turns), "trie-slices")
    known = nodes.groupBy("node").agg(
        F.first("above").alias("above"),
        F.first("depth").alias("depth"),
        F.sum("n").alias("all_n"),
        F.min("least").alias("all_least"),
        F.sum("n_ends").alias("all_ends"),
    )
    known = materialize(known, "trie-nodes")
    weighed = nodes.select("slice", "no", "parent", "node", "depth", "words", "least").join(
        known.select("node", "all_n", "all_least", "all_ends"), "node"
    )
    parts = weighed.groupBy("slice").applyInArrow(subtree_sums, "node binary, n_children bigint, n_leaves bigint, saved bigint")
    total = lambda c: F.sum(c).alias(c)
    sums = parts.groupBy("node").agg(total("n_children"), total("n_leaves"), total("saved"))
    parents = known.select(F.col("node").alias("above"), F.col("all_least").alias("parent_conv"))
    found = known.join(sums, "node").join(ends_hashes(nodes), "node", "left").join(parents, "above", "left")
    return found.select(
        F.col("all_least").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("all_n").alias("n_convs"),
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
