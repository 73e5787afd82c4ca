"""Prefix trie against brute force, and the radix tree alone."""

import hashlib
import random
from zlib import crc32

import duckdb
import pytest

from corate.llm import sql
from corate.llm.prefix_trie import LAYOUTS, Node, insert, prefix_trie, turn_nodes

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 4
        path = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {p: 0 for p in members}
    saved, leaves = dict(children), dict(children)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, convs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(convs) - 1) * len(p[-1][1].encode().split()) if p else 0
    out = []
    for p, convs in members.items():
        joined = ",".join(map(str, sorted(ends.get(p, []))))
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(joined.encode()).hexdigest()
        out.append((min(convs), len(p), parent, len(convs), children[p], leaves[p], saved[p], digest))
    return sorted(out)


def run(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(tuple(r) for r in prefix_trie(table, **options).collect())


def conversations(seed, n=150, deep=40):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), n):
        length = rng.choice([1, 2, 3, 5, 8, deep])
        for t in range(length):
            text = rng.choice(["", "a", "b b", "c c c"]) if rng.random() < 0.8 else f"only {rng.random()}"
            rows.append((c, t, rng.choice(["user", "user", None]), text if rng.random() < 0.95 else None))
    return rows


@pytest.mark.parametrize("slice_turns", [1, 50, 100_000])
def test_equals_brute_force(spark, slice_turns):
    rows = conversations(slice_turns)
    assert run(spark, rows, slice_turns=slice_turns) == brute(rows)


def test_many_equal_conversations(spark):
    """A third of the conversations are the same, and all start alike."""
    rows = []
    for c in range(600):
        rows += [(c, 0, "system", "be brief"), (c, 1, "user", "hello there"), (c, 2, "user", "x" if c % 3 else f"own {c}")]
    assert run(spark, rows, slice_turns=100) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, "user", "second"), (1, 0, "user", "second"), (2, 5, None, None), (2, 7, "", "")]
    rows += [(None, 0, "user", "lost"), (40, 0, "a", "b"), (41, 0, "ab", ""), (43, 0, "user", " \t "), (61, 0, "user", "x"), (60, 0, "user", "y")]
    rows += [(20 * k + 1, 0, "user", "base is absent") for k in range(5, 9)]
    assert run(spark, rows) == brute(rows)


def test_roles_and_texts_are_not_run_together(spark):
    rows = [(c, t, "u" if c % 2 else "us", "ser" if c % 2 else "er") for c in (100, 101, 120, 121) for t in range(5)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    names = ["conv", "base", "own", "head", "node", "n", "slice", "depth", "t", "turns", "least"]
    rows = conversations(9, 30)
    table = spark.createDataFrame([(*r, *[3] * len(names)) for r in rows], SCHEMA + ", " + ", ".join(f"{n} int" for n in names))
    assert sorted(tuple(r) for r in prefix_trie(table).collect()) == brute(rows)


def test_long_conversation(spark):
    """Three of 5,000 turns, each the beginning of the one before."""
    n = 5000
    found = run(spark, [(c, t, "user", f"t{t}") for c in (0, 1, 2) for t in range(n - c)])
    assert [r[1] for r in found] == list(range(n + 1)) if len({r[0] for r in found}) == 1 else len(found) == n + 1
    by_depth = {r[1]: r for r in found}
    assert [by_depth[d][3] for d in (0, 1, n - 2, n - 1, n)] == [3, 3, 3, 2, 1]
    assert {r[5] for r in found} == {1}
    assert [by_depth[d][6] for d in (0, n - 2, n)] == [2 * (n - 2) + 1, 2 + 1, 0]


def test_sql_with_absent_bases_and_null_turns():
    rows = conversations(4, 60, deep=6) + [(7, None, "user", "null turn"), (None, 1, "user", "x")]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(sql.OP12).fetchall()) == brute(rows)


def tree(keys):
    root = Node(b"")
    for k, key in enumerate(keys):
        insert(root, key, k)
    return root


def walk(node):
    yield node
    for _, child in node.each():
        yield from walk(child)


def test_layouts_grow_as_children_come():
    for n in (1, 4, 5, 16, 17, 48, 49, 256):
        order = list(range(n))
        random.Random(n).shuffle(order)
        root = tree([bytes([b]) for b in order])
        assert root.layout == next(x for x in LAYOUTS if x >= n)
        assert [b for b, _ in root.each()] == list(range(n))
        assert [root.find(b).ends[0] for b in order] == list(range(n))
        assert root.find(n) is None if n < 256 else True


def test_paths_are_compressed_and_parted():
    root = tree([b"\0\0\0\1\0\0\0\2", b"\0\0\0\1\0\0\0\3", b"\0\0\0\1"])
    assert len(list(walk(root))) == 5  # root, the first turn, the bytes that both second turns begin with, two ends
    assert [(parent, depth, turn, ends) for parent, depth, turn, ends in turn_nodes(root)] == [
        (-1, 0, -1, []), (0, 1, 1, [2]), (1, 2, 2, [0]), (1, 2, 3, [1]),
    ]


def test_random_keys_give_every_turn_aligned_prefix():
    rng = random.Random(1)
    keys = [b"".join(rng.choice([0, 1, 255, 256, 70000]).to_bytes(4, "big") for _ in range(rng.randrange(6))) for _ in range(400)]
    found, paths = {}, []
    for parent, depth, turn, ends in turn_nodes(tree(keys)):
        paths.append(b"" if parent < 0 else paths[parent] + turn.to_bytes(4, "big"))
        assert len(paths[-1]) == 4 * depth
        found[paths[-1]] = sorted(ends)
    assert len(found) == len(paths)
    assert found.keys() == {k[:d] for k in keys for d in range(0, len(k) + 1, 4)}
    assert all(found[p] == [i for i, k in enumerate(keys) if k == p] for p in found)
