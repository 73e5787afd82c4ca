"""Similar pairs are made where two chunks of items meet; none is shuffled."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from corate.functions.hashing import hash_family
from corate.operators import tiles
from corate.operators.index import dense_index
from corate.operators.minhash import band_keys, baskets, signatures
from corate.operators.sketch import sketches
from corate.plans.similar import similar_pairs
from tests.test_lsh_chunks import _above


def _jaccard(a, b):
    return len(a & b) / len(a | b)


def _sets(rng, universe):
    base = [set(rng.sample(range(universe), rng.choice((3, 12, 40)))) for _ in range(12)]
    near = {k: base[k % 12] - set(rng.sample(sorted(base[k % 12]), k % 3)) | {rng.randrange(universe)} for k in range(60)}
    return near | {100 + k: set(base[0]) for k in range(5)}


@pytest.mark.parametrize("universe, words", [(90, 2), (3000, 32)])
@pytest.mark.parametrize("lookup, least, cells, slice_rows", [(0, 1, 131_072, 1_000_000), (10**9, 3, 7, 5), (8, 8, 50, 1_000_000)])
def test_pairs_of_two_chunks_equal_brute_force(spark, monkeypatch, universe, words, lookup, least, cells, slice_rows):
    """By code, by the order of sizes, and by that with codes; the similarity of what is left."""
    for name, value in (("LOOKUP", lookup), ("LEAST_CHUNKS", least), ("CELLS", cells), ("SLICE_ROWS", slice_rows)):
        monkeypatch.setattr(tiles, name, value)
    sets = _sets(random.Random(universe), universe)
    d = spark.createDataFrame([(i, u) for i, s in sets.items() for u in s], "item bigint, user bigint")
    sk, exact = sketches(d, words, F.col("user")), universe <= 64 * words
    share = {i: {u % 7 for u in s if u < universe // 4} for i, s in sets.items()}
    lists = spark.createDataFrame([(i, sorted(s)) for i, s in share.items() if s], "item bigint, codes array<int>")
    for codes in (None, lists):
        want = {p: _jaccard(*(sets[i] for i in p)) for p in itertools.combinations(sorted(sets), 2) if codes is None or share[p[0]] & share[p[1]]}
        want = {p: s for p, s in want.items() if s >= 0.4}
        open_ = tiles.near_pairs(sk, words, 0.4, codes, exact)
        rows = open_.collect()
        assert len(rows) == len({(r.id1, r.id2) for r in rows}) and {(r.id1, r.id2) for r in rows} >= set(want)
        if exact:
            assert {(r.id1, r.id2): (r.n1, r.n2, r.shared) for r in rows} == {p: (len(sets[p[0]]), len(sets[p[1]]), len(sets[p[0]] & sets[p[1]])) for p in want}
        found = {(r.id1, r.id2): r.similarity for r in tiles.tile_jaccard(open_.drop("shared"), d, 100).collect()}
        assert {p: s for p, s in found.items() if s >= 0.4} == want and len(want) > 20


@pytest.mark.parametrize("universe", [90, 4000])
def test_similar_pairs_are_not_shuffled(spark, universe):
    """Before, pairs met in joins of bands and were told apart by a shuffle of all of them."""
    sets = _sets(random.Random(1), universe)
    if universe > 2048:  # more users than a bitmap has bits
        sets |= {200 + k: set(range(5000 + 40 * k, 5040 + 40 * k)) for k in range(60)}
    d = spark.createDataFrame([(u, i) for i, s in sets.items() for u in s], "user_id bigint, item_id bigint")
    found = similar_pairs(d, 0.4)
    above = set(_above(found, "MapInArrow" if universe == 90 else "FlatMapCoGroupsInArrow"))
    assert above <= {"Project", "Filter"}
    index, family = dense_index(d, "user_id"), hash_family()
    sig = {r.item_id: r for r in signatures(baskets(d, index), family, index.size).collect()}
    banded = lambda a, b: any(all(sig[a][f"h{h}"] == sig[b][f"h{h}"] for h in (k, k + 1, k + 2)) for k in range(0, 120, 3))
    want = {(a, b): _jaccard(sets[a], sets[b]) for a, b in itertools.combinations(sorted(sets), 2) if banded(a, b)}
    assert {(r.id1, r.id2): r.similarity for r in found.collect()} == {p: s for p, s in want.items() if s >= 0.4}


def test_texts_are_told_apart_in_their_row(spark, tmp_path):
    """No token of a text is shuffled where no id comes twice; ids that do, or are null, give each token once."""
    from corate.sources.fixtures import document_tokens

    def tokens(rows, name):
        spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        return document_tokens(spark, f"{tmp_path}/{name}")

    once = tokens([(1, "A b, a É1"), (2, None), (3, "")], "once")
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    assert sorted(once.collect()) == [("a", 1), ("b", 1), ("é1", 1)]
    twice = tokens([(1, "A b"), (1, "b c"), (None, "x"), (None, "x y")], "twice")
    assert sorted(map(str, twice.collect())) == sorted(f"Row(user_id='{t}', item_id={i})" for t, i in [("a", 1), ("b", 1), ("c", 1), ("x", None), ("y", None)])


@pytest.mark.parametrize("universe", [90, 5000])
@pytest.mark.parametrize("strings", [False, True])
def test_exact_pairs_are_not_shuffled(spark, universe, strings):
    """Before, pairs of rare users' lists were told apart by a shuffle and met their baskets, one copy a pair."""
    from corate.operators.exact import exact_similar_pairs

    sets = _sets(random.Random(2), universe)
    if universe > 2048:
        sets |= {200 + k: set(range(9000 + 40 * k, 9040 + 40 * k)) for k in range(60)}
    rows = [(f"u{u}" if strings else u, i) for i, s in sets.items() for u in s]
    d = spark.createDataFrame([*rows, (rows[0][0], None)], f"user_id {'string' if strings else 'bigint'}, item_id bigint")
    want = {(a, b): _jaccard(sets[a], sets[b]) for a, b in itertools.combinations(sorted(sets), 2)}
    for distinct in (False, True):
        found = exact_similar_pairs(d, 0.4, pairs_distinct=distinct)
        assert set(_above(found, "MapInArrow" if universe == 90 else "FlatMapCoGroupsInArrow")) <= {"Project", "Filter"}
        assert {(r.id1, r.id2): r.similarity for r in found.collect()} == {p: s for p, s in want.items() if s >= 0.4}


@pytest.mark.parametrize("bits", [1, 32])
def test_a_null_user_counts_for_the_size_only(spark, monkeypatch, bits):
    from corate.operators import exact

    monkeypatch.setattr(exact, "BITMAP_WORDS", bits)
    sets = _sets(random.Random(3), 300)
    none = {i for i in sets if i % 3 == 0}
    d = spark.createDataFrame([*((u, i) for i, s in sets.items() for u in s), *((None, i) for i in none), (None, 999)], "user_id bigint, item_id bigint")
    want = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        want[a, b] = shared / (len(sets[a]) + (a in none) + len(sets[b]) + (b in none) - shared)
    found = {(r.id1, r.id2): r.similarity for r in exact.exact_similar_pairs(d, 0.4).collect()}
    assert found == {p: s for p, s in want.items() if s >= 0.4} and found


def test_lists_are_used_where_they_make_fewer_pairs(spark, monkeypatch):
    from corate.operators import exact

    monkeypatch.setattr(exact, "ORDERED_PAIRS", 0)
    apart = spark.createDataFrame([(i, 10 * i + k) for i in range(40) for k in range(5)], "item bigint, user bigint")
    alike = spark.createDataFrame([(i, k) for i in range(40) for k in range(20)], "item bigint, user bigint")
    for d, in_order in ((apart, False), (alike, True)):
        sizes = d.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
        assert exact._all_in_order(d, sizes, 0.5) is in_order
