"""Dense index, MinHash signatures and LSH candidates: properties and edge cases."""

import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corate.functions.hashing import hash_family
from corate.operators.index import dense_index, rank_within, union_index
from corate.operators.minhash import band_keys, baskets, lsh_candidates, signatures
from corate.plans.similar import similar_pairs

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.text(alphabet="abcdefgh", min_size=1, max_size=4), min_size=1, max_size=40))
def test_dense_index_is_sorted_and_gap_free(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "user_id string")
    index = dense_index(df, "user_id")
    got = sorted((r.idx, r.id) for r in index.frame.collect())
    want = list(enumerate(sorted(set(ids), key=lambda s: s.encode())))
    assert got == want and index.size == len(want)


def test_dense_index_independent_of_partitions(spark):
    ids = [(f"id{random.Random(1).randrange(10**6) + k}",) for k in range(500)]
    a = dense_index(spark.createDataFrame(ids, "user_id string").repartition(7), "user_id")
    b = dense_index(spark.createDataFrame(ids, "user_id string").coalesce(1), "user_id")
    assert sorted(a.frame.collect()) == sorted(b.frame.collect())


def test_union_index_train_first(spark):
    train = spark.createDataFrame([("b",), ("d",)], "user_id string")
    other = spark.createDataFrame([("a",), ("d",), ("c",)], "user_id string")
    got = {r.id: r.idx for r in union_index(train, other, "user_id").frame.collect()}
    assert got == {"b": 0, "d": 1, "a": 2, "c": 3}


def test_empty_index(spark):
    index = dense_index(spark.createDataFrame([], "user_id string"), "user_id")
    assert index.size == 0 and index.frame.count() == 0


def _brute_signature(rows, family):
    users = sorted({u for u, _ in rows})
    idx = {u: k for k, u in enumerate(users)}
    m = len(users)
    items = {}
    for u, i in rows:
        items.setdefault(i, set()).add(idx[u])
    return {i: [min(((a * x + b) % p) % m for x in xs) for a, b, p in family] for i, xs in items.items()}


def test_signature_matches_brute_force_and_ignores_duplicates(spark):
    family = hash_family(12, seed=7)
    rows = [(f"u{u}", f"i{u % 5}") for u in range(40)] + [("u3", "i1"), ("u3", "i1")]
    df = spark.createDataFrame(rows, "user_id string, item_id string")
    index = dense_index(df, "user_id")
    sig = signatures(baskets(df, index), family, index.size)
    got = {r.item_id: [r[f"h{k}"] for k in range(12)] for r in sig.collect()}
    assert got == _brute_signature(rows, family)


def _brute_pairs(rows, min_sim):
    items = {}
    for u, i in rows:
        items.setdefault(i, set()).add(u)
    out = {}
    for a, b in itertools.combinations(sorted(items), 2):
        j = len(items[a] & items[b]) / len(items[a] | items[b])
        if j >= min_sim:
            out[(a, b)] = j
    return out


@SETTINGS
@given(st.integers(min_value=0, max_value=10**6))
def test_lsh_pairs_are_exact_pairs(spark, seed):
    rng = random.Random(seed)
    rows = [(f"u{rng.randrange(30)}", f"i{rng.randrange(12)}") for _ in range(120)]
    df = spark.createDataFrame(rows, "user_id string, item_id string")
    got = {(r.id1, r.id2): r.similarity for r in similar_pairs(df, min_sim=0.3).collect()}
    exact = _brute_pairs(rows, 0.3)
    assert set(got) <= set(exact)
    for key, value in got.items():
        assert value == pytest.approx(exact[key])
        assert 0.0 <= value <= 1.0


def test_identical_baskets_are_always_candidates(spark):
    rows = [(f"u{u}", item) for u in range(20) for item in ("x", "y")] + [("u99", "z")]
    df = spark.createDataFrame(rows, "user_id string, item_id string")
    got = [(r.id1, r.id2, r.similarity) for r in similar_pairs(df, min_sim=0.5).collect()]
    assert got == [("x", "y", 1.0)]


def test_empty_and_single_item(spark):
    empty = spark.createDataFrame([], "user_id string, item_id string")
    assert similar_pairs(empty, min_sim=0.5).count() == 0
    single = spark.createDataFrame([("u1", "a"), ("u2", "a")], "user_id string, item_id string")
    assert similar_pairs(single, min_sim=0.5).count() == 0


def test_bigint_ids(spark):
    rows = [(u, 100 + (u % 3)) for u in range(30)] + [(u, 200) for u in range(0, 30, 3)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint")
    got = {(r.id1, r.id2) for r in similar_pairs(df, min_sim=0.9).collect()}
    assert got == {(100, 200)}


def test_rank_within_matches_python(spark):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    rows = [(f"g{rng.randrange(4)}", k, rng.random()) for k in range(200)]
    df = spark.createDataFrame(rows, "g string, k int, v double")
    ranked = rank_within(df, ["g"], [F.col("v").desc(), F.col("k").desc()])
    got = {(r.g, r.k): r["rank"] for r in ranked.collect()}
    want = {}
    for g in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], -r[1]))
        want.update({(g, r[1]): n + 1 for n, r in enumerate(members)})
    assert got == want


@SETTINGS
@given(st.integers(min_value=0, max_value=10**6), st.sampled_from([0.2, 0.34, 0.5, 0.8, 1.0]))
def test_prefix_filter_finds_every_exact_pair(spark, seed, min_sim):
    from corate.operators.exact import exact_similar_pairs

    rng = random.Random(seed)
    rows = [(f"u{rng.randrange(25)}", f"i{rng.randrange(10)}") for _ in range(90)]
    rows += [(u, "copy") for u, i in rows if i == "i0"]  # an exact duplicate basket
    df = spark.createDataFrame(rows, "user_id string, item_id string")
    got = {(r.id1, r.id2): r.similarity for r in exact_similar_pairs(df, min_sim).collect()}
    exact = _brute_pairs(rows, min_sim)
    assert set(got) == set(exact)
    for key, value in got.items():
        assert value == pytest.approx(exact[key])


@pytest.mark.parametrize("tile", [1, 3, 1024])
def test_buckets_of_any_size_give_all_their_pairs(spark, tile):
    # a small user universe makes buckets large
    rng = random.Random(11)
    rows = [(f"u{rng.randrange(8)}", f"i{rng.randrange(60)}") for _ in range(400)]
    rows += [(f"v{u}", f"same{k}") for u in range(3) for k in range(30)]
    df = spark.createDataFrame(rows, "user_id string, item_id string")
    index, family = dense_index(df, "user_id"), hash_family()
    keys = band_keys(signatures(baskets(df, index), family, index.size), len(family))
    members = {}
    for r in keys.collect():
        members.setdefault((r.band, r.key), []).append(r.item_id)
    want = {p for m in members.values() for p in itertools.combinations(sorted(m), 2)}
    got = [(r.id1, r.id2) for r in lsh_candidates(keys, tile).collect()]
    assert len(got) == len(set(got)) and set(got) == want
