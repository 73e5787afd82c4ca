"""Exact pairs through the core, heavy keys, both ways to moments, and LSH shapes."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from corate.functions.hashing import Shape, hash_family, lsh_shape
from corate.operators import exact
from corate.operators.minhash import all_band_keys, band_keys, signatures
from corate.operators.predict import predict_item_based
from corate.operators.similarity import _oriented, corating_moments, moments_by_pair, moments_by_user
from corate.operators.spread import dealt


def table(spark, sets):
    rows = [(u, i) for i, users in sets.items() for u in users]
    return spark.createDataFrame(rows, "user_id long, item_id long").repartition(4)


def brute(sets, t):
    found = {}
    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and shared / (len(sets[a]) + len(sets[b]) - shared) >= t:
            found[a, b] = round(shared / (len(sets[a]) + len(sets[b]) - shared), 9)
    return found


def found(df):
    return {(r.id1, r.id2): round(r.similarity, 9) for r in df.collect()}


def corpus(seed, n=160):
    """Items of core users only, of rare users only, mixed ones, copies and one user alone."""
    rng = random.Random(seed)
    sets = {}
    for i in range(n):
        often = {rng.randrange(30) for _ in range(rng.choice([0, 2, 8, 20]))}
        seldom = {100 + rng.randrange(400) for _ in range(rng.choice([0, 1, 5]))}
        sets[i] = often | seldom or {rng.randrange(30)}
    sets.update({n + k: set(sets[k]) for k in range(10)})
    sets.update({n + 20 + k: set(sets[k]) | {9000 + k} for k in range(10)})
    return sets


@pytest.mark.parametrize("min_sim", [0.15, 0.5, 1.0])
def test_core_and_prefix_give_all_pairs(spark, monkeypatch, min_sim):
    monkeypatch.setattr(exact.core_users, "__defaults__", (20, 12))  # core, frequent: part of the frequent users
    monkeypatch.setattr(exact.dense_pairs, "__defaults__", (16,))  # many chunks
    sets = corpus(1)
    assert found(exact.exact_similar_pairs(table(spark, sets), min_sim)) == brute(sets, min_sim)


def test_more_words_than_one_and_no_core(spark, monkeypatch):
    rng = random.Random(4)
    sets = {i: set(rng.sample(range(200), rng.randrange(40, 120))) for i in range(80)}
    want = brute(sets, 0.3)
    assert found(exact.exact_similar_pairs(table(spark, sets), 0.3)) == want  # no user is in 256 items
    monkeypatch.setattr(exact.core_users, "__defaults__", (exact.CORE, 1))
    assert found(exact.exact_similar_pairs(table(spark, sets), 0.3)) == want
    assert len(want) > 500


def test_dense_pairs_are_sparse_rows(spark, monkeypatch):
    """Of items around one core user most pairs are dropped inside the join."""
    sets = {i: {0, *range(10 * i + 1, 10 * i + 5)} for i in range(400)}
    pairs = table(spark, sets).select(F.col("item_id").alias("item"), F.col("user_id").alias("user"))
    core = exact.core_users(pairs)
    assert [r.user for r in core.collect()] == [0]
    assert exact.dense_items(pairs, core, 0.5).count() == 0  # four rare users fill the prefix
    assert exact.dense_items(pairs, core, 0.1).count() == 400
    assert exact.dense_pairs(exact.dense_items(pairs, core, 0.7), 0.7).count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], "user_id long, item_id long")
    assert exact.exact_similar_pairs(empty, 0.5).collect() == []


def test_partner_chunks_follow_the_sizes():
    assert exact._partner_chunks([(2, 0, 9), (4, 10, 19), (9, 20, 39)], 0.5, 10) == [(2, 0, 1), (4, 0, 1), (9, 2, 3)]


def ratings(spark, n_users=40, n_items=12, seed=2):
    rng = random.Random(seed)
    rows = [(f"u{u}", f"i{i}", float(rng.randint(1, 5))) for u in range(n_users) for i in range(n_items) if rng.random() < 0.5]
    return spark.createDataFrame(rows, "user_id string, item_id string, rating double")


def test_moments_by_user_equal_those_by_pair(spark):
    table = ratings(spark)
    r = table.select(F.col("item_id").alias("item"), F.col("user_id").alias("user"), F.col("rating").alias("r"))
    items = sorted(x.item for x in r.select("item").distinct().collect())
    asked = spark.createDataFrame([p for p in combinations(items, 2)][::2] + [("i0", "none")], "id1 string, id2 string")
    sizes = r.groupBy("item").agg(F.count("*").alias("n"))
    rows = lambda df: sorted(tuple(x) for x in df.select("id1", "id2", "n", "s1", "s2", "s12", "s11", "s22").collect())
    by_user, by_pair = rows(moments_by_user(r, asked)), rows(moments_by_pair(r, _oriented(asked, sizes)))
    assert by_user == by_pair == rows(corating_moments(table, asked, unique=True))
    assert 25 < len(by_user) <= 33


def test_only_heavy_keys_are_dealt(spark):
    rows = spark.createDataFrame([("hot", u) for u in range(1000)] + [("light", u) for u in range(40)], "item string, user long")
    lists = spark.createDataFrame([("hot", 1), ("hot", 2), ("light", 3), ("none", 4)], "item string, entry long")
    left, right = dealt(rows, lists, ["item"], "user", piece_rows=100)
    copies = {(r.item, r.entry): r["count"] for r in right.groupBy("item", "entry").count().collect()}
    assert copies == {("hot", 1): 10, ("hot", 2): 10, ("light", 3): 1, ("none", 4): 1}
    sizes = {(r.item, r._bucket): r["count"] for r in left.groupBy("item", "_bucket").count().collect()}
    assert sizes.pop(("light", 0)) == 40 and len(sizes) == 10 and max(sizes.values()) < 160
    joined = sorted((r.item, r.user, r.entry) for r in left.join(right, ["item", "_bucket"]).collect())
    assert joined == sorted((r.item, r.user, r.entry) for r in rows.join(lists, "item").collect())


def test_predictions_do_not_depend_on_dealing(spark, monkeypatch):
    from corate.operators import spread

    train = ratings(spark)
    test = ratings(spark, seed=3).select("user_id", "item_id")
    nb = spark.createDataFrame([(f"i{a}", f"i{b}", 0.1 * (a + b)) for a in range(12) for b in range(12) if a != b], "target_id string, neighbour_id string, weight double")
    rows = lambda: sorted((r.user_id, r.item_id, round(r.prediction, 9)) for r in predict_item_based(train, test, nb).collect())
    want = rows()
    monkeypatch.setattr(spread.dealt, "__defaults__", (5,))
    assert rows() == want


def test_shape_reaches_its_recall():
    for t in (0.05, 0.1, 0.2, 0.25, 0.5, 0.8):
        shape = lsh_shape(t, 0.98)
        assert shape.recall(t) >= 0.98 and shape.hashes <= 800
        finer = shape.rows + 1
        miss = (1 - t**finer) ** (800 // finer)
        assert 1 - miss < 0.98  # one row more does not fit
    assert lsh_shape(1.0).recall(1.0) == 1
    assert Shape(40, 3).recall(0.2) < 0.3
    with pytest.raises(ValueError):
        lsh_shape(0)


def test_chunked_signatures_give_the_same_bands(spark):
    rng = random.Random(6)
    baskets = spark.createDataFrame([(i, x) for i in range(30) for x in rng.sample(range(200), 20)], "item_id long, idx long")
    family = hash_family(24)
    whole = band_keys(signatures(baskets, family, 200), 24, 12, 2).select("item_id", F.xxhash64("band", "key").alias("key"))
    rows = lambda df: sorted((r.item_id, r.key) for r in df.collect())
    assert rows(all_band_keys(baskets, family, 200, 12, 2, chunk=5)) == rows(whole)
    assert rows(all_band_keys(baskets, family, 200, 12, 2)) == rows(whole)
    with pytest.raises(ValueError):
        all_band_keys(baskets, family, 200, 13, 2)


@pytest.mark.parametrize("name", ["lsh_quality_ratings", "lsh_quality_purchases", "lsh_quality_users"])
def test_measured_recall(spark, name):
    import __spark_entry__ as entry

    (row,) = entry.queries()[name](spark, "/root/testdata/sf0.01").collect()
    assert row.recall >= 0.95 and row.precision == 1 and row.n_truth > 50
