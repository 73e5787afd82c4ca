"""Parity bitmaps, pairs that bounds drop inside the joins, and moments of pairs as rows."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from corate.operators import evaluate, similarity
from corate.operators.exact import prefix_candidates
from corate.operators.index import dense_index
from corate.operators.minhash import baskets, encode_pairs
from corate.operators.sketch import shared_bound, sketch_words, sketches
from corate.operators.spread import pairs_within
from corate.plans.similar import similar_pairs


def _sets(spark, sets):
    return spark.createDataFrame([(i, u) for i, s in sets.items() for u in sorted(s)], "item bigint, user bigint")


@pytest.mark.parametrize("universe", [60, 3000])
def test_the_bound_is_never_below_the_intersection(spark, universe):
    rng = random.Random(universe)
    sets = {i: set(rng.sample(range(universe), rng.randint(1, 50))) for i in range(30)}
    words = sketch_words(universe)
    sk = sketches(_sets(spark, sets), words, F.col("user"))
    x, y = (sk.select([F.col(c).alias(p + c) for c in sk.columns]) for p in ("x_", "y_"))
    found = x.join(y, F.col("x_item") < F.col("y_item")).select("x_item", "y_item", shared_bound("x_", "y_", words).alias("most")).collect()
    assert len(found) == 30 * 29 // 2
    exact = universe <= 64 * words
    for r in found:
        shared = len(sets[r.x_item] & sets[r.y_item])
        assert r.most == shared if exact else r.most >= shared


@pytest.mark.parametrize("universe", [90, 2000])
def test_similar_pairs_with_bitmaps_equal_brute_force(spark, universe):
    rng = random.Random(7)
    base = [set(rng.sample(range(universe), 30)) for _ in range(8)]
    sets = {i: set(base[i % 8]) - set(rng.sample(sorted(base[i % 8]), 4)) for i in range(40)}
    truth = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in combinations(sets, 2)}
    truth = {p: s for p, s in truth.items() if s >= 0.5}
    d = _sets(spark, sets).withColumnsRenamed({"item": "item_id", "user": "user_id"})
    d = d.unionByName(spark.createDataFrame([(None, 1), (99, None)], d.schema))
    got = {(r.id1, r.id2): r.similarity for r in similar_pairs(d, 0.5, recall=0.999).collect()}
    assert got == pytest.approx(truth)


def test_items_that_share_little_leave_no_join(spark):
    sets = {i: {0, 1, *range(100 * i + 10, 100 * i + 40)} for i in range(50)}
    assert prefix_candidates(_sets(spark, sets), 0.5).count() == 0


def test_pairs_carry_what_the_join_knows(spark):
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (2, "a", 5), (2, "b", 7)], "g int, id string, n int")
    got = pairs_within(rows, ["g"], "id", carry=("n",), emit={"sum": lambda a, b: F.col(f"{a}n") + F.col(f"{b}n")}).collect()
    assert [tuple(r) for r in got] == [("a", "b", 12)]


def test_the_rows_of_an_item_are_together(spark):
    pairs = spark.createDataFrame([(u, i) for u in range(40) for i in range(20)], "user_id bigint, item_id bigint").repartition(8)
    index = dense_index(pairs, "user_id")
    got = baskets(pairs, index)
    coded = encode_pairs(pairs, index, None)
    for table, place in ((got, F.spark_partition_id()), (coded, F.input_file_name())):
        assert table.count() == 800
        assert table.withColumn("_p", place).select("item_id", "_p").distinct().count() == 20


@pytest.mark.parametrize("limit", [0, 4, 1000])
def test_moments_as_arrays_equal_those_of_rows(spark, monkeypatch, limit):
    rng = random.Random(3)
    ratings = [(u, i, float(rng.randint(1, 5))) for i in range(12) for u in rng.sample(["u%d" % k for k in range(30)], 2 + i)]
    r = spark.createDataFrame(ratings, "user_id string, item_id bigint, rating double")
    pairs = spark.createDataFrame([(0, 1), (9, 5), (5, 9), (3, 7), (10, 11), (11, 2), (11, 77)], "id1 bigint, id2 bigint")
    monkeypatch.setattr(similarity, "VECTOR_USERS", limit)
    made = []
    vector = similarity.moments_by_vector
    monkeypatch.setattr(similarity, "moments_by_vector", lambda *a: made.append(1) or vector(*a))
    got = {(x.id1, x.id2): tuple(x)[2:] for x in similarity.corating_moments(r, pairs, unique=True).collect()}
    by = {}
    for u, i, v in ratings:
        by.setdefault(i, {})[u] = v
    want = {}
    for a, b in {(0, 1), (5, 9), (3, 7), (10, 11), (2, 11)}:
        c = [(by[a][u], by[b][u]) for u in by[a].keys() & by[b].keys()]
        if c:
            want[a, b] = (len(c), sum(x for x, _ in c), sum(y for _, y in c), sum(x * y for x, y in c), sum(x * x for x, _ in c), sum(y * y for _, y in c))
    assert got == want and bool(made) == (limit > 0)


def test_recall_is_estimated_through_rare_users_only(spark, monkeypatch):
    # All share five users; items 2k and 2k + 1 share twenty more.
    sets = {i: {0, 1, 2, 3, 4, *range(100 * (i // 2) + 10, 100 * (i // 2) + 30), 10_000 + i} for i in range(40)}
    d = _sets(spark, sets).withColumnsRenamed({"item": "item_id", "user": "user_id"})
    d = d.unionByName(spark.createDataFrame([(i, None) for i in range(40)], d.schema))
    found = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(15)], "id1 bigint, id2 bigint")
    met = []
    kept = evaluate.sketched_candidates
    monkeypatch.setattr(evaluate, "sketched_candidates", lambda c, *a: met.append(c.count()) or kept(c, *a))
    row = evaluate.estimate_recall(found, d, 0.5).first()
    assert (row.n_items, row.n_truth, row.hits) == (40, 20, 15)
    assert met == [20]


def test_items_of_equal_baskets_are_paired_once(spark):
    """Of a class of copies its smallest member is paired, the others are rows of their own: not copies squared."""
    from corate.plans.similar import similar_pairs

    sets = {"a": set(range(20)), "b": set(range(4, 22)), "c": set(range(50, 70))}
    rows = [(u, f"{name}{k:02d}") for name, users in sets.items() for k in range(12) for u in users]
    pairs = spark.createDataFrame(rows, "user_id bigint, item_id string")
    every = {(r.id1, r.id2): r.similarity for r in similar_pairs(pairs, min_sim=0.5).collect()}
    found = {(r.id1, r.id2): r.similarity for r in similar_pairs(pairs, min_sim=0.5, by_class=True).collect()}
    members = {(f"{name}00", f"{name}{k:02d}"): 1.0 for name in sets for k in range(1, 12)}
    assert found == {("a00", "b00"): every["a00", "b00"]} | members
    # All pairs follow from them.
    of = {m: m for m in (f"{name}00" for name in sets)} | {m: s for s, m in members}
    spread = {(x, y): 1.0 if of[x] == of[y] else found.get((of[x], of[y])) for x in of for y in of if x < y}
    assert {k: v for k, v in spread.items() if v is not None} == every


def test_many_band_keys_are_shuffled_once(spark):
    """Sizes of the groups and the join with them read one exchange, and no signature is shuffled."""
    from corate.functions.hashing import hash_family
    from corate.operators.minhash import all_band_keys

    rows = [(i, (i * 7 + k * k) % 50) for i in range(60) for k in range(6)]
    baskets = spark.createDataFrame(rows, "item_id bigint, idx bigint").distinct()
    family = hash_family(300)
    keys = all_band_keys(baskets, family, 50, 150, 2, write=False)
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "Repartition 8, true" not in plan
    written = all_band_keys(baskets, family, 50, 150, 2)
    assert sorted(keys.collect()) == sorted(written.collect())


def test_notes_meet_members_of_groups_only(spark):
    """Bitmaps are joined with the members of groups of more than one, after the groups are counted; pairs stay the same."""
    rows = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (2, "z"), (3, "z")], "item bigint, key string")
    notes = spark.createDataFrame([(k, k % 2) for k in range(1, 4)], "item bigint, odd int")
    keep = lambda a, b: F.col(f"{a}odd") != F.col(f"{b}odd")
    found = pairs_within(rows, ["key"], "item", keep=keep, notes=notes, emit={"odds": lambda a, b: F.col(f"{a}odd") + F.col(f"{b}odd")})
    assert sorted(map(tuple, found.collect())) == [(1, 2, 1), (2, 3, 1)]
