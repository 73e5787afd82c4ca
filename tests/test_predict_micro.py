"""Fallback ladder of the predictors, one case per rung."""

import pytest

from corate.operators.basic import exclude_pairs, swap_roles
from corate.operators.neighbours import neighbour_table
from corate.operators.predict import predict_item_based, predict_mean, predict_user_based


def _nb(spark, rows):
    return spark.createDataFrame(rows, "target_id string, neighbour_id string, weight double")


def _test(spark, rows):
    return spark.createDataFrame(rows, "user_id string, item_id string")


def _pred(df):
    return {(r.user_id, r.item_id): r.prediction for r in df.collect()}


def test_negative_weight_gives_absolute_value(spark, ratings_df):
    train = ratings_df([("u", "j", 4.0), ("u", "x", 2.0)])
    out = _pred(predict_item_based(train, _test(spark, [("u", "t")]), _nb(spark, [("t", "j", -1.0)])))
    assert out[("u", "t")] == pytest.approx(4.0)


def test_repeated_ratings_count_once(spark, ratings_df):
    """Of several ratings of one user and item the highest counts, in predictions and similarities."""
    from corate.operators.knn import knn_items
    from corate.operators.similarity import pair_similarity

    rows = [("u", "j", 5.0), ("u", "j", 5.0), ("u", "j", 2.0), ("u", "k", 1.0)]
    nb = _nb(spark, [("t", "j", 1.0), ("t", "k", 1.0)])
    out = _pred(predict_item_based(ratings_df(rows), _test(spark, [("u", "t")]), nb))
    assert out[("u", "t")] == pytest.approx(3.0)
    users = _nb(spark, [("a", "u", 1.0)])
    out = _pred(predict_user_based(ratings_df([*rows, ("a", "x", 3.0)]), _test(spark, [("a", "j")]), users))
    assert out[("a", "j")] == pytest.approx(3.0 + (5.0 - 1.0))
    out = _pred(predict_mean(ratings_df(rows), _test(spark, [("u", "zz"), ("q", "j")])))
    assert out == {("u", "zz"): pytest.approx(3.0), ("q", "j"): pytest.approx(5.0)}

    plain = [("u", "a", 1.0), ("v", "a", 4.0), ("w", "a", 2.0), ("u", "b", 2.0), ("v", "b", 5.0), ("w", "b", 1.0)]
    pairs = spark.createDataFrame([("a", "b")], "id1 string, id2 string")
    want = sorted(map(tuple, pair_similarity(ratings_df(plain), pairs).collect()))
    again = sorted(map(tuple, pair_similarity(ratings_df([*plain, ("v", "a", 4.0), ("v", "a", 3.0)]), pairs).collect()))
    assert again == want
    keys = _test(spark, [("u", "b")])
    assert knn_items(ratings_df([*plain, plain[0]]), keys).collect() == knn_items(ratings_df(plain), keys).collect()


def test_user_neighbourhoods_need_a_threshold(spark, ratings_df):
    from corate.plans.recommend import user_based

    train = ratings_df([("u", "j", 5.0)])
    with pytest.raises(ValueError, match="min_sim"):
        user_based(train, _test(spark, [("u", "t")]), min_sim=0.0)


def test_placeholder_only_gives_user_mean(spark, ratings_df):
    train = ratings_df([("u", "t", 5.0), ("u", "x", 1.0)])
    out = _pred(predict_item_based(train, _test(spark, [("u", "t")]), _nb(spark, [("t", "t", 1.0)])))
    assert out[("u", "t")] == pytest.approx(3.0)  # not the target's own rating 5


def test_placeholder_counts_with_weight_one(spark, ratings_df):
    train = ratings_df([("u", "t", 5.0), ("u", "j", 2.0)])
    nb = _nb(spark, [("t", "t", 1.0), ("t", "j", 0.5)])
    out = _pred(predict_item_based(train, _test(spark, [("u", "t")]), nb))
    assert out[("u", "t")] == pytest.approx((1 * 5 + 0.5 * 2) / 1.5)


def test_neighbour_not_rated_by_user_gives_user_mean(spark, ratings_df):
    train = ratings_df([("u", "x", 2.0), ("u", "y", 4.0), ("v", "j", 5.0)])
    out = _pred(predict_item_based(train, _test(spark, [("u", "t")]), _nb(spark, [("t", "j", 0.7)])))
    assert out[("u", "t")] == pytest.approx(3.0)


def test_cold_start_rungs(spark, ratings_df):
    train = ratings_df([("u", "i", 4.0), ("u", "k", 2.0), ("v", "i", 2.0)])
    test = _test(spark, [("new", "i"), ("u", "newitem"), ("new", "newitem")])
    nb = _nb(spark, [("i", "i", 1.0), ("newitem", "newitem", 1.0)])
    out = _pred(predict_item_based(train, test, nb))
    assert out[("new", "i")] == pytest.approx(3.0)  # item mean
    assert out[("u", "newitem")] == pytest.approx(3.0)  # user mean
    assert out[("new", "newitem")] == pytest.approx(8.0 / 3)  # global mean


def test_mean_baseline(spark, ratings_df):
    train = ratings_df([("u", "i", 4.0), ("u", "k", 2.0), ("v", "i", 2.0)])
    test = _test(spark, [("u", "i"), ("u", "zz"), ("zz", "zz")])
    out = _pred(predict_mean(train, test))
    assert out[("u", "i")] == pytest.approx(3.0)
    assert out[("u", "zz")] == pytest.approx(3.0)
    assert out[("zz", "zz")] == pytest.approx(8.0 / 3)


def test_user_based_formula(spark, ratings_df):
    # v rated i with 5; v's other ratings average 3; u's mean is 2; weight 0.5
    train = ratings_df([("u", "a", 1.0), ("u", "b", 3.0), ("v", "i", 5.0), ("v", "a", 2.0), ("v", "b", 4.0)])
    nb = _nb(spark, [("u", "v", 0.5)])
    out = _pred(predict_user_based(train, _test(spark, [("u", "i")]), nb))
    assert out[("u", "i")] == pytest.approx(2.0 + 0.5 * (5 - 3) / 0.5)
    out = _pred(predict_user_based(train, _test(spark, [("u", "i")]), nb, include_active=True))
    assert out[("u", "i")] == pytest.approx(2.0 + (5 - 11 / 3))


def test_neighbour_table_placeholders(spark, ratings_df):
    # A and B have two common raters with identical ratings -> defined; C has one common rater -> placeholder
    train = ratings_df(
        [("u1", "A", 1.0), ("u2", "A", 5.0), ("u1", "B", 2.0), ("u2", "B", 4.0), ("u1", "C", 3.0), ("u9", "D", 1.0)]
    )
    pairs = spark.createDataFrame([("A", "B"), ("A", "C")], "id1 string, id2 string")
    targets = spark.createDataFrame([("A",), ("D",), ("Z",)], "item_id string")
    rows = {(r.target_id, r.neighbour_id): r.weight for r in neighbour_table(pairs, train, targets).collect()}
    assert rows == {("A", "B"): pytest.approx(1.0), ("A", "A"): 1.0, ("D", "D"): 1.0, ("Z", "Z"): 1.0}


def test_exclude_pairs_and_swap(spark, ratings_df):
    train = ratings_df([("u", "i", 4.0), ("u", "k", 2.0)])
    valid = ratings_df([("u", "i", 5.0)])
    assert [tuple(r) for r in exclude_pairs(train, valid).collect()] == [("u", "k", 2.0)]
    assert sorted(tuple(r) for r in swap_roles(swap_roles(train)).collect()) == sorted(
        tuple(r) for r in train.collect()
    )


def test_recommend_exclusion_switch(spark, ratings_df):
    from corate.plans.recommend import recommend

    train = ratings_df([("u", "i", 5.0), ("u", "k", 1.0), ("v", "i", 3.0)])
    valid = ratings_df([("u", "i", 5.0)])
    excluded = _pred(recommend(train, valid, "mean").predictions)
    kept = _pred(recommend(train, valid, "mean", exclude_validation=False).predictions)
    assert excluded[("u", "i")] == pytest.approx(3.0)
    assert kept[("u", "i")] == pytest.approx(4.0)
    with pytest.raises(ValueError):
        recommend(train, valid, "nope")
