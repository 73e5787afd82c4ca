"""CSV sources and sinks."""

import os
import tempfile

from corate.sources.io import read_pairs, read_ratings, write_pairs, write_predictions


def _write(text):
    d = tempfile.mkdtemp(prefix="corate-io-", dir="/tmp")
    path = os.path.join(d, "in.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_quoted_comma_is_one_id(spark):
    path = _write('user_id,business_id,stars\n"a,b",x,3.0\nc,y,4\n')
    rows = sorted(tuple(r) for r in read_ratings(spark, path).collect())
    assert rows == [("a,b", "x", 3.0), ("c", "y", 4.0)]


def test_read_pairs_ignores_extra_columns(spark):
    path = _write("user_id,business_id,stars,extra\nu1,b1,5,z\nu2,b1,3,z\n")
    rows = sorted(tuple(r) for r in read_pairs(spark, path).collect())
    assert rows == [("u1", "b1"), ("u2", "b1")]


def test_sinks_write_reference_headers(spark):
    out = tempfile.mkdtemp(prefix="corate-out-", dir="/tmp")
    pairs = spark.createDataFrame([("b", "c", 0.5), ("a", "b", 1.0)], "id1 string, id2 string, similarity double")
    write_pairs(pairs, os.path.join(out, "pairs"))
    back = spark.read.option("header", True).csv(os.path.join(out, "pairs"))
    assert back.columns == ["business_id_1", "business_id_2", "similarity"]
    assert sorted(tuple(r) for r in back.collect()) == [("a", "b", "1.0"), ("b", "c", "0.5")]
    preds = spark.createDataFrame([("u", "i", 3.14159)], "user_id string, item_id string, prediction double")
    write_predictions(preds, os.path.join(out, "pred"))
    back = spark.read.option("header", True).csv(os.path.join(out, "pred"))
    assert back.columns == ["user_id", "business_id", "prediction"]
    assert [tuple(r) for r in back.collect()] == [("u", "i", "3.14")]


def test_repeated_header_lines_are_dropped(spark):
    path = _write("user_id,business_id,stars\nu1,b1,5\nuser_id,business_id,stars\nu2,b1,3.5\n")
    rows = sorted(tuple(r) for r in read_ratings(spark, path).collect())
    assert rows == [("u1", "b1", 5.0), ("u2", "b1", 3.5)]
    assert sorted(tuple(r) for r in read_pairs(spark, path).collect()) == [("u1", "b1"), ("u2", "b1")]


def test_malformed_rating_fails(spark):
    import pytest

    path = _write("user_id,business_id,stars\nu1,b1,five\n")
    with pytest.raises(Exception, match="malformed rating"):
        read_ratings(spark, path).collect()


def test_truth_file_feeds_precision_recall(spark):
    from corate.operators.evaluate import precision_recall
    from corate.sources.io import read_truth_pairs

    path = _write("business_id_1,business_id_2,similarity\nb1,b2,0.9\nb3,b4,0.7\n")
    found = spark.createDataFrame([("b2", "b1"), ("b5", "b6")], "id1 string, id2 string")
    r = precision_recall(found, read_truth_pairs(spark, path)).first()
    assert (r.n_found, r.n_truth, r.hits, r.precision, r.recall) == (2, 2, 1, 0.5, 0.5)


def test_bad_lines_are_set_aside_and_counted(spark):
    from corate.sources.io import Ingest, ingest_pairs, ingest_ratings

    text = (
        "user_id,business_id,stars\nu1,b1,5\nu2,b2\nu3,b3,4,more\nu4,b4,four\n,b5,3\nu6,,3\nu7,b7,\n"
        'user_id,business_id,stars\n"u,8",b8,2.5\nu9,b9,1e400\n'
    )
    aside = os.path.join(tempfile.mkdtemp(prefix="corate-aside-", dir="/tmp"), "bad")
    found = ingest_ratings(spark, _write(text), aside)
    assert isinstance(found, Ingest)
    assert sorted(tuple(r) for r in found.rows.collect()) == [("u,8", "b8", 2.5), ("u1", "b1", 5.0), ("u9", "b9", float("inf"))]
    assert (found.n_lines, found.n_bad) == (9, {"fields": 2, "id": 2, "rating": 2})
    bad = spark.read.schema("reason string, line string").json(aside)
    assert sorted(tuple(r) for r in bad.collect()) == [
        ("fields", "u2,b2"), ("fields", "u3,b3,4,more"), ("id", ",b5,3"), ("id", "u6,,3"), ("rating", "u4,b4,four"), ("rating", "u7,b7,"),
    ]
    pairs = ingest_pairs(spark, _write(text), aside + "-pairs")
    assert pairs.rows.columns == ["user_id", "item_id"] and pairs.rows.count() == 5
    assert pairs.n_bad == {"fields": 2, "id": 2}


def test_a_file_without_lines(spark):
    from corate.sources.io import ingest_ratings

    found = ingest_ratings(spark, _write("user_id,business_id,stars\n"), os.path.join(tempfile.mkdtemp(prefix="corate-aside-", dir="/tmp"), "bad"))
    assert found.rows.collect() == [] and found.n_lines == 0
