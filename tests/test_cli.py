"""Both command-line entry points, end to end on small CSV files."""

import os
import tempfile


def _csv(text):
    d = tempfile.mkdtemp(prefix="corate-cli-", dir="/tmp")
    path = os.path.join(d, "in.csv")
    with open(path, "w") as f:
        f.write(text)
    return d, path


def test_similar_pairs_cli(spark):
    from corate.plans.similar import main

    rows = "".join(f"u{u},{b},4.0\n" for u in range(12) for b in ("b1", "b2")) + "u99,b3,1.0\n"
    d, path = _csv("user_id,business_id,stars\n" + rows)
    out = os.path.join(d, "pairs")
    main([path, out, "--min-sim", "0.5"])
    back = spark.read.option("header", True).csv(out)
    assert [tuple(r) for r in back.collect()] == [("b1", "b2", "1.0")]


def test_recommend_cli(spark):
    from corate.plans.recommend import main

    train = "user_id,business_id,stars\nu1,b1,5\nu1,b2,3\nu2,b1,4\nu2,b2,2\nu3,b2,1\n"
    valid = "user_id,business_id,stars\nu3,b1,4\nu9,b2,2\n"
    d, train_path = _csv(train)
    _, valid_path = _csv(valid)
    out = os.path.join(d, "pred")
    main([train_path, valid_path, "mean", out])
    back = {(r.user_id, r.business_id): float(r.prediction) for r in spark.read.option("header", True).csv(out).collect()}
    assert back == {("u3", "b1"): 4.5, ("u9", "b2"): 2.0}


def test_recommend_cli_sets_bad_lines_aside(spark, capsys):
    from corate.plans.recommend import main

    d, train_path = _csv("user_id,business_id,stars\nu1,b1,5\nu1,b2,three\nu2,b1,4,x\nu2,b1,4\n")
    _, valid_path = _csv("user_id,business_id,stars\nu3,b1,4\nu9\n")
    out, aside = os.path.join(d, "pred"), os.path.join(d, "aside")
    main([train_path, valid_path, "mean", out, "--quarantine", aside])
    back = {(r.user_id, r.business_id): float(r.prediction) for r in spark.read.option("header", True).csv(out).collect()}
    assert back == {("u3", "b1"): 4.5}
    lines = {r.line for name in ("train", "validation") for r in spark.read.json(os.path.join(aside, name)).collect()}
    assert lines == {"u1,b2,three", "u2,b1,4,x", "u9"}
    assert "train: 4 lines, set aside: {'fields': 1, 'id': 0, 'rating': 1}" in capsys.readouterr().out
