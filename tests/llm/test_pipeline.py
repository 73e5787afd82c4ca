"""The pipeline, each stage against brute force on its own input."""

import corpus_pipeline
from corate.llm.queries import op5_quality
from tests.llm.test_native import brute_exact, water_level
from tests.llm.test_near import brute
from tests.llm.test_text import plain

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns, name
        kept.append(docs.collect())
    ids = [sorted(r.doc_id for r in rows) for rows in kept]
    full = {r.doc_id: r for r in kept[0]}
    assert all(tuple(full[r.doc_id]) == tuple(r)[:5] for rows in kept for r in rows)

    accepted = {r.doc_id for r in op5_quality(spark, SF).where("predicted = 1").collect()}
    assert ids[1] == sorted(accepted)
    assert ids[2] == sorted(r[0] for r in brute_exact([(r.doc_id, r.text) for r in kept[1]]) if r[3])
    assert ids[3] == [r[0] for r in brute([(r.doc_id, r.text) for r in kept[2]]) if r[3]]
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids[4] == sorted(r.doc_id for r in kept[3] if not any(t in plain(r.text or "") for t in items))
    assert len(ids[4]) < len(ids[2]) < len(ids[1]) < len(ids[0])

    sizes, taken = {}, {}
    for r in kept[4]:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in kept[5]:
        assert 0 < r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    target = water_level(sizes)
    assert all(abs(taken.get(s, 0) - target[s]) <= 16 * 3 for s in sizes)
    assert sorted(tuple(map(str, r)) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(tuple(map(str, r)) for r in kept[5])


def test_stages_take_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, None, 0), (3, "a b c", "en", "s", 5), (3, "a b c", "en", "s", 5)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).columns[:5] == docs.columns
        stage(spark, docs, SF).collect()
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_dedup_stages_drop_rows_not_ids(spark):
    """Repeated rows, null ids, and ids with one text that stays and one that goes."""
    near = [f"n{k}" for k in range(100)]
    texts = {
        "a": "one text of a few words",
        "b": "another text of a few other words",
        "c": "a  text\nwithout any id",
        "n": " ".join(near),
        "m": " ".join([*near[:-1], "edited"]),
    }
    ids = [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (2, "b"), (3, "b"), (None, "c"), (None, "c"), (None, "c"), (None, "a"),
           (5, "n"), (5, "n"), (None, "n"), (None, "m"), (5, "m"), (6, "m")]
    rows = [(i, texts[t], None, None, k) for k, (i, t) in enumerate(ids)]
    rows += [(7, "a text without any  id\n", None, None, 100)]  # longer, so it stays instead of the null ids
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    exact = corpus_pipeline.exact(spark, docs, SF)
    assert exact.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in exact.collect())
    assert got == sorted([(1, texts["a"]), (2, texts["b"]), (7, rows[-1][1]), (5, texts["n"]), (5, texts["m"])])
    one = corpus_pipeline.near(spark, docs.where("n_chars >= 10 AND n_chars < 100"), SF)
    assert one.columns == docs.columns and [r.doc_id for r in one.collect()] == [5]
    same = sorted((str(r.doc_id), r.text) for r in corpus_pipeline.near(spark, exact, SF).collect())
    assert [i for i, _ in same] == ["1", "2", "5", "7"]
    nameless = spark.createDataFrame([(None, texts["n"], k) for k in range(50)], "doc_id long, text string, n_chars long")
    assert corpus_pipeline.exact(spark, nameless, SF).count() == 1
