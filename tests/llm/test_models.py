"""The learned operators: gradients, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corate.llm import langid, quality, queries, toxicity
from corate.llm.common import Words, bounded_sample, text_slices

SF = "/root/testdata/sf0.01"
EDGE = [(1, None), (2, ""), (3, " \n"), (4, "word"), (5, "x " * 60000), (5, "x " * 60000), (None, "é!"), (6, "123 %%")]


def edge_table(spark):
    return spark.createDataFrame(EDGE, "doc_id long, text string").withColumn("score", F.lit("old"))


def flat(texts):
    return list(text_slices(pa.array(texts)))


def test_words_and_hashes_equal_python():
    rng = random.Random(1)
    texts = ["".join(rng.choice(" \tabAé\n") for _ in range(rng.randint(0, 12))) for _ in range(300)] + [None]
    seen = {}
    for at, data, offsets in text_slices(pa.array(texts), limit=40):
        words = Words(data, offsets)
        keys = words.hashes()
        for d in range(len(offsets) - 1):
            want = (texts[at + d] or "").encode().split()
            a, b = words.first[d], words.first[d + 1]
            assert [bytes(data[s : s + n]) for s, n in zip(words.start[a:b], words.length[a:b], strict=True)] == want
            for w, k in zip(want, keys[a:b].tolist(), strict=True):
                assert seen.setdefault(w.lower(), k) == k
    assert len(set(seen.values())) == len(seen)


def test_slices_of_offset_and_empty_columns():
    column = pa.array(["aa", None, "", "bcd", "e"]).slice(1)
    got = [(at, bytes(data), offsets.tolist()) for at, data, offsets in text_slices(column, limit=2)]
    assert b"".join(g[1] for g in got) == b"bcde" and sum(len(g[2]) - 1 for g in got) == 4
    assert list(text_slices(pa.array([], pa.string()))) == []
    assert [len(o) for _, _, o in text_slices(pa.array([None, None], pa.string()))] == [3]


def test_bounded_sample(spark):
    rows = spark.range(20000).select(F.col("id"), (F.col("id") % 100 == 0).cast("int").alias("label"))
    got = bounded_sample(rows, "label", 150, "id", 1)
    assert {r[0]: r[1] for r in got.groupBy("label").count().collect()} == {0: 150, 1: 150}
    assert sorted(got.collect()) == sorted(bounded_sample(rows.repartition(5), "label", 150, "id", 1).collect())
    assert bounded_sample(rows.limit(0), "label", 5, "id", 1).count() == 0


# --- quality ---------------------------------------------------------------


def test_attention_gradients():
    rng = np.random.default_rng(0)
    first = np.array([0, 2, 3, 7])
    x, label, weight = rng.normal(size=(7, 4)), np.array([1.0, 0, 1]), np.array([0.2, 0.5, 0.3])
    model = quality.train_attention(x, first, label, weight, hidden=3, gates=2, steps=3)

    def loss():
        y = model.forward(x, first)["y"]
        return -(weight * (label * np.log(y) + (1 - label) * np.log(1 - y))).sum()

    grads = model.gradients(model.forward(x, first), label, weight)
    for name, w in model.weights.items():
        for at in np.ndindex(w.shape):
            keep, step = w[at], 1e-5
            w[at] = keep + step
            up = loss()
            w[at] = keep - step
            down = loss()
            w[at] = keep
            assert grads[name][at] == pytest.approx((up - down) / (2 * step), abs=1e-7)


def test_passages_cover_the_whole_text():
    (at, data, offsets), = flat(["a b c d e f g", None, "x", "A| A| !! 9"])
    first, x = quality.encode_passages(data, offsets, 3)
    assert np.diff(first).tolist() == [3, 1, 1, 2] and x.shape == (7, quality.N_FEATURES) and np.isfinite(x).all()
    alone = quality.encode_passages(*flat(["A| A| !! 9"])[0][1:], 3)[1]
    assert np.array_equal(x[5:], alone)


def test_quality_held_out_accuracy(spark):
    from corate.llm.queries import op5_quality

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = op5_quality(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == r.quality for r in got]) >= 0.95


def test_quality_edge_cases(spark):
    table = edge_table(spark)
    assert {r.score for r in quality.score_quality(table, None).collect()} == {0.5}
    labels = spark.createDataFrame([(4, 1), (2, 0), (2, None), (None, 1), (3, 0), (3, 1)], "doc_id long, quality int")
    model = quality.fit_quality(table, labels)
    got = quality.score_quality(table, model)
    assert got.columns == ["doc_id", "text", "score"] and got.count() == len(EDGE)
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert quality.fit_quality(table, labels.limit(0)) is None
    assert quality.score_quality(table.limit(0), model).count() == 0


def test_quality_learns_only_labels_of_its_documents(spark):
    """Labels of other rows change neither the sample nor the weights of the loss."""
    table = spark.createDataFrame([(k, f"word{k} " * (5 + k)) for k in range(40)], "doc_id long, text string")
    own = [(k, k % 2) for k in range(40)]
    others = [(k, 1) for k in range(1000, 1400)]
    model, same = (
        quality.fit_quality(table, spark.createDataFrame(rows, "doc_id long, quality int"), per_label=15)
        for rows in (own, own + others)
    )
    assert all(np.array_equal(model.weights[k], same.weights[k]) for k in model.weights)


# --- language --------------------------------------------------------------


def test_recurrent_gradients():
    model = langid.ByteGru.start(["a", "b"], 3, 1)
    model.weights = {k: w.astype(np.float64) for k, w in model.weights.items()}
    rng = np.random.default_rng(2)
    symbols, valid, label = rng.integers(0, 5, (6, 4)), np.array([6, 3, 1, 5]), np.array([0, 1, 1, 0])
    _, grads = model.gradients(symbols, valid, label)
    for name in ("Xf", "Uf", "Xg", "Ug", "O", "o"):
        w = model.weights[name]
        for at in list(np.ndindex(w.shape))[:20]:
            keep, step = w[at], 1e-2
            w[at] = keep + step
            up = model.gradients(symbols, valid, label)[0]
            w[at] = keep - step
            down = model.gradients(symbols, valid, label)[0]
            w[at] = keep
            assert grads[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_pieces_hold_every_byte():
    for _, data, offsets in text_slices(pa.array(["abcdefg", None, "", "xy" * 50]), limit=20):
        symbols, valid, doc = langid.pieces(data, offsets, 4)
        for d in range(len(offsets) - 1):
            own = np.flatnonzero(doc == d)
            joined = np.concatenate([symbols[: valid[k], k] for k in own]) if len(own) else np.empty(0)
            assert joined.tolist() == data[offsets[d] : offsets[d + 1]].tolist()


def test_language_held_out_accuracy(spark):
    from corate.llm.queries import op6_language

    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = op6_language(spark, SF).join(lang, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == r.lang for r in got]) >= 0.95


def test_language_edge_cases(spark):
    table = edge_table(spark)
    assert {(r.lang_pred, r.score) for r in langid.predict_language(table, None).collect()} == {("und", 0.0), ("und", 0.0)}
    known = spark.createDataFrame([(1, "hello the word", "en"), (2, "été où é", "fr"), (3, None, "fr"), (4, "x", None)], "doc_id long, text string, lang string")
    model = langid.fit_language(known)
    assert model.languages == ["en", "fr"]
    got = {(r.doc_id, r.text): r for r in langid.predict_language(table, model).collect()}
    for (i, text), r in got.items():
        letters = any(c.isalpha() for c in text or "")
        assert (r.lang_pred in ("en", "fr")) if letters else (r.lang_pred, r.score) == ("und", 0.0), i
    assert langid.fit_language(known.limit(0)) is None
    assert langid.predict_language(table.limit(0), model).count() == 0


# --- toxicity --------------------------------------------------------------

SEEDS = {"insult": ("idiot", "moron"), "threat": ("nothing",)}


def toxic_corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(5, 200))]
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * rng.randint(1, 3)):
            words[rng.randrange(len(words))] = rng.choice(["Idiot!", "moron", "1diot", "scumbag", "scumball,"])
        rows.append((i, " ".join(words), toxic))
    return rows


def test_chain_finds_toxic_texts(spark):
    rows = toxic_corpus(1500)
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    chain = toxicity.fit_toxicity(table, table.where("doc_id % 3 != 0"), SEEDS)
    assert list(chain.links) == ["insult", "threat", "toxic"]
    # Each later link has a weight for every earlier category beside its words and constant.
    assert [len(w) - len(chain.keys) for w in chain.links.values()] == [1, 2, 3]
    got = {r.doc_id: r for r in toxicity.score_toxicity(table, chain).collect()}
    held = [r for r in rows if r[0] % 3 == 0]
    assert np.mean([(got[i].p_toxic >= 0.3) == bool(t) for i, _, t in held]) >= 0.98
    insulted = [got[i].p_insult for i, x, t in held if "moron" in x]
    assert np.mean(insulted) > 3 * np.mean([got[i].p_insult for i, x, t in held if not t])


def test_toxicity_edge_cases(spark):
    table = edge_table(spark).withColumn("p_toxic", F.lit("old"))
    none = toxicity.score_toxicity(table, None, names=["toxic"])
    assert none.columns == ["doc_id", "text", "score", "p_toxic"] and {r.p_toxic for r in none.collect()} == {0.0}
    labels = spark.createDataFrame([(4, 1), (2, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    chain = toxicity.fit_toxicity(table, labels, SEEDS)
    assert all(0 <= r.p_toxic <= 1 for r in toxicity.score_toxicity(table, chain).collect())
    assert toxicity.fit_toxicity(table, labels.limit(0), SEEDS) is None
    assert toxicity.score_toxicity(table.limit(0), chain).count() == 0


def test_toxicity_query_by_language(spark):
    """The registered query on the given labels, which it learns from: what it finds, and what it spares."""
    found = queries.op10_toxicity(spark, SF)
    assert found.columns == ["doc_id", "p_insult", "p_contempt", "score", "toxic"] and found.count() == 1000
    labels, docs = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "documents"))
    rows = found.join(labels.select("doc_id", F.col("toxic").alias("label")), "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    hits = {x: [r.toxic for r in rows if r.label == 1 and r.lang == x] for x in ("en", "de", "es", "fr")}
    assert all(np.mean(hits[x]) >= 0.9 for x in ("en", "de", "es"))  # five French examples are too few to learn from
    assert sum(r.toxic for r in rows if r.label == 0) == 0


def test_toxicity_of_held_out_documents(spark):
    """Labels of four fifths of sf0.1, in four languages; the rest is held out."""
    labels, docs = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("labels", "documents"))
    away = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    chain = toxicity.fit_toxicity(docs, labels.where(~away), queries.TOXIC_SEEDS)
    held = docs.join(labels.where(away).select("doc_id", "toxic"), "doc_id")
    rows = toxicity.score_toxicity(held, chain).collect()
    for lang in ("en", "de", "fr", "es"):
        mine = [(r.p_toxic >= queries.TOXIC_THRESHOLD, r.toxic) for r in rows if r.lang == lang]
        assert np.mean([p for p, t in mine if t]) >= 0.85, lang
        assert np.mean([p for p, t in mine if not t]) <= 0.01, lang


def test_stems_count_different_words():
    texts = ["abcdefgone abcdefgtwo", "abcdefgone abcdefgone", "abcdefga abcdefgb abcdefgc abcdefgd"]
    (_, data, offsets), = flat(texts)
    doc, key, stem = toxicity.text_features(data, offsets)
    counted = [set(key[(doc == d) & (stem != 0)].tolist()) for d in range(3)]
    assert len(counted[0]) == 3 and counted[1] == set()  # one of each length; repeats of a word are one word
    assert counted[0] < counted[2] and len(counted[2]) == 6
    some = np.unique(stem[stem != 0])[:1]
    again = toxicity.text_features(data, offsets, some)
    assert set(again[2].tolist()) == {0, int(some[0])}


def test_a_long_text_in_parts(monkeypatch):
    model = langid.ByteGru.start(["a", "b", "c"], 8, 1)
    rng = np.random.default_rng(1)
    data = rng.integers(97, 110, 5000).astype(np.uint8)
    whole = langid.document_probabilities(model, data, np.array([0, 5000]), 96)
    monkeypatch.setattr(langid, "LONG", 7)
    assert np.allclose(langid.document_probabilities(model, data, np.array([0, 5000]), 96), whole, atol=1e-6)


def test_extra_columns_come_back_unchanged(spark):
    """Every operator that returns its input's columns, given columns with names that it uses inside."""
    from corate.llm.decontaminate import decontaminate
    from corate.llm.exact import exact_dedup
    from corate.llm.html_text import extract_main_text
    from corate.llm.lines import line_dedup
    from corate.llm.mixing import mixed_documents
    from corate.llm.near import near_dedup
    from corate.llm.url_rules import filter_urls

    names = [
        "_gone", "_no_id", "_hash", "_at", "_part", "_row", "_row_key", "_rows", "_id", "_print", "_spans", "_text", "_source", "_size", "_lang",
        "_score", "_p", "_matches", "_judged", "_of", "_found", "_new", "_words", "_label", "_spot", "_nth", "id", "print", "key", "n", "row",
    ]
    texts = ["one two three four five six", "one two three four five six", "a\nb\nc\nd", "a\nb\nc", None, "clean words of its own"]
    rows = [(i, t, "s", "http://x.com/a", "<p>hello</p>", *[f"{n}{i}" for n in names]) for i, t in zip([1, 1, 2, 3, None, 5], texts, strict=True)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, url string, html string, " + ", ".join(f"`{n}` string" for n in names))
    bench = spark.createDataFrame([(1, "nothing of this occurs anywhere in the documents at all")], "item_id long, text string")
    calls = {
        "exact": exact_dedup, "near": near_dedup, "lines": line_dedup, "mix": mixed_documents, "clean": lambda d: decontaminate(d, bench),
        "urls": lambda d: filter_urls(d, queries.URL_RULES), "html": extract_main_text,
        "quality": lambda d: quality.score_quality(d, None), "language": lambda d: langid.predict_language(d, None),
        "toxicity": lambda d: toxicity.score_toxicity(d, None),
    }
    own = {tuple(r[n] for n in names) for r in table.collect()}
    for what, call in calls.items():
        got = call(table)
        assert set(names) <= set(got.columns), what
        found = [tuple(r[n] for n in names) for r in got.collect()]
        assert found and set(found) <= own, what
