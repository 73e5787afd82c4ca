"""Substring dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest

from corate.llm.substrings import RunHashes, own_anchors, substring_dedup

SCHEMA = "doc_id long, text string"


def brute(rows, window):
    """Documents in the order of ids, null ones last; rows of one id and the same words are one document."""
    texts = sorted({(i is None, i or 0, tuple((t or "").encode().split())) for i, t in rows})
    first, out = {}, {}
    for null, i, words in texts:
        cut = range(len(words) - window + 1)
        gone = set()
        for k in cut:
            if first.setdefault(words[k : k + window], (null, i)) != (null, i):
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[null, i, words] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return sorted(
        ((i, *out[i is None, i or 0, tuple((t or "").encode().split())]) for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[3])
    )


def run(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = [tuple(r) for r in substring_dedup(table, **options).collect()]
    return sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


def corpus(seed, vocabulary, n=120):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.choice([3, 7, 12, 30]))] for _ in range(6)]
    hub = [word() for _ in range(90)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3:  # a near copy: a few words of the hub changed, some left out
            text = [w if rng.random() > 0.04 else word() for w in hub]
            cut = rng.randrange(20)
            text = text[cut : len(text) - rng.randrange(20)]
        elif kind < 0.4 and texts:
            text = list(rng.choice(texts))
        else:
            text = []
            for _ in range(rng.randrange(5)):
                text += rng.choice(passages) if rng.random() < 0.5 else [word() for _ in range(rng.randrange(25))]
        texts.append(text)
    texts += [["a"] * 40, ["a"] * 25, ["a", "b"] * 20, ["b", "a"] * 9, hub + hub, ["é", "ß"] * 15, ["Ü"] * 8]
    ids = rng.sample(range(1000), len(texts))
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(t)) for i, t in zip(ids, texts, strict=True)]
    return rows + [(2000, None), (2001, ""), (2002, " \n ")]


@pytest.mark.parametrize(("seed", "vocabulary"), [(1, 2), (2, 6), (3, 400)])
def test_equals_brute_force(spark, seed, vocabulary):
    rows = corpus(seed, vocabulary)
    assert run(spark, rows, window=8, gram=3, block=16) == brute(rows, 8)


def test_production_parameters(spark):
    rng = random.Random(5)
    passage = [f"p{rng.random()}" for _ in range(70)]
    rows = [(9, " ".join(passage[:49])), (8, " ".join(passage[:50])), (7, " ".join(["x", *passage, "y"]))]
    rows += [(i, " ".join([f"u{rng.random()}" for _ in range(3000)] + passage[i % 5 :] + [f"u{i}"])) for i in range(20, 40)]
    assert run(spark, rows) == brute(rows, 50)


def test_odd_rows(spark):
    """Null and repeated ids, repeated rows, equal words under different ids."""
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(3, long), (3, long), (3, long.replace(" ", "\n")), (5, long), (None, long), (None, long + " more"), (4, None), (4, None)]
    assert run(spark, rows, window=8, gram=3, block=16) == brute(rows, 8)
    alone = [(None, long), (None, long), (1, "short")]
    assert [r[2] for r in run(spark, alone, window=8, gram=3)] == [0, 0, 0]


def test_different_texts_of_one_id_are_ordered(spark):
    shared = " ".join(f"w{k}" for k in range(20))
    found = run(spark, [(1, shared + " end"), (1, "start " + shared)], window=8, gram=3)
    assert sorted(r[2] for r in found) == [0, 20]  # one of the two keeps the passage


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, [], window=8, gram=3) == []
    rows = [(1, "a b c d e f g h i"), (2, "x a b c d e f g h")]
    names = ["node", "id", "pos", "key", "n", "digest", "sha", "n_words", "n_removed", "kept_sha256", "home", "_row_key", "_rows"]
    table = spark.createDataFrame([(*r, *[7] * len(names)) for r in rows], ["doc_id", "text", *names])
    found = sorted(tuple(r) for r in substring_dedup(table, window=8, gram=3).collect())
    assert found == brute(rows, 8)


def test_very_long_text(spark):
    """One text of 200,000 words, and a repetitive one, in bounded time."""
    rng = random.Random(3)
    long = [f"w{rng.randrange(5000)}" for _ in range(200_000)]
    rows = [(1, " ".join(long)), (2, " ".join(["q", *long[150_000:150_500], "q"])), (3, " ".join(["z"] * 3000)), (4, " ".join(["z"] * 3000))]
    assert run(spark, rows) == brute(rows, 50)


def test_run_hashes_do_not_depend_on_the_place():
    key = np.random.default_rng(1).integers(0, 2**63, 40).astype(np.uint64)
    twice = RunHashes(np.concatenate([key, key[:3], key]), np.uint64(0x9E3779B97F4A7C15))
    begin = np.arange(30)
    assert (twice(begin, begin + 10) == twice(begin + 43, begin + 53)).all()
    assert len(set(twice(begin, begin + 10).tolist())) == 30


def test_own_anchor_is_the_leftmost_least():
    gram = np.random.default_rng(2).integers(0, 5, 200).astype(np.uint64)
    for width in (1, 2, 5, 8, 35):
        want = [k + int(np.argmin(gram[k : k + width])) for k in range(len(gram) - width + 1)]
        assert own_anchors(gram, width).tolist() == want
