"""Candidates of LSH are made where two chunks of items meet, and their pairs are not shuffled."""

import itertools
import random

import pytest

from corate.functions.hashing import hash_family
from corate.operators import minhash
from corate.operators.index import dense_index
from corate.operators.minhash import band_keys, baskets, lsh_candidates, signatures
from corate.plans import registry
from tests.conftest import SF_SMALL


def _above(df, node: str) -> list[str]:
    """The nodes of the optimized plan above the first ``node``."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next((n for n, line in enumerate(lines) if node in line), len(lines))
    return [line.lstrip("+-: ").split(" ")[0] for line in lines[:at]]


@pytest.mark.parametrize("query", [registry.q_lsh_candidates, registry.q_lsh_jaccard])
def test_pairs_are_not_shuffled(spark, query):
    # Before, pairs met in joins of bands (and again with their baskets) and were told apart by a shuffle.
    assert set(_above(query(spark, SF_SMALL), "MapInArrow")) <= {"Project"}


@pytest.mark.parametrize("slice_rows, tile, least", [(1, 3, 1), (7, 10, 3), (1_000_000, 1000, 1), (50, 1000, 8)])
def test_similarity_of_every_candidate(spark, monkeypatch, slice_rows, tile, least):
    monkeypatch.setattr(minhash, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(minhash, "LEAST_CHUNKS", least)
    rng = random.Random(5)
    rows = [(f"u{rng.randrange(30)}", f"i{rng.randrange(40)}") for _ in range(300)]
    rows += [(f"v{u}", f"copy{k}") for u in range(4) for k in range(25)]
    rows += [("u1", None), ("u2", None), ("only", "alone")]
    df = spark.createDataFrame(rows, "user_id string, item_id string")
    index, family = dense_index(df, "user_id"), hash_family()
    bk = baskets(df, index)
    keys = band_keys(signatures(bk, family, index.size), len(family))
    members, users = {}, {}
    for r in keys.collect():
        if r.item_id is not None:
            members.setdefault((r.band, r.key), []).append(r.item_id)
    for u, i in rows:
        users.setdefault(i, set()).add(u)
    pairs = {p for m in members.values() for p in itertools.combinations(sorted(m), 2)}
    want = {p: len(users[p[0]] & users[p[1]]) / len(users[p[0]] | users[p[1]]) for p in pairs}
    got = [((r.id1, r.id2), r.similarity) for r in lsh_candidates(keys, tile, bk).collect()]
    assert len(got) == len(want) and dict(got) == want and min(want.values()) == 0 and max(want.values()) == 1
    plain = [tuple(r) for r in lsh_candidates(keys, tile).collect()]
    assert len(plain) == len(want) and set(plain) == set(want)


def test_no_bucket_of_two(spark):
    df = spark.createDataFrame([("u1", "a"), ("u2", "b")], "user_id string, item_id string")
    for rows in (df, df.limit(0)):
        index, family = dense_index(rows, "user_id"), hash_family()
        bk = baskets(rows, index)
        keys = band_keys(signatures(bk, family, index.size), len(family)).where("band < 0")
        assert lsh_candidates(keys).collect() == [] and lsh_candidates(keys, basket_df=bk).collect() == []
