"""Results do not depend on the number of shuffle partitions."""

from corate.plans.recommend import item_based
from corate.plans.similar import similar_pairs
from corate.sources import fixtures
from tests.conftest import SF_SMALL


def _with_partitions(spark, n, fn):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in fn().collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_similar_pairs_and_predictions_partition_invariant(spark):
    tokens = fixtures.document_tokens(spark, SF_SMALL)
    train, valid = fixtures.split_ratings(fixtures.ratings_fixture(spark, SF_SMALL))
    a = _with_partitions(spark, 3, lambda: similar_pairs(tokens, min_sim=0.5))
    b = _with_partitions(spark, 11, lambda: similar_pairs(tokens, min_sim=0.5))
    assert a == b and len(a) == 27
    p = _with_partitions(spark, 3, lambda: item_based(train, valid, min_sim=0.2))
    q = _with_partitions(spark, 11, lambda: item_based(train, valid, min_sim=0.2))
    assert p == q and len(p) == 649
