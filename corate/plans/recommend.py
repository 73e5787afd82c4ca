"""Recommenders end to end and the command-line entry point.

``recommend(train, validation, method)`` predicts the rating of every
validation key with one of:

* ``"item"``: item-based CF, LSH neighbourhood (Jaccard >= min_sim), co-rating weights;
* ``"user"``: user-based CF on swapped roles, all user pairs with Jaccard >= USER_MIN_SIM;
* ``"mean"``: item mean, else user mean (what the reference's user case outputs);
* ``"als"``:  ALS matrix factorisation.

Validation keys are removed from training first (``exclude_validation``).
Repeated ratings of one ``(user, item)`` count once, at their highest.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.functions.hashing import DEFAULT_BANDS, DEFAULT_ROWS
from corate.operators.basic import exclude_pairs, one_rating, swap_roles
from corate.operators.evaluate import rmse
from corate.operators.exact import exact_similar_pairs
from corate.operators.factor import als_fit, als_predict
from corate.operators.index import union_index
from corate.operators.neighbours import neighbour_table
from corate.operators.predict import predict_item_based, predict_mean, predict_user_based
from corate.plans.similar import similar_pairs
from corate.session import materialize

METHODS = ("item", "user", "mean", "als")

# User-based CF: least Jaccard of two users' item sets.  All such pairs are found, by the exact join.
USER_MIN_SIM = 0.25


@dataclass(frozen=True)
class Result:
    predictions: DataFrame
    rmse: DataFrame


def item_neighbours(
    train: DataFrame,
    test: DataFrame,
    min_sim: float = 0.5,
    strict: bool = False,
    center: str = "active",
    family=None,
    bands: int = DEFAULT_BANDS,
    rows: int = DEFAULT_ROWS,
    unique: bool = False,
    recall: float | None = None,
) -> DataFrame:
    """Neighbour lists of the test items: LSH pairs over training, co-rating weights."""
    universe = union_index(train, test, "user_id")
    pairs = similar_pairs(train, min_sim, strict, family, bands, rows, universe, recall=recall)
    return neighbour_table(pairs, train, targets=test.select("item_id"), center=center, unique=unique)


def item_based(
    train: DataFrame, test: DataFrame, min_sim: float = 0.5, center: str = "active", unique: bool = False, **lsh
) -> DataFrame:
    train = train if unique else materialize(one_rating(train), "ratings")
    neighbours = item_neighbours(train, test, min_sim, False, center, unique=True, **lsh)
    return predict_item_based(train, test, neighbours, unique=True)


def similar_users(
    train: DataFrame,
    test: DataFrame,
    min_sim: float = USER_MIN_SIM,
    bands: int | None = None,
    rows: int = DEFAULT_ROWS,
    family=None,
    recall: float | None = None,
) -> DataFrame:
    """All pairs of users whose item sets have Jaccard >= ``min_sim``; with ``bands`` or ``recall``, those that LSH finds.

    ``min_sim`` must be positive: at 0 nearly all pairs would do.
    """
    if not 0 < min_sim <= 1:
        raise ValueError("user-based neighbourhoods need a min_sim in (0, 1]")
    swapped = swap_roles(train)
    if bands is None and recall is None:
        return exact_similar_pairs(swapped, min_sim)
    universe = union_index(swapped, swap_roles(test), "user_id")
    return similar_pairs(swapped, min_sim, False, family, bands or DEFAULT_BANDS, rows, universe, recall=recall)


def user_based(
    train: DataFrame,
    test: DataFrame,
    min_sim: float = USER_MIN_SIM,
    center: str = "active",
    include_active: bool = False,
    unique: bool = False,
    **lsh,
) -> DataFrame:
    train = train if unique else materialize(one_rating(train), "ratings")
    pairs = similar_users(train, test, min_sim, **lsh)
    targets = test.select(F.col("user_id").alias("item_id"))
    neighbours = neighbour_table(pairs, swap_roles(train), targets=targets, center=center, unique=True)
    return predict_user_based(train, test, neighbours, include_active, unique=True)


def als_based(train: DataFrame, test: DataFrame, implicit: bool = False, **params) -> DataFrame:
    return als_predict(als_fit(train, test, implicit=implicit, **params), test)


def recommend(
    train: DataFrame,
    validation: DataFrame,
    method: str = "item",
    exclude_validation: bool = True,
    **params,
) -> Result:
    """Predictions for the validation keys and their RMSE against the validation ratings."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    if exclude_validation:
        train = exclude_pairs(train, validation)
    train = materialize(one_rating(train), "ratings")  # read by every branch of the plan
    if method == "item":
        pred = item_based(train, validation, unique=True, **params)
    elif method == "user":
        pred = user_based(train, validation, unique=True, **params)
    elif method == "mean":
        pred = predict_mean(train, validation, unique=True)
    else:
        pred = als_based(train, validation, **params)
    return Result(pred, rmse(pred, validation))


def main(argv=None) -> None:
    """``spark-submit corate/plans/recommend.py train.csv val.csv method out_dir``.

    The package must be importable (``--py-files`` or ``PYTHONPATH``).
    """
    from corate.session import build_session, scratch_scope
    from corate.sources.io import ingest_ratings, read_ratings, write_predictions

    def read(spark, path, name):
        if args.quarantine is None:
            return read_ratings(spark, path)
        found = ingest_ratings(spark, path, f"{args.quarantine}/{name}")
        print(f"{name}: {found.n_lines} lines, set aside: {found.n_bad}")
        return found.rows

    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("train")
    parser.add_argument("validation")
    parser.add_argument("method", choices=METHODS)
    parser.add_argument("output")
    parser.add_argument("--keep-validation-in-train", action="store_true")
    parser.add_argument("--quarantine", help="folder for malformed lines, which else end the job")
    args = parser.parse_args(argv)
    spark = build_session()
    with scratch_scope(spark):
        train, valid = read(spark, args.train, "train"), read(spark, args.validation, "validation")
        result = recommend(train, valid, args.method, exclude_validation=not args.keep_validation_in_train)
        predictions = materialize(result.predictions, "predictions")
        write_predictions(predictions, args.output)
        print("RMSE:", rmse(predictions, valid).first()["rmse"])


if __name__ == "__main__":
    main()
