"""Dimensions, visits and ratings on small hand-made rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from roamrank.operators import dims, ratings, visits
from tests.conftest import rows

DAY = datetime.date


def reviews_of(spark, records):
    return spark.createDataFrame(
        [(listing, DAY.fromisoformat(day), who, name) for listing, day, who, name in records],
        "listing_id bigint, date date, reviewer_id bigint, reviewer_name string",
    )


def listing_area_of(spark, pairs):
    return spark.createDataFrame(
        [(listing, 1, "Hal", f"A{area}", area) for listing, area in pairs],
        "id bigint, host_id bigint, host_name string, neighbourhood string, neighbourhood_id bigint",
    )


def test_area_ids_follow_names_over_any_partitions(spark):
    names = [f"area {c}" for c in "hgfedcba"]
    areas = spark.createDataFrame([("G", n) for n in names], "neighbourhood_group string, neighbourhood string")
    expected = [(name, place) for place, name in enumerate(sorted(names))]
    assert rows(dims.area_dim(areas.repartition(4))) == expected


def test_area_in_two_groups_is_an_error(spark):
    areas = spark.createDataFrame(
        [("G1", "A"), ("G2", "A")], "neighbourhood_group string, neighbourhood string"
    )
    with pytest.raises(ValueError, match="more than one group: 'A'"):
        dims.area_dim(areas)


def test_repeated_and_null_areas(spark):
    areas = spark.createDataFrame(
        [(None, "B"), (None, "B"), (None, None), (None, "A")],
        "neighbourhood_group string, neighbourhood string",
    )
    assert rows(dims.area_dim(areas)) == [("A", 0), ("B", 1)]
    assert rows(dims.area_dim(areas.drop("neighbourhood_group"))) == [("A", 0), ("B", 1)]


@pytest.mark.parametrize("limit", [0, 10**6])
def test_dense_id_both_ways(spark, limit):
    keys = spark.range(5000).select((F.col("id") % 1700 * 3 + 5_000_000_000).alias("key"))
    numbered = rows(dims.dense_id(keys, "key", "n", single_task_keys=limit))
    assert numbered == sorted([(5_000_000_000 + 3 * n, n) for n in range(1700)], key=str)


def test_dense_id_of_nothing(spark):
    none = spark.createDataFrame([(None,)], "key bigint")
    assert rows(dims.dense_id(none, "key", "n")) == []


def test_latest_name_wins(spark):
    table = reviews_of(
        spark,
        [
            (1, "2019-02-01", 1, "New"),
            (1, "2019-01-01", 1, "Old"),
            (1, "2019-01-01", 2, "Ann"),
            (1, "2019-01-01", 2, "Bob"),
            (1, "2019-01-01", 3, None),
            (1, "2019-01-01", 4, "Cy"),
            (1, "2019-02-01", 4, None),
        ],
    )
    assert rows(dims.reviewer_dim(table)) == [(1, "New"), (2, "Bob"), (4, "Cy")]


def test_renamed_reviewer_is_one_rating(spark):
    table = reviews_of(spark, [(1, "2019-01-01", 1, "Old"), (1, "2019-02-01", 1, "New")])
    listings = listing_area_of(spark, [(1, 0)])
    assert rows(ratings.build_ratings(listings, table)) == [(1, 0, 2.0)]
    named = ratings.visit_counts_named(visits.join_reviews(listings, table))
    assert rows(named) == [(1, "New", 0, "A0", 1), (1, "Old", 0, "A0", 1)]


def test_unmatched(spark):
    listings = spark.createDataFrame(
        [(1, 1, "h", "A"), (2, 1, "h", "Z"), (3, 1, "h", None)],
        "id bigint, host_id bigint, host_name string, neighbourhood string",
    )
    areas = spark.createDataFrame([("A", 0)], "neighbourhood string, neighbourhood_id bigint")
    joined = visits.join_listing_area(listings, areas)
    assert rows(joined) == [(1, 1, "h", "A", 0)]
    assert rows(visits.unmatched_listings(listings, areas).select("id")) == [(2,), (3,)]

    table = reviews_of(
        spark, [(1, "2019-01-01", 7, "Ann"), (2, "2019-01-01", 7, "Ann"), (None, "2019-01-01", 8, "Bob")]
    )
    assert rows(visits.join_reviews(joined, table).select("listing_id", "reviewer_id")) == [(1, 7)]
    left_out = visits.unmatched_reviews(joined, table)
    assert rows(left_out.select("listing_id", "reviewer_id")) == [(2, 7), (None, 8)]


def test_review_without_reviewer_is_no_rating(spark):
    table = reviews_of(spark, [(1, "2019-01-01", None, "Ann"), (1, "2019-01-01", 2, "Bob")])
    assert rows(ratings.build_ratings(listing_area_of(spark, [(1, 0)]), table)) == [(2, 0, 1.0)]


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "rows_per_task": 5}])
def test_ratings_of_a_hot_listing(spark, options):
    table = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 20).cast("bigint").alias("listing_id"),
        F.lit(DAY(2019, 1, 1)).alias("date"),
        (F.col("id") % 7).alias("reviewer_id"),
        F.lit("Ann").alias("reviewer_name"),
    )
    counted = {}
    for n in range(900):
        pair = (n % 7, (1 if n % 3 == 0 else n % 20) % 4)
        counted[pair] = counted.get(pair, 0) + 1
    listings = listing_area_of(spark, [(n, n % 4) for n in range(20)])
    expected = sorted([(u, i, float(n)) for (u, i), n in counted.items()], key=str)
    assert rows(ratings.build_ratings(listings, table, **options)) == expected


def test_large_ids_train_under_dense_ones(spark):
    counted = spark.createDataFrame(
        [(5_000_000_009, 0, 1.0), (5_000_000_000, 1, 2.0)],
        "reviewer_id bigint, neighbourhood_id bigint, rating double",
    )
    keyed = ratings.to_trainer(counted)
    assert rows(keyed.ratings) == [(0, 1, 2.0), (1, 0, 1.0)]
    assert rows(keyed.users) == [(5_000_000_000, 0), (5_000_000_009, 1)]


def test_ids_that_fit_are_kept(spark):
    counted = spark.createDataFrame(
        [(2**31 - 1, 3, 1.0)], "reviewer_id bigint, neighbourhood_id bigint, rating double"
    )
    keyed = ratings.to_trainer(counted)
    assert keyed.users is None and rows(keyed.ratings) == [(2**31 - 1, 3, 1.0)]
    assert dict(keyed.ratings.dtypes) == {"user": "int", "item": "int", "rating": "double"}


def test_splits_are_whole_and_disjoint(spark):
    rated = spark.range(20000).selectExpr("cast(id % 400 as int) user", "cast(id / 400 as int) item", "1D rating")
    for train, test in (ratings.holdout_split(rated, seed=1), ratings.random_split(rated, seed=1)):
        assert sorted(rows(train) + rows(test), key=str) == rows(rated)
        assert 0.77 < train.count() / 20000 < 0.83
    again, _ = ratings.holdout_split(rated.repartition(5), seed=1)
    other, _ = ratings.holdout_split(rated, seed=2)
    first, _ = ratings.holdout_split(rated, seed=1)
    assert rows(first) == rows(again) != rows(other)


def test_split_seeds_are_independent(spark):
    pairs = spark.range(1500).crossJoin(spark.range(25).withColumnRenamed("id", "item"))
    rated = pairs.select(F.col("id").alias("user"), "item", F.lit(1.0).alias("rating"))
    held = {seed: set(map(tuple, ratings.holdout_split(rated, seed=seed)[1].collect())) for seed in (1, 42, 43, 101)}
    for a in held:
        assert abs(len(held[a]) / 37_500 - 0.2) < 0.01
        for b in held:
            if a != b:
                assert abs(len(held[a] & held[b]) / len(held[a]) - 0.2) < 0.03
