"""Both ways of joining give the same rows, skew, copies and nulls included."""

import re

import pytest
from pyspark.sql import functions as F

from roamrank.operators import joins
from tests.conftest import rows


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows on one key, equal copies among them, and nulls."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50)
    return spark.range(3000).select(key.cast("bigint").alias("key"), (F.col("id") % 4).alias("value"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(40).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(fact, dim, how):
    plain = rows(fact.join(dim, "key", how))
    assert rows(joins.lookup_join(fact, dim, "key", how)) == plain
    assert rows(joins.lookup_join(fact, dim, "key", how, broadcast_bytes=0)) == plain
    assert rows(joins.lookup_join(fact, dim, "key", how, broadcast_bytes=0, rows_per_task=50)) == plain


def test_hot_key_is_spread(fact):
    hot = joins.hot_keys(fact, "key", rows_per_task=100)
    fan_out = {row["key"]: row[joins.FAN_OUT] for row in hot.table.collect()}
    assert fan_out[7] >= 10 and None in fan_out
    salted = hot.salt(fact.repartition(16)).where("key = 7")
    sizes = [row["count"] for row in salted.groupBy(joins.SALT).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 400


def test_equal_copies_are_spread(spark):
    copies = spark.range(0, 4000, 1, 40).select(F.lit(1).cast("bigint").alias("key"))
    hot = joins.hot_keys(copies, "key", rows_per_task=400)
    assert hot.salt(copies).select(joins.SALT).distinct().count() >= 5


def test_salt_is_the_same_on_every_evaluation(fact):
    hot = joins.hot_keys(fact, "key", rows_per_task=100)
    parts = fact.repartition(8, "value")
    assert rows(hot.salt(parts)) == rows(hot.salt(parts))


def test_no_hot_keys(fact):
    assert joins.hot_keys(fact, "key", rows_per_task=10**6).table is None


def test_payload(spark):
    assert joins.payload_bytes(spark.range(10)) == 10 * 24
    words = spark.createDataFrame([("ab", [1.0, 2.0]), (None, None)], "w string, v array<double>")
    assert joins.payload_bytes(words) == 2 * (16 + 8 + 8) + 2 + 16
    assert joins.payload_bytes(words.limit(0)) == 0
    nested = spark.sql("SELECT map(1, 'abc') AS m, array('x', 'y') AS a, struct(1 AS n, 'z' AS t) AS s")
    assert 3 * 32 <= joins.payload_bytes(nested) < 400


def executed(df):
    """The plan that ran, after what Spark changed while it ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_own_broadcasts(spark):
    """Spark itself broadcasts nothing, so that what is asked for shows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_plan_broadcasts_small_and_shuffles_large(spark, fact, dim, tmp_path, no_own_broadcasts):
    fact.write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    small = executed(joins.lookup_join(stored, dim, "key"))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "PushedFilters: [IsNotNull(key)]" in small
    large = executed(joins.lookup_join(stored, dim, "key", broadcast_bytes=0))
    assert "SortMergeJoin" in large and "BroadcastHashJoin" not in large


def test_hot_keys_are_found_in_part_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_TO_TELL", 1000)
    many = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("key")
    )
    hot = joins.hot_keys(many, "key", rows_per_task=20_000)
    assert [(row["key"], row[joins.FAN_OUT]) for row in hot.table.collect()] in ([(7, 5)], [(7, 6)])


def test_salted_join_sorts_and_merges_by_the_salt(fact, dim, no_own_broadcasts):
    salted = joins.lookup_join(fact, dim, "key", broadcast_bytes=0, rows_per_task=50)
    plan = executed(salted)
    assert re.search(rf"SortMergeJoin \[key#\d+L?, {joins.SALT}#\d+L?\]", plan)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert rows(salted) == rows(joins.lookup_join(fact, dim, "key"))
