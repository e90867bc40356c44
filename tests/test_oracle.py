"""Every registered query against its SQL, on the smallest tables, as is and
with all limits lowered so that the ways for large data are taken."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from roamrank.checks import oracle, queries
from roamrank.operators import dims, joins, recommend

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def same(left, right):
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-9, abs_tol=1e-9)
    return left == right


def compare(df, tables, sql):
    columns = sorted(df.columns)
    got = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=str)
    cursor = tables.execute(sql)
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted((tuple(row[p] for p in places) for row in cursor.fetchall()), key=str)
    assert len(got) == len(expected)
    for mine, theirs in zip(got, expected):
        assert all(map(same, mine, theirs)), (mine, theirs)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, tables, name):
    compare(contract.queries()[name](spark, SF_DIR), tables, contract.oracle_sql()[name])


def test_rank1_order_is_no_luck(spark, tables):
    """Gaps between neighbouring weights dwarf the two engines' difference."""
    _, fitted = queries._converged_model(spark, SF_DIR)
    mine = {row["id"]: abs(row["features"][0]) for row in fitted.item_factors.collect()}
    sql = oracle._sql("SELECT id, f0 FROM itf", *oracle._rank1())
    theirs = {row[0]: abs(row[1]) for row in tables.execute(sql).fetchall()}
    assert mine.keys() == theirs.keys()

    def scaled(weights):
        length = math.sqrt(sum(w * w for w in weights.values()))
        return {key: w / length for key, w in weights.items()}

    mine, theirs = scaled(mine), scaled(theirs)
    difference = max(abs(mine[key] - theirs[key]) for key in mine)
    ordered = sorted(theirs.values())
    assert min(b - a for a, b in zip(ordered, ordered[1:])) > 5 * difference


LARGE = ["visits", "ratings", "unmatched_reviews", "trainer_ids", "predict_pairs", "publish_novel"]


@pytest.mark.parametrize("name", LARGE)
def test_query_by_the_ways_for_large_data(spark, tables, name, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(dims, "SINGLE_TASK_KEYS", 0)
    monkeypatch.setattr(recommend, "CHUNK_NUMBERS", 14)
    compare(contract.queries()[name](spark, SF_DIR), tables, contract.oracle_sql()[name])


def test_whole_job_at_the_default_configuration(spark):
    result = contract.entry(spark)
    assert result.columns == ["reviewerId", "reviewerName", "neighbourhoodNames", "date"]
    assert result.count() == 150


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(oracle.queries())
