"""Top-k, the novelty filter, naming and the sinks."""

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from roamrank import sinks
from roamrank.operators import model, recommend
from roamrank.operators.model import AlsConfig, FactorModel
from tests.conftest import rows

FACTORS = "id int, features array<double>"


def factor_model(spark, users, items):
    def table(vectors):
        return spark.createDataFrame([(n, [float(x) for x in v]) for n, v in vectors.items()], FACTORS)

    return FactorModel(len(next(iter(users.values()))), table(users), table(items))


@pytest.fixture(scope="module")
def random_model(spark):
    rng = np.random.default_rng(3)
    # Whole numbers give many equal scores.
    users = {3 * n: rng.integers(-2, 3, 2).astype(float) for n in range(200)}
    items = {5 * n + 1: rng.integers(-2, 3, 2).astype(float) for n in range(60)}
    return users, items, factor_model(spark, users, items)


def brute_force(users, items, k, seen=frozenset()):
    best = {}
    for user, p in users.items():
        scored = [(-float(p @ q), item) for item, q in items.items() if (user, item) not in seen]
        best[user] = [(item, -score) for score, item in sorted(scored)[:k]]
    return best


def as_lists(df):
    return {row["user"]: [(x["item"], x["score"]) for x in row["items"]] for row in df.collect()}


@pytest.mark.parametrize("chunk", [None, 7, 60])
@pytest.mark.parametrize("k", [1, 5, 100])
def test_topk_is_brute_force(random_model, k, chunk):
    users, items, fitted = random_model
    assert as_lists(recommend.recommend_topk(fitted, k, chunk_items=chunk)) == brute_force(users, items, k)


@pytest.mark.parametrize("chunk", [None, 7])
def test_unseen_topk_is_brute_force(spark, random_model, chunk):
    users, items, fitted = random_model
    rng = np.random.default_rng(4)
    seen = {(u, i) for u in users for i in items if rng.random() < u / 600}
    table = spark.createDataFrame(sorted(seen) + [(0, 999_999)], "user int, item int")
    got = as_lists(recommend.recommend_topk(fitted, 5, seen=table, chunk_items=chunk))
    assert got == brute_force(users, items, 5, seen)


def test_visited_everything(spark):
    fitted = factor_model(spark, {1: [1.0], 2: [1.0]}, {0: [1.0], 1: [2.0]})
    seen = spark.createDataFrame([(1, 0), (1, 1)], "user int, item int")
    best = recommend.recommend_topk(fitted, 5, seen=seen)
    assert as_lists(best) == {1: [], 2: [(1, 2.0), (0, 1.0)]}
    areas = spark.createDataFrame([("A", 0), ("B", 1)], "neighbourhood string, neighbourhood_id bigint")
    people = spark.createDataFrame([(1, "Ann")], "reviewer_id bigint, reviewer_name string")
    named = recommend.attach_names(best, areas, people, as_of="2019-07-01")
    assert rows(named) == [
        (1, "Ann", [], "2019-07-01"),
        (2, "empty", ["B", "A"], "2019-07-01"),
    ]


def test_work_is_split_without_changing_results(random_model, monkeypatch):
    users, items, fitted = random_model
    monkeypatch.setattr(recommend, "SCORES_PER_TASK", 100)
    monkeypatch.setattr(recommend, "SCORES_IN_MEMORY", 130)
    assert as_lists(recommend.recommend_topk(fitted, 4)) == brute_force(users, items, 4)


def test_agrees_with_mllib(spark):
    rated = spark.range(4000).selectExpr(
        "cast(id % 200 as int) user", "cast(id / 200 as int) item", "cast(1 + pmod(xxhash64(id), 9) as double) rating"
    )
    fitted = model.fit_mllib(rated, AlsConfig(seed=2))
    ours = as_lists(recommend.recommend_topk(FactorModel.from_mllib(fitted), 5))
    for row in fitted.recommendForAllUsers(5).collect():
        theirs = [(x["item"], x["rating"]) for x in row["recommendations"]]
        assert [i for i, _ in theirs] == [i for i, _ in ours[row["user"]]]
        assert np.allclose([s for _, s in theirs], [s for _, s in ours[row["user"]]], atol=1e-4)


@pytest.mark.parametrize("zeros", [False, True])
def test_blocks_of_short_vectors_are_left_out(spark, zeros):
    """Few long vectors, many short ones: most pairs of bundle and block are never met."""
    rng = np.random.default_rng(11)
    users = {n: np.abs(rng.normal(size=4)) for n in range(300)}
    items = {n: np.abs(rng.normal(size=4)) * 0.8**n for n in range(80)}
    if zeros:
        users[7], users[8] = np.zeros(4), -users[8]  # equal scores for all, and no bar above zero
        items[79] = items[78] = np.zeros(4)
    seen = {(n, i) for n in users for i in items if n % 50 == 3 and i < 60}
    fitted, visits = factor_model(spark, users, items), Observation()
    table = spark.createDataFrame(sorted(seen), "user int, item int")
    got = as_lists(recommend.recommend_topk(fitted, 5, table, chunk_items=8, visits=visits))
    want = brute_force(users, items, 5, seen)
    assert {u: [i for i, _ in found] for u, found in got.items()} == {u: [i for i, _ in found] for u, found in want.items()}
    assert visits.get["pairs"] == 300 * 9 and 0 < visits.get["met"] < 300 * 2


def test_short_vectors_in_small_bundles(spark, monkeypatch):
    monkeypatch.setattr(recommend, "BUNDLE_USERS", 5)
    rng = np.random.default_rng(12)
    users = {n: np.abs(rng.normal(size=4)) for n in range(200)}
    items = {n: np.abs(rng.normal(size=4)) * (3 if n < 12 else 0.3) for n in range(60)}
    fitted, visits = factor_model(spark, users, items), Observation()
    got = as_lists(recommend.recommend_topk(fitted, 3, chunk_items=6, visits=visits))
    assert {u: [i for i, _ in f] for u, f in got.items()} == {u: [i for i, _ in f] for u, f in brute_force(users, items, 3).items()}
    assert visits.get["met"] <= visits.get["pairs"] / 2


def test_tasks_grow_with_users(spark, monkeypatch):
    """At a fixed number of blocks; each task gets one block and one group of users."""
    monkeypatch.setattr(recommend, "MOST_SCORES_PER_TASK", 400)
    monkeypatch.setattr(recommend, "SCORES_PER_TASK", 400)
    monkeypatch.setattr(recommend, "BUNDLE_USERS", 10)
    rng = np.random.default_rng(13)
    items = factor_model(spark, {0: [1.0, 1.0]}, {n: rng.normal(size=2) for n in range(40)}).item_factors
    cut = recommend._by_length(items.withColumnRenamed("id", "item"), 4)
    tasks = []
    for many in (100, 400, 1600):
        left = spark.range(many).selectExpr(
            "cast(id as int) user", "array(1D, 1D) features", "array(1) seen", "0D bar", "3 reach"
        )
        pairs = recommend._pairs(left, many, [1, 2, 3])
        met = recommend._meet(pairs, cut.where("block > 0"), many, 10, 3)
        tasks.append(met.rdd.getNumPartitions())
        assert met.select(F.sum(F.size("users"))).first()[0] == 3 * many
    assert tasks[0] < tasks[1] < tasks[2] and tasks[2] >= 3 * 1600 * 10 / 400


def test_unknown_area_keeps_its_place(spark):
    fitted = factor_model(spark, {1: [1.0]}, {0: [3.0], 1: [2.0], 2: [1.0]})
    areas = spark.createDataFrame([("A", 0), ("C", 2)], "neighbourhood string, neighbourhood_id bigint")
    people = spark.createDataFrame([(50_000_000_000, "Ann")], "reviewer_id bigint, reviewer_name string")
    ids = spark.createDataFrame([(50_000_000_000, 1)], "reviewer_id bigint, user bigint")
    best = recommend.recommend_topk(fitted, 5)
    named = recommend.attach_names(best, areas, people, ids, "2019-07-01")
    assert rows(named) == [(50_000_000_000, "Ann", ["A", "empty", "C"], "2019-07-01")]
    assert named.dtypes == [
        ("reviewerId", "bigint"),
        ("reviewerName", "string"),
        ("neighbourhoodNames", "array<string>"),
        ("date", "string"),
    ]
    assert rows(recommend.exploded(best)) == [(1, 1, 0, 3.0), (1, 2, 1, 2.0), (1, 3, 2, 1.0)]


def test_date_is_todays_when_not_given(spark):
    fitted = factor_model(spark, {1: [1.0]}, {0: [3.0]})
    areas = spark.createDataFrame([("A", 0)], "neighbourhood string, neighbourhood_id bigint")
    people = spark.createDataFrame([(1, "Ann")], "reviewer_id bigint, reviewer_name string")
    named = recommend.attach_names(recommend.recommend_topk(fitted, 1), areas, people)
    today = spark.sql("SELECT cast(current_date() AS string)").first()[0]
    assert named.first()["date"] == today


RESULT = "reviewerId bigint, reviewerName string, neighbourhoodNames array<string>, date string"


def test_sinks(spark, tmp_path):
    data = [(n, f"R{n}", ["A", "B"] if n else [], "2019-07-01") for n in range(25)]
    frame = spark.createDataFrame(data, RESULT)
    path = str(tmp_path / "result")
    sinks.write_result(frame, path)
    stored = sinks.write_result(frame, path)
    assert stored.count() == 25
    assert [row["reviewerId"] for row in sinks.preview(stored).collect()] == list(range(10))
    flat = dict(rows(sinks.jdbc_rows(stored).select("reviewerId", "neighbourhoodNames")))
    assert flat[0] == "" and flat[3] == "A|B"
    metrics = spark.createDataFrame([("train", 0.5)], "sample string, mse double")
    sinks.write_metrics(metrics, str(tmp_path / "metrics"))
    sinks.write_metrics(metrics, str(tmp_path / "metrics"))
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 2


def test_a_failing_job_leaves_the_result_that_was_there(spark, tmp_path):
    path = str(tmp_path / "result")
    first = spark.createDataFrame([(n, f"R{n}", ["A"], "2019-07-01") for n in range(5)], RESULT)
    sinks.write_result(first, path)
    broken = first.withColumn("reviewerName", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_result(broken, path)
    assert rows(spark.read.parquet(path)) == rows(first)
    assert [p.name for p in tmp_path.iterdir()] == ["result"]
    # A result may be made from the one that it replaces.
    sinks.write_result(sinks.read_result(spark, path).where("reviewerId > 2"), path)
    assert spark.read.parquet(path).count() == 2


def test_a_run_that_ends_between_the_renames(spark, tmp_path):
    path = str(tmp_path / "result")
    first = spark.createDataFrame([(1, "R", ["A"], "2019-07-01")], RESULT)
    sinks.write_result(first, path)
    (tmp_path / "result").rename(tmp_path / ".result.old")
    assert rows(sinks.read_result(spark, path)) == rows(first)
    (tmp_path / "result").rename(tmp_path / ".result.old")
    sinks.write_result(first.limit(0), path)
    assert spark.read.parquet(path).count() == 0 and [p.name for p in tmp_path.iterdir()] == ["result"]


def test_metrics_once_per_run(spark, tmp_path):
    path = str(tmp_path / "metrics")
    kind = "sample string, mse double, run_id string"
    for mse in (0.5, 0.25):
        sinks.write_metrics(spark.createDataFrame([("train", mse, "007"), ("holdout", 2 * mse, "007")], kind), path)
    sinks.write_metrics(spark.createDataFrame([("train", 0.75, "008"), ("train", 1.0, None)], kind), path)
    sinks.write_metrics(spark.createDataFrame([("train", 1.0, None)], kind), path)
    got = rows(sinks.read_metrics(spark, path).select("run_id", "sample", "mse"))
    one = ("train", 1.0)
    assert got == sorted([("007", "train", 0.25), ("007", "holdout", 0.5), ("008", "train", 0.75), (None, *one), (None, *one)], key=str)


def test_one_pass_however_many_blocks(spark):
    """More blocks of items are more rows to join, not more jobs."""
    rng = np.random.default_rng(4)
    users, items = ({n: rng.normal(size=3) for n in range(many)} for many in (50, 40))
    fitted = factor_model(spark, users, items)
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for n, chunk in enumerate((20, 4, 1)):
        spark.sparkContext.setJobGroup(f"blocks-{n}", "blocks")
        recommend.recommend_topk(fitted, 5, chunk_items=chunk).collect()
        jobs.append(len(tracker.getJobIdsForGroup(f"blocks-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(jobs) <= min(jobs) + 2
