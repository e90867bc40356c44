"""Training, prediction, evaluation, storage."""

import numpy as np
import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from roamrank import store
from roamrank.functions.expressions import start_factors
from roamrank.operators import joins, model, normal_equations, ratings
from roamrank.operators.model import AlsConfig, FactorModel
from tests.conftest import rows

RATED = "user int, item int, rating double"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Ratings of rank 2 with a little noise, 70% of them observed."""
    rng = np.random.default_rng(7)
    left, right = rng.normal(size=(300, 2)), rng.normal(size=(40, 2))
    noisy = left @ right.T + rng.normal(scale=0.05, size=(300, 40))
    seen = rng.random(noisy.shape) < 0.7
    data = [(int(u), int(i), float(noisy[u, i])) for u, i in np.argwhere(seen)]
    path = str(tmp_path_factory.mktemp("planted") / "rated")
    spark.createDataFrame(data, RATED).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("solver", ["mllib", "sums"])
def test_recovers_planted_structure(planted, solver):
    fit_on, held = ratings.holdout_split(planted, seed=3)
    config = AlsConfig(seed=42, rank=2, iterations=15, solver=solver)
    row = model.evaluate(model.train(fit_on, config), held, config, "holdout").first()
    assert row["n"] == held.count() and row["mse"] < 0.02
    assert held.agg(F.var_pop("rating")).first()[0] > 0.5


@pytest.mark.parametrize("solver", ["mllib", "sums"])
def test_factors_solve_their_normal_equations(planted, solver):
    config = AlsConfig(seed=42, solver=solver)
    fitted = model.train(planted, config)
    sums = normal_equations.normal_equations(planted, fitted.item_factors, "user", config.rank)
    off = normal_equations.residuals(sums, fitted.user_factors, config.rank, config.reg)
    assert off.count() == 300
    assert off.agg(F.max("residual")).first()[0] < (1e-4 if solver == "mllib" else 1e-9)
    plain = normal_equations.residuals(
        sums.withColumn("n", F.lit(1)), fitted.user_factors, config.rank, config.reg
    )
    assert plain.agg(F.max("residual")).first()[0] > 1e-3


def test_sums_solver_against_numpy(spark, planted):
    config = AlsConfig(seed=5, rank=3, iterations=2, solver="sums")
    fitted = model.train(planted, config)
    data = planted.toPandas()
    start = (
        planted.select("user").distinct().orderBy("user")
        .select(start_factors(F.col("user"), 3, 5).alias("f")).toPandas()
    )
    users = np.stack(start["f"].to_numpy())
    assert np.allclose(np.linalg.norm(users, axis=1), 1) and (users > 0).all()

    def half_step(ids, others, factors, count):
        out = np.zeros((count, 3))
        for one in range(count):
            q, r = factors[others[ids == one]], data["rating"].to_numpy()[ids == one]
            out[one] = np.linalg.solve(q.T @ q + 0.01 * len(q) * np.eye(3), q.T @ r)
        return out

    u, i = data["user"].to_numpy(), data["item"].to_numpy()
    for _ in range(2):
        items = half_step(i, u, users, 40)
        users = half_step(u, i, items, 300)
    got = {row["id"]: row["features"] for row in fitted.user_factors.collect()}
    assert np.allclose([got[n] for n in range(300)], users, atol=1e-8)


def test_lists_in_parts_and_many_items_train_the_same_model(planted, monkeypatch):
    config = AlsConfig(seed=1, rank=3, iterations=2)

    def factors():
        fitted = model.train(planted, config)
        sides = fitted.user_factors, fitted.item_factors
        return [{r["id"]: r["features"] for r in side.collect()} for side in sides]

    plain = factors()
    monkeypatch.setattr(normal_equations, "RATINGS_PER_LIST", 10)
    monkeypatch.setattr(normal_equations, "NUMBERS_AT_ONCE", 300)
    monkeypatch.setattr(normal_equations, "NUMBERS_KEPT", 200)
    in_parts = factors()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    joined = factors()
    for other in (in_parts, joined):
        for mine, theirs in zip(plain, other):
            assert mine.keys() == theirs.keys()
            assert all(np.allclose(mine[n], theirs[n], atol=1e-9) for n in mine)


@pytest.mark.parametrize("way", ["beside", "parts", "buckets"])
def test_holdout_model_in_the_same_passes(planted, monkeypatch, way):
    """Both models are those that two fits give, cold ids included."""
    config = AlsConfig(seed=6, rank=3, iterations=2)
    # One user and one item have no rating kept, and few of the others' are.
    kept = (F.col("user") != 5) & (F.col("item") != 7) & ratings.kept_to_fit(30, 6)
    alone = model.train(planted, config), model.train(planted.where(kept), config)
    if way != "beside":
        monkeypatch.setattr(normal_equations, "RATINGS_PER_LIST", 10)
    if way == "buckets":
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    both = model.train_with_holdout(planted, config, kept)
    for one, other in zip(alone, both):
        for mine, theirs in ((one.user_factors, other.user_factors), (one.item_factors, other.item_factors)):
            mine, theirs = ({r["id"]: r["features"] for r in side.collect()} for side in (mine, theirs))
            assert mine.keys() == theirs.keys()
            assert all(np.allclose(mine[n], theirs[n], atol=1e-8) for n in mine)
    assert 5 not in {r["id"] for r in both[1].user_factors.collect()}
    assert 7 not in {r["id"] for r in both[1].item_factors.collect()}


def test_a_round_writes_factors_and_no_ratings(spark, planted, tmp_path, monkeypatch):
    """What further rounds write is as many numbers as there are ids, however many ratings there are."""
    wrote = {}
    for name in ("write_table",):
        plain = getattr(normal_equations, name)

        def counted(df, label, plain=plain):
            stored = plain(df, label)
            wrote[label] = wrote.get(label, 0) + sum(
                stored.agg(F.sum(F.size(f.name) if f.dataType.typeName() == "array" else F.lit(1))).first()[0] or 0
                for f in stored.schema.fields
            )
            return stored

        monkeypatch.setattr(normal_equations, name, counted)
    totals = []
    for rounds in (1, 4):
        wrote.clear()
        model.train(planted, AlsConfig(seed=6, rank=3, iterations=rounds))
        totals.append(dict(wrote))
    assert totals[0]["rating-lists"] == totals[1]["rating-lists"] > planted.count()
    # The first step's and the last's; those between go from the driver to the tasks.
    assert totals[1]["item-factors"] == 2 * totals[0]["item-factors"] == 2 * 40 * 4
    assert totals[0]["user-factors"] == totals[1]["user-factors"] == 300 * 4


def test_lists_meet_factors_in_their_buckets_without_a_shuffle(spark, planted, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    plans = []
    meet = normal_equations.met_in_buckets

    def noted(*args):
        met = meet(*args)
        plans.append(met._jdf.queryExecution().executedPlan().toString())
        return met

    monkeypatch.setattr(normal_equations, "met_in_buckets", noted)
    try:
        model.train(planted, AlsConfig(seed=6, rank=2, iterations=2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 3 and all("Join" in p and "Exchange" not in p for p in plans)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("roamrank_")]


def test_same_seed_same_model(planted):
    config = AlsConfig(seed=9)
    once, again = (model.train(planted.repartition(n), config) for n in (2, 7))
    for a, b in ((once.user_factors, again.user_factors), (once.item_factors, again.item_factors)):
        b = {row["id"]: row["features"] for row in b.collect()}
        assert all(np.allclose(row["features"], b[row["id"]], atol=1e-9) for row in a.collect())


def test_prediction_agrees_with_mllib(planted):
    fitted = model.fit_mllib(planted, AlsConfig(seed=3))
    ours = model.predict(FactorModel.from_mllib(fitted), planted)
    theirs = fitted.transform(planted).withColumnRenamed("prediction", "theirs")
    gap = ours.join(theirs, ["user", "item"]).agg(
        F.max(F.abs(F.col("prediction") - F.col("theirs"))), F.count("*")
    )
    largest, pairs = gap.first()
    assert pairs == planted.count() and largest < 1e-5


def test_cold_pairs_are_left_out(spark, planted):
    config = AlsConfig(seed=3, rank=2)
    fitted = model.train(planted, config)
    pairs = spark.createDataFrame([(0, 0, 1.0), (9999, 0, 1.0), (0, 9999, 1.0)], RATED)
    assert rows(model.predict(fitted, pairs).select("user", "item")) == [(0, 0)]
    assert model.evaluate(fitted, pairs, config, "new").first()["n"] == 1


def test_saved_twice_and_loaded(spark, planted, tmp_path):
    fitted = model.train(planted, AlsConfig(seed=3))
    path = str(tmp_path / "model")
    model.train(planted, AlsConfig(seed=4, rank=2)).save(path)
    fitted.save(path)
    loaded = FactorModel.load(spark, path)
    assert loaded.rank == 10
    assert rows(loaded.user_factors) == rows(fitted.user_factors)
    assert rows(loaded.item_factors) == rows(fitted.item_factors)


def test_model_from_mllib_directory(spark, planted, tmp_path):
    fitted = model.fit_mllib(planted, AlsConfig(seed=3))
    fitted.write().overwrite().save(str(tmp_path / "mllib"))
    loaded = FactorModel.from_mllib(ALSModel.load(str(tmp_path / "mllib")))
    assert loaded.rank == 10 and rows(loaded.user_factors) == rows(fitted.userFactors)


def test_no_ratings(spark):
    with pytest.raises(ValueError, match="no ratings"):
        model.train(spark.createDataFrame([], RATED), AlsConfig(seed=1))


def test_unknown_solver(planted):
    with pytest.raises(ValueError, match="unknown solver"):
        model.train(planted, AlsConfig(seed=1, solver="other"))



def test_model_of_the_rdd_trainers_layout(spark, tmp_path):
    (tmp_path / "metadata").mkdir()
    about = '{"class":"org.apache.spark.mllib.recommendation.MatrixFactorizationModel","version":"1.0","rank":2}'
    (tmp_path / "metadata" / "part-00000").write_text(about + "\n")
    kind = "id int, features array<double>"
    spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, 0.0])], kind).write.parquet(str(tmp_path / "data" / "user"))
    spark.createDataFrame([(7, [3.0, 1.0])], kind).write.parquet(str(tmp_path / "data" / "product"))
    loaded = FactorModel.load(spark, str(tmp_path))
    assert loaded.rank == 2
    pairs = spark.createDataFrame([(1, 7, 1.0), (2, 7, 1.0), (3, 7, 1.0)], RATED)
    assert rows(model.predict(loaded, pairs).select("user", "prediction")) == [(1, 5.0), (2, 1.5)]
    loaded.save(str(tmp_path / "again"))
    assert rows(FactorModel.load(spark, str(tmp_path / "again")).user_factors) == rows(loaded.user_factors)
    for wrong in (about.replace('"1.0"', '"9.9"'), about.replace('"rank":2', '"rank":3'), "{}"):
        (tmp_path / "metadata" / "part-00000").write_text(wrong)
        (tmp_path / "metadata" / ".part-00000.crc").unlink(missing_ok=True)
        with pytest.raises(ValueError):
            FactorModel.load(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        FactorModel.load(spark, str(tmp_path / "nothing"))


def test_runs_at_once_on_one_model_path(spark, planted, tmp_path, monkeypatch):
    """A run keeps its tables while it writes, and one that began earlier doesn't go before a later one."""
    path = str(tmp_path / "model")
    fitted = model.train(planted, AlsConfig(seed=3, rank=2))
    slow = store.new_version(path)
    store.lease(spark, slow)
    fitted.user_factors.write.parquet(f"{slow}/user_factors")
    for _ in range(3):
        fitted.save(path)
    newest = store.current(spark, path)
    assert len(spark.read.parquet(f"{slow}/user_factors").columns) == 2
    fitted.item_factors.write.parquet(f"{slow}/item_factors")
    assert not store.point(spark, path, slow)
    assert store.current(spark, path) == newest
    assert spark.read.parquet(f"{slow}/item_factors").count() == 40
    store.release(spark, slow)
    fitted.save(path)
    left = {p.name for p in (tmp_path / "model").iterdir() if p.is_dir()}
    assert slow.rpartition("/")[2] not in left and len(left) == 2
    # A lease that nobody gave back runs out.
    dead = store.new_version(path)
    store.lease(spark, dead)
    fitted.user_factors.write.parquet(f"{dead}/user_factors")
    monkeypatch.setattr(store, "LEASE_SECONDS", 0)
    fitted.save(path)
    fitted.save(path)
    assert dead.rpartition("/")[2] not in {p.name for p in (tmp_path / "model").iterdir()}
    assert not [p for p in (tmp_path / "model").iterdir() if p.name.startswith((".lease", ".lock"))]


def test_a_lock_of_a_run_that_died(spark, tmp_path):
    path = str(tmp_path / "model")
    place, system = store._lock(spark, path)
    again, _ = store._lock(spark, path, wait=0.3)
    assert system.exists(again)
