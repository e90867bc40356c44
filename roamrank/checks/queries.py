"""Every operator as a query over the whole given tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roamrank.checks import tables
from roamrank import sinks
from roamrank.operators import dims, model, normal_equations, ratings, recommend, visits
from roamrank.operators.model import AlsConfig, FactorModel
from roamrank.functions.expressions import run_date
from roamrank.plans.pipeline import Outputs, publish
from roamrank.plans.pipeline import record_balance as balance
from roamrank.sources import csv, schemas
from roamrank.workspace import new_path, write_table

SEED = 42
K = 5
AS_OF = "2019-07-01"
# The default configuration: rank 10, three rounds, ridge 0.01.
FULL = AlsConfig(SEED)
# Rank 2 has a closed form, so plain SQL can train the same model.
EXACT = AlsConfig(SEED, rank=2, solver="sums")
# Rank 1 run to convergence: the order of areas depends on no start values.
CONVERGED = AlsConfig(SEED, rank=1, iterations=25, solver="mllib")


def scan_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv.scan_listings(tables.listings(spark, sf_dir))


def scan_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.date_text(csv.scan_reviews(tables.reviews(spark, sf_dir)))


def area_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.area_dim(tables.areas(spark, sf_dir))


def _review_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews in the raw file's columns; comments hold commas, quotes and breaks."""
    comments = F.concat(
        F.lit('Line "'), "l_returnflag", F.lit('", first\nand '), "l_linestatus", F.lit(" second")
    )
    return tables.order_lines(spark, sf_dir).select(
        F.col("l_suppkey").alias("listing_id"),
        F.col("l_orderkey").alias("id"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("c_custkey").alias("reviewer_id"),
        F.col("c_name").alias("reviewer_name"),
        comments.alias("comments"),
        "l_returnflag",
        "l_linestatus",
    )


def _land(spark: SparkSession, records: DataFrame, schema: StructType = schemas.REVIEWS) -> csv.Landed:
    path = new_path(spark, "csv")
    records.write.option("header", True).option("escape", '"').csv(path)
    return csv.land_csv(spark, path, schema)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _review_records(spark, sf_dir).drop("l_returnflag", "l_linestatus")
    return tables.date_text(_land(spark, records).good)


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines get a text where the id belongs."""
    records = _review_records(spark, sf_dir)
    returned = F.col("l_returnflag") == "R"
    broken = records.withColumn("id", F.when(returned, "returned").otherwise(F.col("id").cast("string")))
    landed = _land(spark, broken.drop("l_returnflag", "l_linestatus"))
    good = landed.good.withColumn("quarantined", F.lit(False))
    bad = landed.quarantined.drop(csv.CORRUPT).withColumn("quarantined", F.lit(True))
    return tables.date_text(good.union(bad).fillna(-1, ["id"]))


def listing_area_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.listing_area(spark, sf_dir)


def visits_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.date_text(tables.visits(spark, sf_dir))


def unmatched_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings outside the areas of four of the five regions."""
    known = tables.areas(spark, sf_dir).where(F.col("neighbourhood_group") != "ASIA")
    return visits.unmatched_listings(tables.listings(spark, sf_dir), known)


def unmatched_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of suppliers in debt, when only the others are listed."""
    solvent = tables.read(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
    left_out = visits.unmatched_reviews(
        solvent.select(F.col("s_suppkey").alias("id")),
        tables.reviews(spark, sf_dir),
        frequencies=tables.listing_frequencies(spark, sf_dir),
    )
    return tables.date_text(left_out.select("listing_id", "date", "reviewer_id", "reviewer_name"))


def visit_counts_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.visit_counts_named(tables.visits(spark, sf_dir))


def ratings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.ratings(spark, sf_dir)


def reviewer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.reviewer_dim(tables.reviews(spark, sf_dir))


def dense_reviewer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered in parallel, by name, whatever the number of reviewers."""
    customers = tables.read(spark, sf_dir, "customer")
    return dims.dense_id(customers, "c_name", "id", single_task_keys=0)


def trainer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewer ids above an int's range train under dense ids."""
    counted = write_table(tables.ratings(spark, sf_dir), "ratings")
    moved = counted.withColumn("reviewer_id", F.col("reviewer_id") + 5_000_000_000)
    return _wide(ratings.to_trainer(moved).ratings)


def _wide(rated: DataFrame) -> DataFrame:
    """Trainer ids as bigint, as SQL has them."""
    return rated.withColumn("user", F.col("user").cast("bigint")).withColumn(
        "item", F.col("item").cast("bigint")
    )


def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = ratings.holdout_split(tables.trainer_ratings(spark, sf_dir), seed=SEED)
    return _wide(train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test"))))


def evaluate_user_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric for the plainest predictor: a person's mean rating."""
    rated = tables.trainer_ratings(spark, sf_dir)
    means = rated.groupBy("user").agg(F.avg("rating").alias("prediction"))
    return model.mean_squared_error(rated.join(means, "user")).select(
        F.round("mse", 6).alias("mse"), "n"
    )


def _exact_model(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FactorModel]:
    rated = tables.trainer_ratings(spark, sf_dir)
    return rated, model.train(rated, EXACT)


def als_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fitted = _exact_model(spark, sf_dir)
    sides = [("user", fitted.user_factors), ("item", fitted.item_factors)]
    rows = [
        factors.select(
            F.lit(side).alias("side"),
            F.col("id").cast("bigint").alias("id"),
            F.round(F.col("features")[0], 4).alias("f0"),
            F.round(F.col("features")[1], 4).alias("f1"),
        )
        for side, factors in sides
    ]
    return rows[0].union(rows[1])


def predict_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated, fitted = _exact_model(spark, sf_dir)
    return _wide(model.predict(fitted, rated)).withColumn("prediction", F.round("prediction", 4))


def evaluate_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated, fitted = _exact_model(spark, sf_dir)
    return model.evaluate(fitted, rated, EXACT, "train").select(
        "sample", F.round("mse", 6).alias("mse"), "n", "rank", "iterations", "reg"
    )


def evaluate_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit_on, held = ratings.holdout_split(tables.trainer_ratings(spark, sf_dir), seed=SEED)
    fitted = model.train(fit_on, EXACT)
    return model.evaluate(fitted, held, EXACT, "holdout").select(
        "sample", F.round("mse", 6).alias("mse"), "n"
    )


def recommend_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fitted = _exact_model(spark, sf_dir)
    return _ranked(recommend.recommend_topk(fitted, K))


def recommend_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated, fitted = _exact_model(spark, sf_dir)
    return _ranked(recommend.recommend_topk(fitted, K, seen=rated))


def recommend_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way for more items than one broadcast may hold."""
    rated, fitted = _exact_model(spark, sf_dir)
    return _ranked(recommend.recommend_topk(fitted, K, seen=rated, chunk_items=10))


def _ranked(recommended: DataFrame) -> DataFrame:
    return recommend.exploded(recommended).select(
        F.col("user").cast("bigint").alias("reviewer_id"),
        F.col("rank").cast("bigint").alias("rk"),
        F.col("item").cast("bigint").alias("neighbourhood_id"),
    )


def topk_bruteforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector against the mean vector of each label, by inner product."""
    vectors = tables.read(spark, sf_dir, "embeddings")
    rank = 64
    means = vectors.groupBy("label").agg(
        *[F.avg(F.col("embedding")[i].cast("double")).alias(f"m{i}") for i in range(rank)]
    )
    fitted = FactorModel(
        rank,
        vectors.select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features")),
        means.select(F.col("label").alias("id"), F.array(*[f"m{i}" for i in range(rank)]).alias("features")),
    )
    return recommend.exploded(recommend.recommend_topk(fitted, K)).select(
        F.col("user").cast("bigint").alias("vec_id"),
        F.col("rank").cast("bigint").alias("rk"),
        F.col("item").cast("bigint").alias("label"),
    )


def _converged_model(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FactorModel]:
    rated = tables.trainer_ratings(spark, sf_dir)
    return rated, model.train(rated, CONVERGED)


def als_rank1_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas from the heaviest down; weights themselves have no fixed sign or length."""
    _, fitted = _converged_model(spark, sf_dir)
    below = (-F.abs(F.col("features")[0])).alias("below")
    weights = write_table(fitted.item_factors.select("id", below), "weights")
    return weights.join(dims.dense_id(weights, "below", "rk"), "below").select(
        F.col("id").cast("bigint").alias("neighbourhood_id"), (F.col("rk") + 1).alias("rk")
    )


def recommend_rank1(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fitted = _converged_model(spark, sf_dir)
    return _ranked(recommend.recommend_topk(fitted, K))


def recommend_novel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated, fitted = _converged_model(spark, sf_dir)
    return _ranked(recommend.recommend_topk(fitted, K, seen=rated))


def recommend_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for rank-1 recommendations, with the areas of one region unknown."""
    _, fitted = _converged_model(spark, sf_dir)
    dim = dims.area_dim(tables.areas(spark, sf_dir))
    known = dim.join(
        tables.areas(spark, sf_dir).where(F.col("neighbourhood_group") != "ASIA"), "neighbourhood"
    ).select("neighbourhood", "neighbourhood_id")
    reviewers = dims.reviewer_dim(tables.reviews(spark, sf_dir))
    best = recommend.recommend_topk(fitted, K)
    return sinks.jdbc_rows(recommend.attach_names(best, known, reviewers, as_of=AS_OF))


def recommend_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best areas at the default configuration."""
    rated = tables.trainer_ratings(spark, sf_dir)
    return _ranked(recommend.recommend_topk(model.train(rated, FULL), K))


def _published(spark: SparkSession, sf_dir: str, config: AlsConfig, **options) -> DataFrame:
    outputs = Outputs(new_path(spark, "model"), new_path(spark, "result"))
    published = publish(
        write_table(tables.reviews(spark, sf_dir), "reviews"),
        tables.listings(spark, sf_dir),
        tables.areas(spark, sf_dir),
        outputs,
        config,
        K,
        as_of=AS_OF,
        **options,
    )
    return published.recommendations


def publish_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, from reviews to the stored result."""
    return sinks.jdbc_rows(_published(spark, sf_dir, EXACT, holdout=False))


def publish_novel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job without places already visited."""
    return sinks.jdbc_rows(_published(spark, sf_dir, EXACT, exclude_seen=True, holdout=False))


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job at the default configuration, with both metrics."""
    return _published(spark, sf_dir, FULL)


def publish_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.jdbc_rows(recommendations(spark, sf_dir))


def jdbc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``write_jdbc`` sends; the database itself is the caller's."""
    _, fitted = _exact_model(spark, sf_dir)
    named = recommend.attach_names(
        recommend.recommend_topk(fitted, K),
        dims.area_dim(tables.areas(spark, sf_dir)),
        dims.reviewer_dim(tables.reviews(spark, sf_dir)),
        as_of=AS_OF,
    )
    return sinks.jdbc_rows(named, separator="|")


def sink_parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice to one path; the second run replaces the first."""
    named = reviewer_dim(spark, sf_dir)
    path = new_path(spark, "result")
    sinks.write_result(named, path)
    return sinks.write_result(named, path)


def preview_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _published(spark, sf_dir, EXACT, holdout=False)
    return sinks.jdbc_rows(sinks.preview(stored, 10))


def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to one metrics table."""
    rated = tables.trainer_ratings(spark, sf_dir)
    metrics = model.evaluate(model.train(rated, EXACT), rated, EXACT, "train")
    path = new_path(spark, "metrics")
    sinks.write_metrics(metrics, path)
    sinks.write_metrics(metrics, path)
    return spark.read.parquet(path).select("sample", F.round("mse", 6).alias("mse"), "n", "seed", "solver")


def metrics_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that writes its metric twice, and another run: a row for each run."""
    rated = tables.trainer_ratings(spark, sf_dir)
    fitted, path = model.train(rated, EXACT), new_path(spark, "metrics")
    for run in ("first", "first", "second"):
        sinks.write_metrics(model.evaluate(fitted, rated, EXACT, "train", run_id=run), path)
    return sinks.read_metrics(spark, path).select("run_id", "sample", F.round("mse", 6).alias("mse"), "n")


def predict_from_rdd_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs predicted with a model stored as MLlib's trainer of RDDs does it."""
    rated, fitted = _exact_model(spark, sf_dir)
    path = new_path(spark, "rdd-model")
    about = {"class": model.RDD_CLASS, "version": model.RDD_VERSION, "rank": fitted.rank}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/{model.RDD_METADATA}")
    fitted.user_factors.write.parquet(f"{path}/{model.RDD_USERS}")
    fitted.item_factors.write.parquet(f"{path}/{model.RDD_PRODUCTS}")
    loaded = FactorModel.load(spark, path)
    return _wide(model.predict(loaded, rated)).withColumn("prediction", F.round("prediction", 4))


def route_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each review goes when only suppliers out of debt are listed and some reviews lack a person."""
    solvent = tables.read(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
    listed = solvent.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("bigint").alias("neighbourhood_id"))
    lines = tables.order_lines(spark, sf_dir)
    person = F.when((F.col("l_linestatus") != "F") | (F.col("l_orderkey") % 5 != 0), F.col("c_custkey"))
    reviews = lines.select(F.col("l_suppkey").alias("listing_id"), "date", person.alias("reviewer_id"))
    routed = visits.route_reviews(listed, reviews, frequencies=tables.listing_frequencies(spark, sf_dir))
    stored = visits.store_routes(routed)
    return tables.date_text(stored.select("listing_id", "date", "reviewer_id", "neighbourhood_id", "route"))


def als_normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: MLlib's user factors solve their equations, ridge scaled by n."""
    rated = tables.trainer_ratings(spark, sf_dir)
    fitted = FactorModel.from_mllib(model.fit_mllib(rated, FULL))
    sums = normal_equations.normal_equations(rated, fitted.item_factors, "user", FULL.rank)
    off = normal_equations.residuals(sums, fitted.user_factors, FULL.rank, FULL.reg)
    return off.select(F.col("id").cast("bigint").alias("reviewer_id"), (F.col("residual") < 1e-4).alias("ok"))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: saved twice and loaded, every factor is the one fitted."""
    rated = tables.trainer_ratings(spark, sf_dir)
    fitted = model.train(rated, FULL)
    path = new_path(spark, "model")
    fitted.save(path)
    fitted.save(path)
    loaded = FactorModel.load(spark, path)
    sides = [
        ("user", fitted.user_factors, loaded.user_factors),
        ("item", fitted.item_factors, loaded.item_factors),
    ]
    rows = [
        before.withColumnRenamed("features", "before")
        .join(after, "id", "full")
        .select(
            F.lit(side).alias("side"),
            F.col("id").cast("bigint").alias("id"),
            F.col("before").eqNullSafe(F.col("features")).alias("ok"),
        )
        for side, before, after in sides
    ]
    return rows[0].union(rows[1])


def evaluate_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error on its own ratings at the default configuration."""
    rated = tables.trainer_ratings(spark, sf_dir)
    return model.evaluate(model.train(rated, FULL), rated, FULL, "train").select(
        "sample", F.round("mse", 6).alias("mse"), "n", "rank", "iterations"
    )


def _listing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in the columns of the listings' file; the quoted name has a line break."""
    known = {
        "id": F.col("s_suppkey"),
        "name": F.concat(F.lit('Flat "'), "s_name", F.lit('",\nsecond line')),
        "host_id": F.col("n_nationkey"),
        "host_name": F.col("s_name"),
        "neighbourhood": F.col("n_name"),
        "price": F.when(F.col("s_acctbal") < 0, 1).otherwise(2),
    }
    suppliers = tables.read(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    nations = tables.read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    columns = [
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.LISTINGS.fields
    ]
    return suppliers.join(nations, "n_nationkey").select(*columns, "s_acctbal")


def csv_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _listing_records(spark, sf_dir).drop("s_acctbal")
    return _land(spark, records, schemas.LISTINGS).good.select(
        "id", "host_name", "neighbourhood", (F.col("price") == 1).alias("in_debt"), "name"
    )


def csv_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = tables.areas(spark, sf_dir).select("neighbourhood_group", "neighbourhood")
    return _land(spark, records, schemas.AREAS).good.select("neighbourhood", "neighbourhood_group")


def record_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of which some are malformed or lack a person, listings of which some lack
    an id, and areas of which one region's lack a name: where each record went."""
    records = _review_records(spark, sf_dir)
    person = (F.col("l_linestatus") != "F") | (F.col("id") % 5 != 0)
    reviews = records.withColumn("reviewer_id", F.when(person, F.col("reviewer_id"))).withColumn(
        "id", F.when(F.col("l_returnflag") == "R", "returned").otherwise(F.col("id").cast("string"))
    )
    listings = _listing_records(spark, sf_dir).withColumn("id", F.when(F.col("s_acctbal") >= 0, F.col("id")))
    areas = tables.areas(spark, sf_dir).select(
        "neighbourhood_group", F.when(F.col("neighbourhood_group") != "ASIA", F.col("neighbourhood")).alias("neighbourhood")
    )
    return balance(
        _land(spark, reviews.drop("l_returnflag", "l_linestatus")),
        _land(spark, listings.drop("s_acctbal"), schemas.LISTINGS),
        _land(spark, areas, schemas.AREAS),
    )


def run_date_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date that a run gets if none is given."""
    dated = tables.read(spark, sf_dir, "nation").withColumn("date", run_date())
    return dated.groupBy("date").agg(F.count("*").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_listings": scan_listings,
    "scan_reviews": scan_reviews,
    "area_dim": area_dim,
    "csv_roundtrip": csv_roundtrip,
    "csv_quarantine": csv_quarantine,
    "listing_area_join": listing_area_join,
    "visits": visits_query,
    "unmatched_listings": unmatched_listings,
    "unmatched_reviews": unmatched_reviews,
    "visit_counts_named": visit_counts_named,
    "ratings": ratings_query,
    "reviewer_dim": reviewer_dim,
    "dense_reviewer_ids": dense_reviewer_ids,
    "trainer_ids": trainer_ids,
    "holdout_split": holdout_split,
    "evaluate_user_mean": evaluate_user_mean,
    "als_factors": als_factors,
    "predict_pairs": predict_pairs,
    "evaluate_mse": evaluate_mse,
    "evaluate_holdout": evaluate_holdout,
    "recommend_topk": recommend_topk,
    "recommend_unseen": recommend_unseen,
    "recommend_in_chunks": recommend_in_chunks,
    "topk_bruteforce": topk_bruteforce,
    "als_rank1_items": als_rank1_items,
    "recommend_rank1": recommend_rank1,
    "recommend_novel": recommend_novel,
    "recommend_named": recommend_named,
    "recommend_full": recommend_full,
    "publish_named": publish_named,
    "publish_novel": publish_novel,
    "publish_full": publish_full,
    "jdbc_rows": jdbc_rows,
    "sink_parquet_overwrite": sink_parquet_overwrite,
    "preview_recommendations": preview_recommendations,
    "metrics_table": metrics_table,
    "metrics_rerun": metrics_rerun,
    "predict_from_rdd_layout": predict_from_rdd_layout,
    "route_reviews": route_reviews,
    "als_normal_equations": als_normal_equations,
    "model_roundtrip": model_roundtrip,
    "evaluate_full": evaluate_full,
    "csv_listings": csv_listings,
    "csv_areas": csv_areas,
    "record_balance": record_balance,
    "run_date_today": run_date_today,
}
