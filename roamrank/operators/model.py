"""Training, storing, loading and evaluating the factor model."""

from __future__ import annotations

import datetime
import json
import math
from dataclasses import asdict, dataclass, replace

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamrank import store
from roamrank.functions.expressions import dot, run_date
from roamrank.operators.joins import lookup_join
from roamrank.operators.normal_equations import fit_by_sums
from roamrank.workspace import file_system, shared_dir, sized

# Ratings that one block of MLlib's ALS should hold, if that is the solver asked for.
RATINGS_PER_BLOCK = 1_000_000
MIN_BLOCKS = 10
# Where MLlib's RDD-based matrix factorization stores a model, and as what.
RDD_METADATA, RDD_USERS, RDD_PRODUCTS = "metadata", "data/user", "data/product"
RDD_CLASS = "org.apache.spark.mllib.recommendation.MatrixFactorizationModel"
RDD_VERSION = "1.0"


@dataclass(frozen=True)
class AlsConfig:
    """Explicit-feedback ALS; the ridge term is ``reg`` times an id's ratings.

    ``solver`` is "sums", which trains the same way at every size, or "mllib", Spark's
    own, which keeps all ratings of an id in one task and starts from random factors.
    """

    seed: int
    # The defaults of rank, iterations and reg.
    rank: int = 10
    iterations: int = 3
    reg: float = 0.01
    solver: str = "sums"


@dataclass(frozen=True)
class FactorModel:
    """User and item factors as DataFrames (id int, features array)."""

    rank: int
    user_factors: DataFrame
    item_factors: DataFrame
    solver: str = "sums"

    @classmethod
    def from_mllib(cls, model: ALSModel) -> FactorModel:
        return cls(model.rank, model.userFactors, model.itemFactors, "mllib")

    def save(self, path: str) -> None:
        """Replace what is stored at ``path``, on any file system Spark writes to."""
        spark = self.user_factors.sparkSession
        version = store.new_version(path)
        store.lease(spark, version)
        try:
            self.write_to(version)
            store.point(spark, path, version)
        finally:
            store.release(spark, version)

    def write_to(self, folder: str) -> None:
        """Write to a folder that isn't there yet."""
        self.user_factors.write.parquet(f"{folder}/user_factors")
        self.item_factors.write.parquet(f"{folder}/item_factors")
        spark = self.user_factors.sparkSession
        about = spark.createDataFrame([(self.rank, self.solver)], "rank int, solver string")
        about.coalesce(1).write.parquet(f"{folder}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FactorModel:
        """A model that ``save`` or ``publish`` stored, or MLlib's trainer of RDDs."""
        version = store.current(spark, path, must=False)
        if version is not None:
            return cls.read_from(spark, version)
        place, system = file_system(spark, f"{path}/{RDD_METADATA}")
        if system.exists(place):
            return cls.from_rdd_layout(spark, path)
        raise FileNotFoundError(f"no model at {path}")

    @classmethod
    def from_rdd_layout(cls, spark: SparkSession, path: str) -> FactorModel:
        """The factors of a model as MLlib's RDD-based matrix factorization stores it.

        A line of JSON tells its class, the layout's version and the rank; users and
        products are Parquet tables of (id, features).
        """
        first = spark.read.text(f"{path}/{RDD_METADATA}").first()
        about = json.loads(first["value"]) if first else {}
        if (about.get("class"), about.get("version")) != (RDD_CLASS, RDD_VERSION):
            raise ValueError(f"{path} holds {about.get('class')!r}, version {about.get('version')!r}")
        rank = int(about["rank"])
        sides = []
        for name in (RDD_USERS, RDD_PRODUCTS):
            rows = spark.read.parquet(f"{path}/{name}")
            sides.append(rows.select(F.col("id").cast("int").alias("id"), F.col("features").cast("array<double>").alias("features")))
            if not sides[-1].where(F.size("features") != rank).isEmpty():
                raise ValueError(f"{path}/{name} has vectors that aren't of rank {rank}")
        return cls(rank, *sides, "mllib_rdd")

    @classmethod
    def read_from(cls, spark: SparkSession, folder: str) -> FactorModel:
        about = spark.read.schema("rank int, solver string").parquet(f"{folder}/about").first()
        # Said here, because to look a schema up takes a job.
        kind = f"id int, features array<{'float' if about['solver'] == 'mllib' else 'double'}>"
        sides = [spark.read.schema(kind).parquet(f"{folder}/{side}_factors") for side in ("user", "item")]
        return cls(about["rank"], *sides, about["solver"])


def fit_mllib(ratings: DataFrame, config: AlsConfig) -> ALSModel:
    """MLlib's ALS; sets the context's checkpoint folder, where it cuts its lineage, if there is none."""
    context = ratings.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(ratings.sparkSession))
    blocks = max(MIN_BLOCKS, math.ceil(ratings.count() / RATINGS_PER_BLOCK))
    als = ALS(
        rank=config.rank,
        maxIter=config.iterations,
        regParam=config.reg,
        seed=config.seed,
        numUserBlocks=blocks,
        numItemBlocks=min(blocks, MIN_BLOCKS),
        coldStartStrategy="drop",
        userCol="user",
        itemCol="item",
        ratingCol="rating",
    )
    return als.fit(ratings)


def train(ratings: DataFrame, config: AlsConfig) -> FactorModel:
    """Fit (user, item, rating). Pass a stored table: it is read several times."""
    if config.solver not in ("sums", "mllib"):
        raise ValueError(f"unknown solver {config.solver!r}")
    if ratings.isEmpty():
        raise ValueError("no ratings to train on")
    if config.solver == "mllib":
        return FactorModel.from_mllib(fit_mllib(ratings, config))
    [(users, items)] = fit_by_sums(ratings, config.rank, config.iterations, config.reg, config.seed)
    return FactorModel(config.rank, users, items, config.solver)


def train_with_holdout(ratings: DataFrame, config: AlsConfig, kept: Column) -> tuple[FactorModel, FactorModel]:
    """The model of all ratings, and the one of those where ``kept`` is true, in the same passes.

    MLlib's solver can't do that and trains twice.
    """
    if config.solver != "sums":
        return train(ratings, config), train(ratings.where(kept), config)
    if ratings.where(kept).isEmpty():
        raise ValueError("no ratings to train on")
    both = fit_by_sums(ratings, config.rank, config.iterations, config.reg, config.seed, kept)
    whole, part = (FactorModel(config.rank, users, items, config.solver) for users, items in both)
    return whole, part


def predict(model: FactorModel, pairs: DataFrame) -> DataFrame:
    """Append ``prediction``; pairs with an unknown user or item are left out."""
    users = model.user_factors.select(F.col("id").alias("user"), F.col("features").alias("_user"))
    items = model.item_factors.select(F.col("id").alias("item"), F.col("features").alias("_item"))
    users = sized(users, at_most=model.user_factors)
    items = sized(items, at_most=model.item_factors)
    known = lookup_join(lookup_join(pairs, items, "item"), users, "user")
    score = dot(F.col("_user"), F.col("_item"), model.rank)
    return known.withColumn("prediction", score).drop("_user", "_item")


def mean_squared_error(predicted: DataFrame) -> DataFrame:
    """One row: ``mse`` and the number ``n`` of pairs behind it."""
    error = F.col("rating") - F.col("prediction")
    return predicted.agg(F.avg(error * error).alias("mse"), F.count("*").alias("n"))


def evaluate(
    model: FactorModel,
    ratings: DataFrame,
    config: AlsConfig,
    sample: str,
    run_id: str | None = None,
    as_of: datetime.date | str | None = None,
) -> DataFrame:
    """The metric as a row of the metrics table, with the parameters and the run behind it."""
    metrics = mean_squared_error(predict(model, ratings))
    used = replace(config, solver=model.solver)
    settings = [F.lit(value).alias(name) for name, value in asdict(used).items()]
    run = [F.lit(run_id).cast("string").alias("run_id"), run_date(as_of).alias("date")]
    return metrics.select(F.lit(sample).alias("sample"), "mse", "n", *settings, *run)
