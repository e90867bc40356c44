"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a slope. The weights share out the mix: a source gets at
most CAP times its own words, and what is cut off goes to the others by weight until
none is above. The slope tells how a source's weight runs over training: a density of
``1 + slope * (1 - 2t)`` at time t in [0, 1], so it starts strong or weak and ends the other
way. Its integral is the demand for the source's words up to t. A source's documents
stand in the order of a hash, once for each pass over it; the words before a copy, as
a share of the target, are put into the inverse of the integral, which is the copy's
training position. Sorting by position gives the training order.

The last copy within a target may be taken in part, so that every source has its target
to the word (``whole=False``), or goes in whole if at least half of it does, which is the
smaller error. The first document with words of a source with a target always goes in,
so none vanishes.

A word is a run of characters other than ASCII white space; null or empty text has
none, and such a document is taken with no words and no place. A null source is one
of its own, the last. Rows with equal ids and sizes are interchangeable, null ids
are ordered like an id of their own, and an empty table gives an empty mix. Columns of
the input stay; those that are added replace columns of the same name.

A source's order is cut into buckets of about BUCKET rows by the hash, and a word count
before a row is that before its bucket plus that within it, so a source with a third of
all rows is as many tasks as its rows ask for. Rows of an id that has more than BUCKET,
as null may, come last in their bucket and are parted by a hash of their texts, so only rows that repeat id and text stay together. Reruns part them alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roamrank.operators.joins import FAN_OUT, HotKeys, hot_keys, lookup_join
from roamrank.workspace import write_table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SLOPES = (0.5, 0.0, -0.5)
SHARE, CAP = 1.5, 2
BUCKET = 4_000
ADDED = ("size", "source_size", "target", "taken", "copies")


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def _hash(doc_id: Column) -> Column:
    """52 bits of the id's MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 13), 16, 10).cast("bigint")


def targets(sized: DataFrame, weights=WEIGHTS, slopes=SLOPES, share=SHARE, cap=CAP) -> DataFrame:
    """One row for each source: number in code-point order, size, rows, weight, slope and target.

    Sources in the order of size to weight reach their cap one after another; what the
    cap leaves to those after, by weight, is the level at which the first that stays
    below it and all later ones end. One row for each source passes one task.
    """
    own = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    own = own.withColumn("source_id", F.row_number().over(ordered) - 1)
    cycle = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("source_id") % len(values) + 1)
    own = own.withColumn("weight", cycle(weights)).withColumn("slope", cycle([float(x) for x in slopes]))
    limit = F.col("source_size") * cap
    full = Window.orderBy(limit / F.col("weight"), "source_id")
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(share)
    level = (total - F.coalesce(F.sum(limit).over(before), F.lit(0))) / F.sum("weight").over(after)
    own = own.withColumn("_level", level)
    below = limit / F.col("weight") >= F.col("_level")
    final = F.min_by("_level", F.when(below, F.struct(limit / F.col("weight"), "source_id"))).over(everything)
    reached = F.least(limit.cast("double"), F.coalesce(final, F.lit(float("inf"))) * F.col("weight"))
    return own.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(reached)).drop("_level")


def position(share: Column, slope: Column) -> Column:
    """The time by which a share of a source's target is used up: the inverse of its integrated weight."""
    linear = 1 + slope
    root = (linear - F.sqrt(linear * linear - 4 * slope * share)) / (2 * slope)
    return F.when(slope == 0, share).otherwise(root)


def _parted(rows: DataFrame, hot: HotKeys) -> DataFrame:
    """``rows`` with ``_part``: 0, or for an id with many rows one of the parts that these ask for."""
    if hot.table is None:
        return rows.withColumn("_part", F.lit(0).cast("bigint"))
    found = lookup_join(rows, hot.table, "_hash", "left")
    part = F.when(F.col(FAN_OUT).isNull(), 0).otherwise(1 + F.pmod("_salt", FAN_OUT))
    return found.withColumn("_part", part.cast("bigint")).drop(FAN_OUT)


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    slopes=SLOPES,
    share: float = SHARE,
    cap: int = CAP,
    whole: bool = False,
    light: bool = False,
) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target``, ``taken`` and ``copies``.

    ``copies`` lists the position and words of each time that a document is taken. With
    ``light`` only doc_id and source are kept of the input, and texts are read once.
    """
    kept = [] if light else [F.struct(*[c for c in docs.columns if c not in ADDED]).alias("_document")]
    own = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.col("text").alias("_text"), *kept)
    own = own.withColumn("_key", _key(F.col("source"))).withColumn("_hash", _hash(F.col("doc_id")))
    own = own.withColumn("_salt", F.xxhash64("size", F.col("_text"))).drop("_text")
    # What the plan reads again and again is small; texts are read once more, at the end.
    slim = write_table(own.select("doc_id", "source", "size", "_key", "_hash", "_salt"), "sizes")
    hot = hot_keys(slim, "_hash", BUCKET)
    sources = targets(slim, weights, slopes, share, cap)
    sources = write_table(sources.withColumn("_key", _key(F.col("source"))).drop("source"), "sources")
    told = sources.select("_key", "source_id", "source_size", "rows", "slope", "target")
    bucket = F.shiftright("_hash", 20) * (1 + F.floor(F.col("rows") / BUCKET))
    bucket = F.shiftright(bucket, 32).alias("_bucket")
    sums = (
        _parted(lookup_join(slim, told.select("_key", "source_id", "rows"), "_key"), hot)
        .groupBy("source_id", bucket, "_part")
        .agg(F.sum("size").alias("_words"))
    )
    earlier = Window.partitionBy("source_id").orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("source_id", "_bucket", "_part", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_begin"))
    begins = write_table(begins, "buckets")
    placed = _parted(lookup_join(slim if light else own, told, "_key").withColumn("_bucket", bucket), hot)
    inside = Window.partitionBy("source_id", "_bucket", "_part").orderBy("_hash", "doc_id", "size", "_salt")
    placed = placed.join(begins, ["source_id", "_bucket", "_part"])
    within = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("_begin", F.col("_begin") + within)
    budget = F.floor(F.col("target")).cast("bigint")

    def copy(turn: Column) -> Column:
        start = F.col("_begin") + turn * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), budget - start))
        if whole:
            first = (start == 0) & (F.col("target") > 0)
            words = F.when((words * 2 >= F.col("size")) | first, F.col("size")).otherwise(F.lit(0))
        at = position(F.least(F.lit(1.0), start / F.col("target")), F.col("slope"))
        return F.struct(at.alias("position"), words.cast("bigint").alias("words"))

    turns = F.transform(F.array(*[F.lit(i).cast("bigint") for i in range(cap)]), copy)
    placed = placed.withColumn("copies", F.when(F.col("size") > 0, F.filter(turns, lambda c: c["words"] > 0)))
    placed = placed.withColumn("copies", F.coalesce("copies", F.array().cast("array<struct<position:double,words:bigint>>")))
    taken = F.aggregate("copies", F.lit(0).cast("bigint"), lambda a, c: a + c["words"])
    return placed.withColumn("taken", taken).select(*(["doc_id", "source"] if light else ["_document.*"]), *ADDED)


def in_order(mixed: DataFrame) -> DataFrame:
    """Sorted by the position at which each document is first trained on, those not taken last."""
    first = F.get("copies", F.lit(0))["position"]
    return mixed.orderBy(first.asc_nulls_last(), "doc_id")


def training_rows(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, a row for each copy taken whole, sorted by training position."""
    named = docs.select("doc_id", "source", "text", F.struct("*").alias("_row"))
    copies = mix(named, whole=True, **options).select("doc_id", "_row", F.explode("copies").alias("_copy"))
    return copies.orderBy("_copy.position", "doc_id").select("_row.*")
