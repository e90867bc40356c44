"""Phrases that occur more often than their parts suggest, mined length by length (SETM).

Occurrence relations are stored, sorted by place: R1 holds every occurrence of a
frequent word, R(k) every occurrence of a frequent phrase of k words. R(k) is merge-joined
with itself by piece and adjacent place, which gives the phrases of k + 1 words; they are
counted by group, and only the occurrences of frequent groups are stored as R(k + 1) and
extended further. A row of a relation is a document: the ids of its frequent phrases in
the order of their places, and each one's distance from the one before. A piece's end
adds one to the distance, so neighbours at distance 1 are adjacent in one piece.

Occurrences never leave their documents' rows; what is shuffled are counts, combined in
each batch and each task. Frequent groups go to the occurrences by a broadcast if they
were measured to be small, else occurrences are joined with them, hot groups salted.

A null language is ``und``, a null text empty; texts without words and repeated rows
count like any, a repeated row as often as it is there. Ties in rank go by count and
phrase. An empty table gives no rows; other columns than language and text aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamrank.llm.batches import bound_batches, tidy
from roamrank.llm.texts import Words, buffer_of
from roamrank.operators.joins import lookup_join
from roamrank.workspace import payload_bytes, write_table

#: What ends a piece, and what else parts words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b" \t"
#: Frequent groups up to this size go to the tasks whole.
BROADCAST_BYTES = 32 << 20

NO_LANG = "und"
RELATION = "block bigint, step array<int>, id array<bigint>"


def _texts(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang"), raw.alias("raw"))


def _tokenizer() -> Callable:
    """What tasks do with a batch of (lang, raw); nested, so that it travels by value."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    ends = np.zeros(256, bool)
    ends[np.frombuffer(PIECE_ENDS, np.uint8)] = True

    def tokenized(batch: pa.RecordBatch):
        """Words, steps, and the distinct (lang, word) pairs with each word's number among them."""
        data, starts, until = buffer_of(batch.column("raw"))
        words = Words(lower[data], starts, until, PIECE_ENDS + SPACES)
        piece = np.searchsorted(np.flatnonzero(ends[data]), words.starts)
        steps = np.ones(len(words), np.int32)
        steps[1:] += piece[1:] != piece[:-1]
        codes, known = words.encoded()
        langs = batch.column("lang").dictionary_encode()
        spoken = langs.indices.to_numpy(zero_copy_only=False)[words.owners()]
        pairs, place, counts = np.unique(spoken * len(known) + codes, return_inverse=True, return_counts=True)
        lang, word = np.divmod(pairs, max(1, len(known)))
        return words, steps, langs.dictionary.take(pa.array(lang)), known.take(pa.array(word)), place, counts

    return tokenized


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, a): how often each word occurs in each language."""
    tokenized = _tokenizer()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, lang, word, _, counts = tokenized(batch)
            columns = [lang.cast(pa.string()), word.cast(pa.binary()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "a"])

    counted = _texts(docs).mapInArrow(tidy(count), "lang string, word binary, a bigint")
    return counted.groupBy("lang", "word").agg(F.sum("a").alias("a"))


def _relation(step: np.ndarray, ids: np.ndarray, bounds: np.ndarray, kept: np.ndarray, block: pa.Array) -> pa.RecordBatch:
    """Rows of the kept occurrences, their distances told from each other."""
    at = np.cumsum(step, dtype=np.int64)
    left, found = at[kept], ids[kept]
    until = np.searchsorted(np.flatnonzero(kept), bounds)
    away = np.diff(left, prepend=0)
    first = until[:-1][until[1:] > until[:-1]]
    away[first] = 2  # nothing before it in its row
    offsets = pa.array(until.astype(np.int32))
    columns = [
        block,
        pa.ListArray.from_arrays(offsets, pa.array(away.astype(np.int32))),
        pa.ListArray.from_arrays(offsets, pa.array(found, pa.int64())),
    ]
    some = np.flatnonzero(np.diff(until))
    batch = pa.RecordBatch.from_arrays(columns, ["block", "step", "id"])
    return batch.take(pa.array(some)) if len(some) < batch.num_rows else batch


def _regrouped(occurrences: DataFrame) -> DataFrame:
    """Occurrences (block, at, id) as rows of a relation: a document each."""
    placed = F.sort_array(F.collect_list(F.struct("at", "id")))
    rows = occurrences.groupBy("block").agg(placed.alias("placed"))
    before = F.concat(F.array(F.col("placed.at")[0] - 2), F.slice("placed.at", 1, F.size("placed") - 1))
    step = F.zip_with("placed.at", before, lambda a, b: (a - b).cast("int"))
    return rows.select("block", step.alias("step"), F.col("placed.id").alias("id"))


def word_occurrences(docs: DataFrame, words: DataFrame, limit: int | None = None) -> DataFrame:
    """R1: the occurrences of ``words`` (lang, word, id) in every document."""
    texts = _texts(docs).withColumn("block", F.monotonically_increasing_id())
    tokenized = _tokenizer()
    if payload_bytes(words) > (BROADCAST_BYTES if limit is None else limit):

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found, steps, lang, word, place, _ = tokenized(batch)
                owners, place = pa.array(found.owners()), pa.array(place)
                at = pa.array(np.cumsum(steps, dtype=np.int64))
                columns = [batch.column("block").take(owners), at, lang.take(place).cast(pa.string())]
                columns.append(word.take(place).cast(pa.binary()))
                rows = pa.Table.from_arrays(columns, ["block", "at", "lang", "word"])
                yield from rows.to_batches(max_chunksize=50_000)

        key = F.struct("lang", "word").alias("key")
        each = texts.mapInArrow(tidy(spread), "block bigint, at bigint, lang string, word binary")
        return _regrouped(lookup_join(each.select("block", "at", key), words.select(key, "id"), "key", broadcast_bytes=0))

    rows = words.select("lang", "word", "id").toArrow()  # measured
    by_lang = {}
    for lang in pc.unique(rows["lang"]).to_pylist():
        own = rows.filter(pc.equal(rows["lang"], lang))
        by_lang[lang] = own["word"].combine_chunks(), own["id"].to_numpy()
    told = docs.sparkSession.sparkContext.broadcast(by_lang)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, steps, lang, word, place, _ = tokenized(batch)
            ids = np.full(len(word), -1, np.int64)
            langs = lang.cast(pa.string())
            for name in langs.unique().to_pylist():
                if name in told.value:
                    known, numbers = told.value[name]
                    here = np.flatnonzero(pc.equal(langs, name).to_numpy(zero_copy_only=False))
                    at = pc.index_in(word.take(pa.array(here)).cast(pa.binary()), value_set=known)
                    at = at.fill_null(-1).to_numpy(zero_copy_only=False)
                    ids[here] = np.where(at < 0, -1, numbers[at])
            ids = ids[place]
            yield _relation(steps, ids, found.bounds, ids >= 0, batch.column("block"))

    return texts.mapInArrow(tidy(look_up), RELATION)


def _adjacent() -> Callable:
    """The merge-join of a relation with itself, a batch at a time; travels by value."""

    def adjacent(batch: pa.RecordBatch):
        """Steps, ids, row bounds, and which occurrences the next one adjoins."""
        offsets = batch.column("id").offsets.to_numpy().astype(np.int64)
        bounds = offsets - offsets[0]
        step = batch.column("step").flatten().to_numpy(zero_copy_only=False)
        ids = batch.column("id").flatten().to_numpy(zero_copy_only=False)
        meets = np.zeros(len(ids), bool)
        meets[:-1] = step[1:] == 1
        last = bounds[1:][np.diff(bounds) > 0] - 1
        meets[last] = False
        return step, ids, bounds, meets

    return adjacent


def pair_counts(relation: DataFrame) -> DataFrame:
    """(head, tail, a): how often the phrase ``tail`` begins a word after the phrase ``head``."""
    adjacent = _adjacent()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, ids, _, meets = adjacent(batch)
            at = np.flatnonzero(meets)
            known, code = np.unique(ids, return_inverse=True)
            pairs, counts = np.unique(code[at] * len(known) + code[at + 1], return_counts=True)
            head, tail = np.divmod(pairs, max(1, len(known)))
            columns = [known[head], known[tail], counts.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["head", "tail", "a"])

    counted = relation.mapInArrow(tidy(count), "head bigint, tail bigint, a bigint")
    return counted.groupBy("head", "tail").agg(F.sum("a").alias("a"))


def extended(relation: DataFrame, phrases: DataFrame, limit: int | None = None) -> DataFrame:
    """R(k + 1): the occurrences of ``phrases`` (head, tail, id) in the relation R(k)."""
    adjacent = _adjacent()
    if payload_bytes(phrases) > (BROADCAST_BYTES if limit is None else limit):

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                step, ids, bounds, meets = adjacent(batch)
                at = np.flatnonzero(meets)
                owners = pa.array(np.searchsorted(bounds, at, side="right") - 1)
                places = np.cumsum(step, dtype=np.int64)
                columns = [batch.column("block").take(owners), *(pa.array(c) for c in (places[at], ids[at], ids[at + 1]))]
                rows = pa.Table.from_arrays(columns, ["block", "at", "head", "tail"])
                yield from rows.to_batches(max_chunksize=50_000)

        key = F.struct("head", "tail").alias("key")
        each = relation.mapInArrow(tidy(spread), "block bigint, at bigint, head bigint, tail bigint")
        return _regrouped(lookup_join(each.select("block", "at", key), phrases.select(key, "id"), "key", broadcast_bytes=0))

    rows = phrases.select("head", "tail", "id").toArrow()  # measured
    heads, head = np.unique(rows["head"].to_numpy(), return_inverse=True)
    tails, tail = np.unique(rows["tail"].to_numpy(), return_inverse=True)
    order = np.argsort(head * len(tails) + tail)
    keys, numbers = (head * len(tails) + tail)[order], rows["id"].to_numpy()[order]
    told = relation.sparkSession.sparkContext.broadcast((heads, tails, keys, numbers))

    def found(known: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        return place, known[place] == ids

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, tails, keys, numbers = told.value
        for batch in batches:
            step, ids, bounds, meets = adjacent(batch)
            at = np.flatnonzero(meets)
            (head, known), (tail, also) = found(heads, ids[at]), found(tails, ids[at + 1])
            place, frequent = found(keys, head * len(tails) + tail)
            frequent &= known & also
            longer = np.full(len(ids), -1, np.int64)
            longer[at[frequent]] = numbers[place[frequent]]
            yield _relation(step, longer, bounds, longer >= 0, batch.column("block"))

    return relation.mapInArrow(tidy(look_up), RELATION)


def _named(counts: DataFrame, shorter: DataFrame) -> DataFrame:
    """Frequent pairs with their words, and the counts of all that they begin and end with."""
    heads = shorter.select(F.col("id").alias("head"), "lang", "phrase", "heads")
    tails = shorter.select(F.col("id").alias("tail"), "last", "tails")
    both = lookup_join(lookup_join(counts, heads, "head"), tails, "tail")
    return both.select(
        F.monotonically_increasing_id().alias("id"),
        "head",
        "tail",
        "lang",
        F.concat("phrase", F.lit(" ").cast("binary"), "last").alias("phrase"),
        "last",
        "a",
        F.concat("heads", F.array("a")).alias("heads"),
        F.concat("tails", F.array("a")).alias("tails"),
    )


def _score(length: int, n: Column) -> Column:
    """The cut with the lowest score, the first of several: (score, cut, l, r). Decimals keep it exact."""

    def exact(number: Column, digits: int) -> Column:
        return number.cast(f"decimal({digits},0)")

    def cut(k: int) -> Column:
        l, r = F.col("heads")[k - 1], F.col("tails")[length - k - 1]
        above = exact(F.lit(1000), 4) * exact(F.col("a"), 18) * exact(n, 16)
        score = F.call_function("div", above, exact(l, 18) * exact(r, 18))
        return F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))

    cuts = [cut(k) for k in range(1, length)]
    return F.array_min(F.array(*cuts))


def mine(
    docs: DataFrame, min_count: int = 100, longest: int = 5, top: int = 2000, covered_percent: int = 100
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases.

    Candidates are phrases of two to ``longest`` words within a piece that occur
    ``min_count`` times. One that lies in a longer candidate with ``covered_percent`` of
    its count is left out. The score is the lowest over all cuts in two of
    floor(1000 * a * n / (l * r)), where l and r count the parts and n the language's words.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select("lang", "text")
    counts = write_table(word_counts(docs), "words")
    totals = write_table(counts.groupBy("lang").agg(F.sum("a").alias("n")), "word-totals")
    single = counts.where(F.col("a") >= min_count).select(
        F.monotonically_increasing_id().alias("id"),
        "lang",
        F.col("word").alias("phrase"),
        F.col("word").alias("last"),
        "a",
        F.array("a").alias("heads"),
        F.array("a").alias("tails"),
    )
    levels = [write_table(single, "phrases-1")]
    words = levels[0].select("id", "lang", F.col("phrase").alias("word"))
    relation = write_table(word_occurrences(docs, words), "occurrences-1")
    for length in range(2, longest + 1):
        frequent = pair_counts(relation).where(F.col("a") >= min_count)
        level = write_table(_named(frequent, levels[-1]), f"phrases-{length}")
        if level.isEmpty():
            break
        levels.append(level)
        if length < longest:
            relation = write_table(extended(relation, level.select("head", "tail", "id")), f"occurrences-{length}")

    scored = [
        _scored(level, length, levels[length] if length < len(levels) else None, totals, covered_percent)
        for length, level in enumerate(levels, 1)
        if length > 1
    ]
    if not scored:
        scored = [_scored(levels[0].limit(0), 2, None, totals, covered_percent)]
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = reduce(DataFrame.unionByName, scored).withColumn("rank", F.row_number().over(best))
    # The uncast number, so that Spark limits each task's rows before they are shuffled.
    ranked = ranked.where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("bigint"))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _scored(
    level: DataFrame, length: int, longer: DataFrame | None, totals: DataFrame, covered_percent: int
) -> DataFrame:
    """Phrases that no longer candidate covers, with their scores.

    A candidate that covers a phrase has, among its parts, one that is a word longer
    than the phrase and covers it too, so only those are looked at.
    """
    if longer is not None:
        sides = longer.select(F.col("head").alias("id"), "a").unionByName(longer.select(F.col("tail").alias("id"), "a"))
        most = write_table(sides.groupBy("id").agg(F.max("a").alias("most")), "covered")
        level = lookup_join(level, most, "id", "left")
        level = level.where(F.col("most").isNull() | (100 * F.col("most") < covered_percent * F.col("a")))
    told = lookup_join(level, totals, "lang").withColumn("best", _score(length, F.col("n")))
    return told.select(
        "lang", F.col("phrase").cast("string").alias("phrase"), "a", "best.l", "best.r", "n", "best.score"
    )
