"""Passages that stand elsewhere too, taken out: windows of words, counted by super-k-mers.

A window's minimiser is the run of a few words in it that hashes lowest, the first of
equals. Consecutive windows with the same one travel together as one packed string, a
super-k-mer, to the bucket of that minimiser: about 50 words for 16 windows instead of
16 times 35. Equal windows have equal minimisers, so they meet in one bucket; there the
windows of a minimiser are sorted as they are, word for word, and counted.

Of texts that are there several times one goes to the buckets, with the weight of two.
A minimiser with more than ``HOT`` super-k-mers isn't put into one bucket: each of its
windows travels alone, as a 128-bit digest, after each task has counted its own.

Null text counts as no words. Rows with one id and different texts are judged apart, as
texts are known by their SHA-256; repeated rows repeat each other. Texts shorter than
the window keep all words. An empty table gives no rows. Columns besides the id and the
text are left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from roamrank.llm.batches import bound_batches, tidy
from roamrank.llm.texts import Words, buffer_of, portions
from roamrank.operators.joins import fits_broadcast, lookup_join
from roamrank.workspace import write_table

#: The ASCII white space that parts words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Words of a window, and of a minimiser.
WINDOW = 35
MINIMISER = 5
#: A minimiser with more super-k-mers than this has its windows sent one by one: if all
#: of them differ, the windows of one bucket take up about 100 MB.
HOT = 20_000
#: About this many bytes of super-k-mers go to a task, of about so many bytes each.
TASK_BYTES = 64 << 20
SUPER_KMER_BYTES = 400
#: Bytes of texts that a task works on at a time; each has some forty in arrays beside it.
PORTION = 1 << 20
#: Windows that a task looks at together, if their minimisers are hot.
AT_ONCE = 400_000
#: Texts with copies that a task remembers to have sent.
SENT = 100_000

KEPT = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])
PACKED = "minimiser bigint, key binary, first int, weight int, packed binary"


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """The texts' bytes, with the first half of their SHA-256 as a key."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(*columns, raw.alias("raw")).withColumn("key", F.substring(F.unhex(F.sha2("raw", 256)), 1, 16))


def copied_texts(docs: DataFrame) -> DataFrame:
    """(key, copied, one): the texts that are there several times, and the smallest id among them."""
    counted = _keyed(docs, "doc_id").groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("one"))
    return counted.where("n > 1").select("key", F.lit(True).alias("copied"), "one")


def _minimised(window: int, minimiser: int) -> Callable:
    """A batch's words and super-k-mers; nested, so that it travels by value."""
    turn = np.uint64(0x9E3779B97F4A7C15)

    def minimised(raw: pa.Array):
        """Words, and of each super-k-mer: text, first and last window's first word, and minimiser."""
        data, starts, ends = buffer_of(raw)
        words = Words(data, starts, ends, SPACES)
        owner = words.owners()
        n = len(words) - window + 1
        if n <= 0:
            none = np.zeros(0, np.int64)
            return words, none, none, none, none
        hashed = words.hashes()
        runs = len(words) - minimiser + 1
        value = np.zeros(runs, np.uint64)
        for i in range(minimiser):
            value = value * turn + hashed[i : i + runs]
        value ^= value >> np.uint64(31)
        value *= turn
        value ^= value >> np.uint64(29)
        # The lowest of the runs in each window, the first of equals, by doubling.
        lowest, reach, goal = np.arange(runs), 1, window - minimiser + 1
        while reach < goal:
            shift = min(reach, goal - reach)
            left, right = lowest[:-shift], lowest[shift:]
            lowest = np.where(value[right] < value[left], right, left)
            reach += shift
        whole = np.flatnonzero(owner[:n] == owner[window - 1 :])
        if not len(whole):
            return words, whole, whole, whole, whole
        at = lowest[whole]
        new = np.concatenate([[True], (np.diff(whole) != 1) | (np.diff(at) != 0)])
        begin = np.flatnonzero(new)
        until = np.append(begin[1:], len(whole)) - 1
        return words, owner[whole[begin]], whole[begin], whole[until], value[at[begin]].astype(np.int64)

    return minimised


def minimiser_counts(texts: DataFrame, window: int, minimiser: int) -> DataFrame:
    """(minimiser, n): how many super-k-mers each bucket would get."""
    minimised = _minimised(window, minimiser)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in portions(whole, "raw", PORTION)):
            found, counts = np.unique(minimised(batch.column("raw"))[4], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts, pa.int64())], ["minimiser", "n"])

    counted = texts.select("raw").mapInArrow(tidy(count), "minimiser bigint, n bigint")
    return counted.groupBy("minimiser").agg(F.sum("n").alias("n"))


def super_kmers(
    texts: DataFrame, window: int, minimiser: int, frequent: DataFrame | None = None, hot: bool = False
) -> DataFrame:
    """Packed strings of (key, raw, copied) texts, with the place of the first window in its text.

    Those whose minimiser is in ``frequent``, or with ``hot`` off the others. The tasks
    get the frequent ones whole if they were measured to be small.
    """
    minimised = _minimised(window, minimiser)
    told = None
    if frequent is not None:
        if not fits_broadcast(frequent):
            sent = super_kmers(texts, window, minimiser)
            return lookup_join(sent, frequent, "minimiser", "left_semi" if hot else "left_anti")
        listed = np.sort(np.array([row[0] for row in frequent.collect()], np.int64))  # measured
        told = texts.sparkSession.sparkContext.broadcast(listed)

    def wanted(lowest: np.ndarray) -> np.ndarray:
        known = told.value
        place = np.minimum(np.searchsorted(known, lowest), max(0, len(known) - 1))
        return np.flatnonzero((known[place] == lowest) == hot) if len(known) else np.arange(0 if hot else len(lowest))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()

        def news(batch: pa.RecordBatch) -> pa.RecordBatch:
            """The batch without texts with copies that this task has sent already."""
            new = np.ones(batch.num_rows, bool)
            for place in np.flatnonzero(batch.column("copied").to_numpy(zero_copy_only=False)):
                key = batch.column("key")[place].as_py()
                new[place] = key not in sent
                if len(sent) < SENT:
                    sent.add(key)
            return batch if new.all() else batch.filter(pa.array(new))

        for batch in (part for whole in batches for part in portions(news(whole), "raw", PORTION)):
            copied = batch.column("copied").to_numpy(zero_copy_only=False)
            words, *found = minimised(batch.column("raw"))
            if told is not None:
                some = wanted(found[-1])
                found = [values[some] for values in found]
            text, first, last, lowest = found
            if not len(text):
                continue
            spaced, begins = words.spaced()
            for low in range(0, len(text), 20_000):
                part = slice(low, low + 20_000)
                until = begins[last[part] + window] - 1
                packed = [spaced[a:b] for a, b in zip(begins[first[part]].tolist(), until.tolist())]
                columns = [
                    pa.array(lowest[part]),
                    batch.column("key").take(pa.array(text[part])),
                    pa.array((first[part] - words.bounds[text[part]]).astype(np.int32)),
                    pa.array(1 + copied[text[part]].astype(np.int32)),
                    pa.array(packed, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["minimiser", "key", "first", "weight", "packed"])

    return texts.select("key", "raw", "copied").mapInArrow(tidy(pack), PACKED)


def _edges(packed: bytes) -> tuple[list[int], list[int]]:
    """Where the words of a packed string begin and end."""
    gaps = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32)
    return [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(packed)]


def repeated_in_buckets(packed: DataFrame, window: int) -> DataFrame:
    """(key, low, high): the words, from low to before high, of windows that stand elsewhere too.

    Rows must be sorted by minimiser, all of one in a task.
    """

    def judged(rows: list[tuple]) -> Iterator[tuple]:
        """Of one minimiser's (key, first, weight, packed), those windows that have a second."""
        strings: dict[bytes, int] = {}
        for _, _, weight, packed in rows:
            strings[packed] = strings.get(packed, 0) + weight
        windows = []
        if len(strings) > 1:
            for packed, weight in strings.items():
                begin, end = _edges(packed)
                windows += [(packed[begin[t] : end[t + window - 1]], weight) for t in range(len(begin) - window + 1)]
            windows.sort()
        repeated = {text for text, weight in windows if weight > 1}
        repeated.update(a[0] for a, b in zip(windows, windows[1:]) if a[0] == b[0])
        for key, first, weight, packed in rows:
            if weight > 1:
                continue  # a text with copies: all its windows are repeated
            begin, end = _edges(packed)
            count = len(begin) - window + 1
            if strings[packed] > 1:
                yield key, first, first + count + window - 1
                continue
            low = None
            for t in range(count + 1):
                here = t < count and packed[begin[t] : end[t + window - 1]] in repeated
                if here and low is None:
                    low = t
                elif not here and low is not None:
                    yield key, first + low, first + t + window - 1
                    low = None

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            table = table.combine_chunks()
            ids = table["minimiser"].to_numpy()
            if not len(ids):
                continue
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            rest = table.slice(int(starts[-1]))
            yield told(table, starts)
        if rest is not None:
            yield told(rest, np.array([0, rest.num_rows]))

    def told(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        out = []
        weights = table["weight"].to_numpy()
        for low, high in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if high - low > 1 and (weights[low:high] == 1).any():
                some = table.slice(low, high - low)
                out += judged(list(zip(*(some[c].to_pylist() for c in ("key", "first", "weight", "packed")))))
        keys, lows, highs = zip(*out) if out else ((), (), ())
        columns = [pa.array(keys, pa.binary()), pa.array(lows, pa.int32()), pa.array(highs, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["key", "low", "high"])

    return packed.mapInArrow(tidy(judge), "key binary, low int, high int")


def repeated_one_by_one(packed: DataFrame, window: int) -> DataFrame:
    """The same for super-k-mers of hot minimisers, by their windows' digests.

    What a task has twice is decided there, and one mark of it goes on; the rest is
    dealt by digest, so a window is there once for each ``AT_ONCE`` of a task at most.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, tuple | None] = {}
        out: list[tuple] = []
        for batch in batches:
            for key, first, weight, pack in zip(*(batch.column(c).to_pylist() for c in ("key", "first", "weight", "packed"))):
                begin, end = _edges(pack)
                for t in range(len(begin) - window + 1):
                    digest = xxhash.xxh3_128_digest(pack[begin[t] : end[t + window - 1]])
                    if digest not in kept:
                        kept[digest] = (key, first + t) if weight == 1 else None
                        continue
                    before = kept[digest]
                    if before:
                        out.append((None, *before))
                        kept[digest] = None
                    if weight == 1:
                        out.append((None, key, first + t))
                if len(out) > AT_ONCE // 8:
                    yield listed(out)
                    out = []
                if len(kept) > AT_ONCE:
                    yield listed([(digest, *(place or (None, None))) for digest, place in kept.items()])
                    kept = {}
        yield listed(out)
        yield listed([(digest, *(place or (None, None))) for digest, place in kept.items()])

    def listed(rows: list[tuple]) -> pa.RecordBatch:
        digests, keys, lows = zip(*rows) if rows else ((), (), ())
        columns = [pa.array(digests, pa.binary()), pa.array(keys, pa.binary()), pa.array(lows, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["digest", "key", "low"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of their digests; one without a key marks a window that is there twice."""
        now, waiting = None, None
        for batch in batches:
            out = []
            for digest, key, low in zip(*(batch.column(c).to_pylist() for c in ("digest", "key", "low"))):
                place = (key, low) if key is not None else None
                if digest != now:
                    now, waiting = digest, place
                    continue
                out += [(None, *p) for p in (waiting, place) if p]
                waiting = None
            yield listed(out).drop_columns(["digest"])

    windows = write_table(packed.mapInArrow(tidy(split), "digest binary, key binary, low int"), "hot-windows")
    dealt = windows.where("digest IS NOT NULL").repartition("digest").sortWithinPartitions("digest")
    decided = windows.where("digest IS NULL").select("key", "low")
    found = decided.unionByName(dealt.mapInArrow(tidy(judge), "key binary, low int"))
    return found.select("key", "low", (F.col("low") + window).alias("high"))


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, hot: int | None = None
) -> DataFrame:
    """(key, copied, spans): texts with repeated windows, and the words that those cover.

    ``spans`` lists starts and ends in turn. A text with copies has none: it is covered
    whole, if it is as long as a window.
    """
    if not 0 < minimiser <= window:
        raise ValueError("a minimiser is a part of a window")
    bound_batches(docs.sparkSession)
    copies = write_table(copied_texts(docs), "copied-texts")
    texts = lookup_join(_keyed(docs, "doc_id"), copies, "key", "left")
    texts = texts.where(F.col("copied").isNull() | F.col("doc_id").eqNullSafe(F.col("one")))
    texts = texts.select("key", "raw", F.coalesce("copied", F.lit(False)).alias("copied"))

    total = Observation()
    counts = minimiser_counts(texts, window, minimiser).observe(total, F.sum("n").alias("n"))
    frequent = counts.where(F.col("n") > (HOT if hot is None else hot)).select("minimiser")
    frequent = write_table(frequent, "hot-minimisers")
    tasks = max(1, math.ceil((total.get["n"] or 0) * SUPER_KMER_BYTES / TASK_BYTES))

    cool = super_kmers(texts, window, minimiser, frequent)
    spans = repeated_in_buckets(cool.repartition(tasks, "minimiser").sortWithinPartitions("minimiser"), window)
    if not frequent.isEmpty():
        alone = super_kmers(texts, window, minimiser, frequent, hot=True)
        spans = spans.unionByName(repeated_one_by_one(alone, window))
    placed = F.sort_array(F.collect_list(F.struct("low", "high")))
    covered = F.flatten(F.transform(placed, lambda s: F.array(s["low"], s["high"])))
    spans = spans.groupBy("key").agg(covered.alias("spans")).select("key", F.lit(False).alias("copied"), "spans")
    whole = copies.select("key", "copied", F.array().cast("array<int>").alias("spans"))
    return spans.unionByName(whole)


def without_repeats(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, hot: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every document without words of repeated windows.

    Kept words are joined by one space. Windows are judged on the whole texts as they
    came, not on what is left of them.
    """
    found = write_table(repeated_spans(docs, window, minimiser, hot), "repeated-spans")

    def strip(texts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from stripped(texts)

    def cut(batches):
        for raws, copied, spans in batches:
            out = []
            for raw, whole, own in zip(raws.to_pylist(), copied.to_pylist(), spans.to_pylist()):
                words = raw.split()
                n = len(words)
                if whole and n >= window:
                    words = []
                elif own:
                    kept, at = [], 0
                    for low, high in zip(own[::2], own[1::2]):
                        kept += words[at:low]
                        at = max(at, high)
                    words = kept + words[at:]
                out.append((n, n - len(words), b" ".join(words)))
            yield pa.array([dict(zip(("n_words", "n_removed", "kept"), row)) for row in out], KEPT)

    stripped = tidy(cut)
    strip = F.arrow_udf(strip, "struct<n_words:bigint,n_removed:bigint,kept:binary>")
    told = lookup_join(_keyed(docs, "doc_id"), found, "key", "left")
    made = told.select("doc_id", strip("raw", "copied", "spans").alias("made"))
    return made.select("doc_id", "made.n_words", "made.n_removed", F.col("made.kept").cast("string").alias("kept"))
