"""N-gram Jaccard join with set-relation skipping.

A document's set is that of its SHINGLE-word shingles. Two documents are linked if their
sets' intersection is at least PERCENT hundredths of their union. The sets are exact but for
hashing: a shingle is a 62-bit hash and a set's class a 64-bit one.

1.  Documents with equal sets are one class; only classes are compared.
2.  Shingles are put in one order for all, frequent ones last. Sets that are linked
    share one of their first few (their prefix), so an index of prefixes lists for
    each shingle the classes that may be linked. Entries hold the set's size and the
    shingle's place in it; blocks of a list whose sizes and places leave too little
    to share are skipped.
3.  First, neighbours in each list are compared. Near copies have near copies for
    neighbours, so a large group of them is linked up by about as many comparisons
    as it has members. Sets of one component then have nothing to ask of each other, and
    a list with a single component is skipped as a whole.
4.  What is left are pairs between components. In short lists, a set that is linked to
    another takes over that one's answers: what two such reference sets share, and what
    each lacks of its own, bounds what the pair shares. Only where the bounds don't
    decide are its sets compared. Long lists get their prefixes first: a pair is looked
    at in the list of its first common shingle alone, and only sets with a partner there
    that the prefixes allow are sent as a whole. These are compared by products of
    blocks, and return links alone, so that a group of copies that are near but not near
    enough makes no rows for its pairs. With ``all_links`` pairs within components go
    the same ways, and all links result.

Frequencies, components, links and sets are tables; only shingles that are frequent, at
most FREQUENT of them, come to the driver, and they only set the order. Lists with
more than LIST entries are cut by a hash, part by part against each other.

Words are runs of bytes other than ASCII white space, with A-Z in lower case. Texts
with fewer words than a shingle are one shingle; null or empty texts have none, are
linked with nothing, and are components of their own. A component's id is its smallest
doc_id, null if it has none. Repeated rows stay, one result each; an empty table gives
none. Columns besides doc_id and text are ignored. Whole texts are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roamrank.llm.batches import bound_batches, tidy
from roamrank.operators.joins import lookup_join
from roamrank.workspace import drop_table, gathered, payload_bytes, sized, write_table

SHINGLE = 5
PERCENT = 80
#: How often a shingle is in a prefix to be put last, and how many such at most.
OFTEN, FREQUENT = 20, 1_000_000
#: A list with more entries than SHORT is compared as a whole, and in parts of LIST.
SHORT, LIST = 32, 1_000
BLOCK, COLUMNS = 64, 512
#: Edges that are joined up in one task.
JOINED = 100_000
LAST = 1 << 62  # added to a frequent shingle's hash
#: Bytes of text that are hashed at a time, and shingles that are counted together.
CHUNK = 1 << 19
COUNTED = 2_000_000

# Odd numbers: the base of the words' polynomial and its inverse modulo 2**64,
# multipliers for the places of a shingle's words, and those of a mixing step.
BASE = 0x9FB21C651E98DF25
INVERSE = pow(BASE, -1, 1 << 64)
PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[0]
    h = (h ^ (h >> np.uint64(27))) * MIX[1]
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Texts to sets of shingle hashes, some megabytes of text at a time."""

    def __init__(self) -> None:
        code = np.arange(256)
        self.space = (code == 32) | ((code >= 9) & (code <= 13))
        self.lower = np.where((code >= 65) & (code <= 90), code + 32, code).astype(np.uint8)
        self.powers = self._powers(BASE, 1 << 16)
        self.inverses = self._powers(INVERSE, 1 << 16)

    def _powers(self, base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def _words(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word begins, and its hash; no word goes across a break."""
        if len(data) >= len(self.powers):
            self.powers = self._powers(BASE, 2 * len(data))
            self.inverses = self._powers(INVERSE, 2 * len(data))
        inside = ~self.space[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        breaks = breaks[(breaks > 0) & (breaks < len(data))]
        first[breaks] = inside[breaks]
        last[breaks - 1] = inside[breaks - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((self.lower[data].astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=total[1:])
        own = (total[end] - total[begin]) * self.inverses[begin] + (end - begin).astype(np.uint64) * PLACES[0]
        return begin, _mixed(own)

    def _long(self, data: np.ndarray) -> np.ndarray:
        """Hashes of the words of one text that is read in several pieces, cut at white space."""
        found, at = [], 0
        while at < len(data):
            end = min(len(data), at + CHUNK)
            while end < len(data) and not self.space[data[end]]:
                space = np.flatnonzero(self.space[data[end : end + CHUNK]])
                end = end + int(space[0]) if len(space) else min(len(data), end + CHUNK)
            found.append(self._words(data[at:end], np.zeros(0, dtype=np.int64))[1])
            at = end
        return np.concatenate(found)

    def sets(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For runs of texts: the first one's number, all sets' hashes in order, and where each set begins."""
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        sizes = np.asarray(pc.binary_length(texts)).astype(np.int64)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        values = texts.buffers()[2]
        data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
        at, n = 0, len(texts)
        ends = np.cumsum(sizes)
        while at < n:
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
            stop = min(stop, at + 30_000)
            piece = data[offsets[at] : offsets[stop]]
            if stop == at + 1 and len(piece) > 2 * CHUNK:
                words = self._long(piece) if sizes[at] else np.zeros(0, dtype=np.uint64)
                owner = np.zeros(len(words), dtype=np.int64)
            else:
                breaks = offsets[at:stop] - offsets[at]
                begin, words = self._words(piece, breaks)
                # Empty texts share their break with the next.
                owner = np.searchsorted(breaks, begin, "right") - 1
            yield at, *self._shingles(words, owner, stop - at)
            at = stop

    def _shingles(self, words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        many = np.bincount(owner, minlength=n)
        begin = np.cumsum(many) - many
        values, owners = [], []
        for width in range(1, SHINGLE + 1):
            if width < SHINGLE:  # a short text is one shingle
                at = begin[many == width]
            else:
                left = (begin + many)[owner] - np.arange(len(words))
                at = np.flatnonzero(left >= SHINGLE)
            h = np.full(len(at), width, dtype=np.uint64)
            for k in range(width):
                h += words[at + k] * PLACES[k]
            values.append((_mixed(h) >> np.uint64(2)).astype(np.int64))
            owners.append(owner[at].astype(np.uint16))
        values, owner = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(values)
        order = order[np.argsort(owner[order], kind="stable")]
        values, owner = values[order], owner[order]
        if len(values):
            once = np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])]
            values, owner = values[once], owner[once]
        return values, np.searchsorted(owner, np.arange(n + 1))


def class_of(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n: int) -> int:
    return n + (-PERCENT * n // 100) + 1


def least_overlap(total):
    """The shared shingles that two linked sets have, given the sum of their sizes."""
    return -(-PERCENT * total // (100 + PERCENT))


def _least(total: Column) -> Column:
    return F.ceil(total * PERCENT / (100 + PERCENT)).cast("bigint")


def document_key(docs: DataFrame) -> Column:
    """A hash that tells documents apart, repeated rows excepted."""
    return F.xxhash64("doc_id", "text")


def frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of prefixes, with their counts.

    What comes last makes room in prefixes for what follows, so shingles beyond them are
    counted too, if a batch of documents has them several times.
    """

    def count(batches):
        shingler, seen = Shingler(), set()
        for batch in batches:
            near, far, held = [], [], 0
            for _, hashes, starts in shingler.sets(batch.column(0)):
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    kind = class_of(hashes[a:b])
                    if a < b and kind not in seen:
                        seen.add(kind)
                        n = prefix_length(b - a)
                        end = min(b, a + n + n // 10 + 1)
                        near.append(hashes[a:end].copy())
                        far.append(hashes[end : min(b, a + 3 * n)].copy())
                        held += len(near[-1]) + len(far[-1])
                if held > COUNTED:
                    yield counted(near, far)
                    near, far, held = [], [], 0
            if near:
                yield counted(near, far)

    def counted(near, far):
        shingle, n = np.unique(np.concatenate(near), return_counts=True)
        beyond, m = np.unique(np.concatenate(far), return_counts=True)
        columns = [np.concatenate([shingle, beyond[m > 1]]), np.concatenate([n, m[m > 1]])]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shingle", "n"])

    counts = docs.select("text").mapInArrow(tidy(count), "shingle bigint, n bigint")
    counts = counts.groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas()
    top = top.sort_values("shingle")
    return top["shingle"].to_numpy(dtype=np.int64), top["n"].to_numpy(dtype=np.int64)


def sets(docs: DataFrame) -> DataFrame:
    """(doc_id, key, class, n, prefix, fans): every document's class, size and prefix, in order.

    The prefix is null where the same task has given that of the class already.
    ``fans`` tells into how many parts each shingle's list is cut.
    """
    often, counts = frequent(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, key bigint, class bigint, n bigint, prefix array<bigint>, fans array<int>"

    def describe(batches):
        shingler, seen = Shingler(), set()
        for batch in batches:
            for first, hashes, starts in shingler.sets(batch.column(2)):
                kinds, sizes, prefixes, fans = [], [], [], []
                at = np.minimum(np.searchsorted(often, hashes), max(len(often) - 1, 0))
                last = often[at] == hashes if len(often) else np.zeros(len(hashes), dtype=bool)
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    kinds.append(class_of(hashes[a:b]))
                    sizes.append(b - a)
                    if a == b or kinds[-1] in seen:
                        prefixes.append(None)
                        fans.append(None)
                        continue
                    seen.add(kinds[-1])
                    n, own = prefix_length(b - a), last[a:b]
                    if own.any():
                        order = np.concatenate([np.flatnonzero(~own), np.flatnonzero(own)])[:n] + a
                        prefixes.append(hashes[order] + np.where(last[order], LAST, 0))
                        fan = np.where(last[order], 1 + counts[at[order]] // LIST, 1)
                    else:
                        prefixes.append(hashes[a : a + n])
                        fan = np.ones(n, dtype=np.int64)
                    fans.append(fan.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(kinds)),
                        batch.column(1).slice(first, len(kinds)),
                        pa.array(kinds, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(prefixes, pa.list_(pa.int64())),
                        pa.array(fans, pa.list_(pa.int32())),
                    ],
                    ["doc_id", "key", "class", "n", "prefix", "fans"],
                )

    named = docs.select("doc_id", document_key(docs).alias("key"), "text")
    return write_table(named.mapInArrow(tidy(describe), schema), "sets")


def index(described: DataFrame) -> DataFrame:
    """(shingle, part, class, n, place): lists of the prefixes, but for those of one class."""
    entries = described.where("prefix IS NOT NULL").select(
        "class", "n", F.posexplode(F.arrays_zip("prefix", "fans")).alias("place", "at")
    )
    entries = entries.select(F.col("at.prefix").alias("shingle"), F.col("at.fans").alias("fan"), "class", "n", "place")
    part = F.when(F.col("fan") > 1, F.pmod(F.xxhash64("class", "shingle"), F.col("fan"))).otherwise(0).cast("int")
    entries = entries.withColumn("part", part)
    ordered = entries.repartition("shingle", "part").sortWithinPartitions("shingle", "part", "n", "class")

    def shared(batches):
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            # The last list may go on in the next batch.
            ends = (pdf["shingle"].to_numpy() == pdf["shingle"].iloc[-1]) & (pdf["part"].to_numpy() == pdf["part"].iloc[-1])
            rest = pdf[ends]
            yield _shared(pdf[~ends])
        if rest is not None:
            yield _shared(rest)

    columns = "shingle bigint, fan int, class bigint, n bigint, place int, part int"
    # A list stays in its partition, so merged partitions hold whole lists, one after another.
    ordered = gathered(ordered, 4 * payload_bytes(described))
    return write_table(ordered.mapInPandas(tidy(shared), columns), "index")


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entries of lists with several classes, or of which this is a part; a class once in each."""
    if pdf.empty:
        return pdf
    pdf = pdf.drop_duplicates(["shingle", "part", "class"])
    key = pdf["shingle"].to_numpy()
    part = pdf["part"].to_numpy()
    start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
    many = np.repeat(np.diff(np.r_[start, len(pdf)]), np.diff(np.r_[start, len(pdf)]))
    return pdf[(many > 1) | (pdf["fan"].to_numpy() > 1)]


def _oriented(pairs: DataFrame) -> DataFrame:
    """(a, na, b, nb) with a < b, each pair once."""
    swap = F.col("a") > F.col("b")
    pick = lambda x, y, name: F.when(swap, F.col(y)).otherwise(F.col(x)).alias(name)
    return pairs.select(
        pick("a", "b", "a"), pick("na", "nb", "na"), pick("b", "a", "b"), pick("nb", "na", "nb")
    ).distinct()


def neighbours(lists: DataFrame) -> DataFrame:
    """Pairs that follow each other in a list by size, in one of three orders among equals."""
    order = Window.partitionBy("shingle", "part").orderBy("n", F.xxhash64("class", F.pmod("shingle", F.lit(3))))
    following = lists.select(
        F.col("class").alias("a"),
        F.col("n").alias("na"),
        F.lead("class").over(order).alias("b"),
        F.lead("n").over(order).alias("nb"),
        F.col("place").alias("pa"),
        F.lead("place").over(order).alias("pb"),
    ).where("b IS NOT NULL")
    fits = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= _least(F.col("na") + F.col("nb"))
    most = payload_bytes(lists)
    return gathered(_oriented(gathered(following.where(fits), most)), most)


def open_lists(lists: DataFrame, nodes: DataFrame, all_links: bool) -> DataFrame:
    """Entries of the lists that hold several components, or of all lists, with ``many``, their list's length."""
    known = lookup_join(lists, nodes.withColumnRenamed("root", "component"), "class", "left")
    known = known.withColumn("component", F.coalesce("component", "class"))
    known = write_table(known.drop("part", "fan"), "lists")
    drop_table(lists)
    wide = known.groupBy("shingle").agg(
        F.count("*").alias("many"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    wide = wide.where("many > 1" if all_links else "low < high").select("shingle", "many")
    wide = write_table(gathered(wide, payload_bytes(known)), "open-lists")
    entries = write_table(lookup_join(known, wide, "shingle"), "open-entries")
    drop_table(known)
    drop_table(wide)
    return entries


def candidates(entries: DataFrame, all_links: bool) -> DataFrame:
    """Pairs that share a short list in which sizes and places allow a link; between components, or all."""
    ordered = entries.where(F.col("many") <= SHORT).repartition("shingle").sortWithinPartitions("shingle", "n", "class")

    def pair(batches):
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            key = pdf["shingle"].to_numpy()
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            yield from _pairs(pdf.iloc[: start[-1]], start, all_links)
            rest = pdf.iloc[start[-1] :]
        if rest is not None:
            yield from _pairs(rest, np.array([0, len(rest)]), all_links)

    most = SHORT // 2 * payload_bytes(entries)
    pairs = gathered(ordered, most).mapInPandas(tidy(pair), "a bigint, na bigint, b bigint, nb bigint")
    return gathered(_oriented(pairs), most)


def _pairs(pdf: pd.DataFrame, start: np.ndarray, all_links: bool):
    """Pairs of short lists, those of a length at a time."""
    kind, n, component = (pdf[c].to_numpy() for c in ("class", "n", "component"))
    left = n - pdf["place"].to_numpy()  # what a set has from this shingle on
    many = np.diff(start)
    for length in np.unique(many):
        begin = start[:-1][many == length]
        first, second = np.triu_indices(length, 1)
        step = max(1, 500_000 // max(1, len(first)))
        for some in range(0, len(begin) if len(first) else 0, step):
            i = (begin[some : some + step, None] + first).ravel()
            j = (begin[some : some + step, None] + second).ravel()
            good = (n[i] * 100 >= n[j] * PERCENT) & (kind[i] != kind[j])
            good &= np.minimum(left[i], left[j]) >= least_overlap(n[i] + n[j])
            if not all_links:
                good &= component[i] != component[j]
            if good.any():
                i, j = i[good], j[good]
                yield pd.DataFrame({"a": kind[i], "na": n[i], "b": kind[j], "nb": n[j]})


def links_in_long_lists(found: Sets, entries: DataFrame, all_links: bool) -> DataFrame:
    """Links between the classes of the long lists, whose sets are compared list by list.

    A list is cut into parts by a hash, and each two parts meet in a task, which
    returns no pair but links: a tree over the components that they join up, or all.
    """
    long_ = entries.where(F.col("many") > SHORT)
    own = F.pmod(F.xxhash64("class", "shingle"), F.col("parts")).cast("int")
    dealt = long_.withColumn("parts", (1 + F.floor(F.col("many") / LIST)).cast("int")).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(
        "shingle", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "n", "place", "class",
        "component", "own",
    )
    key = ["shingle", "i", "j"]
    columns = [*key, "class", "n", "place", "component", "own"]

    def by_list(judge):
        """``judge`` over each list's rows, which may go on in the next batch."""

        def lists(batches):
            rest: list[pa.RecordBatch] = []
            last = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = np.column_stack([batch.column(c).to_numpy() for c in range(3)])
                start = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
                for a, b in zip(start, np.r_[start[1:], len(keys)], strict=True):
                    if last is not None and tuple(keys[a]) != last:
                        yield from judge(pa.Table.from_batches(rest), all_links)
                        rest = []
                    last = tuple(keys[a])
                    # Copied, so that a list's rows don't hold the batch they came in.
                    rest.append(batch.take(pa.array(np.arange(a, b))))
            if rest:
                yield from judge(pa.Table.from_batches(rest), all_links)

        return tidy(lists)

    def beside(rows: DataFrame, sets_: DataFrame, name: str, most: int) -> DataFrame:
        met = rows.join(sets_, "class").repartition(*key)
        return gathered(met.sortWithinPartitions(*key, "n", "class").select(*columns, name), most)

    kinds = "shingle bigint, i int, j int, class bigint, n bigint, place int, component bigint, own int"
    # A row travels with its prefix or set, and is compared with the others of its list.
    size = payload_bytes(entries)
    prefixes = found.prefixes(sized(dealt.select("class").distinct(), entries))
    likely = beside(dealt, prefixes, "prefix", 16 * size).mapInArrow(by_list(_likely), kinds)
    likely = found.keep(write_table(likely, "likely"))
    size = payload_bytes(likely)
    members = found.whole(sized(likely.select("class").distinct(), likely))
    met = beside(likely, members, "members", 16 * size + 4 * payload_bytes(members))
    links = _oriented(met.mapInArrow(by_list(_links), "a bigint, na bigint, b bigint, nb bigint"))
    links = write_table(gathered(links, size * (LIST if all_links else 1)), "long-links")
    found.drop()
    return links


def _several(lists: pa.ChunkedArray, upto: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Who holds which of the values that several of the lists hold, by value; of each list its first ones, if told."""
    lists = lists.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    many = lists.value_lengths().to_numpy()
    owner, values = np.repeat(np.arange(len(many)), many), lists.flatten().to_numpy()
    if upto is not None:
        place = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        early = place < upto[owner]
        owner, values = owner[early], values[early]
    column, times = np.unique(values, return_inverse=True, return_counts=True)[1:]
    several = times[column] > 1
    owner, column = owner[several], np.unique(column[several], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    return owner[order], column[order]


def _blocks(n: int, owner: np.ndarray, column: np.ndarray) -> Iterator[np.ndarray]:
    """Who holds what as matrices of COLUMNS values each."""
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        some = slice(np.searchsorted(column, low), np.searchsorted(column, low + COLUMNS))
        held = np.zeros((n, COLUMNS), dtype=np.float32)
        held[owner[some], column[some] - low] = 1
        yield held


def _likely(table: pa.Table, all_links: bool) -> Iterator[pa.RecordBatch]:
    """The rows of a list, sorted by size, that have a partner for whose pair the list is the first
    common one, and for which what they share of their prefixes and what lies beyond is enough."""
    kind, n, place, component, own = (table.column(c).to_numpy() for c in ("class", "n", "place", "component", "own"))
    across = table.column("i")[0].as_py() != table.column("j")[0].as_py()
    prefixes = [np.asarray(x) for x in table.column("prefix").to_numpy()]
    shared, before = (np.zeros((len(n), len(n)), dtype=np.float32) for _ in range(2))
    for held in _blocks(len(n), *_several(table.column("prefix"))):
        shared += held @ held.T
    for held in _blocks(len(n), *_several(table.column("prefix"), place)):
        before += held @ held.T
    ends = np.array([x[-1] for x in prefixes])
    # What each set has beyond the end of the other's prefix, or of its own if that comes first.
    beyond = np.array([n[a] - np.searchsorted(x, ends, "right") for a, x in enumerate(prefixes)])
    shared += np.minimum(beyond, beyond.T)
    good = np.zeros(len(n), dtype=bool)
    for a in range(len(n)):
        pair = (before[a] == 0) & (shared[a] >= least_overlap(n[a] + n)) & (kind != kind[a])
        if across:
            pair &= own != own[a]
        if not all_links:
            pair &= component != component[a]
        good[a] = pair.any()
    yield from table.filter(pa.array(good)).drop_columns(["prefix"]).combine_chunks().to_batches()


def _links(table: pa.Table, all_links: bool) -> Iterator[pa.RecordBatch]:
    """Links of one list, sorted by size; blocks that can have none are skipped."""
    kind, n, place, component, own = (table.column(c).to_numpy() for c in ("class", "n", "place", "component", "own"))
    across = table.column("i")[0].as_py() != table.column("j")[0].as_py()
    shared = np.zeros((len(n), len(n)), dtype=np.float32)
    for held in _blocks(len(n), *_several(table.column("members"))):
        starts = np.arange(0, len(n), BLOCK)
        left = np.maximum.reduceat(n - place, starts)
        for a in range(len(starts)):
            rows = slice(starts[a], starts[a] + BLOCK)
            # Later blocks hold larger sets, up to those that are too large; and of a
            # block that has too little left from this shingle on, none is linked.
            most = n[min(len(n), starts[a] + BLOCK) - 1] * 100 // PERCENT
            end = int(np.searchsorted(n, most, "right"))
            if left[a] < least_overlap(2 * n[starts[a]]):
                continue
            shared[rows, starts[a] : end] += held[rows] @ held[starts[a] : end].T
    linked = np.zeros(shared.shape, dtype=bool)
    for a in range(len(n)):
        good = shared[a, a + 1 :] >= least_overlap(n[a] + n[a + 1 :])
        good &= kind[a + 1 :] != kind[a]
        if across:
            good &= own[a + 1 :] != own[a]
        if not all_links:
            good &= component[a + 1 :] != component[a]
        linked[a, a + 1 :] = good
    del shared
    if all_links:
        first, second = np.nonzero(linked)
    else:
        linked |= linked.T
        first, second = _tree(linked, component)
    if len(first):
        columns = [kind[first], n[first], kind[second], n[second]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "na", "b", "nb"])


def _tree(linked: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links, enough to join up all components that they join up."""
    same = {c: np.flatnonzero(component == c) for c in np.unique(component)}
    reached: set[int] = set()
    first, second = [], []
    for c in same:
        if c in reached:
            continue
        reached.add(c)
        queue = list(same[c])
        while queue:
            i = queue.pop()
            for j in np.flatnonzero(linked[i]):
                if component[j] not in reached:
                    reached.add(component[j])
                    first.append(i)
                    second.append(j)
                    queue.extend(same[component[j]])
    return np.array(first, dtype=np.int64), np.array(second, dtype=np.int64)


@dataclass
class Sets:
    """The described documents, and ways to fetch prefixes and whole sets of some classes.

    Tables that are written on the way are kept until ``drop``, which is for when the
    results that come of them are written.
    """

    docs: DataFrame
    described: DataFrame
    held: list[DataFrame] = field(default_factory=list)

    def keep(self, table: DataFrame) -> DataFrame:
        self.held.append(table)
        return table

    def drop(self) -> None:
        while self.held:
            drop_table(self.held.pop())

    def prefixes(self, needed: DataFrame) -> DataFrame:
        """(class, prefix) of some classes; ``needed`` is of known size."""
        needed = self.keep(write_table(gathered(needed, payload_bytes(needed)), "classes"))
        some = self.described.where("prefix IS NOT NULL").select("class", "prefix")
        return lookup_join(some, needed, "class", "left_semi").dropDuplicates(["class"])

    def _classes(self, pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
        return sized(both.distinct(), pairs)

    def _beside(self, pairs: DataFrame, own: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(own.select(F.col("class").alias(side), F.col(column).alias(f"{column}_{side}")), side)
        return pairs

    def most(self, pairs: DataFrame) -> DataFrame:
        """Pairs with ``most``, the largest overlap that their prefixes allow.

        Up to the smaller of the prefixes' ends both sets are known.
        """
        beside = self._beside(pairs, self.prefixes(self._classes(pairs)), "prefix")
        end = F.least(F.element_at("prefix_a", -1), F.element_at("prefix_b", -1))
        beyond = [
            F.col(f"n{s}") - F.size(F.filter(f"prefix_{s}", lambda x: x <= F.col("_end"))) for s in ("a", "b")
        ]
        shared = F.size(F.array_intersect("prefix_a", "prefix_b"))
        told = (
            beside.withColumn("_end", end)
            .withColumn("most", (shared + F.least(*beyond)).cast("bigint"))
            .select(*pairs.columns, "most")
        )
        return gathered(told, payload_bytes(pairs) + 4 * payload_bytes(self.described))

    def whole(self, needed: DataFrame) -> DataFrame:
        """(class, members): the sets of some classes, each from one document's text; ``needed`` is of known size."""
        needed = self.keep(write_table(gathered(needed, payload_bytes(needed)), "classes"))
        chosen = lookup_join(self.described.select("class", "key"), needed, "class")
        chosen = chosen.groupBy("class").agg(F.min("key").alias("key")).select("key")
        chosen = self.keep(write_table(gathered(chosen, payload_bytes(needed)), "chosen"))
        named = self.docs.select(document_key(self.docs).alias("key"), "text")

        def shingle(batches):
            shingler = Shingler()
            for batch in batches:
                for _, hashes, starts in shingler.sets(batch.column(1)):
                    found = [hashes[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
                    columns = [pa.array([class_of(x) for x in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, ["class", "members"])

        some = lookup_join(named, chosen, "key", "left_semi").select("key", "text")
        some = some.mapInArrow(tidy(shingle), "class bigint, members array<bigint>")
        some = self.keep(write_table(some, "members"))
        return sized(some.dropDuplicates(["class"]), some)

    def overlap(self, pairs: DataFrame) -> DataFrame:
        """Pairs with ``overlap``, found from the whole sets of the classes they name."""
        members = self.whole(self._classes(pairs))
        beside = self._beside(pairs, members, "members")
        shared = F.size(F.array_intersect("members_a", "members_b")).cast("bigint")
        found = beside.select(*pairs.columns, shared.alias("overlap"))
        return gathered(found, payload_bytes(pairs) + 4 * payload_bytes(members))

    def compare(self, pairs: DataFrame) -> DataFrame:
        """The linked ones of the pairs, with their overlap."""
        need = _least(F.col("na") + F.col("nb"))
        likely = self.keep(write_table(self.most(pairs).where(F.col("most") >= need).drop("most"), "likely"))
        links = write_table(self.overlap(likely).where(F.col("overlap") >= need), "links")
        self.drop()
        return links


def by_reference(found: Sets, pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The linked ones of the pairs, by the answers of sets that theirs are linked to.

    With r a's reference and s b's: what a and b share is at most what r and s share
    and what a has beyond r and b beyond s, and at least what r and s share less what
    a lacks of r and b of s.
    """
    best = links.groupBy(F.col("b").alias("class")).agg(F.min(F.struct("a", "na", "overlap")).alias("best"))
    best = best.select("class", F.col("best.a").alias("r"), F.col("best.na").alias("nr"), "best.overlap")
    best = write_table(gathered(best, payload_bytes(links)), "references")
    told = pairs
    for side in ("a", "b"):
        renamed = best.select(
            F.col("class").alias(side), F.col("r").alias(f"r{side}"), F.col("nr").alias(f"nr{side}"),
            F.col("overlap").alias(f"o{side}"),
        )
        told = lookup_join(told, renamed, side, "left")
        told = told.withColumns(
            {
                f"r{side}": F.coalesce(f"r{side}", side),
                f"nr{side}": F.coalesce(f"nr{side}", f"n{side}"),
                f"o{side}": F.coalesce(f"o{side}", f"n{side}"),
            }
        )
    swap = F.col("ra") > F.col("rb")
    told = told.select(
        "a", "na", "b", "nb",
        F.least("ra", "rb").alias("ra"),
        F.greatest("ra", "rb").alias("rb"),
        F.when(swap, F.col("nrb")).otherwise(F.col("nra")).alias("nra"),
        F.when(swap, F.col("nra")).otherwise(F.col("nrb")).alias("nrb"),
        (F.col("na") - F.col("oa") + F.col("nb") - F.col("ob")).alias("beyond"),
        (F.col("nra") - F.col("oa") + F.col("nrb") - F.col("ob")).alias("lacking"),
        _least(F.col("na") + F.col("nb")).alias("need"),
    )
    told = found.keep(write_table(told, "referred"))
    keys = ["ra", "rb"]
    # Sets with one reference share at most its size.
    asked = told.where("ra < rb").groupBy("ra", "rb").agg(
        F.first("nra").alias("na"), F.first("nrb").alias("nb"), F.min(F.col("need") - F.col("beyond")).alias("enough")
    ).withColumnsRenamed({"ra": "a", "rb": "b"})
    size = payload_bytes(told)
    open_ = found.most(found.keep(write_table(gathered(asked, size), "asked"))).where("most >= enough").drop("most", "enough")
    answers = found.overlap(found.keep(write_table(open_, "open"))).select(
        F.col("a").alias("ra"), F.col("b").alias("rb"), F.col("overlap").alias("shared")
    )
    same = told.where("ra = rb").select("a", "na", "b", "nb", "beyond", "lacking", "need", F.col("nra").alias("shared"))
    judged = told.where("ra < rb").join(answers, keys).select(*same.columns).unionByName(same)
    judged = judged.where(F.col("shared") + F.col("beyond") >= F.col("need"))
    judged = write_table(gathered(judged, size), "judged")
    found.drop()
    columns = ["a", "na", "b", "nb"]
    sure = judged.where(F.col("shared") - F.col("lacking") >= F.col("need")).select(*columns)
    unsure = judged.where(F.col("shared") - F.col("lacking") < F.col("need")).select(*columns)
    if unsure.isEmpty():
        return sure
    return sure.unionByName(found.compare(sized(unsure, judged)).select(*columns))


def components(links: DataFrame) -> DataFrame:
    """(class, root) of every class that has a link; the root is the component's smallest class.

    Tasks first join up the links they hold, then JOINED of the edges that are left, about.
    If several tasks did that, every node's larger neighbours, and in turn its smaller
    ones, are tied to the smallest of all, until that changes nothing.
    """

    def join_up(batches):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for pdf in batches:
            for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = np.fromiter(parent, np.int64, len(parent))
        roots = np.fromiter(map(root, nodes.tolist()), np.int64, len(nodes))
        tied = nodes != roots
        yield pd.DataFrame({"u": nodes[tied], "v": roots[tied]})

    def joined_up(pairs: DataFrame) -> DataFrame:
        return write_table(pairs.mapInPandas(tidy(join_up), "u bigint, v bigint"), "edges")

    edges = joined_up(links.select("a", "b"))
    tasks = -(-edges.count() // JOINED)
    edges = joined_up(edges.select(F.col("u").alias("a"), F.col("v").alias("b")).coalesce(max(1, tasks)))
    state, now = None, () if tasks > 1 else None
    while now != state:
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = write_table(smaller.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return edges.select(F.col("u").alias("class"), F.col("v").alias("root"))


@dataclass
class Join:
    """Every document with its class (doc_id, key, class, n), links between classes, and components."""

    members: DataFrame
    links: DataFrame  # a, na, b, nb
    nodes: DataFrame  # class, root


def join(docs: DataFrame, all_links: bool = False) -> Join:
    """The links that hold the components together, or all of them."""
    bound_batches(docs.sparkSession)
    described = sets(docs)
    lists = index(described)
    found = Sets(docs, described)
    columns = ["a", "na", "b", "nb"]
    links = found.compare(found.keep(write_table(neighbours(lists), "neighbours")))
    nodes = components(links)
    entries = open_lists(lists, nodes, all_links)
    pairs = write_table(candidates(entries, all_links), "candidates")
    more = links_in_long_lists(found, entries, all_links)
    size = payload_bytes(more) + payload_bytes(pairs)
    if not pairs.isEmpty():
        more = more.unionByName(by_reference(found, pairs, links))
    more = gathered(more.distinct(), size)
    if all_links:
        more = more.join(links.select("a", "b"), ["a", "b"], "left_anti").select(*columns)
    more = write_table(more, "more-links")
    if not more.isEmpty():
        tied = nodes.select(F.col("class").alias("a"), F.col("root").alias("b"))
        nodes = components(tied.unionByName(more.select("a", "b")))
    links_all = links.select(*columns).unionByName(more)
    return Join(described.select("doc_id", "key", "class", "n"), links_all, nodes)


def labelled(found: Join) -> DataFrame:
    """(doc_id, key, class, n, root): every document with its component's root class; empty sets have none."""
    tied = lookup_join(found.members, found.nodes, "class", "left")
    return tied.withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "class")))


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    named = write_table(labelled(join(docs)), "labelled")
    first = named.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("many"))
    # Only components of several documents are looked up.
    first = write_table(gathered(first.where("many > 1").drop("many"), payload_bytes(named)), "firsts")
    return lookup_join(named, first, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("component_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The documents, one of each component: that with the smallest doc_id, of repeated rows one."""
    named = write_table(labelled(join(docs)), "labelled")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    kept = named.where("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("kept")).select("kept.key")
    kept = kept.unionByName(named.where("root IS NULL").select("key"))
    once = named.groupBy("key").agg(F.count("*").alias("many"), F.max("n").alias("n"))
    kept = write_table(gathered(lookup_join(kept.distinct(), once, "key"), payload_bytes(named)), "kept")
    keyed = docs.select(document_key(docs).alias("key"), F.struct("*").alias("document"))
    single = lookup_join(keyed, kept.where("many = 1 OR n = 0").select("key"), "key", "left_semi")
    repeated = kept.where("many > 1 AND n > 0").select("key")
    if repeated.isEmpty():
        return single.select("document.*")
    again = lookup_join(keyed, repeated, "key", "left_semi").dropDuplicates(["key"])
    return single.unionByName(again).select("document.*")
