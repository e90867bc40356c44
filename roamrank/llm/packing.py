"""Best-two-fit packing of tokenized documents into sequences of fixed length.

A bin is filled greedily, largest piece first. Then its smallest piece is put back
if two other unpacked pieces fill the space, that piece's included, more tightly.
Which bins arise depends only on how many pieces there are of each length, so the
packing is worked out from that histogram (one number for each length up to the
capacity, whatever the corpus), a whole run of equal bins at a time. Each piece then
finds its place by its rank among the pieces of its length, and ranks come from
counts of bounded buckets, so no length, however frequent, is in one task, and no
row that is repeated: buckets depend on the place of a row in its written table, too.

Null text counts as empty; a document without tokens is its end token. Null and
repeated ids are packed like others, one row each; equal pieces may swap places.
An empty table gives no rows. Input columns besides doc_id and text are left out.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from roamrank.llm.batches import bound_batches, give_back, tidy
from roamrank.workspace import write_table

CAPACITY = 2048
END = 0
#: Pieces of a length that are ranked together, about.
BUCKET = 20_000
#: Parts of words that a task's tokenizer remembers before it starts over, and how many it learns at a time.
PARTS, TOGETHER = 400_000, 1_000
#: Characters from which on a word isn't remembered.
LONG = 200

# Basic Latin and Latin-1 letters, and ASCII signs but the apostrophe: a run of the
# former, then one of the latter, are tokens of their own, and neither changes under NFC.
LETTERS = "".join(c for c in map(chr, [*range(65, 91), *range(97, 123), *range(192, 256)]) if c not in "×÷")
SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
PLAIN = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[!-&(-/:-@\[-`{-~]*$"
# The characters of Unicode's White_Space property.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACES = re.compile("[" + "".join(map(chr, WHITE)) + "]+")
# White space to Arrow, but not to the tokenizer.
ODD = r"[\x1c-\x1f]"


def _gather(pool: np.ndarray, lengths: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``pool``, which lie there one after another, in the order ``taken``, and where each ends."""
    starts = np.cumsum(lengths) - lengths
    many = lengths[taken]
    ends = np.cumsum(many)
    kind = np.int32 if max(len(pool), many.sum()) < 1 << 31 else np.int64
    at = np.repeat((starts[taken] - (ends - many)).astype(kind), many)
    at += np.arange(len(at), dtype=kind)
    return pool[at], ends


class Encoder:
    """Texts to token ids, as little-endian 32-bit words.

    The tokenizer drops white space and works on each word alone, so only the different
    words of a batch are looked at, and of these the different parts: letters in lower
    case and the signs after them. The ids of parts are remembered. New parts go straight
    to the tokenizer's model, many at a time, words of any other form through all of it.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.parts: dict[str, bytes] = {"": b""}
        # The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
        # others in order for the characters from 256. Spaces go between parts.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.alphabet = {b: chr(256 + i) for i, b in enumerate(hidden) if b != 32}

    def _learn(self, parts: list[str]) -> Iterator[bytes]:
        """Ids of letters in lower case, and of signs."""
        for first in range(0, len(parts), TOGETHER):
            some = parts[first : first + TOGETHER]
            spelled = " ".join(some)
            if not spelled.isascii():
                spelled = spelled.encode().decode("latin-1").translate(self.alphabet)
            found = self.model.encode(spelled, add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4").tobytes()
            ends = 4 * (np.flatnonzero(np.diff(found.word_ids, append=-1)) + 1)
            start = 0
            for _, end in zip(some, ends.tolist(), strict=True):
                yield ids[start:end]
                start = end

    def _ids(self, parts: list[str], whole: set[int]) -> list[bytes]:
        """Ids of each part; those numbered in ``whole`` are words for the whole tokenizer."""
        found = list(map(self.parts.get, parts))
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(self.parts) + len(new) > PARTS:
            self.parts = {"": b""}
        plain = [i for i in new if i not in whole] if whole else new
        for i, ids in zip(plain, self._learn([parts[i] for i in plain]), strict=True):
            found[i] = self.parts[parts[i]] = ids
        for i in whole.intersection(new):
            ids = self.tokenizer.encode(parts[i], add_special_tokens=False).ids
            found[i] = np.array(ids, dtype="<u4").tobytes()
            if len(parts[i]) < LONG:
                self.parts[parts[i]] = found[i]
        return found

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; null is empty."""
        texts = pc.fill_null(texts, "")
        if pc.any(pc.match_substring_regex(texts, ODD)).as_py():
            split = pa.array([SPACES.split(text) for text in texts.to_pylist()], pa.list_(texts.type))
        else:
            split = pc.utf8_split_whitespace(texts)
        told, offsets = split.values.dictionary_encode(), split.offsets.to_numpy()
        del split
        words = told.dictionary
        plain = pc.and_(pc.match_substring_regex(words, PLAIN), pc.less(pc.utf8_length(words), LONG))
        letters = pc.if_else(plain, pc.utf8_lower(pc.utf8_rtrim(words, SIGNS)), words)
        signs = pc.if_else(plain, pc.utf8_ltrim(words, LETTERS), "")
        parts = pa.concat_arrays([letters, signs]).dictionary_encode()
        first, second = parts.indices.to_numpy().reshape(2, -1)
        whole = set(first[~plain.to_numpy(zero_copy_only=False)].tolist())
        found = self._ids(parts.dictionary.to_pylist(), whole)

        pool = np.frombuffer(b"".join(found), dtype="<u4")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool, ends = _gather(pool, lengths, np.stack([first, second], axis=1).ravel())
        pool, ends = _gather(pool, np.diff(ends[1::2], prepend=0), told.indices.to_numpy())
        ids = pool.tobytes()
        bounds = (4 * np.concatenate([[0], ends])[offsets]).tolist()
        return [ids[start:end] for start, end in pairwise(bounds)]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """Each document's ids and the end token, cut where longer than ``capacity``.

    ``tokenizer`` is the path of a word-BPE file; ``ids`` holds 32-bit little-endian ids.
    """
    bound_batches(docs.sparkSession)
    size = 4 * capacity

    def cut(batches):
        encoder = Encoder(tokenizer)
        give_back()  # what reading the tokenizer's file needed
        for batch in batches:
            rows = []
            for row, ids in enumerate(encoder.encode_all(batch.column("text"))):
                ids += struct.pack("<I", END)
                for piece, at in enumerate(range(0, len(ids), size)):
                    part = ids[at : at + size]
                    rows.append((row, piece, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            if rows:
                row, piece, start, length, crc32, part = zip(*rows, strict=True)
                columns = {
                    "doc_id": batch.column("doc_id").take(pa.array(row)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc32, pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(part, pa.binary())} if keep_ids else {}))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return docs.select("doc_id", "text").mapInArrow(tidy(cut), schema)


@dataclass
class Bins:
    """``many`` equal bins from sequence number ``first``: lengths, how often each, and where it begins."""

    first: int
    many: int
    lengths: list[int]
    times: list[int]
    offsets: list[int]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Bins]:
    """Pack a histogram of lengths, a run of equal bins at a time."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    bins, first = [], 0
    while left.any():
        here, gap = {}, capacity
        free = np.flatnonzero(left)
        while gap:
            i = int(np.searchsorted(free, gap, "right")) - 1
            if i < 0:
                break
            length = int(free[i])
            k = min(gap // length, int(left[length]))
            here[length], gap = k, gap - k * length
            free = free[:i]
        if len(here) > 1 or sum(here.values()) > 1:
            here, gap = _two_for_one(here, gap, left)
        many = min(int(left[length]) // k for length, k in here.items())
        offset, offsets = 0, []
        for length, k in here.items():
            offsets.append(offset)
            offset += length * k
            left[length] -= k * many
        bins.append(Bins(first, many, list(here), list(here.values()), offsets))
        first += many
    return bins


def _two_for_one(here: dict[int, int], gap: int, left: np.ndarray) -> tuple[dict[int, int], int]:
    """Replace the smallest piece of a bin by the two unpacked ones that fill its space best, if they fill it better."""
    smallest = min(here)
    room = gap + smallest
    unpacked = left.copy()
    for length, k in here.items():
        unpacked[length] -= k
    free = np.flatnonzero(unpacked[: room + 1])
    if not gap or not free.size:
        return here, gap
    at = np.searchsorted(free, room - free, "right") - 1
    # Two of one length need two of it; else the next shorter one is the partner.
    own = (at >= 0) & (free[at] == free) & (unpacked[free] < 2)
    at = np.where(own, at - 1, at)
    total = np.where(at >= 0, free + free[at], 0)
    best = int(np.argmax(total))
    if total[best] <= smallest:
        return here, gap
    swapped = dict(here)
    swapped[smallest] -= 1
    if not swapped[smallest]:
        del swapped[smallest]
    for length in (int(free[best]), int(free[at[best]])):
        swapped[length] = swapped.get(length, 0) + 1
    return swapped, room - int(total[best])


def _places(bins: list[Bins], capacity: int):
    """For each length the ranks at which a run of bins begins, and how those bins hold it."""
    found: list[list[tuple[int, int, int, int]]] = [[] for _ in range(capacity + 1)]
    used = [0] * (capacity + 1)
    for b in bins:
        for length, k, offset in zip(b.lengths, b.times, b.offsets, strict=True):
            found[length].append((used[length], b.first, k, offset))
            used[length] += b.many * k
    return {length: np.array(rows, dtype=np.int64).T for length, rows in enumerate(found) if rows}


def _bucket(buckets: int) -> Column:
    """Where a piece is ranked. Equal rows differ in where they lie, which is the same at each reading."""
    lies = (F.col("_metadata.file_name"), F.floor(F.col("_metadata.row_index") / BUCKET))
    return F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", *lies), F.lit(buckets))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece a ``sequence_id`` and its ``offset`` there; ``cut`` has the columns of ``pieces``.

    ``cut`` is read three times, so it has to be a table of ``write_table``.
    """
    # One row for each length, at most ``capacity`` of them, comes to the driver.
    counts = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(plan(counts, capacity), capacity)
    buckets = 1 + sum(counts.values()) // BUCKET
    dealt = cut.withColumn("_bucket", _bucket(buckets))
    sizes = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(inside) - 1).join(offsets, ["length", "_bucket"])

    def placed_at(length: np.ndarray, rank: np.ndarray) -> pd.DataFrame:
        out = np.zeros((2, len(length)), dtype=np.int64)
        for value in np.unique(length):
            mine = np.flatnonzero(length == value)
            start, first, times, offset = places[int(value)]
            run = np.searchsorted(start, rank[mine], "right") - 1
            bin_, slot = np.divmod(rank[mine] - start[run], times[run])
            out[0, mine] = first[run] + bin_
            out[1, mine] = offset[run] + slot * value
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        try:
            for lengths, ranks in batches:
                yield placed_at(lengths.to_numpy(), ranks.to_numpy())
        finally:
            give_back()

    placed = ranked.withColumn("_place", place("length", F.col("_before") + F.col("_rank")))
    return placed.select(*cut.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """Tokenize, cut and pack; the pieces are written once, to the shared folder."""
    return pack(write_table(pieces(docs, tokenizer, capacity, keep_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row for each sequence: its ids in order, and where each of its pieces begins."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    gathered = packed.groupBy("sequence_id").agg(parts.alias("_parts"))
    joined = F.aggregate(
        F.transform("_parts", lambda p: F.hex(p["ids"])), F.lit(""), lambda a, b: F.concat(a, b)
    )
    return gathered.select(
        "sequence_id",
        F.unhex(joined).cast(T.BinaryType()).alias("ids"),
        F.transform("_parts", lambda p: p.dropFields("ids")).alias("pieces"),
    )
