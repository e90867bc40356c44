"""Fill-in-middle: a document cut into prefix, middle and suffix, and put in another order.

Cuts fall between units (lines or characters), chosen by hashes of the seed and the id.
Lines are found in the bytes, lengths are told in code points, and characters are cut
where their bytes are, so both kinds of place are needed. A sparse index converts them:
it records only multibyte characters, their positions and the bytes they have beyond
one. A place is converted by a binary search among those, and text between them, all
of it if it is ASCII, is arithmetic.

Null text counts as empty, and an empty text stays plain; so does one that contains a
mark. A null id is hashed as no digits. Rows with one id are cut by the same hashes;
repeated rows give equal rows. An empty table gives no rows. Columns besides the id and
the text are left out. Rows are independent of each other: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamrank.llm.batches import bound_batches, tidy
from roamrank.llm.texts import buffer_of

#: What stands before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
CUT = "struct<n:bigint,head:bigint,tail:bigint,prefix_chars:bigint,middle_chars:bigint>"


@dataclass(frozen=True)
class Recipe:
    """``percent`` of the documents are transformed, ``spm_percent`` of those suffix first."""

    seed: int = 7
    unit: str = "line"
    percent: int = 100
    spm_percent: int = 50
    marks: tuple[str, str, str] = MARKS

    def __post_init__(self) -> None:
        if self.unit not in ("line", "char"):
            raise ValueError(f"unknown unit {self.unit!r}")
        for a in self.marks:
            for b in self.marks:
                met = any(a.endswith(b[:n]) for n in range(1, len(b))) or (a is not b and b in a)
                if not a or met:
                    raise ValueError(f"marks must not be empty or overlap: {a!r}, {b!r}")


class SparseIndex:
    """The multibyte characters of UTF-8 bytes: where they begin, and the excess bytes before each."""

    def __init__(self, data: np.ndarray) -> None:
        self.places = np.flatnonzero(data >= 0xC0)
        lead = data[self.places]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate([[0], np.cumsum(excess)])
        self.points = self.places - self.before[:-1]

    def to_points(self, at: np.ndarray) -> np.ndarray:
        """Code points before the bytes' places, which are between characters."""
        return at - self.before[np.searchsorted(self.places, at)]

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        """Bytes before as many code points."""
        return points + self.before[np.searchsorted(self.points, points)]


def cuts(texts: pa.Array, first: np.ndarray, second: np.ndarray, unit: str) -> pa.StructArray:
    """For each text: its units, and where prefix and middle end, in bytes and in code points."""
    data, starts, ends = buffer_of(texts)
    index = SparseIndex(data)
    begin, finish = index.to_points(starts), index.to_points(ends)
    if unit == "char":
        n = finish - begin
    else:
        breaks = np.flatnonzero(data == 10)
        own, until = np.searchsorted(breaks, starts), np.searchsorted(breaks, ends)
        n = until - own
        some = ends > starts
        n[some] += data[ends[some] - 1] != 10
    a, b = first % (n + 1), second % (n + 1)
    a, b = np.minimum(a, b), np.maximum(a, b)

    def placed(units: np.ndarray) -> np.ndarray:
        if unit == "char":
            return index.to_bytes(begin + units)
        if not len(breaks):
            return np.where(units > 0, ends, starts)
        line = breaks[np.clip(own + units - 1, 0, len(breaks) - 1)] + 1
        return np.where(units == 0, starts, np.where(own + units > until, ends, line))

    head, tail = placed(a), placed(b)
    points = index.to_points(head), index.to_points(tail)
    columns = [n, head - starts, tail - starts, points[0] - begin, points[1] - points[0]]
    return pa.StructArray.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["n", "head", "tail", "prefix_chars", "middle_chars"]
    )


def _cutter(unit: str) -> Callable:
    def cut(batches):
        for texts, first, second in batches:
            yield cuts(texts, first.to_numpy(zero_copy_only=False), second.to_numpy(zero_copy_only=False), unit)

    run = tidy(cut)

    def cutter(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from run(batches)

    return F.arrow_udf(cutter, CUT)


def _draw(key: str, seed: int, number: int) -> Column:
    """The id's number-th draw: eight hex digits of its hash, as a number."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    digest = F.sha2(named.cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("bigint")


def transform(docs: DataFrame, recipe: Recipe = Recipe(), key: str = "doc_id") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output): form is plain, psm or spm.

    Lengths are code points, null for a plain text, whose output is the text itself.
    """
    bound_batches(docs.sparkSession)
    p, s, m = (F.lit(mark).cast("binary") for mark in recipe.marks)
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = F.lit(False)
    for mark in recipe.marks:
        marked = marked | F.contains(F.col("_text"), F.lit(mark))
    plain = (F.col("_text") == "") | marked | (_draw(key, recipe.seed, 3) % 100 >= recipe.percent)
    form = F.when(plain, "plain").when(_draw(key, recipe.seed, 4) % 100 < recipe.spm_percent, "spm").otherwise("psm")
    raw = F.col("_text").cast("binary")
    cut = _cutter(recipe.unit)(raw, _draw(key, recipe.seed, 1), _draw(key, recipe.seed, 2))
    found = docs.select(F.col(key), text.alias("_text")).withColumn("form", form).withColumn("_cut", cut)
    head, tail = F.col("_cut.head").cast("int"), F.col("_cut.tail").cast("int")
    prefix = F.substr(raw, F.lit(1), head)
    middle = F.substr(raw, head + 1, tail - head)
    suffix = F.substr(raw, tail + 1, F.octet_length(raw) - tail)
    output = (
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(raw)
    )
    moved = F.col("form") != "plain"
    return found.select(
        key,
        F.col("_cut.n").alias("n"),
        "form",
        F.when(moved, F.col("_cut.prefix_chars")).alias("prefix_chars"),
        F.when(moved, F.col("_cut.middle_chars")).alias("middle_chars"),
        output.cast("string").alias("output"),
    )


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text before ``transform``, from its output and form alone.

    Marks don't overlap and stand nowhere else in a transformed text, so each is where
    it is found.
    """
    p, s, m = marks
    before, after = F.substring_index(output, m, 1), F.substring_index(output, m, -1)

    def tail(mark: str, whole: Column) -> Column:
        return F.substring_index(whole, mark, -1)

    psm = F.concat(tail(p, F.substring_index(before, s, 1)), after, tail(s, before))
    spm = F.concat(tail(p, before), after, tail(s, F.substring_index(before, p, 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
