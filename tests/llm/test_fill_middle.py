import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roamrank.llm.fill_middle import MARKS, Recipe, SparseIndex, cuts, restored, transform
from tests.llm.fixtures import awkward, documents
from pyspark.sql import functions as F

ODD = st.text(st.sampled_from("ab\n\r é日😀<PSM>"), max_size=40)


def plainly(doc_id, text, unit="line", percent=100, spm=50):
    """The same by slicing a list of units."""
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in MARKS) or h[2] % 100 >= percent:
        return (doc_id, n, "plain", None, None, text)
    spm_form = h[3] % 100 < spm
    output = f"<S>{s}<P>{p}<M>{m}" if spm_form else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, "spm" if spm_form else "psm", len(p), len(m), output)


@pytest.mark.parametrize("recipe", [Recipe(), Recipe(unit="char"), Recipe(percent=40, spm_percent=0)])
def test_awkward_documents(spark, recipe):
    extra = [(10, "a\nb"), (11, "\n\n"), (12, "né\n日本<P>\n"), (13, "日\n本\n😀\nx"), (14, "<\n<S\n<M"), (15, "\r\n x")]
    rows = awkward() + extra
    made = transform(documents(spark, rows), recipe)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = sorted(map(tuple, made.collect()), key=str)
    want = [plainly(r[0], r[1], recipe.unit, recipe.percent, recipe.spm_percent) for r in rows]
    assert got == sorted(want, key=str)
    back = made.select(restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(r["text"] for r in back) == sorted(r[1] or "" for r in rows)


def test_empty_table(spark):
    assert transform(documents(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD, max_size=5), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1), st.sampled_from(["line", "char"]))
def test_cuts_of_batches(texts, one, two, unit):
    array = pa.array([t.encode() for t in ["skipped", *texts]], pa.binary())[1:]
    first, second = (np.full(len(texts), h, np.int64) for h in (one, two))
    for text, cut in zip(texts, cuts(array, first, second, unit).to_pylist()):
        units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
        a, b = sorted((one % (len(units) + 1), two % (len(units) + 1)))
        head, tail = "".join(units[:a]), "".join(units[:b])
        assert cut["n"] == len(units)
        assert (cut["head"], cut["tail"]) == (len(head.encode()), len(tail.encode()))
        assert (cut["prefix_chars"], cut["middle_chars"]) == (len(head), len(tail) - len(head))


@given(st.text(max_size=60))
def test_index_records_multibyte_characters_alone(text):
    index = SparseIndex(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))
    assert len(index.places) == sum(ord(c) > 127 for c in text)
    points = np.arange(len(text) + 1)
    places = np.cumsum([0, *(len(c.encode("utf-8", "surrogatepass")) for c in text)])
    assert (index.to_bytes(points) == places).all()
    assert (index.to_points(places) == points).all()


def test_marks_that_overlap_are_refused():
    for marks in [("<P>", "<S>", ""), ("aba", "<S>", "<M>"), ("<P>", ">x", "<M>"), ("<P>", "a<P>b", "<M>")]:
        with pytest.raises(ValueError):
            Recipe(marks=marks)
    with pytest.raises(ValueError):
        Recipe(unit="page")
