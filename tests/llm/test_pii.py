import hashlib
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roamrank.llm import boosting, pii, queries
from tests.llm.fixtures import awkward, documents

# The four patterns as they are given, searched plainly.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    text = text or ""
    digits = lambda m: [int(c) for c in m.group() if c.isdigit()]

    def luhn(d):
        doubled = [2 * x for x in d[-2::-2]]
        return (sum(d[-1::-2]) + sum(x - 9 if x > 9 else x for x in doubled)) % 10 == 0

    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab.@-+%_ 0123456789()é\n", max_size=60))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(documents(spark, [(1, "nothing here")]))


def test_query_against_plain_patterns(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op1_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_proposed_spans(model):
    text = "call +1 (269) 555-3296 4524132264652876 now, or mail anna at mail dot example dot org"
    found = {text[s:e]: base for _, s, e, base, _ in pii.spans([text], model)[0]}
    assert "+1 (269) 555-3296" in found and "4524132264652876" in found
    assert not any(found.values())  # the strict patterns take one long run of digits and drop it
    assert any("anna" in piece for piece in found)


def test_clean_texts_stay_clean(model):
    clean = ["the version 4.0.1 of 2019-01-02", "order 1234567890123456 at 10:30", "see at the end. dot it", "a+b-c 1 2 3"]
    assert pii.spans(clean, model) == [[], [], [], []]


def test_awkward_rows(spark, model):
    docs = documents(spark, [*awkward(), (9, "a@b.cd"), (9, "a@b.cd")])
    rows = pii.detect(docs, model).collect()
    assert len(rows) == docs.count() and set(docs.columns) == set(rows[0].asDict())
    assert [[s["kind"] for s in r["pii"]] for r in rows if r["doc_id"] == 9] == [["email"], ["email"]]
    assert all(r["pii"] == [] for r in rows if r["doc_id"] != 9)
    text = pii.redact(docs["text"], model)
    assert {r[0] for r in docs.where("doc_id = 9").select(text).collect()} == {"<email>"}
    assert docs.where("doc_id = 2").select(text).first()[0] is None
    assert pii.detect(docs.limit(0)).count() == 0


def test_long_texts_take_linear_time():
    start = time.perf_counter()
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1" + " " * 300_000, "a at b " * 50_000):
        pii.base_spans(text), pii.candidates(text)
    assert time.perf_counter() - start < 20


def test_trees_and_calibration():
    rng = random.Random(1)
    import numpy as np

    x = np.array([[rng.random(), rng.random()] for _ in range(600)])
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.fit(x[:400], y[:400])
    margin = trees.margin(x[400:])
    assert ((margin > 0) == y[400:]).mean() > 0.95
    slope, shift = boosting.platt(margin, y[400:])
    p = 1 / (1 + np.exp(-(slope * margin + shift)))
    cut = boosting.threshold(p, y[400:], 0.98)
    assert y[400:][p >= cut].mean() >= 0.98


def test_parts_of_an_ip_count_by_their_value():
    for zeros in (2, 39, 60, 5000):
        text = f"at {'0' * zeros}1.2.{'0' * zeros}.255 now"
        assert ("ip", 3, len(text) - 4) in pii.base_spans(text), zeros
        assert not any(kind == "ip" for kind, *_ in pii.base_spans(f"at {'0' * zeros}256.2.3.4")), zeros
    assert pii.strict("ip", "255 . 01.0. 7") and not pii.strict("ip", "1 .2.3. 256")
    assert ("ip", 0, 7) in pii.base_spans("0.0.0.0") and pii.base_spans("1000.1.1.1") == []


class _Certain:
    """Takes every candidate, later ones rather than earlier ones."""

    cuts = dict.fromkeys(pii.KINDS, 0.0)

    def score(self, x):
        return np.linspace(0.1, 0.9, len(x))


def test_spans_overlap_nothing_chosen_before():
    rng = random.Random(5)
    pieces = ["555-123-4567", "+1 555 123 4567", "1.2.3.4", "a@b.co", "a at b dot co", "4111 1111 1111 1111", "x", "12"]
    for _ in range(200):
        text = rng.choice([" ", "", "-"]).join(rng.choice(pieces) for _ in range(rng.randrange(1, 12)))
        base = pii.base_spans(text)
        open_ = [c for c in pii.candidates(text) if all(c[2] <= s or c[1] >= e for _, s, e in base)]
        score = _Certain().score(open_)
        taken = []
        for _, (kind, s, e) in sorted(zip(-score, open_), key=lambda c: (c[0], c[1][1], -c[1][2], c[1][0])):
            if all(e <= a or s >= b for _, a, b in taken):
                taken.append((kind, s, e))
        assert sorted(x[:3] for x in pii.spans([text], _Certain())[0]) == sorted([*base, *taken])


def test_many_spans_take_linear_time():
    start = time.perf_counter()
    for piece in ("call 555-123-4567 now, ", "call +1 555 123 4567; ", "+15551234567, 555-123-4567; "):
        assert len(pii.spans([piece * 50_000], _Certain())[0]) >= 50_000
    assert time.perf_counter() - start < 60
