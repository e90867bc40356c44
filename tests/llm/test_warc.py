import base64
import gzip
import hashlib
import io
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, StringStartsWith
from pyspark.sql.types import StructType

from roamrank.llm import warc

ROWS = [
    (5, "http://a/ö?x y\r\nWARC-Type: none", "<p>same</p>", "clash"),
    (3, None, "<p>same</p>", "clash"),
    (3, "http://again", "<p>same</p>", "clash"),
    (None, "http://null", "<p>same</p>", "clash"),
    (7, "http://e", None, "clash"),
    (8, "http://e", "", "clash"),
    (9, "http://long", "é€ " * 200_000, "clash"),
    (None, "http://lone", "alone", "clash"),
    (10, "http://crlf", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n", "clash"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id bigint, url string, html string, payload string")


@pytest.fixture(scope="module")
def written(pages, tmp_path_factory):
    return warc.write_pages(pages, str(tmp_path_factory.mktemp("w") / "archives"))


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark, written):
    rows = warc.scan(spark, written).withColumn("id", warc.page_id(F.col("record_id"))).collect()
    got = sorted(
        ((r["id"], r["record_type"], r["refers_to"], r["payload_digest"], r["payload_length"]) for r in rows), key=str
    )
    expected = []
    for i, _, html, _ in ROWS:
        n, d = len((html or "").encode()), digest(html)
        first = {"<p>same</p>": 3, None: 7, "": 7}.get(html, i)
        again = i != first
        expected.append((i, "revisit" if again else "response", f"urn:x-page:{first}" if again else None, d, n))
    assert got == sorted(expected, key=str)
    payloads = {r["id"]: r["payload"] for r in rows if r["record_type"] == "response"}
    assert payloads[9].decode() == ROWS[6][2] and payloads[10].decode() == ROWS[8][2] and payloads[7] == b""
    assert all(r["payload"] is None for r in rows if r["record_type"] == "revisit")


def test_files_are_plain_gzip_members(written):
    names = list(pathlib.Path(written).glob("*.warc.gz"))
    text = b"".join(gzip.decompress(p.read_bytes()) for p in names)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS)
    assert b"x%20y%0D%0AWARC-Type" in text


def test_filters_reach_the_reader(spark, written):
    brief = warc.scan(spark, written, "record_id", "record_type", "target_uri")
    asked = brief.where("record_type = 'response' AND target_uri LIKE 'http://l%'")
    assert sorted(r["record_id"] for r in asked.collect()) == ["urn:x-page:", "urn:x-page:9"]
    reader = warc.WarcReader(written, StructType())
    kept = [EqualTo(("record_type",), "response"), StringStartsWith(("target_uri",), "h")]
    other = [GreaterThan(("payload_length",), 3), EqualTo(("payload",), b"")]
    assert list(reader.pushFilters([*kept, *other])) == other
    assert [t[1] for t in reader.tests] == ["record_type", "target_uri"]


class Counting(io.BytesIO):
    """A file that tells how much of it was read."""

    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


def record(i, payload, kind="response"):
    return warc.member(
        warc.record_bytes(
            {"record_id": f"r{i}", "record_type": kind, "target_uri": None, "date": "d", "refers_to": "r0",
             "payload_digest": "X", "payload_length": len(payload), "payload": payload}
        )
    )


def test_unwanted_payloads_are_stepped_over():
    import os

    data = b"".join(record(i, os.urandom(4_000_000)) for i in range(4)) + record(9, b"last")
    file = Counting(data)
    found = list(warc.records(file, lambda h: h["warc-record-id"] == "<r9>", True))
    assert [p for _, p in found] == [b"last"]
    assert file.taken < len(data) / 2  # the rest was never read


def test_foreign_members_without_lengths():
    data = b"".join(gzip.compress(gzip.decompress(record(i, b"x" * 100_000 * i))) for i in range(4))
    found = list(warc.records(io.BytesIO(data), lambda h: h["warc-record-id"] in ("<r1>", "<r3>"), True))
    assert [len(p) for _, p in found] == [100_000, 300_000]


def test_a_broken_archive_is_an_error():
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(record(1, b"abc" * 1000)[:-200]), lambda h: True, True))


def test_empty_table(spark, pages, tmp_path):
    path = warc.write_pages(pages.limit(0), str(tmp_path / "none"))
    assert warc.scan(spark, path).count() == 0


def test_a_second_write_adds_to_the_first(spark, pages, tmp_path):
    path = warc.write_pages(pages, str(tmp_path / "both"))
    warc.write_pages(pages.withColumn("page_id", F.col("page_id") + 100), path)
    assert warc.scan(spark, path).count() == 2 * len(ROWS)
    ids = {r["id"] for r in warc.scan(spark, path).select(warc.page_id(F.col("record_id")).alias("id")).collect()}
    assert {5, 105, 9, 109} <= ids
    next(pathlib.Path(path).glob("*.warc.gz")).unlink()
    with pytest.raises(Exception, match="lacks"):
        warc.scan(spark, path).count()


def test_foreign_responses_with_other_digests_or_none(spark, tmp_path):
    plain = gzip.decompress(record(1, b"body"))
    line = next(x for x in plain.split(b"\r\n") if x.lower().startswith(b"warc-payload-digest"))
    right = b"WARC-Payload-Digest: sha1:" + digest("body").lower().encode()
    others = [plain.replace(line + b"\r\n", b""), plain.replace(line, b"WARC-Payload-Digest: sha256:abc"), plain.replace(line, right)]
    folder = tmp_path / "foreign"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in others))
    got = warc.scan(spark, str(folder)).collect()
    assert [bytes(r["payload"]) for r in got] == [b"body"] * 3
    assert got[0]["payload_digest"] is None and got[1]["payload_digest"] == "abc"
    (folder / "a.warc.gz").write_bytes(gzip.compress(plain.replace(line, right.replace(right[-3:], b"aaa"))))
    with pytest.raises(Exception, match="digest"):
        warc.scan(spark, str(folder)).collect()


@pytest.mark.parametrize("payload", [True, False])
def test_archives_without_compression(payload):
    """Records as from gzip members; blocks that aren't wanted are never read."""
    many = [record(i, b"x" * 50_000 * i) for i in range(4)] + [record(4, b"", "revisit"), record(5, b"a\r\n\r\nb")]
    plain = b"".join(gzip.decompress(m) for m in many)
    wanted = lambda h: h["warc-record-id"] != "<r2>"
    assert list(warc.plain_records(io.BytesIO(plain), wanted, payload)) == list(
        warc.records(io.BytesIO(b"".join(many)), wanted, payload)
    )
    big = gzip.decompress(record(1, b"y" * 20_000_000)) + gzip.decompress(record(2, b"last"))
    file = Counting(big)
    assert [h["payload-length"] for h, _ in warc.plain_records(file, lambda h: h["warc-record-id"] == "<r2>", payload)] == [4]
    assert file.taken < len(big) / 2
    for cut in (10, 60_000, len(plain) - 2):
        with pytest.raises(ValueError):
            list(warc.plain_records(io.BytesIO(plain[:cut]), lambda h: True, True))


def test_lengths_of_foreign_payloads_without_an_http_length():
    plain = gzip.decompress(record(1, b"z" * 300_000))
    told = b"Content-Length: 300000\r\n\r\n"
    other = plain.replace(told, b"Server: x".ljust(len(told) - 4) + b"\r\n\r\n")
    assert len(other) == len(plain) and other != plain
    for payload in (True, False):
        for read, data in ((warc.records, gzip.compress(other)), (warc.plain_records, other)):
            ((header, _),) = read(io.BytesIO(data), lambda h: True, payload)
            assert header["payload-length"] == 300_000


def test_compressed_and_plain_archives_in_one_folder(spark, tmp_path):
    bare = lambda i, p: gzip.decompress(record(i, p)).replace(b"WARC-Payload-Digest: sha1:X\r\n", b"")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(bare(1, b"one")) + gzip.compress(bare(2, b"two")))
    (tmp_path / "b.warc").write_bytes(bare(3, b"three"))
    (tmp_path / "c.txt").write_bytes(b"none")
    got = warc.scan(spark, str(tmp_path)).collect()
    assert sorted(bytes(r["payload"]) for r in got) == [b"one", b"three", b"two"]


def test_payloads_are_not_shuffled(spark, pages):
    plan = warc.page_records(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
