"""Archives round trip, and transactions whatever way their records point."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from partloom.llm import warc_transactions as warc
from partloom.llm.common import work_folder
from partloom.llm.queries import op3_warc_transactions

PAGES = [
    (1, "http://a/x y\r\nz", "é" * 600), (2, None, "é" * 600), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
    (7, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n" * 60), (8, "u", "\x00\r\n\r\n" + "x" * 3_000_000),
    (9, "u", "é" * 600), (9, "u", "é" * 599), (None, "u", "lost"),
]


@pytest.fixture(scope="module")
def archive(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("type", F.lit("mine"))
    path = f"{work_folder(spark)}archives"
    warc.write_archives(pages, path)
    return path


def test_payloads_come_back(spark, archive):
    rows = warc.read_archives(spark, archive).collect()
    assert len(rows) == 3 * 9
    found = {r.record_id: r for r in rows}
    kept = {bytes(r.payload).decode() for r in rows if r.type == "response"}
    assert kept == {h or "" for i, _, h in PAGES if i is not None and h != "é" * 599}
    for r in rows:
        assert r.type not in ("request", "metadata") or found[r.concurrent_to[0]].type in ("response", "revisit")
        assert r.type != "response" or r.payload_digest == "sha1:" + hashlib.sha1(bytes(r.payload)).hexdigest()
        assert r.type != "revisit" or found[r.refers_to].type == "response"


def test_query_on_awkward_pages(spark, tmp_path):
    pages = [p for p in PAGES if p[0] is not None][:8] + [(9, "u", "é" * 600)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op3_warc_transactions(spark, str(tmp_path)).collect()}
    for i, _, html in pages:
        payload = (html or "").encode()
        keeper = max(j for j, _, h in pages if (h or "").encode() == payload)
        again = len(payload) >= 1000 and keeper != i
        assert found[i] == (len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", keeper if again else None)


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert op3_warc_transactions(spark, str(tmp_path)).count() == 0


def test_records_compressed_one_by_one():
    one = "WARC/1.1\r\nWARC-Type: {}\r\nWARC-Record-ID: {}\r\nContent-Length: 4\r\n\r\na\r\nb\r\n\r\n"
    texts = [one.format("metadata", i).encode() for i in range(3)]
    for packed in (b"".join(map(gzip.compress, texts)), gzip.compress(b"".join(texts)), b"".join(texts)):
        assert [dict(f)["warc-record-id"] for f, b in warc.records_of(memoryview(packed)) if b == b"a\r\nb"] == ["0", "1", "2"]
    for lost in (1, 6, 9, 30):
        with pytest.raises(ValueError):
            list(warc.records_of(memoryview(b"".join(texts)[:-lost])))


def record(i, kind, *to):
    return (i, kind, list(to), None, None, None, None, None, b"")


def captures(spark, rows):
    frame = spark.createDataFrame(rows, warc.RECORDS).withColumn("parts", F.lit(1))
    ids = lambda part: sorted(p.record_id for p in part)
    return {r.capture_id: (ids(r.requests), ids(r.metadata), ids(r.others)) for r in warc.assemble(frame).collect()}


def test_direct_links(spark):
    rows = [record("a", "response"), record("b", "revisit"), record("q", "request", "a"), record("m", "metadata", "a", "b", "a"),
            record("c", "conversion", "b"), record("lone", "metadata"), record("d", "resource")]
    assert captures(spark, rows) == {"a": (["q"], ["m"], []), "b": ([], ["m"], ["c"]), "d": ([], [], [])}


def test_links_through_others_and_backwards(spark):
    rows = [record("a", "response", "q"), record("q", "request"), record("m", "metadata", "q"), record("n", "metadata", "m"),
            record("b", "response"), record("r", "request", "b", "s"), record("s", "metadata"), record("x", "metadata", "y"), record("y", "request", "x"),
            record("z", "request", "nowhere")]
    assert captures(spark, rows) == {"a": (["q"], ["m", "n"], []), "b": (["r"], ["s"], [])}


def test_no_records(spark):
    assert captures(spark, []) == {}


def test_archives_packed_and_plain(spark, tmp_path):
    """Packed whole or record by record, or not at all; blocks with blank lines within, before and after them."""
    blocks = ["a\r\nb", "\r\n\r\n", "x\r\n", "\r\n", "", "é\r\n\r\n\r\nz\r\n\r\n", "y" * 300_000]
    head = "WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: {}\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    for kind in ("whole.warc.gz", "each.warc.gz", "plain.warc"):
        texts = [head.format(f"{kind}-{i}", len(b.encode()), b).encode() for i, b in enumerate(blocks)]
        packed = {"whole.warc.gz": gzip.compress(b"".join(texts)), "each.warc.gz": b"".join(map(gzip.compress, texts)), "plain.warc": b"".join(texts)}
        (tmp_path / kind).write_bytes(packed[kind])
    (tmp_path / "empty.warc.gz").write_bytes(gzip.compress(b""))
    found = {r.record_id: bytes(r.payload).decode() for r in warc.read_archives(spark, f"file:{tmp_path}").collect()}
    assert found == {f"{kind}-{i}": b for kind in ("whole.warc.gz", "each.warc.gz", "plain.warc") for i, b in enumerate(blocks)}


def test_captures_of_one_identifier(spark):
    """The first by date is the capture, the others are told, whatever order they come in."""
    rows = [("a", "response", [], None, date, None, None, None, date.encode()) for date in ("2024", "2022", "2023")] + [record("q", "request", "a")]
    for turn in range(4):
        frame = spark.createDataFrame(rows[turn:] + rows[:turn], warc.RECORDS).repartition(3)
        (got,) = warc.assemble(frame).collect()
        assert got.capture.date == "2022" and [r.date for r in got.repeats] == ["2023", "2024"] and len(got.requests) == 1
        assert got.capture.payload == b"2022"


def test_captures_hold_their_payloads(spark, archive):
    found = warc.assemble(warc.read_archives(spark, archive)).collect()
    assert {bytes(r.capture.payload).decode() for r in found if r.capture.type == "response"} == {h or "" for i, _, h in PAGES if i is not None and h != "é" * 599}
    assert all(len(r.requests) == len(r.metadata) == 1 and r.capture.target_uri and not r.repeats for r in found)
