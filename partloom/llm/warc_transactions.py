"""WARC archives: pages written as records, archives read back, transactions assembled.

``write_archives`` makes three records per page: the response (or a revisit record where an equal
payload is kept by another page), the request, and a metadata record, tied by WARC-Concurrent-To.
Records are text, so Spark's text writer writes them, with the two line ends that close a record as
its line separator: through its commit protocol, to any file system, as gzip files of bounded size.
``read_archives`` gives a row per record, ``assemble`` joins request, response and metadata
records through their concurrent-to identifiers and gives one nested row per capture.

Defined results: a null payload is empty and a null URL is ``about:blank``; a page without an id has no
place in an archive and is left out; rows that repeat a page_id are written once, with the greatest
(url, html); white space in URLs is percent-encoded; extra columns are ignored; an empty table gives no rows.
A record that no capture is concurrent to is left out of captures; a capture row holds all its records.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partloom.llm.common import is_empty, plain, stored, work_folder

#: Payloads from this many bytes on are kept once.
REVISIT_FROM = 1000
#: Bytes of payload that an archive should hold.
ARCHIVE_BYTES = 32 << 20

_END = "\r\n\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(kind: str, page: Column) -> Column:
    """A UUID of the record, made from its name so that a rerun task writes the same one."""
    digest = F.md5(F.concat(F.lit(f"{kind}:"), page.cast("string")).cast("binary"))
    part = lambda a, n: F.substr(digest, F.lit(a), F.lit(n))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; those with a null value are left out."""
    return F.concat_ws("", *(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in pairs))


def _record(kind: str, pairs: list[tuple[str, Column]], block: Column) -> Column:
    head = _lines(("WARC-Type", F.lit(kind)), *pairs, ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(F.lit("WARC/1.1\r\n"), head, F.lit("\r\n"), block)


def kept_payloads(pages: DataFrame) -> DataFrame:
    """``page_id`` and ``refers_to`` of the pages whose payload another page keeps: of equal payloads of at
    least REVISIT_FROM bytes the page with the greatest id keeps it."""
    slim = pages.select("page_id", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("size")).where(f"size >= {REVISIT_FROM}")
    keepers = slim.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return slim.join(keepers, ["digest", "size"]).where("page_id <> refers_to").select("page_id", "refers_to")


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Archives of ``pages`` (page_id, url, html) below ``path``."""
    whole = pages.where("page_id IS NOT NULL").select(
        "page_id", F.coalesce(F.col("url"), F.lit("about:blank")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    size = whole.agg(F.sum(F.octet_length("html"))).first()[0] or 0  # one number
    files = max(1, -(-size // ARCHIVE_BYTES))
    once = whole.groupBy("page_id").agg(F.max(F.struct("url", "html")).alias("p")).select("page_id", "p.*") if _repeats(whole) else whole
    # Dealt before the join, so that payloads are shuffled once.
    dealt = once.repartition(files, "page_id").join(kept_payloads(once).repartition(files, "page_id"), "page_id", "left")

    page = F.col("page_id")
    response, request, metadata = (_record_id(kind, page) for kind in ("response", "request", "metadata"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    at = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", url)]
    length = F.octet_length("html").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length, F.lit("\r\n\r\n"))
    digest = F.concat(F.lit("sha1:"), F.sha1(F.col("html").cast("binary")))
    again = F.col("refers_to").isNotNull()
    kept = _record(
        "response",
        [("WARC-Record-ID", response), *at, ("WARC-Payload-Digest", digest), ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.concat(http, F.col("html")),
    )
    revisit = _record(
        "revisit",
        [("WARC-Record-ID", response), *at, ("WARC-Payload-Digest", digest), ("WARC-Profile", F.lit(_REVISIT_PROFILE)),
         ("WARC-Refers-To", _record_id("response", F.col("refers_to"))), ("Content-Type", F.lit("application/http; msgtype=response"))],
        http,
    )
    asked = _record(
        "request",
        [("WARC-Record-ID", request), *at, ("WARC-Concurrent-To", response), ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1\r\n\r\n")),
    )
    told = _record(
        "metadata",
        [("WARC-Record-ID", metadata), *at, ("WARC-Concurrent-To", response), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("page-id: "), page.cast("string"), F.lit("\r\n")),
    )
    records = dealt.select(F.explode(F.array(asked, F.when(again, revisit).otherwise(kept), told)).alias("value"))
    records.write.option("lineSep", _END).option("compression", "gzip").text(path)


def _repeats(pages: DataFrame) -> bool:
    return not is_empty(pages.groupBy("page_id").count().where("count > 1"))


RECORDS = (
    "record_id string, type string, concurrent_to array<string>, target_uri string, date string, payload_digest string,"
    " refers_to string, http_head string, payload binary"
)


class _Bytes:
    """Bytes that come in parts, taken as they are needed."""

    def __init__(self, parts: Iterator[bytes]):
        self._parts, self._held = parts, bytearray()

    def _more(self) -> bool:
        part = next(self._parts, None)
        if part is None:
            return False
        self._held += part
        return True

    def upto(self, mark: bytes) -> bytes | None:
        """The bytes before the next ``mark``, which is passed; None at the end."""
        seen = 0
        while (at := self._held.find(mark, seen)) < 0:
            seen = max(0, len(self._held) - len(mark) + 1)
            if not self._more():
                return None
        out = bytes(self._held[:at])
        del self._held[: at + len(mark)]
        return out

    def rest(self) -> bytes:
        return bytes(self._held)

    def take(self, n: int) -> bytes:
        while len(self._held) < n and self._more():
            pass
        if len(self._held) < n:
            raise ValueError("an archive ends within a record")
        out = bytes(self._held[:n])
        del self._held[:n]
        return out


def unpacked(content: memoryview) -> Iterator[bytes]:
    """The parts of a gzip or plain archive, unpacked as they are asked for."""
    pack = zlib.decompressobj(31) if bytes(content[:2]) == b"\x1f\x8b" else None
    for at in range(0, len(content), 1 << 20):
        data = bytes(content[at: at + (1 << 20)])
        if pack is None:
            yield data
        while pack is not None and data:
            yield pack.decompress(data)
            data = pack.unused_data
            if data:  # the next member of a file compressed record by record
                pack = zlib.decompressobj(31)


def records_of(content: memoryview) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Header fields, with their names in lower case, and block of every record of an archive."""
    return _records(unpacked(content))


def _records(parts: Iterator[bytes]) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    data = _Bytes(parts)
    while (head := data.upto(b"\r\n\r\n")) is not None and head.strip():
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        fields = [(k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines[1:])]
        block = data.take(int(dict(fields)["content-length"]))
        data.take(4)
        yield fields, block
    if data.rest().strip(b"\r\n"):
        raise ValueError("an archive ends within a record")


def _row(fields: list[tuple[str, str]], block: bytes) -> tuple:
    one = dict(fields)
    http, payload = None, block
    if one.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = head.decode("utf-8", "replace")
    return (
        one["warc-record-id"], one["warc-type"], [v for k, v in fields if k == "warc-concurrent-to"], one.get("warc-target-uri"),
        one.get("warc-date"), one.get("warc-payload-digest"), one.get("warc-refers-to"), http, payload,
    )


#: Payload bytes that are handed on at once.
_BATCH = 8 << 20


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives below ``path``.

    Packed archives are read by Spark's text reader, cut at blank lines, and put together again record by record
    as they come, so an archive of any size needs the memory of its largest record. Others, which that reader
    would divide among tasks within records, are read as one value each and so must be under 2 GB.
    """
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 5, pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def batches_of(records: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for fields, block in records:
            rows.append(_row(fields, block))
            held += len(block)
            if held >= _BATCH:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()

    def from_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for content in plain(files.column("content")):
                yield from batches_of(records_of(memoryview(content.as_buffer())))

    def from_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (pair for batch in batches for pair in zip(batch.column("file"), batch.column("value"), strict=True))
        for _, of_file in groupby(lines, key=lambda pair: pair[0].as_py()):
            yield from batches_of(_records(bytes(value.as_buffer()) + _END.encode() for _, value in of_file))

    packed = spark.read.option("lineSep", _END).option("pathGlobFilter", "*.gz").text(path)
    packed = packed.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    bare = spark.read.format("binaryFile").option("pathGlobFilter", "{*[!z],*[!g]z}").load(path).select("content")
    return packed.mapInArrow(from_lines, RECORDS).unionByName(bare.mapInArrow(from_files, RECORDS))


CAPTURE_TYPES = ("response", "revisit", "resource")


def assemble(records: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per capture: ``capture_id``, ``capture`` (its response, revisit or resource record) and arrays of
    the ``requests``, ``metadata`` and ``others`` that are concurrent to it, directly or through another record.

    Captures and the records that name them meet in one grouping by the identifier. Identifiers may point
    either way; where some name a record that is no capture, those are followed first. A record that names
    several captures is with each. Captures with more records than another only make their own row longer.
    Of captures with one identifier the first by (date, target_uri, payload_digest, type) is ``capture``, the others
    are in ``repeats``.
    """
    folder = folder or work_folder(records.sparkSession)
    # Only identifiers are looked at more than once; whole records are read for the grouping alone.
    slim = stored(records.select("record_id", "type", "concurrent_to"), folder, "pointers")
    is_capture = F.col("type").isin(*CAPTURE_TYPES)
    pointing = slim.select("record_id", is_capture.alias("is_capture"), F.explode("concurrent_to").alias("other"))
    named = pointing.where("NOT is_capture").select(F.col("record_id").alias("part"), F.col("other").alias("at"))
    naming = pointing.where("is_capture").select(F.col("other").alias("part"), F.col("record_id").alias("at"))
    ids = slim.where(is_capture).select(F.col("record_id").alias("at")).distinct()
    indirect = stored(named.join(ids, "at", "left_anti"), folder, "indirect")
    fields = ("record_id", "type", "target_uri", "date", "http_head", "payload")
    order = ("date", "target_uri", "payload_digest", "type")
    names = [*order, *(name for name in records.columns if name not in order)]
    whole = F.struct(*(f"`{name}`" for name in names))
    if is_empty(indirect) and is_empty(naming):
        at = F.when(is_capture, F.array("record_id")).otherwise(F.array_distinct("concurrent_to"))
        both = records.withColumn("capture_id", F.explode(at))
    else:
        places = _follow(named, naming, ids, indirect, folder)
        placed = records.where(~is_capture).join(places.select(F.col("part").alias("record_id"), F.col("at").alias("capture_id")), "record_id")
        both = records.where(is_capture).withColumn("capture_id", F.col("record_id")).unionByName(placed)
    both = both.select("capture_id", F.when(is_capture, whole).alias("capture"), F.when(~is_capture, F.struct(*fields)).alias("part"))
    gathered = both.groupBy("capture_id").agg(
        F.sort_array(F.collect_list("capture")).alias("captures"), F.sort_array(F.collect_list("part")).alias("parts")
    ).where("size(captures) > 0")
    kind = lambda wanted: F.filter("parts", lambda p: wanted(p["type"]))
    return gathered.select(
        "capture_id",
        F.element_at("captures", 1).alias("capture"),
        kind(lambda t: t == "request").alias("requests"),
        kind(lambda t: t == "metadata").alias("metadata"),
        kind(lambda t: ~t.isin("request", "metadata")).alias("others"),
        F.slice("captures", F.lit(2), F.size("captures")).alias("repeats"),
    )


def _follow(named: DataFrame, naming: DataFrame, ids: DataFrame, indirect: DataFrame, folder: str) -> DataFrame:
    """``part`` and the captures ``at`` which it belongs to, through as many records as it takes."""
    placed = stored(named.join(ids, "at", "left_semi").unionByName(naming).distinct(), folder, "placed-0")
    fresh, number = placed, 0
    while not is_empty(fresh):
        number += 1
        through = fresh.select(F.col("part").alias("at"), F.col("at").alias("capture"))
        # Records that name one which was placed, and records that such a one names.
        on = indirect.join(through, "at").select("part", F.col("capture").alias("at"))
        back = indirect.select(F.col("at").alias("part"), F.col("part").alias("at")).join(through, "at").select("part", F.col("capture").alias("at"))
        found = on.unionByName(back).distinct().join(placed, ["part", "at"], "left_anti")
        fresh = stored(found, folder, f"found-{number}")
        placed = stored(placed.unionByName(fresh), folder, f"placed-{number}")
    return placed


def field_of(block: Column, name: str) -> Column:
    """A field of a ``application/warc-fields`` block or of an HTTP head; null if it has none."""
    found = F.regexp_extract(block.cast("string"), rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)
