"""WARC archives with a two-level capture index (operator 5).

Writing: every page becomes a WARC record: the response with the page's payload, or, where the same payload has been
captured under a smaller page_id, a revisit record that refers to it. Every task writes its records to archives with
Spark's text writer (a record ends with CR LF CR LF, the writer's line separator), so archives can be in any store that
Spark writes to, and payloads are not shuffled. Archives hold ``archive_records`` records; where one of them gets
larger than ``most_bytes`` all are written again, records by their size to archives of ``archive_records``, fewer or one
record (``SIZES``), about 64 MB at most or a single larger page. The index is made from the archives: each is walked
once, record by record.

Index: a line per record (reversed-host URL key, page_id, archive, offset, length), sorted by key over range
partitions and cut into compressed blocks of ``BLOCK_LINES`` lines; the sparse directory has the first and last key of
each block. ``lookup`` binary-searches the directory, opens the blocks found and reads the records' ranges, from the
archives that the entries name and from no others (up to ``MOST_ARCHIVES`` of them; Spark's readers load an archive
whole, its ranges are cut from it); ``read`` opens all blocks, and so all archives. A record is parsed from its range
alone and its digest is checked.

Defined results: a null html is the empty payload; a null url has the empty key; control characters and spaces of a
url are percent-encoded. Rows that repeat a page_id and payload are all responses if that id is the smallest; records
of a payload without any id are responses. Records below ``least_revisit`` bytes are all responses. An empty table
gives an empty archive and an empty result. Other columns are not read. The page group of a payload may be of any size:
only its smallest id is gathered, map-side, and joined back with skew splitting.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.common import materialize, scratch_path, shipped

ARCHIVE_RECORDS, BLOCK_LINES, MOST_URLS, MOST_BROADCAST, MOST_ARCHIVES = 4096, 256, 100_000, 2_000_000, 1000
MOST_BYTES = 256 << 20  # of an archive; Spark's readers load one whole
#: Payload bytes, and the records of up to so many that an archive holds (the first: ``archive_records``).
SIZES = ((1 << 14, ARCHIVE_RECORDS), (1 << 20, 64), (1 << 62, 1))
DATE = "2024-01-01T00:00:00Z"  # the pages carry no capture time
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five bytes at a time become eight digits."""
    h = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(h, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def clean_url(url: Column) -> Column:
    out = F.coalesce(url, F.lit(""))
    out = F.regexp_replace(out, "\r", "%0D")
    out = F.regexp_replace(out, "\n", "%0A")
    return F.regexp_replace(out, r"[\x00-\x20\x7F]", "%20")


def url_key(url: Column) -> Column:
    """Reversed host, then path and query: http://m.example.com/a?b -> com,example,m)/a?b; the fragment is dropped."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)(?::[0-9]*)?([^#]*)"
    host, rest = (F.regexp_extract(url, pattern, i) for i in (1, 2))
    key = F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest))
    return F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), key).otherwise(url)


@dataclass
class Archive:
    """Where the archives, the index blocks and the directory are."""
    records: str
    blocks: str
    directory: str


def _uuid(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("none"))).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _records(pages: DataFrame, least_revisit: int) -> DataFrame:
    """value: the text of each record, without the end that all records have; bytes: of its payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), clean_url(F.col("url")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload").cast("binary"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    twice = materialize(rows.filter(F.col("bytes") >= least_revisit).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "payloads")
    if twice.count() <= MOST_BROADCAST:  # two numbers each; beyond it the payloads are shuffled by digest
        twice = F.broadcast(twice)
    rows = rows.join(twice, "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    common = F.concat(
        F.lit(f"WARC-Date: {DATE}\r\n"), line("WARC-Record-ID", _uuid(F.col("page_id"))), line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.coalesce(line("X-Page-Id", F.col("page_id").cast("string")), F.lit("")))
    response = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\n"), common, F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        (F.col("bytes") + len(HTTP)).cast("string"), F.lit(END + HTTP))
    revisit = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: revisit\r\n"), common, line("WARC-Profile", F.lit(REVISIT_PROFILE)),
        line("WARC-Refers-To", _uuid(F.col("first_id"))), line("X-Refers-To-Page", F.col("first_id").cast("string")),
        line("X-Payload-Length", F.col("bytes").cast("string")), F.lit("Content-Length: 0" + END))
    return rows.select(F.when(again, revisit).otherwise(F.concat(response, F.col("payload"))).alias("value"),
                       F.when(again, 0).otherwise(F.col("bytes")).alias("bytes"))


def write(pages: DataFrame, archive_records: int = ARCHIVE_RECORDS, least_revisit: int = 0, most_bytes: int = MOST_BYTES) -> Archive:
    """Write archives and index below the shared folder."""
    spark = shipped(pages).sparkSession
    at = Archive(*(scratch_path(spark, f"warc-{x}") for x in ("records", "blocks", "directory")))
    records = _records(pages, least_revisit)

    def put(rows, path, n):
        rows.select("value").write.mode("append").option("lineSep", END).option("maxRecordsPerFile", n).text(path)

    put(records, at.records, archive_records)
    sizes = spark.read.format("binaryFile").load(at.records).agg(F.max("length")).first()[0] or 0  # a listing, no contents
    if sizes > most_bytes:
        at.records, over = scratch_path(spark, "warc-records"), -1
        for size, n in SIZES:
            put(records.filter(F.col("bytes").between(over + 1, size)), at.records, archive_records if over < 0 else n)
            over = size
    lines = _files(spark, at).mapInArrow(_walk, "url string, page_id long, archive string, offset long, length long")
    _write_index(lines.withColumn("key", url_key(F.col("url"))), at)
    return at


def _files(spark: SparkSession, at: Archive, names: list[str] | None = None) -> DataFrame:
    """archive (file name), content; of the archives ``names`` alone, if these are given."""
    paths = at.records if names is None else [f"{at.records}/{n}" for n in names]
    return spark.read.format("binaryFile").load(paths).select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")


def _walk(batches):
    """Where the records of whole archives are."""
    end, types = END.encode(), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    for batch in batches:
        for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            text, at, out = content.as_py(), 0, []
            while at < len(text):
                body = text.index(end, at) + len(end)
                h = _headers(text[at:body - len(end)])
                length = body - at + int(h["Content-Length"])
                page = h.get("X-Page-Id")
                out.append((h["WARC-Target-URI"], None if page is None else int(page), archive, at, length))
                at += length + len(end)
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)],
                                             names=["url", "page_id", "archive", "offset", "length"])


def _headers(head: bytes) -> dict:
    first, *rest = head.decode().split("\r\n")
    if first != "WARC/1.0":
        raise ValueError("not a WARC record")
    return dict(x.split(": ", 1) for x in rest)


def _write_index(lines: DataFrame, at: Archive) -> None:
    """Sorted lines -> compressed blocks, and their first and last keys."""
    def pack(batches):
        held: list[tuple] = []
        for pdf in batches:
            held += list(zip(pdf["part"], pdf["key"], pdf["archive"], pdf["offset"], pdf["length"]))
            full = len(held) // BLOCK_LINES * BLOCK_LINES
            yield block(held[:full])
            held = held[full:]
        yield block(held)

    def block(rows):
        out = []
        for i in range(0, len(rows), BLOCK_LINES):
            own = rows[i:i + BLOCK_LINES]
            text = "\n".join(f"{k} {a} {o} {n}" for _, k, a, o, n in own)
            out.append((int(own[0][0]), own[0][1], own[-1][1], len(own), zlib.compress(text.encode())))
        return pd.DataFrame(out, columns=["part", "first_key", "last_key", "n", "data"])

    (lines.select("key", "page_id", "archive", "offset", "length").repartitionByRange("key", "page_id", "archive", "offset")
     .sortWithinPartitions("key", "page_id", "archive", "offset").withColumn("part", F.spark_partition_id())
     .select("part", "key", "archive", "offset", "length")
     .mapInPandas(pack, "part int, first_key string, last_key string, n int, data binary")
     .withColumn("block", F.monotonically_increasing_id()).write.parquet(at.blocks))
    spark = lines.sparkSession
    spark.read.parquet(at.blocks).select("part", "block", "first_key", "last_key").write.parquet(at.directory)


_ENTRY = "key string, archive string, offset long, length long"


def _opened(blocks: DataFrame, wanted: set | None = None) -> DataFrame:
    """The index lines of blocks; of the ``wanted`` keys alone, found by binary search, if these are given."""
    def run(batches):
        for pdf in batches:
            out = []
            for data in pdf["data"]:
                rows = [x.rsplit(" ", 3) for x in zlib.decompress(data).decode().split("\n")]
                if wanted is not None:
                    keys = [r[0] for r in rows]
                    rows = [r for k in sorted(wanted) for r in rows[bisect_left(keys, k):bisect_right(keys, k)]]
                out += rows
            df = pd.DataFrame(out, columns=["key", "archive", "offset", "length"])
            yield df.astype({"archive": object, "offset": "int64", "length": "int64"})
    return blocks.select("data").mapInPandas(run, _ENTRY)


def parse(record: bytes) -> dict:
    """The fields of one record; raises if its length or its digest is not what it says."""
    head, _, block = record.partition(b"\r\n\r\n")
    h = _headers(head)
    if int(h["Content-Length"]) != len(block):
        raise ValueError("not a whole WARC record")
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    kind, page = h["WARC-Type"], h.get("X-Page-Id")
    out = {"page_id": None if page is None else int(page), "record_type": kind, "url": h["WARC-Target-URI"], "payload": None, "refers_to": None}
    if kind == "revisit":
        size, out["refers_to"] = int(h["X-Payload-Length"]), int(h["X-Refers-To-Page"])
    else:
        out["payload"] = block.partition(b"\r\n\r\n")[2]
        size = len(out["payload"])
        if base64.b32encode(hashlib.sha1(out["payload"]).digest()).decode() != digest:
            raise ValueError(f"payload digest of page {page}")
    return out | {"payload_bytes": size, "payload_digest": digest}


def _ranges(spark: SparkSession, at: Archive, entries: DataFrame, payloads: bool, names: list[str] | None = None) -> DataFrame:
    """The records in the ranges of ``entries``; an archive's entries are as many as its records at most. ``names``: the
    archives that have any, where these are known."""
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if payloads:
        fields.append(("payload", pa.binary()))
        schema += ", payload binary"
    own = entries.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("ranges"))
    # archives are large and their ranges are two numbers a record: these go to the archives, which are not shuffled,
    # as long as there are few; beyond that both sides are shuffled by archive
    if (spark.read.parquet(at.blocks).agg(F.sum("n")).first()[0] or 0) <= MOST_BROADCAST:
        own = F.broadcast(own)

    def run(batches):
        for batch in batches:
            for content, ranges in zip(batch.column(0), batch.column(1)):
                content, ranges = content.as_buffer(), ranges.as_py()
                for i in range(0, len(ranges), 500):
                    rows = [parse(content.slice(r["offset"], r["length"]).to_pybytes()) for r in ranges[i:i + 500]]
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in fields], names=[n for n, _ in fields])

    return _files(spark, at, names).join(own, "archive").select("content", "ranges").mapInArrow(run, schema)


def read(spark: SparkSession, at: Archive, payloads: bool = False) -> DataFrame:
    """All records, through the index: blocks, then ranges."""
    return _ranges(spark, at, _opened(spark.read.parquet(at.blocks)), payloads)


def lookup(spark: SparkSession, at: Archive, urls: list[str]) -> DataFrame:
    """The records (with payloads) of up to ``MOST_URLS`` urls."""
    if len(urls) > MOST_URLS:
        raise ValueError(f"look up at most {MOST_URLS} urls at a time")
    asked = spark.createDataFrame([(u,) for u in urls], "url string")
    wanted = {r[0] for r in asked.select(url_key(clean_url(F.col("url")))).collect()}
    keys = sorted(wanted)

    def search(batches):
        for pdf in batches:
            hit = [bisect_left(keys, a) < bisect_right(keys, b) for a, b in zip(pdf["first_key"], pdf["last_key"])]
            yield pdf[hit][["block"]]

    blocks = spark.read.parquet(at.directory).select("first_key", "last_key", "block").mapInPandas(search, "block long")
    opened = materialize(_opened(spark.read.parquet(at.blocks).join(blocks, "block", "left_semi"), wanted), "entries")
    names = sorted(r[0] for r in opened.select("archive").distinct().limit(MOST_ARCHIVES + 1).collect())
    return _ranges(spark, at, opened, True, names if 0 < len(names) <= MOST_ARCHIVES else None)


def op5(pages: DataFrame) -> DataFrame:
    return read(pages.sparkSession, write(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS h FROM pages
), f AS (
    SELECT h, min(page_id) AS first_id FROM p GROUP BY h
)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(p.h, 10 * (d // 8) + 1, 10) AS BIGINT) // CAST(pow(32, 7 - d % 8) AS BIGINT)) % 32 AS INTEGER) + 1, 1)
           for d in range(32)], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN f USING (h)
"""
