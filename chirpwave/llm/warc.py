"""Operator 7: WARC archives with revisit resolution.

``write_archives`` turns pages into WARC/1.1 records.  Payload digests
(headers only: id, url, digest and length) are shuffled and the smallest id
of every repeated payload becomes its original; pages join their digest's
original, and every other record of that payload is written as a
``revisit`` with fresh headers and no payload.  Records are written by
Spark's text writer, so any file system Spark knows holds the archives, and a
failed task's files never appear.  ``deduplicate_archives`` does the same to
existing archives.

``read_archives`` reads archives back, record by record by Content-Length,
and ``resolve_revisits`` joins every revisit to its original response.

Defined cases: a null payload is empty; payloads under ``min_bytes`` are never
deduplicated; rows that repeat the smallest id of a payload are all
responses; a row with a null id is no original, but may revisit one; a null
url leaves out the target header; control characters in urls are
percent-encoded; an empty table gives an empty archive folder.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
END = CRLF + CRLF  # after every record; the text writer's line separator
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_BYTES = 100
FILE_RECORDS = 5_000
RECORD = ("page_id bigint, url string, record_id string, record_type string, refers_record string, "
          "payload_digest string, payload_bytes bigint, payload string")


def record_id(page_id: Column, url: Column, digest: Column) -> Column:
    """A stable urn:uuid of the record's content, the same on any retry."""
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce(url, F.lit("")), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """One header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _escaped(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def originals(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``(digest, original_id, original_url)`` of payloads that several records
    hold.  Aggregated before the shuffle: a payload of a third of all records
    sends one row per task."""
    return (headers.where((F.col("bytes") >= min_bytes))
            .groupBy("digest").agg(F.min("id").alias("original_id"), F.min_by("url", "id").alias("original_url"),
                                   F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) & F.col("original_id").isNotNull()).drop("n"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   date: str = "2026-01-01T00:00:00Z", min_bytes: int = MIN_BYTES) -> None:
    """Write one record per page into the folder ``path`` (gzip)."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
                        F.sha2(payload.cast("binary"), 256).alias("digest"), F.octet_length(payload).cast("bigint").alias("bytes"))
    first = originals(rows.select("id", "url", "digest", "bytes"), min_bytes)
    joined = rows.join(first, "digest", "left")
    revisit = F.col("original_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("original_id"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF),
                    _header("Content-Length", F.col("bytes").cast("string")), F.lit(CRLF))
    block = F.when(revisit, F.col("http")).otherwise(F.concat("http", "payload"))
    origin = record_id(F.col("original_id"), F.col("original_url"), F.col("digest"))
    text = F.concat(
        F.lit("WARC/1.1" + CRLF), _header("WARC-Type", kind),
        _header("WARC-Record-ID", record_id(F.col("id"), F.col("url"), F.col("digest"))), _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", _escaped(F.col("url"))), _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _header("X-Page-ID", F.col("id").cast("string")),
        F.when(revisit, F.concat(_header("WARC-Profile", F.lit(PROFILE)), _header("WARC-Refers-To", origin),
                                 _header("WARC-Refers-To-Target-URI", _escaped(F.col("original_url"))))).otherwise(F.lit("")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length("block").cast("string")), F.lit(CRLF), F.col("block"))
    (joined.withColumn("http", http).withColumn("block", block).select(text.alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path))


def parse_archive(stream):
    """Records of an open archive: (headers, block)."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers[name.decode().lower()] = value.strip().decode()
        yield headers, stream.read(int(headers["content-length"]))


def _row(headers: dict, block: bytes, keep: bool) -> tuple:
    _, _, payload = block.partition(b"\r\n\r\n")
    response = headers["warc-type"] == "response"
    page = headers.get("x-page-id")
    return (int(page) if page is not None else None, headers.get("warc-target-uri"), headers["warc-record-id"], headers["warc-type"],
            headers.get("warc-refers-to"),
            hashlib.sha256(payload).hexdigest() if response else headers["warc-payload-digest"].partition(":")[2],
            len(payload) if response else None, payload.decode() if response and keep else None)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in ``path``.  Digest and length of
    responses are computed from the payload as read; revisits carry the
    digest their header states and a null length."""
    names = [f.strip().split()[0] for f in RECORD.split(",")]

    def parse(batches):
        for batch in batches:
            for content in batch["content"]:
                raw = io.BytesIO(content.as_buffer())
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if raw.read(2) == b"\x1f\x8b" and not raw.seek(0) else raw
                stream.seek(0)
                rows = []
                for headers, block in parse_archive(stream):
                    rows.append(_row(headers, block, payloads))
                    if len(rows) == 500:
                        yield _records(rows, names)
                        rows = []
                yield _records(rows, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, RECORD)


def _records(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] + [pa.string()] * 5 + [pa.int64(), pa.string()]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, kinds)], names=names)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Adds ``refers_to`` (the original's page id) to every record and gives
    revisits their original's length and, where read, payload."""
    source = (records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_record"))
              .agg(F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("o_bytes"), F.first("payload").alias("o_payload")))
    wanted = records.where("record_type = 'revisit'").select("refers_record").distinct()
    source = source.join(wanted, "refers_record", "left_semi")
    # only revisits are joined: responses, most of the archive, have no key to join on
    plain = [c for c in records.columns if c not in ("payload_bytes", "payload")]
    is_revisit = F.col("record_type").eqNullSafe("revisit")
    met = records.where(is_revisit).join(source, "refers_record", "left").select(
        *plain, "refers_to", F.coalesce("payload_bytes", "o_bytes").alias("payload_bytes"), F.coalesce("payload", "o_payload").alias("payload"))
    own = records.where(~is_revisit).select(*plain, F.lit(None).cast("bigint").alias("refers_to"), "payload_bytes", "payload")
    return own.unionByName(met)


def deduplicate_archives(spark: SparkSession, source: str, target: str, date: str = "2026-01-01T00:00:00Z",
                         min_bytes: int = MIN_BYTES) -> None:
    """Rewrite archives so that every repeated payload is stored once."""
    write_archives(resolve_revisits(read_archives(spark, source)), target, "page_id", "url", "payload", date, min_bytes)
