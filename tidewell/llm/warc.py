"""WARC archives with an index, and reads of selected records by byte range."""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ready_for_python, written
from tidewell.plans.tables import table
from tidewell.session import new_dir

SMALLEST = 100  # bytes of a payload from which copies are stored once
ARCHIVE_BYTES = 256 * 1024 * 1024  # of compressed records in one archive, about
GAP = 64 * 1024  # bytes between two records that are read rather than skipped
READ_BYTES = 8 * 1024 * 1024  # of one read, unless a record is larger
SPLIT_BYTES = 32 * 1024 * 1024  # of an archive that one task reads
LEVEL = 1  # of compression; each record is a gzip member of its own
DATE = "1970-01-01T00:00:00Z"  # pages carry no time

INDEX = ("page_id long, url string, record_type string, refers_to long, digest string, "
         "payload_bytes long, archive string, offset long, length long")
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, url string, payload binary")


def record_id(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(record: str):
    name = record.strip("<>").rsplit(":", 1)[1]
    return None if name == "none" else int(name)


def one_line(url: str) -> str:
    """A URL as a header value: white space and control characters percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode())
                   for c in url)


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC record. A revisit holds the response's headers, not its payload."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url:
        head.append(f"WARC-Target-URI: {one_line(url)}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", "WARC-Profile: "
                 "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes):
    """Header fields, HTTP fields and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def with_originals(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, payload_bytes, refers_to`` (null: a response).

    Of equal payloads only digest and smallest id are gathered, and joined back where a
    payload occurs twice; Spark splits the join where one payload is very frequent.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        html.alias("html"), F.sha2(html, 256).alias("digest"),
        F.octet_length(html).cast("long").alias("payload_bytes"))
    copies = written(
        rows.where(F.col("payload_bytes") >= SMALLEST).groupBy("digest")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1").drop("_n"), "warc-copies")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return rows.join(copies, "digest", "left").withColumn("refers_to", refers).drop("_first")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes one record per page to archives under ``folder`` and returns their index.

    Each task streams its rows to archives of its own, under names that no other attempt
    uses. The index is a Parquet table, which Spark commits once per task, so it names the
    files of the attempts that counted; a lost executor's files are left unread. ``folder``
    is any place that Arrow's file systems reach.
    """
    def write(batches):
        out = path = None
        at = 0
        for batch in batches:
            rows = {name: [] for name in (
                "page_id", "url", "record_type", "refers_to", "digest", "payload_bytes",
                "archive", "offset", "length")}
            for row in _rows(batch):
                if out is not None and at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                if out is None:
                    path, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    store, place = fs.FileSystem.from_uri(path)
                    out = store.open_output_stream(place, compression=None)
                revisit = row["refers_to"] is not None
                payload = row["html"].encode("utf-8", "surrogatepass")
                data = gzip.compress(record(
                    row["page_id"], row["url"], payload, row["digest"], row["refers_to"], revisit),
                    LEVEL, mtime=0)
                out.write(data)
                for name, value in (
                        ("record_type", "revisit" if revisit else "response"), ("archive", path),
                        ("offset", at), ("length", len(data))):
                    rows[name].append(value)
                for name in ("page_id", "url", "refers_to", "digest", "payload_bytes"):
                    rows[name].append(row[name])
                at += len(data)
            yield _batch(rows, INDEX)
        if out is not None:
            out.close()

    ready_for_python(pages.sparkSession)
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place, recursive=True)
    return written(pages.mapInArrow(write, INDEX), "warc-index")


def _rows(batch: pa.RecordBatch):
    """Rows one by one, so that only one page's text is a Python string at a time."""
    columns = [batch.column(i) for i in range(batch.num_columns)]
    for i in range(batch.num_rows):
        yield {name: column[i].as_py() for name, column in zip(batch.schema.names, columns, strict=True)}


ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: dict, schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[name], ARROW[kind]) for name, kind in fields], names=[n for n, _ in fields])


def read_records(selected: DataFrame) -> DataFrame:
    """The records that index rows name: RECORD, the payload null for a revisit.

    Rows are sorted by archive and offset over the cluster, pieces of SPLIT_BYTES apart, and
    neighbours with at most GAP bytes between them become one read of up to READ_BYTES.
    Every response's length and digest are checked against what was read. The number of
    tasks follows the bytes to be read, since the index is small beside them, so
    ``selected`` is read twice.
    """
    ready_for_python(selected.sparkSession)
    wanted = selected.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0
    tasks = max(2 * wanted // SPLIT_BYTES, 1)
    piece = F.floor(F.col("offset") / SPLIT_BYTES)
    ordered = (
        selected.select("archive", "offset", "length").withColumn("_piece", piece)
        .repartition(tasks, "archive", "_piece").sortWithinPartitions("archive", "offset"))
    return ordered.select("archive", "offset", "length").mapInArrow(_read, RECORD)


def _read(batches):
    opened = path = None
    rows, held = {name: [] for name in (f.split(" ")[0] for f in RECORD.split(", "))}, 0
    for archive, wanted in coalesced(_places(batches)):
        if archive != path:
            if opened is not None:
                opened.close()
            store, place = fs.FileSystem.from_uri(archive)
            opened, path = store.open_input_file(place), archive
        start = wanted[0][0]
        data = opened.read_at(wanted[-1][0] + wanted[-1][1] - start, start)
        for offset, length in wanted:
            row = _decoded(data[offset - start:offset - start + length])
            held += len(row["payload"] or b"")
            for name, value in row.items():
                rows[name].append(value)
        if held >= READ_BYTES or len(rows["page_id"]) >= 10_000:
            yield _batch(rows, RECORD)
            rows, held = {name: [] for name in rows}, 0
    if opened is not None:
        opened.close()
    yield _batch(rows, RECORD)


def _places(batches):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True)


def coalesced(places):
    """Groups sorted (archive, offset, length) into reads: (archive, [(offset, length)])."""
    archive, group = None, []
    for path, offset, length in places:
        if group and (path != archive or offset - sum(group[-1]) > GAP
                      or offset + length - group[0][0] > READ_BYTES):
            yield archive, group
            group = []
        archive = path
        if group and group[-1] == (offset, length):
            continue
        group.append((offset, length))
    if group:
        yield archive, group


def _decoded(data: bytes) -> dict:
    fields, http, payload = parse(zlib.decompress(data, wbits=31))
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if not revisit and (hashlib.sha256(payload).hexdigest() != digest
                        or len(payload) != int(http["Content-Length"])):
        raise ValueError(f"{fields['WARC-Record-ID']} does not have its payload")
    return {"page_id": page_of(fields["WARC-Record-ID"]), "payload_bytes": int(http["Content-Length"]),
            "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": page_of(fields["WARC-Refers-To"]) if revisit else None,
            "url": fields.get("WARC-Target-URI"), "payload": None if revisit else payload}


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all pages to archives and reads every record back: RECORD, one row per page.

    Of equal payloads of SMALLEST bytes or more, the page with the smallest id is the
    response and the others revisit it; rows that repeat that page are responses too. A null
    id is larger than any, and in a group of none but null ids all are responses. Null html
    is an empty payload, a null URL is left out, an empty table gives no rows, and further
    columns are ignored.
    """
    folder = folder or new_dir(pages.sparkSession, "warc")
    return read_records(write_archives(with_originals(pages), folder))


def op6_warc(spark, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages")).drop("url", "payload")


ORACLE_OP6 = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
