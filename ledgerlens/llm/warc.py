"""Web archives: written with an index, read back by coalesced byte ranges of the selected records."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import run_dir, staged

SHARED = 1000  # bytes from which equal payloads are stored once
FILE = 256 << 20  # bytes after which a task begins another file
SPAN = 8 << 20  # bytes of a read, about
GAP = 64 << 10  # bytes that a read goes over rather than being split

_INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string, refers_to long"
_HEAD = re.compile(rb"\r\n\r\n")


def _place(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _field(value: str) -> str:
    """A header value on one line."""
    return quote(value, safe="".join(map(chr, range(33, 127))))


def record(page_id, url, payload: bytes, kind: str, refers_to, digest: str) -> bytes:
    """One WARC 1.1 record as a gzip member of its own. A revisit has no payload but names the response that has it."""
    name = "" if page_id is None else page_id
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + pack.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    plain = zlib.decompress(member, 31)
    at = _HEAD.search(plain)
    lines = plain[: at.start()].decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = plain[at.end() : at.end() + int(fields["Content-Length"])]
    if plain[at.end() + len(body) :] != b"\r\n\r\n":
        raise ValueError("a record is cut off")
    return fields, body[_HEAD.search(body).end() :]


def _written(folder: str):
    """Rows to write -> index rows. A task that is run again writes files of new names; only committed index rows count."""

    def run(batches):
        system, path = _place(folder)
        out, name, offset = None, "", 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None or offset >= FILE:
                    if out is not None:
                        out.close()
                    name, offset = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                member = record(row["page_id"], row["url"], (row["html"] or "").encode(), row["record_type"], row["refers_to"], row["digest"])
                out.write(member)
                rows.append((name, offset, len(member), row["url"], row["digest"], row["page_id"], row["record_type"], row["refers_to"]))
                offset += len(member)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["file", "offset", "length", "url", "digest", "page_id", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 8, kinds)], names)
        if out is not None:
            out.close()

    return run


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write the rows (page_id, url, html) as records to files in ``folder`` and give the index, a row for each record.

    Of records with equal payloads of at least 1000 bytes, that with the largest page_id is the response and others revisit it.
    Null html is an empty payload, null url no target; rows without page_id revisit a named response if there is one; rows that
    repeat a page_id are written each. Equal payloads are known by their digest and length, so the texts aren't grouped.
    """
    pages.sparkSession._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(pages.sparkSession._jsc.hadoopConfiguration()).mkdirs(
        pages.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    )
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    holders = (
        rows.filter(F.col("size") >= SHARED)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and holder is not null")
        .drop("n")
    )
    holders = staged(holders, "warc_holders")  # a plain side of the join, so that Spark splits the partition of a frequent payload
    revisits = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    typed = rows.join(holders, ["digest", "size"], "left").select(
        "page_id", "url", "digest",
        F.when(~revisits, F.col("html")).alias("html"),
        F.when(revisits, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisits, F.col("holder")).alias("refers_to"),
    )
    return staged(typed.mapInArrow(_written(folder), _INDEX), "warc_index")


def ranges(index: DataFrame, gap: int = GAP, span: int = SPAN) -> DataFrame:
    """file, begin, end, records: the reads for the index rows given. Neighbours in a file are read at once unless more than
    ``gap`` bytes lie between them; a read begins in one stretch of ``span`` bytes."""
    order = Window.partitionBy("file").orderBy("offset")
    apart = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(order) > gap
    new = F.coalesce(apart | (F.floor(F.col("offset") / span) != F.lag(F.floor(F.col("offset") / span)).over(order)), F.lit(True))
    marked = index.select("file", "offset", "length").distinct().withColumn("new", new.cast("int"))
    return (
        marked.withColumn("read", F.sum("new").over(order))
        .groupBy("file", "read")
        .agg(
            F.min("offset").alias("begin"),
            F.max(F.col("offset") + F.col("length")).alias("end"),
            F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"),
        )
        .drop("read")
    )


def _fetched(folder: str):
    def run(batches):
        system, path = _place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{path}/{row['file']}") as source:
                    data = source.read_at(row["end"] - row["begin"], row["begin"])
                rows = []
                for r in row["records"]:
                    at = r["offset"] - row["begin"]
                    fields, payload = parse(data[at : at + r["length"]])
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{row['file']} at {r['offset']}: the payload doesn't have its digest")
                    known = [fields.get(k, "<urn:page:>")[10:-1] for k in ("WARC-Record-ID", "WARC-Refers-To")]
                    rows.append((*(int(x) if x else None for x in known), fields.get("WARC-Target-URI"), kind, digest, payload))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["page_id", "refers_to", "url", "record_type", "digest", "payload"])

    return run


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """The records of the index rows given (all, or a selection of them), read from the files in ``folder``: page_id, refers_to,
    url, record_type, digest, payload (empty for revisits). Payloads are held against their digests."""
    kinds = "page_id long, refers_to long, url string, record_type string, digest string, payload binary"
    reads = ranges(index)
    spread = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reads.repartition(spread, "file", "begin").mapInArrow(_fetched(folder), kinds)


def resolved(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: measured on the payloads read; revisits have those of the
    response they refer to."""
    slim = staged(
        records.select("page_id", "refers_to", "record_type", "digest", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes")),
        "warc_records",
    )
    whole = slim.filter("record_type = 'response'")
    named = whole.groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.first("payload_digest").alias("payload_digest"), F.first("payload_bytes").alias("payload_bytes"))
    named = staged(named, "warc_responses")
    again = slim.filter("record_type = 'revisit'").drop("payload_digest", "payload_bytes").join(named, ["refers_to", "digest"])
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return whole.select(columns).union(again.select(columns))


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read them all back; see ``write`` and ``resolved``. An empty table
    gives an empty result; other columns are left out."""
    folder = run_dir(pages.sparkSession, "warc")
    return resolved(fetch(write(pages, folder), folder))
