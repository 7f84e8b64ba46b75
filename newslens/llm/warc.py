"""WARC archives of pages: segmented, chunked records out, reassembled payloads in.

A payload seen before (same digest, ``least_bytes`` or more) is written as a revisit of the page of
smallest id, any other as a response: an HTTP message in chunked transfer framing. A block longer
than ``segment_bytes`` becomes a first segment and continuation records, which name the first one's
record id, their number and, the last one, the total length. Reading groups the continuations by
that origin (records of one segment are not shuffled), orders them by number, checks that none
is missing and that the length is right, and decodes the framing.

Defined results: null html is the empty payload; a null page id is written and read as null and never
referred to; rows that share an id and a payload are all responses or all revisits of another page;
a record whose segments are incomplete has a null payload; no rows give no files and an empty result;
line breaks in an address become %0D and %0A; other columns are ignored.
"""

from __future__ import annotations

import gzip
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm import files, frames
from newslens.operators.skew import lookup_join
from newslens.settings import shared_dir, stored

LEAST_BYTES = 100
SEGMENT_BYTES = 1 << 14
CHUNK_BYTES = 1 << 12
FILE_BYTES = 1 << 23
DATE = "2000-01-01T00:00:00Z"  # pages have no time of their own
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "record_id string, origin string, segment int, total long, kind string, page_id string, url string, refers_to string, digest string, block binary"
_NAMES = [part.split()[0] for part in _RECORD.split(", ")]


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in HTTP/1.1 chunks."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16) if end >= 0 else -1
        except ValueError:
            return None
        if size < 0:
            return None
        if not size:
            return b"".join(out)
        at = end + 2
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def payload(block: bytes) -> bytes | None:
    """The body of an HTTP message, its transfer framing decoded."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None
    fields = dict(line.lower().split(b":", 1) for line in head.split(b"\r\n")[1:] if b":" in line)
    return unchunked(body) if fields.get(b"transfer-encoding", b"").strip() == b"chunked" else body


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def records(page_id, url, body: bytes, digest: str, refers_to, segment_bytes: int) -> list[bytes]:
    """The compressed records of one page."""

    def identity() -> str:
        return f"<urn:uuid:{uuid.uuid4()}>"

    own = identity()
    common = [("WARC-Date", DATE), ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A"))]
    page = [] if page_id is None else [("WARC-Page-ID", str(page_id))]
    about = [*common, *page, ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), *about, ("WARC-Profile", _PROFILE)]
        return [_record([*fields, ("WARC-Refers-To-Page-ID", str(refers_to))], b"")]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(body)
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", own), *about, ("Content-Type", "application/http;msgtype=response")]
    if len(block) <= segment_bytes:
        return [_record(fields, block)]
    out = [_record([*fields, ("WARC-Segment-Number", "1")], block[:segment_bytes])]
    for number, at in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", identity()), *common,
                  ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(number))]
        if at + segment_bytes >= len(block):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_record(fields, block[at : at + segment_bytes]))
    return out


def parse(data: bytes):
    """(fields, block) of every record of an archive; each record is a gzip member or plain."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\x1f\x8b":
            member = zlib.decompressobj(31)
            raw = member.decompress(data[at:] if at + (1 << 20) >= len(data) else data[at : at + (1 << 20)])
            used = min(len(data) - at, 1 << 20) - len(member.unused_data)
            while not member.eof:
                more = data[at + used : at + used + (1 << 20)]
                if not more:
                    raise ValueError("an archive is cut short")
                raw += member.decompress(more)
                used += len(more) - len(member.unused_data)
            at += used
            yield from parse(raw)
            continue
        head, found, _ = data[at:].partition(b"\r\n\r\n") if at else data.partition(b"\r\n\r\n")
        if not found:
            raise ValueError("an archive is cut short")
        lines = head.decode("utf-8").split("\r\n")
        fields = {k.lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}
        start = at + len(head) + 4
        size = int(fields["content-length"])
        yield fields, data[start : start + size]
        at = start + size + 4


def write(
    pages: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = LEAST_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
    file_bytes: int = FILE_BYTES,
    folder: str | None = None,
) -> DataFrame:
    """Write the archives; a row per file: path and number of records."""
    folder = folder or shared_dir(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(frames.quoted(page_id)).alias("page_id"),
        F.col(frames.quoted(url)).cast("string").alias("url"),
        F.coalesce(F.col(frames.quoted(html)).cast("string"), F.lit("")).cast("binary").alias("body"),
    ).withColumn("digest", F.sha2("body", 256))
    same = (
        rows.where(F.octet_length("body") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    rows = lookup_join(rows, same, ["digest"], ["page_id"])
    rows = rows.withColumn("refers_to", F.when(F.col("page_id") != F.col("first"), F.col("first")))
    rows = rows.withColumn("refers_to", F.when(F.col("page_id").isNull(), F.col("first")).otherwise(F.col("refers_to")))

    def save(batches):
        held, size, count = [], 0, 0

        def flush():
            nonlocal held, size, count
            row = pa.RecordBatch.from_arrays(
                [pa.array([files.write(folder, "warc.gz", held)]), pa.array([count], pa.int64())], names=["path", "n_records"]
            )
            held, size, count = [], 0, 0
            return row

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "body", "digest", "refers_to")]
            for line in zip(*columns, strict=True):
                own = records(*[v.as_py() for v in line], segment_bytes)
                held += own
                count += len(own)
                size += sum(map(len, own))
                if size >= file_bytes:
                    yield flush()
        if held:
            yield flush()

    return stored(rows.drop("first").mapInArrow(save, "path string, n_records long"), "warc-files")


def _loaded(manifest: DataFrame, segmented: bool) -> DataFrame:
    """A row per record of the files: the segments with their blocks, or the others with their payloads."""

    def load(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for fields, block in parse(files.read(path)):
                    number, total = fields.get("warc-segment-number"), fields.get("warc-segment-total-length")
                    origin = fields.get("warc-segment-origin-id") or (fields["warc-record-id"] if number else None)
                    if (origin is not None) != segmented:
                        continue
                    if not segmented:
                        block = payload(block) if fields["warc-type"] == "response" else None
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    rows.append((fields["warc-record-id"], origin, number and int(number), total and int(total), fields["warc-type"],
                                 fields.get("warc-page-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to-page-id"), digest, block))
                    size += len(block or b"")
                    if size >= 1 << 22:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return files.dealt(manifest.select("path")).mapInArrow(load, _RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text = pa.string()
    kinds = [text, text, pa.int32(), pa.int64(), text, text, text, text, text, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=_NAMES)


def _assembled(records_: DataFrame) -> DataFrame:
    """Segmented records as one: blocks in order, null unless all are there and the length is right."""
    parts = F.array_sort(F.collect_list(F.struct("segment", "block")))
    grouped = records_.groupBy("origin").agg(
        parts.alias("parts"),
        F.max("total").alias("total"),
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("kind", "page_id", "url", "refers_to", "digest")],
    )
    block = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["block"])), ""))  # in time linear in the record
    numbers = F.transform("parts", lambda p: p["segment"])
    whole = (F.octet_length("joined") == F.col("total")) & (numbers == F.sequence(F.lit(1), F.size("parts")))
    return grouped.withColumn("joined", block).withColumn("block", F.when(whole, F.col("joined")))


def read(manifest: DataFrame) -> DataFrame:
    """Per record: page_id (string), url, kind, refers_to, digest (as written) and payload (null for revisits)."""
    columns = ["page_id", "url", "kind", "refers_to", "digest"]

    def decode(batches):
        for batch in batches:
            kinds, blocks = batch.column("kind").to_pylist(), batch.column("block").to_pylist()
            bodies = [payload(b) if k == "response" and b is not None else None for k, b in zip(kinds, blocks, strict=True)]
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bodies, pa.binary())], names=[*columns, "payload"])

    # the archives are read twice rather than written once more; no task holds two Python workers
    whole = _loaded(manifest, False).select(*columns, F.col("block").alias("payload"))
    parts = _assembled(_loaded(manifest, True)).select(*columns, "block")
    schema = "page_id string, url string, kind string, refers_to string, digest string, payload binary"
    return whole.unionByName(parts.mapInArrow(decode, schema))


def op7(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    kind = pages.schema["page_id"].dataType
    found = stored(
        read(write(pages)).select(
            F.col("page_id").cast(kind).alias("page_id"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha2("payload", 256).alias("payload_digest"),
            F.col("kind").alias("record_type"),
            F.col("refers_to").cast(kind).alias("refers_to"),
            F.col("digest").alias("written"),
        ),
        "payloads",
    )
    responses = found.where("record_type = 'response'").drop("written")
    size = responses.groupBy(F.col("payload_digest").alias("written")).agg(F.min("payload_bytes").alias("size"))
    revisits = lookup_join(found.where("record_type = 'revisit'"), size, ["written"], ["page_id"])
    return responses.unionByName(
        revisits.select(
            "page_id",
            F.col("size").alias("payload_bytes"),
            F.when(F.col("size").isNotNull(), F.col("written")).alias("payload_digest"),
            "record_type",
            "refers_to",
        )
    )


OP7_SQL = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, min(page_id) over (partition by payload_digest) as first from p)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from f
"""
