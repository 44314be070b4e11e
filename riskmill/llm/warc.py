"""Web archives: records with chunked payloads, cut into segments, and their reassembly.

Files are written by Spark's text writer, whose line separator is a record's last line break, and read by its text
reader, which splits at the version line. So files may lie in any store that Spark knows, and a task reads record by
record. The version line begins with a letter that it holds only once: a reader that meets a part of it at the end of
its buffer never has to go back, and finds every one. The writer never lets it occur inside a record: it starts a new
chunk of the transfer coding within it, and encodes a letter of a URL that ends in it. Neither a chunk's frame, a
header nor a cut between segments can then make one.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmill.llm.common import map_batches
from riskmill.sources.workspace import fresh_path, stage

VERSION = b"WARC/1.1\r\n"
CHUNK = 8_192
SEGMENT = 32_768
LEAST_BYTES = 100  # smaller payloads are never revisits
DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_VISIBLE = "".join(map(chr, range(33, 127)))


# --- Framing ------------------------------------------------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer coding; a chunk ends inside each version, as a line break follows a chunk's end, too."""
    ends = {0, len(payload), *range(size, len(payload), size)}
    ends.update(m.start() + 4 for m in re.finditer(re.escape(VERSION.rstrip()), payload))
    out, first = [], 0
    for end in sorted(ends - {0}):
        out += [b"%x\r\n" % (end - first), payload[first:end], b"\r\n"]
        first = end
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; sizes may have extensions, trailers are skipped."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def segments(block: bytes, size: int = SEGMENT) -> list[bytes]:
    """Parts of at most ``size`` bytes, at least one."""
    return [block[at : at + size] for at in range(0, len(block), size)] or [b""]


def target_uri(url: str | None) -> str:
    """Visible characters only; the line that holds it must not end in a version line."""
    uri = quote(url or "about:blank", safe=_VISIBLE)
    version = VERSION.rstrip().decode()
    return f"{uri.removesuffix(version)}%57{version[1:]}" if uri.endswith(version) else uri


def record_id(page_id: int | None, digest: str) -> str:
    return str(uuid.UUID(hashlib.md5(f"{page_id}\n{digest}".encode()).hexdigest()))


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the last line break, which the writer adds."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    return b"".join([VERSION, lines.encode(), b"\r\n", block, b"\r\n"])


def records_of(page_id, url, payload: bytes, digest: str, refers_to, segment: int = SEGMENT) -> list[bytes]:
    """The records of a page: a response, cut into segments if it is long, or a revisit."""
    own = f"<urn:uuid:{record_id(page_id, digest)}>"
    about = [
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target_uri(url)),
        ("X-Page-ID", page_id),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields = [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", own),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{record_id(refers_to, digest)}>"),
            ("X-Refers-To-Page-ID", refers_to),
        ]
        return [_record([*fields, *about], _HTTP + b"\r\n")]
    parts = segments(_HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload), segment)
    total = sum(map(len, parts))
    head = [("WARC-Type", "response"), ("WARC-Record-ID", own), *about]
    if len(parts) == 1:
        return [_record(head, parts[0])]
    records = [_record([*head, ("WARC-Segment-Number", 1)], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        fields = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.UUID(own[10:-1]), str(number))}>"),
            ("WARC-Segment-Number", number),
            ("WARC-Segment-Origin-ID", own),
            ("WARC-Segment-Total-Length", total if number == len(parts) else None),
            ("WARC-Date", DATE),
        ]
        records.append(_record(fields, part))
    return records


# --- Writing ------------------------------------------------------------------------------------------


def write_warc(pages: DataFrame, folder: str, segment: int = SEGMENT, compression: str = "gzip") -> None:
    """One record per row of page_id, url, html.

    Of rows with equal payloads of at least 100 bytes, those with the smallest page_id are responses and the
    others revisit them; a payload that has no page_id at all is always a response.
    """
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    long_rows = rows.filter(F.octet_length("payload") >= LEAST_BYTES)
    first = long_rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = first.filter("first IS NOT NULL").select("digest", "first")
    decided = rows.join(first, "digest", "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    decided = decided.select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"))

    def build(batch: pa.RecordBatch) -> dict:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        return {"value": pa.array([r for row in rows for r in records_of(*row, segment)], pa.binary())}

    records = map_batches(decided, build, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.text(folder, compression=compression, lineSep="\r\n")


# --- Reading ------------------------------------------------------------------------------------------

RECORD_SCHEMA = (
    "type string, record_id string, origin string, number int, total bigint, page_id bigint, uri string, "
    "digest string, refers_id string, refers_to bigint, payload_bytes bigint, payload_digest string, piece binary"
)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields (in lower case) and block. The version line may be missing."""
    head, found, rest = raw.removeprefix(VERSION).partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(fields.get("content-length", -1))
    if not found or size < 0 or len(rest) < size or rest[size:].strip(b"\r\n"):
        raise ValueError(f"not a whole record: {fields.get('warc-record-id')}")
    return fields, rest[:size]


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP response, without transfer coding."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if re.search(rb"(?i)\r\ntransfer-encoding:[^\r]*chunked", head) else body


def _id(text: str | None) -> str | None:
    return text.removeprefix("<urn:uuid:").removesuffix(">") if text else None


def _number(text: str | None) -> int | None:
    return int(text) if text is not None else None


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record. Whole responses are decoded; of segments the block is kept."""
    raw = spark.read.text(folder, lineSep=VERSION.decode()).filter("value != ''").select(F.col("value").cast("binary"))
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]

    def parse(batch: pa.RecordBatch) -> dict:
        rows = []
        for record in batch.column(0).to_pylist():
            fields, block = parse_record(record)
            kind, number = fields["warc-type"], _number(fields.get("warc-segment-number"))
            payload = payload_of(block) if kind == "response" and number is None else None
            rows.append(
                (
                    kind,
                    _id(fields["warc-record-id"]),
                    _id(fields.get("warc-segment-origin-id")),
                    number,
                    _number(fields.get("warc-segment-total-length")),
                    _number(fields.get("x-page-id")),
                    fields.get("warc-target-uri"),
                    fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                    _id(fields.get("warc-refers-to")),
                    _number(fields.get("x-refers-to-page-id")),
                    None if payload is None else len(payload),
                    None if payload is None else hashlib.sha256(payload).hexdigest(),
                    None if number is None else block,
                )
            )
        types = [
            pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(),
            pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return {n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)}

    return map_batches(raw, parse, RECORD_SCHEMA)


def reassembled(records: DataFrame) -> DataFrame:
    """record_id, bytes, sha of the payloads that came in segments.

    Segments are grouped by origin, ordered by number and joined; the total length in the last one must be
    met, and no number may be missing. A group is one response.
    """
    own = F.coalesce("origin", "record_id").alias("record_id")
    pieces = records.filter("number IS NOT NULL").select(own, F.struct("number", "total", "piece").alias("s"))
    groups = pieces.groupBy("record_id").agg(F.sort_array(F.collect_set("s")).alias("parts"))

    def join(batch: pa.RecordBatch) -> dict:
        sizes, digests = [], []
        for own, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            block = b"".join(p["piece"] for p in parts)
            if [p["number"] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1]["total"] != len(block):
                raise ValueError(f"segments of {own} are not complete")
            payload = payload_of(block)
            sizes.append(len(payload))
            digests.append(hashlib.sha256(payload).hexdigest())
        return {
            "record_id": batch.column(0),
            "bytes": pa.array(sizes, pa.int64()),
            "sha": pa.array(digests, pa.string()),
        }

    return map_batches(groups, join, "record_id string, bytes bigint, sha string")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every response and revisit.

    The size and digest of a response are taken from its decoded payload, those of a revisit from the response
    that it refers to. A payload that does not have its declared digest fails the job.
    """
    records = stage(read_records(spark, folder), "warc-records")
    whole = records.filter("type = 'response' AND number IS NULL")
    heads = records.filter("type = 'response' AND number = 1").drop("payload_bytes", "payload_digest")
    joined = heads.join(reassembled(records), "record_id").withColumnsRenamed(
        {"bytes": "payload_bytes", "sha": "payload_digest"}
    )
    columns = ["record_id", "page_id", "digest", "payload_bytes", "payload_digest"]
    responses = whole.select(columns).unionByName(joined.select(columns))
    wrong = F.concat(F.lit("payload digest of "), "record_id")
    checked = F.when(F.col("digest") == F.col("payload_digest"), F.col("payload_digest")).otherwise(F.raise_error(wrong))
    responses = responses.withColumn("payload_digest", checked)
    targets = responses.groupBy(F.col("record_id").alias("refers_id")).agg(
        F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest")
    )
    revisits = records.filter("type = 'revisit'").select("refers_id", "page_id", "refers_to").join(targets, "refers_id")
    result = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        responses.withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("bigint")})
        .select(result)
        .unionByName(revisits.withColumn("record_type", F.lit("revisit")).select(result))
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write the pages to the shared folder as archives and read them back.

    NULL html is an empty payload; NULL urls and page_ids are allowed; equal page_ids are several records; other
    columns are ignored; an empty table gives no rows.
    """
    folder = fresh_path(pages.sparkSession, "warc")
    write_warc(pages, folder)
    return read_warc(pages.sparkSession, folder)
