"""WARC archives: writing pages as records, and reading records back with segments put together.

Writing gives gzip files of WARC/1.1 records through Spark's text writer, one record per row and
CRLF after it. Bodies are sent in chunked transfer framing. A block above ``segment_bytes``
becomes a first record and continuation records. Of pages with equal payloads the one with the
largest id is stored, the others are revisit records without a body. A chunk never holds the text
``WARC/1.1`` (the framing is cut inside it), so that the reader can split files at record starts with
Spark's own line reader, splittable where the codec is.

Reading groups continuation records by origin id, orders them by segment number, verifies numbers and total
length, and decodes the framing. Only segmented records are shuffled. A group is one record, so its size
is that of a page.

Cases: a NULL payload is an empty one; a NULL url becomes ``about:blank``; NULL page ids are kept, and
the largest id is taken among those that are not NULL. Rows that repeat both id and payload are all
responses if that id is the largest. Broken records come back with a ``status`` other than ``ok`` and no payload.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.support import arrow_rows, scratch_path, ship, stored

MARK = b"WARC/1.1"
CHUNK_BYTES = 8192
SEGMENT_BYTES = 32768
_OUT = 8 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing; no chunk holds the record mark."""
    out, at = [], 0
    mark = payload.find(MARK)
    while at < len(payload):
        end = min(at + size, len(payload))
        while 0 <= mark < at:
            mark = payload.find(MARK, at)
        if at <= mark < end:
            end = mark + 4
        out.append(b"%x\r\n" % (end - at) + payload[at:end] + b"\r\n")
        at = end
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size line missing")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def record(kind: str, headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without its last CRLF."""
    fields = [("WARC-Type", kind), *headers, ("Content-Length", len(block))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return MARK + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n"


def safe_uri(url: str | None) -> str:
    clean = "".join(c if c > " " else f"%{ord(c):02X}" for c in (url or "about:blank"))
    return clean.replace("WARC/1.1", "WARC%2F1.1")


def page_records(name: str, page_id, url, payload: bytes, refers_to, segment_bytes: int) -> Iterator[bytes]:
    ident = f"<urn:page:{name}>"
    common = [("WARC-Record-ID", ident), ("WARC-Target-URI", safe_uri(url)), ("X-Page-ID", page_id),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", "sha1:" + digest(payload))]
    if refers_to is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: %d\r\n\r\n" % len(payload)
        yield record("revisit", [*common, ("X-Refers-To-Page-ID", refers_to),
                     ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], block)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        yield record("response", common, block)
        return
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield record("response", [*common, ("WARC-Segment-Number", 1)], parts[0])
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if k == len(parts) else []
        yield record("continuation", [("WARC-Record-ID", f"<urn:page:{name}:{k}>"), ("WARC-Segment-Origin-ID", ident),
                     ("WARC-Segment-Number", k), *last], part)


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, min_revisit_bytes: int = 0) -> None:
    """Write page_id, url, html as archives in the folder ``path``."""
    ship(pages.sparkSession)
    pages = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("__payload"))
    pages = pages.withColumns({"__sha": F.unhex(F.sha1("__payload")), "__size": F.octet_length("__payload")})
    copies = stored(
        pages.where(F.col("__size") >= min_revisit_bytes).groupBy("__sha", "__size")
        .agg(F.max("page_id").alias("__keeper"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1").select("__sha", "__size", "__keeper"),
        "equal-payloads",
    )
    marked = pages.join(copies, ["__sha", "__size"], "left").select(
        "page_id", "url", "__payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("__keeper")), F.col("__keeper")).alias("__refers"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out, size = [], 0
            for i in range(batch.num_rows):
                page, url, payload, refers = (batch.column(c)[i].as_py() for c in range(4))
                row += 1
                for r in page_records(f"{part}-{row}", page, url, payload, refers, segment_bytes):
                    out.append(r)
                    size += len(r)
                if size > _OUT:
                    yield arrow_rows(value=(out, pa.binary()))
                    out, size = [], 0
            if out:
                yield arrow_rows(value=(out, pa.binary()))

    rows = marked.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    rows.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


_FIELDS = "record_id string, type string, page_id string, refers_to string, origin_id string, segment long, total long, digest string, url string, block binary, status string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record."""
    ship(spark)
    raw = spark.read.option("lineSep", MARK.decode() + "\r\n").text(path)
    raw = raw.where(F.octet_length("value") > 0).select(F.col("value").cast("binary").alias("value"))
    names = ["WARC-Record-ID", "WARC-Type", "X-Page-ID", "X-Refers-To-Page-ID", "WARC-Segment-Origin-ID",
             "WARC-Segment-Number", "WARC-Segment-Total-Length", "WARC-Payload-Digest", "WARC-Target-URI"]

    def number(text: bytes | None) -> int | None:
        """A field's count of at most 18 digits; None if it is something else."""
        return int(text) if text is not None and text.isdigit() and len(text) <= 18 else None

    def parse(value: bytes) -> tuple:
        head, _, rest = value.partition(b"\r\n\r\n")
        found = dict(x.split(b": ", 1) for x in head.split(b"\r\n") if b": " in x)
        size = number(found.get(b"Content-Length"))
        status = "ok" if size is not None and size <= len(rest) and rest[size:] == b"\r\n\r\n" else "record length"
        f: list = []
        for n in names:
            raw = found.get(n.encode())
            if n in ("WARC-Segment-Number", "WARC-Segment-Total-Length"):
                f.append(number(raw))
                bad = raw is not None and f[-1] is None
            else:
                f.append(None if raw is None else raw.decode(errors="replace"))
                bad = raw is not None and "\ufffd" in f[-1] and b"\xef\xbf\xbd" not in raw
            if bad and status == "ok":
                status = "header"
        return (*f, rest[: size or 0], status)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parse(v.as_py()) for v in batch.column(0)]
            types = [pa.string()] * 5 + [pa.int64()] * 2 + [pa.string()] * 2 + [pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                names=[x.split()[0] for x in _FIELDS.split(", ")],
            )

    return raw.mapInArrow(run, _FIELDS)


def reassembled(records: DataFrame) -> DataFrame:
    """One row per response or revisit: ids, digest, ``parts`` (blocks in order) and status."""
    plain = records.where("segment IS NULL").select(
        "page_id", "type", "refers_to", "digest", "url", F.array("block").alias("parts"), "status"
    )
    pieces = records.where("segment IS NOT NULL").withColumn("__origin", F.coalesce("origin_id", "record_id"))
    grouped = pieces.groupBy("__origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("s"),
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("page_id", "type", "refers_to", "digest", "url")],
        F.max("total").alias("total"),
        F.max(F.when(F.col("status") != "ok", F.col("status"))).alias("bad"),
    )
    numbers = F.transform("s", lambda x: x["segment"])
    size = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x["block"]))
    status = (
        F.when(F.col("bad").isNotNull(), F.col("bad"))
        .when(~(numbers == F.sequence(F.lit(1).cast("long"), F.size("s").cast("long"))), F.lit("segment numbers"))
        .when(F.col("total").isNull() | (size != F.col("total")), F.lit("total length"))
        .otherwise(F.lit("ok"))
    )
    return plain.unionByName(
        grouped.select("page_id", "type", "refers_to", "digest", "url", F.transform("s", lambda x: x["block"]).alias("parts"), status.alias("status"))
    )


def payloads(records: DataFrame, with_payload: bool = True) -> DataFrame:
    """page_id, record_type, refers_to, payload_bytes, payload_digest, status and, if asked for, the payload.

    A revisit has no payload of its own: its size and digest are those its record states.
    """
    def decode(parts: list[bytes], kind: str, stated: str | None):
        head, _, body = b"".join(parts).partition(b"\r\n\r\n")
        fields = dict(x.lower().split(b": ", 1) for x in head.split(b"\r\n") if b": " in x)
        want = (stated or "").removeprefix("sha1:")
        if kind == "revisit":
            return None, int(fields.get(b"content-length", b"0")), want
        payload = unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body
        own = digest(payload)
        if want and own != want:
            raise ValueError("payload digest")
        return payload, len(payload), own

    types = dict(page_id=pa.string(), record_type=pa.string(), refers_to=pa.string(), payload_bytes=pa.int64(),
                 payload_digest=pa.string(), status=pa.string(), payload=pa.binary())
    if not with_payload:
        types.pop("payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in range(batch.num_rows):
                page, kind, refers, stated, _, parts, status = (batch.column(c)[r].as_py() for c in range(7))
                payload = size = own = None
                if status == "ok":
                    try:
                        payload, size, own = decode(parts, kind, stated)
                    except ValueError as e:
                        status = str(e)
                rows.append((page, kind, refers, size, own, status, payload)[: len(types)])
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))

    schema = "page_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, status string"
    return reassembled(records).mapInArrow(run, schema + (", payload binary" if with_payload else ""))


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path, segment_bytes, min_revisit_bytes)
    kind = pages.schema["page_id"].dataType
    return payloads(read_records(spark, path), with_payload=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "status",
    )
