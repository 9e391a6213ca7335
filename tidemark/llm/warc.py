"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Writing is all SQL: each record is one line of Spark's text writer, whose line
separator is the blank line that ends a record. Files are thus committed, retried
and stored as any other Spark output. Of pages with equal payloads the one with
the smallest page_id is the response, the others refer to it. Groups are found
by digest with partial sums; only groups of more than one page are joined back,
and Spark broadcasts them only below its own size threshold.

Reading takes records one after the other, plain or as gzip members. A record
counts if its version line, length, closing blank line and digest are right.
Where one fails, the reader looks for the next place at which a record is valid,
goes on there, and reports the bytes between as a gap. A member is unpacked as far
as it goes, also if it is damaged or ends early, and its content is read likewise.

A null html is an empty payload; payloads of equal pages may be empty too. Null
urls are written as empty. Rows that repeat a page_id are written one by one: of
equal payloads, every row under the smallest page_id is a response. A null page_id
ranks last. An empty table gives an archive without records. Files hold as many
records as fit ``FILE_BYTES`` by the largest of them, and at least one, so a
payload may be as large as Spark's rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import workspace

END = "\r\n\r\n"
PAGE = "urn:page:"
#: Records and bytes of one file at most, so that a reader can hold a file.
FILE_RECORDS = 2000
FILE_BYTES = 256 << 20
#: Bytes of a record besides its url and payload, at most.
HEAD_BYTES = 1024
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
STARTS = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
VERSION_LINE = re.compile(rb"\nWARC/1\.[01]\r\n")


def base32_of_hex(digest):
    """Base32 of a SHA-1 in hex: eight times five hex digits make four base32 ones."""
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    plain, base32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.translate(F.concat(*parts), plain, base32)


def _record(fields: list[tuple], body):
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    length = F.octet_length(body).cast("string")
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines, F.concat(F.lit("Content-Length: "), length))
    return F.concat(head, F.lit(END), body)


def write(
    pages: DataFrame, path: str, smallest_payload: int = 0, file_records: int = FILE_RECORDS, file_bytes: int = FILE_BYTES
) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) below ``path``.

    Payloads of fewer than ``smallest_payload`` bytes are always written in full.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", " ").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    key = F.sha2(F.col("html").cast("binary"), 256).alias("payload_key")
    measured = Observation()
    largest = F.max(F.octet_length("html").cast("long") + F.octet_length("url")).alias("largest")
    groups = (
        rows.observe(measured, largest)
        .where(F.octet_length("html") >= smallest_payload)
        .select("page_id", key)
        .groupBy("payload_key")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("payload_key", "first_id")
    )
    groups, _ = workspace(spark, "warc-groups").store(groups, "groups")
    joined = rows.withColumn("payload_key", key).join(groups, "payload_key", "left")
    longest = 0 if pages.isEmpty() else measured.get["largest"]  # Spark measures nothing in a plan without rows
    file_records = max(1, min(file_records, file_bytes // ((longest or 0) + HEAD_BYTES)))
    page_id = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    digest = F.concat(F.lit("sha1:"), base32_of_hex("sha1"))
    length = F.octet_length("html").cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length, F.lit(END)
    )
    common = [
        ("WARC-Record-ID", F.concat(F.lit(f"<{PAGE}"), page_id, F.lit(">"))),
        ("WARC-Date", F.lit("2000-01-01T00:00:00Z")),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", digest),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ]
    response = _record([("WARC-Type", F.lit("response")), *common], F.concat(http, F.col("html")))
    refers = F.concat(F.lit(f"<{PAGE}"), F.col("first_id").cast("string"), F.lit(">"))
    revisit = _record(
        [("WARC-Type", F.lit("revisit")), *common, ("WARC-Refers-To", refers), ("WARC-Profile", F.lit(PROFILE))], http
    )
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    line = F.when(again, revisit).otherwise(response)
    joined.select(line.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", file_records).text(path)


# -- reading -----------------------------------------------------------------------------


def _parse(data: bytes, at: int) -> dict | str:
    """The record at ``at``, or what is wrong with it."""
    if not VERSION.match(data, at):
        return "no version line"
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0 or VERSION_LINE.search(data, at, head_end):  # the next record's
        return "no end of the header"
    lines = data[at:head_end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    if not re.fullmatch("[0-9]{1,18}", fields.get("content-length", "")):
        return "no length"
    start = head_end + 4
    end = start + int(fields["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return "no blank line where the record should end"
    block = data[start:end]
    http, payload = {}, block
    if fields.get("content-type", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        if cut < 0:
            return "no end of the HTTP header"
        lines = block[:cut].decode("utf-8", "replace").split("\r\n")[1:]
        http = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        payload = block[cut + 4 :]
    told = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") != "revisit" and told.startswith("sha1:") and told[5:] != sha1_base32(payload):
        return "the payload does not have its digest"
    return {"end": end + 4, "fields": fields, "http": http, "payload": payload}


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _inflate(data: bytes, at: int) -> tuple[bytes, int | None, str]:
    """All that the gzip member at ``at`` gives, its end (None if damaged), and what is wrong with it."""
    unpack, out, size = zlib.decompressobj(31), [], 1 << 16
    while at < len(data) and not unpack.eof:
        piece, before = data[at : at + size], unpack.copy()
        try:
            out.append(unpack.decompress(piece))
            at += len(piece)
        except zlib.error as error:  # output of the failing step is lost: make the step smaller
            unpack = before
            if size > 1:
                size //= 2
                continue
            try:  # what the bad byte still gives
                while got := unpack.decompress(piece, 1):
                    out.append(got)
                    piece = unpack.unconsumed_tail
            except zlib.error:
                pass
            return b"".join(out), None, f"gzip: {error}"
    if not unpack.eof:
        return b"".join(out), None, "gzip: the member ends early"
    return b"".join(out), at - len(unpack.unused_data), ""


def _member(data: bytes, at: int) -> dict | str:
    """All valid records of the gzip member at ``at``, with the gaps between them.

    A damaged member ends where its last valid record has been unpacked. A record that
    noise follows there, neither another record nor the end, does not count.
    """
    inner, end, reason = _inflate(data, at)
    found = list(salvage(inner, packed=False))
    valid = [stop for _, stop, record in found if not isinstance(record, str)]
    if end is None and valid and not b"WARC/1.".startswith(inner[valid[-1] : valid[-1] + 7]):
        valid.pop()
    if not valid and (inner or reason):
        return reason or found[0][2]
    if end is None:
        unpack = zlib.decompressobj(31)
        unpack.decompress(memoryview(data)[at:], valid[-1] - 1)  # not on to the check sum
        end = len(data) - len(unpack.unconsumed_tail)
        found = [x for x in found if x[1] <= valid[-1]]
    records = [f"{record}, from byte {a} to {b} of the member's content" if isinstance(record, str) else record for a, b, record in found]
    return {"end": end, "records": records, "reason": reason}


def salvage(data: bytes, packed: bool = True) -> Iterator[tuple[int, int, dict | str]]:
    """(start, end, record) in order; a gap has the reason in place of the record.

    Records of a gzip member, and gaps in its content, have the range of the member.
    Without ``packed``, there are no members.
    """
    at = gap = 0
    reason = ""
    starts = STARTS if packed else VERSION
    while at < len(data):
        found = _member(data, at) if packed and data[at : at + 3] == b"\x1f\x8b\x08" else _parse(data, at)
        if isinstance(found, str):
            reason = reason or found
            ahead = starts.search(data, at + 1)
            at = ahead.start() if ahead else len(data)
            continue
        if gap < at:
            yield gap, at, reason
        for record in found.get("records", [found]):
            yield at, found["end"], record
        at = gap = found["end"]
        reason = found.get("reason", "")
        if reason and at < len(data):  # the rest of a damaged member
            ahead = starts.search(data, at)
            at = ahead.start() if ahead else len(data)
    if gap < at:
        yield gap, at, reason


RECORDS = (
    "file string, start long, end long, gap string, record_type string, record_id string, target_uri string, "
    "payload_digest string, refers_to string, http_length long, payload_bytes long"
)


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """All records and gaps of the files below ``path``; with their payloads if asked for.

    A gap has its reason in ``gap`` and its bytes from ``start`` to ``end``.
    """

    def run(batches):
        for batch in batches:
            for file, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows = []
                for start, end, found in salvage(content.as_py()):
                    row = {"file": file, "start": start, "end": end}
                    if isinstance(found, str):
                        rows.append(row | {"gap": found})
                        continue
                    fields, length = found["fields"], found["http"].get("content-length", "")
                    rows.append(
                        row
                        | {
                            "record_type": fields.get("warc-type"),
                            "record_id": fields.get("warc-record-id"),
                            "target_uri": fields.get("warc-target-uri"),
                            "payload_digest": fields.get("warc-payload-digest"),
                            "refers_to": fields.get("warc-refers-to"),
                            "http_length": int(length) if length.isdigit() else None,
                            "payload_bytes": len(found["payload"]),
                        }
                        | ({"payload": found["payload"]} if payloads else {})
                    )
                for a in range(0, len(rows), 500):
                    yield pa.RecordBatch.from_pylist(rows[a : a + 500], schema=schema)

    names = [tuple(x.split()) for x in RECORDS.split(", ")]
    schema = pa.schema([(n, pa.int64() if kind == "long" else pa.string()) for n, kind in names])
    if payloads:
        schema = schema.append(pa.field("payload", pa.binary()))
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, RECORDS + (", payload binary" if payloads else ""))


def pages(records: DataFrame) -> DataFrame:
    """What the archive says of each page; a revisit has the length of the page it refers to."""
    number = r"<urn:page:(-?\d+)>"
    revisit = F.col("record_type") == "revisit"

    def page(column):
        return F.regexp_extract(column, number, 1).try_cast("long")

    return records.where("gap IS NULL").select(
        page("record_id").alias("page_id"),
        F.when(revisit, F.col("http_length")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type",
        F.when(revisit, page("refers_to")).alias("refers_to"),
    )
