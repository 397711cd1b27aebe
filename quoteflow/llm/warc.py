"""Write web pages as WARC archives, and read archives back even where they are damaged."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteflow.plans.workspace import materialize

# The alphabet of base32, the version lines, the names of fields, and the mark of a gzip member.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
GZIP = b"\x1f\x8b\x08"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
ID = "urn:page:"


def sha1_base32(data: Column) -> Column:
    """SHA-1 as 32 characters of base32."""
    digits = F.sha1(data)
    parts = []
    for k in range(8):  # five hexadecimal digits are four characters
        value = F.conv(F.substring(digits, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            parts.append(F.substr(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*parts)


def warc_records(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    text_column: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """One column ``record`` with a WARC record per row, without the two line ends that close it.

    The payload is the text in UTF-8, null being empty. Of rows with equal payloads of at least
    ``min_bytes`` the one with the smallest id is a response and others are revisits that refer to it;
    rows that repeat the smallest id are all responses, and so are rows of a payload that has no id but
    null. Only digests that occur more than once, and their smallest ids, are joined to the pages.
    """
    payload = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    key = F.col(id_column)
    named = pages.select(
        key.alias("id"),
        F.col(url_column).alias("url"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        sha1_base32(payload).alias("digest"),
        F.length(payload).alias("size"),
    )
    firsts = named.where(F.col("size") >= min_bytes).groupBy("digest", "size")
    firsts = firsts.agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    firsts = materialize(firsts.drop("rows"), "first-pages")
    joined = named.join(firsts, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    field = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    clean = F.regexp_replace("url", r"[\r\n]+", " ")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit(f"<{ID}"), F.col("id").cast("string"), F.lit(">"))),
        field("WARC-Target-URI", clean),
        field("WARC-Date", F.lit(date)),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("X-Payload-Length", F.col("size").cast("string")),
        field("WARC-Refers-To", F.when(revisit, F.concat(F.lit(f"<{ID}"), F.col("first").cast("string"), F.lit(">")))),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", (F.when(revisit, 0).otherwise(F.col("size")) + len(HTTP)).cast("string")),
        F.lit("\r\n" + HTTP),
    )
    return joined.select(F.concat(head, F.when(revisit, "").otherwise(F.col("text"))).alias("record"))


def write_warc(records: DataFrame, path: str, records_per_file: int = 2000) -> None:
    """Write `warc_records` as plain archives. A record ends with two line ends, which part the rows of a text file."""
    writer = records.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file)
    writer.text(path)


class Found(NamedTuple):
    """A record, or a stretch of bytes that holds none (``reason`` says why).

    ``length`` counts the bytes of the archive that this is about, each byte once: of the records of a gzip
    member the first has them all, and records saved from a damaged member have none, as a gap covers it. ``inner`` is
    where the record begins, or the gap is, in the unpacked member.
    """

    offset: int
    length: int
    fields: dict[str, str]
    payload: bytes
    reason: str | None
    inner: int = 0


class _Finder:
    """The next place of a pattern, for places that rise; what has been found is not looked for again."""

    def __init__(self, pattern: re.Pattern, data: bytes):
        self.pattern, self.data, self.found = pattern, data, -1

    def after(self, at: int) -> int:
        if self.found < at:
            following = self.pattern.search(self.data, at)
            self.found = following.start() if following else len(self.data)
        return self.found


class _Plain:
    """Records one after the other in some bytes."""

    def __init__(self, data: bytes):
        self.data = data
        self.heads, self.versions = _Finder(re.compile(rb"\r\n\r\n"), data), _Finder(VERSION, data)

    def record(self, at: int) -> tuple[int, dict[str, str], bytes]:
        """End, fields and block of the record that begins at ``at``; ValueError if it isn't whole."""
        data = self.data
        if not VERSION.match(data, at):
            raise ValueError("no version line")
        head = self.heads.after(at)
        if head == len(data):
            raise ValueError("header without an end")
        if self.versions.after(at + 1) < head + 2:
            raise ValueError("another record begins in the header")
        lines = []
        for line in data[at:head].split(b"\r\n")[1:]:
            if line[:1] in (b" ", b"\t") and lines:
                # A folded line goes on with the value before it.
                lines[-1] += b" " + line.strip()
            else:
                lines.append(line)
        fields = {}
        for line in lines:
            name, colon, value = line.partition(b":")
            if not colon:
                raise ValueError("header line without a colon")
            fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
        size = fields.get("content-length", "")
        if not (size.isascii() and size.isdigit()):
            raise ValueError("no content length")
        begin = head + 4
        end = begin + int(size)
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError("record doesn't end where it should")
        block = data[begin:end]
        wanted = fields.get("warc-block-digest", "")
        if wanted.startswith("sha1:") and base64.b32encode(hashlib.sha1(block).digest()).decode() != wanted[5:]:
            raise ValueError("block digest differs")
        return end + 4, fields, block


def _payload(fields: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP header; ValueError if it isn't what the digest says."""
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    wanted = fields.get("warc-payload-digest", "")
    if wanted.startswith("sha1:") and fields.get("warc-type") != "revisit":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != wanted[5:]:
            raise ValueError("payload digest differs")
    return payload


# Bytes that a decompressor gets at a time, from the first to the last number: what lies behind a member is copied back, so it
# must be little. A member unpacks to something after so many bytes: names in a header aren't longer.
_CHUNKS = (1 << 9, 1 << 14)
_LONGEST_HEADER = 1 << 12


def _member(data: bytes, at: int) -> tuple[int, bytes, str | None]:
    """End and content of the gzip member that begins at ``at``; if it isn't whole, what can be unpacked and why."""
    unpack, parts, view = zlib.decompressobj(31), [], memoryview(data)
    begin, size, unpacked = at, _CHUNKS[0], 0
    while at < len(data):
        # Should a chunk fail, its beginning may still unpack.
        before = unpack.copy()
        try:
            parts.append(unpack.decompress(view[at : at + size]))
        except zlib.error as fault:
            span = view[at : at + size]
            while len(span) > 1:
                half, trial = len(span) // 2, before.copy()
                try:
                    parts.append(trial.decompress(span[:half]))
                    before, span = trial, span[half:]
                except zlib.error:
                    span = span[:half]
            return at, b"".join(parts), f"gzip member: {fault}"
        at += size
        unpacked += len(parts[-1])
        if unpack.eof:
            return min(at, len(data)) - len(unpack.unused_data), b"".join(parts), None
        if not unpacked and at - begin > _LONGEST_HEADER:
            return at, b"", "gzip member without content"
        size = min(2 * size, _CHUNKS[1])
    return len(data), b"".join(parts), "gzip member ends early"


def _records(data: bytes, packed: bool) -> Iterator[Found]:
    """Records and gaps of plain bytes; with ``packed`` members of gzip may stand between them."""
    at, gap, reason = 0, None, None
    plain = _Plain(data)
    starts = _Finder(re.compile(VERSION.pattern + b"|" + re.escape(GZIP)) if packed else VERSION, data)
    while at < len(data):
        found, fault, end = [], None, at
        if packed and data.startswith(GZIP, at):
            end, content, fault = _member(data, at)
            found = list(_records(content, False))
            if not any(one.reason is None for one in found):
                fault = fault or (found[0].reason if found else "empty gzip member")
                found = []
            elif fault is not None:
                # The gap in the archive stands for the rest of the member.
                found = [one for one in found if one.reason is None]
        else:
            try:
                end, fields, block = plain.record(at)
                found = [Found(at, end - at, fields, _payload(fields, block), None)]
            except ValueError as error:
                fault = str(error)
        if gap is not None and fault is None:
            yield Found(gap, at - gap, {}, b"", reason)
            gap = None
        for k, one in enumerate(found):
            if packed and data.startswith(GZIP, at):
                one = one._replace(offset=at, length=end - at if k == 0 and fault is None else 0, inner=one.offset)
            yield one
        if fault is None:
            at = end
            continue
        if gap is None:
            gap, reason = at, fault
        at = starts.after(at + 1)
    if gap is not None:
        yield Found(gap, len(data) - gap, {}, b"", reason)


def salvage(data: bytes) -> Iterator[Found]:
    """All whole records of an archive, plain or of gzip members, and the stretches between them.

    When a record fails a check, reading goes on at the next version line or beginning of a member
    from which a whole record can be read. A member may hold any number of records. Of one that is cut short or
    damaged the whole records before the damage are read, and the member is a gap. Every byte is part of a record or of a
    reported gap. The time grows with the bytes, however many members there are.
    """
    return _records(data, True)


SCHEMA = (
    "path string, offset long, length long, inner long, gap string, record_type string, record_id string, refers_to string, "
    "target_uri string, payload_bytes long, payload_digest string, fields map<string, string>, payload binary"
)
_ROWS = 500


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in ``path``, and one per stretch that could not be read.

    For records ``gap`` is null; for gaps it says which check failed first, and ``offset`` and ``length``
    say which bytes to look at, ``inner`` where in an unpacked gzip member (see `Found`). ``payload_bytes`` and ``payload_digest`` are those of the full payload,
    for revisits as their header gives them. A task reads an archive as a whole, so archives must fit
    in its memory (`write_warc` makes them small; 2 GB is the most that Spark reads as one value). An
    empty folder gives no rows.
    """
    schema = pa.schema(
        [
            ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
            ("inner", pa.int64()), ("gap", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
            ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
        ]
    )

    def row(path: str, found: Found) -> tuple:
        if found.reason is not None:
            return (path, found.offset, found.length, found.inner, found.reason, *[None] * 8)
        fields = found.fields
        kind = fields.get("warc-type")
        size, digest = len(found.payload), None
        if kind == "revisit":
            given = fields.get("x-payload-length", "")
            size = int(given) if given.isascii() and given.isdigit() else None
            digest = fields.get("warc-payload-digest", "sha1:")[5:] or None
        else:
            digest = base64.b32encode(hashlib.sha1(found.payload).digest()).decode()
        bare = lambda name: fields[name].strip("<>") if name in fields else None
        return (
            path, found.offset, found.length, found.inner, None, kind, bare("warc-record-id"), bare("warc-refers-to"),
            fields.get("warc-target-uri"), size, digest, list(fields.items()), found.payload if payloads else None,
        )

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                rows = []
                for found in salvage(batch.column(1)[k].as_py()):
                    rows.append(row(batch.column(0)[k].as_py(), found))
                    if len(rows) == _ROWS:
                        yield packed(rows)
                        rows = []
                if rows:
                    yield packed(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, SCHEMA)
