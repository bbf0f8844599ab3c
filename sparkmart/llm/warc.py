"""WARC archives with revisit records: equal payloads are stored once.

A page's payload is its html in UTF-8 (null: no bytes). Of pages with equal payloads of at least
min_bytes, the one with the smallest page_id keeps its payload in a response record; the others
become revisit records that refer to it. Which is which is settled on headers alone: digest,
length and id are shuffled by digest, summed per task first, and joined to the original of their
digest, a join whose hot keys Spark can split, since it has one row per digest. Payloads are
shuffled once, by page, to the archive that they are written to.

Each record is a gzip member of its own, so that one can be read without those before it; an
archive begins with a warcinfo record, and index_archives lists where every record's member lies.
Archives are written by Spark's text writer, one member per row: a member ends in a zero byte (the
high byte of its length; behind 16 MB and more an empty member follows), and that byte is written as
the line separator. So they can lie in any store that Spark writes, and a lost task is written
again. They are read back as binary files, member by member. Each record carries its page_id in a
header of its own, the digest and length of the full payload also where it is a revisit.

Repeated rows: pages with the same smallest page_id and payload are all responses, with record ids
of their own; a revisit then names its original by page and address only. A null page_id is never
referred to while another page has the payload; pages that all have none are responses each. Null
urls are written as an empty target. A very long payload is one record. An empty table gives no
records. Other columns, whatever their names, go no further.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import columns, slices
from sparkmart.staging import Staging

# Fixed values of the WARC 1.1 and HTTP formats and of base32.
VERSION = "WARC/1.1"
BREAK = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Payload bytes of an archive file, more or less; a file is read back by one task.
ARCHIVE_BYTES = 16 << 20


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base32: 32 digits of five bits each."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def headers(pages: DataFrame) -> DataFrame:
    """Id, url, digest and length of each page's payload, and the payload itself as text."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return columns(pages, "page_id", "url", "html").select(
        "page_id",
        F.coalesce("url", F.lit("")).alias("url"),
        payload.alias("payload"),
        base32_sha1(payload.cast("binary")).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )


def resolve_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """records (one for each page and payload, of so many copies) with record_type, and for revisits
    refers_to, refers_url and refers_copies of the original."""
    originals = (
        records.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "copies")).alias("first"))
        .select(
            F.col("payload_digest").alias("of_digest"), F.col("payload_bytes").alias("of_bytes"),
            F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
            F.col("first.copies").alias("first_copies"),
        )
    )
    same = (F.col("payload_digest") == F.col("of_digest")) & (F.col("payload_bytes") == F.col("of_bytes"))
    joined = records.join(originals, same, "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        *records.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
        F.when(revisit, F.col("first_url")).alias("refers_url"),
        F.when(revisit, F.col("first_copies")).alias("refers_copies"),
    )


KEY = ("page_id", "payload_digest", "payload_bytes")
#: Copies of a page with one payload that are dealt together.
HOT_COPIES = 1_000


def resolved_pages(pages: DataFrame, archives: int, min_bytes: int = 0, staging: Staging | None = None) -> DataFrame:
    """All pages with their payloads and what resolve_revisits says, dealt to so many archives."""
    staging = staging or Staging(pages.sparkSession)
    full = headers(pages)
    # Equal pages of one id get equal answers, so they are one before anything is shuffled.
    slim = full.groupBy(*KEY).agg(F.min("url").alias("url"), F.count(F.lit(1)).alias("copies"))
    answers = ("copies", "record_type", "refers_to", "refers_url", "refers_copies")
    parts = F.ceil(F.col("copies") / HOT_COPIES).alias("parts")
    settled = resolve_revisits(slim, min_bytes).select(*[F.col(c).alias(f"its_{c}") for c in KEY], *answers, parts)
    settled, seen = staging.write(settled, f"settled-{uuid.uuid4().hex}", {"hot": F.count_if(F.col("parts") > 1)})

    def same(left: DataFrame, right: DataFrame) -> Column:
        return reduce(Column.__and__, [left[c].eqNullSafe(right[f"its_{c}"]) for c in KEY])

    part = F.lit(0).cast("long")
    if seen["hot"]:
        # The copies of such a page are dealt to several archives; its answers go to each of them.
        hot = settled.where("parts > 1").select(*[f"its_{c}" for c in KEY], "parts")
        full = full.join(hot, same(full, hot), "left").drop(*[f"its_{c}" for c in KEY])
        part = F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1)))
    full = full.withColumn("part", part)
    full = full.withColumn("at", F.xxhash64(*KEY, "part")).repartition(archives, "at")
    settled = settled.withColumn("its_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    settled = settled.withColumn("its_at", F.xxhash64(*[f"its_{c}" for c in KEY], "its_part")).repartition(archives, "its_at")
    met = (full["at"] == settled["its_at"]) & (full["part"] == settled["its_part"]) & same(full, settled)
    return full.join(settled.hint("merge"), met).select(*headers(pages).columns, *answers)


def record_id(page_id: Column, digest: Column, copy: Column | None = None) -> Column:
    """A URN for a page with a payload, the same in every archive, or for one copy of it."""
    hexed = F.md5(F.concat_ws(" ", F.lit("page"), F.coalesce(page_id.cast("string"), F.lit("none")), digest, copy if copy is not None else F.lit(None).cast("string")).cast("binary"))
    parts = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def one_line(value: Column) -> Column:
    """Header values can't hold control characters."""
    return F.regexp_replace(value, r"[\x00-\x1F\x7F]", " ")


def record_text(date: str) -> Column:
    """The whole record of a resolved page, without the line breaks that end it."""
    revisit, digest = F.col("record_type") == "revisit", F.col("payload_digest")
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(BREAK * 2),
    )
    block_bytes = (F.octet_length(http) + F.octet_length(body)).cast("string")
    named = [
        ("WARC-Type", F.col("record_type")),
        ("WARC-Record-ID", F.when(F.col("copies") == 1, record_id(F.col("page_id"), digest)).otherwise(record_id(F.col("page_id"), digest, F.monotonically_increasing_id().cast("string")))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", one_line(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Refers-To", F.when(revisit & (F.col("refers_copies") == 1), record_id(F.col("refers_to"), digest))),
        ("WARC-Refers-To-Target-URI", F.when(revisit, one_line(F.col("refers_url")))),
        ("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("X-Page-ID", F.col("page_id").cast("string")),
        ("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", block_bytes),
    ]
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit(BREAK))) for k, v in named]
    return F.concat(F.lit(VERSION + BREAK), *[F.coalesce(x, F.lit("")) for x in lines], F.lit(BREAK), http, body)


def member(record: bytes) -> bytes:
    """A record as gzip members, the last of which ends in a zero byte."""
    packed = gzip.compress(record, 6, mtime=0)
    return packed if not packed[-1] else packed + gzip.compress(b"", mtime=0)


def info_record(name: str, date: str) -> bytes:
    """The record that begins an archive."""
    block = f"software: sparkmart{BREAK}format: WARC File Format 1.1{BREAK}".encode()
    own = uuid.uuid5(uuid.NAMESPACE_URL, f"{name} {date}")
    lines = [VERSION, "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{own}>", f"WARC-Date: {date}",
             "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return BREAK.join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, path: str, date: str) -> None:
    """Write resolved records, one archive for each partition that has some."""
    lines = records.select(record_text(date).alias("value"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = True
        for batch in batches:
            for part in slices(batch, "value"):
                rows = [member(v.as_py().encode() + b"\r\n\r\n")[:-1] for v in part.column(0)]
                if fresh:
                    rows.insert(0, member(info_record(f"{path} {TaskContext.get().partitionId()}", date))[:-1])
                    fresh = False
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])

    members = lines.mapInArrow(packed, "value BINARY").select(F.col("value").cast("string").alias("value"))
    members.write.option("lineSep", "\x00").text(path)


def members_in(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of the members of an archive; empty ones belong to those before."""
    at, found, whole = 0, None, memoryview(content)
    while at < len(content):
        stream, parts, stop = zlib.decompressobj(wbits=31), [], at
        while not stream.eof:  # a little at a time: what lies behind the member is copied
            if stop >= len(content):
                raise ValueError(f"the member at byte {at} doesn't end")
            parts.append(stream.decompress(whole[stop : stop + 16_384]))
            stop = min(stop + 16_384, len(content))
        record, length = b"".join(parts), stop - len(stream.unused_data) - at
        if record or found is None:
            if found:
                yield found
            found = (at, length, record)
        else:
            found = (found[0], found[1] + length, found[2])
        at += length
    if found:
        yield found


def records_in(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The headers and blocks of an archive's records, by their stated lengths."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8").split(BREAK)
        if lines[0] != VERSION:
            raise ValueError(f"no record begins at byte {at}: {lines[0][:40]!r}")
        named = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        at = start + int(named["Content-Length"])
        if content[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {start} doesn't end where it says")
        yield named, content[start:at]
        at += 4


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The pages of all archives under a path: id, url, length, digest, type and reference.

    Of response records the digest and length are taken anew from the payload and compared with
    the headers. With payloads, the html is a column too (null for revisits).
    """
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = "page_id BIGINT, url STRING, payload_bytes BIGINT, payload_digest STRING, record_type STRING, refers_to BIGINT"
    if payloads:
        names, schema = [*names, "html"], f"{schema}, html STRING"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                size = 0
                for named, block in (r for _, _, m in members_in(content.as_py()) for r in records_in(m)):
                    if named["WARC-Type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = named["WARC-Type"] == "response"
                    if response:
                        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if (own, len(payload)) != (digest, length):
                            raise ValueError(f"the payload of {named['WARC-Record-ID']} is damaged")
                    page, first = (named.get(k) for k in ("X-Page-ID", "X-Refers-To-Page-ID"))
                    row = (page and int(page), named["WARC-Target-URI"], length, digest, named["WARC-Type"], first and int(first))
                    rows.append((*row, payload.decode() if response else None) if payloads else row)
                    size += len(payload)
                    if len(rows) >= 5000 or size > 4 << 20:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    # An archive is one row: a task must not gather more of them than it needs.
    return _files(spark, path).select("content").mapInArrow(read, schema)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def index_archives(spark: SparkSession, path: str) -> DataFrame:
    """(url, date, record_id, record_type, payload_digest, page_id, archive, offset, length): where the
    member of every record lies. To read one, take length bytes at offset and unpack them."""
    names = ["url", "date", "record_id", "record_type", "payload_digest", "page_id", "archive", "offset", "length"]
    kinds = [*[pa.string()] * 5, pa.int64(), pa.string(), pa.int64(), pa.int64()]
    told = ("WARC-Target-URI", "WARC-Date", "WARC-Record-ID", "WARC-Type", "WARC-Payload-Digest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows = []
                for offset, length, record in members_in(content.as_py()):
                    for named, _ in records_in(record):
                        page = named.get("X-Page-ID")
                        rows.append((*[named.get(k) for k in told], page and int(page), archive, offset, length))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    schema = ", ".join(f"`{n}` {'STRING' if k == pa.string() else 'BIGINT'}" for n, k in zip(names, kinds))
    return _files(spark, path).select("path", "content").mapInArrow(read, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kinds.get(n, pa.string())) for n, values in zip(names, zip(*rows))], names
    )


def archive_pages(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    date: str | None = None,
    archive_bytes: int = ARCHIVE_BYTES,
) -> str:
    """Write deduplicated archives of pages (page_id, url, html) below a folder; their path. The date
    of the records is that of the run unless given.

    Their number follows from the bytes of all payloads, so that one of them fits a task.
    """
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    path = f"{folder}/warc-{uuid.uuid4().hex}"
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    write_archives(resolved_pages(pages, max(1, -(-total // archive_bytes)), min_bytes, Staging(pages.sparkSession, folder)), path, date)
    return path
