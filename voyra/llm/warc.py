"""WARC archives with revisit records for repeated payloads.

``write_archives`` turns pages into WARC records: of the records whose payloads
are equal (and at least ``min_bytes`` long) the one with the largest id is
written in full, the others as revisit records that name it. Only headers
(id, digest, length) are shuffled by payload digest; the payload itself moves
once, to meet the decision for its record. The records are text (headers, CRLF,
UTF-8 payload), so Spark's own text writer puts them into gzip files through
its commit protocol, with the record separator as line separator. Files are limited by
bytes: payloads of each size class go to files of their own, with as many records as
keep a file below ``FILE_BYTES``. ``read_archives`` reads the files as binary,
uncompressed or of any number of gzip members (the usual form has one for each record),
unpacks them piece by piece, and cuts records by their Content-Length; what it holds is
the packed file and one record.

Defined results: a null payload is empty; rows with the same id and payload are
all responses, or all revisit one with a larger id; a null id is smaller than
any other and is written as an empty header; line breaks in a URL are written
percent-encoded; an empty table gives no records; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voyra.llm.common import scratch
from voyra.session import scratch_dir

END = "\r\n\r\n"
FILE_BYTES = 1 << 30              # Spark's reader takes files up to 2 GB
SIZE_CLASSES = (1 << 17, 1 << 23)  # payloads up to these sizes share files with their like; larger ones get one each
PIECE = 1 << 20                   # packed bytes that are unpacked at once
BATCH = 256                       # records that leave a file together
DATE = "2024-01-01T00:00:00Z"     # fixed, so that a rerun writes the same archives

READ_SCHEMA = ("page_id long, url string, record_type string, payload_digest string, refers_to long, "
               "content_bytes long, digest_ok boolean")


def digest(payload: Column) -> Column:
    """Bare base32 SHA-1: five hex digits are 20 bits, which are four base-32 digits."""
    hex40 = F.sha1(payload)
    quads = [F.lpad(F.conv(F.substring(hex40, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, payload_digest, payload_bytes) -> the same with ``refers_to``: the id
    of the response that the record revisits, null for a response.

    The largest id for each digest comes from an aggregate with map-side
    combine; joining it back is a plain equi-join, which AQE splits where one
    payload holds a large part of all records.
    """
    first = (headers.filter(F.col("payload_bytes") >= min_bytes)
             .groupBy(F.col("payload_digest").alias("same_digest"), F.col("payload_bytes").alias("same_bytes"))
             .agg(F.max("page_id").alias("response_id"))
             .filter(F.col("response_id").isNotNull()))
    df = headers.join(first, (headers["payload_digest"] == first["same_digest"])
                      & (headers["payload_bytes"] == first["same_bytes"]), "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("response_id")),
                    F.col("response_id"))
    return df.select("page_id", "payload_digest", "payload_bytes", refers.alias("refers_to"))


def _uri(url: Column) -> Column:
    return F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record(page_id: Column, url: Column, payload: Column, sha: Column, refers_to: Column, refers_url: Column) -> Column:
    """Text of one WARC record, without the separator that ends it."""
    ident = F.coalesce(page_id.cast("string"), F.lit(""))
    uri = _uri(url)
    head = F.concat(F.lit("WARC-Record-ID: <urn:page:"), ident, F.lit(">\r\nWARC-Date: " + DATE + "\r\nWARC-Target-URI: "),
                    uri, F.lit("\r\nWARC-Payload-Digest: sha1:"), sha, F.lit("\r\n"))
    full = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\n"), head,
                    F.lit("Content-Type: text/html\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit(END), payload)
    short = F.concat(F.lit("WARC/1.1\r\nWARC-Type: revisit\r\n"), head,
                     F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
                           "WARC-Refers-To: <urn:page:"), refers_to.cast("string"),
                     F.lit(">\r\nWARC-Refers-To-Target-URI: "), _uri(refers_url),
                     F.lit("\r\nWARC-Refers-To-Date: " + DATE + "\r\nContent-Length: 0" + END))
    return F.when(refers_to.isNull(), full).otherwise(short)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES,
                   classes: tuple[int, ...] = SIZE_CLASSES) -> None:
    """Write (page_id, url, payload) as gzip WARC files under ``path``, a folder for each size class."""
    body = F.coalesce(F.col("payload"), F.lit(""))
    src = pages.select("page_id", "url", body.alias("payload"))
    # headers are made once: the decisions, their urls and the sizes are read from them
    headers = scratch(src.select("page_id", digest(F.col("payload")).alias("payload_digest"),
                                 F.octet_length("payload").cast("long").alias("payload_bytes"), "url"), "warc-headers")
    decided = (resolve(headers, min_bytes).filter(F.col("refers_to").isNotNull())
               .select(F.col("page_id").alias("again_id"), F.col("payload_digest").alias("again_digest"),
                       "refers_to").distinct())
    named = headers.groupBy(F.col("page_id").alias("named_id"), F.col("payload_digest").alias("named_digest")).agg(
        F.min("url").alias("refers_url"))
    decided = decided.join(named, (F.col("refers_to") == F.col("named_id"))
                           & (F.col("again_digest") == F.col("named_digest")), "left").drop("named_id", "named_digest")
    bounds = [-1, *classes, None]
    most = headers.agg(F.max("payload_bytes")).first()[0]
    for k, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        if most is None and k or most is not None and most <= lo:
            break
        n = F.octet_length("payload")
        mine = src.filter(n > lo) if k else src
        mine = mine.filter(n <= hi) if hi is not None and most is not None and most > hi else mine
        mine = mine.withColumn("sha", digest(F.col("payload")))
        out = mine.join(decided, mine["page_id"].eqNullSafe(decided["again_id"]) & (mine["sha"] == decided["again_digest"]), "left")
        text = record(F.col("page_id"), F.col("url"), F.col("payload"), F.col("sha"), F.col("refers_to"), F.col("refers_url"))
        (out.select(text).write.option("lineSep", END).option("compression", "gzip")
            .option("maxRecordsPerFile", 1 if hi is None else max(1, file_bytes // hi)).text(f"{path}/size-{k}"))


def _unpacked(blob: bytes) -> Iterator[bytes]:
    """The bytes of a file, piece by piece: every member of a gzip file, or the file itself."""
    if blob[:2] != b"\x1f\x8b":
        yield blob
        return
    at, member = 0, None
    while at < len(blob) or member is not None:
        if member is None:
            member = zlib.decompressobj(31)
        piece = blob[at: at + PIECE]
        at += len(piece)
        while True:
            out = member.decompress(piece, PIECE * 4)
            if out:
                yield out
            piece = member.unconsumed_tail
            if member.eof or not piece:
                break
        if member.eof:
            at -= len(member.unused_data)
            member = None
            while blob[at: at + 1] == b"\x00":            # padding after the last member
                at += 1
        elif at >= len(blob):
            raise ValueError("a gzip member has no end")


def _records(blob: bytes) -> Iterator[tuple]:
    pieces = _unpacked(blob)
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(pieces, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(1):
        stop = held.find(b"\r\n\r\n")
        while stop < 0:
            seen = len(held)
            if not fill(seen + 1):
                if held.strip(b"\r\n"):
                    raise ValueError("a record has no end of headers")
                return
            stop = held.find(b"\r\n\r\n", max(0, seen - 3))
        head = {}
        for line in held[:stop].decode("utf-8").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            head[name.lower()] = value.strip()
        size = int(head["content-length"])
        if not fill(stop + 4 + size):
            raise ValueError("a record is shorter than its Content-Length")
        payload = bytes(held[stop + 4: stop + 4 + size])
        fill(stop + 8 + size)                              # the separator; the last one may be missing
        del held[: stop + 8 + size]
        sha = head.get("warc-payload-digest", "").removeprefix("sha1:")

        def number(key: str) -> int | None:
            digits = head.get(key, "").removeprefix("<urn:page:").removesuffix(">")
            return int(digits) if digits.lstrip("-").isdigit() else None
        is_response = head["warc-type"] == "response"
        ok = base64.b32encode(hashlib.sha1(payload).digest()).decode() == sha if is_response else None
        yield (number("warc-record-id"), head.get("warc-target-uri", ""), head["warc-type"], sha,
               number("warc-refers-to"), size, ok, payload)


def read_archives(spark: SparkSession, path: str, payloads: bool = False, glob: str = "*.gz") -> DataFrame:
    """Headers of every record of the archives below ``path`` (and its ``payload``, if asked for);
    ``digest_ok`` says whether a response's payload has the digest of its header. A file
    that ends inside a record is an error, not a shorter result."""
    schema = READ_SCHEMA + (", payload binary" if payloads else "")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
             .load(path).select("content"))
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column(0):
                found = _records(blob.as_py())
                while rows := [r[: len(arrow)] for r in islice(found, BATCH)]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    return files.mapInArrow(run, schema)


def archive(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html",
            min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write ``pages`` as deduplicated archives, read them back, and join every
    revisit record to the response that it names."""
    spark = pages.sparkSession
    path = path or scratch_dir(spark, "warc")
    write_archives(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"),
                                F.col(payload).alias("payload")), path, min_bytes)
    back = read_archives(spark, path)
    response = (back.filter("record_type = 'response'")
                .groupBy(F.col("page_id").alias("response_id"), F.col("payload_digest").alias("response_digest"))
                .agg(F.max("content_bytes").alias("response_bytes")))
    df = back.join(response, (back["refers_to"] == response["response_id"])
                   & (back["payload_digest"] == response["response_digest"]), "left")
    return df.select("page_id", F.coalesce("response_bytes", "content_bytes").alias("payload_bytes"),
                     "payload_digest", "record_type", "refers_to")
