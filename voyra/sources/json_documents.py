"""JSON files that hold several documents one after the other.

A crawler that opens its file with mode 'a' and dumps one indented object a run
leaves objects back to back, ``}{`` and all: neither JSON lines nor one JSON value a
file. ``split`` cuts such a text where the depth of braces outside strings returns to
zero, and says of everything else what it is: text between objects, an object that
the file's end cuts off, a stray brace. Where ``starts`` tells how an object
begins, one that was cut off (a run that died) ends at the next such beginning, so
the objects that later runs appended are found.

Files are whole rows (a file is never cut over tasks, and Spark's reader takes
them up to 2 GB); files spread over tasks by size.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE, BACKSLASH, OPEN, CLOSE = b'"\\{}'
_MARK = np.zeros(256, bool)
_MARK[[QUOTE, OPEN, CLOSE]] = True

PIECES = "path string, place long, body string, fault string"

Piece = tuple[int, int, str | None]        # start, end, what is wrong


def _braces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the braces outside strings, and +1 or -1 for each."""
    at = np.flatnonzero(_MARK[data])
    kind = data[at]
    quotes = kind == QUOTE
    # a quote after an odd number of backslashes belongs to its string
    odd = np.zeros(len(at), bool)
    back, look = at - 1, quotes.copy()
    while True:
        look &= back >= 0
        look[look] = data[back[look]] == BACKSLASH
        if not look.any():
            break
        odd[look] = ~odd[look]
        back = back - 1
    quotes &= ~odd
    inside = (np.cumsum(quotes) - quotes) % 2 == 1
    brace = (kind != QUOTE) & ~inside
    return at[brace], np.where(kind[brace] == OPEN, 1, -1)


def _parses(body: bytes) -> bool:
    try:
        json.loads(body)
    except ValueError:
        return False
    return True


def split(body: bytes | memoryview, starts: str | None = None) -> Iterator[Piece]:
    """Objects of ``body`` in order, and the stretches that are none (white space aside)."""
    data = np.frombuffer(body, np.uint8)
    begins = [m.start() for m in re.finditer(starts.encode(), body)] if starts else []

    def gap(lo: int, hi: int) -> Iterator[Piece]:
        if bytes(body[lo:hi]).strip():
            yield lo, hi, "text between objects"

    def next_start(lo: int) -> int | None:
        i = int(np.searchsorted(begins, lo, side="right")) if begins else 0
        return begins[i] if i < len(begins) else None

    here = 0
    while here < len(body):
        at, step = _braces(data[here:])
        at = at + here
        depth = np.cumsum(step)
        stray = np.flatnonzero(depth < 0)
        closed = np.flatnonzero((step < 0) & (depth == 0))
        if len(stray):
            closed = closed[closed < stray[0]]
        opened = np.concatenate([[0], closed + 1])[: len(closed)]
        resume = None
        for i, j in zip(opened, closed):
            lo, hi = int(at[i]), int(at[j]) + 1
            later = next_start(lo)
            if later is not None and later < hi and not _parses(bytes(body[lo:hi])):
                resume = later                     # a cut-off object that swallowed others
                yield from gap(here, lo)
                yield lo, later, "object without an end"
                break
            yield from gap(here, lo)
            yield lo, hi, None
            here = hi
        if resume is None and len(stray):
            yield from gap(here, int(at[stray[0]]))
            yield int(at[stray[0]]), int(at[stray[0]]) + 1, "stray closing brace"
            resume = int(at[stray[0]]) + 1
        elif resume is None:
            rest = at[at >= here]
            if not len(rest):
                yield from gap(here, len(body))
                return
            lo = int(rest[0])
            yield from gap(here, lo)
            later = next_start(lo)
            yield lo, len(body) if later is None else later, "object without an end"
            resume = len(body) if later is None else later
        here = resume


def read_pieces(spark: SparkSession, path: str, glob: str | None = None, starts: str | None = None) -> DataFrame:
    """(path, place, body, fault): every object of the files below ``path``, and every
    stretch that is none with its fault; ``place`` is its first byte in the file."""
    r = spark.read.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, text in zip(b.column(0), b.column(1)):
                body = memoryview(text.as_buffer() or b"").cast("B")          # the batch's own bytes, not a copy
                found = list(split(body, starts))
                # objects leave in blocks, so a large file isn't doubled in one batch
                for k in range(0, len(found), 512):
                    part = found[k: k + 512]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name.as_py()] * len(part), pa.string()), pa.array([p[0] for p in part], pa.int64()),
                         pa.array([str(body[p[0]: p[1]], "utf-8") for p in part], pa.string()),
                         pa.array([p[2] for p in part], pa.string())],
                        ["path", "place", "body", "fault"])

    return files.mapInArrow(cut, PIECES)


def read_documents(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                   starts: str | None = None) -> DataFrame:
    """(path, place, document, fault, body): ``document`` has the type ``schema``; where it can't
    be read ``fault`` says why and ``body`` holds the text, else both are null. Nothing is
    left out: every byte but white space is in a document or in a faulty row."""
    p = read_pieces(spark, path, glob, starts)
    kept = "_unread"
    wide = T.StructType([*schema.fields, T.StructField(kept, T.StringType())])
    p = p.withColumn("d", F.when(F.col("fault").isNull(), F.from_json(
        "body", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": kept})))
    fault = F.coalesce("fault", F.when(F.col("d").isNull() | F.col(f"d.{kept}").isNotNull(), F.lit("not of the schema")))
    p = p.withColumn("fault", fault)
    document = F.when(F.col("fault").isNull(), F.struct(*[F.col(f"d.{f.name}") for f in schema.fields]))
    return p.select("path", "place", document.alias("document"), "fault",
                    F.when(F.col("fault").isNotNull(), F.col("body")).alias("body"))
