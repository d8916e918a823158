"""Substring deduplication by level-wise doubling.

A window is a run of consecutive words of one document. Windows of ``FIRST``
words that occur in one document only are dropped; those that are left are
extended to twice the length where the window that continues them is left as
well, and so on up to the wanted length (the last step overlaps its halves), or
until no candidate survives. Each level touches only what survived the level
before. On the last level a window is a repeat where its words also start in a
document with a smaller id, and the words that repeats cover are removed.

Hashes of the lower levels are filters and keep 40 bits (beside those of the
bucket): a false match only costs an entry on the next level. The last level
compares 64 bits.

Texts move twice, by block of documents: to meet the first level's survivors,
and to be cut. Between the levels there are only (document, place, hash)
entries, written to the scratch folder.

Defined results: a null or empty text has no words; rows with the same id are one
document as far as "smaller" goes, and each row gets its own result; a row
without an id stays as it is and counts for no other; an empty table gives an
empty result; other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from voyra.llm import bytehash as B, packs
from voyra.llm.common import fresh, scratch

WINDOW = 13
FIRST = 4
FILTER_BYTES, EXACT_BYTES = 5, 8
STATE = "block long, n long, docs binary, places binary, hashes binary"

Entries = tuple[np.ndarray, np.ndarray, np.ndarray]      # documents, places, hashes


def levels(window: int, first: int = FIRST) -> list[int]:
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def _gathered(parts: Iterator[tuple[np.ndarray, np.ndarray]], mode: str, pieces: int, width: int, fan: int) -> Iterator[pa.RecordBatch]:
    docs, hashes, size = [], [], 0
    for d, h in parts:
        docs.append(d)
        hashes.append(h)
        size += len(h)
        if size >= packs.BATCH_ENTRIES:
            yield packs.record_batch(packs.batch_rows(np.concatenate(docs), np.concatenate(hashes), mode, pieces, width, fan))
            docs, hashes, size = [], [], 0
    if size:
        yield packs.record_batch(packs.batch_rows(np.concatenate(docs), np.concatenate(hashes), mode, pieces, width, fan))


def _text_windows(src: DataFrame, length: int, mode: str, pieces: int, width: int) -> DataFrame:
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for s in B.slices(b.column(1)):
                at = s.window_ok(length)
                yield ids[s.lo + s.row[at]], B.window_hash(s.word_hash(), length)[at]
    fan = packs.FAN
    return src.mapInArrow(lambda it: _gathered(parts(it), mode, pieces, width, fan), packs.SCHEMA)


def _state_windows(state: DataFrame, mode: str, pieces: int, width: int) -> DataFrame:
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in batches:
            for docs, _, hashes in _entries(pa.Table.from_batches([b])):
                yield docs, hashes
    fan = packs.FAN
    return state.mapInArrow(lambda it: _gathered(parts(it), mode, pieces, width, fan), packs.SCHEMA)


def _entries(table: pa.Table) -> Iterator[Entries]:
    for r in table.to_pylist():
        docs, places = (np.frombuffer(pa.decompress(r[c], decompressed_size=8 * r["n"], codec="zstd", asbytes=True), "<i8")
                        for c in ("docs", "places"))
        yield docs, np.cumsum(places), np.frombuffer(r["hashes"], "<u8")


def _state(block: int, e: Entries) -> pa.Table:
    def small(x: np.ndarray) -> pa.Array:
        return pa.array([pa.compress(x.astype("<i8").tobytes(), codec="zstd", asbytes=True)], pa.binary())
    return pa.table({"block": pa.array([block], pa.int64()), "n": pa.array([len(e[0])], pa.int64()),
                     "docs": small(e[0]), "places": small(np.diff(e[1], prepend=0)),
                     "hashes": pa.array([e[2].astype("<u8").tobytes()], pa.binary())})


_NO_STATE = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("docs", pa.binary()), ("places", pa.binary()),
                       ("hashes", pa.binary())]).empty_table()


class _Marked:
    """The flagged (document, hash) pairs of a block."""

    def __init__(self, packed: pa.Table, width: int) -> None:
        self.mask = np.uint64((1 << 8 * width) - 1)
        self.pairs = np.unique(self._pair(*packs.unpack(packed, width)))

    def _pair(self, docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        return B.mix((hashes & self.mask) ^ B.mix(docs.astype(np.uint64) + np.uint64(1)))

    def has(self, docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.zeros(len(docs), bool)
        pair = self._pair(docs, hashes)
        return self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair


def _extend(e: Entries, step: int) -> Entries:
    """Windows that go on, ``step`` words later, in a window that is left too."""
    docs, places, hashes = e
    if not len(places):
        return e
    there = np.minimum(np.searchsorted(places, places + step), len(places) - 1)
    ok = places[there] == places + step
    return docs[ok], places[ok], B.join_hash(hashes[ok], hashes[there[ok]])


def _next_level(step: int):
    def grow(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _NO_STATE
        marked, out = _Marked(right, FILTER_BYTES), []
        for docs, places, hashes in _entries(left):
            hit = marked.has(docs, hashes)
            out.append(_state(left.column("block")[0].as_py(), _extend((docs[hit], places[hit], hashes[hit]), step)))
        return pa.concat_tables(out)
    return grow


def repeats(src: DataFrame, pieces: int, window: int = WINDOW, first: int = FIRST) -> DataFrame | None:
    """Packed (document, hash) entries, by block, of the windows of (id, text) that
    also start in a document with a smaller id; None if no candidate survives."""
    steps = levels(window, first)

    def kind(i: int) -> tuple[str, int]:
        return (packs.LATER, EXACT_BYTES) if i == len(steps) - 1 else (packs.REPEATED, FILTER_BYTES)

    mode, width = kind(0)
    flags = scratch(packs.shared(_text_windows(src, steps[0], mode, pieces, width), mode, pieces, width), "substring-flags")
    if len(steps) == 1:
        return flags
    length, step = steps[0], steps[1] - steps[0]

    def from_text(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _NO_STATE
        marked, base, out = _Marked(right, FILTER_BYTES), 0, []
        ids = left.column("id").to_numpy()
        for s in B.slices(left.column("text").combine_chunks()):
            at = s.window_ok(length)
            h = B.window_hash(s.word_hash(), length)[at]
            docs = ids[s.lo + s.row[at]]
            hit = marked.has(docs, h)
            # a place is a word number in the block; rows stand a window apart
            out.append((docs[hit], base + at[hit] + s.row[at[hit]] * window, h[hit]))
            base += len(s.row) + s.n * window
        return _state(left.column("block")[0].as_py(), _extend(tuple(np.concatenate(x) for x in zip(*out)), step))

    blocked = src.withColumn("block", packs.block_column(F.col("id"), pieces))
    state = scratch(blocked.groupBy("block").cogroup(flags.withColumnRenamed("key", "block").groupBy("block"))
                    .applyInArrow(from_text, STATE), "substring-level")
    for i in range(1, len(steps)):
        if not state.filter("n > 0").head(1):
            return None
        mode, width = kind(i)
        flags = scratch(packs.shared(_state_windows(state, mode, pieces, width), mode, pieces, width), "substring-flags")
        if i + 1 == len(steps):
            return flags
        grow = _next_level(steps[i + 1] - steps[i])
        state = scratch(state.groupBy("block").cogroup(flags.withColumnRenamed("key", "block").groupBy("block"))
                        .applyInArrow(grow, STATE), "substring-level")
    return None


def _kept_text(s: B.Slice, keep: np.ndarray) -> pa.Array:
    """Per row the kept words, joined by one space."""
    starts, size, row = s.starts[keep], (s.ends - s.starts)[keep], s.row[keep]
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    room = size + ~last
    begin = np.cumsum(room) - room
    out = np.full(int(room.sum()), 32, np.uint8)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(begin, size) + inner] = s.buf[np.repeat(starts, size) + inner]
    total = np.bincount(row, weights=room, minlength=s.n).astype(np.int64)
    offs = np.concatenate([[0], np.cumsum(total)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(s.n, pa.py_buffer(offs), pa.py_buffer(out)).cast(pa.string())


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                first: int = FIRST, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (or its columns ``keep``) with a struct column: n_words, n_removed and
    ``kept``, the words that are left, joined by one space. Returns the column's name too."""
    keep = list(docs.columns) if keep is None else keep
    name, block, ident = fresh(docs, "dedup"), fresh(docs, "block_in"), fresh(docs, "id_in")
    body = fresh(docs, "text_in")
    src = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    pieces = packs.pieces_for(src.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    flags = repeats(src, pieces, window, first)
    spread = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text)))
    left = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(id_col).cast("long").alias(ident),
                       F.col(text).alias(body), packs.block_column(spread, pieces).alias(block))
    struct = T.StructType.fromDDL("n_words long, n_removed long, kept string")
    schema = T.StructType([*left.schema.fields[: len(keep)], T.StructField(name, struct)])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        marked, parts = _Marked(right, EXACT_BYTES), []
        ids = left.column(ident).to_numpy()
        known = left.column(ident).is_valid().to_numpy()
        ids = np.where(known, ids, 0).astype(np.int64)
        for s in B.slices(left.column(body).combine_chunks()):
            at = s.window_ok(window)
            docs_ = ids[s.lo + s.row[at]]
            hit = at[marked.has(docs_, B.window_hash(s.word_hash(), window)[at]) & known[s.lo + s.row[at]]]
            reach = np.zeros(len(s.row) + 1, np.int64)
            reach[hit] = 1
            reach[1:] -= np.concatenate([np.zeros(window - 1, np.int64), reach[:-1] > 0])[: len(s.row)]
            gone = np.cumsum(reach[:-1]) > 0 if len(s.row) else np.zeros(0, bool)
            removed = np.bincount(s.row[gone], minlength=s.n)
            parts.append(pa.StructArray.from_arrays(
                [pa.array(s.counts().astype(np.int64)), pa.array(removed.astype(np.int64)), _kept_text(s, ~gone)],
                [f.name for f in struct]))
        found = pa.chunked_array(parts, type=pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))
        return left.select(keep).append_column(name, found)

    no_flags = docs.sparkSession.createDataFrame([], packs.SCHEMA) if flags is None else flags
    right = no_flags.withColumnRenamed("key", block)
    return left.groupBy(block).cogroup(right.groupBy(block)).applyInArrow(cut, schema), name
