"""Which hashes occur in several documents, and which documents hold them.

Tasks gather (document, hash) entries and emit them as packed rows: a key, the
documents, how many hashes each has, and the hashes. A hash goes to its bucket
once for each gathered batch, with its smallest document; the batch's other
documents with it are known to share it, so they are flagged on the spot and
travel under the key of their own document block (a negative number) through
the same shuffle. A hash that a third of all documents hold thus costs its
bucket one entry a batch. Buckets find the hashes that further batches share.

A batch never sends more than ``FAN`` rows for buckets and as many for blocks, however many
of them there are: beyond ``FAN`` it sends to ranges of them (those with the same remainder),
and a range's entries are gathered in lanes, each about as large as a bucket, which pack
them anew for the buckets and blocks. What is known to be shared when a lane has
seen it leaves at once, as it does from a batch.

The result has one row for each (block, sender) with the flagged entries.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from voyra.llm import bytehash as B

SCHEMA = "key long, docs binary, counts binary, hashes binary, extra binary"
BATCH_ENTRIES = 200_000
BUCKET_BYTES = 6 << 20         # text for each bucket and for each block of documents
FAN = 4096                     # rows that a batch sends at most, for buckets and for blocks

REPEATED = "repeated"          # flag every document of a hash that two documents hold
LATER = "later"                # flag those with a larger id than the smallest that holds it

Row = tuple[int, bytes, bytes, bytes, bytes | None]


def pieces_for(total_bytes: int) -> int:
    """Number of buckets, and of blocks; odd, so that ids with a power of two between them spread."""
    return max(32, -(-int(total_bytes) // BUCKET_BYTES)) | 1


def block_of(docs: np.ndarray, blocks: int) -> np.ndarray:
    return (docs ^ (docs >> 17) ^ (docs >> 31)) % blocks


def block_column(doc: Column, blocks: int) -> Column:
    """The same in Spark (shifts keep the sign in both, the remainder is never negative)."""
    folded = doc.bitwiseXOR(F.shiftright(doc, 17)).bitwiseXOR(F.shiftright(doc, 31))
    return F.pmod(folded, F.lit(blocks).cast("long"))


def _bytes(h: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _hashes(blob: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(blob) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _small(x: np.ndarray) -> bytes:
    return len(x).to_bytes(8, "little") + pa.compress(x.astype("<i8").tobytes(), codec="zstd", asbytes=True)


def _large(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], decompressed_size=8 * n, codec="zstd", asbytes=True), "<i8")


def pack(key: np.ndarray, docs: np.ndarray, hashes: np.ndarray, width: int) -> list[Row]:
    order = np.lexsort((docs, key))
    key, docs, hashes = key[order], docs[order], hashes[order]
    change = np.ones(len(key), bool)
    change[1:] = (key[1:] != key[:-1]) | (docs[1:] != docs[:-1])
    begin = np.flatnonzero(change)
    counts = np.diff(np.append(begin, len(key)))
    owners, keys = docs[begin], key[begin]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    upto = np.append(at[1:], len(keys))
    ends = np.append(begin, len(key))
    return [(int(keys[i]), _small(np.diff(owners[i:j], prepend=0)), _small(counts[i:j]), _bytes(hashes[ends[i]: ends[j]], width), None)
            for i, j in zip(at, upto)]


def unpack(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) entries of packed rows."""
    docs, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for d, c, h in zip(*(table.column(x).to_pylist() for x in ("docs", "counts", "hashes"))):
        if h:
            docs.append(np.repeat(np.cumsum(_large(d)), _large(c)))
            hashes.append(_hashes(h, width))
    return np.concatenate(docs), np.concatenate(hashes)


def _runs(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries by hash, then document, without repetitions; first of each hash; its number."""
    order = np.lexsort((docs, hashes))
    docs, hashes = docs[order], hashes[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    docs, hashes = docs[new], hashes[new]
    first = np.ones(len(docs), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    return docs, hashes, first, np.cumsum(first) - 1


def _flags(docs: np.ndarray, first: np.ndarray, group: np.ndarray, mode: str) -> np.ndarray:
    if mode == LATER:
        return ~first
    return (np.bincount(group) > 1)[group] if len(group) else first


def _bucket(hashes: np.ndarray, pieces: int, width: int) -> np.ndarray:
    bits = hashes >> np.uint64(8 * width) if width < 8 else B.mix(hashes)
    return (bits % np.uint64(pieces)).astype(np.int64)


def batch_rows(docs: np.ndarray, hashes: np.ndarray, mode: str, pieces: int, width: int, fan: int | None) -> list[Row]:
    """Packed rows of one gathered batch: one entry a hash for the buckets, known ones for the blocks;
    for ranges of them where there are more than ``fan`` (None: never; it is the last sender)."""
    docs, hashes, first, group = _runs(docs, hashes)
    if fan is not None and pieces > fan:
        known = _flags(docs, first, group, mode)
        key = np.concatenate([_bucket(hashes[first], pieces, width) % fan, -1 - block_of(docs[known], pieces) % fan])
        return pack(key, np.concatenate([docs[first], docs[known]]), np.concatenate([hashes[first], hashes[known]]), 8)
    low = hashes & np.uint64((1 << 8 * width) - 1) if width < 8 else hashes
    known = _flags(docs, first, group, mode)
    key = np.concatenate([_bucket(hashes[first], pieces, width), -1 - block_of(docs[known], pieces)])
    return pack(key, np.concatenate([docs[first], docs[known]]), np.concatenate([low[first], low[known]]), width)


def record_batch(rows: Iterable[Row]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 5
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      ["key", "docs", "counts", "hashes", "extra"])


def shared(packed: DataFrame, mode: str, pieces: int, width: int) -> DataFrame:
    """Packed rows by block: ``key`` is the block, entries are the flagged ones;
    rows with ``extra`` pass through."""

    def reduce(table: pa.Table) -> pa.Table:
        key = table.column("key")[0].as_py()
        if key < 0:
            return table.set_column(0, "key", pa.array([-1 - key] * len(table), pa.int64()))
        docs, hashes = unpack(table, width)
        docs, hashes, first, group = _runs(docs, hashes)
        hit = _flags(docs, first, group, mode)
        docs, hashes = docs[hit], hashes[hit]
        return pa.Table.from_batches([record_batch(pack(block_of(docs, pieces), docs, hashes, width))])

    def deal(table: pa.Table) -> pa.Table:
        """A lane of a range, packed for its buckets, or for its blocks."""
        docs, hashes = unpack(table, 8)
        if table.column("key")[0].as_py() >= 0:
            rows = batch_rows(docs, hashes, mode, pieces, width, None)
        else:
            low = hashes & np.uint64((1 << 8 * width) - 1) if width < 8 else hashes
            rows = pack(-1 - block_of(docs, pieces), docs, low, width)
        return pa.Table.from_batches([record_batch(rows)])

    if pieces > FAN:
        # rows with ``extra`` have their own block's key already
        lane = F.pmod(F.xxhash64("docs", "counts"), F.lit(-(-pieces // FAN)))
        ranged = packed.filter("extra IS NULL").withColumn("lane", lane).groupBy("key", "lane")
        packed = ranged.applyInArrow(lambda t: deal(t.drop_columns(["lane"])), SCHEMA).unionByName(packed.filter("extra IS NOT NULL"))
    return packed.groupBy("key").applyInArrow(reduce, SCHEMA)
