"""BPE encoding and decoding through a table of distinct words.

Encoding: documents are read in chunks of about ``CHUNK_BYTES``. A chunk's words
(runs between ASCII white space, which no token of the vocabulary crosses) are
numbered by frequency; the chunk is kept as the numbers in order, and its
distinct words go to buckets by hash. A bucket sees every word of its hash
range from all chunks, encodes each distinct word once, and sends the ids back
to the chunks that have it; there they are joined back by position. A word
leaves a chunk once however often it occurs, so no word is a hot key, and text
itself is never shuffled.

Chunks are made twice, once for the words and once for the order, so that nothing
is kept on disk but the shuffles. A chunk's key is a digest of its words in
order: an input that gives other rows on a second read (it should be a table
scan) fails with an error, never with wrong ids.

Decoding: an id-to-piece join against the vocabulary (a table bounded by the
tokenizer, not by the data), pieces put together with a space, as the library
does for a file without a decoder.

Words are told apart by a 64-bit hash inside a chunk only (some 300,000
distinct words, a collision chance of about 2e-9 a chunk).

Defined results: a null or empty text has no ids and decodes to the empty text;
repeated rows are encoded each; null ids are kept; an empty table gives an empty
result; null ids and ids outside the vocabulary decode to nothing; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voyra.llm import bytehash as B
from voyra.llm.common import fresh

WORD_BPE = "word_bpe_49k.json"
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20        # text for each bucket of the distinct-word table


def vocabulary_path(name: str = WORD_BPE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, once in each Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def encode_words(words: list[str], path: str) -> list[list[int]]:
    tok = tokenizer(path)
    out: list[list[int]] = []
    for i in range(0, len(words), 8192):
        out += [e.ids for e in tok.encode_batch_fast(words[i: i + 8192], add_special_tokens=False)]
    return out


@lru_cache(maxsize=2)
def pieces(path: str) -> pa.Array:
    """Piece of every id, by id: the id-to-piece table."""
    tok = tokenizer(path)
    size = max(tok.get_vocab(with_added_tokens=True).values()) + 1
    return pa.array([tok.id_to_token(i) for i in range(size)], pa.string())


def _pack(values: np.ndarray) -> bytes:
    """Small unsigned numbers near their entropy: the bit length of each as compressed
    bytes, then the bits below the leading one, length by length."""
    v = values.astype(np.uint64) + np.uint64(1)
    length = (np.frexp(v.astype(np.float64))[1] - 1).astype(np.uint8)
    head = pa.compress(length.tobytes(), codec="zstd", asbytes=True)
    parts = [len(head).to_bytes(8, "little"), head]
    for c in range(1, int(length.max(initial=0)) + 1):
        low = v[length == c] - (np.uint64(1) << np.uint64(c))
        bits = np.empty((len(low), c), bool)
        for k in range(c):
            bits[:, k] = (low >> np.uint64(k)) & np.uint64(1)
        parts.append(np.packbits(bits).tobytes())
    return b"".join(parts)


def _unpack(blob: bytes, n: int) -> np.ndarray:
    at = 8 + int.from_bytes(blob[:8], "little")
    length = np.frombuffer(pa.decompress(blob[8:at], decompressed_size=n, codec="zstd", asbytes=True), np.uint8)
    out = np.zeros(n, np.int64)
    for c in range(1, int(length.max(initial=0)) + 1):
        mine = np.flatnonzero(length == c)
        size = -(-len(mine) * c // 8)
        bits = np.unpackbits(np.frombuffer(blob, np.uint8, size, at), count=len(mine) * c).reshape(-1, c)
        value = np.full(len(mine), (1 << c) - 1, np.int64)
        for k in range(c):
            value += bits[:, k].astype(np.int64) << k
        out[mine] = value
        at += size
    return out


class _Chunk:
    """Rows gathered by one task until there are enough bytes."""

    def __init__(self) -> None:
        self.ids, self.counts, self.hashes, self.words, self.known = [], [], [], [], np.zeros(0, np.uint64)
        self.size = 0

    def add(self, ids: pa.Array, text: pa.Array, lower: bool = False) -> None:
        self.ids.append(ids)
        self.size += text.nbytes
        for s in B.slices(text, lower=lower):
            self.counts.append(s.counts())
            h = s.word_hash()
            self.hashes.append(h)
            new, at = np.unique(h, return_index=True)
            fresh_ = ~np.isin(new, self.known, assume_unique=True)
            at = at[fresh_]
            self.words.append((new[fresh_], B.take_spans(s.buf, s.starts[at], s.ends[at])))
            self.known = np.sort(np.concatenate([self.known, new[fresh_]]), kind="stable")     # two sorted runs: a merge

    def rows(self, part: int, want: str, buckets: int, id_type: pa.DataType) -> pa.RecordBatch:
        hashes = np.concatenate(self.hashes or [np.zeros(0, np.uint64)])
        at = np.searchsorted(self.known, hashes)
        often = np.bincount(at, minlength=len(self.known))
        by_rank = np.argsort(-often, kind="stable")
        rank = np.empty(len(by_rank), np.int64)
        rank[by_rank] = np.arange(len(by_rank))
        home = (self.known[by_rank] % np.uint64(buckets)).astype(np.int64)
        found = np.concatenate([w[0] for w in self.words] or [np.zeros(0, np.uint64)])
        words = pa.concat_arrays([w[1] for w in self.words] or [pa.array([], pa.string())])
        words = words.take(pa.array(np.argsort(found)[by_rank]))     # by rank
        order = np.argsort(home, kind="stable")
        ends = np.searchsorted(home[order], np.arange(buckets), side="right")
        starts = np.concatenate([[0], ends[:-1]])
        full = np.flatnonzero(ends > starts)
        counts = np.concatenate(self.counts or [np.zeros(0, np.int64)])
        key = part ^ int.from_bytes(hashlib.blake2b(hashes.tobytes() + counts.tobytes(), digest_size=3).digest(), "little")
        if want == "words":
            words = words.take(pa.array(order))
            text = [" ".join(words[lo:hi].to_pylist()).encode() for lo, hi in zip(starts[full], ends[full])]
            return pa.RecordBatch.from_arrays([
                pa.array([key] * len(full), pa.int64()), pa.array(full, pa.int64()), pa.array([len(t) for t in text], pa.int64()),
                pa.array([pa.compress(t, codec="zstd", asbytes=True) for t in text], pa.binary())],
                ["chunk", "bucket", "words_bytes", "words"])
        ids = pa.concat_arrays(self.ids)
        return pa.RecordBatch.from_arrays([
            pa.array([key], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([_pack(counts)], pa.binary()), pa.array([len(rank)], pa.int64()), pa.array([_pack(home)], pa.binary()),
            pa.array([len(hashes)], pa.int64()), pa.array([_pack(rank[at])], pa.binary())],
            ["chunk", "ids", "doc_words", "n_distinct", "home", "n_words", "sequence"])


def chunks(docs: DataFrame, id_col: str, text: str, buckets: int, want: str) -> DataFrame:
    """``words``: one row for each chunk and bucket, with its distinct words;
    ``sequence``: one row for each chunk, with its ids, words for each document,
    bucket of each word number, and the numbers in order."""
    id_field = docs.schema[id_col].dataType
    schema = T.StructType.fromDDL(
        "chunk long, bucket long, words_bytes long, words binary" if want == "words" else
        "chunk long, ids array<long>, doc_words binary, n_distinct long, home binary, n_words long, sequence binary")
    schema = T.StructType([T.StructField(f.name, T.ArrayType(id_field)) if f.name == "ids" else f for f in schema])
    arrow_id = to_arrow_schema(T.StructType([T.StructField("i", id_field)])).types[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, chunk = TaskContext.get().partitionId() << 42, _Chunk()
        for b in batches:
            chunk.add(b.column(0), b.column(1))
            if chunk.size >= CHUNK_BYTES:
                yield chunk.rows(part, want, buckets, arrow_id)
                part, chunk = part + (1 << 24), _Chunk()
        if chunk.ids:
            yield chunk.rows(part, want, buckets, arrow_id)

    return docs.select(F.col(id_col), F.col(text)).mapInArrow(run, schema)


def encode(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids) for every row of ``docs``: the ids of its whole text, in order."""
    path = path or vocabulary_path()
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(32, -(-total // BUCKET_BYTES))
    words = chunks(docs, id_col, text, buckets, "words")
    sequences = chunks(docs, id_col, text, buckets, "sequence")

    def encode_bucket(table: pa.Table) -> pa.Table:
        texts = [pa.decompress(w, decompressed_size=n, codec="zstd", asbytes=True).decode().split(" ")
                 for w, n in zip(table.column("words").to_pylist(), table.column("words_bytes").to_pylist())]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        flat = pa.array([w for t in texts for w in t], pa.string()).dictionary_encode()
        del texts
        coded = encode_words(flat.dictionary.to_pylist(), path)       # each distinct word once
        size = np.array([len(c) for c in coded], np.int64)
        ids = np.fromiter((i for c in coded for i in c), np.int64, int(size.sum()))
        begin = np.concatenate([[0], np.cumsum(size)])
        at = flat.indices.to_numpy()
        sizes_out, ids_out = [], []
        for lo, hi in zip(bounds, bounds[1:]):
            w = at[lo:hi]
            sizes_out.append(_pack(size[w]))
            ids_out.append(_pack(_gather(ids, begin[w], size[w])))
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "n": pa.array(np.diff(bounds), pa.int64()),
                         "sizes": pa.array(sizes_out, pa.binary()), "ids": pa.array(ids_out, pa.binary())})

    coded = words.groupBy("bucket").applyInArrow(
        encode_bucket, "chunk long, bucket long, n long, sizes binary, ids binary")
    id_type = docs.schema[id_col]
    out = T.StructType([T.StructField("id", id_type.dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(out)

    def join_back(left: pa.Table, right: pa.Table) -> pa.Table:
        sizes, begins, flat, total = {}, {}, [], 0
        for r in right.to_pylist():
            n = _unpack(r["sizes"], r["n"])
            sizes[r["bucket"]] = n
            begins[r["bucket"]] = total + np.concatenate([[0], np.cumsum(n)[:-1]])
            flat.append(_unpack(r["ids"], int(n.sum())))
            total += int(n.sum())
        flat = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        tables = []
        if not len(left):
            raise ValueError("the input gave other rows on its second read; write it to a table first")
        for r in left.to_pylist():                                    # one row a chunk
            home = _unpack(r["home"], r["n_distinct"])
            order = np.argsort(home, kind="stable")
            used = sorted(sizes)
            if [len(sizes[b]) for b in used] != np.unique(home, return_counts=True)[1].tolist():
                raise ValueError("the input gave other rows on its second read; write it to a table first")
            size, begin = np.empty(len(home), np.int64), np.empty(len(home), np.int64)
            if used:
                size[order] = np.concatenate([sizes[b] for b in used])
                begin[order] = np.concatenate([begins[b] for b in used])
            at = _unpack(r["sequence"], r["n_words"])
            per_doc = _unpack(r["doc_words"], len(r["ids"]))
            n = size[at]
            ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(per_doc)]
            ids = _gather(flat, begin[at], n).astype(np.int32)
            tables.append(pa.Table.from_arrays([
                pa.array(r["ids"], arrow.types[0]),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))],
                schema=arrow))
        return pa.concat_tables(tables) if tables else arrow.empty_table()

    df = sequences.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(join_back, out)
    return df.withColumnRenamed("id", id_col)


def _gather(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``values[begin: begin + size]`` of every entry, end to end."""
    total = int(size.sum())
    out_begin = np.cumsum(size) - size
    return values[np.repeat(begin - out_begin, size) + np.arange(total)]


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> tuple[DataFrame, str]:
    """``df`` with the text of the id lists in ``ids`` in a new column, whose name is returned."""
    path = path or vocabulary_path()
    name = fresh(df, out)
    cols = list(df.columns)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])
    at = cols.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path)
        if tokenizer(path).decoder is not None:
            raise ValueError("the file has a decoder; only files without one are put together with spaces")
        for b in batches:
            lists = b.column(at)
            if isinstance(lists, pa.ListArray) and lists.null_count:
                lists = pc.coalesce(lists, pa.scalar([], lists.type))
            flat = lists.flatten()
            ok = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(table))), False)
            found = table.take(pc.if_else(ok, flat, pa.scalar(None, flat.type)))
            # a missing piece takes its separator with it: drop it before the join
            keep = pc.is_valid(found)
            seen = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
            offs = lists.offsets.to_numpy()
            offs = seen[offs - offs[0]]
            joined = pa.LargeListArray.from_arrays(pa.array(offs, pa.int64()), found.filter(keep).cast(pa.large_string()))
            text = pc.binary_join(joined, pa.scalar(" ", pa.large_string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, text], [*cols, name])

    return df.mapInArrow(run, schema), name
