"""Language-model scoring with a causal self-attention model over subword ids, in numpy.

Texts are turned into subword ids once (a worker encodes each distinct word once, as long
as it remembers it) and written as packed ids; everything else reads those. The model gives

    P(id) = P(class of id | ids before it) * P(id | class, group of the id before it)

The first factor is causal self-attention over the embeddings of the last ids, followed by
a small feed-forward layer; its output is one of ``CLASSES`` classes. Classes are groups of ids
with like neighbours, from the counts of all training ids. The second is a smoothed share, from
the counts of all training pairs of (group of the id before, id); the ``FREQUENT`` most
frequent ids are groups of their own, the others are grouped by class. Both tables are
bounded by the vocabulary. Every text ends with an end id, which is also what stands before
its first id.

Windows are two blocks of ``BLOCK`` ids that overlap by one block: each id is scored once, in the
last block of its window, and attends to the block before and to what is before it in its
own; places are told by their distance. An id's keys and values are made once.

The model learns from every training id. A start is fitted by Adam on a bounded set of windows
(about ``SAMPLE_TOKENS`` ids, picked by hash from all training windows; all of them where there are
fewer). From there, where the data is, every partition takes all its training windows, with all
parameters, and the partitions' parameters are averaged in a fixed order: embeddings by how often
a partition has the id, the others by the ids it has.

The base score is an add-0.5 unigram model over words. Distinct words of a chunk
go to buckets by hash with their training counts, and total counts come back to
the chunks, joined by position; no word is a hot key.

Defined results: a null or empty text is its end token alone; a document is held
out where crc32 of its id's decimal text, mod 5, is 1 (a null id: the empty
text); repeated rows are scored, and learned from, each; without training
documents all counts are 0; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import itertools
import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from voyra.llm import bytehash as B
from voyra.llm.bpe import CHUNK_BYTES, _Chunk, _gather, _pack, _unpack, encode_words, tokenizer, vocabulary_path
from voyra.llm.common import scratch
from voyra.llm.packs import pieces_for

CLASSES = 64
SIDES = 64             # hashed groups of neighbours on each side of an id
FREQUENT = 256         # ids that are groups of their own before an id
PRIOR = 8.0            # counts that the share of an id in its class stands for
WIDTH = 16
BLOCK = 8              # a window is two blocks
BATCH = 256            # windows a step
RATE = 0.02
SAMPLE_TOKENS = 3_000_000
PASSES = 6             # over the sample at most, where the corpus has fewer ids
STEP_BLOCKS = 1024     # blocks a step of the pass over all windows
FAN = 16               # partitions whose parameters are added at once
SLICE = 300_000        # ids that are laid out in blocks at once
SCORED = 512           # windows that are scored at once: what they need stays in a core's cache
PART = 256             # windows whose gradients are made at once, likewise
BINS = 1 << 22         # pairs that are counted in a dense table
CACHE_WORDS = 1 << 20  # distinct words that a worker remembers

CHUNK = ("bucket long, chunk long, n long, hashes binary, trained binary, ids array<long>, train_docs long, "
         "doc_words binary, n_distinct long, home binary, n_words long, sequence binary, doc_tokens binary, "
         "n_tokens long, tokens binary")
NAMES = [c.split()[0] for c in CHUNK.split(", ")]


def held_out(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i in ids], bool)


LETTERS = string.ascii_lowercase + "".join(chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha())
MARKS = ",.;:!?"


@lru_cache(maxsize=2)
def _direct(path: str) -> tuple[re.Pattern, dict[int, str]] | None:
    """(words that may go to the merges directly, how the file writes their letters); None if the file
    doesn't leave a run of letters as it is, or doesn't part it from the marks after it."""
    tok = tokenizer(path)
    if tok.post_processor is not None or tok.pre_tokenizer is None:
        return None

    def cut(text: str) -> list[str]:
        if tok.normalizer is not None and tok.normalizer.normalize_str(text) != text:
            return []
        return [w for w, _ in tok.pre_tokenizer.pre_tokenize_str(text)]
    written = {ord(c): "".join(cut(c)) for c in LETTERS}
    whole = LETTERS.translate(written)
    ends = [LETTERS + m for m in (*MARKS, MARKS, MARKS[::-1])]
    if cut(LETTERS) != [whole] or any(cut(w) != [whole, w[len(LETTERS):]] for w in ends):
        return None
    return re.compile(f"([{LETTERS}]+)([{MARKS}]*)"), written


def word_ids(words: list[str], path: str) -> list[list[int]]:
    """Subword ids of every word, as ``encode_words`` gives them. Words of lower-case Latin letters, with
    or without marks at their end, go to the merges directly where the file allows it."""
    direct = _direct(path)
    if direct is None:
        return encode_words(words, path)
    (plain, written), merge = direct, tokenizer(path).model.tokenize
    found = [plain.fullmatch(w) for w in words]
    rest = iter(encode_words([w for w, m in zip(words, found) if m is None], path))
    ends: dict[str, list[int]] = {"": []}
    out = []
    for m in found:
        if m is None:
            out.append(next(rest))
            continue
        core, end = m.groups()
        if end not in ends:
            ends[end] = [t.id for t in merge(end)]
        out.append([t.id for t in merge(core if core.isascii() else core.translate(written))] + ends[end])
    return out


class WordIds:
    """Subword ids of words by the words' 64-bit hash: sorted hashes, where their ids begin, ids."""

    def __init__(self, path: str):
        self.path, self.keys = path, np.zeros(0, np.uint64)
        self.begin, self.size, self.ids = np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.uint32)

    def __call__(self, hashes: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, number of ids of each) of words with different ``hashes``; those not met before are encoded."""
        at = np.searchsorted(self.keys, hashes)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == hashes[known]
        new = np.flatnonzero(~known)
        if len(new):
            coded = word_ids(words.take(pa.array(new)).to_pylist(), self.path)
            size = np.array([len(c) for c in coded], np.uint32)
            flat = np.fromiter(itertools.chain.from_iterable(coded), np.uint32, int(size.sum()))
            del coded
            if len(self.keys) + len(new) > CACHE_WORDS:          # begin again with this chunk's words
                kept = np.sort(at[known])
                ids = _gather(self.ids, self.begin[kept].astype(np.int64), self.size[kept].astype(np.int64))
                self.keys, self.size, self.ids = self.keys[kept], self.size[kept], ids
                self.begin = (np.cumsum(self.size) - self.size).astype(np.uint32)
            keys = np.concatenate([self.keys, hashes[new]])
            begin = np.concatenate([self.begin, (len(self.ids) + np.cumsum(size) - size).astype(np.uint32)])
            order = np.argsort(keys, kind="stable")
            self.keys, self.begin = keys[order], begin[order]
            self.size, self.ids = np.concatenate([self.size, size])[order], np.concatenate([self.ids, flat])
            at = np.searchsorted(self.keys, hashes)
        begin, size = self.begin[at].astype(np.int64), self.size[at].astype(np.int64)
        return _gather(self.ids, begin, size), size


_word_ids: dict[str, WordIds] = {}            # one for each worker


def _chunk_rows(chunk: _Chunk, key: int, buckets: int, path: str, end: int) -> pa.RecordBatch:
    hashes = np.concatenate(chunk.hashes or [np.zeros(0, np.uint64)])
    counts = np.concatenate(chunk.counts or [np.zeros(0, np.int64)])
    ids = pa.concat_arrays(chunk.ids).to_pylist()
    held = held_out(ids)
    at = np.searchsorted(chunk.known, hashes)
    by_rank = np.argsort(-np.bincount(at, minlength=len(chunk.known)), kind="stable")
    rank = np.empty(len(by_rank), np.int64)
    rank[by_rank] = np.arange(len(by_rank))
    seq = rank[at]
    owner = np.repeat(np.arange(len(counts)), counts)
    trained = np.bincount(seq[~held[owner]], minlength=len(rank))
    home = (chunk.known[by_rank] % np.uint64(buckets)).astype(np.int64)
    # subword ids of the chunk, by document, each with its end id
    found = np.concatenate([w[0] for w in chunk.words] or [np.zeros(0, np.uint64)])
    words = pa.concat_arrays([w[1] for w in chunk.words] or [pa.array([], pa.string())])
    flat, size = _word_ids.setdefault(path, WordIds(path))(chunk.known[by_rank], words.take(pa.array(np.argsort(found)[by_rank])))
    flat = flat.astype(np.int64)
    tokens = _gather(flat, (np.cumsum(size) - size)[seq], size[seq])
    per_doc = np.bincount(owner, weights=size[seq], minlength=len(counts)).astype(np.int64)
    tokens = np.insert(tokens, np.cumsum(per_doc), end).astype("<u4")
    order = np.argsort(home, kind="stable")
    ends = np.searchsorted(home[order], np.arange(buckets), side="right")
    starts = np.concatenate([[0], ends[:-1]])
    rows = []
    for b in np.flatnonzero(ends > starts):
        mine = order[starts[b]: ends[b]]
        rows.append((int(b), key, len(mine), chunk.known[by_rank[mine]].astype("<u8").tobytes(), _pack(trained[mine])) + (None,) * 10)
    rows.append((None, key, None, None, None, ids, int((~held).sum()), _pack(counts), len(rank), _pack(home), len(seq), _pack(seq),
                 _pack(per_doc + 1), len(tokens), pa.compress(tokens.astype("<u2" if end < 65536 else "<u4").tobytes(), codec="zstd", asbytes=True)))
    kinds = [pa.binary() if c.endswith("binary") else pa.list_(pa.int64()) if "array" in c else pa.int64() for c in CHUNK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], NAMES)


def prepare_chunks(docs: DataFrame, buckets: int, path: str, end: int) -> DataFrame:
    """Rows of every chunk, written once: words by bucket, and the documents' numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        key, chunk = TaskContext.get().partitionId() << 32, _Chunk()
        for b in batches:
            chunk.add(b.column(0), b.column(1), lower=True)
            if chunk.size >= CHUNK_BYTES:
                yield _chunk_rows(chunk, key, buckets, path, end)
                key, chunk = key + 1, _Chunk()
        if chunk.ids:
            yield _chunk_rows(chunk, key, buckets, path, end)
    return scratch(docs.mapInArrow(run, CHUNK), "attention-chunks")


def _tokens(r: dict, end: int) -> tuple[np.ndarray, np.ndarray]:
    kind = "<u2" if end < 65536 else "<u4"
    raw = pa.decompress(r["tokens"], decompressed_size=r["n_tokens"] * np.dtype(kind).itemsize, codec="zstd", asbytes=True)
    return np.frombuffer(raw, kind), _unpack(r["doc_tokens"], len(r["ids"]))


# the model -----------------------------------------------------------------

@dataclass
class Vocabulary:
    """What counts say about ids: the class of each, the group that it is for the id after it, and
    log10 P(id | class, group) in two parts, ``table`` by [group, column of the id] and ``own`` by id. Ids
    met in training have columns of their own, the others one for each class."""

    class_of: np.ndarray
    group_of: np.ndarray
    column: np.ndarray
    table: np.ndarray
    own: np.ndarray

    def inside(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return self.table[self.group_of[before], self.column[ids]] + self.own[ids]


def shapes(size: int) -> dict[str, tuple[int, ...]]:
    """Parameters of a model of ``size`` ids; the embedding after the last id's is that of a text's beginning."""
    return {"embed": (size + 1, WIDTH), "place": (2 * BLOCK,), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH),
            "o": (WIDTH, WIDTH), "up": (WIDTH, 2 * WIDTH), "down": (2 * WIDTH, WIDTH), "out": (WIDTH, CLASSES), "bias": (CLASSES,)}


def initial(size: int, seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    scale = {n: 0.1 if n == "embed" else s[0] ** -0.5 if len(s) == 2 else 0.0 for n, s in shapes(size).items()}
    return {n: (rng.standard_normal(s) * scale[n]).astype(np.float32) for n, s in shapes(size).items()}


# a query in place i of the second block has key j of the window at this distance
_AWAY = BLOCK + np.arange(BLOCK)[:, None] - np.arange(2 * BLOCK)[None]
_LATER = np.where(_AWAY < 0, -1e9, 0.0).astype(np.float32)
_AWAY = np.maximum(_AWAY, 0)
EMPTY = -1


def blocks(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, blocks that have targets) of texts laid out in blocks, an empty block before
    each; a place without an id is ``EMPTY``. The input of a text's first place is ``BEGIN`` (-2)."""
    each = 1 - (-sizes // BLOCK)
    first = np.cumsum(each) - each
    begin = np.cumsum(sizes) - sizes
    inputs = np.full(int(each.sum()) * BLOCK, EMPTY, np.int64)
    targets = inputs.copy()
    at = np.repeat((first + 1) * BLOCK - begin, sizes) + np.arange(len(tokens))
    targets[at] = tokens
    before = np.concatenate([[0], tokens[:-1]])
    before[begin[sizes > 0]] = BEGIN
    inputs[at] = before
    full = np.ones(int(each.sum()), bool)
    full[first] = False
    return inputs.reshape(-1, BLOCK), targets.reshape(-1, BLOCK), np.flatnonzero(full)


BEGIN = -2


def _exp(x: np.ndarray) -> np.ndarray:
    """exp in place, of rows moved by their largest value if a value is too large for it as it is."""
    if x.max(initial=0) > 60:
        x -= x.max(axis=-1, keepdims=True)
    return np.exp(x, out=x)


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[-1], x.dtype)          # much faster than a reduction of short rows


def _windows(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The rows of each block of ``at`` and of the block before it, as a view where the blocks follow each other."""
    step = flat.strides
    every = np.lib.stride_tricks.as_strided(flat, (len(flat) // BLOCK - 1, 2 * BLOCK, WIDTH), (BLOCK * step[0], *step))
    return every if len(at) == len(every) else every[at - 1]


def forward(p: dict[str, np.ndarray], inputs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Class logits after each input of the blocks ``at`` (each with the block before it as its
    window), and what the gradient needs."""
    row, x = _embedded(p, inputs)
    # places in one list: one product of matrices for all
    flat = x.reshape(-1, WIDTH)
    keys, values = (_windows(flat @ p[n], at) for n in ("k", "v"))
    own = x[at]
    q = ((own.reshape(-1, WIDTH) @ p["q"]) * np.float32(WIDTH ** -0.5)).reshape(own.shape)
    att = q @ keys.transpose(0, 2, 1)
    att += p["place"][_AWAY] + _LATER
    none = np.concatenate([inputs[at - 1], inputs[at]], axis=1) == EMPTY
    some = np.flatnonzero(none.any(axis=1))
    att[some] -= none[some, None] * np.float32(1e9)
    att = _exp(att.reshape(-1, 2 * BLOCK))
    att /= np.maximum(_row_sums(att), np.float32(1e-30))[:, None]
    att = att.reshape(len(at), BLOCK, 2 * BLOCK)
    h = att @ values
    y = (own.reshape(-1, WIDTH) + h.reshape(-1, WIDTH) @ p["o"])
    u = np.maximum(y @ p["up"], 0)
    z = y + u @ p["down"]
    d = (z @ p["out"] + p["bias"]).reshape(len(at), BLOCK, CLASSES)
    return d, (row, x, own, q, keys, values, att, h, y.reshape(own.shape), u.reshape(len(at), BLOCK, 2 * WIDTH), z.reshape(own.shape))


def gradient(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, class_of: np.ndarray,
             at: np.ndarray | None = None) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """(gradients of the mean loss by name, rows of the embedding, their gradients) of a batch of windows: those
    of the blocks ``at`` of ``inputs``, without it pairs of blocks; ``targets`` are those of each window's second."""
    if at is not None and len(at) == len(inputs) - 1:
        return _stretch_gradient(p, inputs, targets, class_of)
    at = np.arange(1, len(inputs), 2) if at is None else at
    d, (row, x, own, q, keys, values, att, h, y, u, z) = forward(p, inputs, at)
    valid = targets >= 0
    cls = class_of[np.maximum(targets, 0)]
    d = np.exp(d - d.max(axis=-1, keepdims=True))
    d /= d.sum(axis=-1, keepdims=True)
    np.put_along_axis(d, cls[..., None], np.take_along_axis(d, cls[..., None], -1) - 1, -1)
    d *= (valid / max(int(valid.sum()), 1)).astype(d.dtype)[..., None]

    def outer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.reshape(-1, a.shape[-1]).T @ b.reshape(-1, b.shape[-1])
    g = {"out": outer(z, d), "bias": d.sum(axis=(0, 1))}
    dz = d @ p["out"].T
    g["down"] = outer(u, dz)
    du = (dz @ p["down"].T) * (u > 0)
    g["up"] = outer(y, du)
    dy = dz + du @ p["up"].T
    g["o"] = outer(h, dy)
    dh = dy @ p["o"].T
    da, dv = dh @ values.transpose(0, 2, 1), att.transpose(0, 2, 1) @ dh
    ds = att * (da - (da * att).sum(axis=-1, keepdims=True))
    g["place"] = np.bincount(_AWAY.ravel(), weights=ds.sum(axis=0).ravel(), minlength=2 * BLOCK).astype(d.dtype)
    dq = ds @ keys * np.float32(WIDTH ** -0.5)
    dk = ds.transpose(0, 2, 1) @ q
    g["q"] = outer(own, dq)
    dk, dv = _by_block(dk, at, len(x)), _by_block(dv, at, len(x))
    g["k"], g["v"] = outer(x, dk), outer(x, dv)
    dx = dk @ p["k"].T + dv @ p["v"].T
    dx[at] += dy + dq @ p["q"].T
    return g, *_by_row(row, dx)


def _by_row(row: np.ndarray, dx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = row.ravel()
    order = np.argsort(key.astype(np.uint16) if key.max(initial=0) < 1 << 16 else key, kind="stable")       # 16 bits are sorted by radix
    sorted_rows = key[order]
    first = np.flatnonzero(np.diff(sorted_rows, prepend=-1))
    return sorted_rows[first], np.add.reduceat(dx.reshape(-1, WIDTH).take(order, axis=0), first, axis=0)


def _turned(flat: np.ndarray) -> np.ndarray:
    """The columns (places) of the window of every block but the first, as a view."""
    row, one = flat.strides
    return np.ndarray((flat.shape[1] // BLOCK - 1, WIDTH, 2 * BLOCK), flat.dtype, flat, 0, (BLOCK * one, row, one))


def _rows(flat: np.ndarray) -> np.ndarray:
    """The rows (places) of the window of every block but the first, as a view."""
    row, one = flat.strides
    return np.ndarray((len(flat) // BLOCK - 1, 2 * BLOCK, WIDTH), flat.dtype, flat, 0, (BLOCK * row, row, one))


def _by_place(way: np.ndarray, sent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two factors whose product, by block, is what its places get from the windows that it is the second and the first
    block of: ``way`` by [window, place of the second block, place of the window], ``sent`` by [window, place of the second block]."""
    n = len(way)
    both, rows = np.empty((n + 1, 2 * BLOCK, BLOCK), way.dtype), np.empty((n + 2, BLOCK, WIDTH), way.dtype)
    both[1:, :BLOCK], both[:-1, BLOCK:], rows[1:-1] = way[:, :, BLOCK:], way[:, :, :BLOCK], sent
    both[0, :BLOCK] = both[-1, BLOCK:] = rows[0] = rows[-1] = 0
    return both.transpose(0, 2, 1), _rows(rows.reshape(-1, WIDTH))


def _embedded(p: dict[str, np.ndarray], inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.where(inputs < 0, len(p["embed"]) - 1, inputs)
    return row, p["embed"].take(row, axis=0)


def _stretch(p: dict[str, np.ndarray], inputs: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """What ``forward`` makes before the classes, for all blocks but the first of a stretch with the embeddings ``x``. Keys are
    made with places along the last axis: products of small matrices are several times slower with a turned one."""
    flat = x.reshape(-1, WIDTH)
    own = flat[BLOCK:]
    q = own @ (p["q"] * np.float32(WIDTH ** -0.5))
    att = q.reshape(-1, BLOCK, WIDTH) @ _turned(p["k"].T @ flat.T)
    att += p["place"][_AWAY] + _LATER
    none = inputs == EMPTY
    lack = none.any(axis=1)
    if lack.any():
        some = np.flatnonzero(lack[:-1] | lack[1:])
        att[some] -= np.concatenate([none[some], none[some + 1]], axis=1)[:, None] * np.float32(1e9)
    att = _exp(att.reshape(-1, 2 * BLOCK))
    att /= np.maximum(_row_sums(att), np.float32(1e-30))[:, None]
    att = att.reshape(-1, BLOCK, 2 * BLOCK)
    h = (att @ _rows(flat @ p["v"])).reshape(-1, WIDTH)
    y = h @ p["o"]
    y += own
    u = y @ p["up"]
    np.maximum(u, 0, out=u)
    z = u @ p["down"]
    z += y
    return q, att, h, y, u, z


def _stretch_gradient(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray,
                      class_of: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """``gradient`` of the windows of all blocks of a stretch but the first: with fewer passes over what is as wide as the
    classes, and ``PART`` windows at a time, so that what is between stays in a core's cache."""
    row, x = _embedded(p, inputs)
    goal = targets.ravel()
    valid = goal >= 0
    cls = class_of[np.maximum(goal, 0)]
    weight = (valid / max(int(valid.sum()), 1)).astype(x.dtype)
    scale = np.float32(WIDTH ** -0.5)
    three = np.concatenate([p["q"] * scale, p["k"], p["v"]], axis=1)
    moved, direct = np.empty((*x.shape[:2], 3 * WIDTH), x.dtype), np.empty(x.shape, x.dtype)
    moved[0] = direct[0] = 0                                       # moved: the gradients of queries, keys and values
    g = {n: np.zeros_like(p[n]) for n in ("out", "bias", "down", "up", "o", "place")}
    for i in range(0, len(targets), PART):
        j = min(i + PART, len(targets))
        part, xs = slice(i * BLOCK, j * BLOCK), x[i: j + 1]
        flat = xs.reshape(-1, WIDTH)
        q, att, h, y, u, z = _stretch(p, inputs[i: j + 1], xs)
        # d is the gradient by class, times the sum of the exponentials, over the weight: ``share`` goes to narrower factors
        d = z @ p["out"]
        d += p["bias"]
        if d.max() > 60 or d.min() < -60:
            d -= d.max(axis=-1, keepdims=True)
        np.exp(d, out=d)
        total = _row_sums(d)
        d.ravel()[cls[part] + np.arange(0, d.size, CLASSES)] -= total
        share = weight[part] / total
        g["bias"] += share @ d
        z *= share[:, None]
        g["out"] += z.T @ d
        dz = d @ p["out"].T
        dz *= share[:, None]
        g["down"] += u.T @ dz
        du = dz @ p["down"].T
        du *= u > 0
        g["up"] += y.T @ du
        dz += du @ p["up"].T
        g["o"] += h.T @ dz
        direct[i + 1: j + 1] = dz.reshape(-1, BLOCK, WIDTH)
        dh = (dz @ p["o"].T).reshape(-1, BLOCK, WIDTH)
        ds = dh @ _turned(p["v"].T @ flat.T)
        ds -= _row_sums((dh.reshape(h.shape) * h)).reshape(-1, BLOCK, 1)
        ds *= att
        g["place"] += np.bincount(_AWAY.ravel(), weights=ds.sum(axis=0).ravel(), minlength=2 * BLOCK).astype(x.dtype)
        np.matmul(ds, _rows(flat @ p["k"]), out=moved[i + 1: j + 1, :, :WIDTH])
        for k, way, sent in ((WIDTH, ds, q.reshape(-1, BLOCK, WIDTH)), (2 * WIDTH, att, dh)):
            into, before = moved[i: j + 1, :, k: k + WIDTH], moved[i, :, k: k + WIDTH].copy()
            np.matmul(*_by_place(way, sent), out=into)
            into[0] += before
    moved = moved.reshape(-1, 3 * WIDTH)
    g["q"], g["k"], g["v"] = np.split(x.reshape(-1, WIDTH).T @ moved, 3, axis=1)
    g["q"] = g["q"] * scale
    dx = moved @ three.T
    dx += direct.reshape(dx.shape)
    return g, *_by_row(row, dx)


def _by_block(windows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sums over the windows of the blocks ``at``, each two blocks one after the other, by block (of ``n``)."""
    out = np.zeros((n, BLOCK, WIDTH), windows.dtype)
    out[at - 1] += windows[:, :BLOCK]
    out[at] += windows[:, BLOCK:]
    return out


def adam(p: dict[str, np.ndarray], batches: Iterator[tuple[np.ndarray, np.ndarray]], steps: int, class_of: np.ndarray, rate: float,
         embeddings: bool = True) -> tuple[dict[str, np.ndarray], int]:
    """Parameters after ``steps`` batches, with a rate that rises, then falls; and the ids seen."""
    names, seen = [n for n in p if n != "embed"], 0
    flat = np.concatenate([p[n].ravel() for n in names])            # all but the embeddings, which ``p`` has as views
    cuts = np.cumsum([0, *(p[n].size for n in names)])
    p = {"embed": p["embed"].copy() if embeddings else p["embed"], **{n: flat[i:j].reshape(p[n].shape) for n, i, j in zip(names, cuts, cuts[1:])}}
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    mean_hot, square_hot = (np.zeros_like(p["embed"]) if embeddings else None for _ in range(2))
    for t, (inputs, targets, *at) in enumerate(batches, 1):
        now = np.float32(rate * min(1.0, t / 100) * (1 - t / (steps + 1)))
        g, rows, hot = gradient(p, inputs, targets, class_of, *at)
        seen += int((targets >= 0).sum())
        late, late2 = 1 - 0.9 ** t, 1 - 0.99 ** t
        x = np.concatenate([g[n].ravel() for n in names])
        mean, square = 0.9 * mean + 0.1 * x, 0.99 * square + 0.01 * x * x
        flat -= now * (mean / np.float32(late)) / (np.sqrt(square / np.float32(late2)) + np.float32(1e-8))
        if embeddings:                       # only the rows of this batch move
            m = 0.9 * mean_hot.take(rows, axis=0) + 0.1 * hot
            s = 0.99 * square_hot.take(rows, axis=0) + 0.01 * hot * hot
            mean_hot[rows], square_hot[rows] = m, s
            p["embed"][rows] -= now * m / (np.sqrt(s) + np.float32(1e-8))
    return p, seen


def _picked(r: dict, end: int, salt: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(inputs, targets) of a share of a chunk's training windows, picked by their place: two rows of
    inputs for each row of targets, as ``blocks`` lays them out."""
    tokens, sizes = _tokens(r, end)
    n = -(-sizes // BLOCK)
    begin = np.cumsum(sizes) - sizes
    place = B.mix(np.arange(int(n.sum()), dtype=np.uint64) ^ B.mix(np.array([(r["chunk"] << 8) + salt], np.uint64)))
    picked = np.flatnonzero(place < np.uint64(min(share, 1.0) * (2.0 ** 64 - 2 ** 12)))
    doc = np.searchsorted(np.cumsum(n), picked, side="right")
    train = ~held_out(r["ids"])[doc]
    picked, doc = picked[train], doc[train]
    first = (picked - (np.cumsum(n) - n)[doc]) * BLOCK              # place in its text of a window's first target
    at = first[:, None] + np.arange(-BLOCK, BLOCK)
    inside = (at >= 0) & (at < sizes[doc][:, None])
    spot = np.where(inside, begin[doc][:, None] + at, 0)
    ids = tokens[spot].astype(np.int32)
    before = tokens[np.maximum(spot - 1, 0)].astype(np.int32)
    inputs = np.where(inside, np.where(at == 0, BEGIN, before), EMPTY)
    return inputs.reshape(-1, BLOCK), np.where(inside, ids, EMPTY)[:, BLOCK:]


def _batched(windows: list[tuple[np.ndarray, np.ndarray]], seed: int, passes: int = 1) -> tuple[int, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """(steps, batches) of windows in a random order, ``passes`` times."""
    inputs = np.concatenate([w[0] for w in windows]).reshape(-1, 2, BLOCK)
    targets = np.concatenate([w[1] for w in windows])
    rng = np.random.default_rng(seed)
    order = np.concatenate([rng.permutation(len(targets)) for _ in range(passes)])
    steps = -(-len(order) // BATCH)
    return steps, ((inputs[o].reshape(-1, BLOCK), targets[o]) for o in (order[i: i + BATCH] for i in range(0, len(order), BATCH)))


def _all_windows(r: dict, end: int, seed: int) -> tuple[int, np.ndarray, Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(steps, how often each input occurs, batches) of all training windows of a chunk: stretches of ``STEP_BLOCKS``
    blocks, those of a slice in a random order. The last count is that of the texts' beginnings."""
    tokens, sizes = _tokens(r, end)
    mine = ~held_out(r["ids"])
    tokens, sizes = tokens[np.repeat(mine, sizes)], sizes[mine]
    visits = np.append(np.bincount(tokens, minlength=end + 1), len(sizes))
    begin, part = np.cumsum(sizes) - sizes, np.cumsum(sizes) // SLICE
    first = np.flatnonzero(np.diff(part, prepend=-1))
    cuts = list(zip(first, np.append(first[1:], len(sizes))))
    starts = [np.arange(1, int((1 - (-sizes[lo:hi] // BLOCK)).sum()), STEP_BLOCKS) for lo, hi in cuts]

    def batches() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        rng = np.random.default_rng(seed)
        for (lo, hi), begins in zip(cuts, starts):
            inputs, targets, _ = blocks(tokens[begin[lo]: begin[hi - 1] + sizes[hi - 1]].astype(np.int64), sizes[lo:hi])
            for i in rng.permutation(begins):
                j = min(i + STEP_BLOCKS, len(inputs))
                yield inputs[i - 1: j], targets[i:j], np.arange(1, j - i + 1)
    return sum(len(s) for s in starts), visits, batches()


_PACKED = ("ids", "doc_tokens", "n_tokens", "tokens", "chunk")


def train(chunks: DataFrame, vocabulary: Vocabulary, end: int, tokens: int) -> dict[str, np.ndarray]:
    """Parameters fitted to all training windows (``tokens`` ids), from a start that a bounded set of them gives."""
    size, class_of = len(vocabulary.class_of), vocabulary.class_of

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                inputs, targets = _picked(r, end, 1, SAMPLE_TOKENS / max(tokens, 1))
                yield pa.RecordBatch.from_arrays([pa.array([r["chunk"]], pa.int64()), pa.array([inputs.astype("<i4").tobytes()], pa.binary()),
                                                  pa.array([targets.astype("<i4").tobytes()], pa.binary())], ["chunk", "inputs", "targets"])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        windows = [tuple(np.frombuffer(x, "<i4").reshape(-1, BLOCK) for x in pair)
                   for pair in zip(table.column("inputs").to_pylist(), table.column("targets").to_pylist())]
        ids = sum(int((w[1] >= 0).sum()) for w in windows)
        steps, batches = _batched(windows, 0, min(PASSES, max(1, SAMPLE_TOKENS // max(ids, 1))))      # a small corpus is read more than once
        p, _ = adam(initial(size), batches, steps, class_of, RATE)
        return pa.table({n: pa.array([x.tobytes()], pa.binary()) for n, x in p.items()})

    schema = ", ".join(f"{n} binary" for n in shapes(size))
    # about SAMPLE_TOKENS ids, whatever the input's size
    sample = chunks.select(*_PACKED).mapInArrow(pick, "chunk long, inputs binary, targets binary")
    fitted = scratch(sample.groupBy(F.lit("all")).applyInArrow(fit, schema), "attention-sample").first()
    if fitted is None:
        return initial(size)
    p = {n: np.frombuffer(fitted[n], np.float32).reshape(s) for n, s in shapes(size).items()}

    rest = [n for n in p if n != "embed"]

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        q, seen, visits = p, 0, np.zeros(size + 1)
        for b in batches:
            for r in b.to_pylist():
                steps, inputs, made = _all_windows(r, end, r["chunk"] & 0xFFFFFFFF)
                q, ids = adam(q, made, steps, class_of, RATE / 10)
                seen, visits = seen + ids, visits + inputs
        if seen:
            flat = np.concatenate([q[n].ravel() for n in rest]).astype(float) * seen
            moved = ((q["embed"] - p["embed"]) * visits[:, None]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([seen], pa.int64()),
                                              *[pa.array([x.tobytes()], pa.binary()) for x in (flat, moved, visits)]], names)

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")               # one order of addition: a rerun gives the same numbers
        sums = []
        for name, kind in zip(names[2:], (np.float64, np.float32, np.float64)):
            total = 0.0
            for blob in table.column(name):
                total = total + np.frombuffer(blob.as_buffer(), kind)
            sums.append(pa.array([total.astype(kind).tobytes()], pa.binary()))
        return pa.table({n: c for n, c in zip(names, [pa.array([table.column("part")[0].as_py() // FAN], pa.int32()),
                                                      pa.array([sum(table.column("seen").to_pylist())], pa.int64()), *sums])})

    names, kind = ["part", "seen", "params", "moved", "visits"], "part int, seen long, params binary, moved binary, visits binary"
    packed = chunks.select(*_PACKED)
    sums, tasks = packed.mapInArrow(refine, kind), packed.rdd.getNumPartitions()         # of the plan; nothing runs as an RDD
    while True:
        sums = sums.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(add, kind)
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            break
    got = scratch(sums, "attention-refined").first()
    if got is None:
        return p
    visits, at = np.frombuffer(got["visits"]), 0
    moved = np.frombuffer(got["moved"], np.float32).reshape(p["embed"].shape) / np.maximum(visits, 1)[:, None]
    flat, out = np.frombuffer(got["params"]) / got["seen"], {"embed": (p["embed"] + moved).astype(np.float32)}
    for n, s in list(shapes(size).items())[1:]:
        out[n] = flat[at: at + int(np.prod(s))].reshape(s).astype(np.float32)
        at += int(np.prod(s))
    return out


# tables of the corpus ---------------------------------------------------------

def _counted(chunks: DataFrame, count) -> pa.Table:
    """Sums of what ``count`` gives for each chunk: sparse (row, column, n) entries, as many
    as the vocabulary has at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                i, j, n = count(r)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(n, pa.int64())], ["i", "j", "n"])
    counted = chunks.select(*_PACKED).mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    return counted.toArrow()


def _training_pairs(r: dict, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(id before, id) of every training id; the end id stands before a text."""
    tokens, sizes = _tokens(r, end)
    tokens = tokens.astype(np.int64)
    before = np.concatenate([[end], tokens[:-1]])         # a text's first id follows the end of the one before
    mine = np.repeat(~held_out(r["ids"]), sizes)
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = end
    return before[mine], tokens[mine]


def _entries(row: np.ndarray, column: np.ndarray, rows: int, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, n) of the pairs that occur."""
    key = row * columns + column
    if rows * columns <= BINS:
        n = np.bincount(key, minlength=rows * columns)
        key = np.flatnonzero(n)
        n = n[key]
    else:
        key, n = np.unique(key, return_counts=True)
    return key // columns, key % columns, n


def vocabulary(chunks: DataFrame, end: int, size: int) -> tuple[Vocabulary, int]:
    """Classes, groups and shares of all ids, and the number of training ids.

    An id is described by how often each of ``SIDES`` hashed groups of ids follows
    and precedes it; ids with like neighbours share a class (k-means, weighted by count).
    """
    width = 2 * SIDES + 1

    def neighbours(r: dict):
        before, own = _training_pairs(r, end)
        one = np.zeros_like(own)
        parts = [_entries(own, one, size, 1), _entries(own, before % SIDES, size, SIDES), _entries(before, own % SIDES, size, SIDES)]
        at = [j + first for (_, j, _), first in zip(parts, (0, 1, 1 + SIDES))]
        return np.concatenate([x[0] for x in parts]), np.concatenate(at), np.concatenate([x[2] for x in parts])

    t = _counted(chunks, neighbours)
    table = np.zeros((size, width))
    table[t["i"].to_numpy(), t["j"].to_numpy()] = t["n"].to_numpy()
    total, count = int(table[:, 0].sum()), table[:, 0] + 0.5
    class_of = _cluster(table[:, 1:], count)
    mass = np.bincount(class_of, weights=count, minlength=CLASSES)
    group_of = FREQUENT + class_of
    group_of[np.argsort(-count, kind="stable")[:FREQUENT]] = np.arange(FREQUENT)

    met = np.flatnonzero(table[:, 0])
    column = len(met) + class_of
    column[met] = np.arange(len(met))

    def pairs(r: dict):
        before, own = _training_pairs(r, end)
        return _entries(group_of[before], column[own], FREQUENT + CLASSES, len(met))

    t = _counted(chunks, pairs)
    group, at, n = (t[c].to_numpy() for c in ("i", "j", "n"))
    of_class = np.zeros((FREQUENT + CLASSES, CLASSES))
    np.add.at(of_class, (group, class_of[met[at]]), n)
    share = count / mass[class_of]
    inside = np.empty((FREQUENT + CLASSES, len(met) + CLASSES), np.float32)
    inside[:, : len(met)] = PRIOR * share[met]
    inside[:, len(met):] = PRIOR
    inside[group, at] += n
    inside /= of_class[:, np.append(class_of[met], np.arange(CLASSES))] + PRIOR
    only = np.log10(share)
    only[met] = 0.0
    return Vocabulary(class_of, group_of, column, np.log10(inside, out=inside), only), total


def _cluster(neighbours: np.ndarray, count: np.ndarray) -> np.ndarray:
    mean = neighbours.sum(axis=0) / max(neighbours.sum(), 1.0) + 1e-9
    # ids without neighbours are all alike: the first stands for them
    seen = neighbours.any(axis=1)
    lone = int(np.argmin(seen)) if not seen.all() else 0
    rows = np.flatnonzero(seen | (np.arange(len(seen)) == lone))
    shape = neighbours[rows] + 20 * mean
    shape = np.sqrt(shape / shape.sum(axis=1, keepdims=True))
    weight = count[rows]
    centre = [shape[int(np.argmax(weight))]]                      # far apart, frequent ids first
    gap = ((shape - centre[0]) ** 2).sum(axis=1)
    while len(centre) < CLASSES:
        centre.append(shape[int(np.argmax(gap * weight))])
        gap = np.minimum(gap, ((shape - centre[-1]) ** 2).sum(axis=1))
    centre = np.array(centre)
    for _ in range(20):
        near = ((shape ** 2).sum(axis=1)[:, None] - 2 * shape @ centre.T + (centre ** 2).sum(axis=1)).argmin(axis=1)
        for c in range(CLASSES):
            if (near == c).any():
                centre[c] = np.average(shape[near == c], axis=0, weights=weight[near == c])
    out = np.full(len(seen), near[np.searchsorted(rows, lone)])
    out[rows] = near
    return out


def score_documents(tokens: np.ndarray, sizes: np.ndarray, p: dict[str, np.ndarray], vocabulary: Vocabulary, end: int) -> np.ndarray:
    """log10 probability of every document; each id is scored in one window. What is as long as the ids is made by slice."""
    begin, out = np.cumsum(sizes) - sizes, np.zeros(len(sizes))
    part = np.cumsum(sizes) // SLICE
    for lo, hi in zip(*(lambda a: (a, np.append(a[1:], len(sizes))))(np.flatnonzero(np.diff(part, prepend=-1)))):
        size, mine = sizes[lo:hi], tokens[begin[lo]: begin[hi - 1] + sizes[hi - 1]].astype(np.int64)
        before = np.concatenate([[end], mine[:-1]])
        before[(np.cumsum(size) - size)[size > 0]] = end
        out[lo:hi] = np.bincount(np.repeat(np.arange(hi - lo), size), weights=vocabulary.inside(before, mine), minlength=hi - lo)
        inputs, targets, _ = blocks(mine, size)
        doc = np.repeat(np.arange(hi - lo), 1 - (-size // BLOCK))
        found, spot = np.zeros(targets.shape), vocabulary.class_of[np.maximum(targets, 0)]
        for i in range(1, len(inputs), SCORED):                # empty blocks between texts are carried along, and not counted
            j = min(i + SCORED, len(inputs))
            z = _stretch(p, inputs[i - 1: j], _embedded(p, inputs[i - 1: j])[1])[-1] @ p["out"]
            z += p["bias"]
            if z.max(initial=0) > 60:
                z -= z.max(axis=-1, keepdims=True)
            own = z.take(spot[i:j].ravel() + np.arange(0, z.size, CLASSES)).astype(float)
            found[i:j] = (own - np.log(_row_sums(_exp(z)))).reshape(-1, BLOCK)
        found[targets < 0] = 0
        out[lo:hi] += np.bincount(doc, weights=found.sum(axis=1) / np.log(10), minlength=hi - lo)
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_subwords) of every row."""
    path = path or vocabulary_path()
    size = len(tokenizer(path).get_vocab(with_added_tokens=True))
    end = size - 1                                    # the file's end-of-text id is its last
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    buckets = pieces_for(src.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    rows = prepare_chunks(src, buckets, path, end)
    chunks = rows.filter("bucket IS NULL")

    def total(table: pa.Table) -> pa.Table:
        n = np.array(table.column("n").to_pylist(), np.int64)
        h = np.frombuffer(b"".join(table.column("hashes").to_pylist()), "<u8")
        trained = np.concatenate([_unpack(t, i) for t, i in zip(table.column("trained").to_pylist(), n)])
        _, inverse = np.unique(h, return_inverse=True)
        count = np.bincount(inverse, weights=trained).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(n)])
        first = [1] + [0] * (len(n) - 1)
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "n": pa.array(n),
                         "counts": pa.array([_pack(count[inverse[i:j]]) for i, j in zip(bounds, bounds[1:])], pa.binary()),
                         "words": pa.array([int((count > 0).sum()) * f for f in first], pa.int64()),
                         "seen": pa.array([int(count.sum()) * f for f in first], pa.int64())})

    counted = scratch(rows.filter("bucket IS NOT NULL").select("bucket", "chunk", "n", "hashes", "trained").groupBy("bucket")
                      .applyInArrow(total, "chunk long, bucket long, n long, counts binary, words long, seen long"), "attention-words")
    distinct, seen = counted.agg(F.sum("words"), F.sum("seen")).first()
    ends = chunks.agg(F.sum("train_docs")).first()[0] or 0
    all_tokens = (seen or 0) + ends
    distinct = (distinct or 0) + (ends > 0)
    words, ids_seen = vocabulary(chunks, end, size)
    params = train(chunks, words, end, ids_seen)
    floor = np.log10(all_tokens + 0.5 * (distinct + 1))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        back = {r["bucket"]: _unpack(r["counts"], r["n"]) for r in right.to_pylist()}
        parts = []
        for r in left.to_pylist():
            home = _unpack(r["home"], r["n_distinct"])
            count = np.zeros(len(home), np.int64)
            if len(home):
                count[np.argsort(home, kind="stable")] = np.concatenate([back[b] for b in sorted(back)])
            count = count[_unpack(r["sequence"], r["n_words"])]
            per_doc = _unpack(r["doc_words"], len(r["ids"]))
            owner = np.repeat(np.arange(len(per_doc)), per_doc)
            base = np.bincount(owner, weights=np.log10(count + 0.5) - floor, minlength=len(per_doc)) + np.log10(ends + 0.5) - floor
            known = np.bincount(owner[count > 0], minlength=len(per_doc)) + (ends > 0)
            tokens, sizes = _tokens(r, end)
            parts.append(pa.table({
                "id": pa.array(r["ids"], pa.int64()), "held_out": pa.array(held_out(r["ids"])), "n_tokens": pa.array(per_doc + 1),
                "n_known": pa.array(known.astype(np.int64)), "train_tokens": pa.array(np.full(len(per_doc), all_tokens, np.int64)),
                "base_score": pa.array(base), "score": pa.array(score_documents(tokens, sizes, params, words, end)),
                "n_subwords": pa.array(sizes)}))
        return pa.concat_tables(parts)

    left = chunks.select("chunk", "ids", "doc_words", "n_distinct", "home", "n_words", "sequence", "doc_tokens", "n_tokens", "tokens")
    right = counted.select("chunk", "bucket", "n", "counts")
    return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(
        finish, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double, n_subwords long").withColumnRenamed("id", id_col)
