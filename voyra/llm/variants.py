"""Spelling variants: words that differ from a more frequent word by one edit.

``vocabulary`` counts the words of all texts. ``near`` finds for each word the words at
edit distance one by dynamic programming over a sorted list: the list is walked by
prefixes, the row of the edit matrix (three cells around the diagonal) that belongs to a
prefix is made once and serves all words that share it (those between two places of a
smaller LCP), and a range of words whose shared prefix is already more than one edit
away is skipped. All words of a list are looked up at once, one column at a time.

The vocabulary is never one list. A pair of words of c and of c or c + 1 code points that
differ in one place agrees in the first c // 2 code points or in the last c - c // 2, so
it meets in the list of that beginning or of that end (in the second only if it doesn't
meet in the first: each pair is found once). A list of more than ``LIST_CHARS``
code points is split in the same way, by half of what isn't fixed yet; when all but one
place is fixed, a list cannot hold more than the alphabet's square. So no task holds an
unbounded list, no list is compared with itself in pairs, and nothing is left out.

Defined results: null and empty texts have no words; a row without an id counts as one
with an empty id; rows that repeat an id and a text count each; very long runs are words
like others; ties of n go to the smaller word by code points; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from voyra.llm import bytehash as B
from voyra.llm.common import scratch

MIN_POINTS = 7           # code points of a word
MIN_COUNT = 2            # occurrences of a word
ALTER = 31               # a run whose crc32 this divides loses a code point
FACTOR = 10              # a form is so many times as frequent
LIST_CHARS = 300_000     # code points of a list that is walked at once
QUERY_ROWS = 16_384      # words looked up at once
GATHER_WORDS = 400_000   # words gathered before a task passes counts on
COLUMNS = 64             # bytes of a run whose crc32 is made side by side with others

# ASCII letters in lower case; lead byte of U+00C0 to U+00FF; all others become a space
_RUN = np.full(256, 32, np.uint8)
_RUN[97:123] = np.arange(97, 123)
_RUN[65:91] = np.arange(97, 123)
_RUN[0xC3] = 0xC3

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1))


# the vocabulary -------------------------------------------------------------------

def runs(s: B.Slice) -> B.Slice:
    """The slice with letter runs as words, A to Z lower-cased."""
    buf = _RUN[s.buf]
    tail = np.zeros(len(buf), bool)
    tail[1:] = s.buf[:-1] == 0xC3
    buf[tail] = s.buf[tail]
    return B.words_of(s.lo, s.hi, buf, s.offs)


def crc32(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """zlib.crc32 of each span, carried on from ``seed``."""
    order = np.argsort(starts - ends, kind="stable")
    at, size = starts[order], (ends - starts)[order]
    crc = ~seed[order].astype(np.uint32)
    live = len(at)
    for k in range(min(COLUMNS, int(size[0]) if live else 0)):
        live = int(np.searchsorted(-size, -k, side="left"))       # spans of more than k bytes
        c = crc[:live]
        crc[:live] = _CRC[(c ^ buf[at[:live] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out = np.empty(len(at), np.uint32)
    out[order] = ~crc
    for i in np.flatnonzero(ends - starts > COLUMNS):
        out[i] = zlib.crc32(buf[starts[i] + COLUMNS: ends[i]].tobytes(), int(out[i]))
    return out


def count_words(ids: list, text: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(hash, word, occurrences) of the altered runs, for each slice."""
    for raw in B.slices(text):
        s = runs(raw)
        points = np.zeros(len(s.buf) + 1, np.int64)
        np.cumsum((s.buf & 0xC0) != 0x80, out=points[1:])
        size = points[s.ends] - points[s.starts]
        long = size >= MIN_POINTS
        starts, ends, size, row = s.starts[long], s.ends[long], size[long], s.row[long]
        seeds = np.zeros(s.n, np.uint32)
        for r in np.unique(row):
            i = ids[s.lo + r]
            seeds[r] = zlib.crc32(b"%s:" % (b"" if i is None else str(i).encode()))
        h = crc32(s.buf, starts, ends, seeds[row])
        altered = h % ALTER == 0
        words = []
        for i in np.flatnonzero(altered & (size > MIN_POINTS)):
            w, cut = s.buf[starts[i]: ends[i]].tobytes().decode(), int(h[i]) % int(size[i])
            words.append(w[:cut] + w[cut + 1:])
        if words:
            more = pa.array(words, pa.string())
            t = next(B.slices(more, max_bytes=1 << 62))
            key, first, n = np.unique(t.word_hash(), return_index=True, return_counts=True)
            yield key, more.take(pa.array(first)), n
        starts, ends = starts[~altered], ends[~altered]
        if len(starts):
            key, first, n = np.unique(s.span_hash(starts, ends), return_index=True, return_counts=True)
            yield key, B.take_spans(s.buf, starts[first], ends[first]), n


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words with enough code points and occurrences."""
    def merged(parts: list) -> pa.RecordBatch:
        key = np.concatenate([p[0] for p in parts])
        words = pa.chunked_array([p[1] for p in parts])
        _, first, at = np.unique(key, return_index=True, return_inverse=True)
        n = np.bincount(at, np.concatenate([p[2] for p in parts])).astype(np.int64)
        return pa.RecordBatch.from_arrays([words.take(pa.array(first)).combine_chunks().cast(pa.string()), pa.array(n)], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            for part in count_words(b.column(0).to_pylist(), b.column(1)):
                parts.append(part)
                held += len(part[0])
                if held > GATHER_WORDS:
                    yield merged(parts)
                    parts, held = [], 0
        if parts:
            yield merged(parts)

    src = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text}`"))
    words = src.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.filter(F.col("n") >= MIN_COUNT)


# words at distance one ------------------------------------------------------------

def walk(m: np.ndarray, size: np.ndarray, group: np.ndarray, depth: np.ndarray, bar: np.ndarray,
         least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, near word) as row numbers of ``m``: code points of sorted words, zeros after
    the end and at least two columns of them. Rows of one ``group`` lie together and share their
    first ``depth`` code points; pairs that share ``bar`` of them or more aren't wanted,
    nor those whose shorter word doesn't have ``least``."""
    n = len(m)
    first = np.searchsorted(group, group, side="left")
    past = np.searchsorted(group, group, side="right")
    lcp = np.full(n, -1, np.int64)
    if n > 1:
        lcp[1:] = np.where(group[1:] == group[:-1], (m[1:] != m[:-1]).argmax(axis=1), -1)
    by_lcp = np.argsort(lcp, kind="stable")
    cut = np.searchsorted(lcp[by_lcp], np.arange(m.shape[1] + 1))
    out_q, out_v = [], []
    for begin in range(0, n, QUERY_ROWS):
        todo = np.arange(begin, min(n, begin + QUERY_ROWS))
        todo = todo[past[todo] - first[todo] > 1]
        todo = todo[np.argsort(depth[todo], kind="stable")]
        q = lo = hi = np.zeros(0, np.int64)
        row = np.zeros((3, 0), np.int8)
        d = int(depth[todo[0]]) if len(todo) else m.shape[1]
        while d < m.shape[1]:
            fresh = todo[np.searchsorted(depth[todo], d): np.searchsorted(depth[todo], d, side="right")]
            if len(fresh):                  # their row: deletion, the diagonal, insertion
                q, lo, hi = (np.concatenate(x) for x in ((q, fresh), (lo, first[fresh]), (hi, past[fresh])))
                start = np.array([[1 if d else 2], [0], [1]], np.int8)
                row = np.concatenate([row, np.repeat(start, len(fresh), axis=1)], axis=1)
            if not len(q):
                later = depth[todo] > d
                if not later.any():
                    break
                d = int(depth[todo][later].min())
                continue
            # the words of a range that go on with the same code point
            edges = by_lcp[cut[d]: cut[d + 1]]
            s, e = np.searchsorted(edges, lo, side="right"), np.searchsorted(edges, hi, side="left")
            many = e - s + 1
            of = np.repeat(np.arange(len(q)), many)
            k = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            at = s[of] + k
            padded = np.append(edges, 0) if len(edges) else np.zeros(1, np.int64)
            new_lo = np.where(k == 0, lo[of], padded[np.maximum(at - 1, 0)])
            new_hi = np.where(k == many[of] - 1, hi[of], padded[np.minimum(at, len(padded) - 1)])
            q, lo, hi, row = q[of], new_lo, new_hi, row[:, of]
            c = m[lo, d]
            over = c == 0                   # the word ends here: its distance stands in the row
            if over.any():
                off = size[q[over]] - d + 1
                near = (off >= 0) & (off <= 2)
                near[near] = row[off[near], np.flatnonzero(over)[near]] == 1
                eq, ev = q[over][near], lo[over][near]
                ok = np.minimum(size[eq], size[ev]) == least[eq]
                out_q.append(eq[ok])
                out_v.append(ev[ok])
                go = ~over
                q, lo, hi, row, c = q[go], lo[go], hi[go], row[:, go], c[go]
            left = row[0] + (m[q, d - 1] != c if d else np.int8(1))
            left = np.minimum(left, row[1] + 1)
            mid = np.minimum(np.minimum(row[1] + (m[q, d] != c), row[2] + 1), left + 1)
            right = np.minimum(row[2] + (m[q, min(d + 1, m.shape[1] - 1)] != c), mid + 1)
            row = np.minimum(np.stack([left, mid, right]), 2).astype(np.int8)
            d += 1
            # skipped: more than one edit away, alone with itself, or met in the other list
            go = (row.min(axis=0) <= 1) & ~((hi - lo == 1) & (lo == q)) & ~((bar[q] == d) & (row[1] == 0))
            q, lo, hi, row = q[go], lo[go], hi[go], row[:, go]
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out_q]), np.concatenate([empty, *out_v])


def matrix(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, all below 256, zeros after the end; sizes)."""
    latin = [w.encode("latin-1") for w in words.to_pylist()]
    size = np.array([len(w) for w in latin], np.int64)
    wide = int(size.max(initial=0)) + 2
    m = np.zeros((len(latin), wide), np.uint8)
    flat = np.frombuffer(b"".join(latin), np.uint8)
    m[np.repeat(np.arange(len(latin)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return m, size


def _solve(table: pa.Table) -> pa.RecordBatch:
    """Near words of the rows of whole lists: their number, the most frequent and its n."""
    table = table.combine_chunks()
    words = table.column("word").combine_chunks()
    m, size = matrix(words)
    key = table.column("list").combine_chunks().dictionary_encode().indices.to_numpy()
    change = np.ones(len(key), bool)
    change[1:] = key[1:] != key[:-1]
    n, c, a, bar = (table.column(x).to_numpy() for x in ("n", "c", "a", "bar"))
    q, v = walk(m, size, np.cumsum(change) - 1, a, bar, c)
    order = np.lexsort((v, -n[v], q))
    q, v = q[order], v[order]
    head = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    near = np.diff(np.append(head, len(q)))
    return pa.RecordBatch.from_arrays(
        [words.take(pa.array(q[head])), pa.array(near.astype(np.int64)), words.take(pa.array(v[head])), pa.array(n[v[head]])],
        ["word", "n_near", "best", "best_n"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gathers whole lists from rows sorted by list, and walks them."""
    held: list[pa.RecordBatch] = []
    chars = 0
    for b in batches:
        held.append(b)
        chars += pc.sum(pc.utf8_length(b.column(b.schema.get_field_index("word")))).as_py() or 0
        if chars < LIST_CHARS:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column("list")
        # the last list may go on in the next batch
        last = pc.index(keys, keys[len(keys) - 1]).as_py()
        if last:
            yield _solve(table.slice(0, last))
        rest = table.slice(last).combine_chunks()
        held = rest.to_batches()
        chars = pc.sum(pc.utf8_length(rest.column("word"))).as_py() or 0
    if held:
        yield _solve(pa.Table.from_batches(held))


def _lists(rows: DataFrame) -> DataFrame:
    """``rows`` (word, n, c, a, b, bar) with the list that each belongs to: words of class c
    with the same first a and last b code points."""
    ends = F.when(F.col("b") == 0, "").otherwise(F.expr("right(word, b)"))
    return rows.withColumn("list", F.concat_ws(" ", "c", "a", "b", F.expr("left(word, a)"), ends))


def near(vocab: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of the words of ``vocab`` (word, n; distinct, code points up
    to U+00FF) that have near words: how many, and the one of largest n."""
    size = F.length("word")
    rows = vocab.withColumn("c", F.explode(F.array(size, size - 1))).filter(F.col("c") > 0)
    half = F.floor(F.col("c") / 2).cast("int")
    none = F.lit(1 << 30)
    side = F.explode(F.array(F.struct(half.alias("a"), F.lit(0).alias("b"), none.alias("bar")),
                             F.struct(F.lit(0).alias("a"), (F.col("c") - half).alias("b"), half.alias("bar"))))
    rows = _lists(rows.withColumn("side", side).select("word", "n", "c", "side.*"))
    found = []
    while True:
        # lists that are too long and can be split: few, whatever the size of the vocabulary
        chars = rows.groupBy("list").agg(F.sum(F.length("word").cast("long")).alias("chars"), F.first(F.col("c") - F.col("a") - F.col("b")).alias("open"))
        long = scratch(chars.filter((F.col("chars") > LIST_CHARS) & (F.col("open") > 1)).select("list"), "long-lists")
        if long.isEmpty():
            found.append(_walked(rows))
            break
        found.append(_walked(rows.join(long, "list", "left_anti")))
        split = rows.join(long, "list", "left_semi")
        step = F.floor((F.col("c") - F.col("a") - F.col("b")) / 2).cast("int")
        side = F.explode(F.array(
            F.struct((F.col("a") + step).alias("a"), F.col("b"), F.col("bar")),
            F.struct(F.col("a"), (F.col("c") - F.col("a") - step).alias("b"), F.least("bar", F.col("a") + step).alias("bar"))))
        rows = scratch(_lists(split.withColumn("side", side).select("word", "n", "c", "side.*")), "split-lists")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    least = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    out = out.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("least"))
    return out.select("word", "n_near", F.col("least.word").alias("best"), (-F.col("least.n")).alias("best_n"))


def _walked(rows: DataFrame) -> DataFrame:
    rows = rows.select("list", "word", "n", "c", "a", "bar")
    rows = rows.repartition("list").sortWithinPartitions("c", "list", "word")
    return rows.mapInArrow(_scan, "word string, n_near long, best string, best_n long")


# forms ----------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain, by doubling. A form is at least
    ``FACTOR`` times as frequent as its word, so chains have no cycles and the
    rounds are few: the logarithm of the logarithm of the largest count."""
    reach = scratch(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reach.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = reach.join(onward, F.col("root") == F.col("at"), "left")
        step = scratch(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.filter("moved").isEmpty():
            return reach
        reach = step.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every word with its form, root, number of near words and counts."""
    vocab = scratch(vocabulary(docs, id_col, text), "vocabulary")
    found = near(vocab)
    v = vocab.join(found, "word", "left")
    is_form = F.col("best_n") >= FACTOR * F.col("n")
    v = v.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                 F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    v = scratch(v, "variants")
    ends = roots(v.filter("form IS NOT NULL"))
    v = v.join(ends, "word", "left")
    return v.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
