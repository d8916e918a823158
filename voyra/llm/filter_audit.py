"""Audit of how filters interact, over every order in which they can be applied.

``measure`` reads each text once with a byte transducer: the tables ``CLASS``
(byte -> class), ``NEXT`` (state, class -> state) and ``OUT`` (state, class -> what the
byte adds) are the whole machine. It counts words, code points, capitals and
symbols and gives the bounds of every word, which go into an open-addressing hash
table; an entry that meets a used place counts as the same word only if its bytes
are the same. The tables are stepped for all bytes of a slice at once: a byte that
isn't a continuation byte leads to the same state from everywhere, so the state after
each byte follows from the last such byte and the number of continuation bytes since.

``audit`` reduces the documents to (part, failed filters, labels) with counts, and
only these few rows meet the 120 orders: what an order's step removes depends on its
filter and on the set of filters before it, 80 pairs, from which each order is read off.

Identical texts are compared by SHA-256. The smallest id of a text comes from a grouped
minimum, joined back by digest, so a text that a third of all rows share is one row for
each part and task before it meets itself.

Defined results: a null or empty text has no words, fails A, and equals other null or
empty texts; a row without a source belongs to part ''; a row without an id has no
smaller one, is none to others, and has no labels; rows that repeat an id and a text
don't fail E through each other; repeated labels of an id count once, by their largest
value; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from voyra.llm import bytehash as B
from voyra.llm.common import map_text, scratch

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_CAPITAL_PCT = 2
SYMBOLS = "#$%&*|"

# the transducer -----------------------------------------------------------------

SPACE, CAPITAL, SYMBOL, OTHER, TAIL, LEAD2, LEAD3, LEAD4 = range(8)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
CLASS[65:91] = CAPITAL
CLASS[[ord(c) for c in SYMBOLS]] = SYMBOL
CLASS[0x80:0xC0] = TAIL
CLASS[0xC0:0xE0] = LEAD2
CLASS[0xE0:0xF0] = LEAD3
CLASS[0xF0:] = LEAD4

# GAP: between words; WORD: in one; WANT1 to WANT3: in one, with so many bytes of a code point to come
GAP, WORD, WANT1, WANT2, WANT3 = range(5)
NEXT = np.zeros((5, 8), np.uint8)
NEXT[:] = [GAP, WORD, WORD, WORD, WORD, WANT1, WANT2, WANT3]
NEXT[GAP, TAIL] = WORD                   # not in UTF-8: a tail without a lead counts as part of a word
NEXT[WANT2, TAIL], NEXT[WANT3, TAIL] = WANT1, WANT2

STARTS, ENDS, POINT, IS_CAPITAL, IS_SYMBOL = 1, 2, 4, 8, 16
OUT = np.zeros((5, 8), np.uint8)
OUT[:, :TAIL] = POINT
OUT[:, LEAD2:] = POINT
OUT[:, CAPITAL] |= IS_CAPITAL
OUT[:, SYMBOL] |= IS_SYMBOL
OUT[GAP, CAPITAL:] |= STARTS
OUT[WORD:, SPACE] |= ENDS

# state after a byte of class c and k tails more (the lead's class counts, not the state before it)
_AFTER = np.zeros((8, 4), np.uint8)
_AFTER[:, 0] = NEXT[GAP]
for _k in range(1, 4):
    _AFTER[:, _k] = NEXT[_AFTER[:, _k - 1], TAIL]
_AFTER[SPACE, 1:] = WORD


def states(kind: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """State before each byte; every text begins (``begins``) in GAP."""
    lead = np.where(kind != TAIL, np.arange(len(kind)), -1)
    lead[begins] = begins
    lead = np.maximum.accumulate(lead)
    after = _AFTER[kind[lead], np.minimum(np.arange(len(kind)) - lead, 3)]
    before = np.empty(len(kind), np.uint8)
    before[1:] = after[:-1]
    before[begins] = GAP
    return before


def transduce(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(what each byte adds, word starts, word ends) of texts that lie between ``offs``."""
    begins = offs[:-1][np.diff(offs) > 0]
    if not len(buf):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = CLASS[buf]
    before = states(kind, begins)
    out = OUT[before, kind]
    starts = np.flatnonzero(out & STARTS)
    # a word ends at the space after it or with its text
    last = np.append(begins[1:], len(buf)) - 1
    open_end = NEXT[before[last], kind[last]] != GAP
    return out, starts, np.sort(np.concatenate([np.flatnonzero(out & ENDS), last[open_end] + 1]))


# the hash table -----------------------------------------------------------------

def _eight(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place of ``buf`` as one number, zeros after the end."""
    wide = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(wide, (len(buf) + 1, 8), (1, 1))


def same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from ``a`` and from ``b`` are the same, for each pair."""
    out = np.ones(len(a), bool)
    view = _eight(buf)
    left, at = np.arange(len(a)), 0
    while len(left) and at < 64:
        x = np.ascontiguousarray(view[a[left] + at]).view("<u8").ravel()
        y = np.ascontiguousarray(view[b[left] + at]).view("<u8").ravel()
        rest = np.minimum(size[left] - at, 8).astype(np.uint64)
        drop = np.uint64(64) - np.uint64(8) * rest
        differ = ((x ^ y) << drop) != 0
        out[left[differ]] = False
        at += 8
        left = left[~differ & (size[left] > at)]
    for i in left:                         # words of more than 64 bytes
        out[i] = buf[a[i]: a[i] + size[i]].tobytes() == buf[b[i]: b[i] + size[i]].tobytes()
    return out


def distinct(buf: np.ndarray, row: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Marks the words that are the first of their row and spelling in a table with
    open addressing; ``key`` is a hash of the spelling and only says where to look."""
    new = np.zeros(len(row), bool)
    bits = max(4, int(2 * len(row) + 1).bit_length())
    table = np.full(1 << bits, -1, np.int64)
    at = (B.mix(key ^ B.mix(row.astype(np.uint64) + np.uint64(1))) >> np.uint64(64 - bits)).astype(np.int64)
    word, size = np.arange(len(row)), ends - starts
    while len(word):
        free = table[at] < 0
        # of the words that want a free place, one gets it; the others look at it again
        table[at[free][::-1]] = word[free][::-1]
        held = table[at]
        won = held == word
        new[word[won]] = True
        same = ~won & (row[held] == row[word]) & (size[held] == size[word])
        pair = np.flatnonzero(same)
        same[pair] = same_bytes(buf, starts[held[pair]], starts[word[pair]], size[word[pair]])
        go = ~(won | same)
        word, at = word[go], (at[go] + 1) & ((1 << bits) - 1)
    return new


def measure(text: pa.Array) -> list[np.ndarray]:
    """words, distinct words, capitals, code points and symbols of each text."""
    parts: list[list[np.ndarray]] = []
    for s in B.slices(text):
        out, starts, ends = transduce(s.buf, s.offs)
        row = np.searchsorted(s.offs, starts, side="right") - 1
        new = distinct(s.buf, row, starts, ends, s.span_hash(starts, ends))

        def per_row(flag: int) -> np.ndarray:
            total = np.zeros(len(out) + 1, np.int64)
            np.cumsum(out & flag != 0, out=total[1:])
            return np.diff(total[s.offs])
        parts.append([np.bincount(row, minlength=s.n), np.bincount(row[new], minlength=s.n),
                      per_row(IS_CAPITAL), per_row(POINT), per_row(IS_SYMBOL)])
    if not parts:
        return [np.zeros(0, np.int64)] * 5
    return [np.concatenate(c).astype(np.int64) for c in zip(*parts)]


# the audit ----------------------------------------------------------------------

FIELDS = "words long, distinct_words long, capitals long, points long, symbols long"


def failures(docs: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(id, part, digest, failed) of every row; bit i of ``failed`` is filter i of A to D."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                      F.unhex(F.sha2(body, 256)).alias("digest"), body.alias("body"))
    df, m = map_text(src, "body", FIELDS, measure, ["id", "part", "digest"], "measures")
    f = {c.split()[0]: F.col(m)[c.split()[0]] for c in FIELDS.split(", ")}
    rules = [f["words"] < MIN_WORDS, 100 * f["distinct_words"] < MIN_DISTINCT_PCT * f["words"],
             100 * f["capitals"] > MAX_CAPITAL_PCT * f["points"], f["symbols"] > 0]
    mask = sum((F.when(rule, 1 << i).otherwise(0) for i, rule in enumerate(rules)), F.lit(0))
    return df.select("id", "part", "digest", mask.cast("int").alias("failed"))


def _labelled(rows: DataFrame, labels: DataFrame, label_id: str, quality: str, toxic: str) -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` (0 or 1). Rows without an id have no partner, and
    are dealt out in turn so that they don't meet in one task."""
    one = labels.select(F.col(f"`{label_id}`").cast("long").alias("label_id"), F.col(f"`{quality}`").cast("int").alias("q"),
                        F.col(f"`{toxic}`").cast("int").alias("t")).filter("label_id IS NOT NULL")
    one = one.groupBy("label_id").agg((F.max("q") == 1).alias("good"), (F.max("t") == 1).alias("toxic"))
    one = one.withColumn("label_lane", F.lit(0).cast("long"))
    lane = F.when(F.col("id").isNull(), F.monotonically_increasing_id().bitwiseAND(F.lit(1023))).otherwise(0)
    known = rows.withColumn("lane", lane).join(one, (F.col("id") == F.col("label_id")) & (F.col("lane") == F.col("label_lane")), "left")
    return known.select(*rows.columns, *[F.coalesce(F.col(c), F.lit(False)).cast("int").alias(c) for c in ("good", "toxic")])


def counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "source",
           quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part, failed, n, good, toxic): documents by part and set of failed filters, A to E."""
    rows = _labelled(failures(docs, id_col, text, part), labels, id_col, quality, toxic)
    group = ["digest", "part", "failed", "good", "toxic"]
    # rows of an id first: the key of a text that many rows share is spread by their ids
    each = rows.groupBy(*group, "id").agg(F.count("*").alias("n"))
    per_text = each.groupBy(*group).agg(
        F.sum("n").alias("n"), F.min("id").alias("low"), F.min_by("n", "id").alias("n_low"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))
    # both sides of the join below read this table
    per_text = scratch(per_text, "audit-texts")
    least = per_text.groupBy(F.col("digest").alias("of")).agg(F.min("low").alias("least"))
    joined = per_text.join(least, F.col("digest") == F.col("of"))
    first = F.when(F.col("low") == F.col("least"), F.col("n_low")).otherwise(0)
    again = F.when(F.col("low").isNull(), 0).otherwise(F.col("n") - F.col("n_null") - first)
    kinds = F.explode(F.array(F.struct(F.col("failed").alias("set"), (F.col("n") - again).alias("docs")),
                              F.struct((F.col("failed") + 16).alias("set"), again.alias("docs")))).alias("kind")
    rows = joined.select("part", "good", "toxic", kinds).select("part", "good", "toxic", "kind.*")
    return rows.groupBy("part", F.col("set").alias("failed")).agg(
        F.sum("docs").alias("n"), F.sum(F.col("docs") * F.col("good")).alias("good"), F.sum(F.col("docs") * F.col("toxic")).alias("toxic"))


def steps() -> list[tuple[int, int, list[tuple[str, int]]]]:
    """(filter, filters before it as bits, [(order, step)]): the 80 pairs and the orders that hold them."""
    out = []
    n = len(FILTERS)
    for f in range(n):
        others = [i for i in range(n) if i != f]
        for k in range(n):
            for before in combinations(others, k):
                rest = [i for i in others if i not in before]
                orders = ["".join(FILTERS[i] for i in (*a, f, *b)) for a in permutations(before) for b in permutations(rest)]
                out.append((f, sum(1 << i for i in before), [(o, k + 1) for o in orders]))
    return out


def audit(by_failure: DataFrame) -> DataFrame:
    """Every step of every order, for each part of ``counts``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(b).alias("before")) for f, b, _ in steps()])).alias("pair")
    rows = by_failure.select("*", pairs).select("*", "pair.*")
    bit = F.expr("shiftleft(1, f)")
    fails = F.col("failed").bitwiseAND(bit) != 0
    gone = F.col("failed").bitwiseAND(F.col("before")) != 0

    def total(when, what="n"):
        return F.sum(F.when(when, F.col(what)).otherwise(0))
    per_pair = rows.groupBy("part", "f", "before").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("failed") == bit).alias("unique_fails"), total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"))
    # an order holds the pair (f, before) in |before|! * (4 - |before|)! of the 120
    size = F.bit_count("before")
    times = F.element_at(F.array(*[F.lit(factorial(k) * factorial(4 - k)) for k in range(5)]), (size + 1).cast("int"))
    share = per_pair.groupBy(F.col("part").alias("of_part"), F.col("f").alias("of_f")).agg(F.sum(F.col("removed") * times).alias("shapley"))
    joined = per_pair.join(share, (F.col("part") == F.col("of_part")) & (F.col("f") == F.col("of_f")))
    key = F.col("f") * 32 + F.col("before")
    held = F.create_map(*[x for f, b, orders in steps() for x in (
        F.lit(f * 32 + b), F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step")) for o, k in orders]))])
    out = joined.select("*", F.explode(held[key]).alias("at"))
    return out.select("part", "at.filter_order", F.col("at.step").cast("int").alias("step"),
                      *[F.col(c).cast("long").alias(c) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])
