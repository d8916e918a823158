"""Quality rules with suffix-array repetition.

Base rules count words, symbols, repeated lines and words in repeated 3-word
windows. The repetition rule builds, for every text, the suffix array of its
words by prefix doubling and the longest common prefix of neighbouring
suffixes; a suffix's larger LCP is the length of the longest maximal repeat
that starts there. The spans of all repeats of at least ``MIN_REPEAT`` words
are united; a text fails when they cover more than ``MAX_COVERED`` of its words
or when one repeat is longer than ``MAX_LONGEST`` of them.

Both limits lie well below the base rule: every covered word is also in a
repeated 3-word window, so a covered limit of ``MAX_REPEAT_PCT`` could reject
nothing more, and a passage found twice covers twice its length, so the longest
limit acts by itself only below half of the covered one.

All texts of a slice are sorted at once: the row is part of the first rank, so
suffixes of different texts never compare equal, and each doubling round sorts
only the suffixes that still share a rank.

Defined results: a null or empty text has zero counts and fails the base rules
(under 50 words); repeated rows each get their own result; an empty table gives
an empty result; extra columns pass through unread, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from voyra.llm import bytehash as B
from voyra.llm.common import map_text

MIN_WORDS = 50           # base rule: fewer words fail
MAX_REPEAT_PCT = 50      # base rule: percent of words in repeated 3-word windows
MIN_REPEAT = 8           # words of a repeat that counts as covered
MAX_COVERED = 0.2        # share of words inside such repeats
MAX_LONGEST = 0.08       # longest repeat, as a share of the text's words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, longest_repeat long, base_failed boolean, kept boolean")


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offs])


def duplicate_lines(s: B.Slice) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same row."""
    breaks = np.flatnonzero(s.buf == 10)
    starts = np.unique(np.concatenate([s.offs[:-1], breaks + 1]))
    starts = starts[starts < len(s.buf)]
    row = np.searchsorted(s.offs, starts, side="right") - 1
    ends = np.append(breaks, len(s.buf))[np.searchsorted(breaks, starts)]
    ends = np.minimum(ends, s.offs[row + 1])
    full = np.searchsorted(s.starts, ends) > np.searchsorted(s.starts, starts)
    row, h = row[full], s.span_hash(starts[full], ends[full])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    again = np.zeros(len(h), bool)
    again[1:] = (row[1:] == row[:-1]) & (h[1:] == h[:-1])
    return np.bincount(row[again], minlength=s.n)


def repeated_window_words(s: B.Slice, words: np.ndarray, length: int = 3) -> np.ndarray:
    """Words of each row inside windows of ``length`` words found twice or more in it."""
    at = s.window_ok(length)
    if not len(at):
        return np.zeros(s.n, np.int64)
    key = B.mix(B.window_hash(words, length)[at] ^ B.mix(s.row[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    twice = np.zeros(len(key), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(words) + length, bool)
    for k in range(length):
        hit[at[order[twice]] + k] = True
    return _per_row(hit[: len(words)], s.first)


def repeat_lengths(row: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Length of the longest repeat (within its row) that starts at each word.

    Suffix array by prefix doubling; neighbours' LCP from the ranks of every
    round, largest power of two first.
    """
    n = len(words)
    longest = np.zeros(n + 1, np.int64)
    if n < 2:
        return longest[:n]
    order = np.lexsort((words, row))
    new = np.ones(n, bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
    start = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    rank = np.empty(n, np.int64)
    rank[order] = start[group]
    row_end = np.searchsorted(row, row, side="right")
    levels = [rank.copy()]
    sizes = np.diff(np.append(start, n))
    active = order[sizes[group] > 1]
    h = 1
    while len(active):
        nxt = active + h
        second = np.where(nxt < row_end[active], rank[np.minimum(nxt, n - 1)] + 1, 0)
        key = rank[active] * np.int64(n + 1) + second
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        head = rank[active]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        lead = np.ones(len(key), bool)
        lead[1:] = head[1:] != head[:-1]
        idx = np.arange(len(key))
        start = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        lead_at = np.maximum.accumulate(np.where(lead, idx, 0))
        rank[active] = head + (start[group] - lead_at[start[group]])
        levels.append(rank.copy())
        sizes = np.diff(np.append(start, len(key)))
        active = active[sizes[group] > 1]
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    a, b = suffixes[:-1], suffixes[1:]
    near = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[near], b[near]
    lcp = np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < row_end[a]) & (y < row_end[b])
        same = inside & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        lcp += same * (1 << k)
    np.maximum.at(longest, a, lcp)
    np.maximum.at(longest, b, lcp)
    return longest[:n]


def measure(text: pa.Array, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
            max_longest: float = MAX_LONGEST) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = []
    for s in B.slices(text):
        words = s.word_hash()
        n = s.counts()
        repeat = repeated_window_words(s, words)
        chars = _per_row(~B._SPACE[s.buf] & ((s.buf & 0xC0) != 0x80), s.offs)
        length = repeat_lengths(s.row, words)
        length[length < min_repeat] = 0
        at = np.arange(len(words))
        reach = np.maximum.accumulate(at + length) if len(at) else at
        covered = _per_row(reach > at, s.first)
        longest = np.zeros(s.n, np.int64)
        np.maximum.at(longest, s.row, length)
        failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * n)
        kept = ~failed & (covered <= max_covered * n) & (longest <= max_longest * n)
        parts.append([n, chars, _per_row(_SYMBOL[s.buf], s.offs), duplicate_lines(s), repeat,
                      covered, longest, failed, kept])
    if not parts:
        return [np.zeros(0, np.int64)] * 7 + [np.zeros(0, bool)] * 2
    return [np.concatenate(c) for c in zip(*parts)]


def quality(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
            **limits) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of the measures and the verdict ``kept``."""
    return map_text(docs, text, FIELDS, lambda t: measure(t, **limits), keep, "quality")


def keep_good(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    df, q = quality(docs, text, **limits)
    return df.filter(F.col(q)["kept"]).drop(q)
