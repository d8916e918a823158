"""Token counts: an exact histogram of encoded lengths.

Documents are encoded word by word (each distinct word of a few MB of text once,
a bounded cache for each worker) and only their lengths leave the task. They are
aggregated to (length, documents); from that table suffix sums answer, for
every context limit, how many documents are longer, how many tokens a cut at
the limit keeps, and which quantile the limit is. The histogram has one row for
each distinct length; its running sums are made inside ranges of ``RANGE``
lengths, with the ranges' totals as offsets.

Defined results: a null or empty text has length 0; repeated rows count each; an
empty table gives an empty histogram; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from voyra.llm import bytehash as B
from voyra.llm.bpe import encode_words, vocabulary_path
from voyra.llm.common import map_text, scratch

RANGE = 256
CACHE_WORDS = 1 << 18

_cache: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def word_lengths(s: B.Slice, path: str) -> np.ndarray:
    """Tokens of each word of a slice; encodes words that the worker does not remember."""
    distinct, at, inverse = np.unique(s.word_hash(), return_index=True, return_inverse=True)
    known, sizes = _cache.get(path, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    where = np.searchsorted(known, distinct)
    hit = np.zeros(len(distinct), bool)
    if len(known):
        hit = known[np.minimum(where, len(known) - 1)] == distinct
    out = np.empty(len(distinct), np.int64)
    out[hit] = sizes[where[hit]]
    miss = at[~hit]
    words = B.take_spans(s.buf, s.starts[miss], s.ends[miss]).to_pylist()
    out[~hit] = [len(i) for i in encode_words(words, path)]
    if len(known) + len(miss) > CACHE_WORDS:
        known, sizes = known[:0], sizes[:0]
    both = np.concatenate([known, distinct[~hit]])
    order = np.argsort(both)
    _cache[path] = both[order], np.concatenate([sizes, out[~hit]])[order]
    return out[inverse]


def token_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                 path: str | None = None) -> tuple[DataFrame, str]:
    """``docs`` with a struct column holding ``n_tokens``."""
    path = path or vocabulary_path()

    def count(col: pa.Array) -> list:
        parts = []
        for s in B.slices(col):
            total = np.concatenate([[0], np.cumsum(word_lengths(s, path))])
            parts.append(np.diff(total[s.first]))
        return [np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)]

    return map_text(docs, text, "n_tokens long", count, keep, "tokens")


def histogram(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """(n_tokens, n_docs), exact; written once, so that no answer encodes again."""
    df, c = token_counts(docs, text, [], path)
    return scratch(df.groupBy(F.col(c)["n_tokens"].alias("n_tokens")).agg(F.count("*").alias("n_docs")), "lengths")


def limits(hist: DataFrame) -> DataFrame:
    """For every length that occurs, as a context limit: documents and tokens in all,
    documents longer than it, tokens that a cut at it keeps, tokens it drops, and
    the share of documents that fit (so the smallest limit with a share of at
    least q is the q-quantile)."""
    df = hist.withColumn("range", F.floor(F.col("n_tokens") / RANGE)).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs"))
    per_range = df.groupBy("range").agg(F.sum("n_docs").alias("range_docs"), F.sum("tokens").alias("range_tokens"))
    after = W.orderBy(F.col("range").desc()).rowsBetween(W.unboundedPreceding, -1)     # one row for each range
    everything = W.partitionBy()
    per_range = per_range.select(
        "range", F.coalesce(F.sum("range_docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("range_tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("range_docs").over(everything).alias("total_docs"),
        F.sum("range_tokens").over(everything).alias("total_tokens"))
    longer = W.partitionBy("range").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, -1)
    df = df.join(per_range, "range")
    over = F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("docs_after")
    over_tokens = F.coalesce(F.sum("tokens").over(longer), F.lit(0)) + F.col("tokens_after")
    return df.select(
        F.col("n_tokens").alias("context_limit"), "n_docs", over.alias("docs_longer"),
        "total_docs", "total_tokens",
        (F.col("total_tokens") - over_tokens + F.col("n_tokens") * over).alias("kept_tokens"),
        (over_tokens - F.col("n_tokens") * over).alias("dropped_tokens"),
        ((F.col("total_docs") - over) / F.col("total_docs")).alias("share_that_fits"))


def quantiles(hist: DataFrame, levels: list[float]) -> DataFrame:
    """(level, n_tokens): the smallest length that at least ``level`` of the documents fit."""
    at = limits(hist)
    return at.agg(*[F.min(F.when(F.col("share_that_fits") >= q, F.col("context_limit"))).alias(f"q{i}")
                    for i, q in enumerate(levels)]).select(F.explode(F.array(*[
                        F.struct(F.lit(float(q)).alias("level"), F.col(f"q{i}").alias("n_tokens"))
                        for i, q in enumerate(levels)])).alias("x")).select("x.*")


def truncated_total(hist: DataFrame, limit: int) -> DataFrame:
    """(kept_tokens): tokens that stay when every document is cut at any ``limit``."""
    return hist.agg(F.coalesce(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("kept_tokens"))
