"""Mixing sources to target weights over a time-varying curriculum.

``plan`` decides how many words the mix takes of every document: sources share
``SHARE`` of all words by weight, no source gives more than ``MAX_PASSES``
times its own words, and what it cannot give is shared again by weight. Inside
a source the documents stand in a hashed order; the mix reads the source from
the start, pass after pass, until its target is reached, so only one document
of a source is taken in part.

``positions`` integrates each source's weight schedule into its cumulative
demand, a rising function of training time in [0, 1], and inverts it: a word
that is the x-th of its source's target stands where the demand reaches x.
Documents are then range-sorted by that position.

No source is ever in one task: the order is cut into hash buckets of about
``BUCKET_ROWS`` rows, cumulative sizes are made inside the buckets, and a table
of bucket totals (one row for each source and bucket) gives the offsets.

Defined results: a null text or one without words has size 0 and is taken 0
times; a null source is a source of its own, last in order; rows that repeat a
doc_id count as rows of their own, and so do rows without one, which take their
place in the order by their content; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from voyra.llm import bytehash as B
from voyra.llm.common import map_text, scratch

WEIGHTS = (3, 1, 2)      # by a source's rank, repeating
SHARE = 1.5
MAX_PASSES = 2
BUCKET_ROWS = 1024

# (time, factor) knots of the weight schedule by a source's rank, repeating; a
# factor scales the source's weight, is linear between knots and has mean 1.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),              # early
    ((0.0, 0.5), (1.0, 1.5)),              # late
    ((0.0, 1.0), (1.0, 1.0)),              # even
)


def sizes(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` with a struct column holding ``size``, the number of words."""
    def count(col):
        parts = [s.counts() for s in B.slices(col)]
        return [np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)]
    return map_text(docs, text, "size long", count, keep, "words")


def targets(per_source: DataFrame, weights=WEIGHTS, share: float = SHARE,
            max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, source_rank, target) from (source, source_size).

    Water filling: sources in order of capacity per weight; the common level is
    that of the first one that stays below its own capacity. The windows run
    over one row for each source, not over documents.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    df = per_source.select("source", "source_size", rank.alias("source_rank"), w.alias("weight"))
    everything = W.partitionBy()
    by_ratio = W.orderBy(F.col("source_size") / F.col("weight"), "source_rank").rowsBetween(
        W.unboundedPreceding, -1)
    df = (df.withColumn("total", F.sum("source_size").over(everything))
            .withColumn("weights", F.sum("weight").over(everything))
            .withColumn("full", F.coalesce(F.sum("source_size").over(by_ratio), F.lit(0)))
            .withColumn("full_weight", F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))))
    level = ((share * F.col("total") - max_passes * F.col("full"))
             / (F.col("weights") - F.col("full_weight")))
    cap = (max_passes * F.col("source_size")).cast("double")
    df = df.withColumn("level", level).withColumn("cap", cap)
    # levels rise up to the first source that stays below its capacity and fall after it
    df = df.withColumn("common", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                                              F.col("level"))).over(everything))
    target = F.when(F.col("total") == 0, 0.0).otherwise(
        F.coalesce(F.least(F.col("cap"), F.col("common") * F.col("weight")), F.col("cap")))
    return df.select("source", "source_size", "source_rank", target.alias("target"))


def _order(id_col: str, content: Column | None) -> Column:
    """Hashed order of a source's rows; those without an id go by their content, if it is at hand."""
    key = F.xxhash64(id_col)
    return key if content is None else F.when(F.col(id_col).isNull(), content).otherwise(key)


def plan(docs: DataFrame, id_col: str = "doc_id", source: str = "source", size: str = "size",
         **rule) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, size, source_size, source_rank,
    target, start (words of the source before it) and taken."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
                     F.col(size).cast("long").alias("size"))
    df = _planned(df.withColumn("order_key", _order("doc_id", None)), None, ["order_key", "doc_id", "size"], **rule)
    return df.select("doc_id", "source", "size", "source_size", "source_rank", "target", "start", "taken")


def _planned(light: DataFrame, rows: DataFrame | None, order: list[str], **rule) -> DataFrame:
    """``rows`` (``light`` itself, if None) with source_size, source_rank, target, start
    and taken. Both have source, size, order_key; ``light`` is read several times."""
    df = light
    buckets = max(16, -(-df.count() // BUCKET_ROWS))
    # a struct that holds the source: null sources meet in a plain equi-join, which then
    # asks for the window's own partitioning, so that rows are dealt out once for both
    at = [F.struct("source").alias("src"), F.pmod("order_key", F.lit(buckets)).cast("int").alias("bucket")]
    per_bucket = df.select("*", *at).groupBy("src", "bucket").agg(F.sum("size").alias("bucket_size"))
    per_bucket = scratch(per_bucket, "mix-buckets")
    goal = targets(per_bucket.groupBy(F.col("src.source").alias("source")).agg(F.sum("bucket_size").alias("source_size")), **rule)
    before = W.partitionBy("src").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offset = per_bucket.select("src", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    offset = offset.join(goal.select(F.struct("source").alias("src"), *[c for c in goal.columns if c != "source"]), "src")
    inside = W.partitionBy("src", "bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    df = (df if rows is None else rows).select("*", *at)
    df = df.withColumn("inner_start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    df = df.join(offset, ["src", "bucket"])
    start = F.col("offset") + F.col("inner_start")
    words = F.round(F.col("target")).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0)
    rest = words - passes * F.col("source_size")
    partial = F.least(F.greatest(rest - start, F.lit(0)), F.col("size"))
    return df.withColumn("start", start).withColumn(
        "taken", (passes * F.col("size") + partial).cast("long")).drop(
        "bucket", "src", "order_key", "offset", "inner_start")


def _invert(knots: tuple, share: Column) -> Column:
    """Time at which the integral of a piecewise linear schedule reaches ``share`` of its whole."""
    pieces, total = [], 0.0
    for (t0, f0), (t1, f1) in zip(knots, knots[1:]):
        area = (f0 + f1) / 2 * (t1 - t0)
        pieces.append((t0, t1, f0, f1, total, area))
        total += area
    want = share * total
    out = None
    for t0, t1, f0, f1, done, area in reversed(pieces):
        x = F.greatest(want - done, F.lit(0.0))
        slope = (f1 - f0) / (t1 - t0)
        # f0 * d + slope / 2 * d**2 = x, in the form that is stable for any slope
        at = t0 + 2 * x / (f0 + F.sqrt(F.greatest(F.lit(f0 * f0) + 2 * slope * x, F.lit(0.0))))
        out = F.least(at, F.lit(t1)) if out is None else F.when(want >= done + area, out).otherwise(F.least(at, F.lit(t1)))
    return out


def position(schedules=SCHEDULES, words_before: Column | None = None) -> Column:
    """Training time of a row of ``plan``: where its source's demand reaches the
    middle of what is taken of its first copy; null if nothing is taken."""
    begin = F.col("start") if words_before is None else words_before
    share = F.when(F.col("target") > 0, F.least(
        (begin + F.least(F.col("taken"), F.col("size")) / 2) / F.col("target"), F.lit(1.0)))
    kind = (F.col("source_rank") - 1) % len(schedules)
    out = F.lit(None).cast("double")
    for i, knots in enumerate(schedules):
        out = F.when(kind == i, _invert(knots, share)).otherwise(out)
    return F.when(F.col("taken") > 0, out)


def copies(planned: DataFrame) -> DataFrame:
    """One row for each copy that the mix reads, with the columns of ``planned``, copy (from 0),
    words and position. A document is in at most ``MAX_PASSES`` + 1 rows, whatever the input's size."""
    n = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    df = planned.filter(F.col("taken") > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), n - 1)))
    words = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    begin = F.col("start") + F.col("copy") * F.col("source_size")
    return df.withColumn("words", words).withColumn("position", position(words_before=begin))


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
        **rule) -> DataFrame:
    """The plan of ``docs`` with ``position``, range-sorted by it (not taken ones first)."""
    sized, c = sizes(docs, text, [id_col, source])
    sized = scratch(sized.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
                                 F.col(c)["size"].alias("size")), "mix-sizes")
    planned = plan(sized, **rule).withColumn("position", position())
    return planned.orderBy("position", "doc_id")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source: str = "source",
                    text: str = "text", **rule) -> DataFrame:
    """The training stream as rows of ``docs``: one row for each copy of which at
    least half is taken, range-sorted by position, with the columns of ``docs``.

    Each row is planned and repeated by itself, whatever its id: nothing is joined
    on it. Only rows that agree in id and size are ordered by their content."""
    row = [F.col(f"`{c}`") for c in docs.columns]
    sized, c = sizes(docs, text)
    rows = sized.select(F.struct(*row).alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                        F.col(f"`{source}`").alias("source"), F.col(c)["size"].alias("size"),
                        F.xxhash64(*row).alias("content"))
    rows = rows.withColumn("order_key", _order("doc_id", F.col("content")))
    light = scratch(rows.select("source", "size", "order_key"), "mix-sizes")
    stream = copies(_planned(light, rows, ["order_key", "doc_id", "size", "content"], **rule))
    stream = stream.filter(2 * F.col("words") >= F.col("size"))
    return stream.orderBy("position", "doc_id", "copy", "content").select("row.*")
