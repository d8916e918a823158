"""Profiles kept as mergeable sketches, one for each day.

A day's sketches are made once, when its data come, and stored: an HLL sketch of the
distinct values, and an approximate top-k sketch of the frequent ones. Any span of days is
described by merging its sketches; the days' data are not read again, and a new day
reads only itself. The exact form (``profile.describe``) stands beside it.

HLL: relative standard error 1.04 / sqrt(2**lg_k) (1.6 % at 12). Top-k: frequencies are exact as
long as a day and the span have at most three quarters of ``items`` different values, and
estimates beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 12
ITEMS = 1024


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def day_sketches(df: DataFrame, day: Column, value: str, frequent: str, lg_k: int = LG_K, items: int = ITEMS) -> DataFrame:
    """One row a day: rows, sketch of the distinct ``value``, sketch of the frequent values of ``frequent``."""
    return df.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(value, F.lit(lg_k)).alias("distinct_sketch"),
        F.expr(f"approx_top_k_accumulate({frequent}, {items})").alias("top_sketch"))


def add_days(df: DataFrame, path: str) -> None:
    """Store the sketches of the days in ``df``; a day that is there is replaced, others stay as they are."""
    (df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))


def merged(days: DataFrame, by: list[str] | None = None, k: int = 5) -> DataFrame:
    """(by..., n, n_distinct, top) of merged days; ``top`` is an array of (item, count), most frequent first."""
    g = days.groupBy(*(by or [])).agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
                                      F.expr("approx_top_k_combine(top_sketch)").alias("top_sketch"))
    return g.withColumn("top", F.expr(f"approx_top_k_estimate(top_sketch, {k})")).drop("top_sketch")
