"""Column profiles: count / unique / top / freq, and distinct counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def describe(df: DataFrame, col: str) -> DataFrame:
    """count / unique / top / freq of one string column (top: most frequent,
    ties to the smallest value). One grouped count (map-side combined), then
    one aggregate over the distinct values."""
    counts = df.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n")).where(F.col("v").isNotNull())
    return counts.agg(
        F.sum("n").cast("long").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("top"),
        F.max("n").alias("freq"),
    ).select(F.lit(col).alias("column"), "*")


def distinct_counts(df: DataFrame, cols: list[str], approx: bool = False, rsd: float = 0.01,
                    digest: tuple[str, ...] = ()) -> DataFrame:
    """One row with the number of distinct values of each column.

    Exact by default; columns in ``digest`` (long texts) are counted by their
    SHA-256 digest so the distinct shuffle moves 32 bytes a row. ``approx``
    uses HyperLogLog++ (``approx_count_distinct``, relative error ``rsd``):
    no shuffle of values at all, for very large tables.
    """
    aggs = []
    for c in cols:
        v = F.sha2(F.col(c), 256) if c in digest else F.col(c)
        aggs.append((F.approx_count_distinct(v, rsd) if approx else F.count_distinct(v)).alias(c))
    return df.agg(*aggs)
