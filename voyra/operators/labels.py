"""Category codes, label lookups and the deterministic split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voyra.operators.numbering import seq_number


SENT_BYTES = 32 << 20


def category_codes(values: DataFrame, col: str, out: str = "code") -> DataFrame:
    """Distinct values of ``col`` -> (col, code), code = position in sorted
    order, 0-based (a ``StringIndexer`` with alphabetical order gives the same).

    Numbered with ``seq_number`` over ranges cut where the values are, so a long
    list is numbered by many tasks, however much its values begin alike.
    """
    d = values.select(col).where(F.col(col).isNotNull()).distinct()
    return seq_number(d, [], [col], out=out)


def attach_codes(df: DataFrame, codes: DataFrame, col: str, code: str = "code") -> DataFrame:
    """name -> code. The code table has one row per class; it goes to every executor
    when it is small by measure, so rows stay where they are (classes are few, and a shuffle by class
    would put a class, texts and all, into one task), else it joins
    by sort-merge (and splits a skewed class with the skew-join rule)."""
    return df.join(sent(codes.select(col, code), col), col, "left")


def attach_names(df: DataFrame, codes: DataFrame, col: str, code: str = "code") -> DataFrame:
    """code -> name (the reverse lookup)."""
    return df.join(sent(codes.select(code, col), col), code, "left")


def sent(codes: DataFrame, col: str) -> DataFrame:
    """``codes``, a row a class, marked for broadcast if its names and rows measure at most ``SENT_BYTES``."""
    size = codes.agg(F.sum(F.coalesce(F.octet_length(F.col(col).cast("string")), F.lit(0)) + F.lit(64))).first()[0] or 0
    return F.broadcast(codes) if size <= SENT_BYTES else codes


def md5_bucket(col: str | Column, buckets: int = 10) -> Column:
    """Deterministic bucket in [0, buckets) from the md5 of the value."""
    c = F.col(col) if isinstance(col, str) else col
    head = F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("long")
    return head % F.lit(buckets)


def random_split(df: DataFrame, train: float = 0.6, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random train/test split (``randomSplit``): per-partition Bernoulli
    sampling, no shuffle. Reproducible only for the same input partitioning;
    ``split_part`` is the form that gives the same split on any layout."""
    a, b = df.randomSplit([train, 1.0 - train], seed=seed)
    return a, b


def split_part(col: str | Column, train_tenths: int = 6) -> Column:
    """'train' for md5 bucket < train_tenths of 10, else 'test' (60/40 by default)."""
    return F.when(md5_bucket(col) < train_tenths, F.lit("train")).otherwise(F.lit("test"))
