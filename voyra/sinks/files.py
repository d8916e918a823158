"""Sinks. Each writes with the DataFrame writer and returns the path.

Overwrites are per partition (``partitionOverwriteMode=dynamic``), so a
re-run that reprocesses some attractions replaces exactly their folders and a
retried task or a lost executor never leaves a half-written page: Spark's
commit protocol publishes a task's files only when the task succeeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voyra.sources.files import CSV_OPTIONS


def _writer(df: DataFrame, mode: str, partition_by: list[str] | None, max_records: int | None):
    if partition_by:
        # Rebalance on the partition columns: few files per folder, and AQE
        # splits a hot folder (one attraction with a third of the rows) over
        # several tasks instead of one.
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    return w


def _save(df: DataFrame, mode: str, partition_by: list[str] | None, max_records: int | None, dynamic: bool):
    w = _writer(df, mode, partition_by, max_records)
    return w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: list[str] | None = None, max_records: int | None = None,
               dynamic: bool = True) -> str:
    """JSON lines. With ``dynamic`` only the partitions present in ``df`` are replaced."""
    _save(df, mode, partition_by, max_records, dynamic).json(path)
    return path


APPENDED_ROWS = 256


def write_json_appended(df: DataFrame, path: str, key: str, order: str, per_row: int = 8,
                        max_records: int | None = None) -> str:
    """Appends indented documents, those of a key one straight after the other, as a
    crawler that reopens its file does. ``order`` (whole numbers from 0 within the key) puts
    ``per_row`` neighbours into one line-wise record, so no key is gathered whole;
    ``read_documents`` takes the files apart again. A file ends after ``max_records`` records
    (``APPENDED_ROWS`` without it), as its reader holds it whole."""
    doc = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"pretty": "true"})
    rows = df.select(F.col(f"`{key}`").alias("k"), F.floor(F.col(f"`{order}`") / per_row).alias("part"),
                     F.col(f"`{order}`").alias("o"), doc.alias("doc"))
    rows = rows.groupBy("k", "part").agg(F.array_sort(F.collect_list(F.struct("o", "doc"))).alias("docs"))
    w = rows.select(F.array_join(F.transform("docs", lambda d: d["doc"]), "").alias("value")).write.mode("append")
    w.option("maxRecordsPerFile", max_records or APPENDED_ROWS).text(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, dynamic: bool = True) -> str:
    _save(df, mode, partition_by, None, dynamic).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("multiLine", "mode")}
    df.write.mode(mode).options(**opts).csv(path)
    return path


KEY_BUCKETS = 256


def key_bucket(col: str, buckets: int = KEY_BUCKETS):
    """Folder bucket of a high-cardinality key (one folder per attraction
    does not scale to millions of attractions; a fixed number of hash
    buckets does, and each document keeps its key)."""
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


def write_json_by_key(df: DataFrame, path: str, key: str, buckets: int = KEY_BUCKETS,
                      max_records: int | None = None) -> str:
    """Documents grouped in ``buckets`` folders by a hash of ``key``; only the
    buckets present are replaced. ``max_records=1`` gives one file per
    document (the crawler's exact layout; many small files at scale)."""
    return write_json(df.withColumn("key_bucket", key_bucket(key, buckets)), path,
                      partition_by=["key_bucket"], max_records=max_records)


def write_routed(df: DataFrame, kind_col: str, path: str) -> str:
    """Every record to the folder of its kind in one pass over the data
    (instead of one filtered write per kind)."""
    return write_json(df, path, partition_by=[kind_col])


def write_counted(df: DataFrame, path: str, counts: dict[str, Column], partition_by: list[str] | None = None) -> dict[str, int]:
    """Appends ``df`` as JSON lines and counts while it writes: for each name the rows for which the
    condition holds. The counts come from the writing pass (no second scan), and are
    appended to ``<path>_counts`` once the rows are published; they are returned, too."""
    spark = df.sparkSession
    seen = Observation()
    rows = df.observe(seen, *[F.count_if(c).alias(k) for k, c in counts.items()])
    _writer(rows, "append", partition_by, None).json(path)
    got = {k: seen.get[k] for k in counts}
    one = spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in got.items()])
    one.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}_counts")
    return got


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of every run that ``write_counted`` appended to ``path``."""
    return spark.read.parquet(f"{path.rstrip('/')}_counts")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", props: dict | None = None) -> None:
    """Database sink through Spark's JDBC writer (the reference's commented-out
    database writes). Upserts are computed first (union + latest per key);
    not exercised here: no database server runs in this environment."""
    df.write.mode(mode).jdbc(url, table, properties=props or {})


def write_fingerprints(df: DataFrame, path: str, col: str = "fp", mode: str = "append") -> str:
    """One digest per line, appended like the crawler's seen file."""
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)
    return path
