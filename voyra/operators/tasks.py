"""Task state for resumable ingest: init, status, complete, pending, retry.

The task table is ``(attr_name, page, url, complete)``; the reference kept one
SQLite table per attraction, here it is one table of a versioned store
(``voyra.sinks.versions``), in hash buckets of its key: an update rewrites only the
buckets it touches, and is there as a whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voyra.operators.reviews import gen_page_urls
from voyra.sinks.versions import ConcurrentCommit, Merge, Store

TASKS = "tasks"
TASK_KEY = ["attr_name", "page"]


def init_tasks(seeds: DataFrame, total: str, url_of, size: int = 10, mode: str = "ceil") -> DataFrame:
    """Seeds (attr_name, total) -> every page as an open task."""
    pages = gen_page_urls(seeds, total, url_of, size, mode)
    return pages.withColumn("complete", F.lit(False))


def task_init(spark: SparkSession, seeds: DataFrame, total: str, url_of, path: str,
              size: int = 10) -> DataFrame:
    """Create and fill the task table only if it does not exist yet.

    It exists once its first version is published: what a run that died before that
    has written is not seen, and the table is initialised again."""
    store = Store(spark, path)
    if not store.has(TASKS):
        try:
            store.commit({TASKS: Merge(init_tasks(seeds, total, url_of, size))}, {TASKS: TASK_KEY})
        except ConcurrentCommit:
            if not store.has(TASKS):
                raise
    return store.read(TASKS)


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    return Store(spark, path).read(TASKS)


def page_status(attempts: DataFrame, order: str = "attempt") -> DataFrame:
    """Latest attempt per (attr_name, page) -> done, n_attempts, n_failed, last_ts.

    ``order`` is the attempt's sequence number (a long that follows ts, then
    event_id), so "latest" is ``max_by(.., order)``: one hash aggregate with
    fixed-width buffers, combined map-side, no join."""
    return attempts.groupBy("attr_name", "page").agg(
        (~F.max_by("failed", order)).alias("done"),
        F.count(F.lit(1)).alias("n_attempts"),
        F.count_if("failed").alias("n_failed"),
        F.max_by("ts", order).alias("last_ts"))


def task_complete(tasks: DataFrame, status: DataFrame) -> DataFrame:
    """Mark pages done whose latest attempt succeeded; others keep their flag."""
    s = status.select("attr_name", "page", "done")
    j = tasks.join(s, ["attr_name", "page"], "left")
    return j.select("attr_name", "page", "url",
                    (F.col("complete") | F.coalesce(F.col("done"), F.lit(False))).alias("complete"))


def completed(status: DataFrame) -> Merge:
    """The change that marks pages (attr_name, page, done) done; other pages keep their flag,
    and pages that are no task are left out."""
    def resolve(j: DataFrame) -> DataFrame:
        done = F.coalesce("old_complete", F.lit(False)) | F.coalesce("new_done", F.lit(False))
        return j.where("old_row").select("attr_name", "page", F.col("old_url").alias("url"), done.alias("complete"))
    return Merge(status.select("attr_name", "page", "done"), resolve)


def complete_pages(spark: SparkSession, status: DataFrame, path: str) -> DataFrame:
    """Mark the pages done whose latest attempt succeeded, as one new version of the
    persisted table, and read it back."""
    store = Store(spark, path)
    store.commit({TASKS: completed(status)})
    return store.read(TASKS)


def write_task_update(spark: SparkSession, tasks: DataFrame, path: str) -> DataFrame:
    """Put task rows into the persisted table (those of the same page are replaced) as
    one new version, and read it back."""
    store = Store(spark, path)
    store.commit({TASKS: Merge(tasks)}, {TASKS: TASK_KEY})
    return store.read(TASKS)


def scan_pending(tasks: DataFrame) -> DataFrame:
    """``SELECT page, url WHERE complete = 0`` (pushed down to the scan)."""
    return tasks.where(~F.col("complete")).select("attr_name", "page", "url")


def retry_queue(status: DataFrame) -> DataFrame:
    """Pages whose latest attempt failed, with the attempt counts."""
    return status.where(~F.col("done")).select("attr_name", "page", "n_attempts", "n_failed")


def run_of(ts: str = "ts"):
    """A run is one calendar day of attempts."""
    return F.to_date(F.col(ts))


def fetch_counts(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy(run_of().alias("run")).agg(
        F.count_if(~F.col("failed")).alias("n_success"), F.count_if("failed").alias("n_failed"))


def run_elapsed(attempts: DataFrame) -> DataFrame:
    g = attempts.groupBy(run_of().alias("run")).agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))
    micros = F.unix_micros(F.col("end_ts").cast("timestamp")) - F.unix_micros(F.col("start_ts").cast("timestamp"))
    return g.withColumn("elapsed_s", micros / F.lit(1e6))
