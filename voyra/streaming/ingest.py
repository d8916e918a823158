"""Incremental, resumable ingest with Structured Streaming.

The crawler's queues and "stop when the queue stays empty" loops become a
file-source stream run with ``trigger(availableNow=True)``: it processes
everything present when it starts, in bounded micro-batches, then stops.
Progress lives in the checkpoint folder, so a restart continues where the
last run stopped and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voyra.operators.tasks import TASKS, completed
from voyra.session import scratch_dir
from voyra.sinks.versions import Merge, Store
from voyra.sources.tables import SCHEMAS


MAX_FILES_PER_BATCH = 10_000


def file_stream(spark: SparkSession, directory: str, table: str | None = None,
                schema: str | None = None, max_files: int | None = MAX_FILES_PER_BATCH) -> DataFrame:
    """Parquet files arriving in ``directory``, or in its table ``{table}.parquet``
    (one file or a folder of part files) when a table is named. A backlog is taken in micro-batches of at most ``max_files`` files, so
    availableNow drains it in bounded steps rather than one giant batch."""
    r = spark.readStream.schema(schema or SCHEMAS[table])
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    # a pattern that only the table's path matches: a stream takes a single file by pattern alone
    return r.parquet(f"{directory.rstrip('/')}/{table}.parque[t]" if table else directory)


def run_available_now(writer):
    """Start with the availableNow trigger and wait until the input is drained, however long it takes."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def ingest(stream: DataFrame, out_path: str, checkpoint: str, partition_by: list[str] | None = None):
    """Append every micro-batch to a parquet table (exactly once via the
    file sink's commit log)."""
    w = stream.writeStream.format("parquet").option("path", out_path) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return run_available_now(w)


def _input_of(batch: DataFrame, batch_id: int) -> tuple[str, int]:
    """What a micro-batch is to a versioned store: its stream's id, which lives in the
    checkpoint, and its number. A replayed batch has both again."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), batch_id


def drain_counts(stream: DataFrame, keys: list[str], store: Store | str, checkpoint: str, table: str = "counts"):
    """Running counts per key kept in streaming state; each micro-batch merges the
    totals that it changed into ``table``, as one version."""
    store = Store.at(stream.sparkSession, store)
    agg = stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    def write(batch: DataFrame, batch_id: int):
        store.commit({table: Merge(batch)}, {table: keys}, batch=_input_of(batch, batch_id))

    w = agg.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_available_now(w)


def pages_and_tasks(stream: DataFrame, store: Store | str, checkpoint: str, parse: Callable[[DataFrame], DataFrame],
                    pages: str = "pages"):
    """Page documents and task state in one step: each micro-batch is parsed to documents
    (attr_name, attr_page, ...), and one version holds both the documents and the marks of
    their tasks. A run that dies before the version is published has done neither, one
    that dies after it finds the batch done: no page is lost, and none is there twice."""
    store = Store.at(stream.sparkSession, store)

    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        docs = parse(batch)
        staged = scratch_dir(spark, "parsed-pages")            # both merges read what was parsed once
        docs.write.parquet(staged)
        docs = spark.read.schema(docs.schema).parquet(staged)
        done = docs.select("attr_name", F.col("attr_page").alias("page"), F.lit(True).alias("done"))
        store.commit({pages: Merge(docs, stored=True), TASKS: completed(done)}, {pages: ["attr_name", "attr_page"]},
                     batch=_input_of(batch, batch_id))

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_available_now(w)


def batch_files(stream: DataFrame, out_path: str, checkpoint: str, order: str, per_file: int = 10,
                run_on: bool = False):
    """Micro-batch writer: each batch numbered in ``order``, key = running
    number within the batch, at most ``per_file`` records a file, one folder
    per batch id (so a replayed batch overwrites its own folder only).

    With ``run_on`` the number goes on from batch to batch: each batch's row count
    is kept in a table beside the checkpoint's own folders, one folder per batch
    id, and a batch starts at the sum of those before it. A replayed batch, which
    has the same rows, gets the same numbers again. Batches follow the files'
    arrival, so the numbers of several batches are in ``order`` only if the files are.
    """
    from voyra.operators.numbering import number_by_id

    counts = f"{checkpoint.rstrip('/')}/batch_counts"

    def first_number(batch: DataFrame, batch_id: int) -> int:
        spark = batch.sparkSession
        size = spark.range(1).select(F.lit(batch.count()).cast("long").alias("n_rows"))
        size.coalesce(1).write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}")
        sizes = spark.read.schema("n_rows BIGINT, batch_id BIGINT").parquet(counts)
        return sizes.where(F.col("batch_id") < batch_id).agg(F.sum("n_rows")).first()[0] or 0

    def write(batch: DataFrame, batch_id: int):
        n = number_by_id(batch, [], order, out="k")
        if run_on:
            n = n.withColumn("k", F.col("k") + F.lit(first_number(batch, batch_id)).cast("long"))
        n = n.withColumn("batch_id", F.lit(batch_id).cast("long"))
        n.repartitionByRange(F.floor(F.col("k") / per_file)).sortWithinPartitions("k") \
            .write.mode("overwrite").option("maxRecordsPerFile", per_file) \
            .json(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_available_now(w)


def task_state(stream: DataFrame, store: Store | str, checkpoint: str, table: str = "state"):
    """Per task, the status of its latest attempt and its attempt counts,
    kept in streaming state and merged into a table after every batch.

    ``stream``: (task, ts, event_id, failed). The aggregate runs in update
    mode, so a batch emits only the tasks it touched, with their absolute
    totals (not deltas); the merge rewrites just the hash buckets those tasks
    live in and publishes one version. A replayed batch is known by its
    number and changes nothing.
    """
    store = Store.at(stream.sparkSession, store)
    agg = stream.groupBy("task").agg(
        F.max(F.struct("ts", "event_id", "failed")).alias("last"),
        F.count(F.lit(1)).alias("n_attempts"),
        F.count_if("failed").alias("n_failed"))

    def upsert(batch: DataFrame, batch_id: int):
        upd = batch.select("task", (~F.col("last.failed")).alias("done"), "n_attempts", "n_failed",
                           F.col("last.ts").alias("last_ts"))
        store.commit({table: Merge(upd)}, {table: ["task"]}, batch=_input_of(batch, batch_id))

    w = agg.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return run_available_now(w)


def dedup(stream: DataFrame, key: str, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Drop requests already seen, across runs (the seen set is the state in
    the checkpoint). With ``event_time`` the state is bounded: a key is
    remembered for ``delay`` past the watermark (``dropDuplicatesWithinWatermark``)."""
    if event_time is None:
        return stream.dropDuplicates([key])
    if dict(stream.dtypes).get(event_time) == "timestamp_ntz":
        # watermarks need TIMESTAMP; the session zone is pinned to UTC
        stream = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
