"""Queries for incremental ingest. Each runs a stream to
completion with the availableNow trigger and returns the read-back sink; the
oracle is the batch answer over the same table (stream = batch)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voyra.functions import html as H
from voyra.functions import urls as U
from voyra.operators import tasks as TK
from voyra.plans import entities as E
from voyra.plans import render
from voyra.plans import sql as S
from voyra.plans.q_extract import REVIEW_SLOTS_SQL, page_documents
from voyra.plans.q_scalar import TITLE_SQL
from voyra.plans.registry import query
from voyra.session import scratch_dir
from voyra.sinks import files as sinks
from voyra.sinks.versions import Store
from voyra.sources import tables
from voyra.streaming import ingest as ST


@query("stream_ingest", sql=f"""
SELECT page_id, {TITLE_SQL} AS title, CAST(len({S.links('html')}) AS INTEGER) AS n_links
FROM pages""")
def stream_ingest(spark, sf_dir):
    """pages (file stream) -> parse -> parquet sink."""
    s = ST.file_stream(spark, sf_dir, "pages")
    parsed = s.select("page_id", H.html_title("html").alias("title"),
                      F.size(H.html_links("html")).alias("n_links"))
    out, ckpt = scratch_dir(spark, "ingest-out"), scratch_dir(spark, "ingest-ckpt")
    ST.ingest(parsed, out, ckpt)
    return spark.read.schema("page_id BIGINT, title STRING, n_links INT").parquet(out)


@query("stream_drain", sql="SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_drain(spark, sf_dir):
    """Stateful running counts; the run stops once the input is drained."""
    s = ST.file_stream(spark, sf_dir, "events")
    store = Store(spark, scratch_dir(spark, "drain-out"))
    ST.drain_counts(s, ["event_type"], store, scratch_dir(spark, "drain-ckpt"))
    return store.read("counts").select("event_type", "n")


@query("stream_batches", sql="""
SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k, (row_number() OVER (ORDER BY doc_id) - 1) // 10 AS file_batch
FROM documents""")
def stream_batches(spark, sf_dir):
    """foreachBatch writer, at most ten records a file, keyed by a number that runs on
    over the batches. The backlog is one batch, whatever its number of files: files
    need not be in the order of their ids, and the numbers are."""
    s = ST.file_stream(spark, sf_dir, "documents", max_files=None).select("doc_id", "source", "text")
    out, ckpt = scratch_dir(spark, "batches-out"), scratch_dir(spark, "batches-ckpt")
    ST.batch_files(s, out, ckpt, order="doc_id", per_file=10, run_on=True)
    back = spark.read.schema("doc_id BIGINT, k BIGINT, batch_id BIGINT").json(out)
    return back.select("doc_id", "k", F.floor(F.col("k") / 10).cast("long").alias("file_batch"))


@query("stream_dedup", sql="SELECT DISTINCT sha1(url) AS fp FROM pages")
def stream_dedup(spark, sf_dir):
    """Every page requested twice (two producers); each fingerprint passes once."""
    a = ST.file_stream(spark, sf_dir, "pages").select(U.url_fingerprint("url").alias("fp"))
    b = ST.file_stream(spark, sf_dir, "pages").select(U.url_fingerprint("url").alias("fp"))
    d = ST.dedup(a.unionByName(b), "fp")
    out, ckpt = scratch_dir(spark, "dedup-out"), scratch_dir(spark, "dedup-ckpt")
    ST.ingest(d, out, ckpt)
    return spark.read.schema("fp STRING").parquet(out)


@query("stream_task_state", sql="""
SELECT 'attr' || CAST(user_id AS VARCHAR) AS task,
       NOT arg_max(event_type = 'error', (ts, event_id)) AS done,
       count(*) AS n_attempts, count(*) FILTER (WHERE event_type = 'error') AS n_failed,
       CAST(max(ts) AS VARCHAR) AS last_ts
FROM events GROUP BY user_id""")
def stream_task_state(spark, sf_dir):
    """Task state (task = attraction of the fetch log) maintained by a stream
    over two runs: the first half of the month, then the rest. The second run
    continues from the state in the checkpoint and upserts the touched tasks."""
    e = tables.events(spark, sf_dir, "event_id", "ts", "user_id", "event_type")
    landing = scratch_dir(spark, "task-landing")
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, step INT"
    store, ckpt = Store(spark, scratch_dir(spark, "task-state")), scratch_dir(spark, "task-state-ckpt")
    cut = F.to_timestamp(F.lit("2024-01-16 00:00:00"))

    def run():
        s = ST.file_stream(spark, landing, schema=schema).select(
            F.concat(F.lit("attr"), F.col("user_id").cast("string")).alias("task"), "ts", "event_id",
            (F.col("event_type") == "error").alias("failed"))
        ST.task_state(s, store, ckpt)
    sinks.write_parquet(e.where(F.col("ts") < cut), f"{landing}/step=1", dynamic=False)
    run()
    sinks.write_parquet(e.where(~(F.col("ts") < cut) | F.col("ts").isNull()), f"{landing}/step=2", dynamic=False)
    run()
    t = store.read("state")
    return t.select("task", "done", "n_attempts", "n_failed", F.col("last_ts").cast("string").alias("last_ts"))


@query("stream_resume", sql="SELECT event_id, user_id, event_type FROM events")
def stream_resume(spark, sf_dir):
    """Two runs over a landing folder that fills in two steps (first half of
    the month, then the rest): the second run picks up only the new files and
    the sink holds every event once."""
    e = tables.events(spark, sf_dir, "event_id", "ts", "user_id", "event_type")
    landing = scratch_dir(spark, "landing")
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING"
    out, ckpt = scratch_dir(spark, "resume-out"), scratch_dir(spark, "resume-ckpt")
    cut = F.to_timestamp(F.lit("2024-01-16 00:00:00"))
    sinks.write_parquet(e.where(F.col("ts") < cut), f"{landing}/step=1", dynamic=False)
    ST.ingest(ST.file_stream(spark, landing, schema=schema + ", step INT"), out, ckpt)
    sinks.write_parquet(e.where(~(F.col("ts") < cut) | F.col("ts").isNull()), f"{landing}/step=2", dynamic=False)
    ST.ingest(ST.file_stream(spark, landing, schema=schema + ", step INT"), out, ckpt)
    return spark.read.schema(schema).parquet(out).select("event_id", "user_id", "event_type")


@query("stream_pages", sql=REVIEW_SLOTS_SQL + f"""
SELECT attr_name, attr_page, count(*) AS n_reviews,
       md5(string_agg({S.clean("coalesce(title, 'NONE')")}, '|' ORDER BY review_id)) AS titles_md5,
       md5(string_agg({S.clean("replace(review, chr(10), '')")}, '|' ORDER BY review_id)) AS reviews_md5, true AS complete
FROM slots GROUP BY attr_name, attr_page""")
def stream_pages(spark, sf_dir):
    """Fetched review pages land in two steps; a stream takes them in, a run each: pages are
    cleaned, extracted and assembled to documents, which are committed with the marks of
    their tasks, one version a micro-batch. Documents and task marks read back together."""
    store, ckpt, landing = Store(spark, scratch_dir(spark, "site")), scratch_dir(spark, "site-ckpt"), scratch_dir(spark, "site-landing")
    seeds = tables.documents(spark, sf_dir, "source").groupBy(F.col("source").alias("attr_name")).agg(F.count(F.lit(1)).alias("n"))
    TK.task_init(spark, seeds, "n", E.review_page_url, store.path)
    pages = render.review_pages(spark, sf_dir).select("url", "html").withColumn("half", F.pmod(F.xxhash64("url"), F.lit(2)))
    sinks.write_parquet(pages, f"{landing}/all", dynamic=False)
    pages = spark.read.schema(pages.schema).parquet(f"{landing}/all")
    fetched = f"{landing}/fetched"
    for half in (0, 1):
        pages.where(F.col("half") == half).select("url", "html").write.parquet(f"{fetched}/step={half}")
        ST.pages_and_tasks(ST.file_stream(spark, fetched, schema="url STRING, html STRING, step INT"), store, ckpt, page_documents)
    docs, tasks = store.read("pages"), TK.read_tasks(spark, store.path)
    both = docs.join(tasks.withColumnRenamed("page", "attr_page"), ["attr_name", "attr_page"])
    values = F.map_values("attr_reviews")
    return both.select("attr_name", "attr_page", F.size(values).cast("long").alias("n_reviews"),
                       F.md5(F.array_join(F.transform(values, lambda v: v["title"]), "|")).alias("titles_md5"),
                       F.md5(F.array_join(F.transform(values, lambda v: v["review"]), "|")).alias("reviews_md5"), "complete")
