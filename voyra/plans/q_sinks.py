"""Queries for sinks and task state.

Each writes to a fresh folder under ``spark.checkpoint.dir`` and returns the
read-back frame, so the check covers the written files, not the plan.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from voyra.functions import urls as U
from voyra.operators import labels as L
from voyra.operators import reviews as R
from voyra.operators import tasks as TK
from voyra.operators.numbering import number_by_id
from voyra.plans import entities as E
from voyra.plans import sql as S
from voyra.plans.q_joins import TASKS_SQL
from voyra.plans.q_sources import review_page_documents
from voyra.plans.registry import query
from voyra.session import materialize, scratch_dir
from voyra.sinks import files as sinks
from voyra.sinks.seen import SeenSet
from voyra.sinks.versions import Merge, Store
from voyra.sources import files as src
from voyra.sources import tables


@query("sink_item_json", sql=S.with_(S.INFO) + """
SELECT attr_name, name, CAST(CAST(tenths / 10.0 AS DECIMAL(2,1)) AS VARCHAR) AS score,
       CAST(score_cnt AS VARCHAR) AS score_cnt FROM info""")
def sink_item_json(spark, sf_dir):
    """One JSON document per attraction, in hash-bucket folders of the name
    (a folder per attraction does not scale; each document keeps its name)."""
    from voyra.operators.items import build_attraction
    a = E.attraction_info(spark, sf_dir)
    items = a.select("attr_name", build_attraction().alias("attr_info"))
    path = sinks.write_json_by_key(items, scratch_dir(spark, "attr-info"), "attr_name")
    back = src.read_attractions(spark, path)
    return back.select("attr_name", "attr_info.name", "attr_info.score", "attr_info.score_cnt")


@query("sink_page_json", sql=S.with_(S.REVIEWS) + """
SELECT attr_name, CAST(attr_page AS BIGINT) AS attr_page, count(*) AS n_reviews FROM reviews
GROUP BY attr_name, attr_page""")
def sink_page_json(spark, sf_dir):
    """One document per (attraction, page) in hash-bucket folders of the
    attraction; ``max_records=1`` in ``write_json_by_key`` would give the
    crawler's one-file-per-page layout (many small files at scale)."""
    r = E.reviews(spark, sf_dir, with_lang=False).select(
        "attr_name", "attr_page", "review_id", "title", F.lit("NONE").alias("time"),
        F.lit("NONE").alias("type"), "review")
    pages = R.page_assemble(r)
    path = sinks.write_json_by_key(pages, scratch_dir(spark, "review-pages"), "attr_name")
    back = src.read_review_pages(spark, path)
    return back.select("attr_name", "attr_page", F.size("attr_reviews").cast("long").alias("n_reviews"))


@query("sink_batches", sql="""
SELECT k // 10 AS batch, count(*) AS n_records, min(k) AS first_key, max(k) AS last_key
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents)
GROUP BY 1""")
def sink_batches(spark, sf_dir):
    """Files of at most ten reviews each; key = batch * 10 + slot."""
    d = tables.documents(spark, sf_dir, "doc_id", "source", "text")
    n = number_by_id(d, [], "doc_id", out="k")
    n = n.withColumn("batch", R.batch_index(n, "k"))
    recs = n.select("batch", "k", "doc_id", F.struct(F.substring("text", 1, 40).alias("title"),
                                                     F.col("text").alias("review")).alias("r"))
    # range-partition on batch so each batch lands in one task; 10 per file
    recs = recs.repartitionByRange("batch").sortWithinPartitions("k")
    path = sinks.write_json(recs, scratch_dir(spark, "batches"), max_records=10)
    back = spark.read.schema("batch BIGINT, k BIGINT, doc_id BIGINT").json(path)
    return back.groupBy("batch").agg(F.count(F.lit(1)).alias("n_records"), F.min("k").alias("first_key"),
                                     F.max("k").alias("last_key"))


@query("sink_keyed_doc", sql="""
SELECT source AS attr_name, max(doc_id) AS doc_id, arg_max(n_chars, doc_id) AS n_chars FROM documents
GROUP BY source""")
def sink_keyed_doc(spark, sf_dir):
    """The run's items keyed by attraction, later item wins. Written as a keyed
    table (one document per key), not as one object holding the whole run."""
    d = tables.documents(spark, sf_dir, "doc_id", "source", "n_chars")
    last = R.latest_per_key(d.withColumnRenamed("source", "attr_name"), ["attr_name"], ["doc_id"])
    path = sinks.write_json(last, scratch_dir(spark, "keyed"))
    return spark.read.schema("attr_name STRING, doc_id BIGINT, n_chars BIGINT").json(path)


@query("sink_numbered", sql="SELECT row_number() OVER (ORDER BY doc_id) - 1 AS k, doc_id, source FROM documents")
def sink_numbered(spark, sf_dir):
    """The run numbered 0..n-1 in arrival order (doc_id), without a global
    single-partition window."""
    d = tables.documents(spark, sf_dir, "doc_id", "source")
    n = number_by_id(d, [], "doc_id", out="k")
    path = sinks.write_json(n.select("k", "doc_id", "source"), scratch_dir(spark, "numbered"))
    return spark.read.schema("k BIGINT, doc_id BIGINT, source STRING").json(path)


@query("sink_csv", sql=S.with_(S.LANG_CODES) + """
SELECT d.doc_id, md5(d.text) AS text_md5, CAST(c.code AS INTEGER) AS label
FROM documents d JOIN lang_codes c ON d.lang = c.name""")
def sink_csv(spark, sf_dir):
    """Training file ``text,label`` with a header, quotes and line breaks kept."""
    d = tables.documents(spark, sf_dir, "doc_id", "text", "lang")
    codes = L.category_codes(d, "lang")
    t = L.attach_codes(d, codes, "lang").select("doc_id", "text", F.col("code").cast("int").alias("label"))
    path = sinks.write_csv(t, scratch_dir(spark, "train-csv"))
    back = src.read_labelled_csv(spark, path, "doc_id BIGINT, text STRING, label INT")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "label")


def _seeds(spark, sf_dir):
    return E.attempt_totals(spark, sf_dir)


@query("task_init", sql=S.with_(TASKS_SQL) + "SELECT attr_name, page, url, false AS complete FROM tasks")
def task_init(spark, sf_dir):
    """Create the task table only if it does not exist; the second call keeps it."""
    path = scratch_dir(spark, "tasks")
    TK.task_init(spark, _seeds(spark, sf_dir), "n", E.review_page_url, path, size=E.ATTEMPTS_PER_PAGE)
    return TK.task_init(spark, _seeds(spark, sf_dir), "n", E.review_page_url, path, size=E.ATTEMPTS_PER_PAGE)


def _completed_table(spark, sf_dir):
    path = scratch_dir(spark, "tasks")
    TK.task_init(spark, _seeds(spark, sf_dir), "n", E.review_page_url, path, size=E.ATTEMPTS_PER_PAGE)
    return TK.complete_pages(spark, TK.page_status(E.attempts(spark, sf_dir)), path)


@query("task_complete", sql=S.with_(TASKS_SQL) + "SELECT attr_name, page, url, complete FROM tasks")
def task_complete(spark, sf_dir):
    return _completed_table(spark, sf_dir)


@query("scan_pending", sql=S.with_(TASKS_SQL) + "SELECT attr_name, page, url FROM tasks WHERE NOT complete")
def scan_pending(spark, sf_dir):
    """Open tasks read back from the persisted table (filter pushed to the scan)."""
    return TK.scan_pending(_completed_table(spark, sf_dir))


@query("retry_queue", sql=S.with_(S.ATTEMPTS) + """
SELECT attr_name, page, count(*) AS n_attempts, count(*) FILTER (WHERE failed) AS n_failed
FROM attempts GROUP BY attr_name, page HAVING arg_max(failed, (ts, event_id))""")
def retry_queue(spark, sf_dir):
    """Pages whose latest attempt failed, to be tried again, with counts."""
    return TK.retry_queue(TK.page_status(E.attempts(spark, sf_dir)))


@query("sink_append", sql="SELECT source AS attr_name, 2 * count(*) AS n FROM documents GROUP BY source")
def sink_append(spark, sf_dir):
    """Two runs append their review pages as indented objects back to back; all of
    them are read again."""
    path = scratch_dir(spark, "append")
    for _ in range(2):
        sinks.write_json_appended(review_page_documents(spark, sf_dir), path, "attr_name", "attr_page")
    back = src.read_review_pages(spark, path, layout="files", glob="part-*")
    return back.groupBy("attr_name").agg(F.sum(F.size("attr_reviews")).alias("n"))


@query("sink_upsert", sql="""
WITH v1 AS (SELECT source AS attr_name, count(*) AS n, 1 AS version FROM documents WHERE lang = 'en' GROUP BY source),
     v2 AS (SELECT source AS attr_name, count(*) AS n, 2 AS version FROM documents WHERE lang <> 'en' GROUP BY source)
SELECT attr_name, n, version FROM v2
UNION ALL SELECT attr_name, n, version FROM v1 WHERE attr_name NOT IN (SELECT attr_name FROM v2)""")
def sink_upsert(spark, sf_dir):
    """A second batch of per-attraction counts merged into the table of the first: one
    commit each, the later row of a key stays."""
    d = tables.documents(spark, sf_dir, "source", "lang")

    def counts(rows, version):
        return rows.groupBy(F.col("source").alias("attr_name")).agg(F.count(F.lit(1)).alias("n")) \
            .withColumn("version", F.lit(version))
    store = Store(spark, scratch_dir(spark, "upsert"))
    store.commit({"counts": Merge(counts(d.where(F.col("lang") == "en"), 1))}, {"counts": ["attr_name"]})
    store.commit({"counts": Merge(counts(d.where(F.col("lang") != "en"), 2))})
    return store.read("counts")


@query("write_counts", sql="""
SELECT count(*) FILTER (WHERE event_type <> 'error') AS kept, count(*) FILTER (WHERE event_type = 'error') AS failed,
       count(*) FILTER (WHERE user_id IS NULL OR ts IS NULL) AS quarantined, count(*) AS written
FROM events""")
def write_counts(spark, sf_dir):
    """Fetch attempts go to the folder of their outcome in two runs; the pass that writes them
    counts what was kept, failed and quarantined, and the runs' stored counts are added up."""
    e = tables.events(spark, sf_dir, "event_id", "ts", "user_id", "event_type")
    e = e.withColumn("failed", F.col("event_type") == "error")
    path = scratch_dir(spark, "counted")
    first = F.col("event_id") % 2 == 0
    for run in (e.where(first), e.where(~first | F.col("event_id").isNull())):
        sinks.write_counted(run, path, {"kept": ~F.col("failed"), "failed": F.col("failed"),
                                        "quarantined": F.col("user_id").isNull() | F.col("ts").isNull(), "written": F.lit(True)}, ["failed"])
    names = ("kept", "failed", "quarantined", "written")
    return sinks.read_counts(spark, path).agg(*[F.sum(c).cast("long").alias(c) for c in names])


@query("seen_set", sql="""
SELECT page_id, url, 0 AS left_over FROM pages
WHERE sha1(url) NOT IN (SELECT sha1(url) FROM pages WHERE url LIKE '%utm_source%')""")
def seen_set(spark, sf_dir):
    """Requests that a stored, bucketed set of fingerprints doesn't hold (it has those of the tracking
    links); once they are added, none is left over."""
    req = tables.pages(spark, sf_dir, "page_id", "url").withColumn("fp", U.url_fingerprint("url"))
    seen = SeenSet(spark, scratch_dir(spark, "seen-set"), buckets=8)
    seen.add(req.where(F.col("url").contains("utm_source")))
    new = materialize(seen.unseen(req))
    seen.add(new)
    left = seen.unseen(req).agg(F.count(F.lit(1))).scalar()
    return new.select("page_id", "url", left.cast("int").alias("left_over"))
