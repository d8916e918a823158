"""Queries for aggregations. All grouped aggregates here combine
map-side before the shuffle, so a hot key costs one partial row per task."""

from __future__ import annotations

from pyspark.sql import functions as F

from voyra.operators import items
from voyra.operators import profile as P
from voyra.operators import reviews as R
from voyra.operators import sketches as SK
from voyra.operators import tasks as TK
from voyra.operators import threads as TH
from voyra.plans import entities as E
from voyra.plans import sql as S
from voyra.plans.registry import query
from voyra.session import materialize, scratch_dir
from voyra.sources import tables


def _describe_sql(col):
    return f"""
SELECT '{col}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
       arg_min(v, (-n, v)) AS top, max(n) AS freq
FROM (SELECT {col} AS v, count(*) AS n FROM documents WHERE {col} IS NOT NULL GROUP BY {col})"""


@query("describe_cat", sql=_describe_sql("source") + "\nUNION ALL" + _describe_sql("lang"))
def describe_cat(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "source", "lang")
    return P.describe(d, "source").unionByName(P.describe(d, "lang"))


@query("nunique", sql="""
SELECT count(DISTINCT source) AS n_sources, count(DISTINCT lang) AS n_classes,
       count(DISTINCT text) AS n_texts FROM documents""")
def nunique(spark, sf_dir):
    """Distinct counts; texts are counted by their SHA-256 digest, so the
    distinct shuffle moves 32 bytes a row instead of whole texts."""
    d = tables.documents(spark, sf_dir, "source", "lang", "text")
    counts = P.distinct_counts(d, ["source", "lang", "text"], digest=("text",))
    return counts.select(F.col("source").alias("n_sources"), F.col("lang").alias("n_classes"),
                         F.col("text").alias("n_texts"))


@query("unique_list", sql="SELECT source AS value, min(doc_id) AS first_seen FROM documents GROUP BY source")
def unique_list(spark, sf_dir):
    """Distinct values with the id where each first appears (first-seen order)."""
    d = tables.documents(spark, sf_dir, "doc_id", "source")
    return d.groupBy(F.col("source").alias("value")).agg(F.min("doc_id").alias("first_seen"))


@query("item_counts", sql="""
SELECT CASE role WHEN 'user' THEN 'review' WHEN 'assistant' THEN 'info' ELSE 'other' END AS kind,
       count(*) AS n_items, count(DISTINCT conv_id) AS n_threads
FROM conversations GROUP BY 1""")
def item_counts(spark, sf_dir):
    c = tables.conversations(spark, sf_dir, "conv_id", "role")
    return c.groupBy(items.kind_of("role").alias("kind")).agg(
        F.count(F.lit(1)).alias("n_items"), F.count_distinct("conv_id").alias("n_threads"))


@query("fetch_counts", sql="""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run, count(*) FILTER (WHERE event_type <> 'error') AS n_success,
       count(*) FILTER (WHERE event_type = 'error') AS n_failed
FROM events GROUP BY 1""")
def fetch_counts(spark, sf_dir):
    e = tables.events(spark, sf_dir, "ts", "event_type")
    out = TK.fetch_counts(e.select("ts", (F.col("event_type") == "error").alias("failed")))
    return out.select(F.col("run").cast("string").alias("run"), "n_success", "n_failed")


@query("run_elapsed", sql="""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run, CAST(min(ts) AS VARCHAR) AS start_ts,
       CAST(max(ts) AS VARCHAR) AS end_ts,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS elapsed_s
FROM events GROUP BY 1""")
def run_elapsed(spark, sf_dir):
    e = tables.events(spark, sf_dir, "ts")
    out = TK.run_elapsed(e)
    return out.select(F.col("run").cast("string").alias("run"), F.col("start_ts").cast("string").alias("start_ts"),
                      F.col("end_ts").cast("string").alias("end_ts"), F.round("elapsed_s", 6).alias("elapsed_s"))


@query("page_assemble", sql=S.with_(S.REVIEWS) + """
SELECT attr_name, CAST(attr_page AS BIGINT) AS attr_page, count(*) AS n_reviews,
       string_agg(CAST(review_id AS VARCHAR), ',' ORDER BY review_id) AS ids,
       md5(string_agg(title, '|' ORDER BY review_id)) AS titles_md5
FROM reviews GROUP BY attr_name, attr_page""")
def page_assemble(spark, sf_dir):
    r = E.reviews(spark, sf_dir, with_lang=False).select(
        "attr_name", "attr_page", "review_id", "title", F.lit(None).cast("string").alias("time"),
        F.lit(None).cast("string").alias("type"), "review")
    p = R.page_assemble(r)
    vals = F.map_values("attr_reviews")
    return p.select("attr_name", "attr_page", F.size("attr_reviews").cast("long").alias("n_reviews"),
                    F.array_join(F.map_keys("attr_reviews"), ",").alias("ids"),
                    F.md5(F.array_join(F.transform(vals, lambda v: v["title"]), "|")).alias("titles_md5"))


@query("body_concat", sql=S.with_(S.POSTS) + """
SELECT conv_id, page, md5(string_agg(text, '' ORDER BY turn)) AS body_md5,
       CAST(sum(length(text)) AS BIGINT) AS body_chars
FROM posts GROUP BY conv_id, page""")
def body_concat(spark, sf_dir):
    b = TH.body_concat(E.posts(spark, sf_dir))
    return b.select("conv_id", "page", F.md5("body").alias("body_md5"),
                    F.length("body").cast("long").alias("body_chars"))


THREAD_SQL = S.with_(S.POSTS) + """,
pages AS (
  SELECT conv_id, page, min(turn) AS first_turn, count(*) AS n_posts FROM posts GROUP BY conv_id, page)
"""


@query("thread_assemble", sql=THREAD_SQL + """
SELECT g.conv_id, 'Thread ' || CAST(g.conv_id AS VARCHAR) AS topic, 'Page ' || CAST(g.page + 1 AS VARCHAR) AS page,
       f.username AS first_user, f.posttime AS first_time, len(string_split(f.text, chr(10))) AS first_paragraphs,
       md5(f.text) AS first_md5, g.n_posts - 1 AS n_replies
FROM pages g JOIN posts f ON f.conv_id = g.conv_id AND f.turn = g.first_turn""")
def thread_assemble(spark, sf_dir):
    t = TH.thread_assemble(E.posts(spark, sf_dir))
    fp = F.col("firstpost")
    return t.select("conv_id", "topic", "page", fp["username"].alias("first_user"),
                    fp["posttime"].alias("first_time"), F.size(fp["posttext"]).cast("long").alias("first_paragraphs"),
                    F.md5(F.array_join(fp["posttext"], "\n")).alias("first_md5"),
                    F.size("replypost").cast("long").alias("n_replies"))


@query("tail_slice", sql=THREAD_SQL + """
SELECT p.conv_id, p.page AS page_no, string_agg(p.username || '@' || p.posttime, ',' ORDER BY p.turn) AS replies
FROM posts p JOIN pages g ON p.conv_id = g.conv_id AND p.page = g.page
WHERE p.turn > g.first_turn GROUP BY p.conv_id, p.page""")
def tail_slice(spark, sf_dir):
    """All posts of a thread page but the first."""
    t = TH.thread_assemble(E.posts(spark, sf_dir))
    rep = F.array_join(F.transform("replypost", lambda r: F.concat(r["username"], F.lit("@"), r["posttime"])), ",")
    return t.where(F.size("replypost") > 0).select("conv_id", "page_no", rep.alias("replies"))


@query("page_totals", sql="""
SELECT 'attr' || CAST(user_id AS VARCHAR) AS attr_name, count(*) AS n_items,
       (count(*) + 9) // 10 AS n_pages, count(*) // 10 AS n_pages_floor
FROM events GROUP BY user_id""")
def page_totals(spark, sf_dir):
    """Per attraction: total attempts logged and the pages they cover."""
    e = tables.events(spark, sf_dir, "user_id")
    g = e.groupBy(F.concat(F.lit("attr"), F.col("user_id").cast("string")).alias("attr_name")) \
        .agg(F.count(F.lit(1)).alias("n_items"))
    from voyra.functions.text import page_count
    return g.select("attr_name", "n_items", page_count("n_items", 10, "ceil").alias("n_pages"),
                    page_count("n_items", 10, "floor").alias("n_pages_floor"))


def _days_sql(by):
    day = "CAST(CAST(ts AS DATE) AS VARCHAR)" if by else "'all'"
    group = "GROUP BY 1" if by else ""
    return f"""
SELECT {day} AS day, count(*) AS n, arg_min(top, (-freq, top)) AS top, max(freq) AS freq, true AS close_enough
FROM (SELECT ts, event_type AS top, count(*) OVER (PARTITION BY {day}, event_type) AS freq FROM events) {group}"""


@query("describe_days", sql=_days_sql(True) + " UNION ALL " + _days_sql(False))
def describe_days(spark, sf_dir):
    """Rows, most frequent event type and its count of every day and of all days, from sketches stored
    a day each (the last day is added by itself), and whether the estimated number of
    users is within three standard errors of the exact one."""
    e = tables.events(spark, sf_dir, "ts", "user_id", "event_type").withColumn("on_day", F.to_date("ts"))
    path = scratch_dir(spark, "day-sketches")
    last = e.agg(F.max("on_day")).first()[0]
    for part in (e.where(F.col("on_day") < F.lit(last)), e.where(F.col("on_day") == F.lit(last))):
        SK.add_days(SK.day_sketches(part, F.col("on_day"), "user_id", "event_type"), path)
    days = materialize(SK.read_days(spark, path).withColumn("day", F.col("day").cast("string")))
    got = SK.merged(days, ["day"]).unionByName(SK.merged(days).withColumn("day", F.lit("all")))
    exact = e.groupBy(F.col("on_day").cast("string").alias("day")).agg(F.count_distinct("user_id").alias("users"))
    exact = exact.unionByName(e.agg(F.count_distinct("user_id").alias("users")).withColumn("day", F.lit("all")))
    # of equally frequent types the smaller name
    top = F.get(F.array_sort(F.transform("top", lambda t: F.struct((-t["count"]).alias("less"), t["item"].alias("item")))), 0)
    close = F.abs(F.col("n_distinct") - F.col("users")) <= 3 * SK.standard_error() * F.col("users") + 1
    return got.join(exact, "day").select("day", "n", top["item"].alias("top"), (-top["less"]).cast("long").alias("freq"), close.alias("close_enough"))
