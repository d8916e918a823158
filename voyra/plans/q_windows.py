"""Queries for numbering and per-key windows.

Numbering uses ``number_by_id`` (per key and range of ids, plus offsets), which
equals ``row_number()`` but never sorts a whole key in one task.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voyra.operators import labels as L
from voyra.operators import reviews as R
from voyra.operators.numbering import number_by_id
from voyra.plans import entities as E
from voyra.plans import sql as S
from voyra.plans.registry import query
from voyra.sources import tables


@query("review_id", headline=True, sql=S.with_(S.REVIEWS) + """
SELECT attr_name, doc_id, review_id, attr_page FROM reviews""")
def review_id(spark, sf_dir):
    r = E.reviews(spark, sf_dir, with_lang=False)
    return r.select("attr_name", "doc_id", "review_id", "attr_page")


@query("batch_index", sql="""
SELECT lang, doc_id, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 10 AS batch
FROM documents""")
def batch_index(spark, sf_dir):
    """Ten records a batch, numbered per language in id order."""
    d = tables.documents(spark, sf_dir, "doc_id", "lang")
    n = number_by_id(d, ["lang"], "doc_id", out="seq")
    return n.select("lang", "doc_id", R.batch_index(n, "seq").alias("batch"))


@query("latest_per_key", sql="""
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, CAST(max(ts) AS VARCHAR) AS ts,
       arg_max(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY user_id""")
def latest_per_key(spark, sf_dir):
    """Last write per key wins (order: ts, then event_id)."""
    e = tables.events(spark, sf_dir, "user_id", "event_id", "ts", "event_type")
    last = R.latest_per_key(e, ["user_id"], ["ts", "event_id"])
    return last.select("user_id", "event_id", F.col("ts").cast("string").alias("ts"), "event_type")


@query("category_codes", sql=S.with_(S.CODES) + "SELECT name, code FROM codes")
def category_codes(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "source")
    c = L.category_codes(d, "source")
    return c.select(F.col("source").alias("name"), "code")


@query("page_cap", sql=S.with_(S.REVIEWS) + """
SELECT attr_name, doc_id, review_id FROM reviews WHERE review_id < 25""")
def page_cap(spark, sf_dir, k: int = 25):
    """First ``k`` reviews of each attraction in id order."""
    # row_number() <= k on the plain window: Spark keeps k rows a key in every task before the shuffle
    d = tables.documents(spark, sf_dir, "doc_id", "source")
    n = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    return d.withColumn("n", n).where(F.col("n") <= k).select(
        F.col("source").alias("attr_name"), "doc_id", (F.col("n") - 1).cast("long").alias("review_id"))
