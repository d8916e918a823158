"""Queries for set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from voyra.functions import html as H
from voyra.functions import urls as U
from voyra.operators import labels as L
from voyra.operators import reviews as R
from voyra.plans import entities as E
from voyra.plans import sql as S
from voyra.plans.q_scalar import LINKS_SQL, SCHEME_HOST_SQL
from voyra.plans.registry import query
from voyra.sources import tables


@query("labels_concat", sql=f"""
SELECT page_id, len(l) AS n_labels, array_to_string(l, '&') AS labels
FROM (SELECT page_id, list_concat(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#:]+)', 1), '.'),
                                  {S.links('html')}) AS l FROM pages)""")
def labels_concat(spark, sf_dir):
    """Host labels followed by the extra link list; duplicates kept."""
    p = tables.pages(spark, sf_dir, "page_id", "url", "html")
    l = F.concat(F.split(U.url_host("url"), r"\."), H.html_links("html"))
    return p.select("page_id", F.size(l).cast("long").alias("n_labels"), F.array_join(l, "&").alias("labels"))


@query("union_producers", sql=S.with_(S.REVIEWS, S.POSTS) + """
SELECT 'review' AS kind, doc_id AS id, attr_name AS source, NULL::BIGINT AS conv_id, md5(review) AS text_md5 FROM reviews
UNION ALL
SELECT 'post' AS kind, turn AS id, NULL AS source, conv_id, md5(text) AS text_md5 FROM posts
UNION ALL
SELECT 'page' AS kind, page_id AS id, url AS source, NULL::BIGINT AS conv_id, md5(html) AS text_md5 FROM pages""")
def union_producers(spark, sf_dir):
    """Three producers into one collection, missing columns as NULL."""
    r = tables.documents(spark, sf_dir, "doc_id", "source", "text").select(
        F.lit("review").alias("kind"), F.col("doc_id").alias("id"), "source", F.md5("text").alias("text_md5"))
    p = E.posts(spark, sf_dir).select(F.lit("post").alias("kind"), F.col("turn").alias("id"), "conv_id",
                                     F.md5("text").alias("text_md5"))
    g = tables.pages(spark, sf_dir).select(F.lit("page").alias("kind"), F.col("page_id").alias("id"),
                                          F.col("url").alias("source"), F.md5("html").alias("text_md5"))
    return r.unionByName(p, allowMissingColumns=True).unionByName(g, allowMissingColumns=True)


@query("dedup_requests", sql=S.with_(LINKS_SQL) + f""",
req AS (
  SELECT page_id, -1 AS pos, url AS req_url FROM pages
  UNION ALL
  SELECT page_id, pos, CASE WHEN starts_with(href, '/') AND NOT starts_with(href, '//')
                            THEN {SCHEME_HOST_SQL} || href ELSE href END FROM links)
SELECT sha1(req_url) AS fp, arg_min(req_url, (page_id, pos)) AS url,
       CAST(arg_min(page_id, (page_id, pos)) AS BIGINT) AS first_page_id
FROM req GROUP BY sha1(req_url)""")
def dedup_requests(spark, sf_dir):
    """Every page URL and every absolute link is a request; each distinct
    fingerprint is kept once, at its first (page_id, position)."""
    p = tables.pages(spark, sf_dir, "page_id", "url", "html")
    # the page and its links leave one scan as one list
    base = F.regexp_extract("url", U.SCHEME_HOST, 1)
    listed = p.select("page_id", "url", base.alias("base"), F.coalesce(H.html_links("html"), F.array().cast("array<string>")).alias("links"))
    every = F.concat(F.array("url"), F.transform("links", lambda h: U.abs_url(h, F.col("base"))))
    req = listed.select("page_id", F.explode(every).alias("req_url")).withColumn("fp", U.url_fingerprint("req_url"))
    # the fingerprint fixes the URL, so both are keys and the buffer is one long: a hash aggregate
    first = req.groupBy("fp", "req_url").agg(F.min("page_id").alias("first_page_id"))
    return first.select("fp", F.col("req_url").alias("url"), "first_page_id")


@query("dedup_reviews", headline=True, sql=S.with_(S.REVIEWS) + """
SELECT attr_name, title, min(review_id) AS review_id, arg_min(doc_id, review_id) AS doc_id, md5(review) AS review_md5
FROM reviews GROUP BY attr_name, title, review""")
def dedup_reviews(spark, sf_dir):
    """One row per distinct (attraction, title, body), the lowest id kept.

    The body takes part as its SHA-256 digest (with its md5 for the output,
    a function of the body): the dedup shuffle moves ~100 bytes a row, not
    whole texts."""
    r = E.reviews(spark, sf_dir, with_lang=False, digest_only=True).select(
        "attr_name", "title", "review_id", "doc_id", "attr_page", "review_key", "review_md5")
    d = R.dedup_reviews(r, keys=("attr_name", "title", "review_key", "review_md5"))
    return d.select("attr_name", "title", "review_id", "doc_id", "review_md5")


@query("train_test_split", sql=S.with_(S.SPLIT) + "SELECT doc_id, label, part FROM split")
def train_test_split(spark, sf_dir):
    """60/40 split by an md5 bucket of the id: deterministic, re-runnable."""
    d = E.labelled(spark, sf_dir)
    return d.select("doc_id", "label", L.split_part("doc_id").alias("part"))
