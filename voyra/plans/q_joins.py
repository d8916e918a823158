"""Queries for joins.

No join carries a broadcast hint. Dimension-like sides (code tables, per
attraction aggregates) are broadcast by AQE only when their measured size is
under ``spark.sql.autoBroadcastJoinThreshold``; beyond it the plan stays a
sort-merge join and AQE's skew rule splits a hot key's partition.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from voyra.functions import html as H
from voyra.functions import urls as U
from voyra.operators import labels as L
from voyra.operators import reviews as R
from voyra.operators import tasks as TK
from voyra.plans import entities as E
from voyra.plans import sql as S
from voyra.plans.q_sources import _page_url_sql
from voyra.plans.registry import query
from voyra.session import materialize
from voyra.sources import tables


@query("label_lookup", sql=S.with_(S.CODES) + """
SELECT d.doc_id, c.code AS target, c.name AS output_name
FROM documents d JOIN codes c ON d.source = c.name""")
def label_lookup(spark, sf_dir):
    """name -> code (mapNI) on every row, then code -> name (mapIN) back."""
    d = tables.documents(spark, sf_dir, "doc_id", "source")
    codes = materialize(L.category_codes(d, "source"))   # one row per class, used twice
    coded = L.attach_codes(d, codes, "source").select("doc_id", F.col("code").alias("target"))
    back = L.attach_names(coded.withColumnRenamed("target", "code"), codes, "source")
    return back.select("doc_id", F.col("code").alias("target"), F.col("source").alias("output_name"))


def _fetched_review_pages(spark, sf_dir):
    """Fetched child pages: (url, n_reviews), the URL computed from the page."""
    r = E.reviews(spark, sf_dir, with_lang=False)
    g = r.groupBy("attr_name", "attr_page").agg(F.count(F.lit(1)).alias("n_reviews"))
    return g.select(E.review_page_url(F.col("attr_name"), F.col("attr_page")).alias("url"), "n_reviews")


PAGE_LIST_SQL = f"""page_list AS (
  SELECT attr_name, page, {_page_url_sql('attr_name', 'page')} AS url
  FROM (SELECT source AS attr_name, unnest(range(0, (count(*) + 9) // 10)) AS page
        FROM documents GROUP BY source))"""


@query("parent_context", sql=S.with_(S.REVIEWS, PAGE_LIST_SQL) + """
SELECT p.attr_name, p.page, count(*) AS n_reviews
FROM page_list p JOIN reviews r ON r.attr_name = p.attr_name AND r.attr_page = p.page
GROUP BY p.attr_name, p.page""")
def parent_context(spark, sf_dir):
    """Carry attraction and page number from the generated URL table to the
    fetched child page by an equi-join on url."""
    seeds = tables.documents(spark, sf_dir, "source").groupBy(F.col("source").alias("attr_name")) \
        .agg(F.count(F.lit(1)).alias("n"))
    parents = R.gen_page_urls(seeds, "n", E.review_page_url)
    children = _fetched_review_pages(spark, sf_dir)
    return parents.join(children, "url").select("attr_name", "page", "n_reviews")


def _attraction_url(attr):
    return F.concat(F.lit(E.SITE + E.REVIEW_PATH), F.regexp_extract(attr, r"(\d+)$", 1),
                    F.lit(f"-{U.PAGE_SLOT}-"), attr, F.lit(".html"))


@query("link_fanout", sql=S.with_(S.CODES, PAGE_LIST_SQL) + """
SELECT c.code // 30 AS listing, p.attr_name, p.page, p.url
FROM codes c JOIN page_list p ON p.attr_name = c.name""")
def link_fanout(spark, sf_dir):
    """Listing pages (30 attraction links each) -> attraction pages -> review pages.

    The listing markup is rendered from the attraction table, its links are
    extracted and exploded, joined to the attraction pages by URL, and each
    attraction fans out to its review-page URLs.
    """
    d = tables.documents(spark, sf_dir, "source")
    codes = L.category_codes(d, "source")
    listing = codes.select((F.floor(F.col("code") / 30)).cast("long").alias("listing"),
                           F.col("code"), F.col("source").alias("attr_name"))
    # one <a> per attraction; a listing holds at most 30, so the array is bounded
    html = listing.groupBy("listing").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("code", "attr_name"))),
        lambda e: F.concat(F.lit('<li><a href="'), F.regexp_replace(_attraction_url(e["attr_name"]),
                                                                   F.lit(E.SITE), F.lit("")),
                           F.lit('">'), H.html_escape(e["attr_name"]), F.lit("</a></li>"))), "").alias("html"))
    links = html.select("listing", F.explode(H.html_links("html")).alias("href"))
    links = links.select("listing", U.abs_url("href", E.SITE).alias("attr_url"))
    seeds = d.groupBy(F.col("source").alias("attr_name")).agg(F.count(F.lit(1)).alias("n"))
    attractions = seeds.select("attr_name", "n", _attraction_url(F.col("attr_name")).alias("attr_url"))
    hit = links.join(attractions, "attr_url").select("listing", "attr_name", "n")
    pages = R.gen_page_urls(hit, "n", E.review_page_url, keep=["listing"])
    return pages.select("listing", "attr_name", "page", "url")


@query("unseen", sql="""
SELECT page_id, url FROM pages
WHERE sha1(url) NOT IN (SELECT sha1(url) FROM pages WHERE url LIKE '%utm_source%')""")
def unseen(spark, sf_dir, dont_filter: bool = False):
    """Requests whose fingerprint is not in the seen set. The seen set here is
    the tracking-link pages already fetched. ``dont_filter`` bypasses it."""
    p = tables.pages(spark, sf_dir, "page_id", "url")
    req = p.withColumn("fp", U.url_fingerprint("url"))
    if dont_filter:
        return req.select("page_id", "url")
    seen = p.where(F.col("url").contains("utm_source")).select(U.url_fingerprint("url").alias("fp"))
    return req.join(seen, "fp", "left_anti").select("page_id", "url")


@query("label_coverage", sql=S.with_(S.SPLIT) + """
SELECT DISTINCT label FROM split WHERE part = 'test'
EXCEPT SELECT DISTINCT label FROM split WHERE part = 'train'""")
def label_coverage(spark, sf_dir):
    """Test labels that never occur in train (expected: none)."""
    d = E.labelled(spark, sf_dir).withColumn("part", L.split_part("doc_id"))
    test = d.where(F.col("part") == "test").select("label").distinct()
    train = d.where(F.col("part") == "train").select("label").distinct()
    return test.join(train, "label", "left_anti")


@query("info_reviews", sql=S.with_(S.REVIEWS, S.INFO) + """
SELECT r.attr_name, r.review_id, CAST(CAST(i.tenths / 10.0 AS DECIMAL(2,1)) AS VARCHAR) AS score,
       i.score_cnt
FROM reviews r LEFT JOIN info i ON r.attr_name = i.attr_name""")
def info_reviews(spark, sf_dir):
    """Each review with its attraction's info (left join on attr_name)."""
    r = E.reviews(spark, sf_dir, with_lang=False).select("attr_name", "review_id")
    i = E.attraction_info(spark, sf_dir).select("attr_name", "score", "score_cnt")
    j = r.join(i, "attr_name", "left")
    return j.select("attr_name", "review_id", F.col("score").cast("string").alias("score"), "score_cnt")


TASKS_SQL = S.ATTEMPTS + """,
last AS (SELECT attr_name, page, arg_max(failed, (ts, event_id)) AS last_failed
         FROM attempts GROUP BY attr_name, page),
tasks AS (
  SELECT attr_name, page,
         '""" + E.SITE + E.REVIEW_PATH + """' || regexp_extract(attr_name, '(\\d+)$', 1)
           || '-Reviews-or' || CAST(page * 10 AS VARCHAR) || '-' || attr_name || '.html' AS url,
         NOT last_failed AS complete
  FROM last)"""


@query("pending_semi", sql=S.with_(TASKS_SQL) + """
SELECT attr_name, page, url FROM tasks WHERE NOT complete""")
def pending_semi(spark, sf_dir):
    """Only the pages whose task is still open: the generated page list, left
    semi join the open tasks read from the persisted task table (the filter
    on ``complete`` is pushed into that scan)."""
    from voyra.plans.q_sinks import _completed_table
    pages = TK.init_tasks(E.attempt_totals(spark, sf_dir), "n", E.review_page_url, size=E.ATTEMPTS_PER_PAGE)
    pending = TK.scan_pending(_completed_table(spark, sf_dir)).select("attr_name", "page")
    return pages.join(pending, ["attr_name", "page"], "left_semi").select("attr_name", "page", "url")
