"""Queries for scans and sources and the flagship page query."""

from __future__ import annotations

from pyspark.sql import functions as F

from voyra.functions import html as H
from voyra.functions import text as X
from voyra.functions import urls as U
from voyra.operators import reviews as R
from voyra.plans import entities as E
from voyra.plans import sql as S
from voyra.plans.registry import query
from voyra.session import scratch_dir
from voyra.sinks import files as sinks
from voyra.sources import files as src
from voyra.sources import tables

# ---------------------------------------------------------------- flagship

HOST_SQL = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]+)', 1)"
H1_SQL = r"regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"


def page_link_stats_df(spark, sf_dir):
    p = tables.pages(spark, sf_dir, "url", "html")
    # Clean the extracted field, not the whole page: same result, far less work.
    title = F.trim(X.clean_text(H.strip_tags(F.regexp_extract("html", H.H1, 1))))
    title = F.when(F.col("html").rlike(H.H1), title)
    per_page = p.select(U.url_host("url").alias("host"), title.alias("title"),
                        F.size(H.html_links("html")).alias("n_links"))
    return per_page.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum("n_links").cast("long").alias("n_links"),
        F.count("title").alias("n_titled"),
        F.sum(F.length("title")).cast("long").alias("title_chars"),
    )


query("page_link_stats", headline=True, sql=f"""
SELECT {HOST_SQL} AS host, count(*) AS n_pages,
       CAST(sum(len({S.links('html')})) AS BIGINT) AS n_links,
       count(title) AS n_titled, CAST(sum(length(title)) AS BIGINT) AS title_chars
FROM (SELECT url, html,
             CASE WHEN regexp_matches(html, '(?s)<h1[^>]*>(.*?)</h1>')
                  THEN trim({S.clean(f"regexp_replace({H1_SQL}, '<[^>]*>', '', 'g')")}) END AS title
      FROM pages)
GROUP BY 1""")(page_link_stats_df)


# ---------------------------------------------------------------- scans

@query("scan_pages", sql="SELECT page_id, url, md5(html) AS html_md5, length(html) AS html_chars FROM pages")
def scan_pages(spark, sf_dir):
    p = tables.pages(spark, sf_dir)
    return p.select("page_id", "url", F.md5("html").alias("html_md5"),
                    F.length("html").cast("long").alias("html_chars"))


def review_page_documents(spark, sf_dir):
    """Review pages assembled from documents."""
    r = E.reviews(spark, sf_dir, with_lang=False)
    r = r.select("attr_name", "attr_page", "review_id", "title",
                 F.lit(None).cast("string").alias("time"),
                 F.lit(None).cast("string").alias("type"), "review")
    return R.page_assemble(r)


@query("scan_review_json", sql=S.with_(S.REVIEWS) + """
SELECT attr_name, CAST(attr_page AS BIGINT) AS attr_page, count(*) AS n_reviews,
       CAST(min(review_id) AS BIGINT) AS first_id, CAST(max(review_id) AS BIGINT) AS last_id
FROM reviews GROUP BY attr_name, attr_page""")
def scan_review_json(spark, sf_dir):
    """Files in which indented documents follow each other without a separator, taken
    apart and read."""
    path = sinks.write_json_appended(review_page_documents(spark, sf_dir), scratch_dir(spark, "review-files"),
                                     "attr_name", "attr_page")
    pages = src.read_review_pages(spark, path, layout="files", glob="part-*")
    keys = F.transform(F.map_keys("attr_reviews"), lambda k: k.try_cast("long"))
    return pages.select("attr_name", "attr_page",
                        F.size("attr_reviews").cast("long").alias("n_reviews"),
                        F.array_min(keys).alias("first_id"), F.array_max(keys).alias("last_id"))


@query("explode_reviews", sql=S.with_(S.REVIEWS) + """
SELECT attr_name, CAST(attr_page AS BIGINT) AS attr_page, CAST(review_id AS BIGINT) AS review_id,
       title, md5(review) AS review_md5
FROM reviews""")
def explode_reviews(spark, sf_dir):
    path = sinks.write_json(review_page_documents(spark, sf_dir), scratch_dir(spark, "review-pages"))
    e = R.explode_reviews(src.read_review_pages(spark, path))
    return e.select("attr_name", "attr_page", "review_id", "title", F.md5("review").alias("review_md5"))


@query("scan_csv", sql="""
SELECT doc_id, md5(text) AS input_md5, length(text) AS input_chars, source AS output
FROM documents""")
def scan_csv(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "text", "source")
    out = d.select("doc_id", F.col("text").alias("input"), F.col("source").alias("output"),
                   F.lit(None).cast("int").alias("target"))
    path = sinks.write_csv(out, scratch_dir(spark, "labelled-csv"))
    back = src.read_labelled_csv(spark, path)
    return back.select("doc_id", F.md5("input").alias("input_md5"),
                       F.length("input").cast("long").alias("input_chars"), "output")


def _page_url_sql(attr, page):
    return (f"'{E.SITE}{E.REVIEW_PATH}' || regexp_extract({attr}, '(\\d+)$', 1)"
            f" || '-Reviews-or' || CAST({page} * 10 AS VARCHAR) || '-' || {attr} || '.html'")


@query("gen_page_urls", sql=f"""
SELECT attr_name, page, {_page_url_sql('attr_name', 'page')} AS url
FROM (SELECT source AS attr_name, unnest(range(0, (count(*) + 9) // 10)) AS page
      FROM documents GROUP BY source)""")
def gen_page_urls(spark, sf_dir):
    seeds = tables.documents(spark, sf_dir, "source").groupBy(F.col("source").alias("attr_name")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return R.gen_page_urls(seeds, "n", E.review_page_url, size=10, mode="ceil")


@query("scan_seen", sql="SELECT sha1(url) AS fp FROM pages")
def scan_seen(spark, sf_dir):
    p = tables.pages(spark, sf_dir, "url")
    path = sinks.write_fingerprints(p.select(U.url_fingerprint("url").alias("fp")),
                                    scratch_dir(spark, "seen"))
    return src.read_fingerprints(spark, path)
