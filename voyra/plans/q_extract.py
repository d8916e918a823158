"""Queries for record extraction from markup.

The markup is rendered from the tables (voyra.plans.render), extracted with
``mapInPandas`` and typed with Spark expressions; the oracle is plain SQL over
the source tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from voyra.functions import html as H
from voyra.functions import text as X
from voyra.functions import urls as U
from voyra.operators import extract as XT
from voyra.operators import frontier as FR
from voyra.operators import reviews as R
from voyra.operators import threads as TH
from voyra.plans import entities as E
from voyra.plans import render
from voyra.plans import sql as S
from voyra.plans.registry import query


def typed_attraction(raw):
    """Raw extracted fields -> the typed attraction record."""
    return raw.select(
        "attr_name",
        F.col("name"),
        F.concat(X.split_labels("labels_text"), F.col("extra_labels")).alias("labels"),
        "location",
        F.col("score").try_cast("decimal(2,1)").alias("score"),
        X.to_int(X.digits_only("score_cnt")).alias("score_cnt"),
        F.map_from_arrays("exp_names", "exp_lists").alias("experiences"),
        F.struct("near_restas", "near_attras").alias("nearby"),
    )


@query("html_attraction", sql=S.with_(S.INFO) + """
SELECT attr_name, name, array_to_string(labels, '&') || '&reviews ' || CAST(score_cnt AS VARCHAR) AS labels,
       array_to_string(location, ', ') AS location,
       CAST(CAST(tenths / 10.0 AS DECIMAL(2,1)) AS VARCHAR) AS score, score_cnt,
       'short=' || CAST(n_short AS VARCHAR) || ';long=' || CAST(n_long AS VARCHAR) AS experiences,
       near_resta || '|' || near_attra AS nearby
FROM info""")
def html_attraction(spark, sf_dir):
    pages = render.attraction_pages(spark, sf_dir)
    a = typed_attraction(XT.extract_attractions(pages, "html", ["attr_name"]))
    exp = F.array_join(F.transform(F.map_entries("experiences"),
                                   lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";")
    return a.select("attr_name", "name", F.array_join("labels", "&").alias("labels"),
                    F.array_join("location", ", ").alias("location"), F.col("score").cast("string").alias("score"),
                    "score_cnt", exp.alias("experiences"),
                    F.concat_ws("|", F.array_join("nearby.near_restas", ","),
                                F.array_join("nearby.near_attras", ",")).alias("nearby"))


def typed_reviews(raw, on_missing: str = "fill"):
    """Extracted slots -> flat reviews. ``on_missing='fill'`` writes NONE for a
    missing title; ``'stop'`` ends the page at its first slot without one."""
    r = raw.withColumn("title", F.when(F.col("title") != "", F.col("title")))
    if on_missing == "stop":
        from voyra.operators.reviews import stop_at_missing
        r = stop_at_missing(r, ["attr_name", "attr_page"], "slot", "title")
    v = X.split_visit("time")
    return r.select(
        "attr_name", "attr_page",
        (F.col("attr_page") * 10 + F.col("slot")).cast("long").alias("review_id"),
        X.or_sentinel("title").alias("title"),
        v["time"].alias("time"), v["type"].alias("type"), X.visit_month(v["time"]).alias("visit_month"),
        F.array_join("fragments", "").alias("review"),
    )


REVIEW_SLOTS_SQL = S.with_(S.REVIEWS, S.VISITS) + """,
slots AS (
  SELECT r.attr_name, r.attr_page, r.review_id, CASE WHEN d.n_chars >= 200 THEN r.title END AS title,
         CASE WHEN v.visit <> 'NONE' THEN v.visit END AS visit, r.review
  FROM reviews r JOIN documents d USING (doc_id) LEFT JOIN visits v ON v.event_id = r.doc_id),
parts AS (SELECT *, string_split(replace(visit, ' • ', '  '), '  ') AS p FROM slots)
"""


@query("html_reviews", headline=True, sql=REVIEW_SLOTS_SQL + """
SELECT attr_name, CAST(attr_page AS BIGINT) AS attr_page, CAST(review_id AS BIGINT) AS review_id,
       coalesce(title, 'NONE') AS title, p[1] AS time,
       CASE WHEN len(p) >= 2 THEN array_to_string(p[2:], '  ') END AS type,
       CAST(CAST(try_strptime(p[1], '%b %Y') AS DATE) AS VARCHAR) AS visit_month,
       md5(replace(review, chr(10), '')) AS review_md5
FROM parts""")
def html_reviews(spark, sf_dir):
    pages = render.review_pages(spark, sf_dir)
    raw = XT.extract_reviews(pages, "html", ["attr_name", "attr_page"])
    t = typed_reviews(raw)
    return t.select("attr_name", "attr_page", "review_id", "title", "time", "type",
                    F.col("visit_month").cast("string").alias("visit_month"),
                    F.md5("review").alias("review_md5"))


@query("html_page_total", sql=S.with_(S.REVIEWS) + """
SELECT r.attr_name, CAST(r.attr_page AS BIGINT) AS attr_page, CAST(t.total AS BIGINT) AS total
FROM (SELECT DISTINCT attr_name, attr_page FROM reviews) r
JOIN (SELECT attr_name, count(*) AS total FROM reviews GROUP BY attr_name) t USING (attr_name)""")
def html_page_total(spark, sf_dir):
    pages = render.review_page_heads(spark, sf_dir)
    return pages.select("attr_name", "attr_page",
                        H.html_page_total("html").alias("total"))


@query("html_forum", sql=S.with_(S.POSTS) + """
SELECT conv_id, page AS page_no, 'Thread ' || CAST(conv_id AS VARCHAR) AS topic,
       'Page ' || CAST(page + 1 AS VARCHAR) AS page_label,
       CAST(row_number() OVER (PARTITION BY conv_id, page ORDER BY turn) - 1 AS INTEGER) AS post_no,
       CASE WHEN username <> 'system' THEN username END AS username, posttime,
       md5(text) AS text_md5,
       CASE WHEN page < max(page) OVER (PARTITION BY conv_id)
            THEN '/forum/thread-' || CAST(conv_id AS VARCHAR) || '-page-' || CAST(page + 2 AS VARCHAR) || '.html'
       END AS next
FROM posts""")
def html_forum(spark, sf_dir):
    pages = render.forum_pages(spark, sf_dir).withColumnRenamed("page", "page_no")
    f = XT.extract_forum(pages, "html", ["conv_id", "page_no"])
    return f.select("conv_id", "page_no", F.col("topic"), F.col("page").alias("page_label"), "post_no",
                    "username", "posttime", F.md5(F.array_join("posttext", "\n")).alias("text_md5"), "next")


NEXT_HREF = r'<a class="next" href="([^"]*)"'


@query("next_page_chain", sql=S.with_(S.POSTS) + """
SELECT DISTINCT conv_id, page, page AS depth FROM posts""")
def next_page_chain(spark, sf_dir):
    """Follow each thread's next-page links from its first page."""
    pages = render.forum_page_feet(spark, sf_dir)
    href = F.regexp_extract("html", NEXT_HREF, 1)
    nxt = F.regexp_extract(href, r"-page-(\d+)\.html$", 1).try_cast("long") - 1
    edges = pages.select("conv_id", "page", F.when(href != "", nxt).alias("next_page"))
    return TH.follow_chain(spark, edges)


# ---------------------------------------------------------------- the walk over the site

SITE = FR.Site(
    patterns=(("region", r"/Region-oa\d+\.html$"), ("review_page", r"-Reviews-or\d+-"), ("attraction", r"-Reviews-"),
              ("forum_index", r"/forum/index-\d+\.html$"), ("thread", r"/forum/thread-\d+-page-\d+\.html$")),
    leads={"region": ("region", "attraction"), "attraction": ("review_page",), "forum_index": ("forum_index", "thread"),
           "thread": ("thread",)},
    names=("attraction", "thread_topic"))


def site_links(spark, sf_dir):
    """Typed links of the region's, the forum's and the threads' pages, and the review pages that an
    attraction's own page counts (they are generated from its total, as crawlers do)."""
    forum = render.forum_pages(spark, sf_dir).select(F.concat(F.lit(E.SITE), "url").alias("url"), "html")
    pages = render.region_pages(spark, sf_dir).unionByName(render.forum_index_pages(spark, sf_dir)).unionByName(forum)
    attractions = render.attraction_pages(spark, sf_dir)
    total = X.comma_int(F.regexp_extract("html", r'class="score-count">([0-9,]+) reviews', 1))
    seeds = attractions.select("attr_name", render.attraction_url(F.col("attr_name")).alias("from_url"), total.alias("n"))
    listed = R.gen_page_urls(seeds, "n", E.review_page_url, keep=["from_url"])
    listed = listed.select("from_url", F.col("url").alias("to_url"), F.lit("review_page").alias("kind"), F.lit("").alias("label"))
    links = FR.typed_links(pages, SITE)
    # a thread's topic is what the index calls it; its next pages are called "Next"
    topic = (F.col("kind") == "thread") & SITE.kind(F.col("from_url")).isin("forum_index")
    return links.withColumn("kind", F.when(topic, "thread_topic").otherwise(F.col("kind"))).unionByName(listed)


@query("frontier_walk", sql=S.with_(S.REVIEWS, S.POSTS, S.CODES) + f"""
, threads AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS n FROM (SELECT DISTINCT conv_id FROM posts)),
indexes AS (SELECT DISTINCT n // {render.INDEX_SIZE} AS i, CAST(ceil((n // {render.INDEX_SIZE}) / {render.INDEX_AHEAD}.0) AS BIGINT) AS d FROM threads),
names AS (SELECT name, code, code // {render.LISTING_SIZE} AS listing FROM codes),
urls AS (
  SELECT name, '{E.SITE}{E.REVIEW_PATH}' || regexp_extract(name, '(\\d+)$', 1) || '-Reviews-' AS head, listing FROM names),
thread_pages AS (SELECT DISTINCT conv_id, page FROM posts)
SELECT '{E.SITE}/Region-oa' || CAST(listing AS VARCHAR) || '.html' AS url, 'region' AS kind, listing AS depth,
  CASE WHEN listing > 0 THEN '{E.SITE}/Region-oa' || CAST(listing - 1 AS VARCHAR) || '.html' END AS parent, NULL AS context
FROM (SELECT DISTINCT listing FROM names)
UNION ALL
SELECT head || name || '.html', 'attraction', listing + 1, '{E.SITE}/Region-oa' || CAST(listing AS VARCHAR) || '.html', name FROM urls
UNION ALL
SELECT head || 'or' || CAST(attr_page * 10 AS VARCHAR) || '-' || name || '.html', 'review_page', listing + 2, head || name || '.html', name
FROM urls JOIN (SELECT DISTINCT attr_name, attr_page FROM reviews) r ON r.attr_name = name
UNION ALL
SELECT '{E.SITE}/forum/index-' || CAST(a.i AS VARCHAR) || '.html', 'forum_index', a.d,
  (SELECT min('{E.SITE}/forum/index-' || CAST(b.i AS VARCHAR) || '.html') FROM indexes b
   WHERE b.i < a.i AND b.i >= a.i - {render.INDEX_AHEAD} AND b.d = a.d - 1), NULL
FROM indexes a
UNION ALL
SELECT '{E.SITE}/forum/thread-' || CAST(p.conv_id AS VARCHAR) || '-page-' || CAST(p.page + 1 AS VARCHAR) || '.html', 'thread',
  i.d + 1 + p.page,
  CASE WHEN p.page = 0 THEN '{E.SITE}/forum/index-' || CAST(i.i AS VARCHAR) || '.html'
       ELSE '{E.SITE}/forum/thread-' || CAST(p.conv_id AS VARCHAR) || '-page-' || CAST(p.page AS VARCHAR) || '.html' END,
  'Thread ' || CAST(p.conv_id AS VARCHAR)
FROM thread_pages p JOIN threads t USING (conv_id) JOIN indexes i ON i.i = t.n // {render.INDEX_SIZE}
""".replace("'-Reviews-' AS head", "'-Reviews' AS head").replace("head || name || '.html'", "head || '-' || name || '.html'")
       .replace("head || 'or'", "head || '-or'"))
def frontier_walk(spark, sf_dir):
    """Every page that can be reached from the region's and the forum's first page, with its
    depth, the page it was found on, and the attraction or thread it belongs to."""
    roots = spark.createDataFrame([(f"{E.SITE}/Region-oa0.html",), (f"{E.SITE}/forum/index-0.html",)], "url string")
    found = FR.walk(spark, site_links(spark, sf_dir), roots, SITE)
    kind = F.when(F.col("kind") == "thread_topic", "thread").otherwise(F.col("kind"))
    return found.select("url", kind.alias("kind"), "depth", "parent", "context")


@query("forum_index_links", sql=S.with_(S.POSTS) + f"""
SELECT '{E.SITE}/forum/index-' || CAST((row_number() OVER (ORDER BY conv_id) - 1) // {render.INDEX_SIZE} AS VARCHAR) || '.html' AS index_url,
  '{E.SITE}/forum/thread-' || CAST(conv_id AS VARCHAR) || '-page-1.html' AS thread_url, 'Thread ' || CAST(conv_id AS VARCHAR) AS topic
FROM (SELECT DISTINCT conv_id FROM posts)""")
def forum_index_links(spark, sf_dir):
    """The thread links of the forum's index pages."""
    links = FR.typed_links(render.forum_index_pages(spark, sf_dir), SITE).where("kind = 'thread'")
    return links.select(F.col("from_url").alias("index_url"), F.col("to_url").alias("thread_url"), F.col("label").alias("topic"))


# ---------------------------------------------------------------- clean, extract, sink, complete

def page_documents(pages):
    """Review pages (url, html) -> page documents, cleaned: the name as it may be a key, number from the URL."""
    named = pages.select(X.safe_name(H.html_title("html")).alias("attr_name"), U.url_page_no("url").alias("attr_page"), "html")
    t = typed_reviews(XT.extract_reviews(named, "html", ["attr_name", "attr_page"]))
    return R.page_assemble(t.withColumns({c: X.clean_text(c) for c in ("title", "review")}))
