"""Queries for record building, projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voyra.functions import html as H
from voyra.functions import text as X
from voyra.operators import items
from voyra.operators import labels as L
from voyra.operators import reviews as R
from voyra.plans import entities as E
from voyra.plans import sql as S
from voyra.plans.registry import query
from voyra.sources import tables

H1_OR_NULL_SQL = S.title("html")


@query("build_attraction", sql=S.with_(S.INFO) + """
SELECT attr_name, name, array_to_string(labels, '&') AS labels, array_to_string(location, ', ') AS location,
       CAST(CAST(tenths / 10.0 AS DECIMAL(2,1)) AS VARCHAR) AS score, score_cnt,
       'short=' || CAST(n_short AS VARCHAR) || ';long=' || CAST(n_long AS VARCHAR) AS experiences,
       near_resta || '|' || near_attra AS nearby
FROM info""")
def build_attraction(spark, sf_dir):
    a = E.attraction_info(spark, sf_dir)
    rec = a.select("attr_name", items.build_attraction().alias("attr_info"))
    i = F.col("attr_info")
    exp = F.array_join(F.transform(F.map_entries(i["experiences"]),
                                   lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";")
    return rec.select(
        "attr_name", i["name"].alias("name"), F.array_join(i["labels"], "&").alias("labels"),
        F.array_join(i["location"], ", ").alias("location"), i["score"].cast("string").alias("score"),
        i["score_cnt"].alias("score_cnt"), exp.alias("experiences"),
        F.concat_ws("|", F.array_join(i["nearby"]["near_restas"], ","),
                    F.array_join(i["nearby"]["near_attras"], ",")).alias("nearby"))


@query("build_review", sql=S.with_(S.REVIEWS) + """
SELECT attr_name, review_id, title, 'NONE' AS time, 'NONE' AS type, md5(review) AS review_md5 FROM reviews""")
def build_review(spark, sf_dir):
    r = E.reviews(spark, sf_dir, with_lang=False)
    rec = R.build_review("title", R.fill_missing(F.lit(None).cast("string")),
                         R.fill_missing(F.lit(None).cast("string")), "review")
    out = r.select("attr_name", "review_id", rec.alias("r"))
    return out.select("attr_name", "review_id", "r.title", "r.time", "r.type",
                      F.md5("r.review").alias("review_md5"))


@query("item_project", sql=S.with_(S.REVIEWS) + """
SELECT attr_name, CAST(attr_page AS BIGINT) AS attr_page, CAST(review_id AS BIGINT) AS review_id,
       title, CAST(NULL AS VARCHAR) AS visit_month, CAST(NULL AS VARCHAR) AS companion, md5(review) AS review_md5
FROM reviews""")
def item_project(spark, sf_dir):
    r = E.reviews(spark, sf_dir)  # carries doc_id and lang, which the item does not declare
    r = r.withColumn("visit_month", F.lit(None)).withColumn("companion", F.lit(None))
    flat = items.item_project(r, items.FLAT_REVIEW, extra="drop")
    return flat.select("attr_name", "attr_page", "review_id", "title",
                       F.col("visit_month").cast("string").alias("visit_month"), "companion",
                       F.md5("review").alias("review_md5"))


ROUTE_SQL = """CASE role WHEN 'user' THEN 'review' WHEN 'assistant' THEN 'info' ELSE 'other' END"""


@query("route_by_type", sql=f"SELECT conv_id, turn, {ROUTE_SQL} AS route FROM conversations")
def route_by_type(spark, sf_dir):
    """Every record to the sink of its kind, in one pass (a folder per kind),
    read back with the kind from the folder name."""
    from voyra.session import scratch_dir
    from voyra.sinks.files import write_routed
    c = tables.conversations(spark, sf_dir, "conv_id", "turn", "role")
    tagged = c.select("conv_id", "turn", items.kind_of("role").alias("route"))
    path = write_routed(tagged, "route", scratch_dir(spark, "routed"))
    back = spark.read.schema("conv_id BIGINT, turn BIGINT, route STRING").json(path)
    return back.select("conv_id", "turn", "route")


@query("filter_eq_first", sql=S.with_(S.LANG_CODES) + """
SELECT c.code AS target, arg_min(d.source, d.doc_id) AS first_output
FROM documents d JOIN lang_codes c ON d.lang = c.name GROUP BY c.code""")
def filter_eq_first(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "source", "lang")
    codes = L.category_codes(d, "lang")
    # Set-based form of "rows of class k, then the first name", for all k at once:
    # the first id per class is a hash aggregate (map-side combined); codes and
    # names come from joins with that K-row table.
    first = L.attach_codes(d.groupBy("lang").agg(F.min("doc_id").alias("doc_id")), codes, "lang")
    return first.select("doc_id", F.col("code").alias("target")).join(d.select("doc_id", "source"), "doc_id").select(
        "target", F.col("source").alias("first_output"))


@query("fill_missing", sql=f"SELECT page_id, coalesce({H1_OR_NULL_SQL}, 'NONE') AS title FROM pages")
def fill_missing(spark, sf_dir):
    p = tables.pages(spark, sf_dir, "page_id", "html")
    return p.select("page_id", R.fill_missing(H.html_title("html")).alias("title"))


@query("stop_at_missing", sql=S.with_(S.REVIEWS) + """,
slots AS (SELECT r.attr_name, r.attr_page, r.review_id, r.review_id % 10 AS slot,
                 CASE WHEN d.n_chars >= 200 THEN r.title END AS title
          FROM reviews r JOIN documents d USING (doc_id)),
firsts AS (SELECT attr_name, attr_page, min(slot) AS first_missing FROM slots WHERE title IS NULL
           GROUP BY attr_name, attr_page)
SELECT s.attr_name, s.attr_page, s.review_id, s.slot
FROM slots s LEFT JOIN firsts f USING (attr_name, attr_page)
WHERE f.first_missing IS NULL OR s.slot < f.first_missing""")
def stop_at_missing(spark, sf_dir):
    """Short reviews (< 200 characters) carry no title; a page stops there."""
    r = E.reviews(spark, sf_dir, with_lang=False, extra=("n_chars",))
    s = r.select(
        "attr_name", "attr_page", "review_id", (F.col("review_id") % 10).alias("slot"),
        F.when(F.col("n_chars") >= 200, F.col("title")).alias("title"))
    kept = R.stop_at_missing(s, ["attr_name", "attr_page"], "slot", "title")
    return kept.select("attr_name", "attr_page", "review_id", "slot")


@query("slot_limit", sql="""
SELECT doc_id, len(s) AS n_slots, md5(array_to_string(s, chr(10))) AS slots_md5
FROM (SELECT doc_id, string_split(text, chr(10))[1:10] AS s FROM documents)""")
def slot_limit(spark, sf_dir):
    """At most ten slots: the first ten lines of each text."""
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    s = F.slice(F.split("text", "\n"), 1, 10)
    return d.select("doc_id", F.size(s).cast("long").alias("n_slots"),
                    F.md5(F.array_join(s, "\n")).alias("slots_md5"))


@query("range_slice", sql=f"""
SELECT page_id, array_to_string({S.links('html')}[16:20], '|') AS links
FROM pages""")
def range_slice(spark, sf_dir):
    """Links 15..19 (0-based) of each page."""
    p = tables.pages(spark, sf_dir, "page_id", "html")
    return p.select("page_id", F.array_join(F.slice(H.html_links("html"), 16, 5), "|").alias("links"))


@query("empty_guard", sql=f"""
SELECT page_id, url FROM (SELECT page_id, url, {H1_OR_NULL_SQL} AS t FROM pages)
WHERE t IS NULL OR t = ''""")
def empty_guard(spark, sf_dir):
    """Pages whose name is empty go to quarantine."""
    p = tables.pages(spark, sf_dir, "page_id", "url", "html")
    t = p.select("page_id", "url", H.html_title("html").alias("t"))
    return t.where(F.col("t").isNull() | (F.col("t") == "")).select("page_id", "url")


@query("page_quarantine", sql=S.with_(S.ATTEMPTS, S.VISITS) + """
SELECT attr_name, page, count(*) AS n_records, count(*) FILTER (WHERE bad) AS n_bad,
       CASE WHEN count(*) FILTER (WHERE bad) > 0 THEN 'bad' ELSE 'good' END AS status
FROM (SELECT a.attr_name, a.page,
             p[1] = 'NONE' OR try_strptime(p[1], '%b %Y') IS NULL OR len(p) > 2 AS bad
      FROM attempts a JOIN visits v USING (event_id),
           LATERAL (SELECT string_split(replace(v.visit, ' • ', '  '), '  ') AS p))
GROUP BY attr_name, page""")
def page_quarantine(spark, sf_dir):
    """A record whose visit month does not parse, or whose visit string has
    more than two parts, fails its whole page."""
    a = E.attempts(spark, sf_dir).select("attr_name", "page", "event_id")
    v = E.visit_strings(spark, sf_dir)
    sv = X.split_visit("visit")
    rec = a.join(v, "event_id").select(
        "attr_name", "page", (X.visit_month(sv["time"]).isNull() | sv["extra"]).alias("bad"))
    return items.quarantine_pages(rec, ["attr_name", "page"], "bad")


@query("shape_cols", sql=S.with_(S.LANG_CODES) + """
SELECT d.doc_id, md5(d.text) AS input_md5, d.source AS output, CAST(c.code AS INTEGER) AS target
FROM documents d JOIN lang_codes c ON d.lang = c.name""")
def shape_cols(spark, sf_dir):
    d = tables.documents(spark, sf_dir)
    codes = L.category_codes(d, "lang")
    shaped = (d.drop("n_chars")
              .withColumnsRenamed({"text": "input", "source": "output"})
              .transform(lambda x: L.attach_codes(x, codes, "lang"))
              .withColumn("target", F.col("code").cast(T.IntegerType()))
              .select("doc_id", "input", "output", "target"))
    return shaped.select("doc_id", F.md5("input").alias("input_md5"), "output", "target")
