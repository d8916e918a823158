"""Queries for scalar functions: text, URL and simple HTML fields.

Each is a projection over a whole table; everything stays in codegen.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from voyra.functions import html as H
from voyra.functions import text as X
from voyra.functions import urls as U
from voyra.operators import reviews as R
from voyra.plans import entities as E
from voyra.plans import sql as S
from voyra.plans.q_sources import _page_url_sql
from voyra.plans.registry import query
from voyra.sources import tables

MARKERS_SQL = "'<!--red_beg-->|<!--red_end-->|<em>|</em>'"


@query("strip_markers", sql=f"""
SELECT page_id, md5(regexp_replace(html, {MARKERS_SQL}, '', 'g')) AS html_md5,
       length(regexp_replace(html, {MARKERS_SQL}, '', 'g')) AS html_chars FROM pages""")
def strip_markers(spark, sf_dir):
    p = tables.pages(spark, sf_dir, "page_id", "html")
    s = X.strip_markers("html")
    return p.select("page_id", F.md5(s).alias("html_md5"), F.length(s).cast("long").alias("html_chars"))


@query("demojize", sql=f"""
SELECT doc_id, md5({S.demojize('text')}) AS text_md5, length({S.demojize('text')}) AS text_chars
FROM documents""")
def demojize(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    s = X.demojize("text")
    return d.select("doc_id", F.md5(s).alias("text_md5"), F.length(s).cast("long").alias("text_chars"))


@query("ascii_filter", sql="""
SELECT doc_id, md5(regexp_replace(text, '[^ -~]', '', 'g')) AS text_md5,
       length(regexp_replace(text, '[^ -~]', '', 'g')) AS text_chars FROM documents""")
def ascii_filter(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    s = X.ascii_filter("text")
    return d.select("doc_id", F.md5(s).alias("text_md5"), F.length(s).cast("long").alias("text_chars"))


@query("clean_text", sql=f"""
SELECT page_id, md5({S.clean('html')}) AS html_md5, length({S.clean('html')}) AS html_chars
FROM pages""")
def clean_text(spark, sf_dir):
    p = tables.pages(spark, sf_dir, "page_id", "html")
    s = X.clean_text("html")
    return p.select("page_id", F.md5(s).alias("html_md5"), F.length(s).cast("long").alias("html_chars"))


@query("safe_name", sql="""
SELECT doc_id, translate(text, '''/,?:*<>|"', '') AS name FROM documents""")
def safe_name(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", X.safe_name("text").alias("name"))


@query("digits_only", sql="""
SELECT doc_id, regexp_replace(text, '[^0-9]', '', 'g') AS digits,
       TRY_CAST(regexp_replace(text, '[^0-9]', '', 'g') AS BIGINT) AS value,
       TRY_CAST(regexp_replace(format('{:,}', n_chars) || ' reviews', '[^0-9]', '', 'g') AS BIGINT) AS n_reviews
FROM documents""")
def digits_only(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "text", "n_chars")
    shown = F.concat(F.format_number("n_chars", 0), F.lit(" reviews"))
    return d.select("doc_id", X.digits_only("text").alias("digits"),
                    X.to_int(X.digits_only("text")).alias("value"),
                    X.to_int(X.digits_only(shown)).alias("n_reviews"))


@query("comma_int", sql="""
SELECT doc_id, format('{:,}', n_chars) AS shown, CAST(n_chars AS BIGINT) AS value FROM documents""")
def comma_int(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "n_chars")
    shown = F.format_number("n_chars", 0)
    return d.select("doc_id", shown.alias("shown"), X.comma_int(shown).alias("value"))


@query("page_count", sql="""
SELECT source AS attr_name, count(*) AS n, (count(*) + 9) // 10 AS pages,
       count(*) // 10 AS pages_floor, count(*) // 10 + 1 AS pages_floor_plus_one,
       count(*) // 30 AS listing_pages
FROM documents GROUP BY source""")
def page_count(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "source")
    g = d.groupBy(F.col("source").alias("attr_name")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("attr_name", "n", X.page_count("n", 10, "ceil").alias("pages"),
                    X.page_count("n", 10, "floor").alias("pages_floor"),
                    X.page_count("n", 10, "floor_plus_one").alias("pages_floor_plus_one"),
                    X.page_count("n", 30, "floor").alias("listing_pages"))


@query("split_labels", sql="""
SELECT doc_id, len(p) AS n_labels, p[1] AS first_label, p[len(p)] AS last_label
FROM (SELECT doc_id, string_split(replace(text, ' ', '&'), '&') AS p FROM documents)""")
def split_labels(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    p = X.split_labels(F.replace("text", F.lit(" "), F.lit("&")))
    return d.select("doc_id", F.size(p).cast("long").alias("n_labels"),
                    F.get(p, 0).alias("first_label"), F.element_at(p, -1).alias("last_label"))


SPLIT_VISIT_SQL = S.with_(S.VISITS) + """,
parts AS (SELECT event_id, string_split(replace(visit, ' • ', '  '), '  ') AS p FROM visits),
split AS (
  SELECT event_id,
         CASE WHEN p[1] <> 'NONE' THEN p[1] END AS time,
         CASE WHEN len(p) >= 2 AND array_to_string(p[2:], '  ') <> 'NONE'
              THEN array_to_string(p[2:], '  ') END AS type,
         len(p) > 2 AS extra
  FROM parts)
"""


@query("split_visit", sql=SPLIT_VISIT_SQL + "SELECT event_id, time, type, extra FROM split")
def split_visit(spark, sf_dir):
    v = E.visit_strings(spark, sf_dir)
    s = X.split_visit("visit")
    return v.select("event_id", s["time"].alias("time"), s["type"].alias("type"), s["extra"].alias("extra"))


@query("visit_month", sql=SPLIT_VISIT_SQL +
       "SELECT event_id, CAST(CAST(try_strptime(time, '%b %Y') AS DATE) AS VARCHAR) AS visit_month FROM split")
def visit_month(spark, sf_dir):
    """Typed month of the visit (shown as its ISO date text in the result)."""
    v = E.visit_strings(spark, sf_dir)
    return v.select("event_id", X.visit_month(X.split_visit("visit")["time"]).cast("string").alias("visit_month"))


LINKS_SQL = f"""links AS (
  SELECT page_id, url, unnest(l) AS href, unnest(range(len(l))) AS pos
  FROM (SELECT page_id, url, {S.links('html')} AS l FROM pages))"""
SCHEME_HOST_SQL = r"regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)"


def _links(spark, sf_dir):
    p = tables.pages(spark, sf_dir, "page_id", "url", "html")
    return p.select("page_id", "url", F.posexplode(H.html_links("html")).alias("pos", "href"))


@query("abs_url", sql=S.with_(LINKS_SQL) + f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos,
       CASE WHEN starts_with(href, '/') AND NOT starts_with(href, '//')
            THEN {SCHEME_HOST_SQL} || href ELSE href END AS abs_url
FROM links""")
def abs_url(spark, sf_dir):
    l = _links(spark, sf_dir)
    base = F.regexp_extract("url", U.SCHEME_HOST, 1)
    return l.select("page_id", "pos", U.abs_url("href", base).alias("abs_url"))


@query("url_join", sql=S.with_(LINKS_SQL) + f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos,
       CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN href
            WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1) || ':' || href
            WHEN starts_with(href, '/') THEN {SCHEME_HOST_SQL} || href
            WHEN starts_with(href, '?') THEN regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', '') || href
            WHEN starts_with(href, '#') THEN regexp_replace(url, '#.*$', '') || href
            WHEN href = '' THEN url
            ELSE regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', ''), '[^/]*$', '') || href
       END AS joined
FROM links""")
def url_join(spark, sf_dir):
    l = _links(spark, sf_dir)
    return l.select("page_id", "pos", U.url_join("url", "href").alias("joined"))


def _review_page_list(spark, sf_dir):
    seeds = tables.documents(spark, sf_dir, "source").groupBy(F.col("source").alias("attr_name")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return R.gen_page_urls(seeds, "n", E.review_page_url)


PAGE_LIST_SQL = f"""page_list AS (
  SELECT attr_name, page, {_page_url_sql('attr_name', 'page')} AS url
  FROM (SELECT source AS attr_name, unnest(range(0, (count(*) + 9) // 10)) AS page
        FROM documents GROUP BY source))"""


@query("url_template", sql=S.with_(PAGE_LIST_SQL) + f"""
SELECT attr_name, page,
       replace('{E.SITE}{E.REVIEW_PATH}' || regexp_extract(attr_name, '(\\d+)$', 1)
               || '-Reviews-' || attr_name || '.html', 'Reviews', 'Reviews-or' || CAST(page * 10 AS VARCHAR)) AS url
FROM page_list""")
def url_template(spark, sf_dir):
    pl = _review_page_list(spark, sf_dir).select("attr_name", "page")
    template = F.concat(F.lit(E.SITE + E.REVIEW_PATH),
                        F.regexp_extract("attr_name", r"(\d+)$", 1), F.lit(f"-{U.PAGE_SLOT}-"),
                        F.col("attr_name"), F.lit(".html"))
    return pl.select("attr_name", "page", U.url_template(template, F.col("page") * 10).alias("url"))


@query("url_page_no", sql=S.with_(PAGE_LIST_SQL) + """
SELECT attr_name, page, TRY_CAST(regexp_extract_all(url, '(\\d+)', 1)[3] AS BIGINT) // 10 AS page_no
FROM page_list
UNION ALL
SELECT url AS attr_name, NULL AS page, TRY_CAST(regexp_extract_all(url, '(\\d+)', 1)[3] AS BIGINT) // 10 AS page_no
FROM pages""")
def url_page_no(spark, sf_dir):
    pl = _review_page_list(spark, sf_dir)
    a = pl.select("attr_name", "page", U.url_page_no("url").alias("page_no"))
    p = tables.pages(spark, sf_dir, "url")
    b = p.select(F.col("url").alias("attr_name"), F.lit(None).cast("long").alias("page"),
                 U.url_page_no("url").alias("page_no"))
    return a.unionByName(b)


@query("url_fingerprint", sql="SELECT page_id, sha1(url) AS fp FROM pages")
def url_fingerprint(spark, sf_dir):
    p = tables.pages(spark, sf_dir, "page_id", "url")
    return p.select("page_id", U.url_fingerprint("url").alias("fp"))


@query("to_json", sql="SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations")
def to_json(spark, sf_dir):
    """Post record -> JSON text; the check reads the fields back out of the text."""
    c = tables.conversations(spark, sf_dir)
    # indented text, as the stored documents are written
    j = c.select("conv_id", "turn", F.to_json(F.struct("conv_id", "turn", "role", "text"),
                                              {"pretty": "true"}).alias("json"))
    back = F.from_json("json", "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    return j.select(back["conv_id"].alias("conv_id"), back["turn"].alias("turn"),
                    back["role"].alias("role"), F.md5(back["text"]).alias("text_md5"))


@query("zip_map", sql="""
WITH w AS (
  SELECT doc_id, unnest(p) AS word, unnest(range(len(p))) AS i
  FROM (SELECT doc_id, string_split(text, ' ') AS p FROM documents)),
k AS (SELECT doc_id, word, min(i) AS first_i, max(i) AS last_i FROM w GROUP BY doc_id, word)
SELECT doc_id, count(*) AS n_keys,
       string_agg(word, '|' ORDER BY first_i) AS keys,
       string_agg(word || ':' || CAST(last_i AS VARCHAR), '|' ORDER BY first_i) AS vals
FROM k GROUP BY doc_id""")
def zip_map(spark, sf_dir):
    """Names and lists -> map; a repeated name keeps its later list."""
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    words = F.split("text", " ")
    lists = F.transform(words, lambda w, i: F.array(w, i.cast("string")))
    m = F.map_from_arrays(words, lists)
    return d.select("doc_id", m.alias("m")).select(
        "doc_id", F.size(F.map_keys("m")).cast("long").alias("n_keys"),
        F.array_join(F.map_keys("m"), "|").alias("keys"),
        F.array_join(F.transform(F.map_values("m"), lambda v: F.array_join(v, ":")), "|").alias("vals"))


TITLE_SQL = S.title("html")


@query("html_title", sql=f"SELECT page_id, {TITLE_SQL} AS title FROM pages")
def html_title(spark, sf_dir):
    p = tables.pages(spark, sf_dir, "page_id", "html")
    return p.select("page_id", H.html_title("html").alias("title"))


@query("html_links", sql=S.with_(LINKS_SQL) + "SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM links")
def html_links(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", "pos", "href")


@query("first_match", sql=f"SELECT page_id, {S.links('html')}[1] AS first_link FROM pages")
def first_match(spark, sf_dir):
    p = tables.pages(spark, sf_dir, "page_id", "html")
    return p.select("page_id", F.get(H.html_links("html"), 0).alias("first_link"))


PARAS_SQL = r"""list_transform(regexp_extract_all(regexp_replace(html,
   '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g'),
   '(?s)<p(?:\s[^>]*)?>(.*?)</p>', 1), lambda x: regexp_replace(x, '<[^>]*>', '', 'g'))"""


@query("html_text_all", sql=f"""
SELECT page_id, len(p) AS n_paragraphs, md5(array_to_string(p, chr(10))) AS text_md5
FROM (SELECT page_id, {PARAS_SQL} AS p FROM pages)""")
def html_text_all(spark, sf_dir):
    p = tables.pages(spark, sf_dir, "page_id", "html")
    t = H.html_text_all("html")
    return p.select("page_id", F.size(t).cast("long").alias("n_paragraphs"),
                    F.md5(F.array_join(t, "\n")).alias("text_md5"))
