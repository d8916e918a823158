"""Page markup rendered from the tables with Spark string functions.

These stand in for fetched attraction, review-listing and forum pages in
the shape the extractors read. Every text value is escaped; every group
collected here is bounded (10 reviews a page, 3 posts a thread page).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voyra.functions.html import html_escape as esc
from voyra.functions.urls import PAGE_SLOT
from voyra.operators.labels import category_codes
from voyra.operators.numbering import number_by_id
from voyra.plans import entities as E
from voyra.session import materialize
from voyra.sources import tables


def _items(arr, tag: str = "li") -> Column:
    return F.array_join(F.transform(arr, lambda x: F.concat(F.lit(f"<{tag}>"), esc(x), F.lit(f"</{tag}>"))), "")


def attraction_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """attr_name, url, html for every attraction."""
    a = E.attraction_info(spark, sf_dir)
    exp = F.col("experiences")
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"), esc(F.col("name")), F.lit("</title></head><body>"),
        F.lit("<h1>"), esc(F.col("name")), F.lit("</h1>"),
        F.lit('<div class="labels">'), esc(F.array_join("labels", "&")), F.lit("</div>"),
        F.lit('<ul class="extra-labels">'), _items(F.array(F.concat(F.lit("reviews "), F.col("score_cnt").cast("string")))),
        F.lit("</ul>"),
        F.lit('<div class="location">'), _items(F.col("location"), "span"), F.lit("</div>"),
        F.lit('<span class="score">'), F.col("score").cast("string"), F.lit("</span>"),
        F.lit('<span class="score-count">'), F.format_number("score_cnt", 0), F.lit(" reviews</span>"),
        F.lit('<div class="near-restas"><ul>'), _items(F.col("nearby.near_restas")), F.lit("</ul></div>"),
        F.lit('<div class="near-attras"><ul>'), _items(F.col("nearby.near_attras")), F.lit("</ul></div>"),
        F.lit('<div class="exp-tabs">'), _items(F.map_keys(exp), "button"), F.lit("</div>"),
        F.array_join(F.transform(F.map_values(exp), lambda v: F.concat(
            F.lit('<div class="exp-panel"><ul>'), _items(v), F.lit("</ul></div>"))), ""),
        F.lit("</body></html>"),
    )
    return a.select("attr_name", html.alias("html"))


def review_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with their visit string (events joined on doc_id = event_id)
    and whether the title is shown (reviews under 200 characters have none)."""
    # numbered and joined with the visits without texts, which come in last
    r = review_numbers(spark, sf_dir, "n_chars")
    v = E.visit_strings(spark, sf_dir).withColumnRenamed("event_id", "doc_id")
    t = tables.documents(spark, sf_dir, "doc_id", F.substring("text", 1, E.TITLE_CHARS).alias("title"), F.col("text").alias("review"))
    return r.join(v, "doc_id", "left").join(t, "doc_id").select(
        "attr_name", "attr_page", "review_id", "doc_id",
        F.when(F.col("n_chars") >= 200, F.col("title")).alias("title"),
        F.when(F.col("visit") != "NONE", F.col("visit")).alias("visit"), "review")


def review_numbers(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """doc_id, attr_name, review_id, attr_page and further columns of documents, without texts."""
    d = number_by_id(tables.documents(spark, sf_dir, "doc_id", "source", *extra), ["source"], "doc_id", "review_id")
    return d.select("doc_id", F.col("source").alias("attr_name"), "review_id",
                    F.floor(F.col("review_id") / E.REVIEWS_PER_PAGE).cast("long").alias("attr_page"), *extra)


def _review_head(spark: SparkSession, sf_dir: str, pages: DataFrame) -> DataFrame:
    """``pages`` (attr_name, attr_page, _lo, _hi: first and last number on it) with the beginning
    of their markup: the heading and the pager, which counts all reviews."""
    totals = tables.documents(spark, sf_dir, "source").groupBy(F.col("source").alias("attr_name")).agg(F.count(F.lit(1)).alias("total"))
    head = F.concat(
        F.lit("<!DOCTYPE html><html><body><h1>"), esc(F.col("attr_name")), F.lit("</h1>"),
        F.lit('<div class="pager">Showing '), (F.col("_lo") + 1).cast("string"), F.lit("-"),
        (F.col("_hi") + 1).cast("string"), F.lit(" of "), F.format_number("total", 0), F.lit(" reviews</div>"))
    return pages.join(totals, "attr_name").withColumn("head", head)


def review_page_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """attr_name, attr_page, html: the beginning of each listing page, down to the pager."""
    g = review_numbers(spark, sf_dir).groupBy("attr_name", "attr_page").agg(F.min("review_id").alias("_lo"), F.max("review_id").alias("_hi"))
    return _review_head(spark, sf_dir, g).select("attr_name", "attr_page", F.col("head").alias("html"))


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """attr_name, attr_page, url, html: one listing page of up to ten reviews."""
    s = review_slots(spark, sf_dir)
    slot = F.concat(
        F.lit('<div class="review"><div class="user">u'), F.col("doc_id").cast("string"),
        F.lit('</div><div class="bubble">*</div><div class="title">'), F.coalesce(esc(F.col("title")), F.lit("")),
        F.lit("</div>"),
        F.when(F.col("visit").isNotNull(), F.concat(F.lit('<div class="time">'), esc(F.col("visit")), F.lit("</div>")))
        .otherwise(F.lit("")),
        F.lit('<div class="body">'), _items(F.split("review", "\n"), "span"), F.lit("</div></div>"))
    g = s.groupBy("attr_name", "attr_page").agg(
        F.array_sort(F.collect_list(F.struct("review_id", slot.alias("h")))).alias("_s"),
        F.min("review_id").alias("_lo"), F.max("review_id").alias("_hi"))
    g = _review_head(spark, sf_dir, g)
    html = F.concat(
        "head", F.array_join(F.transform("_s", lambda e: e["h"]), ""), F.lit("</body></html>"))
    return g.select("attr_name", "attr_page", E.review_page_url(F.col("attr_name"), F.col("attr_page")).alias("url"),
                    html.alias("html"))


def forum_url(conv_id, page) -> Column:
    return F.concat(F.lit("/forum/thread-"), conv_id.cast("string"), F.lit("-page-"),
                    (page + 1).cast("string"), F.lit(".html"))


def _next_link(pages: DataFrame) -> DataFrame:
    """``pages`` (conv_id, page) with ``nxt``, the link to the next page of the thread, if there is one."""
    last = pages.groupBy("conv_id").agg(F.max("page").alias("_last"))
    nxt = F.when(F.col("page") < F.col("_last"), F.concat(
        F.lit('<a class="next" href="'), forum_url(F.col("conv_id"), F.col("page") + 1), F.lit('">Next</a>'))).otherwise(F.lit(""))
    return pages.join(last, "conv_id").withColumn("nxt", nxt)


def forum_page_feet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, page, html: the end of each thread page, after its posts."""
    pages = tables.conversations(spark, sf_dir, "conv_id", "turn").select(
        "conv_id", F.floor(F.col("turn") / E.POSTS_PER_PAGE).cast("long").alias("page")).distinct()
    return _next_link(pages).select("conv_id", "page", F.concat("nxt", F.lit("</body></html>")).alias("html"))


def forum_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, page, url, html: one thread page of up to three posts, with a
    next link when a later page exists. System posts show no user name."""
    p = E.posts(spark, sf_dir)
    post = F.concat(
        F.lit('<div class="post">'),
        F.when(F.col("username") != "system",
               F.concat(F.lit('<div class="username">'), esc(F.col("username")), F.lit("</div>"))).otherwise(F.lit("")),
        F.lit('<div class="posttime">'), esc(F.col("posttime")), F.lit('</div><div class="posttext">'),
        _items(F.split("text", "\n"), "p"), F.lit("</div></div>"))
    g = p.groupBy("conv_id", "page").agg(F.array_sort(F.collect_list(F.struct("turn", post.alias("h")))).alias("_p"))
    last = tables.conversations(spark, sf_dir, "conv_id", "turn").select("conv_id", F.floor(F.col("turn") / E.POSTS_PER_PAGE).cast("long").alias("page"))
    last = last.groupBy("conv_id").agg(F.max("page").alias("_last"))
    nxt = F.when(F.col("page") < F.col("_last"), F.concat(
        F.lit('<a class="next" href="'), forum_url(F.col("conv_id"), F.col("page") + 1), F.lit('">Next</a>'))).otherwise(F.lit(""))
    g = g.join(last, "conv_id").withColumn("nxt", nxt)
    html = F.concat(
        F.lit('<!DOCTYPE html><html><body><h1 class="topic">Thread '), F.col("conv_id").cast("string"),
        F.lit('</h1><div class="pageno">Page '), (F.col("page") + 1).cast("string"), F.lit("</div>"),
        F.array_join(F.transform("_p", lambda e: e["h"]), ""), "nxt", F.lit("</body></html>"))
    return g.select("conv_id", "page", forum_url(F.col("conv_id"), F.col("page")).alias("url"), html.alias("html"))


LISTING_SIZE = 30        # attractions a region page lists
INDEX_SIZE = 20          # threads a forum index page lists
INDEX_AHEAD = 10         # index pages that an index page links to


def attraction_url(attr) -> Column:
    return F.concat(F.lit(E.SITE + E.REVIEW_PATH), F.regexp_extract(attr, r"(\d+)$", 1),
                    F.lit(f"-{PAGE_SLOT}-"), attr, F.lit(".html"))


def region_url(page) -> Column:
    return F.concat(F.lit(E.SITE + "/Region-oa"), page.cast("string"), F.lit(".html"))


def index_url(page) -> Column:
    return F.concat(F.lit(E.SITE + "/forum/index-"), page.cast("string"), F.lit(".html"))


def _link(url: Column, label: Column, css: str = "item") -> Column:
    """A root-relative link; an advertisement beside it is inside a comment."""
    return F.concat(F.lit(f'<a class="{css}" href=\''), esc(F.replace(url, F.lit(E.SITE), F.lit(""))), F.lit("'><b>"), esc(label),
                    F.lit("</b></a><!-- <a href='/ad.html'>ad</a> -->"))


def _list_pages(items: DataFrame, size: int, url: Column, label: Column) -> DataFrame:
    """(n, ...) numbered items -> (page, links): ``size`` links a page."""
    row = items.select(F.floor(F.col("n") / size).cast("long").alias("page"), "n", _link(url, label).alias("a"))
    g = row.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("n", "a"))).alias("l"))
    return g.select("page", F.array_join(F.transform("l", lambda x: x["a"]), "").alias("links"))


def region_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, html of the region's listing pages, each with a link to the next."""
    names = materialize(category_codes(tables.documents(spark, sf_dir, "source"), "source", out="n"))
    pages = _list_pages(names, LISTING_SIZE, attraction_url(F.col("source")), F.col("source"))
    pages = pages.withColumn("last", names.agg(F.floor(F.max("n") / LISTING_SIZE)).scalar())
    more = F.when(F.col("page") < F.col("last"), _link(region_url(F.col("page") + 1), F.lit("Next"), "next")).otherwise("")
    html = F.concat(F.lit("<html><script>var a = \"<a href='/x.html'>x</a>\";</script><body>"), "links", more, F.lit("</body></html>"))
    return pages.select(region_url(F.col("page")).alias("url"), html.alias("html"))


def forum_index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, html of the forum's index pages: threads, and the index pages that follow."""
    threads = materialize(number_by_id(tables.conversations(spark, sf_dir, "conv_id").distinct(), [], "conv_id", "n"))
    label = F.concat(F.lit("Thread "), F.col("conv_id").cast("string"))
    pages = _list_pages(threads, INDEX_SIZE, F.concat(F.lit(E.SITE), forum_url(F.col("conv_id"), F.lit(0))), label)
    pages = pages.withColumn("last", threads.agg(F.floor(F.max("n") / INDEX_SIZE)).scalar())
    ahead = F.filter(F.transform(F.sequence(F.lit(1), F.lit(INDEX_AHEAD)), lambda k: F.col("page") + k), lambda p: p <= F.col("last"))
    more = F.array_join(F.transform(ahead, lambda p: _link(index_url(p), (p + 1).cast("string"), "page")), "")
    return pages.select(index_url(F.col("page")).alias("url"), F.concat(F.lit("<html><body>"), "links", more, F.lit("</body></html>")).alias("html"))
