"""Relational operators over review pages and flat reviews.

Design notes for scale:
* "first / last per key" is a grouped ``min``/``max`` of a struct (or
  ``min_by``), not a ``row_number`` window: the aggregate combines map-side,
  so a key with a third of the rows is reduced before the shuffle.
* Page assembly groups the reviews of one page, so collected arrays stay
  bounded whatever the size of an attraction.
* Generated page lists are exploded in two steps with a shuffle between, so
  one attraction with millions of pages is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voyra.functions.text import NONE


def build_review(title="title", time="time", type_="type", review="review") -> Column:
    """The stored review record: struct(title, time, type, review)."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.struct(c(title).alias("title"), c(time).alias("time"),
                    c(type_).alias("type"), c(review).alias("review"))


def page_assemble(reviews: DataFrame) -> DataFrame:
    """Flat reviews -> one document per (attr_name, attr_page) with
    attr_reviews = map(string(review_id) -> review struct), ordered by id.

    Expects columns attr_name, attr_page, review_id, title, time, type, review.
    """
    entry = F.struct(F.col("review_id").cast("string").alias("k"),
                     build_review().alias("v"), F.col("review_id").alias("i"))
    g = reviews.groupBy("attr_name", "attr_page").agg(F.collect_list(entry).alias("_e"))
    ordered = F.array_sort(F.transform("_e", lambda e: F.struct(e["i"].alias("i"), e["k"].alias("k"), e["v"].alias("v"))))
    return g.select("attr_name", F.col("attr_page").cast("long").alias("attr_page"),
                    F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["k"], e["v"])))
                    .alias("attr_reviews"))


def explode_reviews(pages: DataFrame) -> DataFrame:
    """Review-page documents -> one row per review; review_id is a long."""
    e = pages.select("attr_name", "attr_page", F.explode("attr_reviews").alias("k", "v"))
    return e.select("attr_name", "attr_page", F.col("k").try_cast("long").alias("review_id"),
                    "v.title", "v.time", "v.type", "v.review")


def dedup_reviews(reviews: DataFrame, keys=("attr_name", "title", "review"),
                  order: str = "review_id") -> DataFrame:
    """Keep one row per distinct (attraction, title, body): the lowest id."""
    keys = list(keys)
    rest = [c for c in reviews.columns if c not in keys and c != order]
    # min(id) and min_by(col, id) keep fixed-width buffers for numeric columns,
    # so Spark hash-aggregates (no sort on the long text keys) and combines
    # copies map-side before the shuffle.
    aggs = [F.min(order).alias(order)] + [F.min_by(c, order).alias(c) for c in rest]
    return reviews.groupBy(*keys).agg(*aggs).select(*keys, order, *rest)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last write wins: per key, the row with the greatest ``order``."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    if len(order) == 1:
        # one order column: max + max_by keep fixed-width buffers where the
        # columns are numeric, so the aggregate hashes and combines map-side
        o = order[0]
        aggs = [F.max(o).alias(o)] + [F.max_by(c, o).alias(c) for c in rest]
        return df.groupBy(*keys).agg(*aggs).select(*keys, o, *rest)
    last = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_l")
    return df.groupBy(*keys).agg(last).select(*keys, *[f"_l.{c}" for c in order],
                                              *[f"_l.{c}" for c in rest])


def fill_missing(c, enabled: bool = True) -> Column:
    """Missing field -> the NONE sentinel (or keep NULL with ``enabled=False``)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(NONE)) if enabled else col


def stop_at_missing(slots: DataFrame, page_keys: list[str], slot: str = "slot",
                    title: str = "title") -> DataFrame:
    """Keep the slots before the first slot without a title on each page.

    A page holds at most ten slots, so a window over the page is bounded
    (one shuffle on the page key, no self-join of the input).
    """
    from pyspark.sql import Window
    w = Window.partitionBy(*page_keys)
    first_missing = F.min(F.when(F.col(title).isNull(), F.col(slot))).over(w)
    j = slots.withColumn("_first_missing", first_missing)
    return j.where(F.col("_first_missing").isNull() | (F.col(slot) < F.col("_first_missing"))) \
            .drop("_first_missing")


def gen_page_urls(seeds: DataFrame, total: str, url_of, size: int = 10,
                  mode: str = "ceil", chunk: int = 100_000, keep: list[str] | None = None) -> DataFrame:
    """Seeds (attr_name, total items) -> one row per page: attr_name, page, url
    (plus the seed columns named in ``keep``).

    ``mode``: 'ceil' lists every item; 'floor' and 'floor_plus_one' are the
    crawlers' truncating forms. ``url_of(attr_name_col, page_col)`` builds the URL.
    """
    from voyra.functions.text import page_count
    keep = keep or []
    s = seeds.select("attr_name", *keep, page_count(F.col(total), size, mode).alias("_np"))
    # Step 1: chunks of pages; step 2: pages inside a chunk, after a shuffle.
    c = s.select("attr_name", *keep, "_np", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("_np") - 1) / chunk).cast("long"))).alias("_c"))
    c = c.where(F.col("_np") > 0).repartition("attr_name", "_c")
    lo = F.col("_c") * chunk
    hi = F.least(lo + chunk, F.col("_np")) - 1
    p = c.select("attr_name", *keep, F.explode(F.sequence(lo, hi)).alias("page"))
    return p.select(*keep, "attr_name", "page", url_of(F.col("attr_name"), F.col("page")).alias("url"))


def batch_index(df: DataFrame, seq: str, per_batch: int = 10) -> Column:
    """Batch number of a row from its sequence number (ten records a file)."""
    return F.floor(F.col(seq) / per_batch).cast("long")
