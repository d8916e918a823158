"""A walk over typed links, breadth first, in rounds that are far fewer than the levels.

Pages have a kind, told by their URL, and a link counts if its page's kind may
lead to the kind of its target (a region to attractions, a forum index to threads ...).
Links are read from the markup once, into a table (from, to, kind, label). Pages that have links
are numbered in URL order and dealt into blocks of neighbours, of about ``BLOCK_LINKS`` links each. A round
takes each block that has news, a task a block: from the depths that came in it walks on inside the block
until nothing there gets nearer, and sends depths over the links that leave it. When no block has news, the
depths are the least ones, whatever the order in which they came. So the rounds go by how often a way
changes its block, not by the depth of the site; links that fit into one block take one round. Pages without links
of their own (review pages, the last pages of threads) are in no block; their depth is their nearest page's and one.

Then one join has each page's ways: the least depth, there the smallest parent, there the smallest label. What a
link's label says where a kind of page begins (an attraction's name, a thread's topic) goes along with all pages
below it: pages look up along their parents, first inside a block, then twice as far each round.

What is found is written every round, so a lost executor repeats its tasks only. A task holds one block;
through the driver go hashes of the blocks that have news.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voyra.functions import html as H
from voyra.functions import urls as U
from voyra.operators.labels import category_codes
from voyra.session import scratch_dir


@dataclass(frozen=True)
class Site:
    """Kinds of pages: ``patterns`` (kind, regex of its URLs; the first that matches), ``leads`` (kind
    of a page, kinds its links may lead to), and the kinds whose label ``names`` what is below."""

    patterns: tuple[tuple[str, str], ...]
    leads: dict[str, tuple[str, ...]]
    names: tuple[str, ...] = ()

    def kind(self, url: Column) -> Column:
        out = F.lit(None).cast("string")
        for kind, pattern in reversed(self.patterns):
            out = F.when(url.rlike(pattern), F.lit(kind)).otherwise(out)
        return out

    def may_lead(self, here: Column, there: Column) -> Column:
        out = F.lit(False)
        for kind, to in self.leads.items():
            out = out | ((here == kind) & there.isin(*to))
        return out


SENT_ROWS = 1 << 16       # hashes of at most so many blocks go to every executor
BLOCK_LINKS = 1 << 20     # links and pages of a block, about
FAR = np.iinfo(np.int64).max

LINKS = "from_url STRING, to_url STRING, kind STRING, label STRING"


def typed_links(pages: DataFrame, site: Site) -> DataFrame:
    """(url, html) -> (from_url, to_url, kind, label): the links that count, made absolute
    against their page, without fragments."""
    found = pages.select(F.col("url").alias("from_url"), F.explode(H.html_links_and_texts("html")).alias("a"))
    to = F.regexp_replace(U.url_join("from_url", F.col("a.href")), "#.*$", "")
    found = found.select("from_url", to.alias("to_url"), F.col("a.label").alias("label"))
    found = found.withColumn("kind", site.kind(F.col("to_url")))
    return found.where(site.may_lead(site.kind(F.col("from_url")), F.col("kind"))).select("from_url", "to_url", "kind", "label")


def _near(rows: DataFrame, block: str, few: DataFrame, n: int) -> DataFrame:
    """The ``rows`` whose ``block`` may be one of the ``n`` of ``few`` (block); all, if those are many."""
    if n > SENT_ROWS:
        return rows
    hashes = few.select(F.xxhash64("block").alias("_h")).distinct()
    return rows.join(F.broadcast(hashes), F.xxhash64(block) == F.col("_h"), "left_semi")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _links_of(pages: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Places of the links of ``pages``, if those of page i are at start[i] to below start[i + 1]."""
    size = start[pages + 1] - start[pages]
    return np.repeat(start[pages] - np.cumsum(size) + size, size) + np.arange(size.sum())


def nearest(f: np.ndarray, t: np.ndarray, known: tuple[np.ndarray, np.ndarray], news: tuple[np.ndarray, np.ndarray],
            most: int = FAR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Walk inside a block. ``f``, ``t``: its links, from pages of the block; ``known`` and ``news``: (page, depth) as it was,
    and as it came in. Returns the pages that are nearer now, their depths, and (page, depth) of what
    they lead to outside. No depth is above ``most``."""
    order = np.argsort(f, kind="stable")
    f, t = f[order], t[order]
    pages, start = np.unique(f, return_index=True)
    start = np.append(start, len(f))
    at = np.minimum(np.searchsorted(pages, t), max(len(pages) - 1, 0))
    inside = pages[at] == t if len(pages) else np.zeros(0, bool)
    depth = np.full(len(pages), FAR)
    depth[np.searchsorted(pages, known[0])] = known[1]
    before = depth.copy()
    np.minimum.at(depth, np.searchsorted(pages, news[0]), news[1])
    waiting = np.flatnonzero(depth < before)
    waiting = waiting[np.argsort(depth[waiting], kind="stable")]
    comes, done, level, d = depth[waiting], 0, np.zeros(0, np.int64), 0
    while len(level) or done < len(waiting):
        if not len(level):
            d = int(comes[done])
        upto = int(np.searchsorted(comes, d, "right"))
        more, done = waiting[done:upto], max(done, upto)
        level = np.union1d(level, more[depth[more] == d])      # those that were reached sooner have been taken
        if d >= most:
            break
        links = _links_of(level, start)
        to = at[links[inside[links]]]
        level = np.unique(to[depth[to] > d + 1])
        d += 1
        depth[level] = d
    nearer = np.flatnonzero((depth < before) & (depth <= most))
    out = _links_of(nearer[depth[nearer] < most], start)
    out = out[~inside[out]]
    there, of = np.unique(t[out], return_inverse=True)
    then = np.full(len(there), FAR)
    np.minimum.at(then, of, depth[np.searchsorted(pages, f[out])] + 1)
    return pages[nearer], depth[nearer], there, then


def ends(page: np.ndarray, to: np.ndarray) -> np.ndarray:
    """For each page the last on its way that isn't among ``page``, going from page[i] to to[i]; no way is a circle."""
    order = np.argsort(page)
    at = order[np.minimum(np.searchsorted(page, to, sorter=order), len(page) - 1)]
    at = np.where(page[at] == to, at, np.arange(len(page)))
    while True:
        twice = at[at]
        if (twice == at).all():
            return to[at]
        at = twice


def _depths(links: DataFrame, roots: DataFrame, width: int, most: int) -> DataFrame:
    """(id, d) of the pages of ``links`` (block, f, t) that are reached from ``roots`` (id), ``width`` pages a block."""
    spark, folder, turn = links.sparkSession, scratch_dir(links.sparkSession, "frontier-depths"), 0
    row = "own BOOLEAN, block BIGINT, id BIGINT, d BIGINT"

    def run(b: pa.Table) -> pa.Table:
        f, t, d = (b.column(c).fill_null(-1).to_numpy() for c in ("id", "t", "d"))
        link = d < 0
        own = b.column("own").to_numpy(zero_copy_only=False).astype(bool)
        known, came = ~link & own, ~link & ~own
        page, depth, there, then = nearest(f[link], t[link], (f[known], d[known]), (f[came], d[came]), most)
        return pa.table({"own": np.repeat([True, False], [len(page), len(there)]), "block": np.concatenate([page, there]) // width,
                         "id": np.concatenate([page, there]), "d": np.concatenate([depth, then])})

    def add(rows: DataFrame) -> DataFrame:
        rows.withColumn("turn", F.lit(turn)).write.mode("append").parquet(folder)
        return spark.read.schema(f"{row}, turn INT").parquet(folder)
    found = add(roots.select(F.lit(False).alias("own"), _block("id", width).alias("block"), "id", F.lit(0).cast("long").alias("d")))
    while True:
        came = found.where(~F.col("own") & (F.col("turn") == turn))
        blocks = came.select("block").distinct()
        n = blocks.count()
        if not n:
            return found.where("own").groupBy("id").agg(F.min("d").alias("d"))
        none = F.lit(None).cast("long")
        rows = links.select(F.lit(True).alias("own"), "block", F.col("f").alias("id"), none.alias("d"), "t").unionByName(
            found.where("own").groupBy("block", "id").agg(F.min("d").alias("d")).select(F.lit(True).alias("own"), "block", "id", "d", none.alias("t")))
        rows = _near(rows, "block", blocks, n).unionByName(
            came.groupBy("block", "id").agg(F.min("d").alias("d")).select(F.lit(False).alias("own"), "block", "id", "d", none.alias("t")))
        turn += 1
        found = add(rows.groupBy("block").applyInArrow(run, row))


def _block(page: str, width: int) -> Column:
    return F.floor(F.col(page) / F.lit(width)).cast("long")


def _inherited(rows: DataFrame, width: int) -> DataFrame:
    """(f, inherited): what the pages that have links (``rows``: t, f, named, label) hand on to the pages below them: their own
    label, or what their parent hands on; of several kinds of one page the smallest, null before all."""
    value = F.when(F.col("named"), F.struct(F.col("label").alias("c"))).when(F.col("f").isNull(), F.struct(F.lit(None).cast("string").alias("c")))
    pages = rows.where("t IS NOT NULL").groupBy("t").agg(F.min(value).alias("v"), F.collect_set(F.when(~F.col("named"), F.col("f"))).alias("up"))
    pages = _stored(pages, "frontier-pages")

    def follow(b: pa.Table) -> pa.Table:
        return pa.table({"t": b.column("t"), "up": ends(b.column("t").to_numpy(), b.column("up").to_numpy())})
    one = F.col("v").isNull() & (F.size("up") == 1)
    short = pages.where(one).select(_block("t", width).alias("block"), "t", F.col("up")[0].alias("up")).groupBy("block").applyInArrow(follow, "t long, up long")
    pages = pages.where(~one).unionByName(short.select("t", F.lit(None).cast(pages.schema["v"].dataType).alias("v"), F.array("up").alias("up")))
    while True:
        pages = _stored(pages, "frontier-pages")
        open_ = F.size("up") > 0
        if pages.where(open_).isEmpty():
            return pages.select(F.col("t").alias("f"), F.col("v.c").alias("inherited"))
        above = pages.select(F.col("t").alias("a"), "v", "up")
        further = pages.where(open_).select("t", F.explode("up").alias("a")).join(above, "a").select("t", "v", "up")
        here = pages.where(open_).select("t", "v", F.array().cast("array<bigint>").alias("up"))
        pages = pages.where(~open_).unionByName(here.unionByName(further).groupBy("t").agg(
            F.min("v").alias("v"), F.array_distinct(F.flatten(F.collect_list("up"))).alias("up")))


def walk(spark: SparkSession, links: DataFrame, roots: DataFrame, site: Site, max_depth: int | None = None) -> DataFrame:
    """(url, kind, depth, parent, context) of every page reached from ``roots`` (url), once:
    at its least depth, with the smallest parent URL there; ``context`` is the label of the
    nearest link on that way whose kind names, null above the first. Links of a page to
    itself, cycles and repeated links add nothing; null URLs are left out."""
    table = scratch_dir(spark, "typed-links")
    links.where("from_url IS NOT NULL AND to_url IS NOT NULL").write.parquet(table)
    links = spark.read.schema(LINKS).parquet(table)
    most = FAR if max_depth is None else max_depth
    ids = _stored(category_codes(links, "from_url", out="id"), "frontier-ids")         # pages that have links
    links = _stored(links.join(ids.withColumnRenamed("id", "f"), "from_url").join(ids.select(F.col("from_url").alias("to_url"), F.col("id").alias("t")),
                                                                                 "to_url", "left"), "frontier-links")
    starts = roots.where("url IS NOT NULL").select("url").distinct().join(ids.withColumnRenamed("from_url", "url"), "url", "left")
    between, pages = links.where("t <> f"), ids.count()
    blocks = max(1, -(-(between.count() + pages) // BLOCK_LINKS))
    width = max(1, -(-pages // blocks))
    # a page whose links all lead to pages without links has a link to itself here, so that it is in its block
    inner = between.select("f", "t").unionByName(ids.select(F.col("id").alias("f"), F.col("id").alias("t"))).distinct()
    inner = _stored(inner.select(_block("f", width).alias("block"), "f", "t"), "frontier-inner")
    depths = _depths(inner, starts.where("id IS NOT NULL").select("id"), width, most)
    named = F.coalesce(F.col("kind").isin(*site.names), F.lit(False)) if site.names else F.lit(False)
    ways = links.join(depths.select(F.col("id").alias("f"), "d"), "f").where(F.col("d") < most).select(
        F.col("to_url").alias("url"), "t", "kind", (F.col("d") + 1).alias("depth"), F.col("from_url").alias("parent"), "f",
        F.when(named, F.coalesce("label", F.lit(""))).alias("label"))
    none = F.lit(None)
    ways = ways.unionByName(starts.select("url", F.col("id").alias("t"), site.kind(F.col("url")).alias("kind"), F.lit(0).cast("long").alias("depth"),
                                          none.cast("string").alias("parent"), none.cast("long").alias("f"), none.cast("string").alias("label")))
    # the URL fixes the kind; of several ways the least depth, then the smallest parent, then the smallest label
    rows = ways.groupBy("url", "kind").agg(F.min("t").alias("t"), F.min(F.struct("depth", "parent", "f", "label")).alias("way"))
    least = F.min("way.depth").over(Window.partitionBy("url"))
    rows = rows.withColumn("least", least).where(F.col("way.depth") == F.col("least"))
    rows = _stored(rows.select("url", "kind", "t", "way.*", (named & F.col("way.f").isNotNull()).alias("named")), "frontier-rows")
    found = rows.join(_inherited(rows, width), "f", "left")
    context = F.when(F.col("named"), F.col("label")).otherwise(F.col("inherited"))
    return _stored(found.select("url", "kind", "depth", "parent", context.alias("context")), "frontier")
