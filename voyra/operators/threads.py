"""Forum threads: assemble pages of posts, first post and replies, bodies,
and following next-page links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def post_struct():
    return F.struct(F.col("username"), F.col("posttime"), F.split(F.col("text"), "\n").alias("posttext"))


def thread_assemble(posts: DataFrame) -> DataFrame:
    """Posts (conv_id, page, turn, username, posttime, text) -> one record per
    thread page: topic, page, firstpost, replypost (= posts[1:]).

    A thread page holds at most a fixed number of posts, so the collected
    array is bounded however long the thread is.
    """
    g = posts.groupBy("conv_id", "page").agg(
        F.array_sort(F.collect_list(F.struct(F.col("turn"), post_struct().alias("p")))).alias("_ps"))
    ps = F.transform("_ps", lambda e: e["p"])
    return g.select(
        "conv_id",
        F.concat(F.lit("Thread "), F.col("conv_id").cast("string")).alias("topic"),
        F.concat(F.lit("Page "), (F.col("page") + 1).cast("string")).alias("page"),
        F.get(ps, 0).alias("firstpost"),
        F.slice(ps, 2, F.greatest(F.size(ps) - 1, F.lit(0))).alias("replypost"),
        F.col("page").alias("page_no"),
    )


def body_concat(posts: DataFrame) -> DataFrame:
    """Text fragments of a page in order, joined with no separator."""
    g = posts.groupBy("conv_id", "page").agg(
        F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("_f"))
    return g.select("conv_id", "page", F.array_join(F.transform("_f", lambda e: e["text"]), "").alias("body"))


def follow_chain(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Follow next-page links from every thread's first page until none is left:
    (conv_id, page, depth) for every page reached, depth of its first visit.

    Path doubling: ``reach`` holds the first visits at depths below ``step``;
    ``jump`` maps a page to the page ``step`` links further. Each round extends
    ``reach`` through ``jump`` (depths step .. 2*step-1) and squares ``jump``
    with a self-join, so a thread of L pages takes ceil(log2 L) rounds of two
    joins, keyed on (thread, page): a long thread is spread over its pages.
    A first visit only follows from a first visit, so keeping the minimum
    depth per page each round is exact and bounds ``reach`` by the pages.
    Each round is checkpointed to the checkpoint folder (lineage stays short).
    """
    from voyra.session import checkpoint_root
    checkpoint_root(spark)
    edges = edges.select("conv_id", "page", "next_page").checkpoint(eager=True)
    bound = edges.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    reach = edges.where(F.col("page") == 0).select("conv_id", "page", F.lit(0).cast("long").alias("depth"))
    jump = edges.where(F.col("next_page").isNotNull()).select("conv_id", "page", F.col("next_page").alias("to"))
    step = 1
    while step < bound:
        ext = reach.join(jump, ["conv_id", "page"]).select(
            "conv_id", F.col("to").alias("page"), (F.col("depth") + F.lit(step)).alias("depth"))
        reach = reach.unionByName(ext).groupBy("conv_id", "page").agg(F.min("depth").alias("depth"))
        a, b = jump.alias("a"), jump.alias("b")
        jump = a.join(b, (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("a.to") == F.col("b.page"))) \
            .select(F.col("a.conv_id").alias("conv_id"), F.col("a.page").alias("page"), F.col("b.to").alias("to"))
        reach, jump = reach.checkpoint(eager=True), jump.checkpoint(eager=True)
        step *= 2
    return reach


def follow_chain_recursive(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """The same walk as a recursive CTE (one join per link followed); kept as
    the plain-SQL statement of ``follow_chain`` and used to check it.

    ``edges``: (conv_id, page, next_page or NULL). Each step
    joins the frontier with the edge table. The edge table is written once to
    the checkpoint folder, so iterations read it instead of recomputing it.

    No path without repeats is longer than its thread's page count, so that
    count (the largest over threads) bounds the recursion exactly; a cycle in
    the links is walked at most that far and each page keeps the depth of its
    first visit, as a crawler that skips seen URLs would.
    """
    from voyra.session import checkpoint_root
    checkpoint_root(spark)
    edges = edges.select("conv_id", "page", "next_page").checkpoint(eager=True)
    bound = edges.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    limit = spark.conf.get("spark.sql.cteRecursionLevelLimit", "100")
    spark.conf.set("spark.sql.cteRecursionLevelLimit", str(max(int(limit), bound + 2)))
    chain = spark.sql(
        """
        WITH RECURSIVE chain(conv_id, page, depth) AS (
          SELECT conv_id, page, CAST(0 AS BIGINT) FROM {edges} WHERE page = 0
          UNION ALL
          SELECT e.conv_id, e.next_page, c.depth + 1
          FROM chain c JOIN {edges} e ON e.conv_id = c.conv_id AND e.page = c.page
          WHERE e.next_page IS NOT NULL AND c.depth < {bound}
        )
        SELECT conv_id, page, min(depth) AS depth FROM chain GROUP BY conv_id, page
        """,
        edges=edges, bound=bound,
    )
    return chain
