"""Relational operators: identities, idempotence, exact numbering, skew form."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from voyra.operators import reviews as R
from voyra.operators.numbering import id_bucket, seq_number

ROWS = [("Tower", i, i // 10, f"t{i % 7}", None, None, f"body {i % 13}") for i in range(57)] + \
       [("Park", i, i // 10, "same", "Jul 2021", "Solo", "same body") for i in range(12)]
SCHEMA = "attr_name STRING, review_id LONG, attr_page LONG, title STRING, time STRING, type STRING, review STRING"


def test_explode_after_assemble_is_identity(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    pages = R.page_assemble(df)
    assert pages.where(F.size("attr_reviews") > 10).count() == 0
    back = R.explode_reviews(pages)
    key = ["attr_name", "review_id"]
    a = sorted(tuple(r) for r in back.select(*key, "title", "review").collect())
    b = sorted(tuple(r) for r in df.select(*key, "title", "review").collect())
    assert a == b
    assert back.where(F.floor(F.col("review_id") / 10) != F.col("attr_page")).count() == 0


def test_dedup_keeps_lowest_id_and_is_idempotent(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    once = R.dedup_reviews(df)
    twice = R.dedup_reviews(once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    park = once.where("attr_name = 'Park'").collect()
    assert len(park) == 1 and park[0].review_id == 0


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z"), ("a", 2, "w")], "k STRING, o INT, v STRING")
    got = {r.k: (r.o, r.v) for r in R.latest_per_key(df, ["k"], ["o"]).collect()}
    assert got == {"a": (3, "y"), "b": (2, "z")}


def test_seq_number_equals_row_number_with_hot_key(spark):
    rnd = random.Random(7)
    ids = rnd.sample(range(1_000_000), 3000)
    # one key holds a third of the rows; small bucket width forces many buckets
    rows = [("hot" if i % 3 == 0 else f"k{i % 17}", x) for i, x in enumerate(ids)] + [(None, 5), (None, 9)]
    df = spark.createDataFrame(rows, "k STRING, id LONG")
    got = seq_number(df, ["k"], ["id"], id_bucket("id", 1000), out="s")
    want = df.withColumn("s", F.row_number().over(Window.partitionBy("k").orderBy("id")) - 1)
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    glob = seq_number(df, [], ["id"], id_bucket("id", 5000), out="s")
    assert sorted(r.s for r in glob.collect()) == list(range(len(rows)))


def test_hot_key_is_spread_over_partitions(spark):
    """One key holds a third of the rows. A per-key window puts all of it in
    one partition; the bucketed and the range numbering both spread it."""
    n = 30_000
    df = spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(n)], "k STRING, id LONG")

    def max_share(parted):
        sizes = [r["count"] for r in parted.groupBy(F.spark_partition_id()).count().collect()]
        return max(sizes) / n
    by_key = df.repartition(8, "k")                                    # what Window.partitionBy(k) needs
    by_bucket = df.withColumn("_vb", id_bucket("id", 1000)).repartition(8, "k", "_vb")
    by_range = df.repartitionByRange(8, "k", "id")
    assert max_share(by_key) >= 1 / 3
    assert max_share(by_bucket) < 0.25 and max_share(by_range) < 0.25


def test_stop_at_missing(spark):
    df = spark.createDataFrame([("p", 0, "a"), ("p", 1, None), ("p", 2, "c"), ("q", 0, "x")],
                               "pg STRING, slot INT, title STRING")
    kept = R.stop_at_missing(df, ["pg"], "slot", "title")
    assert sorted((r.pg, r.slot) for r in kept.collect()) == [("p", 0), ("q", 0)]


def test_gen_page_urls_modes(spark):
    seeds = spark.createDataFrame([("a", 0), ("b", 10), ("c", 11)], "attr_name STRING, n LONG")
    url = lambda a, p: F.concat(a, F.lit("-"), p.cast("string"))
    for mode, want in [("ceil", {"b": 1, "c": 2}), ("floor_plus_one", {"a": 1, "b": 2, "c": 2}),
                       ("floor", {"b": 1, "c": 1})]:
        got = R.gen_page_urls(seeds, "n", url, 10, mode).groupBy("attr_name").count().collect()
        assert {r[0]: r[1] for r in got} == want, mode
    many = spark.createDataFrame([("big", 2_500_000)], "attr_name STRING, n LONG")
    pages = R.gen_page_urls(many, "n", url, 10, "ceil", chunk=50_000)
    assert pages.count() == 250_000 and pages.agg(F.max("page")).first()[0] == 249_999
