"""The stored seen set, counters of the writing pass, and sketches by day."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from voyra.operators import sketches as SK
from voyra.sinks import files as sinks
from voyra.sinks.seen import SeenSet


def fps(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").alias("n"), F.sha1(F.col("id").cast("string")).alias("fp"))


def test_seen_set_grows_and_is_opened_again(spark, tmp_dir):
    path = f"{tmp_dir}/seen"
    seen = SeenSet(spark, path, buckets=4)
    assert seen.unseen(fps(spark, 0, 50)).count() == 50
    seen.add(fps(spark, 0, 30).union(fps(spark, 0, 30)))
    assert seen.read().count() == 30 and {r.n for r in seen.unseen(fps(spark, 20, 40)).collect()} == set(range(30, 40))
    seen.add(fps(spark, 20, 40))
    assert seen.read().count() == 40
    again = SeenSet(spark, path, buckets=99)              # the folder knows its buckets
    assert again.buckets == 4 and again.unseen(fps(spark, 0, 41)).count() == 1
    odd = spark.createDataFrame([(1, None), (2, "")], "n long, fp string")
    again.add(odd)
    assert [r.n for r in again.unseen(odd).collect()] == [1]
    # one file a bucket and run
    assert len(glob.glob(f"{path}/part-*")) <= 3 * 4


def test_the_seen_side_is_not_shuffled(spark, tmp_dir):
    seen = SeenSet(spark, f"{tmp_dir}/seen", buckets=6)
    seen.add(fps(spark, 0, 500))
    seen.add(fps(spark, 500, 900))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = seen.unseen(fps(spark, 800, 1000))
        assert df.count() == 100
        df = seen.unseen(fps(spark, 800, 1000))
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftAnti" in plan and plan.count("Exchange hashpartitioning") == 1
    side = plan[plan.index("FileScan"):].split("\n")[0]
    assert "Bucketed: true" in side


def test_counts_of_the_writing_pass(spark, tmp_dir):
    scans = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b
    rows = spark.range(1000).selectExpr("id", "id % 7 = 0 AS bad").mapInArrow(touch, "id long, bad boolean")
    for _ in range(2):
        got = sinks.write_counted(rows, f"{tmp_dir}/out", {"kept": ~F.col("bad"), "bad": F.col("bad"), "none": F.lit(False)}, ["bad"])
        assert got == {"kept": 857, "bad": 143, "none": 0}
    assert scans.value == 2000                            # every row passed once a run
    assert spark.read.json(f"{tmp_dir}/out").count() == 2000
    assert sorted(tuple(r) for r in sinks.read_counts(spark, f"{tmp_dir}/out").collect()) == [(857, 143, 0)] * 2
    empty = sinks.write_counted(rows.limit(0), f"{tmp_dir}/empty", {"kept": F.lit(True)})
    assert empty == {"kept": 0}


def days(spark):
    return spark.range(60_000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 5).cast("int")).alias("day"), (F.col("id") * 7919 % 20_011).alias("user"),
        F.when(F.col("id") % 3 == 0, "view").when(F.col("id") % 11 == 0, "buy").otherwise("click").alias("kind"))


def test_sketches_of_days_merge_within_the_error(spark, tmp_dir):
    df, path = days(spark), f"{tmp_dir}/sketches"
    SK.add_days(SK.day_sketches(df.where("day < '2024-01-05'"), F.col("day"), "user", "kind"), path)
    first = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/day=*/*.parquet")}
    SK.add_days(SK.day_sketches(df.where("day = '2024-01-05'"), F.col("day"), "user", "kind"), path)
    now = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/day=*/*.parquet")}
    assert len(first) == 4 and len(now) == 5 and all(now[f] == t for f, t in first.items())       # earlier days untouched
    for where in ("true", "day >= '2024-01-04'"):
        got = SK.merged(SK.read_days(spark, path).where(where)).first()
        exact = df.where(where).agg(F.count("*"), F.count_distinct("user")).first()
        assert got.n == exact[0] and abs(got.n_distinct - exact[1]) <= 3 * SK.standard_error() * exact[1]
        counts = {r.kind: r["count"] for r in df.where(where).groupBy("kind").count().collect()}
        assert {t["item"]: t["count"] for t in got.top} == counts
    SK.add_days(SK.day_sketches(df.where("day = '2024-01-05'"), F.col("day"), "user", "kind"), path)   # a day again: replaced
    assert SK.merged(SK.read_days(spark, path)).first().n == 60_000
