"""Numbering by ranges and trees of prefix sums against the plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from voyra.operators import numbering as N


def numbered(df, keys, order, out="s"):
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w) - 1)


def same(a, b):
    key = lambda r: tuple(map(str, r))
    return sorted(map(key, a.collect())) == sorted(map(key, b.select(*a.columns).collect()))


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_prefix_sums_are_the_window(spark, monkeypatch, bits):
    """With two or four neighbours a sum the tree has up to eleven levels."""
    monkeypatch.setattr(N, "FAN_BITS", bits)
    counts = spark.range(900).selectExpr("if(id % 3 = 0, null, id % 2) AS k", "id * id % 2000 AS at", "id % 7 AS n") \
        .groupBy("k", "at").agg(F.sum("n").alias("n"))
    keyed, key = N._keyed(counts, ["k"])
    got = N.prefix_sums(keyed, key, "at", "n", 2000, "before").select(F.col("_vkey.k").alias("k"), "at", "n", "before")
    w = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    assert same(got, counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))))


def windows(df):
    """Partition columns of each window in the plan."""
    plan = df._jdf.queryExecution().optimizedPlan()
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Window":
            out.append(node.partitionSpec().size())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_ten_million_ranges_without_a_long_window(spark):
    """No window takes more than 1,024 rows: 10,000,000 ranges are three levels."""
    span = 10_000_000
    counts = spark.range(0, span, 997).selectExpr("id AS at", "1L AS n")
    got = N.prefix_sums(counts, [], "at", "n", span, "before")
    assert sorted(windows(got)) == [0, 1, 1]
    top = counts.selectExpr("shiftright(at, 20) AS top").distinct().count()
    assert top <= 1 << N.FAN_BITS
    r = got.agg(F.max(F.abs(F.col("before") - F.expr("at div 997"))), F.count("*")).first()
    assert tuple(r) == (0, -(-span // 997))


def test_one_user_with_a_third_of_the_events(spark):
    events = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id % 997) AS user", "(id * 7919) % 1000 AS ts", "id")
    assert same(N.seq_number(events, ["user"], ["ts", "id"], out="s"), numbered(events, ["user"], ["ts", "id"]))
    pieces = events.repartitionByRange(8, "user", "ts", "id").select("user", F.spark_partition_id().alias("p")).where("user = 7")
    assert pieces.distinct().count() >= 3                # the hot key is cut over tasks


@pytest.mark.parametrize("ids", ["xxhash64(id)", "id * id * 1000003 - 5000000000000", "id", "id - 40000",
                                 "if(id = 0, 9000000000000000000, id)", "if(id = 0, -9000000000000000000, id)"])
def test_ids_far_apart_and_close_together(spark, ids):
    """Hashed ids, growing gaps, dense ids, below zero, and one that lies far off."""
    rows = spark.range(20_000).selectExpr(f"{ids} AS id", "if(id % 3 = 0, null, cast(id % 5 as string)) AS k", "'x' AS other")
    for keys in ([], ["k"]):
        assert same(N.number_by_id(rows, keys, "id", "s"), numbered(rows, keys, ["id"]))


def test_buckets_of_longs(spark):
    ids = [-(1 << 63), -65537, -65536, -1, 0, 65535, 65536, (1 << 53) + 1, (1 << 63) - 1]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "id long").select(N.id_bucket("id")).collect()]
    assert got == [i // 65536 for i in ids]


def test_empty_and_single_rows_and_null_ids(spark):
    none = spark.createDataFrame([], "k string, id long")
    assert N.number_by_id(none, ["k"], "id").count() == N.number_by_id(none, [], "id").count() == 0
    rows = spark.createDataFrame([("a", None), ("a", 3), ("a", 5), (None, None)], "k string, id long")
    assert same(N.number_by_id(rows, ["k"], "id", "s"), numbered(rows, ["k"], ["id"]))


def test_codes_of_names_that_begin_alike(spark):
    from voyra.operators.labels import category_codes
    names = spark.range(5000).selectExpr("concat('the same long beginning of a name ', id % 700) AS name")
    got = {r["name"]: r["code"] for r in category_codes(names, "name").collect()}
    assert got == {n: i for i, n in enumerate(sorted(got))} and len(got) == 700
