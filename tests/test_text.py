from pyspark.sql import functions as F

from voyra.functions import text as X


def one(spark, expr, value, schema="s STRING"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_text_order_and_idempotent(spark):
    raw = "<em>Great</em> view \U0001F44D <!--red_beg-->café<!--red_end-->\nJul 2021 • Family"
    once = one(spark, X.clean_text(F.col("s")), raw)
    assert once == "Great view :thumbs_up: cafJul 2021  Family"
    assert one(spark, X.clean_text(F.col("s")), once) == once
    assert one(spark, X.clean_text(F.col("s"), enabled=False), raw) == raw


def test_ascii_filter_removes_above_126_and_controls(spark):
    assert one(spark, X.ascii_filter(F.col("s")), "a\u007fbéc\td~") == "abcd~"


def test_demojize_variation_selector(spark):
    assert one(spark, X.demojize(F.col("s")), "I ❤️ it ❤") == "I :red_heart: it :red_heart:"


def test_safe_name_apostrophe_comma_backslash_kept(spark):
    assert one(spark, X.safe_name(F.col("s")), "St. Paul's, \"Cathedral\"?<>|*:/\\") == "St. Pauls Cathedral\\"


def test_comma_int_and_digits(spark):
    assert one(spark, X.comma_int(F.col("s")), "52,910") == 52910
    assert one(spark, X.comma_int(F.col("s")), "n/a") is None
    assert one(spark, X.to_int(X.digits_only(F.col("s"))), "1,234 reviews") == 1234


def test_page_count_modes_on_exact_multiples(spark):
    rows = spark.createDataFrame([(0,), (9,), (10,), (11,), (30,)], "n LONG")
    got = rows.select("n", X.page_count("n", 10, "ceil").alias("c"), X.page_count("n", 10, "floor").alias("f"),
                      X.page_count("n", 10, "floor_plus_one").alias("p")).orderBy("n").collect()
    assert [(r.n, r.c, r.f, r.p) for r in got] == [(0, 0, 0, 1), (9, 1, 0, 1), (10, 1, 1, 2), (11, 2, 1, 2),
                                                  (30, 3, 3, 4)]


def test_split_labels_not_trimmed(spark):
    assert one(spark, X.split_labels(F.col("s")), "Parks & Gardens&Sights ") == ["Parks ", " Gardens", "Sights "]


def test_split_visit_all_forms(spark):
    df = spark.createDataFrame([("Jul 2021  Family",), ("Jul 2021 • Couples",), ("Mar 2019",), ("NONE",),
                                ("Jul 2021  Solo  extra",), (None,)], "s STRING")
    v = X.split_visit("s")
    got = [tuple(r) for r in df.select(v["time"], v["type"], v["extra"], X.visit_month(v["time"]).cast("string")).collect()]
    assert got == [("Jul 2021", "Family", False, "2021-07-01"), ("Jul 2021", "Couples", False, "2021-07-01"),
                   ("Mar 2019", None, False, "2019-03-01"), (None, None, False, None),
                   ("Jul 2021", "Solo  extra", True, "2021-07-01"), (None, None, None, None)]
