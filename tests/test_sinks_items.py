"""Sinks (read back), item projection, routing and page quarantine."""

import glob
import json
import os

import pytest

from voyra.operators import items
from voyra.sinks import files as sinks
from voyra.sources import files as src


def test_csv_round_trip_keeps_quotes_commas_newlines_and_spaces(spark, tmp_dir):
    rows = [(1, ' lead and trail ', "x", 0), (2, 'say "hi", then\nleave', "y", 1), (3, "", "z", None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, input STRING, output STRING, target INT")
    path = sinks.write_csv(df, f"{tmp_dir}/csv")
    back = {r.doc_id: tuple(r)[1:] for r in src.read_labelled_csv(spark, path).collect()}
    assert back[1] == (" lead and trail ", "x", 0)
    assert back[2] == ('say "hi", then\nleave', "y", 1)
    assert back[3][1:] == ("z", None)


def test_batches_at_most_ten_per_file(spark, tmp_dir):
    df = spark.range(95).withColumnRenamed("id", "k")
    sinks.write_json(df.repartition(1), f"{tmp_dir}/b", max_records=10)
    files = glob.glob(f"{tmp_dir}/b/*.json")
    sizes = sorted(sum(1 for _ in open(f)) for f in files)
    assert sum(sizes) == 95 and max(sizes) == 10 and len(files) == 10


def test_partitioned_json_dynamic_overwrite(spark, tmp_dir):
    path = f"{tmp_dir}/p"
    a = spark.createDataFrame([("x", 1), ("y", 2)], "attr_name STRING, v INT")
    sinks.write_json(a, path, partition_by=["attr_name"])
    b = spark.createDataFrame([("y", 3)], "attr_name STRING, v INT")
    sinks.write_json(b, path, partition_by=["attr_name"])       # replaces folder y only
    got = sorted(map(tuple, spark.read.json(path).select("attr_name", "v").collect()))
    assert got == [("x", 1), ("y", 3)]
    assert sorted(d for d in os.listdir(path) if not d.startswith("_")) == ["attr_name=x", "attr_name=y"]


def test_append_keeps_both_runs(spark, tmp_dir):
    df = spark.range(3)
    sinks.write_json(df, f"{tmp_dir}/a", mode="append")
    sinks.write_json(df, f"{tmp_dir}/a", mode="append")
    assert spark.read.json(f"{tmp_dir}/a").count() == 6
    for f in glob.glob(f"{tmp_dir}/a/*.json"):
        for line in open(f):
            json.loads(line)                                     # every line parses alone


def test_item_project_rejects_undeclared_and_missing(spark):
    df = spark.createDataFrame([("a", 1, 2, "t", None, None, "r", "extra")],
                               "attr_name STRING, attr_page INT, review_id INT, title STRING, visit_month DATE, "
                               "companion STRING, review STRING, lang STRING")
    with pytest.raises(items.UndeclaredField):
        items.item_project(df, items.FLAT_REVIEW)
    assert items.item_project(df, items.FLAT_REVIEW, extra="drop").columns == [f.name for f in items.FLAT_REVIEW]
    with pytest.raises(items.UndeclaredField):
        items.item_project(df.drop("title"), items.FLAT_REVIEW, extra="drop")


def test_route_sends_every_record_once(spark):
    df = spark.createDataFrame([("user",), ("assistant",), ("system",), (None,), ("tool",)], "role STRING")
    tagged = df.select("role", items.kind_of("role").alias("kind"))
    routed = items.route(tagged, "kind", ["review", "info"])
    counts = {k: v.count() for k, v in routed.items()}
    assert counts == {"review": 1, "info": 1, "_unrouted": 3}


def test_read_page_files_whole_text(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/site/a")
    with open(f"{tmp_dir}/site/a/p1.html", "w") as f:
        f.write("<html>\n<h1>One</h1>\n</html>")
    with open(f"{tmp_dir}/site/p2.html", "w") as f:
        f.write("<h1>Two</h1>")
    with open(f"{tmp_dir}/site/notes.txt", "w") as f:
        f.write("skip me")
    got = {os.path.basename(r.url): r.html for r in src.read_page_files(spark, f"{tmp_dir}/site").collect()}
    assert got == {"p1.html": "<html>\n<h1>One</h1>\n</html>", "p2.html": "<h1>Two</h1>"}


def test_write_routed_one_folder_per_kind(spark, tmp_dir):
    df = spark.createDataFrame([(1, "review"), (2, "info"), (3, "review")], "id INT, kind STRING")
    path = sinks.write_routed(df, "kind", f"{tmp_dir}/r")
    assert sorted(d for d in os.listdir(path) if not d.startswith("_")) == ["kind=info", "kind=review"]
    assert sorted(map(tuple, spark.read.json(path).select("id", "kind").collect())) == \
        [(1, "review"), (2, "info"), (3, "review")]


def test_quarantine_at_page_grain(spark):
    rec = spark.createDataFrame([("p", 0, False), ("p", 0, True), ("p", 1, False)], "a STRING, pg INT, bad BOOLEAN")
    got = {r.pg: r.status for r in items.quarantine_pages(rec, ["a", "pg"], "bad").collect()}
    assert got == {0: "bad", 1: "good"}
