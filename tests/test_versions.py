"""Versioned tables: whole commits or none, replays, buckets, cleaning."""

import os

import pytest
from pyspark.sql import functions as F

from voyra.operators import tasks as TK
from voyra.sinks import versions
from voyra.sinks.versions import ConcurrentCommit, Merge, Store
from voyra.streaming import ingest as ST


def rows(spark, *data):
    return spark.createDataFrame(list(data), "k string, n long, v string")


def table(store, name="t", number=None):
    return sorted(tuple(r) for r in store.read(name, number).collect())


def test_merge_replaces_rows_of_the_key_and_keeps_versions(spark, tmp_dir):
    store = Store(spark, f"{tmp_dir}/s")
    assert not store.has("t") and store.version().number == 0
    assert store.commit({"t": Merge(rows(spark, ("a", 1, "x"), ("b", 1, "y"), (None, 1, "z")))}, {"t": ["k", "n"]}) == 1
    # columns by name, in any order; null keys meet null keys
    more = rows(spark, ("b", 1, "Y"), ("c", 2, None), (None, 1, "Z")).select("v", "n", "k")
    assert store.commit({"t": Merge(more)}) == 2
    assert sorted(map(str, store.read("t").collect())) == sorted(map(str, rows(
        spark, ("a", 1, "x"), ("b", 1, "Y"), ("c", 2, None), (None, 1, "Z")).collect()))
    assert store.read("t", 1).count() == 3 and store.read("t", 1).where("v = 'y'").count() == 1
    empty = rows(spark, ("a", 1, "x")).limit(0)
    assert store.commit({"t": Merge(empty), "u": Merge(empty)}, {"u": ["k"]}) == 3
    assert store.read("t").count() == 4 and store.read("u").count() == 0


def test_only_touched_buckets_are_written(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(versions, "BUCKET_ROWS", 100)
    store = Store(spark, f"{tmp_dir}/s")
    big = spark.range(3000).selectExpr("id AS k", "id * 2 AS v")
    store.commit({"t": Merge(big)}, {"t": ["k"]})
    first = store.version().tables["t"]
    assert first.buckets == 30 and sum(first.rows.values()) == 3000 and len(first.folders) > 20
    store.commit({"t": Merge(spark.range(5, 7).selectExpr("id AS k", "-1L AS v"))})
    second = store.version().tables["t"]
    changed = {b for b in second.folders if second.folders[b] != first.folders[b]}
    assert 1 <= len(changed) <= 2 and second.rows == first.rows
    assert store.read("t").where("v = -1").count() == 2 and store.read("t").count() == 3000


def test_a_grown_table_is_dealt_out_again(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(versions, "BUCKET_ROWS", 10)
    store = Store(spark, f"{tmp_dir}/s")
    store.commit({"t": Merge(spark.range(5).selectExpr("id AS k", "id AS v"))}, {"t": ["k"]})
    assert store.version().tables["t"].buckets == 1
    store.commit({"t": Merge(spark.range(5, 300).selectExpr("id AS k", "id AS v"))})
    store.commit({"t": Merge(spark.range(300, 301).selectExpr("id AS k", "id AS v"))})
    t = store.version().tables["t"]
    assert t.buckets == 30 and sum(t.rows.values()) == 301
    assert [r.k for r in store.read("t").orderBy("k").collect()] == list(range(301))


def test_a_writer_that_dies_between_write_and_publish(spark, tmp_dir, monkeypatch):
    """Every task is still there, the failed commit isn't seen, and running it again works."""
    path = f"{tmp_dir}/tasks"
    seeds = spark.createDataFrame([("a", 500), ("b", 70)], "attr_name STRING, n LONG")
    url = lambda a, p: F.concat(a, F.lit("/"), p.cast("string"))
    before = sorted(TK.task_init(spark, seeds, "n", url, path).collect())
    assert len(before) == 57
    status = spark.createDataFrame([("a", 3, True), ("b", 1, False), ("zz", 0, True)], "attr_name string, page long, done boolean")

    def die(self, version):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", die)
        with pytest.raises(OSError):
            TK.complete_pages(spark, status, path)
    assert sorted(TK.read_tasks(spark, path).collect()) == before
    done = TK.complete_pages(spark, status, path)
    assert [(r.attr_name, r.page) for r in done.where("complete").collect()] == [("a", 3)] and done.count() == 57
    # the left-over folder of the failed commit goes with the cleaning, what is read stays
    gone = Store(spark, path).vacuum(keep=1)
    assert len(gone) >= 2 and TK.read_tasks(spark, path).count() == 57
    assert Store(spark, path).numbers() == [2]


def test_two_writers_of_one_version(spark, tmp_dir):
    one, two = Store(spark, f"{tmp_dir}/s"), Store(spark, f"{tmp_dir}/s")
    one.commit({"t": Merge(rows(spark, ("a", 1, "x")))}, {"t": ["k"]})
    stale = two.version()
    one.commit({"t": Merge(rows(spark, ("b", 1, "x")))})
    two.version = lambda number=None: stale              # began before the other's commit
    with pytest.raises(ConcurrentCommit):
        two.commit({"t": Merge(rows(spark, ("c", 1, "x")))})
    assert [r.k for r in one.read("t").orderBy("k").collect()] == ["a", "b"]
    assert not [f for f in os.listdir(f"{tmp_dir}/s/versions") if "draft" in f and not f.endswith(".crc")]


def test_a_batch_is_applied_once(spark, tmp_dir):
    store = Store(spark, f"{tmp_dir}/s")
    for _ in range(2):
        assert store.commit({"t": Merge(rows(spark, ("a", 1, "x")))}, {"t": ["k"]}, batch=("q", 0)) == 1
    assert store.commit({"t": Merge(rows(spark, ("a", 1, "other")))}, batch=("q", 0)) == 1
    assert store.commit({"t": Merge(rows(spark, ("a", 2, "new")))}, batch=("q", 1)) == 2
    assert store.commit({"t": Merge(rows(spark, ("a", 1, "late")))}, batch=("other", 0)) == 3
    assert table(store) == [("a", 1, "late")]


def page_stream(spark, landing):
    return ST.file_stream(spark, landing + "/*", schema="attr_name STRING, attr_page LONG, body STRING", max_files=1)


def land(spark, landing, step, *data):
    spark.createDataFrame(list(data), "attr_name string, attr_page long, body string").coalesce(1).write.parquet(f"{landing}/{step}")


@pytest.mark.parametrize("when", ["before publish", "after publish"])
def test_pages_and_tasks_when_a_run_dies(spark, tmp_dir, monkeypatch, when):
    """A crash between the documents and the marks repeats no page and loses none."""
    store, landing, ckpt = Store(spark, f"{tmp_dir}/s"), f"{tmp_dir}/in", f"{tmp_dir}/ckpt"
    seeds = spark.createDataFrame([("a", 30), ("b", 20)], "attr_name STRING, n LONG")
    TK.task_init(spark, seeds, "n", lambda a, p: F.concat(a, p.cast("string")), store.path)
    land(spark, landing, 0, ("a", 0, "x"), ("b", 1, "y"))
    parse = lambda b: b.select("attr_name", "attr_page", F.upper("body").alias("body"))
    publish = Store._publish

    def dying(self, version):
        if when == "after publish":
            publish(self, version)
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", dying)
        with pytest.raises(Exception, match="lost"):
            ST.pages_and_tasks(page_stream(spark, landing), store, ckpt, parse)

    def state():
        docs = sorted(tuple(r) for r in store.read("pages").collect()) if store.has("pages") else []
        done = sorted((r.attr_name, r.page) for r in store.read("tasks").where("complete").collect())
        return docs, done
    docs, done = state()
    assert [d[:2] for d in docs] == done == ([] if when == "before publish" else [("a", 0), ("b", 1)])
    land(spark, landing, 1, ("a", 2, "z"))
    ST.pages_and_tasks(page_stream(spark, landing), store, ckpt, parse)
    assert state() == ([("a", 0, "X"), ("a", 2, "Z"), ("b", 1, "Y")], [("a", 0), ("a", 2), ("b", 1)])
    number = store.version().number
    ST.pages_and_tasks(page_stream(spark, landing), store, ckpt, parse)      # nothing new
    assert store.version().number == number and store.read("tasks").count() == 5
    # a second stream over the same store counts its batches by itself
    other = f"{tmp_dir}/in2"
    land(spark, other, 0, ("b", 0, "w"))
    ST.pages_and_tasks(page_stream(spark, other), store, f"{tmp_dir}/ckpt2", parse)
    assert ("b", 0) in state()[1] and len(state()[0]) == 4


def test_stored_rows_are_not_written_again(spark, tmp_path, monkeypatch):
    from voyra.sinks import versions as V
    made, fresh = [], V.scratch_dir
    monkeypatch.setattr(V, "scratch_dir", lambda *a: made.append(a[1]) or fresh(*a))
    store = V.Store(spark, str(tmp_path / "store"))
    for k, rows in enumerate(([(1, "a"), (2, "b")], [(2, "c"), (3, "d")])):
        spark.createDataFrame(rows, "id long, v string").write.parquet(str(tmp_path / f"in{k}"))
        store.commit({"t": V.Merge(spark.read.parquet(str(tmp_path / f"in{k}")), stored=True)}, {"t": ["id"]})
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "a"), (2, "c"), (3, "d")] and made == []
