"""Task state and streaming: init guard, complete, pending, resume, stream = batch."""

import datetime as dt

from pyspark.sql import functions as F

from voyra.operators import tasks as TK
from voyra.sinks.versions import Store
from voyra.streaming import ingest as ST


def url(a, p):
    return F.concat(a, F.lit("/"), p.cast("string"))


def test_task_init_only_once_and_complete(spark, tmp_dir):
    path = f"{tmp_dir}/tasks"
    seeds = spark.createDataFrame([("a", 25), ("b", 10), ("c", 0)], "attr_name STRING, n LONG")
    t = TK.task_init(spark, seeds, "n", url, path)
    assert t.count() == 4 and t.where("complete").count() == 0
    other = spark.createDataFrame([("z", 100)], "attr_name STRING, n LONG")
    assert TK.task_init(spark, other, "n", url, path).count() == 4     # exists: untouched
    # a folder without the commit marker (a run that died while writing) is initialised again
    import os
    half = f"{tmp_dir}/half"
    os.makedirs(f"{half}/_bucket=3")
    assert TK.task_init(spark, seeds, "n", url, half).count() == 4
    ts = dt.datetime(2024, 1, 1)
    attempts = spark.createDataFrame(
        [("a", 0, ts, 1, 0, True), ("a", 0, ts + dt.timedelta(1), 2, 3, False),   # retried, then done
         ("a", 1, ts, 3, 1, False), ("a", 2, ts, 4, 2, True), ("b", 0, ts, 5, 0, True)],
        "attr_name STRING, page LONG, ts TIMESTAMP, event_id LONG, attempt LONG, failed BOOLEAN")
    status = TK.page_status(attempts)
    done = TK.write_task_update(spark, TK.task_complete(t, status), path)
    assert sorted((r.attr_name, r.page) for r in TK.scan_pending(done).collect()) == [("a", 2), ("b", 0)]
    retry = {(r.attr_name, r.page): (r.n_attempts, r.n_failed) for r in TK.retry_queue(status).collect()}
    assert retry == {("a", 2): (1, 1), ("b", 0): (1, 1)}
    # a later run where b's page worked: only its flag flips, a's stay
    later = spark.createDataFrame([("b", 0, ts + dt.timedelta(2), 6, 1, False)], attempts.schema)
    again = TK.write_task_update(spark, TK.task_complete(TK.read_tasks(spark, path), TK.page_status(later)), path)
    assert sorted((r.attr_name, r.page) for r in TK.scan_pending(again).collect()) == [("a", 2)]


def test_stream_resume_and_dedup_across_runs(spark, tmp_dir):
    landing, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    schema = "fp STRING, n LONG"
    spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], schema).write.parquet(f"{landing}/1")
    s = lambda: ST.dedup(ST.file_stream(spark, landing + "/*", schema=schema), "fp")
    ST.ingest(s(), out, ckpt)
    assert sorted(r.fp for r in spark.read.parquet(out).collect()) == ["a", "b"]
    # second run: one new key, one already seen in the first run
    spark.createDataFrame([("b", 4), ("c", 5)], schema).write.parquet(f"{landing}/2")
    ST.ingest(s(), out, ckpt)
    assert sorted(r.fp for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    # third run with nothing new adds nothing
    ST.ingest(s(), out, ckpt)
    assert spark.read.parquet(out).count() == 3


def test_batch_files_over_several_micro_batches(spark, tmp_dir):
    import glob
    landing, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    for i, (lo, hi) in enumerate([(0, 25), (25, 30), (30, 61)]):
        spark.range(lo, hi).withColumnRenamed("id", "doc_id").coalesce(1).write.parquet(f"{landing}/{i}")
    s = ST.file_stream(spark, landing + "/*", schema="doc_id LONG", max_files=1)
    ST.batch_files(s, out, ckpt, order="doc_id", per_file=10)
    back = spark.read.json(out)
    assert back.count() == 61 and back.select("doc_id").distinct().count() == 61
    per_batch = {r.batch_id: (r.n, r.lo, r.hi) for r in back.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect()}
    assert sorted(v[0] for v in per_batch.values()) == [5, 25, 31]
    assert all(lo == 0 and hi == n - 1 for n, lo, hi in per_batch.values())   # numbered per batch
    for f in glob.glob(f"{out}/batch_id=*/*.json"):
        assert sum(1 for _ in open(f)) <= 10


def test_batch_numbers_run_on_over_micro_batches_and_replays(spark, tmp_dir):
    import os
    import shutil
    landing, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def land(*parts):
        for i, lo, hi in parts:
            spark.range(lo, hi).withColumnRenamed("id", "doc_id").coalesce(1).write.parquet(f"{landing}/{i}")
            for f in os.listdir(f"{landing}/{i}"):
                os.utime(f"{landing}/{i}/{f}", (1_700_000_000 + i, 1_700_000_000 + i))

    def run():
        s = ST.file_stream(spark, landing + "/*", schema="doc_id LONG", max_files=1)
        ST.batch_files(s, out, ckpt, order="doc_id", per_file=10, run_on=True)
        return sorted((r.doc_id, r.k, r.batch_id) for r in spark.read.json(out).collect())
    land((0, 0, 25), (1, 25, 30), (2, 30, 61))
    got = run()
    assert [x[:2] for x in got] == [(i, i) for i in range(61)] and len({x[2] for x in got}) == 3
    # a last batch that was written but not committed is run again: the same numbers
    for f in os.listdir(f"{ckpt}/commits"):
        if f in ("2", ".2.crc"):
            os.unlink(f"{ckpt}/commits/{f}")
    shutil.rmtree(f"{out}/batch_id=2")
    assert run() == got
    # a later run goes on where the last one stopped
    land((3, 61, 70))
    assert [x[:2] for x in run()] == [(i, i) for i in range(70)]


def test_stream_batches_equals_its_sql_over_many_files(spark, tmp_dir, monkeypatch):
    from voyra.plans.registry import QUERIES, load_all
    load_all()
    monkeypatch.setattr(ST.file_stream, "__defaults__", (None, None, 2))      # as if a batch ended at two files
    docs = spark.range(83).selectExpr("(id * 37) % 83 AS doc_id", "'t' AS text", "'en' AS lang", "'s' AS source", "id AS n_chars")
    docs.repartition(7).write.parquet(f"{tmp_dir}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["stream_batches"](spark, tmp_dir).collect())
    assert got == [(i, i, i // 10) for i in range(83)]


def test_streaming_task_state_updates_and_reruns(spark, tmp_dir):
    landing, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/state", f"{tmp_dir}/ckpt"
    schema = "task STRING, ts TIMESTAMP, event_id LONG, failed BOOLEAN"
    t0 = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("a", t0, 1, True), ("b", t0, 2, False)], schema).write.parquet(f"{landing}/1")

    def run():
        ST.task_state(ST.file_stream(spark, landing + "/*", schema=schema), out, ckpt)
        return {r.task: (r.done, r.n_attempts, r.n_failed)
                for r in Store(spark, out).read("state").collect()}
    assert run() == {"a": (False, 1, 1), "b": (True, 1, 0)}
    # a retry of a succeeds later; b is untouched
    spark.createDataFrame([("a", t0 + dt.timedelta(1), 3, False)], schema).write.parquet(f"{landing}/2")
    assert run() == {"a": (True, 2, 1), "b": (True, 1, 0)}
    assert run() == {"a": (True, 2, 1), "b": (True, 1, 0)}       # nothing new: same table


def test_stream_equals_batch_on_table(spark, tmp_dir):
    from conftest import SF_SMALL
    from voyra.plans.registry import QUERIES, load_all
    load_all()
    streamed = QUERIES["stream_drain"](spark, SF_SMALL)
    batch = spark.read.parquet(f"{SF_SMALL}/events.parquet").groupBy("event_type").count()
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_follow_chain_with_cycle_and_long_chain(spark):
    from voyra.operators.threads import follow_chain, follow_chain_recursive
    rows = [(1, 0, 1), (1, 1, 2), (1, 2, 1),            # cycle back to page 1
            (2, 0, None)] + [(3, p, p + 1 if p < 149 else None) for p in range(150)]  # 150 pages
    edges = spark.createDataFrame(rows, "conv_id LONG, page LONG, next_page LONG")
    got = {(r.conv_id, r.page): r.depth for r in follow_chain(spark, edges).collect()}
    assert {k: v for k, v in got.items() if k[0] == 1} == {(1, 0): 0, (1, 1): 1, (1, 2): 2}
    assert got[(2, 0)] == 0
    assert len([k for k in got if k[0] == 3]) == 150 and got[(3, 149)] == 149
    small = edges.where("conv_id < 3")
    a = sorted(map(tuple, follow_chain(spark, small).collect()))
    assert a == sorted(map(tuple, follow_chain_recursive(spark, small).collect()))


def test_dedup_within_watermark_on_events(spark, tmp_dir):
    """Bounded-state form: the same key twice within the delay passes once."""
    from conftest import SF_SMALL
    s = ST.file_stream(spark, SF_SMALL, "events").select("event_id", "ts", "user_id")
    twice = s.unionByName(ST.file_stream(spark, SF_SMALL, "events").select("event_id", "ts", "user_id"))
    d = ST.dedup(twice, "event_id", event_time="ts", delay="2 days")
    out, ckpt = f"{tmp_dir}/o", f"{tmp_dir}/c"
    ST.ingest(d, out, ckpt)
    got = spark.read.parquet(out)
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert got.count() == n and got.select("event_id").distinct().count() == n


def test_stream_reads_a_table_of_several_files_like_one_file(spark, tmp_dir):
    from voyra.streaming.ingest import file_stream, ingest
    rows = spark.range(90).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "'<p>' AS html")
    for name, parts in (("one", 1), ("many", 5)):
        rows.repartition(parts).write.parquet(f"{tmp_dir}/{name}/pages.parquet")
        ingest(file_stream(spark, f"{tmp_dir}/{name}", "pages", max_files=2), f"{tmp_dir}/{name}-out", f"{tmp_dir}/{name}-ckpt")
        got = spark.read.parquet(f"{tmp_dir}/{name}-out")
        assert got.count() == 90 and got.select("page_id").distinct().count() == 90


def test_page_keeps_more_than_ten_reviews(spark):
    from voyra.operators.reviews import explode_reviews, page_assemble
    df = spark.range(13).selectExpr("'a' AS attr_name", "1 AS attr_page", "id AS review_id", "'t' AS title",
                                    "'m' AS time", "'k' AS type", "'r' AS review")
    assert explode_reviews(page_assemble(df)).count() == 13
