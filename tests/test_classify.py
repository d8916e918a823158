"""Classification: toy naive Bayes by hand, split properties, report."""

import math

import pytest
from pyspark.sql import functions as F

from voyra.operators import classify as C
from voyra.operators import labels as L

TRAIN = [(1, "sunny park walk", "outdoor"), (2, "park lake sunny", "outdoor"),
         (3, "museum art gallery", "indoor"), (4, "gallery paintings art art", "indoor"),
         (5, "stadium match", "sport")]


def test_naive_bayes_matches_hand_computation(spark, tmp_dir):
    train = spark.createDataFrame(TRAIN, "doc_id LONG, text STRING, label STRING")
    model = C.nb_fit(train, f"{tmp_dir}/nb")
    test = spark.createDataFrame([(9, "Art park, ART!", "indoor"), (10, "zzz unknown", "sport")],
                                 "doc_id LONG, text STRING, label STRING")
    scores = {r.cls: r.score for r in C.nb_scores(model, test).where("doc_id = 9").collect()}
    vocab = {t for _, s, _ in TRAIN for t in s.split()}
    tok = {c: sum(len(s.split()) for _, s, l in TRAIN if l == c) for c in ("outdoor", "indoor", "sport")}
    cnt = {("indoor", "art"): 3, ("outdoor", "park"): 2}
    for c in tok:
        want = math.log(sum(1 for *_, l in TRAIN if l == c) / 5)
        for t in ["art", "park", "art"]:
            want += math.log((cnt.get((c, t), 0) + 1) / (tok[c] + len(vocab)))
        assert abs(scores[c] - want) < 1e-9
    preds = {r.doc_id: r for r in C.nb_predict(model, test).collect()}
    p = preds[9]
    assert p.prediction == "indoor" and 0 < p.p_true < 1 and abs(p.loss + math.log(p.p_true)) < 1e-9
    # no token in the vocabulary: the prior decides (ties to the smaller name)
    assert preds[10].prediction == "indoor" and abs(preds[10].p_true - 0.2) < 1e-9


def test_tokens_cap_and_case(spark):
    df = spark.createDataFrame([("Ça va? ÇA  va-bien " + "x " * 600,)], "text STRING")
    t = df.select(C.tokens("text")).first()[0]
    assert t[:4] == ["ça", "va", "ça", "va"] and len(t) == 512


def test_split_is_partition_and_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id").withColumn("part", L.split_part("doc_id"))
    parts = {r.part: r["count"] for r in df.groupBy("part").count().collect()}
    assert sum(parts.values()) == 2000 and set(parts) == {"train", "test"}
    assert 0.5 < parts["train"] / 2000 < 0.7
    again = df.withColumn("p2", L.split_part("doc_id")).where("part <> p2").count()
    assert again == 0


def test_class_report(spark):
    preds = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "label STRING, prediction STRING")
    r = {x["class"]: x for x in C.class_report(preds).collect()}
    assert r["a"].precision == 1.0 and r["a"].recall == 0.5 and r["a"].support == 2
    assert abs(r["b"].precision - 1 / 3) < 1e-12 and r["b"].recall == 1.0
    assert r["c"].precision == 0.0 and r["c"].f1 == 0.0 and r["c"].support == 1


def test_category_codes_alphabetical(spark):
    df = spark.createDataFrame([("zoo",), ("art",), ("Park",), ("art",), (None,)], "n STRING")
    got = {r.n: r.code for r in L.category_codes(df, "n").collect()}
    assert got == {"Park": 0, "art": 1, "zoo": 2}


def test_random_split_and_distinct_counts(spark):
    from voyra.operators.profile import distinct_counts
    df = spark.range(5000).withColumnRenamed("id", "doc_id").withColumn("g", F.col("doc_id") % 37)
    a, b = L.random_split(df, 0.6, seed=7)
    ids_a, ids_b = {r.doc_id for r in a.collect()}, {r.doc_id for r in b.collect()}
    assert not ids_a & ids_b and len(ids_a | ids_b) == 5000
    exact = distinct_counts(df, ["g", "doc_id"]).first()
    approx = distinct_counts(df, ["g", "doc_id"], approx=True).first()
    assert (exact.g, exact.doc_id) == (37, 5000)
    assert abs(approx.doc_id - 5000) < 0.05 * 5000 and approx.g == 37


def test_naive_bayes_of_odd_texts_and_classes(spark, tmp_dir):
    """Empty and null texts, a class without tokens, null labels, repeated ids, no training rows."""
    schema = "doc_id LONG, text STRING, label STRING"
    train = spark.createDataFrame(TRAIN + [(6, None, "empty"), (7, "", "empty"), (8, "park", None)], schema)
    model = C.nb_fit(train, f"{tmp_dir}/nb")
    assert [c[0] for c in model.classes] == ["empty", "indoor", "outdoor", "sport"]
    test = spark.createDataFrame([(1, "art art", "indoor"), (2, None, "sport"), (2, None, "sport"), (3, "zzz", None), (4, "", "other")], schema)
    got = {r.doc_id: r for r in C.nb_predict(model, test).collect()}
    assert got[1].prediction == "indoor" and set(got) == {1, 2, 3, 4}
    assert got[2].prediction == "empty" and abs(got[2].p_true - 1 / 7) < 1e-9         # the priors decide: 2, 2, 2 and 1 of 7
    assert got[3].loss is None and got[4].p_true is None
    none = C.nb_fit(train.limit(0), f"{tmp_dir}/none")
    assert none.classes == [] and [r.prediction for r in C.nb_predict(none, test.where("doc_id = 1")).collect()] == [None]


def test_tokens_are_counted_in_one_shuffle(spark):
    docs = spark.createDataFrame([(i, "a b a " * i, "x") for i in range(5)], "doc_id LONG, text STRING, label STRING")
    counts = C.token_counts(docs, ["doc_id", "label"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    got = [(r.doc_id, r.token, r.n) for r in counts.collect()]
    assert [x for x in got if x[1][0] == " "] == [(0, got[[x[0] for x in got].index(0)][1], 0)]
    assert {x for x in got if x[0]} == {(i, t, i * (2 if t == "a" else 1)) for i in range(1, 5) for t in "ab"}
    hot = spark.createDataFrame([(7, "a b", "x")] * 400, docs.schema)          # one id holds all rows
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    parts = C.token_counts(hot, ["doc_id"]).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    spark.conf.unset(coalesce)
    assert len(parts) >= 4 and sum(r["count"] for r in parts) == 800


def sgd_rows():
    import numpy as np
    rng = np.random.default_rng(0)
    words = {c: [f"{c}{i}" for i in range(15)] for c in "xyz"}
    rows = []
    for i in range(240):
        c = "xyz"[i % 3]
        rows.append((i, " ".join(rng.choice(words[c] + ["the", "of", "and"] * 4, 12)), c))
    return rows + [(900, None, "x"), (901, "", "y"), (902, "x1 x2", None)]


def test_sgd_against_numpy(spark):
    """Every step's gradient, batch and rate, by plain loops over dense rows."""
    import numpy as np
    from voyra.operators import sgd as G
    schema = "doc_id LONG, text STRING, label STRING"
    df = spark.createDataFrame(sgd_rows(), schema).repartition(3)
    k, epochs, size, rate, seed = 64, 2, 100, 3.0, 5
    rows = [r for r in df.select("*", *[F.pmod(F.xxhash64(F.lit(seed), F.lit(e), "doc_id"), F.lit(3)).alias(f"b{e}") for e in range(epochs)]).collect() if r.label]
    bucket = {t: b for t, b in df.select(F.explode(C.tokens("text", None)).alias("t")).select("t", F.pmod(F.xxhash64("t"), F.lit(k))).distinct().collect()}
    x = np.zeros((len(rows), k + 1))
    for i, r in enumerate(rows):
        for t in (r.text or "").split():
            x[i, bucket[t]] += 1
        x[i, :k] = np.log1p(x[i, :k])
        x[i, :k] /= max(np.sqrt((x[i, :k] ** 2).sum()), 1e-300)
        x[i, k] = 1
    y = np.array(["xyz".index(r.label) for r in rows])
    w = np.zeros((3, k + 1))
    steps = 3 * epochs
    for s in range(steps):
        e, b = divmod(s, 3)
        mine = np.array([r[f"b{e}"] == b for r in rows])
        p = G.softmax(x[mine] @ w.T)
        p[np.arange(mine.sum()), y[mine]] -= 1
        t = (s + 0.5) / steps
        w = w - rate * (t / 0.3 if t < 0.3 else (1 - t) / 0.7) * (p.T @ x[mine]) / mine.sum()
    model = G.fit(df, epochs, size, rate, seed, k)
    assert model.classes == ["x", "y", "z"] and np.allclose(model.weights, w, atol=1e-9)
    got = {r.doc_id: r for r in G.predict(model, df, ["doc_id"]).collect()}
    for i, r in enumerate(rows):
        p = G.softmax(x[i: i + 1] @ w.T)[0]
        assert abs(got[r.doc_id].score - p.max()) < 1e-9 and abs(p["xyz".index(got[r.doc_id].prediction)] - p.max()) < 1e-12


def test_sgd_parameters_act(spark):
    import numpy as np
    from voyra.operators import sgd as G
    df = spark.createDataFrame(sgd_rows(), "doc_id LONG, text STRING, label STRING")

    def accuracy(model):
        got = G.predict(model, df.where("label IS NOT NULL"), ["doc_id", "label"]).collect()
        return np.mean([r.prediction == r.label for r in got])
    base = G.fit(df, 2, 64, 3.0, num_features=256)
    assert accuracy(base) >= 0.95
    again = G.fit(df.repartition(5), 2, 64, 3.0, num_features=256)
    assert np.allclose(base.weights, again.weights, atol=1e-9)
    for other in (G.fit(df, 1, 64, 3.0, num_features=256), G.fit(df, 2, 243, 3.0, num_features=256), G.fit(df, 2, 64, 0.01, num_features=256),
                  G.fit(df, 2, 64, 3.0, seed=1, num_features=256)):
        assert not np.allclose(base.weights, other.weights, atol=1e-6)
    assert np.abs(G.fit(df, 2, 64, 0.01, num_features=256).weights).max() < np.abs(base.weights).max() / 10
    one = G.fit(df.where("label = 'x'"), 1, 64, 3.0, num_features=16)
    assert one.classes == ["x"] and [r.prediction for r in G.predict(one, df.limit(1), ["doc_id"]).collect()] == ["x"]
    none = G.fit(df.limit(0), 1, 64, 3.0, num_features=16)
    assert none.classes == [] and G.predict(none, df.limit(2), ["doc_id"]).count() == 2


def test_features_of_a_text_are_one_row_from_where_it_is_cut(spark):
    """Counts of single tokens are not shuffled, and no expression goes over a text once for each of its entries; rows that
    agree in their keys are one text, in a batch or over several."""
    import collections
    from voyra.operators import sgd as G
    rows = [(i, f"a b a c w{i}", "x") for i in range(40)] + [(7, "b z", "x"), (7, None, "x"), (7, "b", "y"), (50, None, "x"), (51, " .", None)]
    rows += [(None, f"q a v{i % 3}", "x") for i in range(30)] + [(None, "q", None), (None, "a q", None)]
    df, k = spark.createDataFrame(rows, "doc_id LONG, text STRING, label STRING").repartition(5), 64
    bucket = {r.t: r.b for r in df.select(F.explode(C.tokens("text", None)).alias("t")).select("t", F.pmod(F.xxhash64("t"), F.lit(k)).alias("b")).distinct().collect()}
    want = {(i, label): collections.Counter() for i, _, label in rows}
    for i, text, label in rows:
        want[i, label].update(bucket[t] for t in (text or "").replace(".", "").split())
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("2", old):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            x = G.features(df, ["doc_id", "label"], num_features=k)
            plan, got = x._jdf.queryExecution().executedPlan().toString(), x.collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
        assert "Aggregate" not in plan and "aggregate(" not in plan and plan.count("MapInArrow") == 2
        assert len(got) == len(want) and {(r.doc_id, r.label) for r in got} == set(want)
        for r in got:
            n = want[r.doc_id, r.label]
            v = [math.log1p(n[b]) for b in sorted(n)]
            assert r["at"] == sorted(n) and r["x"] == pytest.approx([y / math.sqrt(sum(z * z for z in v)) for y in v])


def test_gradient_sums_are_a_tree(spark, monkeypatch):
    import numpy as np
    from voyra.operators import sgd as G
    monkeypatch.setattr(G, "FAN", 2)
    rows = G.features(spark.createDataFrame(sgd_rows()[:60], "doc_id LONG, text STRING, label STRING"), ["doc_id"], num_features=32) \
        .withColumn("cls", F.lit(1).cast("long")).repartition(9)
    w = np.ones((2, 33)) * 0.1
    g, n = G._summed(rows, w, rows.rdd.getNumPartitions())
    import pyarrow as pa
    whole = pa.Table.from_batches([pa.RecordBatch.from_pylist([r.asDict() for r in rows.collect()], schema=pa.schema(
        [("doc_id", pa.int64()), ("at", pa.list_(pa.int32())), ("x", pa.list_(pa.float64())), ("cls", pa.int64())]))])
    assert n == 60 and np.allclose(g, G.gradient(whole, w))


def test_sgd_jobs_do_not_grow_with_batches(spark, monkeypatch):
    """An epoch is one pass, however many batches it has; every shard learns, and a text counts once."""
    import numpy as np
    from voyra.operators import sgd as G
    df = spark.createDataFrame(sgd_rows(), "doc_id LONG, text STRING, label STRING")
    trees, tree = [], G._tree
    monkeypatch.setattr(G, "_tree", lambda *a: trees.append(tree(*a)) or trees[-1])
    monkeypatch.setattr(G, "STEPS", 2)
    model = G.fit(df, 3, 10, 3.0, num_features=256)                       # 25 batches, 13 shards
    assert [n for _, n in trees] == [242, 242, 242]
    again = G.fit(df.repartition(5), 3, 10, 3.0, num_features=256)
    assert np.allclose(model.weights, again.weights, atol=1e-9)
    got = G.predict(model, df.where("label IS NOT NULL"), ["label"]).collect()
    assert np.mean([r.prediction == r.label for r in got]) >= 0.95


def test_token_counts_hold_a_batch_of_texts_only(spark):
    """No aggregate over a task's whole share of the texts; the model goes out by its measured size."""
    docs = spark.createDataFrame([(i, "a b a c" if i % 2 else None, "x" if i % 3 else "y") for i in range(20)], "doc_id LONG, text STRING, label STRING")
    counts = C.token_counts(docs, ["doc_id", "label"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "MapInArrow" in plan
    got = sorted((r.doc_id, r.token.split(" ")[0], r.n) for r in counts.collect())
    assert got == sorted([(i, t, n) for i in range(1, 20, 2) for t, n in (("a", 2), ("b", 1), ("c", 1))] + [(i, "", 0) for i in range(0, 20, 2)])
    from voyra.session import scratch_dir
    model = C.nb_fit(docs, scratch_dir(spark, "nb"))
    big = C.NaiveBayes(model.classes, model.weights, C.MODEL_BYTES + 1)
    joins = [C._scored(m, counts, ["doc_id"])._jdf.queryExecution().optimizedPlan().toString() for m in (model, big)]
    assert "broadcast" in joins[0] and "broadcast" not in joins[1]
    assert sorted(map(str, C._scored(model, counts, ["doc_id"]).collect())) == sorted(map(str, C._scored(big, counts, ["doc_id"]).collect()))


def test_a_large_model_shuffles_counts_of_rare_tokens_only(spark, monkeypatch):
    """Weights of frequent tokens go out as far as they are small; documents and sums are those of one model in one piece."""
    from voyra.session import scratch_dir
    texts = ["often often some", "often some rare", "often rarest", "often some", None, "", "of no class", "often some seldom"]
    docs = spark.createDataFrame([(i, t, [None, "x", "y"][i % 3]) for i, t in enumerate(texts)] + [(3, "rare often", "x"), (None, "some some", "y")],
                                 "doc_id LONG, text STRING, label STRING")
    counts = C.token_counts(docs, ["doc_id", "label"])
    train = docs.where("text IS NULL OR text <> 'of no class'")
    one = C.nb_fit(train, scratch_dir(spark, "nb"))
    assert one.split is None
    monkeypatch.setattr(C, "MODEL_BYTES", 200)          # two tokens of two classes
    two = C.nb_fit(train, scratch_dir(spark, "nb"))
    frequent, others = ({r.token for r in w.collect()} for w in two.split)
    assert frequent == {"often", "some"} and others == {r.token for r in one.weights.collect()} - frequent and others
    plan = C._scored(two, counts, ["doc_id", "label"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" in plan and plan.count("strategy=broadcast") == 2
    rows = [{(r.doc_id, r.label): {x.cls: round(x.score, 9) for x in r._s} for r in C._scored(m, counts, ["doc_id", "label"]).collect()} for m in (one, two)]
    assert rows[0] == rows[1] and len(rows[0]) == 10
    monkeypatch.setattr(C, "MODEL_BYTES", 1)            # no token fits
    none = C.nb_fit(train, scratch_dir(spark, "nb"))
    assert none.split[0].count() == 0
    assert {(r.doc_id, r.label): {x.cls: round(x.score, 9) for x in r._s} for r in C._scored(none, counts, ["doc_id", "label"]).collect()} == rows[0]


def test_codes_are_joined_where_the_texts_are(spark, monkeypatch):
    """No shuffle by class, which would put a class with all its texts into one task."""
    from voyra.operators import labels as L
    df = spark.createDataFrame([(i, "t" * 50, "ab"[i % 2] if i % 5 else None) for i in range(40)], "id long, text string, lang string")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    codes = spark.createDataFrame([("a", 0), ("b", 1)], "lang string, code long")
    try:
        for out in (L.attach_codes(df, codes, "lang"), L.attach_names(df.withColumn("code", F.lit(1).cast("long")).drop("lang"), codes, "lang")):
            assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
            assert out.count() == 40
        monkeypatch.setattr(L, "SENT_BYTES", 0)
        assert "SortMergeJoin" in L.attach_codes(df, codes, "lang")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(threshold)
