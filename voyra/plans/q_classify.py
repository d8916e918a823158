"""Queries for text classification and evaluation (SURVEY 2.11, eval_loss and
class_report of 2.5, top_losses of 2.7).

Labelled text = documents, label = lang, split 60/40 by an md5 bucket of the
id. Naive Bayes is exact, and SQL computes the same; of the iterative models SQL
states what must hold for every text (see ``TEST_SQL``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from voyra.operators import classify as C
from voyra.operators import labels as L
from voyra.operators import sgd as SGD
from voyra.plans import entities as E
from voyra.plans import sql as S
from voyra.plans.registry import query
from voyra.session import materialize, scratch_dir
from voyra.sinks import files as sinks
from voyra.sources import files as src
from voyra.sources import tables

ALL_TOKENS_SQL = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
TOKENS_SQL = ALL_TOKENS_SQL + f"[1:{C.MAX_TOKENS}]"       # text_features: the cut is the feature

NB_SQL = S.with_(S.SPLIT) + f""",
toks AS (SELECT doc_id, label, part, unnest({ALL_TOKENS_SQL}) AS token FROM split),
w AS (SELECT token, label AS cls, ln(count(*) + 1) AS w, count(*) AS cnt
      FROM toks WHERE part = 'train' GROUP BY token, label),
vocab AS (SELECT DISTINCT token FROM w),
pc AS (SELECT label AS cls, count(*) AS n_docs FROM split WHERE part = 'train' GROUP BY label),
tc AS (SELECT cls, sum(cnt) AS n_tok FROM w GROUP BY cls),
cstats AS (SELECT pc.cls, ln(pc.n_docs / (SELECT sum(n_docs) FROM pc)) AS prior,
                  ln(coalesce(tc.n_tok, 0) + (SELECT count(*) FROM vocab)) AS denom
           FROM pc LEFT JOIN tc USING (cls)),
dt AS (SELECT doc_id, token, count(*) AS n FROM toks WHERE token IN (SELECT token FROM vocab)
       GROUP BY doc_id, token),
nin AS (SELECT doc_id, sum(n) AS n_in FROM dt GROUP BY doc_id),
sparse AS (SELECT dt.doc_id, w.cls, sum(dt.n * w.w) AS s FROM dt JOIN w USING (token) GROUP BY dt.doc_id, w.cls),
scores AS (SELECT d.doc_id, d.label, d.part, c.cls,
                  c.prior - coalesce(nin.n_in, 0) * c.denom + coalesce(sp.s, 0) AS score
           FROM split d CROSS JOIN cstats c LEFT JOIN nin ON nin.doc_id = d.doc_id
           LEFT JOIN sparse sp ON sp.doc_id = d.doc_id AND sp.cls = c.cls),
agg AS (SELECT doc_id, label, part, max(score) AS mx, arg_min(cls, (-score, cls)) AS prediction,
               max(score) FILTER (WHERE cls = label) AS s_true
        FROM scores GROUP BY doc_id, label, part),
lse AS (SELECT s.doc_id, max(a.mx) + ln(sum(exp(s.score - a.mx))) AS lse
        FROM scores s JOIN agg a USING (doc_id) GROUP BY s.doc_id),
preds AS (SELECT a.doc_id, a.label, a.part, a.prediction, l.lse - a.s_true AS loss
          FROM agg a JOIN lse l USING (doc_id))
"""


def nb_predictions(spark, sf_dir):
    """(doc_id, label, part, prediction, p_true, loss) for every document; tokens are counted once."""
    keep = ["doc_id", "label", "part"]
    d = E.labelled(spark, sf_dir).withColumn("part", L.split_part("doc_id"))
    path = scratch_dir(spark, "token-counts")
    counted = C.token_counts(d, keep)
    counted.write.parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)
    train = F.col("part") == "train"
    model = C.nb_fit_counts(counted.where(train), d.select(*keep).where(train), scratch_dir(spark, "nb-model"))
    return C.nb_predict_counts(model, counted, keep)


@query("text_features", sql=f"""
SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, {TOKENS_SQL} AS t FROM documents)""")
def text_features(spark, sf_dir):
    d = tables.documents(spark, sf_dir, "doc_id", "text")
    t = C.tokens("text")
    return d.select("doc_id", F.size(t).cast("long").alias("n_tokens"),
                    F.size(F.array_distinct(t)).cast("long").alias("n_distinct"),
                    F.md5(F.array_join(t, " ")).alias("tokens_md5"))


@query("classifier_nb", headline=True, sql=NB_SQL + """
SELECT doc_id, label, part, prediction, round(loss, 4) AS loss FROM preds""")
def classifier_nb(spark, sf_dir):
    p = nb_predictions(spark, sf_dir)
    return p.select("doc_id", "label", "part", "prediction", F.round("loss", 4).alias("loss"))


@query("eval_loss", sql=NB_SQL + """
SELECT part, count(*) AS n, round(avg(loss), 4) AS mean_loss,
       round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 4) AS accuracy
FROM preds GROUP BY part""")
def eval_loss(spark, sf_dir):
    p = nb_predictions(spark, sf_dir)
    return p.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("loss"), 4).alias("mean_loss"),
        F.round(F.avg((F.col("prediction") == F.col("label")).cast("double")), 4).alias("accuracy"))


@query("class_report", sql=NB_SQL + """,
conf AS (SELECT label, prediction, count(*) AS n FROM preds WHERE part = 'test' GROUP BY label, prediction),
classes AS (SELECT label AS class FROM conf UNION SELECT prediction AS class FROM conf),
r AS (SELECT c.class,
             coalesce((SELECT sum(n) FROM conf WHERE label = c.class), 0) AS support,
             coalesce((SELECT sum(n) FROM conf WHERE prediction = c.class), 0) AS predicted,
             coalesce((SELECT sum(n) FROM conf WHERE label = c.class AND prediction = c.class), 0) AS tp
      FROM classes c),
pr AS (SELECT class, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM r)
SELECT class, round(p, 4) AS precision, round(r, 4) AS recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 4) AS f1, CAST(support AS BIGINT) AS support
FROM pr""")
def class_report(spark, sf_dir):
    p = nb_predictions(spark, sf_dir).where(F.col("part") == "test")
    r = C.class_report(p)
    return r.select("class", F.round("precision", 4).alias("precision"), F.round("recall", 4).alias("recall"),
                    F.round("f1", 4).alias("f1"), "support")


@query("confusion_matrix", sql=NB_SQL + """
SELECT label, prediction, count(*) AS n FROM preds WHERE part = 'test' GROUP BY label, prediction""")
def confusion_matrix(spark, sf_dir):
    """Test documents by label and prediction."""
    return C.confusion(nb_predictions(spark, sf_dir).where(F.col("part") == "test"))


@query("top_losses", sql=NB_SQL + """
SELECT doc_id, label, prediction, round(loss, 4) AS loss FROM preds WHERE part = 'test'
ORDER BY preds.loss DESC, doc_id LIMIT 5""")
def top_losses(spark, sf_dir):
    p = nb_predictions(spark, sf_dir).where(F.col("part") == "test")
    t = C.top_losses(p, 5)
    return t.select("doc_id", "label", "prediction", F.round("loss", 4).alias("loss"))


@query("label_map", sql=S.with_(S.CODES) + """
SELECT d.doc_id, md5(d.text) AS text_md5, CAST(c.code AS INTEGER) AS label, c.name AS name
FROM documents d JOIN codes c ON d.source = c.name""")
def label_map(spark, sf_dir):
    """Code -> name table over the attraction names, the ``text,label`` file
    written and read back, and the names looked up again from the codes."""
    d = tables.documents(spark, sf_dir, "doc_id", "text", "source")
    codes = materialize(L.category_codes(d, "source"))   # one row per class, used twice
    f = L.attach_codes(d, codes, "source").drop("source") \
        .withColumn("label", F.col("code").cast("int")).drop("code").select("doc_id", "text", "label")
    path = sinks.write_csv(f, scratch_dir(spark, "label-map"))
    back = src.read_labelled_csv(spark, path, "doc_id BIGINT, text STRING, label INT")
    names = L.sent(codes.select(F.col("code").cast("int").alias("label"), F.col("source").alias("name")), "name")
    named = back.join(names, "label", "left")
    return named.select("doc_id", F.md5("text").alias("text_md5"), "label", "name")


# ---------------------------------------------------------------- iterative models

FLOOR = 0.8          # held-out accuracy that a fitted model must reach

# What SQL can say about a fitted model: every text gets an answer, answers are known classes,
# probabilities lie in (0, 1], and enough of the held-out answers are right.
TEST_SQL = S.with_(S.SPLIT) + "SELECT doc_id, label{} FROM split WHERE part = 'test'"


def _fit_lr(spark, sf_dir, max_iter: int = 20):
    d = E.labelled(spark, sf_dir).withColumn("part", L.split_part("doc_id"))
    return C.lr_pipeline(max_iter=max_iter).fit(d.where(F.col("part") == "train")), d


def _accurate(preds):
    """Whether enough of ``preds`` (label, prediction) are right, as a scalar."""
    return preds.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")) >= FLOOR).scalar()


@query("classifier_train", sql=TEST_SQL.format(", true AS known, true AS accurate"))
def classifier_train(spark, sf_dir, epochs: int = 8, batch_size: int = 1024, rate: float = 20.0):
    """Mini-batch training on the training part; the test part's predictions, and whether
    they are known classes and right often enough."""
    d = E.labelled(spark, sf_dir).withColumn("part", L.split_part("doc_id"))
    model = SGD.fit(d.where(F.col("part") == "train"), epochs, batch_size, rate)
    preds = materialize(SGD.predict(model, d.where(F.col("part") == "test"), ["doc_id", "label"]))
    return preds.select("doc_id", "label", F.col("prediction").isin(model.classes).alias("known"), _accurate(preds).alias("accurate"))


@query("classify_text", sql="SELECT doc_id, true AS known, true AS in_range FROM documents")
def classify_text(spark, sf_dir):
    """Every text -> a label, which is one of the trained ones, and its probability, in (0, 1]."""
    model, d = _fit_lr(spark, sf_dir)
    names = [r[0] for r in d.where(F.col("part") == "train").select("label").distinct().collect()]     # one row a class
    p = C.lr_predictions(model, d)
    return p.select("doc_id", F.col("prediction").isin(names).alias("known"), ((F.col("score") > 0) & (F.col("score") <= 1)).alias("in_range"))


@query("model_compare", sql=NB_SQL + "SELECT doc_id, prediction AS nb, true AS lr_known, true AS lr_accurate FROM preds WHERE part = 'test'")
def model_compare(spark, sf_dir):
    """The same test texts through naive Bayes (exact) and logistic regression, side by side."""
    model, d = _fit_lr(spark, sf_dir)
    lr = materialize(C.lr_predictions(model, d.where(F.col("part") == "test")).select("doc_id", "label", "prediction"))
    nb = nb_predictions(spark, sf_dir).where(F.col("part") == "test").select("doc_id", F.col("prediction").alias("nb"))
    return lr.join(nb, "doc_id").select("doc_id", "nb", F.col("prediction").isNotNull().alias("lr_known"), _accurate(lr).alias("lr_accurate"))


@query("model_save", sql=TEST_SQL.format(", true AS same"))
def model_save(spark, sf_dir):
    """The fitted pipeline is stored and loaded; both predict the test texts, and agree."""
    from pyspark.ml import PipelineModel
    model, d = _fit_lr(spark, sf_dir)
    path = scratch_dir(spark, "model")
    model.write().overwrite().save(path)
    test = d.where(F.col("part") == "test")
    loaded = C.lr_predictions(PipelineModel.load(path), test).select("doc_id", F.col("prediction").alias("again"), F.col("score").alias("score_again"))
    both = C.lr_predictions(model, test).join(loaded, "doc_id")
    same = F.col("prediction").eqNullSafe(F.col("again")) & (F.abs(F.col("score") - F.col("score_again")) < 1e-9)
    return both.select("doc_id", "label", same.alias("same"))
