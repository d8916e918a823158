"""Text classification: tokens, naive Bayes as joins and aggregates, a Spark
ML pipeline, and evaluation (loss, per-class report, top losses).

Naive Bayes here is multinomial with add-one smoothing, written as grouped
aggregates and one equi-join so it runs on the cluster at any size and has
an exact SQL statement of the same computation:

  prior(c)   = log(docs of c / docs)
  w(t, c)    = log(count(t, c) + 1)                  (only observed pairs)
  denom(c)   = log(tokens of c + |V|)
  score(d,c) = prior(c) - N(d) * denom(c) + sum over t in d of w(t, c)

N(d) counts the token occurrences of d that are in the training vocabulary
V; unseen (t, c) pairs contribute log(1) = 0, so only observed pairs join.

Plan: a document's tokens are counted once (``token_counts``: whole texts are dealt out first, so
words are counted where they are cut and only counts move on), and both halves read those
counts. Fit = one partial aggregate on (token, class), written as the model table,
one row per token with a weight for each class. Score = the counts joined with the
model on token, and one sum for each class straight into a partial aggregate on the
document. A model of at most ``MODEL_BYTES`` by measure is broadcast: the counts of a document lie
together, so its partial sums leave a task as one row and no count is shuffled. Of a larger model the
most frequent tokens, as many as are that small, are broadcast; only counts of the others are joined by
shuffle, and none of those is a hot join key by the model. So what a task sorts, and the documents it has sums of,
are those of rare tokens. The class table (prior and denominator, one
row per class) goes through the driver: classes are labels that a model is trained for, and
each is a column of sums; the plan is the same at every size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values --------------------------------------------------------
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"   # tokens are runs of letters and digits
MAX_TOKENS = 512                  # the reference's maxlen
COUNTED_ROWS = 1 << 16            # counts that leave Python at once
MODEL_BYTES = 128 << 20           # weights of at most so many bytes go to every executor
# --- end of fixed values -------------------------------------------------


def tokens(text: str | Column, max_tokens: int | None = MAX_TOKENS) -> Column:
    """Lower-cased tokens, empty ones dropped; the first ``max_tokens``, or all (None)."""
    t = F.col(text) if isinstance(text, str) else text
    toks = F.filter(F.split(F.lower(t), TOKEN_SPLIT), lambda x: x != "")
    return toks if max_tokens is None else F.slice(toks, 1, max_tokens)


def token_counts(docs: DataFrame, keep: list[str], text: str = "text", max_tokens: int | None = None) -> DataFrame:
    """(keep..., token, n) of every row of ``docs``: how often its text has each token. A row without
    tokens has one entry, with a token that is in no text and n = 0; rows that agree in
    ``keep`` have entries of their own, for the reader to add up. Texts are cut where they are dealt to and
    counted a batch of rows at a time, so a task's memory doesn't grow with its share of the texts."""
    # rows are dealt out by a number of their own, so no id, and no text without tokens, is a hot key
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *keep, F.col(text).alias("_text")).repartition("_row")
    rows = rows.select(*keep, "_row", tokens("_text", max_tokens).alias("_t"))
    schema = T.StructType([*rows.select(*keep).schema.fields, T.StructField("token", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, words, n = _counted(b.column(len(keep) + 1), b.column(len(keep)))
            for lo in range(0, len(row), COUNTED_ROWS):
                at = pa.array(row[lo: lo + COUNTED_ROWS])
                yield pa.RecordBatch.from_arrays([*[b.column(i).take(at) for i in range(len(keep))], words[lo: lo + COUNTED_ROWS],
                                                  pa.array(n[lo: lo + COUNTED_ROWS])], schema.names)
    return rows.mapInArrow(run, schema)


def _counted(lists: pa.Array, ids: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, token, n) of the different tokens of each list, row by row, then of the lists without any
    (null ones, too): a blank and the list's id, 0."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    width = max(len(coded.dictionary), 1)
    key, n = np.unique(np.repeat(np.arange(len(size)), size) * width + coded.indices.to_numpy(), return_counts=True)
    none = np.flatnonzero(size == 0)
    blank = pc.binary_join_element_wise("", ids.take(pa.array(none)).cast(pa.string()), " ")
    return (np.concatenate([key // width, none]), pa.concat_arrays([coded.dictionary.take(pa.array(key % width)), blank]),
            np.concatenate([n, np.zeros(len(none), np.int64)]))


class NaiveBayes:
    """Fitted model: ``classes`` (cls, prior, denom), a list with one entry per class, by name, and
    ``weights`` (token, ws), one row per token with a weight for each of them."""

    def __init__(self, classes: list[tuple[str, float, float]], weights: DataFrame, size: int | None = None,
                 split: tuple[DataFrame, DataFrame] | None = None):
        """``size``: bytes of the weights, if measured; ``split``: the weights in two, of frequent tokens (at most
        ``MODEL_BYTES``) and of all others, if they are larger."""
        self.classes, self.weights, self.size, self.split = classes, weights, size, split


def nb_fit_counts(counts: DataFrame, train: DataFrame, path: str, label: str = "label") -> NaiveBayes:
    """Fit on the token counts of the documents ``train`` (rows without a label teach nothing); the
    model is written to ``path`` (a folder under spark.checkpoint.dir) and everything after reads it."""
    spark = train.sparkSession
    n_docs = {r[0]: r[1] for r in train.where(F.col(label).isNotNull()).groupBy(label).count().collect()}   # one row a class
    names = sorted(n_docs)
    known = counts.where(F.col(label).isNotNull() & (F.col("n") > 0))
    per_class = known.groupBy("token", F.col(label).alias("cls")).agg(F.sum("n").alias("n"))
    sums = [F.coalesce(F.sum(F.when(F.col("cls") == c, F.col("n"))), F.lit(0)) for c in names]
    per_class.groupBy("token").agg(F.array(*sums).alias("ns")).write.mode("overwrite").parquet(path)
    model = spark.read.schema("token STRING, ns ARRAY<BIGINT>").parquet(path)
    all_n = F.aggregate("ns", F.lit(0).cast("long"), lambda a, n: a + n)
    totals = model.agg(F.count(F.lit(1)).alias("v"), *[F.sum(F.col("ns")[i]) for i in range(len(names))], F.sum(F.octet_length("token")).alias("b")).first()
    docs = sum(n_docs.values())
    classes = [(c, math.log(n_docs[c] / docs), math.log((totals[i + 1] or 0) + totals[0]) if (totals[i + 1] or 0) + totals[0] else 0.0)
               for i, c in enumerate(names)]
    row = 8 * len(names) + 64                                                 # weights, and what a row takes besides its token
    size = (totals["b"] or 0) + totals["v"] * row

    def weights(rows: DataFrame) -> DataFrame:
        return rows.select("token", F.transform("ns", lambda n: F.log(n + F.lit(1))).alias("ws"))
    split = None
    if size > MODEL_BYTES:
        scale = F.floor(F.log2(all_n))
        by_scale = model.groupBy(scale.alias("scale")).agg((F.sum(F.octet_length("token")) + F.count(F.lit(1)) * row).alias("b")).collect()  # up to 64 rows
        least, left = 64, MODEL_BYTES
        for r in sorted(by_scale, key=lambda r: -r["scale"]):
            left -= r["b"]
            if left < 0:
                break
            least = r["scale"]
        split = weights(model.where(scale >= least)), weights(model.where(scale < least))
    return NaiveBayes(classes, weights(model), size, split)


def nb_fit(train: DataFrame, path: str, label: str = "label", text: str = "text",
           max_tokens: int | None = None) -> NaiveBayes:
    """``nb_fit_counts`` from texts (label, text)."""
    return nb_fit_counts(token_counts(train, [label], text, max_tokens), train, path, label)


def _scored(model: NaiveBayes, counts: DataFrame, keep: list[str]) -> DataFrame:
    """Per document: keep columns and ``_s`` = array<struct<ns, cls, score>> of
    every class, sorted by (-score, cls)."""
    # where weights are small by measure, counts stay where they are, and a document's meet in one task
    if model.split is not None:
        frequent, others = model.split
        j = counts.join(F.broadcast(frequent), "token", "left").select(*keep, "n", "ws")
        rare = counts.where(F.col("n") > 0).join(F.broadcast(frequent.select("token")), "token", "left_anti")
        j = j.unionByName(rare.join(others, "token").select(*keep, "n", "ws"))
    else:
        small = model.size is not None and model.size <= MODEL_BYTES
        j = counts.join(F.broadcast(model.weights) if small else model.weights, "token", "left")
    n_in = F.coalesce(F.sum(F.when(F.col("ws").isNotNull(), F.col("n"))), F.lit(0))
    # a token that is in no class's texts weighs log(1) = 0
    sums = [F.coalesce(F.sum(F.col("n") * F.col("ws")[i]), F.lit(0.0)).alias(f"_s{i}") for i in range(len(model.classes))]
    g = j.groupBy(*keep).agg(n_in.alias("_n"), *sums)

    def entry(i, cls, prior, denom):
        v = F.lit(prior) - F.col("_n") * F.lit(denom) + F.col(f"_s{i}")
        return F.struct((-v).alias("ns"), F.lit(cls).alias("cls"), v.alias("score"))
    entries = [entry(i, *c) for i, c in enumerate(model.classes)]
    none = "array<struct<ns:double,cls:string,score:double>>"
    return g.select(*keep, F.array_sort(F.array(*entries)).alias("_s") if entries else F.array().cast(none).alias("_s"))


def nb_scores(model: NaiveBayes, docs: DataFrame, text: str = "text",
              max_tokens: int | None = None) -> DataFrame:
    """(doc_id, cls, score) for every document and class."""
    g = _scored(model, token_counts(docs, ["doc_id"], text, max_tokens), ["doc_id"])
    return g.select("doc_id", F.explode("_s").alias("x")).select("doc_id", "x.cls", "x.score")


def nb_predict_counts(model: NaiveBayes, counts: DataFrame, keep: list[str], label: str = "label") -> DataFrame:
    """keep columns, prediction (argmax, ties to the smaller name), p_true
    (softmax probability of the true class) and loss = -log p_true."""
    g = _scored(model, counts, keep)
    top = F.get("_s", F.lit(0))
    mx = top["score"]
    z = F.aggregate("_s", F.lit(0.0), lambda acc, x: acc + F.exp(x["score"] - mx))
    s_true = F.get(F.filter("_s", lambda x: x["cls"] == F.col(label)), 0)["score"]
    loss = mx + F.log(z) - s_true
    return g.select(*keep, top["cls"].alias("prediction"), F.exp(-loss).alias("p_true"), loss.alias("loss"))


def nb_predict(model: NaiveBayes, docs: DataFrame, label: str = "label", text: str = "text",
               max_tokens: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """``nb_predict_counts`` from texts: doc_id, label, further ``keep``, prediction, p_true, loss."""
    keep = ["doc_id", label] + [k for k in (keep or []) if k not in ("doc_id", label)]
    return nb_predict_counts(model, token_counts(docs, keep, text, max_tokens), keep, label)


def confusion(preds: DataFrame) -> DataFrame:
    """Confusion matrix in long form: label, prediction, n."""
    return preds.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_report(preds: DataFrame) -> DataFrame:
    """Per class: precision, recall, F1, support (from the confusion counts)."""
    conf = confusion(preds)
    # each confusion cell counts once for its true class (support, tp) and
    # once for its predicted class: one more aggregate, no joins
    n, hit = F.col("n"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    cells = conf.select(F.explode(F.array(
        F.struct(F.col("label").alias("class"), n.alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("class"), zero.alias("support"), n.alias("predicted"),
                 zero.alias("tp")))).alias("c"))
    r = cells.groupBy(F.col("c.class").alias("class")).agg(
        F.sum("c.support").alias("support"), F.sum("c.predicted").alias("predicted"), F.sum("c.tp").alias("tp"))
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rc = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    r = r.select("class", p.alias("precision"), rc.alias("recall"), F.col("support").cast("long").alias("support"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return r.withColumn("f1", f1)


def top_losses(preds: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` examples with the highest loss (ties: smaller id first)."""
    return preds.orderBy(F.desc("loss"), F.asc("doc_id")).limit(n)


def lr_pipeline(max_tokens: int | None = None, num_features: int = 1 << 18, max_iter: int = 20,
                reg: float = 0.01, label: str = "label"):
    """Spark ML pipeline: tokens (all, or the first ``max_tokens``) -> hashed term frequencies -> IDF
    (fitted on the training rows only) -> multinomial logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, SQLTransformer, StringIndexer

    tok = RegexTokenizer(inputCol="text", outputCol="words_all", pattern=TOKEN_SPLIT, gaps=True, toLowercase=True)
    cap = SQLTransformer(statement="SELECT *, " + ("words_all" if max_tokens is None else f"slice(words_all, 1, {max_tokens})") + " AS words FROM __THIS__")
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features)
    idf = IDF(inputCol="tf", outputCol="features")
    idx = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc", handleInvalid="keep")
    lr = LogisticRegression(featuresCol="features", labelCol="label_idx", maxIter=max_iter, regParam=reg,
                            family="multinomial")
    return Pipeline(stages=[tok, cap, tf, idf, idx, lr])


def lr_predictions(model, docs: DataFrame) -> DataFrame:
    """doc_id, label, prediction (class name), score (its probability among the classes that have one)."""
    from pyspark.ml.feature import StringIndexerModel
    from pyspark.ml.functions import vector_to_array
    idx = [s for s in model.stages if isinstance(s, StringIndexerModel)][0]
    names = F.array(*[F.lit(x) for x in idx.labels])
    out = model.transform(docs)
    # the indexer keeps one extra index for labels unseen in training; it is no class, and no answer
    out = out.withColumn("_p", F.slice(vector_to_array("probability"), 1, len(idx.labels)))
    top = F.array_max("_p")
    name = F.try_element_at(names, F.array_position("_p", top).cast("int"))
    total = F.aggregate("_p", F.lit(0.0), lambda a, x: a + x)
    return out.select("doc_id", "label", name.alias("prediction"), (top / total).alias("score"))
