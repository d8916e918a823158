"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positive examples, other text stays
unlabelled, and the classifiers never see a "clean" label. With the class prior
``pi`` the risk of a linear model z(x) is

    pi * E_P[l(z)] + max(0, E_U[l(-z)] - pi * E_P[l(-z)]),    l(z) = log(1 + exp(-z)):

the second term is the risk on clean text, estimated from unlabelled text less
the toxic share in it. Where the estimate falls below zero the classifier has
begun to fit single examples, and the step goes the other way.

A text's features are the lower-cased words it holds (runs of letters) and their
beginnings of 4, 5 and 6 bytes, each once, whatever their number. Steps are Adam
with a soft threshold, so most weights are zero and long texts gather no noise.
Features are 64-bit hashes; a model is its list of non-zero weights.

``CLASSIFIERS`` classifiers are trained side by side in numpy, one task each, on
the same confirmed examples and a part each of the unlabelled ones; a score is the
logistic function of their mean. The samples are bounded (``MAX_POSITIVE`` and
``MAX_UNLABELLED`` documents, those of the smallest id hashes); the prior is the
toxic share of all training labels, and every whole text is scored.

Only rows with crc32(id as text) mod ``FOLDS`` != 0 are learnt from, in labels and in
unlabelled text; labels and ids are no features.

Defined results: a null or empty text has no features and gets the score of the
bias; a row without an id is scored, not learnt from and not held out; rows that
repeat an id are scored each, and learnt from once (the text of the smallest hash);
repeated labels of an id count once, toxic if one says so; with no confirmed example
every score is 0; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from voyra.llm import bytehash as B
from voyra.llm.common import map_text, scratch

FOLDS = 5
MAX_POSITIVE = 3000          # confirmed documents that are learnt from
MAX_UNLABELLED = 12000       # unlabelled documents, over all classifiers
CLASSIFIERS = 3
PREFIXES = (4, 5, 6)         # bytes of a word's beginning that are features too
STEPS = 150
RATE = 0.1
L1 = 4e-4                    # soft threshold, for each unit of step size
LEAST_POSITIVES = 3          # a feature of fewer confirmed documents has no weight

# letters keep their (lower-case) byte, all others become a space
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def in_training(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % FOLDS != 0


def _letters(s: B.Slice) -> B.Slice:
    buf = _LETTERS[s.buf]
    after = np.zeros(len(buf), bool)           # capitals of U+00C0 to U+00DE, but for the times sign
    after[1:] = buf[:-1] == 0xC3
    capital = after & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)
    buf[capital] += 0x20
    return B.words_of(s.lo, s.hi, buf, s.offs)


def features(text: pa.Array) -> Iterator[tuple[B.Slice, np.ndarray, np.ndarray]]:
    """(slice, row in the slice, feature hash); a word's beginning repeats as often as the word."""
    for raw in B.slices(text):
        s = _letters(raw)
        rows, keys = [s.row], [s.word_hash()]
        for n in PREFIXES:
            long = s.ends - s.starts > n
            rows.append(s.row[long])
            keys.append(B.mix(s.span_hash(s.starts[long], s.starts[long] + n) + np.uint64(n)))
        yield s, np.concatenate(rows), np.concatenate(keys)


def feature_sets(text: pa.Array) -> list[pa.Array]:
    """The distinct features of each text, as packed 64-bit hashes."""
    out: list[bytes] = []
    for s, row, key in features(text):
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        row, key = row[new], key[new]
        at = np.searchsorted(row, np.arange(s.n + 1))
        out += [key[at[i]: at[i + 1]].tobytes() for i in range(s.n)]
    return [pa.array(out, pa.binary())]


@dataclass
class Model:
    """Non-zero weights by feature hash (sorted), and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        bits = 21
        self._mask = np.uint64((1 << bits) - 1)
        self._seen = np.zeros(1 << bits, bool)
        self._seen[(self.keys & self._mask).astype(np.int64)] = True

    def logits(self, text: pa.Array) -> np.ndarray:
        parts = [np.zeros(0)]
        for s, row, key in features(text):
            maybe = self._seen[(key & self._mask).astype(np.int64)]
            row, key = row[maybe], key[maybe]
            at = np.searchsorted(self.keys, key)
            hit = at < len(self.keys)
            hit[hit] = self.keys[at[hit]] == key[hit]
            pair = np.unique(row[hit] * np.int64(len(self.keys) + 1) + at[hit])
            row, at = np.divmod(pair, len(self.keys) + 1)
            parts.append(self.bias + np.bincount(row, self.weights[at] if len(at) else None, minlength=s.n)
                         if len(at) else np.full(s.n, self.bias))
        return np.concatenate(parts)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def risk_gradient(z: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """(risk of toxic text, estimated risk of clean text, gradient by z of the step to take)."""
    p, u = positive, ~positive
    n_p, n_u = max(1, int(p.sum())), max(1, int(u.sum()))
    toxic = prior * np.logaddexp(0, -z[p]).sum() / n_p
    clean = np.logaddexp(0, z[u]).sum() / n_u - prior * np.logaddexp(0, z[p]).sum() / n_p
    up = _sigmoid(z)                                   # derivative of l(-z)
    clean_grad = np.where(p, -prior * up / n_p, up / n_u)
    if clean < 0:
        return toxic, clean, -clean_grad
    return toxic, clean, clean_grad + np.where(p, prior * (up - 1) / n_p, 0.0)


def train(sets: list[bytes], positive: np.ndarray, prior: float, steps: int = STEPS, rate: float = RATE,
          l1: float = L1, least: int = LEAST_POSITIVES) -> Model:
    """One classifier from packed feature sets; ``positive`` marks the confirmed examples."""
    keys = [np.frombuffer(b, np.uint64) for b in sets]
    held = np.concatenate([k for k, p in zip(keys, positive) if p] or [np.zeros(0, np.uint64)])
    vocab, n = np.unique(held, return_counts=True)
    vocab = vocab[n >= least]
    rows, cols = [], []
    for i, k in enumerate(keys):
        at = np.searchsorted(vocab, k)
        ok = at < len(vocab)
        ok[ok] = vocab[at[ok]] == k[ok]
        cols.append(at[ok].astype(np.int32))
        rows.append(np.full(int(ok.sum()), i, np.int32))
    row, col = np.concatenate(rows or [np.zeros(0, np.int32)]), np.concatenate(cols or [np.zeros(0, np.int32)])
    w, bias = np.zeros(len(vocab)), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros(len(w)), np.zeros(len(w)), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], minlength=len(keys)) + bias if len(row) else np.full(len(keys), bias)
        g = risk_gradient(z, positive, prior)[2]
        gw = np.bincount(col, g[row], minlength=len(w)) if len(col) else np.zeros(len(w))
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9 ** t, 1 - 0.99 ** t
        scale = rate / (np.sqrt(v / b) + 1e-4)
        w = w - scale * m / a
        w = np.sign(w) * np.maximum(np.abs(w) - scale * l1, 0)
        bias -= rate * (mb / a) / (np.sqrt(vb / b) + 1e-4)
    kept = np.flatnonzero(w)
    return Model(vocab[kept], w[kept], float(bias))


def mean(models: list[Model]) -> Model:
    """The model whose logit is the mean of the models' logits."""
    keys = np.concatenate([m.keys for m in models])
    vocab, at = np.unique(keys, return_inverse=True)
    w = np.bincount(at, np.concatenate([m.weights for m in models]), minlength=len(vocab)) / len(models)
    return Model(vocab, w, float(np.mean([m.bias for m in models])))


def _sample(ids: DataFrame, most: int, salt: int) -> list[int]:
    """``most`` ids at most, those of the smallest hash. The share of rows that reaches the
    sort is cut to about twice that number first, so no task gets more."""
    place = F.xxhash64(F.lit(salt), "id")
    n = ids.count()
    if n > 2 * most:
        ids = ids.filter(F.shiftrightunsigned(place, 11) < F.lit(int((1 << 53) * 2 * most / n)))
    return [r["id"] for r in ids.select("id").distinct().orderBy(place, "id").limit(most).collect()]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
        toxic: str = "toxic") -> Model | None:
    """The mean classifier of the training rows; None if no toxic document is confirmed or no text is there."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter(in_training(F.col("id")))
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{toxic}`").alias("toxic"))
    known = known.filter(in_training(F.col("id")) & F.col("toxic").isNotNull())
    known = known.groupBy("id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n, hits = known.agg(F.count("*"), F.sum("toxic")).first()
    if not hits:
        return None
    prior = float(np.clip(hits / n, 1e-4, 0.5))
    confirmed = _sample(known.filter("toxic = 1"), MAX_POSITIVE, 1)
    others = _sample(rows.select("id"), MAX_UNLABELLED, 2)
    picked = [(i, -1) for i in confirmed] + [(i, k % CLASSIFIERS) for k, i in enumerate(others)]
    # at most MAX_POSITIVE + MAX_UNLABELLED rows: a broadcast of proven size
    sample = F.broadcast(spark.createDataFrame(picked, "pick long, part int"))
    wanted = F.broadcast(spark.createDataFrame(sorted({(i,) for i, _ in picked}), "pick long"))
    texts = rows.join(wanted, rows["id"] == wanted["pick"], "left_semi")
    texts = texts.groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sets, f = map_text(texts, "text", "keys binary", feature_sets, ["id"], "features")
    sets = scratch(sets.select("id", F.col(f)["keys"].alias("keys")), "toxicity-sample")
    each = sets.join(sample, sets["id"] == sample["pick"]).select("id", "part", "keys")
    every = F.array(*[F.lit(k) for k in range(CLASSIFIERS)])
    each = each.withColumn("positive", F.col("part") < 0).withColumn(
        "part", F.explode(F.when(F.col("part") < 0, every).otherwise(F.array("part"))))

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("positive", "ascending")])
        positive = table.column("positive").to_numpy(zero_copy_only=False).astype(bool)
        m = train(table.column("keys").to_pylist(), positive, prior)
        return pa.table({"part": table.column("part").slice(0, 1), "keys": pa.array([m.keys.tobytes()], pa.binary()),
                         "weights": pa.array([m.weights.tobytes()], pa.binary()), "bias": pa.array([m.bias], pa.float64())})

    models = each.groupBy("part").applyInArrow(learn, "part int, keys binary, weights binary, bias double")
    # one row for each classifier; a model holds features of the bounded sample only
    got = sorted(scratch(models, "toxicity-models").collect(), key=lambda r: r["part"])
    if not got:
        return None
    return mean([Model(np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["weights"]), r["bias"]) for r in got])


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` with a struct column holding ``score``."""
    if model is None:
        return map_text(docs, text, "score double", lambda t: [np.zeros(len(t))], keep, "toxicity")
    keys, weights, bias = model.keys, model.weights, model.bias
    made: list[Model] = []

    def run(t: pa.Array) -> list[np.ndarray]:
        if not made:
            made.append(Model(keys, weights, bias))
        return [_sigmoid(made[0].logits(t))]
    return map_text(docs, text, "score double", run, keep, "toxicity")
