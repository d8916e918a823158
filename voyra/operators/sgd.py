"""Text classification by mini-batch gradient descent: epochs, batch size, learning rate.

Multinomial logistic regression on hashed token counts (``num_features`` buckets, counts as
log(1 + n), each text at length one). Texts are dealt into shards of about ``STEPS`` batches by
a hash. Every epoch puts the texts of a shard into a new order, given
by a hash of the seed, the epoch and the text's id, and cuts it into batches of about
``batch_size``. A batch is one step. The rate follows one cycle: up to ``rate`` over the first
``WARM`` of all steps, then down to zero.

An epoch is one Spark job, however many batches it has: each task takes the steps of its shards,
all of which begin with the weights that the epoch before ended with, and the weights after the
epoch are the mean over the shards, by their texts. So every epoch learns from every text, and
the jobs are as many as the epochs. Tables of one shard are trained step by step as by one machine.
Batches so large that a task should not hold ``STEPS`` of them (more than ``SHARD_ROWS`` texts)
are one job a step: tasks sum the gradients of their texts.

Weights and gradients are summed by a tree: groups of tasks add their sums up, one task adds those, so
no task reads more than ``FAN`` sums, and one sum of the model's size, classes times
features, comes to the driver an epoch (or step).

Features are written once. A lost executor repeats its shards of one epoch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voyra.operators.classify import tokens
from voyra.session import scratch_dir

FAN = 64
WARM = 0.3
STEPS = 16              # steps of a shard in an epoch
SHARD_ROWS = 1 << 16    # texts that a task may hold at once


@dataclass
class Model:
    """``weights`` (classes, features + 1): the last column is the bias."""

    classes: list[str]
    weights: np.ndarray

    @property
    def num_features(self) -> int:
        return self.weights.shape[1] - 1


def features(docs: DataFrame, keep: list[str], text: str = "text", num_features: int = 1 << 12) -> DataFrame:
    """(keep..., at, x): the buckets that a text's tokens fall into, ascending, and their values.
    Texts of rows that agree in ``keep`` are one text. Buckets are counted a batch of texts at a time, where
    the texts are cut; a text moves on as its counts, in one row."""
    # rows are dealt out by a number of their own, so no id is a hot key
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *keep, F.col(text).alias("_text")).repartition("_row")
    buckets = F.transform(tokens("_text", None), lambda t: F.pmod(F.xxhash64(t), F.lit(num_features)).cast("int"))
    kept = rows.select(*keep).schema.fields
    counts = rows.select(*keep, buckets.alias("at")).mapInArrow(
        lambda batches: (_merged(b, keep, num_features) for b in batches if b.num_rows), _with(kept, "at array<int>, n array<long>"))
    alike = counts.repartition(*keep).sortWithinPartitions(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None                       # the key that was read last: its rows may go on in the next batch
        for b in batches:
            if not b.num_rows:
                continue
            if last is not None:
                b = pa.Table.from_batches([pa.RecordBatch.from_arrays(last.columns, schema=b.schema), b]).combine_chunks().to_batches()[0]
            b = _merged(b, keep, num_features)
            last = b.slice(b.num_rows - 1)
            yield _valued(b.slice(0, b.num_rows - 1), keep)
        if last is not None:
            yield _valued(last, keep)
    return alike.mapInArrow(run, _with(kept, "at array<int>, x array<double>"))


def _with(fields: list[T.StructField], more: str) -> T.StructType:
    return T.StructType([*fields, *T.StructType.fromDDL(more).fields])


def _merged(b: pa.RecordBatch, keep: list[str], num_features: int) -> pa.RecordBatch:
    """(keep..., at, n) of the rows of ``b`` (keep..., at[, n]; without ``n``, each entry counts one): neighbours
    that agree in ``keep`` are one row, buckets ascend, each once."""
    keys = list(zip(*(b.column(i).to_pylist() for i in range(len(keep))), strict=True))
    new = np.array([i == 0 or k != keys[i - 1] for i, k in enumerate(keys)])
    lists, first = b.column(len(keep)), np.flatnonzero(new)
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    place = np.repeat(np.cumsum(new) - 1, size) * num_features + lists.flatten().to_numpy()
    if b.num_columns == len(keep) + 1:
        place, n = np.unique(place, return_counts=True)
    elif len(first) == b.num_rows:                    # no two rows to add up
        n = b.column(len(keep) + 1).flatten().to_numpy()
    else:
        place, to = np.unique(place, return_inverse=True)
        n = np.bincount(to, b.column(len(keep) + 1).flatten().to_numpy(), len(place)).astype(np.int64)
    ends = pa.array(np.searchsorted(place, np.arange(len(first) + 1) * num_features), pa.int32())
    return pa.RecordBatch.from_arrays([*[b.column(i).take(pa.array(first)) for i in range(len(keep))],
                                       pa.ListArray.from_arrays(ends, pa.array(place % num_features, pa.int32())),
                                       pa.ListArray.from_arrays(ends, pa.array(n, pa.int64()))], [*keep, "at", "n"])


def _valued(b: pa.RecordBatch, keep: list[str]) -> pa.RecordBatch:
    """``b`` (keep..., at, n) with values instead of counts: log(1 + n), each row at length one."""
    lists = b.column(len(keep) + 1)
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    row, v = np.repeat(np.arange(b.num_rows), size), np.log1p(lists.flatten().to_numpy())
    v = v / np.sqrt(np.bincount(row, v * v, b.num_rows))[row]
    at, ends = b.column(len(keep)).flatten(), pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
    return pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.ListArray.from_arrays(ends, at), pa.ListArray.from_arrays(ends, pa.array(v))],
                                      [*keep, "at", "x"])


def rate_at(step: int, steps: int, rate: float) -> float:
    """One cycle: linear up to ``rate``, linear down to zero."""
    t = (step + 0.5) / steps
    return rate * (t / WARM if t < WARM else (1 - t) / (1 - WARM))


def _rows(b: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the features of a batch."""
    at, x = (b.column(c).combine_chunks() if isinstance(b, pa.Table) else b.column(c) for c in ("at", "x"))
    size = np.diff(at.offsets.to_numpy())
    return np.repeat(np.arange(len(size)), size), at.flatten().to_numpy(), x.flatten().to_numpy()


def _scores(b, weights: np.ndarray) -> np.ndarray:
    row, at, x = _rows(b)
    z = np.tile(weights[:, -1], (b.num_rows, 1))
    for c in range(len(weights)):
        z[:, c] += np.bincount(row, weights[c, at] * x, minlength=b.num_rows)
    return z


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradient(b, weights: np.ndarray) -> np.ndarray:
    """Sum over the rows of ``b`` (at, x, cls) of the gradient of -log p(class)."""
    row, at, x = _rows(b)
    p = softmax(_scores(b, weights))
    p[np.arange(b.num_rows), b.column("cls").to_numpy()] -= 1
    g = np.zeros_like(weights)
    for c in range(len(weights)):
        g[c, :-1] = np.bincount(at, p[row, c] * x, minlength=weights.shape[1] - 1)
    g[:, -1] = p.sum(axis=0)
    return g


def _summed(rows: DataFrame, weights: np.ndarray, tasks: int) -> tuple[np.ndarray, int]:
    """Gradient of a batch of texts that ``tasks`` tasks read, and their number, by a tree of sums."""
    shape = weights.shape
    schema = "part int, n long, g binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        g, n = np.zeros(shape), 0
        for b in batches:
            g, n = g + gradient(b, weights), n + b.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n]), pa.array([g.tobytes()], pa.binary())],
                                             ["part", "n", "g"])

    return _tree(rows.select("at", "x", "cls").mapInArrow(partial, schema), shape, tasks)


def _tree(sums: DataFrame, shape: tuple[int, ...], tasks: int) -> tuple[np.ndarray, int]:
    """Sum of the arrays of ``shape`` and of the numbers in ``sums`` (part, from 0 to below ``tasks``, n, g)."""
    schema = "part int, n long, g binary"

    def add(t: pa.Table) -> pa.Table:
        t = t.sort_by([("part", "ascending"), ("n", "ascending")])      # one order of addition, so reruns agree
        g = np.zeros(shape)
        for blob in t.column("g"):
            g += np.frombuffer(blob.as_py()).reshape(shape)
        return pa.table({"part": pa.array([t.column("part")[0].as_py() // FAN], pa.int32()), "n": pa.array([sum(t.column("n").to_pylist())]),
                         "g": pa.array([g.tobytes()], pa.binary())})

    while True:
        sums = sums.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(add, schema)
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            break
    got = sums.collect()                            # one row of the model's size
    return sum((np.frombuffer(r["g"]).reshape(shape) for r in got), np.zeros(shape)), sum(r["n"] for r in got)


def _epoch(rows: DataFrame, weights: np.ndarray, shards: int, batches: int, epoch: int, epochs: int, rate: float, seed: int) -> np.ndarray:
    """Weights after an epoch over ``rows`` (shard, id, cls, at, x), of which each shard takes ``batches`` steps."""
    shape, steps = weights.shape, epochs * batches
    mine = F.pmod(F.xxhash64(F.lit(seed), F.lit(epoch), "id"), F.lit(batches)).cast("int")

    def trained(t: pa.Table) -> pa.RecordBatch:
        w, batch = weights, t.column("batch").to_numpy()
        for b in np.unique(batch):
            own = t.filter(pa.array(batch == b))
            w = w - rate_at(epoch * batches + int(b), steps, rate) * gradient(own, w) / own.num_rows
        return pa.RecordBatch.from_arrays([t.column("shard").combine_chunks().slice(0, 1), pa.array([t.num_rows]),
                                           pa.array([(w * t.num_rows).tobytes()], pa.binary())], ["part", "n", "g"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for p in parts:
            if not p.num_rows:
                continue
            shard = p.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for lo, hi in zip(cuts, cuts[1:]):
                if held and held[0].column(0)[0].as_py() != shard[lo]:
                    yield trained(pa.Table.from_batches(held))
                    held = []
                held.append(p.slice(lo, hi - lo))
        if held:
            yield trained(pa.Table.from_batches(held))

    local = rows.select("shard", mine.alias("batch"), "at", "x", "cls").mapInArrow(run, "part int, n long, g binary")
    total, n = _tree(local, shape, shards)
    return total / n


def fit(train: DataFrame, epochs: int = 8, batch_size: int = 1024, rate: float = 20.0, seed: int = 42, num_features: int = 1 << 12,
        id_col: str = "doc_id", label: str = "label", text: str = "text") -> Model:
    """Train on (id, label, text); rows without a label teach nothing."""
    spark = train.sparkSession
    train = train.where(F.col(label).isNotNull())
    classes = [r[0] for r in train.select(label).distinct().orderBy(label).collect()]        # one row a class
    code = F.create_map(*[F.lit(v) for i, c in enumerate(classes) for v in (c, i)]) if classes else F.lit(None)
    path, whole = scratch_dir(spark, "sgd-features"), scratch_dir(spark, "sgd-shards")
    rows = features(train, [id_col, label], text, num_features)
    rows.select(F.col(id_col).alias("id"), (F.try_element_at(code, F.col(label)) if classes else F.lit(0)).cast("long").alias("cls"),
                "at", "x").write.parquet(path)
    columns = "id BIGINT, cls BIGINT, at ARRAY<INT>, x ARRAY<DOUBLE>"
    rows = spark.read.schema(columns).parquet(path)
    n, weights = rows.count(), np.zeros((len(classes), num_features + 1))
    if not n or len(classes) < 2:
        return Model(classes, weights)
    if batch_size > SHARD_ROWS // STEPS:
        return Model(classes, _step_by_step(rows, weights, n, epochs, batch_size, rate, seed))
    shards = -(-n // (STEPS * batch_size))
    batches = max(1, math.ceil(n / (shards * batch_size)))
    # written once, a shard in one piece
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(shards)).cast("int"))
    dealt.repartition(shards, "shard").sortWithinPartitions("shard", "id", "cls").write.parquet(whole)
    rows = spark.read.schema(f"{columns}, shard INT").parquet(whole)
    for epoch in range(epochs):
        weights = _epoch(rows, weights, shards, batches, epoch, epochs, rate, seed)
    return Model(classes, weights)


def _step_by_step(rows: DataFrame, weights: np.ndarray, n: int, epochs: int, batch_size: int, rate: float, seed: int) -> np.ndarray:
    """Weights after all steps over the ``n`` rows, a job each."""
    tasks, batches = rows.rdd.getNumPartitions(), max(1, math.ceil(n / batch_size))           # of the plan; nothing runs as an RDD
    for step in range(epochs * batches):
        epoch, batch = divmod(step, batches)
        mine = F.pmod(F.xxhash64(F.lit(seed), F.lit(epoch), "id"), F.lit(batches)) == batch
        g, size = _summed(rows.where(mine), weights, tasks)
        if size:
            weights = weights - rate_at(step, epochs * batches, rate) * g / size
    return weights


def predict(model: Model, docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """(keep..., prediction, score): the class of the largest probability (ties: the smaller name), and it."""
    rows = features(docs, keep, text, model.num_features)
    names, weights = pa.array(model.classes, pa.string()), model.weights
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = softmax(_scores(b, weights)) if len(names) else np.zeros((b.num_rows, 0))
            top = p.argmax(axis=1) if len(names) else np.zeros(b.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(keep)], names.take(pa.array(top)) if len(names) else pa.nulls(b.num_rows, pa.string()),
                 pa.array(p[np.arange(b.num_rows), top]) if len(names) else pa.nulls(b.num_rows, pa.float64())], [*keep, "prediction", "score"])
    return rows.mapInArrow(run, ", ".join(cols) + ", prediction string, score double")
