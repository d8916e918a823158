"""Session helpers.

Everything here is plain Spark configuration. Queries call ``configure`` on
whatever session they are handed (the cluster's, a test's) so the few SQL
settings that change results are pinned, and ask ``scratch_dir`` for a place
to write intermediate tables that every executor can see.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results, so every query pins them on the session it gets.
RESULT_CONF = {
    # Spark 4 defaults to ANSI mode; the operators here use try_* forms where
    # bad input is expected, and plain arithmetic never overflows on ids.
    "spark.sql.session.timeZone": "UTC",
    # zip_map: a repeated experience name keeps the later list, as a dict does.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Settings that only change speed. Applied by ``build_session``; a cluster
# session keeps its own values.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Arrow batches hand whole pages to the Python extractors; the default of
# 10,000 rows a batch is ~1 GB of 100 KB pages. Used when the session has not
# chosen a value.
ARROW_BATCH_ROWS = "512"


# Settings for a large cluster (about 100 TB of input, 1000 executors). The
# shuffle starts wide and AQE coalesces it to ~256 MB partitions, splits
# skewed ones (a key with a third of the rows) and turns joins into
# broadcasts only under the measured-size threshold.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": ARROW_BATCH_ROWS,
    "spark.task.maxFailures": "8",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.stage.maxConsecutiveAttempts": "8",
}


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``voyra`` importable in the Python workers (the extractors run
    there): zip the package once per application and add it with
    ``addPyFile``, as ``--py-files`` would; Spark serves it to every executor."""
    import os
    import zipfile
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _shipped or os.environ.get("VOYRA_SHIP_PACKAGE", "1") == "0":
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="voyra-pyfiles-"), "voyra.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _shipped.add(app)


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RESULT_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, ARROW_BATCH_ROWS)
    ship_package(spark)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "voyra", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster use the given session."""
    b = SparkSession.builder.master(master).appName(app)
    conf = {**SPEED_CONF, **RESULT_CONF,
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": "8g"}
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def cluster_session(app: str = "voyra", extra: dict | None = None) -> SparkSession:
    """Session for a cluster run: master, executors and ``spark.checkpoint.dir``
    come from the submit configuration; the settings above are added."""
    b = SparkSession.builder.appName(app)
    for k, v in {**CLUSTER_CONF, **RESULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    return configure(b.getOrCreate())


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset (a local test) do we make one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="voyra-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/voyra-scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Compute a small table once for several consumers: a reliable checkpoint
    in the shared checkpoint folder (survives executor loss, cuts lineage)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


__all__ = ["configure", "build_session", "checkpoint_root", "scratch_dir"]
