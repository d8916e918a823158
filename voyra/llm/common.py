"""Registry and small Spark helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from voyra.session import configure, scratch_dir
from voyra.sources.tables import table_path

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Shuffle files of a finished write are dropped at once, not when the driver
# happens to collect garbage: several operators write intermediate tables.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set(CLEANUP, "true")
    return spark


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return run
    return deco


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Whole table ``name``; only ``cols`` reach the scan."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


_watchers: list[list[str]] = []


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it
    back: cuts lineage, and a lost executor loses nothing that is written."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    for made in _watchers:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def tables_made() -> Iterator[list[str]]:
    """The folders that ``scratch`` makes inside the block."""
    made: list[str] = []
    _watchers.append(made)
    try:
        yield made
    finally:
        _watchers[:] = [w for w in _watchers if w is not made]


def discard(spark: SparkSession, *folders: str) -> None:
    """Delete folders that ``scratch`` made and that nothing reads any more."""
    for f in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_text(df: DataFrame, text: str, fields: str, fn: Callable[[pa.Array], list],
             keep: list[str] | None = None, out: str = "stats") -> tuple[DataFrame, str]:
    """Append a struct column of per-text results to the columns ``keep`` (all, if None).

    ``fn`` gets the text column of one Arrow batch and returns one array per
    field of ``fields`` (a DDL list). Returns the frame and the name of the new
    column, ``out`` or, where the input has that name, a longer one.
    """
    keep = list(df.columns) if keep is None else keep
    name = fresh(df, out)
    # a kept text is sent once, not a second time as the input of ``fn``
    more = [] if text in keep else [F.col(f"`{text}`").alias(fresh(df, "text_in"))]
    src = df.select(*[F.col(f"`{c}`") for c in keep], *more)
    at = keep.index(text) if text in keep else len(keep)
    struct = T.StructType.fromDDL(fields)
    schema = T.StructType([*src.schema.fields[: len(keep)], T.StructField(name, struct)])
    names = [f.name for f in struct.fields]
    kept = [f.name for f in src.schema.fields[: len(keep)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(i) for i in range(len(kept))]
            vals = [v if isinstance(v, pa.Array) else pa.array(v) for v in fn(b.column(at))]
            yield pa.RecordBatch.from_arrays([*cols, pa.StructArray.from_arrays(vals, names)], [*kept, name])

    return src.mapInArrow(run, schema), name
