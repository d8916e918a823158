"""Tables that change as a whole: snapshots, and a pointer that moves on in one step.

A store is a folder with named tables. Rows live in hash buckets of their key, each
bucket in a folder of its own that is never written twice:

    data/<table>/<commit>/_bucket=<b>/part-...     rows
    versions/00000007.json                         which folder holds each bucket

A commit writes the new folders of the buckets it touches, then publishes the next
version file, naming them and, for the untouched buckets, the folders they had. Until
that file is there readers see the version before, whatever was written; once it
is, they see all of the commit, in every table it changed. The file is put there by a
rename that fails where one exists (HDFS and local folders; an object store needs a
committer with the same promise), so of two writers one is told to start over.

``batch`` names the input of a commit, such as a stream and its batch number. A batch
that a version already has is not applied again, so replays change nothing.

The bucket count follows the rows: it is chosen when a table is made, and a
commit that finds more than ``GROWTH`` times ``BUCKET_ROWS`` rows a bucket deals
the table out again. Version files hold one line a bucket, not one a row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voyra.session import scratch_dir

BUCKET_ROWS = 1_000_000
GROWTH = 4
BUCKET = "_bucket"


class ConcurrentCommit(RuntimeError):
    """Another writer published the version first; read again and retry."""


@dataclass
class Table:
    """One table in a version: its schema, key, bucket count, rows and folders by bucket."""

    schema: str
    key: list[str]
    buckets: int
    rows: dict[str, int] = field(default_factory=dict)
    folders: dict[str, str] = field(default_factory=dict)


@dataclass
class Version:
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "batches": self.batches,
                           "tables": {k: vars(t) for k, t in self.tables.items()}}, indent=1)

    @staticmethod
    def of(text: str) -> Version:
        d = json.loads(text)
        return Version(d["number"], {k: Table(**t) for k, t in d["tables"].items()}, d["batches"])


@dataclass
class Merge:
    """Rows to put into a table. ``rows`` replaces the rows of the same key; with ``resolve``, a
    function of the joined frame, old and new columns (``old_<c>``, ``new_<c>``; a side
    that has no row is null) make the row that stays. Rows of one key in ``rows`` must be one.
    ``stored`` says that ``rows`` are a written table, which is not written once more."""

    rows: DataFrame
    resolve: Callable[[DataFrame], DataFrame] | None = None
    stored: bool = False


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.org.apache.commons.io.IOUtils
        self._fs = self._Path(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    @staticmethod
    def at(spark: SparkSession, where: Store | str) -> Store:
        return where if isinstance(where, Store) else Store(spark, where)

    # versions -----------------------------------------------------------------

    def _version_path(self, number: int):
        return self._Path(f"{self.path}/versions/{number:08d}.json")

    def numbers(self) -> list[int]:
        folder = self._Path(f"{self.path}/versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int | None = None) -> Version:
        """The newest version, or that ``number``; version 0 is the empty store."""
        if number is None:
            number = max(self.numbers(), default=0)
        if number == 0:
            return Version()
        stream = self._fs.open(self._version_path(number))
        try:
            return Version.of(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: Version) -> None:
        """The one step that makes a commit visible: a rename that fails if the version is there."""
        target = self._version_path(version.number)
        draft = self._Path(f"{self.path}/versions/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(version.to_json().encode()))
        finally:
            out.close()
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
        how = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, target, how)
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                raise ConcurrentCommit(f"version {version.number} of {self.path} is taken") from e
            raise

    # reading ------------------------------------------------------------------

    def _frame(self, table: Table, buckets: list[int] | None = None) -> DataFrame:
        at = sorted({f for b, f in table.folders.items() if buckets is None or int(b) in buckets})
        schema = _schema(table)
        if not at:
            return self.spark.createDataFrame([], schema)
        # folders of buckets, without discovery: the version file says where rows are
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in at])

    def read(self, name: str, number: int | None = None) -> DataFrame:
        """Table ``name`` in the newest version, or in version ``number``."""
        return self._frame(self.version(number).tables[name])

    def has(self, name: str) -> bool:
        return name in self.version().tables

    # writing ------------------------------------------------------------------

    @staticmethod
    def _dealt(df: DataFrame, key: list[str], buckets: int) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets)).cast("int"))

    def _write(self, name: str, df: DataFrame, commit: str) -> tuple[dict[str, int], dict[str, str]]:
        """Writes rows that carry their bucket; rows and folder of each bucket."""
        folder = f"data/{name}/{commit}"
        # a hot bucket is split over tasks
        df.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        back = self.spark.read.schema(f"{BUCKET} INT").option("basePath", f"{self.path}/{folder}").parquet(f"{self.path}/{folder}")
        rows = {str(r[0]): r[1] for r in back.groupBy(BUCKET).count().collect()}      # one row a bucket
        return rows, {b: f"{folder}/{BUCKET}={b}" for b in rows}

    @staticmethod
    def _count_for(rows: int) -> int:
        return max(1, -(-rows // BUCKET_ROWS))

    def commit(self, changes: dict[str, Merge], keys: dict[str, list[str]] | None = None,
               batch: tuple[str, int] | None = None) -> int:
        """Merges into each table of ``changes`` and publishes them as one version; returns
        its number. A table that isn't there is made, with its key from ``keys``. A batch
        that was committed before is left out, and the version that stands is returned."""
        now = self.version()
        if batch is not None and now.batches.get(batch[0], -1) >= batch[1]:
            return now.number
        tables, commit = dict(now.tables), f"{now.number + 1:08d}-{uuid.uuid4().hex[:8]}"
        for name, change in changes.items():
            old = tables.get(name)
            tables[name] = (self._created(name, change, (keys or {})[name], commit) if old is None
                            else self._merged(name, old, change, commit))
        batches = dict(now.batches)
        if batch is not None:
            batches[batch[0]] = batch[1]
        nxt = Version(now.number + 1, tables, batches)
        self._publish(nxt)
        return nxt.number

    def _created(self, name: str, change: Merge, key: list[str], commit: str) -> Table:
        rows = change.rows if change.resolve is None else change.resolve(self._joined(None, change.rows, key))
        # written once: the count decides the buckets
        if change.stored and change.resolve is None:
            buckets = self._count_for(rows.count())
        else:
            staged = scratch_dir(self.spark, f"table-{name}")
            seen = Observation()
            rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(staged)
            buckets = self._count_for(seen.get["n"])
            rows = self.spark.read.schema(rows.schema).parquet(staged)
        n, folders = self._write(name, self._dealt(rows, key, buckets), commit)
        return Table(rows.schema.json(), key, buckets, n, folders)

    def _joined(self, old: DataFrame | None, new: DataFrame, key: list[str]) -> DataFrame:
        rest = [c for c in new.columns if c not in key]
        mine = new.select(*[F.col(f"`{c}`").alias(f"new_{c}") for c in new.columns], F.lit(True).alias("new_row"))
        if old is None:
            return mine.select(*[F.col(f"`new_{k}`").alias(k) for k in key],
                               *[F.lit(None).cast(new.schema[c].dataType).alias(f"old_{c}") for c in rest],
                               F.lit(None).cast("boolean").alias("old_row"), *[F.col(f"`new_{c}`") for c in rest], "new_row")
        theirs = old.select(*[F.col(f"`{c}`").alias(f"old_{c}") for c in old.columns], F.lit(True).alias("old_row"))
        same = reduce(lambda a, b: a & b, [F.col(f"`old_{k}`").eqNullSafe(F.col(f"`new_{k}`")) for k in key])
        j = theirs.join(mine, same, "full")
        keys = [F.when(F.col("new_row"), F.col(f"`new_{k}`")).otherwise(F.col(f"`old_{k}`")).alias(k) for k in key]
        return j.select(*keys, *[F.col(f"`old_{c}`") for c in old.columns if c not in key], "old_row", *[F.col(f"`new_{c}`") for c in rest], "new_row")

    def _merged(self, name: str, table: Table, change: Merge, commit: str) -> Table:
        schema = _schema(table)
        # the change is computed once, with its buckets: which are touched, and then the merge
        new = change.rows if change.resolve is not None else change.rows.select(*[F.col(f"`{c}`") for c in schema.names])
        new = new.withColumns({f.name: F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields if f.name in new.columns})
        total = sum(table.rows.values())
        grown = total > GROWTH * BUCKET_ROWS * table.buckets
        buckets = self._count_for(total) if grown else table.buckets
        new = self._dealt(new, table.key, buckets)
        if not change.stored:
            staged = scratch_dir(self.spark, f"change-{name}")
            new.write.parquet(staged)
            new = self.spark.read.schema(new.schema).parquet(staged)
        touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())           # one row a bucket
        old = self._frame(table) if grown else self._frame(table, touched)
        j = self._joined(old, new.drop(BUCKET), table.key)
        if change.resolve is not None:
            rows = change.resolve(j)
        else:
            rest = [c for c in schema.names if c not in table.key]
            rows = j.select(*table.key, *[F.when(F.col("new_row"), F.col(f"`new_{c}`")).otherwise(F.col(f"`old_{c}`")).alias(c) for c in rest])
        rows = rows.select(*[F.col(f"`{c}`").cast(schema[c].dataType).alias(c) for c in schema.names])
        n, folders = self._write(name, self._dealt(rows, table.key, buckets), commit)
        if grown:
            return Table(table.schema, table.key, buckets, n, folders)
        kept = lambda d: {b: x for b, x in d.items() if int(b) not in set(touched)}
        return Table(table.schema, table.key, buckets, {**kept(table.rows), **n}, {**kept(table.folders), **folders})

    # cleaning -----------------------------------------------------------------

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes version files but the newest ``keep``, and data folders that no version left
        names. Not for a store that someone writes to: a commit in the making has no version."""
        numbers = self.numbers()
        stay = numbers[-keep:]
        held = {f.rsplit("/", 1)[0] for n in stay for t in self.version(n).tables.values() for f in t.folders.values()}
        gone = []
        for n in numbers[:-keep]:
            self._fs.delete(self._version_path(n), False)
        data = self._Path(f"{self.path}/data")
        for table in self._fs.listStatus(data) if self._fs.exists(data) else []:
            for c in self._fs.listStatus(table.getPath()):
                folder = f"data/{table.getPath().getName()}/{c.getPath().getName()}"
                if folder not in held:
                    self._fs.delete(c.getPath(), True)
                    gone.append(folder)
        return gone


def _schema(table: Table) -> T.StructType:
    return T.StructType.fromJson(json.loads(table.schema))
