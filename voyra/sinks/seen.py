"""The set of requests already seen, kept in join order.

Fingerprints lie in a bucketed, sorted table (``CLUSTERED BY (fp) SORTED BY (fp) INTO n BUCKETS``), so an
anti-join against it moves only the new requests: Spark reads bucket i of the set beside
partition i of the requests and never shuffles the set, however large it has grown.
``add`` deals the new fingerprints out by the table's own hash, one file a bucket.

The table is files in a folder; a session registers it under a name of its own. The
number of buckets is part of the folder, since every session must know it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
SCHEMA = "fp STRING"
_NOTE = "_buckets"           # beside the data; readers skip names with an underscore


class SeenSet:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        """Opens the set in folder ``path``, or makes an empty one of ``buckets`` buckets."""
        self.spark, self.path = spark, path.rstrip("/")
        note = f"{self.path}/{_NOTE}"
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(note)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(at):
            stream = fs.open(at)
            self.buckets = int(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            stream.close()
        else:
            out = fs.create(at, False)
            out.write(bytearray(str(buckets).encode()))
            out.close()
            self.buckets = buckets
        self.table = "seen_" + hashlib.sha1(self.path.encode()).hexdigest()[:16]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({SCHEMA}) USING parquet CLUSTERED BY (fp) SORTED BY (fp) "
                  f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, requests: DataFrame, fp: str = "fp") -> DataFrame:
        """The rows of ``requests`` whose fingerprint isn't in the set (a null is never in it)."""
        seen = self.read().select(F.col("fp").alias("_seen"))
        return requests.join(seen, F.col(fp) == F.col("_seen"), "left_anti")

    def add(self, requests: DataFrame, fp: str = "fp") -> None:
        """Puts the fingerprints of ``requests`` in; those that are there already are left out."""
        new = requests.select(F.col(fp).alias("fp")).where("fp IS NOT NULL").distinct()
        new = self.unseen(new).repartition(self.buckets, "fp")
        new.write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
