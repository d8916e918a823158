"""Readers for the driver tables.

Every reader goes through ``spark.read.parquet`` with the declared schema, so
Spark prunes columns and pushes filters into the scan; callers select only the
columns they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Declared schemas of the input tables (as read by Spark).
SCHEMAS = {
    "pages": "page_id BIGINT, url STRING, html STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "benchmark": "item_id BIGINT, text STRING",
}



def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan a driver table; one plan for tables of every size."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    df = reader.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def pages(spark, sf_dir, *cols):
    return table(spark, sf_dir, "pages", *cols)


def documents(spark, sf_dir, *cols):
    return table(spark, sf_dir, "documents", *cols)


def labels(spark, sf_dir, *cols):
    return table(spark, sf_dir, "labels", *cols)


def conversations(spark, sf_dir, *cols):
    return table(spark, sf_dir, "conversations", *cols)


def events(spark, sf_dir, *cols):
    return table(spark, sf_dir, "events", *cols)
