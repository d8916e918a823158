"""Item records: assembly, projection to a declared schema, routing and
page-grain quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLAT_REVIEW = T.StructType([
    T.StructField("attr_name", T.StringType()),
    T.StructField("attr_page", T.LongType()),
    T.StructField("review_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("visit_month", T.DateType()),
    T.StructField("companion", T.StringType()),
    T.StructField("review", T.StringType()),
])


class UndeclaredField(ValueError):
    pass


def build_attraction(name="name", location="location", labels="labels", score="score",
                     score_cnt="score_cnt", experiences="experiences", nearby="nearby") -> Column:
    """The attraction record: struct(name, location, labels, score, score_cnt,
    experiences, nearby)."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.struct(c(name).alias("name"), c(location).alias("location"), c(labels).alias("labels"),
                    c(score).alias("score"), c(score_cnt).alias("score_cnt"),
                    c(experiences).alias("experiences"), c(nearby).alias("nearby"))


def item_project(df: DataFrame, schema: T.StructType, extra: str = "error") -> DataFrame:
    """Select the declared fields in declared order and types.

    A declared field missing from ``df`` is an error. A column the item does
    not declare is an error with ``extra='error'`` (as assigning an unknown
    item field is) or dropped with ``extra='drop'``.
    """
    names = [f.name for f in schema.fields]
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise UndeclaredField(f"missing declared fields: {missing}")
    undeclared = [c for c in df.columns if c not in names]
    if undeclared and extra == "error":
        raise UndeclaredField(f"fields not declared by the item: {undeclared}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def kind_of(role: str | Column) -> Column:
    """Record kind of a tagged stream (user post = review, assistant = info)."""
    r = F.col(role) if isinstance(role, str) else role
    return F.when(r == "user", "review").when(r == "assistant", "info").otherwise("other")


def route(tagged: DataFrame, kind_col: str, kinds: list[str]) -> dict[str, DataFrame]:
    """One filtered frame per kind; every record goes to exactly one sink.
    Persist ``tagged`` first when several sinks are written."""
    out = {k: tagged.where(F.col(kind_col) == k) for k in kinds}
    known = F.col(kind_col).isin(kinds)
    out["_unrouted"] = tagged.where(~known | F.col(kind_col).isNull())
    return out


def quarantine_pages(records: DataFrame, page_keys: list[str], bad: str) -> DataFrame:
    """Page-grain verdict: a page with any bad record is 'bad' as a whole."""
    return records.groupBy(*page_keys).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col(bad)).alias("n_bad"),
    ).withColumn("status", F.when(F.col("n_bad") > 0, "bad").otherwise("good"))
