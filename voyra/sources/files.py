"""File sources: review-page JSON documents, labelled-text CSV, fingerprint text.

All readers take an explicit schema, so there is no inference pass over the
data and the plan is fixed before the first byte is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voyra.sources.json_documents import read_documents

REVIEW = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("review", T.StringType()),
])

REVIEW_PAGE = T.StructType([
    T.StructField("attr_name", T.StringType()),
    T.StructField("attr_page", T.LongType()),
    # JSON object keys are strings; the key is page * 10 + slot.
    T.StructField("attr_reviews", T.MapType(T.StringType(), REVIEW)),
])

ATTRACTION_INFO = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("location", T.ArrayType(T.StringType())),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("score", T.StringType()),
    T.StructField("score_cnt", T.StringType()),
    T.StructField("experiences", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("nearby", T.StructType([
        T.StructField("near_restas", T.ArrayType(T.StringType())),
        T.StructField("near_attras", T.ArrayType(T.StringType())),
    ])),
])

ATTRACTION = T.StructType([
    T.StructField("attr_name", T.StringType()),
    T.StructField("attr_info", ATTRACTION_INFO),
])

POST = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("posttime", T.StringType()),
    T.StructField("posttext", T.ArrayType(T.StringType())),
])

THREAD_PAGE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("firstpost", POST),
    T.StructField("replypost", T.ArrayType(POST)),
])

LABELLED_TEXT = "doc_id BIGINT, input STRING, output STRING, target INT"

# CSV options for text with quotes, commas and line breaks (RFC 4180 quoting),
# and no trimming of the values on either side.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "FAILFAST",
}


# how a review-page document begins (the crawler dumps the name first)
REVIEW_PAGE_STARTS = r'\{\s*"attr_name"\s*:'
REVIEW_FILES = "*__reviews_*.json"


def read_review_pages(spark: SparkSession, path: str, layout: str = "lines", glob: str = REVIEW_FILES) -> DataFrame:
    """Review-page documents.

    ``layout='lines'``: one document per line (what ``sinks`` writes).
    ``layout='files'``: indented documents, one file or several appended to it back to back,
    in a folder per attraction named ``{attr}/{attr}__reviews_{page}.json`` (the crawler's
    form). Only readable documents; ``read_review_faults`` has the rest.
    """
    if layout == "lines":
        return spark.read.schema(REVIEW_PAGE).json(path)
    d = read_documents(spark, path, REVIEW_PAGE, glob, REVIEW_PAGE_STARTS)
    return d.where(F.col("fault").isNull()).select("document.*")


def read_review_faults(spark: SparkSession, path: str, glob: str = REVIEW_FILES) -> DataFrame:
    """(path, place, fault, body) of what the files hold besides readable documents."""
    d = read_documents(spark, path, REVIEW_PAGE, glob, REVIEW_PAGE_STARTS)
    return d.where(F.col("fault").isNotNull()).select("path", "place", "fault", "body")


def read_attractions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ATTRACTION).json(path)


def read_labelled_csv(spark: SparkSession, path: str, schema: str = LABELLED_TEXT) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def read_page_files(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """Saved pages, one file each -> (url, html); the url is the file path."""
    df = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true") \
        .text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def read_fingerprints(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One 40-character hex digest per line -> fp. With ``glob``, every file
    of that name below ``path`` (one seen-file per crawl folder)."""
    r = spark.read
    if glob:
        r = r.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return r.text(path).withColumnRenamed("value", "fp")
