"""How the driver tables stand for the review-site entities.

| Entity                | Table          | Mapping                                           |
|-----------------------|----------------|---------------------------------------------------|
| fetched page          | pages          | as is                                             |
| review                | documents      | attraction = source, review = text, id = number   |
|                       |                | within source by doc_id, page = id div 10,        |
|                       |                | title = first 40 characters                       |
| labelled text         | documents      | text -> lang (4 classes); labels for quality      |
| forum post / thread   | conversations  | thread = conv_id, post = turn, user = role,       |
|                       |                | thread page = turn div 3                         |
| fetch task / attempt  | events         | attraction = 'attr' || user_id, attempt = event,  |
|                       |                | task page = attempt number div 10 within user,    |
|                       |                | failed = event_type 'error'                       |
| visit string          | events         | month of ts plus event_type in three forms        |

All mappings are column expressions over the scans, so they stay in codegen;
the only shuffles are the bucketed numberings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voyra.functions.urls import OFFSET_MARK, PAGE_SLOT
from voyra.operators.numbering import number_by_id, seq_number
from voyra.sources import tables

REVIEWS_PER_PAGE = 10
POSTS_PER_PAGE = 3
ATTEMPTS_PER_PAGE = 10
TITLE_CHARS = 40
SITE = "https://www.example-travel.org"
# review-page path: region id, attraction id, then "Reviews[-or<offset>]" and the name
REVIEW_PATH = "/Attraction_Review-g100-d"


def reviews(spark: SparkSession, sf_dir: str, with_lang: bool = True, extra: tuple = (),
            digest_only: bool = False) -> DataFrame:
    """Flat reviews: attr_name, review_id, attr_page, title, review, doc_id[, lang][, extra...].

    ``digest_only``: the body is replaced by review_key (SHA-256) and
    review_md5, computed before the numbering shuffle, so no text moves."""
    cols = ["doc_id", "source", "text"] + (["lang"] if with_lang else []) + list(extra)
    d = tables.documents(spark, sf_dir, *cols)
    body = ["text"]
    if digest_only:
        d = d.select(*[c for c in d.columns if c != "text"], F.substring("text", 1, TITLE_CHARS).alias("title"),
                     F.sha2("text", 256).alias("review_key"), F.md5("text").alias("review_md5"))
        body = ["review_key", "review_md5"]
    else:
        d = d.withColumn("title", F.substring("text", 1, TITLE_CHARS))
    d = number_by_id(d, ["source"], "doc_id", out="review_id")
    out = [F.col("source").alias("attr_name"), "review_id",
           F.floor(F.col("review_id") / REVIEWS_PER_PAGE).cast("long").alias("attr_page"), "title"]
    out += [F.col("text").alias("review")] if not digest_only else body
    out.append("doc_id")
    if with_lang:
        out.append("lang")
    return d.select(*out, *extra)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forum posts: conv_id, page, turn, username, posttime, text."""
    c = tables.conversations(spark, sf_dir, "conv_id", "turn", "role", "text")
    return c.select(
        "conv_id",
        F.floor(F.col("turn") / POSTS_PER_PAGE).cast("long").alias("page"),
        "turn",
        F.col("role").alias("username"),
        F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("posttime"),
        "text",
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch attempts: attr_name, page, attempt, ts, event_id, failed."""
    e = tables.events(spark, sf_dir, "event_id", "ts", "user_id", "event_type")
    e = seq_number(e, ["user_id"], ["ts", "event_id"], out="attempt")
    return e.select(
        F.concat(F.lit("attr"), F.col("user_id").cast("string")).alias("attr_name"),
        F.floor(F.col("attempt") / ATTEMPTS_PER_PAGE).cast("long").alias("page"),
        "attempt", "ts", "event_id",
        (F.col("event_type") == "error").alias("failed"),
    )


def attempt_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds for the task table: attr_name, n = attempts logged (no numbering needed)."""
    e = tables.events(spark, sf_dir, "user_id")
    g = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.concat(F.lit("attr"), F.col("user_id").cast("string")).alias("attr_name"), "n")


def visit_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit strings in the three stored forms: event_id, visit.

    event_id % 3 = 0: "Mon yyyy  type"; 1: "Mon yyyy • type"; 2: "Mon yyyy",
    except errors in form 2, which carry the sentinel NONE.
    """
    e = tables.events(spark, sf_dir, "event_id", "ts", "event_type")
    month = F.date_format("ts", "MMM yyyy")
    form = F.col("event_id") % 3
    visit = (F.when(form == 0, F.concat(month, F.lit("  "), F.col("event_type")))
             .when(form == 1, F.concat(month, F.lit(" • "), F.col("event_type")))
             .when(F.col("event_type") == "error", F.lit("NONE"))
             .otherwise(month))
    return e.select("event_id", visit.alias("visit"))


def attraction_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed attraction records, one per source (a grouped aggregate with
    map-side combine; every collected array is bounded by the 4 languages).

    name = source; labels = sorted distinct languages; location = [source,
    upper(first language)]; score = mean length in thousands, in tenths, capped
    at 5.0; score_cnt = number of reviews; experiences = {short: [n < 1000
    chars], long: [n >= 1000 chars]}; nearby = ([cafe <min doc>], [spot <max doc>]).
    """
    d = tables.documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars")
    g = d.groupBy(F.col("source").alias("attr_name")).agg(
        F.array_sort(F.collect_set("lang")).alias("labels"),
        F.min("lang").alias("_l"),
        F.least(F.lit(50), F.floor(F.sum("n_chars") / F.count(F.lit(1)) / 100)).cast("long").alias("_tenths"),
        F.count(F.lit(1)).alias("score_cnt"),
        F.count_if(F.col("n_chars") < 1000).alias("_short"),
        F.count_if(F.col("n_chars") >= 1000).alias("_long"),
        F.min("doc_id").alias("_min"), F.max("doc_id").alias("_max"),
    )
    return g.select(
        "attr_name",
        F.col("attr_name").alias("name"),
        F.array("attr_name", F.upper("_l")).alias("location"),
        "labels",
        (F.col("_tenths").cast("decimal(4,0)") / 10).cast("decimal(2,1)").alias("score"),
        "score_cnt",
        F.map_from_arrays(F.array(F.lit("short"), F.lit("long")),
                          F.array(F.array(F.col("_short").cast("string")),
                                  F.array(F.col("_long").cast("string")))).alias("experiences"),
        F.struct(F.array(F.concat(F.lit("cafe "), F.col("_min").cast("string"))).alias("near_restas"),
                 F.array(F.concat(F.lit("spot "), F.col("_max").cast("string"))).alias("near_attras"))
        .alias("nearby"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled text for classification: doc_id, text, label (= lang)."""
    d = tables.documents(spark, sf_dir, "doc_id", "text", "lang")  # tokenised next
    return d.select("doc_id", "text", F.col("lang").alias("label"))


def review_page_url(attr_name, attr_page) -> "F.Column":
    """Site URL of one review page (the offset is the first review on it)."""
    return F.concat(
        F.lit(SITE + REVIEW_PATH),
        F.regexp_extract(attr_name, r"(\d+)$", 1),
        F.lit("-" + PAGE_SLOT + OFFSET_MARK),
        (attr_page * REVIEWS_PER_PAGE).cast("string"),
        F.lit("-"), attr_name, F.lit(".html"),
    )
