"""Training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. When a stage begins, the one
before it is written: the intermediate tables that it made are deleted then, but for those
that ``docs`` itself still reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voyra.llm import bpe, jaccard, mixing, quality as Q, secret_scan
from voyra.llm.common import discard, prepare, read, scratch, tables_made

_left: list[str] = []            # intermediate tables of the stage that was called last


def _begin(spark: SparkSession, docs: DataFrame) -> None:
    prepare(spark)
    if _left:
        files = docs.inputFiles()
        still = [p for p in _left if any(p in f for f in files)]
        discard(spark, *[p for p in _left if p not in still])
        _left[:] = still


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the repetition rule."""
    _begin(spark, docs)
    return Q.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the n-gram Jaccard join (five words, 0.8 or more) the document with the smallest id."""
    _begin(spark, docs)
    with tables_made() as made:
        out = jaccard.one_of_each(docs, length=5, percent=80)
    _left.extend(made)
    return out


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, found secrets replaced by a mark; ``n_chars`` follows the text."""
    _begin(spark, docs)
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream: documents that the mix takes, repeated as it repeats them,
    sorted by training position."""
    _begin(spark, docs)
    with tables_made() as made:
        out = mixing.mixed_documents(docs)
    _left.extend(made)
    return out


def written_place() -> Column:
    """Place of a row in the order in which its table was written: part file, file of
    that task, row. It rises along the order; it isn't a count."""
    name = F.col("_metadata.file_name")
    part, file = (F.coalesce(F.regexp_extract(name, p, 1).try_cast("long"), F.lit(0).cast("long"))
                  for p in (r"^part-(\d+)", r"-c(\d+)\."))
    return F.shiftleft(part, 42) + F.shiftleft(file, 31) + F.col("_metadata.row_index")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the stream, and the text that they decode to. The rows
    come in any order; sorted by ``position`` they are the stream as source_mix wrote it."""
    _begin(spark, docs)
    docs = docs.select(F.struct("doc_id", written_place().alias("position")).alias("row"), "text")
    decoded, text = bpe.decode(bpe.encode(docs, "row"))
    return decoded.select("row.doc_id", "row.position", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.col(text).alias("decoded"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

# The repetition rule and the tokenizer's merges have no SQL form; the tests
# hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepare(spark), sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch(docs, f"pipeline-{name}")
    return docs
