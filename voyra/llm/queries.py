"""The registered queries opN_<name> and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: F401

from voyra.llm.common import ORACLE, QUERIES, query, read
from voyra.llm import (attention, bpe, filter_audit, jaccard, lengths, mixing, qalsh, quality as Q, secret_scan, substring,
                       toxicity, variants, warc)


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, suffix-array repetition and the verdict of every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    df, q = Q.quality(docs, keep=["doc_id"])
    return df.select("doc_id", f"{q}.*")


@query("op8_warc_revisits", sql="""
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT page_id, n, hex, array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((
      CAST('0x' || substr(hex, CAST(1 + 5 * (k // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31) AS INT), 1)), '') AS digest
  FROM d),
m AS (SELECT *, max(page_id) OVER (PARTITION BY hex, n) AS top FROM bits)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM m
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back; revisits joined to their responses."""
    return warc.archive(read(spark, sf_dir, "pages", "page_id", "url", "html"))


@query("op10_source_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and its training position."""
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "position")


def _either(pattern: str) -> str:
    """The keywords of the assign rule with each letter in either case, for RE2."""
    return re.sub(r"\(\?i:([^()]*)\)", lambda m: "(?:" + re.sub(
        "[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", m[1]) + ")", pattern)


def _secret_sql() -> str:
    cols, lists = [], []
    for i, r in enumerate(secret_scan.RULES):
        rx = _either(r.pattern).replace("'", "''")
        cols.append(f"regexp_extract_all(t, '{rx}') AS m{i}, string_split_regex(t, '{rx}') AS p{i}, "
                    f"regexp_extract_all(t, '{rx}', {r.group}) AS v{i}")
        start = (f"coalesce(list_sum(list_transform(p{i}[1:k], lambda x: length(x))), 0) + "
                 f"coalesce(list_sum(list_transform(m{i}[1:k - 1], lambda x: length(x))), 0)")
        lists.append(f"list_transform(list_filter(range(1, len(m{i}) + 1), lambda k: length(v{i}[k]) >= {r.min_chars}), "
                     f"lambda k: {{'s': CAST({start} AS BIGINT), 'r': {i}, 'e': CAST({start} + length(m{i}[k]) AS BIGINT), 'kind': '{r.kind}'}})")
    text = "array_to_string(list_transform({}, lambda x: x.kind || ':' || x.s || ':' || x.e), ',')"
    base = "list_filter(s, lambda x: x.r < 3)"
    count = ", ".join(f"CAST(len(list_filter(s, lambda x: x.r = {i})) AS BIGINT) AS n_{r.kind}"
                      for i, r in enumerate(secret_scan.BASE))
    return (f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), "
            f"f AS (SELECT doc_id, {', '.join(cols)} FROM d), "
            f"g AS (SELECT doc_id, list_sort(list_concat({', '.join(lists)})) AS s FROM f) "
            f"SELECT doc_id, {count}, sha256(coalesce({text.format(base)}, '')) AS base_sha256, "
            f"coalesce({text.format('s')}, '') AS spans FROM g")


@query("op6_secret_scans", sql=_secret_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, found through the trigram index."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    df, spans = secret_scan.scan(docs)
    kinds = [r.kind for r in secret_scan.BASE]
    base = F.filter(F.col(spans), lambda s: s["kind"].isin(kinds))
    counts = [F.size(F.filter(F.col(spans), secret_scan.is_kind(k))).cast("long").alias(f"n_{k}") for k in kinds]
    return df.select("doc_id", *counts, F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
                     secret_scan.span_text(F.col(spans)).alias("spans"))


@query("op1_bpe_codec")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded through the distinct-word table, and decoded again."""
    coded = bpe.encode(read(spark, sf_dir, "documents", "doc_id", "text"))
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    coded = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(decimal, 256).alias("ids_sha256"), "ids")
    back, text = bpe.decode(coded)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col(text), 256).alias("decoded_sha256"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, quantile shares and truncated totals for every context limit."""
    return lengths.limits(lengths.histogram(read(spark, sf_dir, "documents", "text")))


@query("op2_substring_dedup", sql="""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
starts AS (
  SELECT doc_id, ws, CAST(unnest(range(1, greatest(len(ws) - 11, 1))) AS BIGINT) AS p FROM w),
windows AS (SELECT doc_id, p, sha256(array_to_string(ws[p:p + 12], ' ')) AS h FROM starts),
low AS (SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h),
hit AS (SELECT DISTINCT doc_id, p FROM windows JOIN low USING (h) WHERE doc_id > first_doc),
gone AS (
  SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, p + unnest(range(13)) AS k FROM hit) GROUP BY doc_id),
cut AS (
  SELECT w.doc_id, ws, coalesce(ks, []) AS ks FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ks) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(ks, i)), ' ')) AS kept_sha256
FROM cut
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a 13-word window shares with an earlier document, removed."""
    df, d = substring.deduplicate(read(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])
    return df.select("doc_id", f"{d}.n_words", f"{d}.n_removed", F.sha2(F.col(d)["kept"], 256).alias("kept_sha256"))


@query("op4_ngram_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicate documents (4-word shingles, Jaccard 0.85 or more) of every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard.join(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "class_id")


@query("op3_collision_neighbours")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every vector whose id is divisible by 100, among all vectors."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return qalsh.nearest(vectors, vectors.filter("vec_id % 100 = 0"), 10)


@query("op5_attention_scores")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base score and attention-model score of every document."""
    return attention.score(read(spark, sf_dir, "documents", "doc_id", "text"))


@query("op11_pu_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, from classifiers trained on confirmed and unlabelled text."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    df, t = toxicity.score(docs, model, keep=["doc_id"])
    score = F.col(t)["score"]
    return df.select("doc_id", F.coalesce(~toxicity.in_training(F.col("doc_id")), F.lit(False)).alias("held_out"),
                     score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


@query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with its near words, its form and its root."""
    return variants.variants(read(spark, sf_dir, "documents", "doc_id", "text"))


@query("op13_filter_audit", sql="""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
m AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
f AS (
  SELECT part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN low < m.doc_id THEN 16 ELSE 0 END AS failed,
    CASE WHEN quality = 1 THEN 1 ELSE 0 END AS good, CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS bad
  FROM m LEFT JOIN labels ON labels.doc_id = m.doc_id),
c AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM f GROUP BY part, failed),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
o AS (
  SELECT l1.x || l2.x || l3.x || l4.x || l5.x AS filter_order, [l1.b, l2.b, l3.b, l4.b, l5.b] AS bits
  FROM l l1, l l2, l l3, l l4, l l5 WHERE l1.b + l2.b + l3.b + l4.b + l5.b = 31
    AND len(list_distinct([l1.x, l2.x, l3.x, l4.x, l5.x])) = 5),
s AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before
  FROM o, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step) k),
r AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN failed & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN failed & bit > 0 AND failed & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failed & bit > 0 AND failed & before > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failed & bit > 0 AND failed & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN failed & bit > 0 AND failed & before = 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of every order of five filters keeps and removes, by source."""
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    return filter_audit.audit(filter_audit.counts(docs, read(spark, sf_dir, "labels", "doc_id", "quality", "toxic")))
