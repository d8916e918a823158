"""Shared DuckDB SQL fragments for the oracle statements.

These restate the entity mappings of ``voyra.plans.entities`` in SQL, from
the definitions, so the oracle does not go through the Spark code.
"""

from __future__ import annotations

from voyra.functions.text import EMOJI_ALIASES

REVIEWS = """reviews AS (
  SELECT source AS attr_name, doc_id, lang, text AS review,
         substring(text, 1, 40) AS title,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS review_id,
         (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 10 AS attr_page
  FROM documents)"""

POSTS = """posts AS (
  SELECT conv_id, turn // 3 AS page, turn, role AS username,
         'turn ' || CAST(turn AS VARCHAR) AS posttime, text
  FROM conversations)"""

ATTEMPTS = """attempts AS (
  SELECT 'attr' || CAST(user_id AS VARCHAR) AS attr_name,
         (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS page,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS attempt,
         ts, event_id, event_type = 'error' AS failed
  FROM events)"""

VISITS = """visits AS (
  SELECT event_id,
         CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%b %Y') || '  ' || event_type
              WHEN event_id % 3 = 1 THEN strftime(ts, '%b %Y') || ' • ' || event_type
              WHEN event_type = 'error' THEN 'NONE'
              ELSE strftime(ts, '%b %Y') END AS visit
  FROM events)"""


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def demojize(expr: str) -> str:
    for emo, alias in EMOJI_ALIASES:
        expr = f"replace({expr}, {q(emo)}, {q(alias)})"
    return expr


def clean(expr: str) -> str:
    marked = f"regexp_replace({expr}, '<!--red_beg-->|<!--red_end-->|<em>|</em>', '', 'g')"
    return f"regexp_replace({demojize(marked)}, '[^ -~]', '', 'g')"


def unescape(expr: str) -> str:
    """The entities of the test pages decoded (the last one last)."""
    for entity, text in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        expr = f"replace({expr}, {q(entity)}, {q(text)})"
    return expr


def title(html: str) -> str:
    """Text of a page's first heading, tags removed, entities decoded; NULL without one."""
    h1 = "'(?s)<h1[^>]*>(.*?)</h1>'"
    text = f"trim(regexp_replace(regexp_extract({html}, {h1}, 1), '<[^>]*>', '', 'g'))"
    return f"CASE WHEN regexp_matches({html}, {h1}) THEN {unescape(text)} END"


LINK_RX = (r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
           r"""|<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)""")


def links(html: str) -> str:
    """List of the links of a page: either quote or none, comments, scripts and styles left out."""
    found = f"list_filter(regexp_extract_all({html}, '{LINK_RX}', 1), lambda x: x <> '')"
    bare = """regexp_replace(x, '^["'']|["'']$', '', 'g')"""
    return f"list_transform({found}, lambda x: {unescape(bare)})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

INFO = """info AS (
  SELECT source AS attr_name, source AS name,
         list_sort(list(DISTINCT lang)) AS labels,
         [source, upper(min(lang))] AS location,
         CAST(least(50, floor(sum(n_chars) / count(*) / 100)) AS BIGINT) AS tenths,
         CAST(count(*) AS BIGINT) AS score_cnt,
         count(*) FILTER (WHERE n_chars < 1000) AS n_short,
         count(*) FILTER (WHERE n_chars >= 1000) AS n_long,
         'cafe ' || CAST(min(doc_id) AS VARCHAR) AS near_resta,
         'spot ' || CAST(max(doc_id) AS VARCHAR) AS near_attra
  FROM documents GROUP BY source)"""

CODES = """codes AS (
  SELECT source AS name, dense_rank() OVER (ORDER BY source) - 1 AS code
  FROM (SELECT DISTINCT source FROM documents))"""

LANG_CODES = """lang_codes AS (
  SELECT lang AS name, dense_rank() OVER (ORDER BY lang) - 1 AS code
  FROM (SELECT DISTINCT lang FROM documents))"""

SPLIT = """split AS (
  SELECT doc_id, text, lang AS label,
         CASE WHEN ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 < 6
              THEN 'train' ELSE 'test' END AS part
  FROM documents)"""
