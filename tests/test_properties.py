"""Property tests: Spark expressions against a plain-Python brute force on
random text, and numbering against the plain window on random keys."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from voyra.functions import text as X
from voyra.operators.numbering import id_bucket, seq_number

PIECES = st.sampled_from(["<em>", "</em>", "<!--red_beg-->", "<!--red_end-->", "❤️", "❤", "\U0001F44D",
                          "•", "  ", "\n", "é", "a", "Z", " ", "~", " ", "\U0001F600", "️"])
TEXTS = st.lists(st.one_of(st.text(max_size=12), st.lists(PIECES, max_size=8).map("".join)), min_size=1,
                 max_size=40)


def brute_clean(s: str) -> str:
    for m in X.MARKERS:
        s = s.replace(m, "")
    for emo, alias in X.EMOJI_ALIASES:
        s = s.replace(emo, alias)
    return re.sub(r"[^ -~]", "", s)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_clean_text_matches_brute_force_and_is_idempotent(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, s STRING")
    got = dict(df.select("i", X.clean_text("s").alias("c")).collect())
    for i, t in enumerate(texts):
        assert got[i] == brute_clean(t)
        assert brute_clean(got[i]) == got[i]


_SEG = st.text(alphabet="abcXYZ019-_", min_size=1, max_size=5)
_PATH = (st.lists(_SEG, max_size=3).map(lambda p: "/" + "/".join(p)) | st.just("")
         | st.lists(_SEG, min_size=1, max_size=3).map(lambda p: "/" + "/".join(p) + "/"))
_BASE = st.builds(lambda s, h, p, q, f: f"{s}://{h}.org{p}{q}{f}", st.sampled_from(["http", "https"]), _SEG, _PATH,
                  st.sampled_from(["", "?a=1", "?b=2&c=3"]), st.sampled_from(["", "#top"]))
_ROOTED = st.lists(_SEG, min_size=1, max_size=3).map(lambda p: "/" + "/".join(p))
_HREF = st.one_of(_ROOTED, st.builds(lambda s, p: s + p, _SEG, _PATH),
                  st.sampled_from(["", "?p=2", "#r5", "//cdn.org/x", "https://other.org/y", "mailto:a@b.org"]),
                  st.builds(lambda p, q: p + q, _ROOTED, st.sampled_from(["?x=1", "#f"])))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_BASE, _HREF), min_size=20, max_size=60))
def test_url_join_matches_urllib_without_dot_segments(spark, pairs):
    from urllib.parse import urljoin

    from voyra.functions import urls as U
    df = spark.createDataFrame(pairs, "b STRING, h STRING")
    got = [r[0] for r in df.select(U.url_join("b", "h")).collect()]
    assert got == [urljoin(b, h) for b, h in pairs]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "hot", None]), st.integers(0, 10_000)),
                min_size=1, max_size=200, unique_by=lambda x: (x[0], x[1])),
       st.integers(1, 300))
def test_seq_number_is_row_number(spark, rows, width):
    df = spark.createDataFrame(rows, "k STRING, id LONG")
    got = seq_number(df, ["k"], ["id"], id_bucket("id", width), out="s")
    want = df.withColumn("s", F.row_number().over(Window.partitionBy("k").orderBy("id")) - 1)
    key = lambda r: (str(r.k), r.id, r.s)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    by_range = seq_number(df, ["k"], ["id"], out="s")          # range form: any id spacing
    assert sorted(map(key, by_range.collect())) == sorted(map(key, want.collect()))
