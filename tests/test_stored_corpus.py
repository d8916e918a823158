"""A stored corpus in the crawler's layout (written here, invented text): read, explode,
dedup, visit split and fingerprints against the same figures in plain Python."""

import json
import os

import pytest
from pyspark.sql import functions as F

from voyra.functions import text as X
from voyra.operators import reviews as R
from voyra.sources import files as src

KINDS = ["NONE", "Couples", "Family", "Friends", "Solo", "Business"]
MONTHS = ["Jan 2020", "Jul 2021", "NONE", "Mar 2019"]


def visit(i):
    """The three stored forms: split, not split (bullet in the time), without a kind."""
    time, kind = MONTHS[i % 4], KINDS[i % 6]
    return (f"{time} • {kind}", "NONE") if i % 7 == 0 and time != "NONE" and kind != "NONE" else (time, kind)


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    """12 attractions of 4 pages of 10 reviews; page 3 repeats page 1 under new numbers; two runs of
    the last attraction's first page are in one file."""
    root, rows = tmp_path_factory.mktemp("corpus"), []
    for a in range(12):
        name = f"Place {a}'s Hall"
        os.makedirs(root / name)
        for page in range(4):
            shown = 1 if page == 3 else page
            doc = {"attr_name": name, "attr_page": page, "attr_reviews": {}}
            for slot in range(10):
                i = a * 100 + shown * 10 + slot
                time, kind = visit(i)
                review = {"title": f"Title {i % 50}", "time": time, "type": kind, "review": f"Body {i} {{:red_heart:}} \"é\""}
                doc["attr_reviews"][str(page * 10 + slot)] = review
                rows.append((name, page, page * 10 + slot, review))
            runs = 2 if a == 11 and page == 0 else 1
            rows += [r for r in rows[-10:]] * (runs - 1)
            (root / name / f"{name}__reviews_{page}.json").write_text(json.dumps(doc, indent=2) * runs)
        (root / name / "requests.seen").write_text("".join(f"{a * 10 + k:040x}\n" for k in range(a + 1)))
    return str(root), rows


def test_stored_corpus_figures(spark, corpus):
    path, rows = corpus
    pages = src.read_review_pages(spark, path, layout="files")
    assert pages.count() == 49 and src.read_review_faults(spark, path).count() == 0
    flat = R.explode_reviews(pages)
    assert flat.count() == len(rows) == 490
    assert flat.where(F.floor(F.col("review_id") / 10) != F.col("attr_page")).count() == 0
    assert R.dedup_reviews(flat).count() == len({(n, r["title"], r["review"]) for n, _, _, r in rows}) == 360
    v = X.split_visit("time")
    companion = F.coalesce(X.none_if_sentinel("type"), v["type"], F.lit("NONE"))
    got = dict(map(tuple, flat.groupBy(companion.alias("c")).count().collect()))
    want = {}
    for *_, r in rows:
        kind = r["time"].split(" • ")[1] if " • " in r["time"] else r["type"]
        want[kind] = want.get(kind, 0) + 1
    assert got == want and len(want) == 6
    assert flat.where(X.visit_month(v["time"]).isNull()).count() == sum(r["time"] == "NONE" for *_, r in rows)


def test_stored_fingerprints(spark, corpus):
    fps = src.read_fingerprints(spark, corpus[0], glob="requests.seen")
    assert fps.count() == sum(range(1, 13))
    assert fps.where(~F.col("fp").rlike("^[0-9a-f]{40}$")).count() == 0
