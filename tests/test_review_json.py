"""The crawler's stored layout: one pretty-printed page document per file in a
folder per attraction (invented text)."""

import json
import os

from pyspark.sql import functions as F

from voyra.operators import reviews as R
from voyra.sources import files as src


def write_fixture(root):
    pages = {
        ("Old Mill", 0): [("Great", "Jul 2021  Family", "Lovely place :red_heart:"),
                          ("Busy", "NONE", "Too crowded at noon.")],
        ("Old Mill", 1): [("Great", "Jul 2021  Family", "Lovely place :red_heart:")],
        ("Sam's Pier", 0): [("Windy", "Mar 2019 • Couples", "Café was shut.")],
    }
    for (name, page), reviews in pages.items():
        os.makedirs(f"{root}/{name}", exist_ok=True)
        doc = {"attr_name": name, "attr_page": page,
               "attr_reviews": {str(page * 10 + i): {"title": t, "time": tm.split("  ")[0] if "  " in tm else tm,
                                                     "type": tm.split("  ")[1] if "  " in tm else "NONE",
                                                     "review": body}
                                for i, (t, tm, body) in enumerate(reviews)}}
        with open(f"{root}/{name}/{name}__reviews_{page}.json", "w") as f:
            json.dump(doc, f, indent=2)


def test_read_layout_explode_dedup(spark, tmp_dir):
    write_fixture(tmp_dir)
    pages = src.read_review_pages(spark, tmp_dir, layout="files")
    assert pages.count() == 3
    flat = R.explode_reviews(pages)
    assert flat.where(F.floor(F.col("review_id") / 10) != F.col("attr_page")).count() == 0
    assert flat.count() == 4
    dedup = R.dedup_reviews(flat.select("attr_name", "review_id", "title", "time", "type", "review"))
    assert dedup.count() == 3
    pier = flat.where("attr_name = \"Sam's Pier\"").first()
    assert pier.time == "Mar 2019 • Couples" and pier.review == "Café was shut."
