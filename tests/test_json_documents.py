"""Files of JSON documents that follow each other without a separator."""

import json
import os

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from voyra.operators import reviews as R
from voyra.sinks import files as sinks
from voyra.sources import files as src
from voyra.sources import json_documents as JD


def page(name, number, *bodies):
    return {"attr_name": name, "attr_page": number,
            "attr_reviews": {str(number * 10 + i): {"title": f"t{i}", "time": "Jul 2021", "type": "NONE", "review": b}
                             for i, b in enumerate(bodies)}}


def dump(*docs):
    return "".join(json.dumps(d, indent=2) for d in docs)


def walk(text):
    """Objects of a well-formed run of objects, character by character."""
    out, depth, inside, escaped, start = [], 0, False, False, 0
    for i, c in enumerate(text):
        if inside:
            inside = not (c == '"' and not escaped)
            escaped = c == "\\" and not escaped
        elif c == '"':
            inside, escaped = True, False
        elif c == "{":
            start = i if not depth else start
            depth += 1
        elif c == "}":
            depth -= 1
            if not depth:
                out.append(text[start:i + 1])
    return out


JSON_TEXT = st.text(alphabet='{}[]"\\ :,aé\n', max_size=12)
OBJECTS = st.lists(st.dictionaries(JSON_TEXT, st.recursive(JSON_TEXT | st.integers(), lambda x: st.dictionaries(JSON_TEXT, x, max_size=2), max_leaves=4),
                                   max_size=3), max_size=5)


@given(OBJECTS, st.sampled_from(["", "\n", " \n "]), st.sampled_from([None, 2]))
@settings(max_examples=150, deadline=None)
def test_split_gives_back_every_object(objects, between, indent):
    text = between.join(json.dumps(o, indent=indent, ensure_ascii=False) for o in objects)
    body = text.encode()
    got = list(JD.split(body))
    assert all(fault is None for *_, fault in got)
    pieces = [body[a:b].decode() for a, b, _ in got]
    assert pieces == walk(text)
    assert [json.loads(p) for p in pieces] == objects


@given(OBJECTS, st.integers(0, 400), st.text(alphabet='{}"\\ax', max_size=6))
@settings(max_examples=150, deadline=None)
def test_no_byte_is_lost_whatever_the_text(objects, cut, junk):
    body = (dump(*objects)[:cut] + junk + dump(*objects)).encode()
    last = 0
    for a, b, _ in JD.split(body, r"\{"):
        assert a >= last and b > a and not body[last:a].strip()
        last = b
    assert not body[last:].strip()


def test_appended_files(spark, tmp_dir):
    """Three objects, braces and quotes inside strings, a truncated last one."""
    hard = 'a "quoted" } brace { and \\ a backslash\\" }{'
    one, two, three = page("Old Mill", 0, hard, "Lovely"), page("Old Mill", 1, "é }"), page("Old Mill", 0, "again")
    files = {"Old Mill/Old Mill__reviews_0.json": dump(one, two, three) + dump(page("Old Mill", 2, "cut"))[:-20],
             "Pier/Pier__reviews_0.json": dump(page("Pier", 0, "x")), "Pier/Pier__reviews_1.json": "",
             "Pier/notes.json": "{}", "Pier/Pier__reviews_2.json": "log line\n" + dump(page("Pier", 2, "y")) + " } ",
             "Pier/Pier__reviews_3.json": '{"attr_name": "Pier", "attr_page": "three"}'}
    for name, text in files.items():
        os.makedirs(os.path.dirname(f"{tmp_dir}/{name}"), exist_ok=True)
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    rows = src.read_review_pages(spark, tmp_dir, layout="files").collect()
    got = sorted((r.attr_name, r.attr_page, tuple(v["review"] for v in r.attr_reviews.values())) for r in rows)
    assert got == [("Old Mill", 0, (hard, "Lovely")), ("Old Mill", 0, ("again",)), ("Old Mill", 1, ("é }",)),
                   ("Pier", 0, ("x",)), ("Pier", 2, ("y",))]
    faults = sorted((os.path.basename(r.path), r.fault, r.body) for r in src.read_review_faults(spark, tmp_dir).collect())
    assert [(p.replace("%20", " "), f) for p, f, _ in faults] == [
        ("Old Mill__reviews_0.json", "object without an end"), ("Pier__reviews_2.json", "stray closing brace"),
        ("Pier__reviews_2.json", "text between objects"), ("Pier__reviews_3.json", "not of the schema")]
    assert faults[0][2] == dump(page("Old Mill", 2, "cut"))[:-20]


def test_a_run_that_died_hides_no_later_run():
    docs = [page("A", 0, "one {"), page("A", 1, "two"), page("A", 2, "three")]
    for cut in range(1, len(dump(docs[0]))):
        body = (dump(docs[0])[:cut] + dump(docs[1], docs[2])).encode()
        good = [json.loads(body[a:b]) for a, b, fault in JD.split(body, src.REVIEW_PAGE_STARTS) if fault is None]
        assert good == docs[1:], cut


def test_numbers_beyond_32_bits(spark, tmp_dir):
    big = 5_000_000_000
    with open(f"{tmp_dir}/x__reviews_0.json", "w") as f:
        f.write(dump(page("Far", big, "a", "b")))
    flat = R.explode_reviews(src.read_review_pages(spark, tmp_dir, layout="files")).orderBy("review_id").collect()
    assert [(r.attr_page, r.review_id) for r in flat] == [(big, big * 10), (big, big * 10 + 1)]


def test_appended_sink_and_reader(spark, tmp_dir):
    pages = spark.createDataFrame([(f"n{i % 2}", i // 2, {str(i): f'a " }} {{ {i}'}) for i in range(40)],
                                  "attr_name string, attr_page long, attr_reviews map<string,string>")
    for _ in range(2):
        sinks.write_json_appended(pages, f"{tmp_dir}/out", "attr_name", "attr_page", per_row=8)
    back = JD.read_documents(spark, f"{tmp_dir}/out", pages.schema, "part-*")
    assert back.where("fault is not null").count() == 0
    key = lambda r: (r[0], r[1], sorted(r[2].items()))
    assert sorted(map(key, back.select("document.*").collect())) == sorted(map(key, 2 * pages.collect()))
    text = spark.read.text(f"{tmp_dir}/out", wholetext=True).agg(F.max("value")).first()[0]
    assert "}{" in text and "\n  " in text


def test_appended_files_are_bounded(spark, tmp_path, monkeypatch):
    """A reader holds a file whole, so files end after a number of records, and are cut without copies of the body."""
    from voyra.sinks import files as FS
    monkeypatch.setattr(FS, "APPENDED_ROWS", 2, raising=False)
    df = spark.createDataFrame([("k", i) for i in range(40)], "attr_name string, attr_page long").coalesce(1)
    path = FS.write_json_appended(df, str(tmp_path / "out"), "attr_name", "attr_page", per_row=4)
    pieces = JD.read_pieces(spark, path, "part-*").collect()
    per_file = {p.path: sum(q.path == p.path for q in pieces) for p in pieces}
    assert len(pieces) == 40 and max(per_file.values()) <= 8
    body = '{"a": "é}"} x {"b": 1}'.encode()
    assert list(JD.split(memoryview(body))) == list(JD.split(body))
