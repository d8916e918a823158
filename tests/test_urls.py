from voyra.functions import urls as U


def test_url_join_forms(spark):
    base = "https://www.example.org/Attraction_Review-g1-d2-Reviews-or10-x.html?a=1#top"
    cases = [("https://other.org/p", "https://other.org/p"), ("//cdn.org/x", "https://cdn.org/x"),
             ("/ShowTopic-g1", "https://www.example.org/ShowTopic-g1"),
             ("?page=2", "https://www.example.org/Attraction_Review-g1-d2-Reviews-or10-x.html?page=2"),
             ("#r5", "https://www.example.org/Attraction_Review-g1-d2-Reviews-or10-x.html?a=1#r5"),
             ("", base),
             ("next.html", "https://www.example.org/next.html")]
    df = spark.createDataFrame([(base, h) for h, _ in cases], "b STRING, h STRING")
    got = [r[0] for r in df.select(U.url_join("b", "h")).collect()]
    assert got == [e for _, e in cases]
    bare = spark.createDataFrame([("https://host.org", "a")], "b STRING, h STRING")
    assert bare.select(U.url_join("b", "h")).first()[0] == "https://host.org/a"


def test_url_page_no_needs_three_integers(spark):
    df = spark.createDataFrame([("https://x.org/Attraction_Review-g100-d2042-Reviews-or30-Old_Mill.html",),
                                ("https://x.org/a-1-b-2",), ("https://x.org/none",)], "u STRING")
    assert [r[0] for r in df.select(U.url_page_no("u")).collect()] == [3, None, None]


def test_url_template_every_occurrence(spark):
    df = spark.createDataFrame([("a-Reviews-b-Reviews",)], "u STRING")
    assert df.select(U.url_template("u", 20)).first()[0] == "a-Reviews-or20-b-Reviews-or20"


def test_fingerprint_is_40_hex(spark):
    fp = spark.createDataFrame([("https://x.org/",)], "u STRING").select(U.url_fingerprint("u")).first()[0]
    assert len(fp) == 40 and all(c in "0123456789abcdef" for c in fp)


def test_abs_url(spark):
    df = spark.createDataFrame([("/a",), ("//b.org/c",), ("http://d.org",)], "h STRING")
    assert [r[0] for r in df.select(U.abs_url("h", "https://site.org")).collect()] == \
        ["https://site.org/a", "//b.org/c", "http://d.org"]


def test_url_join_folds_dot_segments(spark):
    from urllib.parse import urljoin
    bases = ["http://h.org/a/b/c.html", "http://h.org", "http://h.org/a/?x=1#f"]
    links = ["../x.html", "./x", "../../../up", "..", ".", "/a/./b/../c?q=../d", "d/../e#../f", "plain", ".hidden", "a..b"]
    pairs = [(b, l) for b in bases for l in links]
    df = spark.createDataFrame(pairs, "b string, l string")
    got = [r[0] for r in df.select(U.url_join("b", "l")).collect()]
    assert got == [urljoin(b, l) for b, l in pairs]
