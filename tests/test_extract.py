"""Extractors on hand-written markup (invented text)."""

from voyra.functions import html as H
from voyra.operators import extract as XT
from voyra.plans.q_extract import typed_attraction, typed_reviews

ATTRACTION = """<html><body><h1>Smith&#39;s Gallery, Old Town</h1>
<div class="labels">Museums&Art Galleries &amp; Halls</div><ul class="extra-labels"><li>Free entry</li></ul>
<span class="score">4.5</span><span class="score-count">1,234 reviews</span>
<div class="near-restas"><ul></ul></div><div class="near-attras"><ul><li>Canal Walk</li><li>Tower</li></ul></div>
<div class="exp-tabs"><button>Tours</button><button>Tickets</button><button>Tours</button></div>
<div class="exp-panel"><ul><li>Morning tour</li></ul></div><div class="exp-panel"><ul><li>Day pass</li></ul></div>
<div class="exp-panel"><ul><li>Evening tour</li><li>Night tour</li></ul></div>
</body></html>"""


def test_attraction_fields_and_last_experience_wins(spark):
    pages = spark.createDataFrame([("a1", ATTRACTION)], "attr_name STRING, html STRING")
    a = typed_attraction(XT.extract_attractions(pages, "html", ["attr_name"])).first()
    assert a.name == "Smith's Gallery, Old Town"
    assert a.labels == ["Museums", "Art Galleries ", " Halls", "Free entry"]
    assert a.location == []                     # no location block on the page
    assert str(a.score) == "4.5" and a.score_cnt == 1234
    assert a.experiences == {"Tours": ["Evening tour", "Night tour"], "Tickets": ["Day pass"]}
    assert a.nearby.near_restas == [] and a.nearby.near_attras == ["Canal Walk", "Tower"]


def slot(title, time, frags):
    t = f'<div class="time">{time}</div>' if time is not None else ""
    spans = "".join(f"<span>{f}</span>" for f in frags)
    return (f'<div class="review"><div class="user">u</div><div class="bubble">*</div>'
            f'<div class="title">{title}</div>{t}<div class="body">{spans}</div></div>')


REVIEW_PAGE = ("<html><body><h1>Tower</h1>"
               + slot("Lovely", "Jul 2021 • Family", ["Nice ", "view."])
               + slot("", "Mar 2019  Solo", ["No title here."])
               + slot("Quiet", None, ["Body sits one div earlier."])
               + slot("Busy", "Aug 2020", ["Crowded<br>but fine &amp; fun"])
               + "".join(slot(f"t{i}", "Jan 2020  Friends", ["x"]) for i in range(8))
               + "</body></html>")


def test_review_slots_fill_and_stop(spark):
    pages = spark.createDataFrame([("Tower", 2, REVIEW_PAGE)], "attr_name STRING, attr_page INT, html STRING")
    raw = XT.extract_reviews(pages, "html", ["attr_name", "attr_page"])
    assert raw.count() == 10                     # at most ten slots a page
    filled = typed_reviews(raw).orderBy("review_id").collect()
    r0, r1, r2, r3 = filled[:4]
    assert (r0.review_id, r0.title, r0.time, r0.type, r0.review) == (20, "Lovely", "Jul 2021", "Family", "Nice view.")
    assert (r1.title, r1.time, r1.type) == ("NONE", "Mar 2019", "Solo")
    assert (r2.title, r2.time, r2.review) == ("Quiet", None, "Body sits one div earlier.")
    assert r3.review == "Crowdedbut fine & fun" and str(r3.visit_month) == "2020-08-01"
    stopped = typed_reviews(raw, on_missing="stop").collect()
    assert [r.review_id for r in stopped] == [20]


FORUM = ("<html><body><h1 class='topic'>Best time to visit?</h1><div class='pageno'>Page 1</div>"
         "<div class='post'><div class='username'>ann</div><div class='posttime'>1 May</div>"
         "<div class='posttext'><p>First para<p>Second para</p></div></div>"
         "<div class='post'><div class='posttime'>2 May</div><div class='posttext'><p>Reply</p></div></div>"
         "<a class='next' href='/forum/t-page-2.html'>Next</a></body></html>")


def test_forum_page(spark):
    pages = spark.createDataFrame([(7, FORUM)], "conv_id LONG, html STRING")
    rows = XT.extract_forum(pages, "html", ["conv_id"]).orderBy("post_no").collect()
    assert rows[0].topic == "Best time to visit?" and rows[0].page == "Page 1"
    assert rows[0].next == "/forum/t-page-2.html"
    assert rows[0].username == "ann" and rows[0].posttext == ["First para", "Second para"]
    assert rows[1].username is None and rows[1].posttext == ["Reply"]


def test_escaped_text_round_trips_through_the_parser(spark):
    from pyspark.sql import functions as F

    from voyra.functions.html import html_escape
    tricky = ['a < b && c > d', 'say "hi" & \'bye\'', '&amp; is not &', '</div><script>x</script>',
              'café • naïve', '&#39; &lt;tag&gt;', 'line1\nline2']
    df = spark.createDataFrame([(t,) for t in tricky], "t STRING")
    html = df.select(F.concat(F.lit('<div class="review"><div>u</div><div>*</div><div class="title">'),
                              html_escape(F.col("t")), F.lit('</div><div class="body"><span>'),
                              html_escape(F.col("t")), F.lit("</span></div></div>")).alias("h")).collect()
    for t, row in zip(tricky, html):
        (r,) = XT.reviews_of(row.h)
        assert r["title"] == t and r["fragments"] == [t]


def test_parser_survives_broken_markup():
    root = XT.parse_html("<div class='a'><p>one<br><b>two</div><p>three")
    assert [XT.text(n) for n in XT.select(root, "div.a p")] == ["onetwo"]
    assert XT.text(XT.select_one(root, "p")) == "onetwo"
    assert XT.select(root, "span") == []


def test_sql_table_functions_match_dataframe_form(spark):
    XT.register_sql_functions(spark)
    pages = spark.createDataFrame([("Tower", 2, REVIEW_PAGE)], "attr_name STRING, attr_page INT, html STRING")
    pages.createOrReplaceTempView("review_pages_fixture")
    via_sql = spark.sql("SELECT p.attr_name, p.attr_page, s.* FROM review_pages_fixture p, "
                        "LATERAL review_slots(p.html) s")
    via_df = XT.extract_reviews(pages, "html", ["attr_name", "attr_page"])
    assert sorted(map(tuple, via_sql.collect())) == sorted(map(tuple, via_df.collect()))
    forum = spark.createDataFrame([(7, FORUM)], "conv_id LONG, html STRING")
    forum.createOrReplaceTempView("forum_fixture")
    rows = spark.sql("SELECT f.conv_id, s.* FROM forum_fixture f, LATERAL forum_posts(f.html) s").collect()
    assert [r.username for r in rows] == ["ann", None]


def test_links_and_heading_in_any_form(spark):
    page = ("<H1 class=x>Salt &amp; <B>Light</B></H1><A HREF='/one'>1</A><a class=\"n\" href=/two>2</a>"
            "<a href = \"/q?a=1&amp;b=2\">3</a><a name=\"x\">none</a><a data-href=\"no\" href=\"\">4</a>")
    got = spark.createDataFrame([(page,), (None,)], "html string").select(H.html_links("html"), H.html_title("html")).collect()
    assert list(got[0][0]) == ["/one", "/two", "/q?a=1&b=2", ""] and got[0][1] == "Salt & Light"
    assert got[1][0] is None and got[1][1] is None


def test_entities_are_decoded_once(spark):
    """Against the standard library, for entities with a semicolon."""
    import html
    texts = ["&amp;lt;", "a &lt;b&gt; &#39;c&#x27; &quot;", "&eacute;&Eacute;&euro;&nbsp;&hellip;", "&#128512; &#x1F600;", "&unknown; & &; &#; &amp",
             "&#0;&#xD800;&#x110000;&#9999999;", "&#150;&#x80;", "plain", "", "&apos;", "a&amp;b&amp;amp;c"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = [r[0] for r in df.select(H.html_unescape("t")).collect()]
    expect = [html.unescape(t) for t in texts]
    expect[4] = "&unknown; & &; &#; &amp"           # the last has no semicolon
    assert got == expect + [None]


def test_links_in_comments_scripts_and_styles_are_none(spark):
    page = ("<!-- <a href='/no1'>x</a> --><script>s = \"<a href='/no2'>y</a>\"</script><style>a:after{content:\"<a href=/no3>\"}</style>"
            "<A HREF='/a?x=1&amp;y=2'>One &amp; <b>two</b></A><a class=\"x\" href=\"\">empty</a><a href=/b>B</a><a name='c'>none</a>")
    df = spark.createDataFrame([(page,), (None,)], "html string")
    links, both = df.select(H.html_links("html"), H.html_links_and_texts("html")).first()
    assert links == ["/a?x=1&y=2", "", "/b"]
    assert [tuple(x) for x in both] == [("/a?x=1&y=2", "One & two"), ("", "empty"), ("/b", "B")]
    title = spark.createDataFrame([("<h1>Smith&#39;s &lt;Gallery&gt; &amp;amp;</h1>",)], "html string").select(H.html_title("html")).first()[0]
    assert title == "Smith's <Gallery> &amp;"
