"""Record extraction from page markup: attraction, review and forum pages.

Runs as ``mapInPandas``: Spark partitions the pages, each Python worker
parses an Arrow batch with the standard library's ``html.parser`` and
returns flat rows with a declared schema. Selectors are parameters (the
site's class names are generated and change), written as
``tag.class descendant.class``; positions follow XPath (1-based).
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"p", "div", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article",
          "header", "footer", "nav", "form", "pre", "blockquote", "aside", "main"}
# element -> start tags that end it while it is open (HTML's optional end tags)
AUTO_CLOSE = {"p": _BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
              "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
# containers that stop the search for an element to close
SCOPE = {"#root", "html", "body", "div", "ul", "ol", "table", "article", "section", "td", "th", "li",
         "blockquote", "main", "aside", "nav", "header", "footer", "form"}

# --- default selector tables (parameters, not site facts) ------------------
ATTRACTION_SELECTORS = {
    "name": "h1",
    "labels": "div.labels",
    "extra_labels": "ul.extra-labels li",
    "location": "div.location span",
    "score": "span.score",
    "score_cnt": "span.score-count",
    "near_restas": "div.near-restas li",
    "near_attras": "div.near-attras li",
    "exp_names": "div.exp-tabs button",
    "exp_panels": "div.exp-panel",
    "exp_items": "li",
}
REVIEW_SELECTORS = {
    "name": "h1",
    "pager": "div.pager",
    "slot": "div.review",
    "title": "div.title",
    "time": "div.time",
    "body_with_time": 5,      # child div holding the body when a time is shown
    "body_without_time": 4,   # ... and when it is not
    "fragment": "span",
    "max_slots": 10,
}
FORUM_SELECTORS = {
    "topic": "h1.topic",
    "page": "div.pageno",
    "post": "div.post",
    "username": "div.username",
    "posttime": "div.posttime",
    "posttext": "div.posttext p",
    "next": "a.next",
}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    @property
    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.cur = self.root

    def _implicit_close(self, tag):
        """An open element that this start tag ends (``<p>`` ends an open
        ``<p>``, ``<li>`` an open ``<li>`` ...), looked up to the nearest
        container; close it and everything opened inside it."""
        n = self.cur
        while n is not None:
            if tag in AUTO_CLOSE.get(n.tag, ()):
                self.cur = n.parent
                return
            if n.tag in SCOPE:
                return
            n = n.parent

    def handle_starttag(self, tag, attrs):
        self._implicit_close(tag)
        n = Node(tag, dict(attrs), self.cur)
        self.cur.children.append(n)
        if tag not in VOID:
            self.cur = n

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, dict(attrs), self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent   # closes any unclosed children too

    def handle_data(self, data):
        self.cur.children.append(data)


def parse_html(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def _matches(n: Node, simple: str) -> bool:
    tag, *classes = simple.split(".")
    return (not tag or n.tag == tag) and all(c in n.classes for c in classes)


def _descendants(n: Node) -> Iterator[Node]:
    for c in n.children:
        if isinstance(c, Node):
            yield c
            yield from _descendants(c)


def select(n: Node, selector: str) -> list[Node]:
    """Descendant selector, document order, no duplicates."""
    found = [n]
    for simple in selector.split():
        nxt, seen = [], set()
        for f in found:
            for d in _descendants(f):
                if id(d) not in seen and _matches(d, simple):
                    seen.add(id(d))
                    nxt.append(d)
        found = nxt
    return found


def select_one(n: Node, selector: str) -> Node | None:
    r = select(n, selector)
    return r[0] if r else None


def texts(n: Node) -> list[str]:
    """All text nodes under ``n`` (XPath ``.//text()``)."""
    out = []
    for c in n.children:
        out.extend([c] if isinstance(c, str) else texts(c))
    return out


def text(n: Node | None) -> str | None:
    return None if n is None else "".join(texts(n))


def child_elements(n: Node, tag: str) -> list[Node]:
    return [c for c in n.children if isinstance(c, Node) and c.tag == tag]


# --- per-page extractors (plain Python, used inside mapInPandas) ----------

def attraction_of(html: str, sel: dict = ATTRACTION_SELECTORS) -> dict:
    root = parse_html(html)
    panels = select(root, sel["exp_panels"])
    return {
        "name": text(select_one(root, sel["name"])),
        "labels_text": text(select_one(root, sel["labels"])),
        "extra_labels": [text(x) for x in select(root, sel["extra_labels"])],
        "location": [text(x) for x in select(root, sel["location"])],
        "score": text(select_one(root, sel["score"])),
        "score_cnt": text(select_one(root, sel["score_cnt"])),
        "near_restas": [text(x) for x in select(root, sel["near_restas"])],
        "near_attras": [text(x) for x in select(root, sel["near_attras"])],
        "exp_names": [text(x) for x in select(root, sel["exp_names"])],
        "exp_lists": [[text(i) for i in select(p, sel["exp_items"])] for p in panels],
    }


def reviews_of(html: str, sel: dict = REVIEW_SELECTORS) -> list[dict]:
    root = parse_html(html)
    out = []
    for i, slot in enumerate(select(root, sel["slot"])[: sel["max_slots"]]):
        divs = child_elements(slot, "div")
        time = select_one(slot, sel["time"])
        pos = sel["body_with_time"] if time is not None else sel["body_without_time"]
        body = divs[pos - 1] if len(divs) >= pos else None
        frags = [text(x) for x in select(body, sel["fragment"])] if body is not None else None
        out.append({"slot": i, "title": text(select_one(slot, sel["title"])),
                    "time": text(time), "fragments": frags})
    return out


def forum_of(html: str, sel: dict = FORUM_SELECTORS) -> dict:
    root = parse_html(html)
    nxt = select_one(root, sel["next"])
    posts = []
    for p in select(root, sel["post"]):
        posts.append({"username": text(select_one(p, sel["username"])),
                      "posttime": text(select_one(p, sel["posttime"])),
                      "posttext": [text(x) for x in select(p, sel["posttext"])]})
    return {"topic": text(select_one(root, sel["topic"])), "page": text(select_one(root, sel["page"])),
            "next": None if nxt is None else nxt.attrs.get("href"), "posts": posts}


# --- Spark wrappers --------------------------------------------------------

ATTRACTION_OUT = ("name STRING, labels_text STRING, extra_labels ARRAY<STRING>, location ARRAY<STRING>, "
                  "score STRING, score_cnt STRING, near_restas ARRAY<STRING>, near_attras ARRAY<STRING>, "
                  "exp_names ARRAY<STRING>, exp_lists ARRAY<ARRAY<STRING>>")
REVIEW_OUT = "slot INT, title STRING, time STRING, fragments ARRAY<STRING>"
FORUM_OUT = ("topic STRING, page STRING, next STRING, post_no INT, username STRING, posttime STRING, "
             "posttext ARRAY<STRING>")


def _schema(df: DataFrame, keep: list[str], out: str) -> str:
    types = dict(df.dtypes)
    return ", ".join(f"{k} {types[k]}" for k in keep) + ", " + out


def extract_attractions(pages: DataFrame, html: str, keep: list[str],
                        sel: dict = ATTRACTION_SELECTORS) -> DataFrame:
    """One row per page with the raw attraction fields (typed in Spark later)."""
    def run(batches):
        for b in batches:
            recs = [attraction_of(h, sel) for h in b[html]]
            out = pd.DataFrame(recs, columns=list(attraction_of("", sel).keys()))
            for k in reversed(keep):
                out.insert(0, k, b[k].values)
            yield out
    return pages.mapInPandas(run, _schema(pages, keep, ATTRACTION_OUT))


def extract_reviews(pages: DataFrame, html: str, keep: list[str],
                    sel: dict = REVIEW_SELECTORS) -> DataFrame:
    """One row per review slot (1 page -> up to ``max_slots`` rows)."""
    cols = [*keep, "slot", "title", "time", "fragments"]

    def run(batches):
        for b in batches:
            rows = []
            kv = [b[k].values for k in keep]
            for i, h in enumerate(b[html]):
                for r in reviews_of(h, sel):
                    rows.append([v[i] for v in kv] + [r["slot"], r["title"], r["time"], r["fragments"]])
            yield pd.DataFrame(rows, columns=cols)
    return pages.mapInPandas(run, _schema(pages, keep, REVIEW_OUT))


def extract_forum(pages: DataFrame, html: str, keep: list[str],
                  sel: dict = FORUM_SELECTORS) -> DataFrame:
    """One row per post with the page's topic, page label and next link."""
    cols = [*keep, "topic", "page", "next", "post_no", "username", "posttime", "posttext"]

    def run(batches):
        for b in batches:
            rows = []
            kv = [b[k].values for k in keep]
            for i, h in enumerate(b[html]):
                f = forum_of(h, sel)
                for j, p in enumerate(f["posts"]):
                    rows.append([v[i] for v in kv] + [f["topic"], f["page"], f["next"], j,
                                                      p["username"], p["posttime"], p["posttext"]])
            yield pd.DataFrame(rows, columns=cols)
    return pages.mapInPandas(run, _schema(pages, keep, FORUM_OUT))


# --- SQL-facing form -------------------------------------------------------

def register_sql_functions(spark) -> None:
    """Register the extractors as Python table functions for SQL, e.g.

        SELECT p.attr_name, s.* FROM pages p, LATERAL review_slots(p.html) s

    (Arrow-batched UDTFs; the DataFrame form above is ``extract_*``)."""
    from pyspark.sql.functions import udtf

    @udtf(returnType=REVIEW_OUT, useArrow=True)
    class ReviewSlots:
        def eval(self, html: str):
            for r in reviews_of(html or ""):
                yield r["slot"], r["title"], r["time"], r["fragments"]

    @udtf(returnType=ATTRACTION_OUT, useArrow=True)
    class AttractionFields:
        def eval(self, html: str):
            a = attraction_of(html or "")
            yield tuple(a[k] for k in ("name", "labels_text", "extra_labels", "location", "score", "score_cnt",
                                       "near_restas", "near_attras", "exp_names", "exp_lists"))

    @udtf(returnType=FORUM_OUT, useArrow=True)
    class ForumPosts:
        def eval(self, html: str):
            f = forum_of(html or "")
            for j, p in enumerate(f["posts"]):
                yield f["topic"], f["page"], f["next"], j, p["username"], p["posttime"], p["posttext"]

    spark.udtf.register("review_slots", ReviewSlots)
    spark.udtf.register("attraction_fields", AttractionFields)
    spark.udtf.register("forum_posts", ForumPosts)
