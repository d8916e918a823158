"""The walk over typed links against a queue in plain Python."""

from collections import deque

import numpy as np
from pyspark.sql import functions as F

from voyra.operators import frontier as FR

SITE = FR.Site(patterns=(("list", r"/list"), ("item", r"/item"), ("page", r"/page")),
               leads={"list": ("list", "item"), "item": ("page",), "page": ("page",)}, names=("item",))


def queue(links, roots, site):
    """Breadth first; of several ways to a page on its level the smallest (parent, context)."""
    found = {u: (0, None, None) for u in roots}
    todo = deque(sorted(roots))
    while todo:
        level, ways = set(todo), {}
        for u in todo:
            for a, b, kind, label in links:
                if a == u and b not in found:
                    context = (label or "") if kind in site.names else found[u][2]
                    ways.setdefault(b, []).append((u, context))
        todo = deque(sorted(ways))
        for b, w in ways.items():
            depth = found[w[0][0]][0] + 1
            found[b] = (depth, *min(w, key=lambda x: (x[0], x[1] is not None, x[1] or "")))
        assert not level & set(todo)
    return found


def kind(u):
    return next((k for k in ("list", "item", "page") if f"/{k}" in u), None)


def test_walk_against_a_queue(spark):
    rng = np.random.default_rng(4)
    urls = [f"http://h/{k}{i}" for k, n in (("list", 8), ("item", 30), ("page", 60), ("other", 5)) for i in range(n)]
    links = []
    while len(links) < 230:                       # cycles, links to itself, repeated links with other labels
        a, b = (urls[int(x)] for x in rng.integers(0, len(urls), 2))
        if kind(b) in SITE.leads.get(kind(a), ()):
            links.append((a, b, kind(b), None if rng.random() < 0.1 else f"label {rng.integers(5)}"))
    links += [links[0], (urls[0], urls[0], "list", "self"), (None, urls[1], "list", "x"), (urls[0], None, None, "x")]
    df = spark.createDataFrame(links, FR.LINKS).repartition(3)
    roots = [urls[0], urls[1]]
    got = FR.walk(spark, df, spark.createDataFrame([(u,) for u in roots + [roots[0], None]], "url string"), SITE)
    rows = {r["url"]: (r["depth"], r["parent"], r["context"]) for r in got.collect()}
    assert rows == queue([x for x in links if x[0] and x[1]], roots, SITE) and len(rows) > 40
    assert got.count() == len(rows) and all(r["kind"] == kind(r["url"]) for r in got.collect())
    near = FR.walk(spark, df, spark.createDataFrame([(urls[0],)], "url string"), SITE, max_depth=1)
    assert near.agg(F.max("depth")).first()[0] == 1


def test_typed_links_of_pages(spark):
    pages = [("http://h/list1", "<a href='/item1'>One &amp; all</a><a href='page9'>no: lists lead to items</a><a href='list2#x'>more</a>"
                                "<!-- <a href='/item7'>hidden</a> --><a href='http://else/item3'>far</a>"),
             ("http://h/item1", "<a href='./page1?p=2'>P</a><a href='/item2'>no</a>"), ("http://h/other", "<a href='/item1'>no kind</a>"), ("http://h/list3", None)]
    got = FR.typed_links(spark.createDataFrame(pages, "url string, html string"), SITE).collect()
    assert sorted(tuple(r) for r in got) == [
        ("http://h/item1", "http://h/page1?p=2", "page", "P"), ("http://h/list1", "http://else/item3", "item", "far"),
        ("http://h/list1", "http://h/item1", "item", "One & all"), ("http://h/list1", "http://h/list2", "list", "more")]


def test_walk_from_nothing(spark):
    none = spark.createDataFrame([], FR.LINKS)
    assert FR.walk(spark, none, spark.createDataFrame([], "url string"), SITE).count() == 0
    assert FR.walk(spark, none, spark.createDataFrame([("http://h/list1",)], "url string"), SITE).count() == 1


def test_rounds_send_hashes_of_the_level_only(spark, monkeypatch):
    """Neither the links nor what was found before goes through the driver, and all levels lie in one folder."""
    from voyra.operators import frontier as FR
    site = FR.Site((("page", "^p"),), {"page": ("page",)})
    links = spark.createDataFrame([(f"p{i}", f"p{j}", "page", "") for i in range(9) for j in (i + 1, i - 1, 0)], FR.LINKS)
    roots = spark.createDataFrame([("p0",)], "url string")
    sent, broadcast = [], FR.F.broadcast
    monkeypatch.setattr(FR.F, "broadcast", lambda df: sent.append(df.columns) or broadcast(df))
    got = FR.walk(spark, links, roots, site)
    folders = {f.rsplit("/", 1)[0] for f in got.inputFiles()}
    # p-1 is reached from p0
    want = sorted([(f"p{i}", i, f"p{i - 1}" if i else None) for i in range(10)] + [("p-1", 1, "p0")])
    assert sorted((r.url, r.depth, r.parent) for r in got.collect()) == want
    assert sent and {tuple(c) for c in sent} == {("_h",)} and len(folders) == 1
    monkeypatch.setattr(FR, "SENT_ROWS", 0)
    assert sorted((r.url, r.depth, r.parent) for r in FR.walk(spark, links, roots, site).collect()) == want


def test_depths_block_by_block_are_least():
    """The walk inside blocks, in any order of rounds, against breadth-first search."""
    rng = np.random.default_rng(7)
    for trial in range(60):
        n, width, most = int(rng.integers(1, 40)), int(rng.integers(1, 20)), int(rng.choice([0, 1, 3, FR.FAR]))
        f, t = np.concatenate([rng.integers(0, n, (2, int(rng.integers(0, 3 * n)))), np.tile(np.arange(n), (2, 1))], axis=1)
        roots = rng.integers(0, n, 2)
        want, todo, d = {int(r): 0 for r in roots}, set(map(int, roots)), 0
        while todo and d < most:
            d += 1
            todo = {int(b) for a, b in zip(f, t) if a in todo} - set(want)
            want.update(dict.fromkeys(todo, d))
        got, news = {}, {int(r): 0 for r in roots}
        while news:
            block = int(rng.choice(sorted({p // width for p in news})))       # one block a round
            here = {p: d for p, d in news.items() if p // width == block}
            mine = f // width == block
            pairs = [(np.array([*x], np.int64), np.array([*x.values()], np.int64)) for x in ({p: d for p, d in got.items() if p // width == block}, here)]
            page, depth, there, then = FR.nearest(f[mine], t[mine], *pairs, most)
            assert all(got.get(int(p), FR.FAR) > d for p, d in zip(page, depth)) and not set(there // width) & {block}
            got.update(zip(page.tolist(), depth.tolist()))
            news = {p: d for p, d in news.items() if p not in here}
            for p, d in zip(there.tolist(), then.tolist()):
                news[p] = min(d, news.get(p, FR.FAR))
        assert got == want, trial
    way = {5: 3, 3: 9, 9: 2, 7: 3, 2: 40}
    assert FR.ends(np.array([*way]), np.array([*way.values()])).tolist() == [40] * 5


def test_rounds_do_not_grow_with_the_depth(spark, monkeypatch):
    """A long chain is walked in one round a block, whatever its levels; names go down all of it."""
    n = 240
    chain = [(f"http://h/page{i:03}", f"http://h/page{i + 1:03}", "page", "next") for i in range(n)]
    links = spark.createDataFrame([("http://h/list1", "http://h/item1", "item", "It"), ("http://h/item1", "http://h/page000", "page", "")] + chain
                                  + [(b, a, "page", "back") for a, b, _, _ in chain[::7]], FR.LINKS).repartition(4)
    roots = spark.createDataFrame([("http://h/list1",)], "url string")
    rounds, near = [], FR._near
    monkeypatch.setattr(FR, "_near", lambda *a: rounds.append(a) or near(*a))
    want = [("http://h/list1", 0, None, None), ("http://h/item1", 1, "http://h/list1", "It"), ("http://h/page000", 2, "http://h/item1", "It")] \
        + [(b, i + 3, a, "It") for i, (a, b, _, _) in enumerate(chain)]
    for size, most in ((FR.BLOCK_LINKS, 1), (130, 8)):
        monkeypatch.setattr(FR, "BLOCK_LINKS", size)
        rounds.clear()
        got = FR.walk(spark, links, roots, SITE)
        assert sorted((r.url, r.depth, r.parent, r.context) for r in got.collect()) == sorted(want) and 1 <= len(rounds) <= most


def test_blocks_against_a_queue(spark, monkeypatch):
    rng = np.random.default_rng(5)
    urls = [f"http://h/{k}{i}" for k, n in (("list", 8), ("item", 20), ("page", 40)) for i in range(n)]
    links = []
    while len(links) < 120:
        a, b = (urls[int(x)] for x in rng.integers(0, len(urls), 2))
        if kind(b) in SITE.leads.get(kind(a), ()):
            links.append((a, b, kind(b), None if rng.random() < 0.1 else f"label {rng.integers(5)}"))
    links += [("http://h/list0", f"http://h/list{i}", "list", "") for i in range(1, 8)]
    monkeypatch.setattr(FR, "BLOCK_LINKS", 40)
    want = queue(links, ["http://h/list0"], SITE)
    for most in (None, 3):
        got = FR.walk(spark, spark.createDataFrame(links, FR.LINKS), spark.createDataFrame([("http://h/list0",)], "url string"), SITE, most)
        assert {r["url"]: (r["depth"], r["parent"], r["context"]) for r in got.collect()} == {u: w for u, w in want.items() if most is None or w[0] <= most}
