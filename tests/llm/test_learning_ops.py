"""Toxicity, spelling variants and the filter audit against brute force."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ODD = [None, "", " \n\t ", "one", "Zwei Wörter, zwei", "é ü 漢字 😀 " * 120, "A B C d#" * 30, "x" * 30000 + " y",
       " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i % 40}" for i in range(300)), "Über" * 900]


@pytest.fixture(scope="module")
def prepared(spark):
    from voyra.llm.common import prepare
    return prepare(spark)


# 13 --------------------------------------------------------------------------

def brute_masks(rows):
    low = {}
    for i, t, _ in rows:
        if i is not None:
            low[t or ""] = min(low.get(t or "", i), i)
    out = []
    for i, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        rules = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), i is not None and low[t] < i]
        out.append((part or "", i, "".join(f for f, x in zip("ABCDE", rules) if x)))
    return out


def brute_audit(rows, labels):
    masks = brute_masks(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = {}
    for part in {m[0] for m in masks}:
        mine = [m for m in masks if m[0] == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [m for m in left if f in m[2]]
                left = [m for m in left if f not in m[2]]
                shapley[f] += len(gone)
                before = set(order[:k])
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), sum(f in m[2] and bool(before & set(m[2])) for m in mine),
                    sum(m[2] == f for m in mine), sum(m[1] in good for m in gone), sum(m[1] in toxic for m in gone), f]
        for key, v in out.items():
            if key[0] == part:
                v[6] = shapley[v[6]]
    return {k: tuple(v) for k, v in out.items()}


def audited(df):
    from voyra.llm import filter_audit as A
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert all(dict(df.dtypes)[c] == "bigint" for c in cols) and dict(df.dtypes)["step"] == "int"
    got = df.collect()
    assert len({(r["part"], r["filter_order"], r["step"]) for r in got}) == len(got)
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in cols) for r in got}


def test_audit_of_odd_rows(prepared):
    from voyra.llm import filter_audit as A
    texts = ODD + ["Same Text again " * 80] * 6 + [None, "", "one"]
    rows = [(i, t, "ab "[i % 3].strip() if i % 4 else None) for i, t in enumerate(texts)]
    rows += [(3, "one", "a"), (3, "one", "a"), (None, "one", "b"), (None, "Same Text again " * 80, None), (7, "other", "z")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 25, 2)] + [(None, 1, 1), (3, 1, None)]
    docs = prepared.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, part int, failed int").repartition(4)
    marks = prepared.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audited(A.audit(A.counts(docs, marks))) == brute_audit(rows, labels)
    # a label said twice counts once, by its largest value
    twice = marks.unionByName(prepared.createDataFrame([(4, 0, 1), (4, 1, 0)], marks.schema))
    assert audited(A.audit(A.counts(docs, twice))) == brute_audit(rows, labels + [(4, 1, 1)])


def test_audit_of_empty_tables(prepared):
    from voyra.llm import filter_audit as A
    docs = prepared.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    none = prepared.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(A.counts(docs.limit(0), none)).count() == 0
    assert audited(A.audit(A.counts(docs, none))) == brute_audit([(1, "a b", "s")], [])


def step_by_step(data):
    """The transducer, byte after byte, with a dictionary for the words."""
    from voyra.llm import filter_audit as A
    state, words, start, points, capitals, symbols = A.GAP, [], 0, 0, 0, 0
    for i, b in enumerate(data):
        kind = A.CLASS[b]
        out = A.OUT[state, kind]
        if out & A.STARTS:
            start = i
        if out & A.ENDS:
            words.append(data[start:i])
        points += bool(out & A.POINT)
        capitals += bool(out & A.IS_CAPITAL)
        symbols += bool(out & A.IS_SYMBOL)
        state = A.NEXT[state, kind]
    if state != A.GAP:
        words.append(data[start:])
    return len(words), len(set(words)), capitals, points, symbols


def test_transducer_steps_and_regular_expressions():
    from voyra.llm import filter_audit as A
    rng = np.random.default_rng(1)
    letters = list("aB é漢😀\n\t#|x ")
    texts = [t for t in ODD if t and len(t) < 5000] + ["".join(rng.choice(letters, int(n))) for n in rng.integers(0, 90, 200)]
    got = list(zip(*(c.tolist() for c in A.measure(pa.array(texts)))))
    for t, g in zip(texts, got):
        w = WORD.findall(t)
        assert g == (len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall(r"[#$%&*|]", t))), t
        assert g == step_by_step(t.encode()), t


def test_hash_table_verifies_words_with_one_key():
    """With the same key for all words only the comparison of bytes tells them apart."""
    from voyra.llm import bytehash as B, filter_audit as A
    words = ["a", "b", "ab", "longer word!"[:9], "longer wordx"[:9], "y" * 70 + "1", "y" * 70 + "2", "a", "b", "y" * 70 + "1", "12345678", "12345679", "12345678"]
    s = next(B.slices(pa.array([" ".join(words), " ".join(words[:4])])))
    new = A.distinct(s.buf, s.row, s.starts, s.ends, np.zeros(len(s.starts), np.uint64))
    assert np.bincount(s.row[new]).tolist() == [len(set(" ".join(words).split())), len(set(" ".join(words[:4]).split()))]


# 12 --------------------------------------------------------------------------

def brute_vocabulary(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_near(vocab):
    """Near words, candidates from shared deletions."""
    at = defaultdict(set)
    for w in vocab:
        at[w].add(w)
        for k in range(len(w)):
            at[w[:k] + w[k + 1:]].add(w)
    out = defaultdict(set)
    for group in at.values():
        for a, b in itertools.combinations(group, 2):
            if one_edit(a, b):
                out[a].add(b)
                out[b].add(a)
    return out


def brute_variants(rows):
    vocab = brute_vocabulary(rows)
    close = brute_near(vocab)
    form = {}
    for w, n in vocab.items():
        best = min(close[w], key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= 10 * n else None
    out = {}
    for w, n in vocab.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(close[w]), vocab[form[w]] if form[w] else None)
    return out


def found(df):
    got = df.collect()
    assert len({r["word"] for r in got}) == len(got)
    return {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in got}


def variant_rows(seed=0, docs=60):
    rng = np.random.default_rng(seed)
    stems = ["".join(rng.choice(list("abcdéÿx"), int(k))) for k in rng.integers(6, 12, 40)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(200):
            w = stems[min(int(rng.exponential(6)), len(stems) - 1)]
            for _ in range(int(rng.random() < 0.15) + int(rng.random() < 0.02)):
                k = int(rng.integers(0, len(w)))
                w = [w[:k] + w[k + 1:], w[:k] + "q" + w[k:], w[:k] + "z" + w[k + 1:], w + w[-1], w[0] + w][int(rng.integers(0, 5))]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("limit", [300_000, 60])
def test_variants_against_all_deletions(prepared, monkeypatch, limit):
    """With lists of 60 code points nearly every list is split, down to single places."""
    from voyra.llm import variants as V
    monkeypatch.setattr(V, "LIST_CHARS", limit)
    rows = variant_rows() + list(enumerate(ODD, 100)) + [(None, "Sonderbar sonderbar ÀÉÎ×÷ÿøé×÷ÿøé"), (3, "Sonderbar sonderbare"),
                                                        (3, "Sonderbar sonderbare"), (900, "long" * 300 + " " + "long" * 300 + " " + "long" * 299 + "lon " * 2)]
    rows += [(901, ("long" * 299 + "lon ") * 5)]
    docs = prepared.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    want = brute_variants(rows)
    assert any(v[0] and v[1] != v[0] for v in want.values()) and any(v[3] > 2 for v in want.values())
    assert found(V.variants(docs)) == want


def test_variants_of_the_test_table(prepared):
    from voyra.llm import queries, variants as V
    rows = [tuple(r) for r in prepared.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.QUERIES["op12_spelling_variants"](prepared, SF_SMALL)) == brute_variants(rows)
    empty = prepared.createDataFrame([], "doc_id long, text string")
    assert V.variants(empty).count() == 0


def test_walk_of_words_that_share_much():
    """Words of two letters: every list is dense, and edits in runs have several places."""
    from voyra.llm import variants as V
    words = sorted("".join(p) for k in (7, 8) for p in itertools.product("ab", repeat=k))
    m, size = V.matrix(pa.array(words))
    zero = np.zeros(len(words), np.int64)
    got = set()
    for least in (7, 8):
        q, v = V.walk(m, size, zero, zero, zero + (1 << 30), zero + least)
        pairs = list(zip(q.tolist(), v.tolist()))
        assert len(set(pairs)) == len(pairs)
        got |= {(words[a], words[b]) for a, b in pairs}
    assert got == {(a, b) for a, bs in brute_near(words).items() for b in bs}


def test_crc_of_spans():
    from voyra.llm import variants as V
    texts = [b"a", b"", b"abcdefgh" * 30, "é".encode() * 20, b"x" * 64, b"x" * 65]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    seed = np.array([zlib.crc32(b"%d:" % i) for i in range(len(texts))], np.uint32)
    assert V.crc32(buf, starts, ends, seed).tolist() == [zlib.crc32(b"%d:" % i + t) for i, t in enumerate(texts)]


# 11 --------------------------------------------------------------------------

def test_risk_and_its_gradient():
    from voyra.llm import toxicity as X
    rng = np.random.default_rng(3)
    positive = np.array([True] * 5 + [False] * 9)
    prior = 0.3

    def parts(z):
        loss = lambda x: np.log1p(np.exp(-x))
        toxic = prior * loss(z[positive]).mean()
        return toxic, loss(-z[~positive]).mean() - prior * loss(-z[positive]).mean()
    signs = set()
    for shift in (0.0, 4.0):
        z = rng.normal(size=14) + np.where(positive, shift, -shift)
        toxic, clean, g = X.risk_gradient(z, positive, prior)
        assert np.allclose((toxic, clean), parts(z))
        signs.add(clean < 0)
        for i in range(14):
            e = np.zeros(14)
            e[i] = 1e-6
            up, down = parts(z + e), parts(z - e)
            wanted = -(up[1] - down[1]) if clean < 0 else sum(up) - sum(down)
            assert abs(wanted / 2e-6 - g[i]) < 1e-6
    assert signs == {True, False}


def toxic_rows(n=500):
    rng = np.random.default_rng(5)
    plain = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, int(rng.integers(5, 300))))
        bad = rng.random() < 0.2
        if bad:
            words[int(rng.integers(0, len(words)))] = ["Nasty", "VILEness", "vilely,", "Éckel"][int(rng.integers(0, 4))]
        rows.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_of_held_out_rows(prepared):
    from voyra.llm import toxicity as X
    rows, labels = toxic_rows()
    odd = [(None, "nasty"), (1000, None), (1001, ""), (1002, "word1 " * 40000 + "nasty"), (1003, "nasty"), (1003, "nasty")]
    docs = prepared.createDataFrame([(*r, 9, "x") for r in rows + odd], "doc_id long, text string, toxic int, score string").repartition(4)
    marks = prepared.createDataFrame(labels + [(4444, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    model = X.fit(docs, marks)
    df, t = X.score(docs, model)
    assert df.columns == [*docs.columns, t] and t not in docs.columns
    got = df.select("doc_id", "text", f"{t}.score").collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r[2] <= 1 for r in got)
    score = {r[0]: r[2] for r in got}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 40 and np.mean([(score[i] >= 0.5) == bool(y) for i, y in held]) >= 0.98
    assert score[1000] == score[1001] == pytest.approx(1 / (1 + math.exp(-model.bias))) and score[1000] < 0.5
    assert min(score[None], score[1002], score[1003]) >= 0.5
    # labels of held-out rows and of unknown ids change nothing, and a rerun agrees
    lies = [(i, 1 - y) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, y) for i, y in labels]
    again = X.fit(docs.repartition(7), prepared.createDataFrame(lies + [(4444, 1), (None, 1), (5, None)], marks.schema))
    assert np.array_equal(again.keys, model.keys) and np.allclose(again.weights, model.weights) and again.bias == pytest.approx(model.bias)


def test_toxicity_without_examples_or_rows(prepared):
    from voyra.llm import toxicity as X
    docs = prepared.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    marks = prepared.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert X.fit(docs, marks) is None and X.fit(docs, marks.limit(0)) is None
    df, t = X.score(docs, None)
    assert [r[0] for r in df.select(f"{t}.score").collect()] == [0.0, 0.0]
    some = X.fit(docs.limit(0), prepared.createDataFrame([(1, 1), (3, 0), (7, 1)], marks.schema))
    assert some is None
    assert X.score(docs.limit(0), None)[0].count() == 0


def test_features_are_words_and_beginnings_once():
    from voyra.llm import toxicity as X
    one, same, other = X.feature_sets(pa.array(["Abcdefgh x Été", "abcdefgh, x! abcdefgh été", None]))[0].to_pylist()
    assert one == same and len(one) == 8 * (4 + 1 + 2) and other == b""     # été: 5 bytes, so its first 4 too


# 2, 4: rows that a batch sends ------------------------------------------------

def test_rows_of_a_batch_do_not_grow_with_the_buckets():
    from voyra.llm import packs
    rng = np.random.default_rng(0)
    docs, hashes = rng.integers(0, 5000, 200_000), rng.integers(0, 1 << 40, 200_000).astype(np.uint64) << np.uint64(20)
    size = {}
    for pieces in (packs.FAN, 10_001, 100_001, 1_000_001):
        rows = packs.batch_rows(docs, hashes, packs.REPEATED, pieces, 8, packs.FAN)
        size[pieces] = len(rows), sum(sum(len(x) for x in r[1:4]) for r in rows)
        assert len(rows) <= 2 * packs.FAN
    first = size[packs.FAN]
    assert all(abs(n - first[0]) < 0.1 * first[0] and abs(b - first[1]) < 0.1 * first[1] for n, b in size.values())


@pytest.mark.parametrize("fan", [3, 16])
def test_ranges_and_lanes_change_no_result(prepared, monkeypatch, fan):
    """The operators with ranges of buckets and blocks, in lanes, against those without."""
    from voyra.llm import jaccard, packs, substring
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(90)]
    texts = []
    for _ in range(60):
        w = list(base)
        for k in rng.choice(90, int(rng.integers(0, 30)), replace=False):
            w[k] = f"v{rng.integers(30)}"
        texts.append(" ".join(w[int(rng.integers(0, 20)):]))
    df = prepared.createDataFrame(list(enumerate(texts + [None, ""])), "doc_id long, text string").repartition(4)

    def results():
        cut, d = substring.deduplicate(df)
        return (sorted((r["doc_id"], *r[d]) for r in cut.collect()),
                sorted((r["id"], r["n_shingles"], r["class_id"], r["component_id"]) for r in jaccard.join(df).collect()))
    want = results()
    assert len({r[3] for r in want[1]}) > 3 and any(r[2] for r in want[0])
    monkeypatch.setattr(packs, "FAN", fan)              # 33 buckets and blocks
    assert results() == want


# 5: windows that are learnt from ----------------------------------------------

def test_picked_windows_are_those_of_the_layout():
    from voyra.llm import attention as A
    rng = np.random.default_rng(0)
    sizes = np.array([1, 5, A.BLOCK, 3 * A.BLOCK + 1, 40, 1])
    tokens = rng.integers(0, 900, sizes.sum())
    ids = [10, 11, None, 13, 14, 15]
    r = {"ids": ids, "doc_tokens": A._pack(sizes), "n_tokens": len(tokens), "chunk": 7 << 32,
         "tokens": pa.compress(tokens.astype("<u2").tobytes(), codec="zstd", asbytes=True)}
    inputs, targets, full = A.blocks(tokens, sizes)
    train = [i for i, x in enumerate(np.repeat(A.held_out(ids), -(-sizes // A.BLOCK))) if not x]
    got, goal = A._picked(r, 900, 1, 1.0)
    assert (got.reshape(-1, 2, A.BLOCK) == np.stack([inputs[full - 1], inputs[full]], 1)[train]).all()
    assert (goal == targets[full][train]).all()
    some, few = A._picked(r, 900, 1, 0.4)
    assert 0 < len(few) < len(goal) and {tuple(x) for x in few} <= {tuple(x) for x in goal}


def test_attention_learns_from_every_training_id():
    """The pass over a chunk has every id of its training texts once as a target, and the batch of blocks in a
    row has the gradient of the same windows taken apart."""
    from voyra.llm import attention as A
    rng = np.random.default_rng(3)
    ids = [i for i in range(60)]
    sizes = rng.integers(1, 40, len(ids))
    tokens = rng.integers(0, 900, int(sizes.sum()))
    r = {"ids": ids, "chunk": 5, "n_tokens": len(tokens), "doc_tokens": A._pack(sizes),
         "tokens": pa.compress(tokens.astype("<u2").tobytes(), codec="zstd", asbytes=True)}
    steps, visits, made = A._all_windows(r, 900, 0)
    made = list(made)
    train = np.repeat(~A.held_out(ids), sizes)
    goals = np.concatenate([t[t >= 0] for _, t, _ in made])
    assert len(made) == steps and sorted(goals) == sorted(tokens[train])
    assert visits[:901].sum() == train.sum() and visits[901] == (~A.held_out(ids)).sum()
    p, cls = A.initial(901), rng.integers(0, A.CLASSES, 901)
    inputs, targets, at = made[0]
    pairs = np.stack([inputs[at - 1], inputs[at]], axis=1).reshape(-1, A.BLOCK)
    g, rows, hot = A.gradient(p, inputs, targets, cls, at)
    g2, rows2, hot2 = A.gradient(p, pairs, targets, cls)
    assert all(np.allclose(g[n], g2[n], atol=1e-5) for n in g) and rows.tolist() == rows2.tolist() and np.allclose(hot, hot2, atol=1e-5)


@pytest.mark.parametrize("scale", [1, 300])
def test_attention_stretches_in_parts(monkeypatch, scale):
    """The gradient of a stretch, made in parts, is that of its windows taken apart, also with logits that are too large for exp;
    places without an id get none."""
    from voyra.llm import attention as A
    monkeypatch.setattr(A, "PART", 3)
    rng = np.random.default_rng(5)
    tokens, sizes = rng.integers(0, 50, 150), np.array([1, 40, 8, 60, 17, 24])
    p, cls = {n: x.astype(float) for n, x in A.initial(50).items()}, rng.integers(0, A.CLASSES, 50)
    p["out"], p["place"] = p["out"] * scale, rng.standard_normal(2 * A.BLOCK)
    inputs, targets, _ = A.blocks(tokens, sizes)
    at = np.arange(1, len(inputs))
    g, rows, hot = A.gradient(p, inputs, targets[1:], cls, at)
    g2, rows2, hot2 = A.gradient(p, np.stack([inputs[at - 1], inputs[at]], axis=1).reshape(-1, A.BLOCK), targets[1:], cls)
    whole, whole2 = np.zeros_like(p["embed"]), np.zeros_like(p["embed"])
    whole[rows], whole2[rows2] = hot, hot2
    assert set(g) == set(g2) == set(p) - {"embed"} and all(np.allclose(g[n], g2[n], rtol=1e-9, atol=1e-11) for n in g)
    assert np.allclose(whole, whole2, rtol=1e-9, atol=1e-11)


def test_attention_scores_hold_no_array_of_all_ids():
    """Scoring a chunk takes memory by slice, not by chunk, and gives what its documents get alone."""
    import tracemalloc
    from voyra.llm import attention as A
    rng = np.random.default_rng(6)
    sizes = rng.integers(1, 2000, 2000)
    tokens = rng.integers(0, 50, int(sizes.sum())).astype("<u2")
    p, cls = A.initial(50), rng.integers(0, A.CLASSES, 50)
    v = A.Vocabulary(cls, A.FREQUENT + cls, np.arange(50), rng.standard_normal((A.FREQUENT + A.CLASSES, 50)).astype(np.float32), np.zeros(50))
    tracemalloc.start()
    got = A.score_documents(tokens, sizes, p, v, 49)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(tokens)
    ends = np.cumsum(sizes)
    for i in (0, 700, 1999):
        assert got[i] == pytest.approx(A.score_documents(tokens[ends[i] - sizes[i]: ends[i]], sizes[i: i + 1], p, v, 49)[0], rel=1e-6)
