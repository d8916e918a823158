"""Secret scans through a trigram inverted index; DataFrame functions only.

Every rule's regex is turned into a Boolean query over trigrams of the
lower-cased text: an AND of clauses, each an OR of alternatives, each an AND of
trigrams that any match must hold. The inverted index is a table (gram, id) of
the trigrams that some query names; intersecting its postings per id gives each
rule's candidates, which meet their texts in one join and are verified with
the regex itself. A rule without mandatory trigrams (a run of hex digits) scans
every text.

Offsets come from the regex's own cut of the text: matches and the pieces
between them, with cumulative lengths in code points. The cumulative sums are
made in two levels of ``CHUNK``: a match costs at most ``CHUNK`` additions, and the sums
over chunks the square of the number of chunks (a 131,072nd of that of the matches).

Defined results: a null or empty text has no spans; rows that repeat an id are
scanned each by itself; a null id is an id like any other; an empty table gives
an empty result; other columns are passed on, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from voyra.llm.common import fresh


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str          # Java and Python agree on the syntax used here
    group: int = 0        # the group whose length is limited
    min_chars: int = 0


# The base rules, then those that the method adds.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),       # flat: a repeated group would recurse for each word
    Rule("git_token", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pay_key", r"[rs]k_live_[A-Za-z0-9]{20,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + ADDED

MAX_STRINGS = 64          # more spellings than this give no clause
CHUNK = 256               # matches summed together on the lower level

Clause = tuple[frozenset, ...]


def _clause(strings: set[str]) -> Clause | None:
    """OR over the spellings of the AND of their trigrams; None if one has no trigram."""
    grams = {frozenset(s[i: i + 3] for i in range(len(s) - 2)) for s in strings}
    if not grams or frozenset() in grams:
        return None
    least = [g for g in grams if not any(o < g for o in grams)]
    return tuple(sorted(least, key=sorted))


def _walk(items, strings: set[str], clauses: list[Clause]) -> set[str]:
    """Follow a parsed regex; ``strings`` are the spellings that end here."""

    def cut(new: set[str]) -> set[str]:
        c = _clause(strings)
        if c:
            clauses.append(c)
        return new

    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            strings = {s + chr(arg).lower() for s in strings}
        elif name == "SUBPATTERN":
            strings = _walk(arg[-1], strings, clauses)
        elif name in ("BRANCH", "IN") or (name == "MAX_REPEAT" and arg[:2] == (0, 1)):
            if name == "BRANCH":
                options = [_exact(branch) for branch in arg[1]]
            elif name == "IN":
                options = [{chr(a).lower()} if str(o) == "LITERAL" else None for o, a in arg]
            else:
                options = [{""}, _exact(arg[2])]
            ends = None if None in options else {s + e for s in strings for o in options for e in o}
            strings = cut({""}) if ends is None or len(ends) > MAX_STRINGS else ends
        elif name == "MAX_REPEAT" and arg[0] > 0:
            strings = _walk(arg[2], strings, clauses)
            strings = cut({""})
        else:
            strings = cut({""})
    return strings


def _exact(items) -> set[str] | None:
    """All spellings of a part of a regex, None if there are too many to list."""
    clauses: list[Clause] = []
    if any(str(op) not in ("LITERAL", "SUBPATTERN", "BRANCH", "IN", "MAX_REPEAT") or
           (str(op) == "MAX_REPEAT" and arg[:2] != (0, 1)) for op, arg in items):
        return None
    before = len(clauses)
    out = _walk(items, {""}, clauses)
    return out if len(clauses) == before and out != {""} else None


def trigram_query(pattern: str) -> list[Clause]:
    """AND of clauses that every text with a match fulfils; [] if none is mandatory."""
    clauses: list[Clause] = []
    last = _walk(re._parser.parse(pattern), {""}, clauses)
    c = _clause(last)
    return [*clauses, c] if c else clauses


def postings(docs: DataFrame, id_col: str, text: str, grams: list[str]) -> DataFrame:
    """Inverted index (gram, id), for the trigrams that queries name."""
    names = F.array(*[F.lit(g) for g in grams])
    # an array of one text, so that the lambda lowers it once for all trigrams
    found = F.flatten(F.transform(F.array(F.lower(F.col(text))), lambda low: F.filter(
        names, lambda g: F.contains(low, g))))
    return docs.select(F.col(id_col).alias("id"), F.explode(found).alias("gram"))


def candidates(index: DataFrame, queries: dict[str, list[Clause]]) -> DataFrame:
    """(id, kinds): the rules whose query an id's postings fulfil."""
    have = F.collect_set("gram")        # at most the grams that queries name
    def holds(clauses: list[Clause]) -> Column:
        out = F.lit(True)
        for clause in clauses:
            any_of = F.lit(False)
            for grams in clause:
                all_of = F.size(F.array_except(F.array(*[F.lit(g) for g in sorted(grams)]), F.col("have"))) == 0
                any_of = any_of | all_of
            out = out & any_of
        return out
    kinds = F.filter(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]), lambda k: k.isNotNull())
    return (index.groupBy("id").agg(have.alias("have")).select("id", kinds.alias("kinds"))
            .filter(F.size("kinds") > 0))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is made once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def _total(steps: Column, first: Column, n: Column | int) -> Column:
    """Length of ``n`` steps, from the one with index ``first``."""
    return F.aggregate(F.slice(steps, first + 1, n if isinstance(n, Column) else F.lit(n)), F.lit(0).cast("long"),
                       lambda a, s: a + s["gap"] + s["size"])


def _chunks(n: Column) -> Column:
    return F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))


def _sum(values: Column, n: Column) -> Column:
    return F.aggregate(F.slice(values, F.lit(1), n), F.lit(0).cast("long"), lambda a, v: a + v)


def _spans(text: Column, rule: Rule, size=F.length) -> Column:
    """Array of (start, end) of a rule's matches; ``size`` measures texts (F.length: code points,
    F.octet_length: bytes). ``limited`` is the code points of the group with a limit."""
    pattern = F.lit(rule.pattern)
    found = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"), F.split(text, rule.pattern, -1).alias("g"),
                     *([F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("v")] if rule.group else []))

    def steps(f: Column) -> Column:
        zipped = F.arrays_zip(f["m"].alias("m"), F.slice(f["g"], F.lit(1), F.size(f["m"])).alias("g"),
                              f["v" if rule.group else "m"].alias("v"))
        return F.transform(zipped, lambda z: F.struct(size(z["g"]).cast("long").alias("gap"), size(z["m"]).cast("long").alias("size"),
                                                      F.length(z["v"]).alias("limited")))

    def placed(x: Column) -> Column:
        def span(s: Column, i: Column) -> Column:
            c = F.floor(i / CHUNK).cast("int")
            start = F.get(x["before"], c) + _total(x["steps"], c * CHUNK, i - c * CHUNK) + s["gap"]
            return F.struct(start.alias("start"), (start + s["size"]).alias("end"), s["limited"].alias("limited"))
        return F.transform(x["steps"], span)

    # lengths are summed inside chunks, then over the chunks before each, once a chunk
    spans = _let(_let(_let(F.struct(_let(found, steps).alias("steps")), lambda x: F.struct(
        x["steps"].alias("steps"), F.transform(_chunks(F.size(x["steps"])), lambda c: _total(x["steps"], c * CHUNK, CHUNK)).alias("sums"))),
        lambda x: F.struct(x["steps"].alias("steps"), F.transform(x["sums"], lambda _, c: _sum(x["sums"], c)).alias("before"))), placed)
    none = F.array().cast("array<struct<start:bigint,end:bigint,limited:int>>")
    spans = F.when(F.rlike(text, pattern), spans).otherwise(none)
    return F.filter(spans, lambda s: s["limited"] >= rule.min_chars)


def _labelled(order: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("rule"), s["end"].alias("end"),
                              F.lit(kind).alias("kind"))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
         rules: tuple[Rule, ...] = RULES, size=F.length) -> tuple[DataFrame, str]:
    """``docs`` with an array column of (kind, start, end), by start, then by rule; places in
    code points, or in what ``size`` measures.

    Returns the frame and the name of the new column.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    grams = sorted({g for q in indexed.values() for clause in q for alt in clause for g in alt})
    name = fresh(docs, "spans")
    found_id, kinds = fresh(docs, "candidate_id"), fresh(docs, "candidate_kinds")
    if grams:
        hits = candidates(postings(docs, id_col, text, grams), indexed).select(
            F.col("id").alias(found_id), F.col("kinds").alias(kinds))
        df = docs.join(hits, docs[id_col].eqNullSafe(hits[found_id]), "left")
    else:
        df = docs.withColumn(found_id, F.lit(None)).withColumn(kinds, F.lit(None).cast("array<string>"))
    body = F.coalesce(F.col(text), F.lit(""))
    each = []
    for i, rule in enumerate(rules):
        spans = _spans(body, rule, size)
        if rule.kind in indexed:
            spans = F.when(F.array_contains(F.col(kinds), rule.kind), spans).otherwise(
                F.array().cast("array<struct<start:bigint,end:bigint,limited:int>>"))
        each.append(F.transform(spans, _labelled(i, rule.kind)))
    spans = F.transform(F.array_sort(F.concat(*each)), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return df.withColumn(name, spans).drop(found_id, kinds), name


def is_kind(kind: str):
    return lambda s: s["kind"] == kind


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text: str = "text", mark: str = "[SECRET]",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark`` (overlapping spans by one)."""
    # in bytes: a stretch of a byte string is cut without a look at what is before it
    df, name = scan(docs, id_col, text, rules, F.octet_length)

    def ends(spans: Column, first: Column, n: Column) -> Column:
        return F.array_max(F.transform(F.slice(spans, first + 1, n), lambda s: s["end"]))

    def clean(x: Column) -> Column:
        def reach(i: Column) -> Column:
            """Where the spans before ``i`` end at most."""
            c = F.floor(i / CHUNK).cast("int")
            zero = F.lit(0).cast("long")
            return F.greatest(F.get(x["before"], c), F.coalesce(ends(x["spans"], c * CHUNK, i - c * CHUNK), zero))

        def piece(s: Column, i: Column) -> Column:
            """The text between the spans before and this one, and its mark."""
            return _let(reach(i), lambda at: F.when(s["start"] >= at, F.concat(
                F.substring(x["body"], (at + 1).cast("int"), (s["start"] - at).cast("int")).cast("string"), F.lit(mark))).otherwise(""))
        tail = F.substring(x["body"], (reach(F.size(x["spans"])) + 1).cast("int"), F.lit(2147483647)).cast("string")
        return F.concat(F.array_join(F.transform(x["spans"], piece), ""), tail)

    built = _let(_let(F.struct(F.col(text).cast("binary").alias("body"), F.col(name).alias("spans"), F.transform(
        _chunks(F.size(name) + 1), lambda c: ends(F.col(name), c * CHUNK, F.lit(CHUNK))).alias("tops")), lambda x: F.struct(
            x["body"].alias("body"), x["spans"].alias("spans"), F.transform(x["tops"], lambda _, c: F.coalesce(
                F.array_max(F.slice(x["tops"], F.lit(1), c)), F.lit(0).cast("long"))).alias("before"))), clean)
    return df.withColumn(text, F.when(F.size(name) > 0, built).otherwise(F.col(text))).select(*docs.columns)
