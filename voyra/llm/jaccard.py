"""N-gram Jaccard join as a blocked sparse matrix product.

Rows of the matrix are documents, columns their distinct n-word shingles. Two
documents link when their rows' product (the overlap) is at least ``PERCENT``
of the union.

1. Documents with equal shingle sets are one class; its smallest id stands for it.
2. Columns that only one document holds cannot add to any overlap; they are
   found in blocks of columns (``packs``) and dropped. A row with fewer than
   ``PERCENT`` percent of its columns left is below the bound of any partner
   and is dropped too, before any pair is looked at.
3. Of each remaining row only the rarest columns, as many as a partner must
   share at least one of (n - ceil(0.85 n) + 1), are used to find candidates.
   Rows connected by such columns form a candidate group.
4. Candidate groups are multiplied in blocks of rows, sized by the columns they
   hold; a group above one block is multiplied for every pair of its blocks.
   Inside a block a row is multiplied with all others at once, overlap counts
   are accumulated, and pairs below the bound are discarded. Rows whose
   possible partners are all in their own component already are skipped: their
   links could not change the result. So a large group of near copies costs a
   few row products, and the output is a spanning set of links, not all pairs.
5. Links and classes give components (``components``).

Defined results: a text without words, empty or null has size 0 and links with
nothing; fewer words than n give the whole sequence as one shingle; repeated
rows with the same id are in one class if their sets are equal, and otherwise
separate rows under one id; a null id gives a null component unless linked to a
row with an id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from voyra.llm import bytehash as B, packs
from voyra.llm.common import discard, fresh, scratch, tables_made
from voyra.llm.components import components

SHINGLE = 4
PERCENT = 85
BLOCK_ENTRIES = 2_000_000       # columns held by the rows of one block

PACK_BYTES = 8
STATS = np.dtype([("uid", "<i8"), ("id", "<i8"), ("known", "<i8"), ("n", "<i8"), ("a", "<u8"), ("b", "<u8")])
SAME = ["n", "sum_a", "sum_b"]   # rows that agree in these have equal sets
ROWS = "uid long, id long, n long, sum_a decimal(20,0), sum_b decimal(20,0), columns binary"


def shingle_sets(s: B.Slice, length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of every row of a slice, by row."""
    words = s.word_hash()
    at = s.window_ok(length)
    h, row = B.window_hash(words, length)[at], s.row[at]
    counts = s.counts()
    for size in range(1, length):                       # rows with too few words
        short = np.flatnonzero(counts == size)
        if len(short):
            whole = B.window_hash(words, size)[s.first[short]]
            h = np.concatenate([h, B.mix(whole + np.uint64(size))])
            row = np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def _scan(docs: DataFrame, length: int, pieces: int) -> DataFrame:
    """Packed (uid, hash) entries of (id, text, uid), and one row for each batch and block with the
    documents' own figures (uid, id, set size, two sums that tell sets apart)."""
    fan = packs.FAN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            docs_, hashes, stats = (np.concatenate(x) for x in zip(*held))
            rows = packs.batch_rows(docs_, hashes, packs.REPEATED, pieces, PACK_BYTES, fan)
            block = packs.block_of(stats["uid"], pieces)
            for b in np.unique(block):
                rows.append((-1 - int(b), b"", b"", b"", stats[block == b].tobytes()))
            return packs.record_batch(rows)

        for b in batches:
            ids = b.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy().astype(np.int64)
            uid = b.column(2).to_numpy()
            for s in B.slices(b.column(1), lower=True):
                row, h = shingle_sets(s, length)
                stats = np.zeros(s.n, STATS)
                stats["uid"] = uid[s.lo: s.hi]
                stats["id"], stats["known"] = ids[s.lo: s.hi], known[s.lo: s.hi]
                stats["n"] = np.bincount(row, minlength=s.n)
                for name, salt in (("a", 1), ("b", 2)):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(B.mix(h + np.uint64(salt)))])
                    ends = np.cumsum(stats["n"])
                    stats[name] = total[ends] - total[ends - stats["n"]]
                held.append((uid[s.lo + row], h, stats))
                size += len(h)
                if size >= packs.BATCH_ENTRIES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.mapInArrow(run, packs.SCHEMA)


def _rows(shared: DataFrame, percent: int) -> DataFrame:
    """One row for each document; ``columns`` holds its shared ones if they reach the bound."""

    def build(table: pa.Table) -> pa.Table:
        stats = np.concatenate([np.frombuffer(x, STATS) for x in table.column("extra").to_pylist() if x])
        stats = stats[np.argsort(stats["uid"])]
        docs, hashes = packs.unpack(table, PACK_BYTES)
        order = np.lexsort((hashes, docs))
        docs, hashes = docs[order], hashes[order]
        new = np.ones(len(docs), bool)
        new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
        docs, hashes = docs[new], hashes[new]
        lo = np.searchsorted(docs, stats["uid"])
        hi = np.searchsorted(docs, stats["uid"], side="right")
        enough = (hi > lo) & (100 * (hi - lo) >= percent * stats["n"])
        blobs = [hashes[i:j].astype("<i8").tobytes() if ok else None for i, j, ok in zip(lo, hi, enough)]
        wide = pa.decimal128(20, 0)
        return pa.table({
            "uid": pa.array(stats["uid"]), "id": pa.array(stats["id"], mask=stats["known"] == 0), "n": pa.array(stats["n"]),
            "sum_a": pa.array(stats["a"]).cast(wide), "sum_b": pa.array(stats["b"]).cast(wide),
            "columns": pa.array(blobs, pa.binary())})

    return shared.groupBy("key").applyInArrow(build, ROWS)


def _explode(rows: DataFrame) -> DataFrame:
    """(uid, n, column) entries of packed rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, blob in enumerate(b.column(2).to_pylist()):
                cols = np.frombuffer(blob, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cols), uid[i])), pa.array(np.full(len(cols), n[i])), pa.array(cols)],
                    ["uid", "n", "hash"])
    return rows.select("uid", "n", "columns").mapInArrow(run, "uid long, n long, hash long")


def _bound(n, percent: int):
    """Least overlap of a set of n shingles with any partner: ceil(percent / 100 * n)."""
    return F.floor((F.lit(percent) * n + 99) / 100)


def _candidate_rows(rows: DataFrame, percent: int) -> DataFrame:
    """(uid, n, columns by frequency, then hash; prefix): rows that still reach the
    bound when only columns of other rows count, and how many of their columns find candidates."""
    entries = _explode(rows)
    often = entries.groupBy("hash").agg(F.count("*").alias("df")).filter("df > 1")
    per_row = entries.join(often, "hash").groupBy("uid", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "hash"))).alias("cols"))
    bound = _bound(F.col("n"), percent)
    per_row = per_row.filter(F.size("cols") >= bound)
    # columns that no other row holds come first in the order and take their part of the prefix
    return per_row.select("uid", "n", F.col("cols.hash").alias("cols"),
                          (F.size("cols") - bound + 1).cast("int").alias("prefix"))


def _product(table: pa.Table, percent: int) -> pa.Table:
    """Links that connect the rows of one candidate group as all their links would."""
    uid, n = table.column("uid").to_numpy(), table.column("n").to_numpy().astype(np.int64)
    order = np.argsort(uid)
    lists = table.column("cols").combine_chunks().take(pa.array(order))
    uid, n = uid[order], n[order]
    prefix = table.column("prefix").to_numpy()[order].astype(np.int64)
    m = len(uid)
    size = np.diff(lists.offsets.to_numpy())
    _, col = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    width = int(col.max(initial=-1)) + 1
    doc = np.repeat(np.arange(m), size)
    begin = np.concatenate([[0], np.cumsum(size)])
    inside = np.arange(len(col)) - begin[doc]
    find = np.flatnonzero(inside < prefix[doc])                # entries that find candidates
    find = find[np.argsort(col[find], kind="stable")]
    fcol, fdoc = col[find], doc[find]
    label = np.arange(m)
    out_a, out_b = [], []
    while len(fcol):
        start = np.flatnonzero(np.append(True, fcol[1:] != fcol[:-1]))
        mine = label[fdoc]
        mixed = np.minimum.reduceat(mine, start) != np.maximum.reduceat(mine, start)
        live = np.repeat(mixed, np.diff(np.append(start, len(fcol))))
        fcol, fdoc = fcol[live], fdoc[live]
        if not len(fcol):
            break
        p = int(np.argmax(np.bincount(fdoc, minlength=m)))     # most open columns first
        mark = np.zeros(width, bool)
        mark[col[begin[p]: begin[p + 1]]] = True
        overlap = np.bincount(doc[mark[col]], minlength=m)
        link = 100 * overlap >= percent * (n + n[p] - overlap)
        link[p] = False
        found, one = np.unique(label[link], return_index=True)
        other = found != label[p]
        out_a += [uid[p]] * int(other.sum())
        out_b += uid[np.flatnonzero(link)[one[other]]].tolist()
        if other.any():
            joined = np.append(found[other], label[p])
            label[np.isin(label, joined)] = joined.min()
        rest = fdoc != p                                       # all pairs of p are decided
        fcol, fdoc = fcol[rest], fdoc[rest]
    return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})


def _links(rows: DataFrame, percent: int, block_entries: int) -> DataFrame:
    """Links (a, b) between uids that connect what all links connect."""
    rows = scratch(_candidate_rows(rows, percent), "jaccard-rows")
    finding = rows.select("uid", F.explode(F.slice("cols", F.lit(1), F.col("prefix"))).alias("hash"))
    low = finding.groupBy("hash").agg(F.min("uid").alias("b"), F.max("uid").alias("top")).filter("b < top")
    group = components(finding.join(low, "hash").select(F.col("uid").alias("a"), "b").distinct())
    group = group.unionByName(group.select(F.col("component").alias("node"), "component").distinct())
    rows = rows.join(group, rows["uid"] == group["node"]).drop("node")
    sizes = rows.groupBy("component").agg(F.sum(F.size("cols")).alias("entries"))
    blocks = F.ceil(F.col("entries") / block_entries).cast("int")
    total = sizes.agg(F.sum("entries")).first()[0] or 0
    units = max(8, -(-total // block_entries))
    rows = rows.join(sizes.select("component", blocks.alias("blocks")), "component")
    # small groups share a unit of work; a large one has a unit for each pair of its blocks
    mine = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    partner = F.explode(F.when(F.col("blocks") > 1, F.filter(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: i != F.col("mine"))).otherwise(F.array(F.lit(0))))
    rows = rows.withColumn("mine", mine).withColumn("partner", partner)
    unit = F.when(F.col("blocks") > 1, F.col("component")).otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(units)))
    rows = rows.select(unit.alias("unit"), F.least("mine", "partner").alias("i"), F.greatest("mine", "partner").alias("j"),
                       "component", "uid", "n", "cols", "prefix")

    def multiply(table: pa.Table) -> pa.Table:
        table = table.sort_by("component")
        comp = table.column("component").to_numpy()
        at = np.flatnonzero(np.append(True, comp[1:] != comp[:-1]))
        return pa.concat_tables([_product(table.slice(i, j - i), percent) for i, j in zip(at, np.append(at[1:], len(comp)))])

    return rows.groupBy("unit", "i", "j").applyInArrow(multiply, "a long, b long")


def _classes(src: DataFrame, length: int, percent: int, block_entries: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of (id, text, uid): its rows with their sets' figures, the classes of equal
    sets, and (node, component) for every class_uid that a link joins to another."""
    pieces = packs.pieces_for(src.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    spark = src.sparkSession
    shared = packs.shared(_scan(src, length, pieces), packs.REPEATED, pieces, PACK_BYTES)
    # uids depend on how the input was split: they are made once, and written
    with tables_made() as made:
        shared = scratch(shared, "jaccard-shared")
    rows = scratch(_rows(shared, percent), "jaccard-documents")
    discard(spark, *made)
    classes = rows.filter("n > 0").groupBy(*SAME).agg(
        F.min("id").alias("class_id"), F.min("uid").alias("class_uid"))
    classes = scratch(classes, "jaccard-classes")
    heads = rows.filter("columns IS NOT NULL").join(classes.select(F.col("class_uid").alias("uid")), "uid", "left_semi")
    with tables_made() as made:
        linked = components(_links(heads, percent, block_entries))
    # what is read from here on: the last table of components, and the rows without their columns
    discard(spark, *made[:-1])
    linked = linked.unionByName(linked.select(F.col("component").alias("node"), "component").distinct())
    return rows, classes, linked


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = SHINGLE,
         percent: int = PERCENT, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(id, n_shingles, class_id, component_id), one row for each row of ``docs``:
    the smallest id with the same shingle set, and the smallest one reachable by links."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"),
                      F.monotonically_increasing_id().alias("uid"))
    rows, classes, linked = _classes(src, length, percent, block_entries)
    reach = classes.join(linked, classes["class_uid"] == linked["node"])
    lowest = scratch(reach.groupBy("component").agg(F.min("class_id").alias("component_id")), "jaccard-components")
    reach = reach.select(*SAME, "component").join(lowest, "component").drop("component")
    classes = classes.join(reach, SAME, "left")
    out = rows.drop("columns").join(classes, SAME, "left")
    return out.select("id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
                      F.when(F.col("n") > 0, F.coalesce("component_id", "class_id")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = SHINGLE,
                percent: int = PERCENT, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Of each component the row with the smallest id; of several rows with that id
    the first one read.

    Components are made of rows, not of ids: whole copies of a row stay once, rows
    with the same id in two components are held apart, a row without an id stays
    where no linked row has one, and a row without words is a component of its own.
    ``docs`` is written once with a key for each row, which the heads are met by.
    """
    uid = fresh(docs, "row_key")
    keyed = scratch(docs.withColumn(uid, F.monotonically_increasing_id()), "jaccard-input")
    src = keyed.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), F.col(uid).alias("uid"))
    rows, classes, linked = _classes(src, length, percent, block_entries)
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "uid")).alias("head")
    of_class = rows.filter("n > 0").groupBy(*SAME).agg(first)
    root = F.coalesce("component", "class_uid").alias("root")
    of_class = of_class.join(classes, SAME).join(linked, F.col("class_uid") == F.col("node"), "left").select(root, "head")
    heads = of_class.groupBy("root").agg(F.min("head").alias("head")).select(F.col("head.uid").alias("head_uid"))
    heads = heads.unionByName(rows.filter("n = 0").select(F.col("uid").alias("head_uid")))
    return keyed.join(heads, keyed[uid] == heads["head_uid"], "left_semi").drop(uid)
