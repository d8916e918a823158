"""Exact sequential numbering that does not put a hot key into one task.

``row_number() over (partition by k order by o)`` sorts every row of a key in
one task; with a key holding a third of the data that task is the job. Here
the rows of a key are cut into ranges of the order column, each
range is numbered in its own task, and a (key, range) count table
gives the offset of every range. The result equals the plain window.

Offsets are prefix sums made as a tree: ranges are summed by ``FAN`` neighbours, those
sums by ``FAN`` again, until a key has no more than ``FAN`` of them, and offsets
come down the same way. So no window holds more than ``FAN`` rows of a key, however
many ranges there are, keyed or not.

Shuffles: one for the numbering inside ranges (on key + range), one partial aggregate
for the count table; the join back uses the same partitioning or, when
AQE sees the count table is small, broadcasts it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAN_BITS = 10                    # FAN = 1024 ranges are summed at once
RANGE_ROWS = 1 << 16             # ids a range, where ids lie close together
DENSE = 4                        # close together: the ids span at most so many times their number


def prefix_sums(counts: DataFrame, keys: list[str], at: str, n: str, span: int, out: str) -> DataFrame:
    """``counts`` (keys, ``at``, ``n``; one row for each) with ``out`` = the sum of ``n`` of the
    smaller ``at`` of the same keys. ``at`` is a whole number from 0 to below ``span``."""
    def before(by: list[str]) -> Column:
        w = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(n).over(w), F.lit(0))
    if span <= 1 << FAN_BITS:
        return counts.withColumn(out, before(keys))
    up, above = f"{at}_up", f"{out}_above"
    counts = counts.withColumn(up, F.shiftright(at, FAN_BITS))
    sums = counts.groupBy(*keys, up).agg(F.sum(n).alias(n))
    sums = prefix_sums(sums, keys, up, n, ((span - 1) >> FAN_BITS) + 1, above).drop(n)
    inside = counts.withColumn(out, before([*keys, up]))
    j = inside.join(sums, [*keys, up])
    return j.withColumn(out, F.col(out) + F.col(above)).drop(up, above)


def _keyed(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with its keys as one struct: windows and joins then ask for the same
    partitioning, and keys that are null meet (a struct holding a null is not null)."""
    if not keys:
        return df, []
    return df.withColumn("_vkey", F.struct(*[F.col(f"`{k}`") for k in keys])).drop(*keys), ["_vkey"]


def _shown(df: DataFrame, cols: list[str], keys: list[str], seq: Column, out: str) -> DataFrame:
    return df.select(*[F.col("_vkey")[c].alias(c) if c in keys else F.col(f"`{c}`") for c in cols], seq.cast("long").alias(out))


def seq_number(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None = None,
               out: str = "seq", bounds: tuple[int, int] | None = None) -> DataFrame:
    """Add ``out`` = row_number()-1 over (partition by keys order by order).

    ``order`` must be a total order within a key (end it with a unique id),
    or the numbering of ties is arbitrary, as with the plain window.

    Without ``bucket`` (the default) the rows are range-partitioned on
    (keys, order): Spark samples the data to pick the range bounds, so a key
    with a third of the rows is cut over many partitions whatever its ids
    look like. Each partition is sorted, every row gets its position from
    ``monotonically_increasing_id`` (partition index and row offset), and a
    (partition, key) count table gives each piece its offset.

    With ``bucket`` (a whole number that never decreases along ``order`` within a
    key, e.g. ``floor(id / width)``; ``bounds`` are its smallest and largest value, if
    known) the rows are numbered inside (key, bucket) with a window instead: no
    sampling pass and no materialised copy. ``number_by_id`` chooses between the two.
    """
    if bucket is None:
        return _seq_by_range(df, keys, order, out)
    if bounds is None:
        lo, hi = df.select(bucket.alias("b")).agg(F.min("b"), F.max("b")).first()
        bounds = (lo or 0, hi or 0)
    # rows without a bucket come first, as nulls do in the window
    at = F.coalesce(bucket.cast("long") - F.lit(bounds[0]).cast("long") + 1, F.lit(0).cast("long"))
    ordered = df.withColumn("_vat", at).withColumn("_vorder", F.struct(*[F.col(f"`{c}`") for c in order]))
    b, key = _keyed(ordered, keys)
    part = [*key, "_vat"]
    counts = b.groupBy(*part).agg(F.count(F.lit(1)).alias("_vn"))
    offsets = prefix_sums(counts, key, "_vat", "_vn", bounds[1] - bounds[0] + 2, "_voff").drop("_vn")
    local = b.withColumn("_vr", F.row_number().over(Window.partitionBy(*part).orderBy("_vorder")))
    return _shown(local.join(offsets, part), df.columns, keys, F.col("_voff") + F.col("_vr") - 1, out)


def number_by_id(df: DataFrame, keys: list[str], id_col: str, out: str = "seq") -> DataFrame:
    """``seq_number`` in the order of a whole-number id (unique within a key). One pass over the id
    column says how the ids lie: close together (numbers handed out in turn), and ranges of
    ``RANGE_ROWS`` ids hold at most that many rows; or far apart (hashes, ids of
    many sources), and the ranges are cut where the rows are."""
    lo, hi, n = df.agg(F.min(id_col), F.max(id_col), F.count(id_col)).first()
    if n and hi - lo + 1 > DENSE * n:
        return seq_number(df, keys, [id_col], out=out)
    width = RANGE_ROWS
    first, last = (lo or 0) // width, (hi or 0) // width
    return seq_number(df, keys, [id_col], id_bucket(id_col, width), out, (first, last))


def _seq_by_range(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [*keys, *order]
    r = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    mid = F.monotonically_increasing_id()
    r = r.withColumn("_vp", F.shiftright(mid, 33)).withColumn("_vi", mid.bitwiseAND(F.lit((1 << 33) - 1)))
    # Range bounds come from sampling, and a recomputation may sample anew:
    # write the stamped rows once so the count table and the rows agree.
    from voyra.session import materialize
    r, key = _keyed(materialize(r), keys)
    # per (partition, key): where the key starts in the partition and how many rows it has
    pieces = r.groupBy("_vp", *key).agg(F.min("_vi").alias("_vfirst"), F.count(F.lit(1)).alias("_vn"))
    offs = prefix_sums(pieces, key, "_vp", "_vn", n, "_voff").drop("_vn")
    # one row per (partition, key) piece: small, so AQE broadcasts it
    return _shown(r.join(offs, ["_vp", *key]), df.columns, keys, F.col("_voff") + F.col("_vi") - F.col("_vfirst"), out)


def id_bucket(col: str | Column, width: int = RANGE_ROWS) -> Column:
    """Floor of a whole number by ``width``, exact for every long."""
    c = (F.col(col) if isinstance(col, str) else col).cast("long")
    w = F.lit(width).cast("long")
    return F.call_function("div", c, w) - F.when(F.pmod(c, w) != F.call_function("mod", c, w), 1).otherwise(0)


def time_bucket(col: str | Column, seconds: int = 60) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")
