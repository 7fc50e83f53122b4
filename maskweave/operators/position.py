"""Global stream position, limits, slices and fixed batches.

The reference walks an ordered stream; here the order is an explicit key.
Position is the two-pass "zip with index" done with DataFrame ops: a
range-partitioned sort (boundaries come from a sample, so partitions stay
balanced even when a key prefix is hot), a per-partition row tag, a
per-partition count, and offsets over that small count table.  No
single-partition window over the data, no driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskweave.session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition << 33 | row in partition


def with_position(df: DataFrame, order: tuple[str, ...] = ("doc_id",), pos_col: str = "pos",
                  name: str = "position") -> DataFrame:
    """Add ``pos`` = 0-based rank of the row by ``order`` (a total
    order; keys must be unique).

    The tagged rows are written once to the shared checkpoint folder, so
    the tag is fixed even if executors are lost and stages re-run.  The
    offsets table has one row per sort partition (bounded by the shuffle
    partition setting, not by the data), which is what is broadcast.
    """
    cols = df.columns
    tagged = materialize(
        df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), name)
    part = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (tagged.withColumn("_part", part).withColumn("_local", local)
            .join(F.broadcast(offsets), "_part")  # one row per sort partition
            .select(*cols, (F.col("_off") + F.col("_local")).alias(pos_col)))


def limit_positions(df: DataFrame, n: int | None, pos_col: str = "pos") -> DataFrame:
    """First ``n`` rows by position; 0 or None means no limit."""
    if not n:
        return df
    return df.filter(F.col(pos_col) < F.lit(n))


#: Bins that a pass of ``nth_key`` counts.
BINS = 4096


def nth_key(df: DataFrame, n: int, key: str = "doc_id"):
    """The ``n``-th smallest value (from 1) of a unique integer ``key``, or
    None when there are fewer.  Each pass counts the keys of a range in BINS
    equal bins and goes on with the bin that holds the n-th: six passes over
    the key column at most, whose bounds reach the scan; nothing is sorted or
    written, and BINS counts come back."""
    k = F.col(key)
    lo, hi, rows = df.agg(F.min(k), F.max(k), F.count(k)).first()
    if rows < n:
        return None
    while lo < hi:
        width = -(-(hi - lo + 1) // BINS)
        wide = hi - lo >= 1 << 63 or lo < -(1 << 62)  # beyond the integers of SQL
        place = F.expr(f"(cast(`{key}` as decimal(20, 0)) - cast('{lo}' as decimal(20, 0))) div {width}" if wide
                       else f"(cast(`{key}` as bigint) - {lo}L) div {width}L")
        bins = df.where((k >= F.lit(lo)) & (k <= F.lit(hi))).groupBy(place.alias("bin")).count().collect()
        for r in sorted(bins, key=lambda r: r["bin"]):
            if n <= r["count"]:
                lo, hi = lo + r["bin"] * width, min(hi, lo + (r["bin"] + 1) * width - 1)
                break
            n -= r["count"]
    return lo


def first_rows(df: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """The first ``n`` rows by a unique ``key``.  An integer key is
    cut by selection, any other by position; in both cases only the keys are
    looked at, and ``key <= cut`` reaches the Parquet scan."""
    return rows_between(df, 0, n, key)


def rows_between(df: DataFrame, skip: int, take: int | None, key: str = "doc_id") -> DataFrame:
    """B6 without positions: rows ``skip`` to ``skip + take`` by a unique key."""
    if df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long"):
        def at(n):
            return nth_key(df, n, key)
    else:
        pos = with_position(df.select(key), (key,), name="keys")

        def at(n):
            row = pos.where(F.col("pos") == n - 1).first()
            return row and row[key]
    if skip:
        low = at(skip)
        if low is None:
            return df.limit(0)
        out = df.filter(F.col(key) > F.lit(low))
    else:
        out = df
    high = None if take is None else at(skip + take) if take > 0 else None
    if take == 0:
        return df.limit(0)
    return out if high is None else out.filter(F.col(key) <= F.lit(high))


def rounded_limit(n: int, batch_size: int) -> int:
    """The reference reads whole batches until the start passes n."""
    return -(-n // batch_size) * batch_size


def skip_take(df: DataFrame, skip: int, take: int | None, pos_col: str = "pos") -> DataFrame:
    """Positional slice [skip, skip + take)."""
    cond = F.col(pos_col) >= F.lit(skip)
    if take is not None:
        cond = cond & (F.col(pos_col) < F.lit(skip + take))
    return df.filter(cond)


def with_batch_id(df: DataFrame, batch_size: int, pos_col: str = "pos") -> DataFrame:
    """Consecutive batches of ``batch_size``; the last may be partial."""
    return df.withColumn("batch_id", F.floor(F.col(pos_col) / F.lit(batch_size)).cast("bigint"))


def batch_lists(df: DataFrame, batch_size: int, value: str = "text", pos_col: str = "pos") -> DataFrame:
    """B5 list form: one row per batch holding its values in stream order.
    Each group holds at most ``batch_size`` rows, so the collect is bounded."""
    b = with_batch_id(df, batch_size, pos_col)
    return (b.groupBy("batch_id")
             .agg(F.sort_array(F.collect_list(F.struct(F.col(pos_col).alias("p"), F.col(value).alias("v"))))
                  .alias("_items"))
             .select("batch_id", F.col("_items.v").alias(value)))


def running_sum(df: DataFrame, order: list[str], value: str, out: str,
                block_rows: int = 1 << 16, seq: str | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` over the total order ``order``
    without a single-partition window over the data.

    The last order column ``seq`` must be a dense-ish integer inside each
    group of the leading columns; rows are cut into blocks of
    ``block_rows`` consecutive ``seq`` values.  Block totals form a table of
    rows / block_rows, whose prefix one task takes; each block's
    local running sum is a window over at most ``block_rows`` rows.
    """
    seq = seq or order[-1]
    lead = [c for c in order if c != seq]
    blk = F.floor(F.col(seq) / F.lit(block_rows)).cast("bigint")
    b = df.withColumn("_blk", blk)
    totals = b.groupBy(*lead, "_blk").agg(F.sum(value).alias("_bt"))
    prior = Window.orderBy(*lead, "_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*lead, "_blk", F.coalesce(F.sum("_bt").over(prior), F.lit(0)).alias("_boff"))
    local = Window.partitionBy(*lead, "_blk").orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    return (b.withColumn("_loc", F.sum(value).over(local))
             .join(offsets, [*lead, "_blk"])
             .withColumn(out, (F.col("_boff") + F.col("_loc")).cast("bigint"))
             .drop("_blk", "_loc", "_boff"))
