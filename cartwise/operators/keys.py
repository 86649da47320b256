"""Keyed, order-dependent building blocks.

Every ordering ends in a unique column, so results do not depend on the
input order or the partition count.  ``row_number``/``rank`` followed by a
``<= k`` filter is planned by Spark as WindowGroupLimit on both sides of the
shuffle, so a hot key sends at most k rows per map task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        return [cs]
    return list(cs)


def top_k_per_key(df: DataFrame, keys, order: Sequence, k: int = 1,
                  rank_col: str | None = None, method: str = "row_number") -> DataFrame:
    """Keep the first ``k`` rows per key by ``order``.

    ``method="rank"`` keeps ties at the cut.  ``rank_col`` keeps the number.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    fn = F.rank() if method == "rank" else F.row_number()
    name = rank_col or "_rk"
    out = df.withColumn(name, fn.over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def first_per_key(df: DataFrame, keys, order: Sequence) -> DataFrame:
    """One row per key, the first by a stated order."""
    return top_k_per_key(df, keys, order, 1)


def renumber(df: DataFrame, keys, order: Sequence, name: str = "rank",
             offset: Column | None = None) -> DataFrame:
    """``row_number`` per key (+ an offset column) as ``name``."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    rn = F.row_number().over(w)
    return df.withColumn(name, (rn + offset) if offset is not None else rn)


def running_count(df: DataFrame, keys, order: Sequence, cond: Column, name: str) -> DataFrame:
    """Running number of rows meeting ``cond``."""
    w = (Window.partitionBy(*_cols(keys)).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(name, F.sum(F.when(cond, 1).otherwise(0)).over(w))


def islands(df: DataFrame, keys, order: Sequence, is_start: Column, value: str,
            island_col: str = "subgroup", out_col: str | None = None) -> DataFrame:
    """Gaps and islands: each ``is_start`` row opens an island; every row
    gets the ``value`` of its island's first row (W12, W13).  Rows before
    the first start form island 0, headed by their own first row."""
    df = running_count(df, keys, order, is_start, island_col)
    w = (Window.partitionBy(*_cols(keys), island_col).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out_col or f"{value}_first", F.first(value).over(w))


def round_robin(df: DataFrame, keys, bucket: str, order: Sequence, k: int,
                name: str = "pick") -> DataFrame:
    """Take one row per bucket in turn until ``k`` picks.

    Buckets are visited in ascending order; rows with a NULL bucket are
    dropped, as a grouped loop would do.  Same picks as the loop, without
    one: turn = position inside the bucket, pick = order by (turn, bucket).
    """
    ks = _cols(keys)
    d = df.filter(F.col(bucket).isNotNull())
    d = d.withColumn("_turn", F.row_number().over(Window.partitionBy(*ks, bucket).orderBy(*order)))
    w = Window.partitionBy(*ks).orderBy("_turn", bucket)
    return d.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k).drop("_turn")


def forward_fill(df: DataFrame, keys, order: Sequence, cols: Sequence[str]) -> DataFrame:
    """Each NULL takes the last non-NULL value before it."""
    w = (Window.partitionBy(*_cols(keys)).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.select(*[F.last(c, ignorenulls=True).over(w).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def linear_fill(df: DataFrame, keys, x: str, cols: Sequence[str], ends: str = "nearest") -> DataFrame:
    """Linear interpolation of NULLs in ``cols`` along ``x``.

    Interior gaps: straight line between the nearest known points below and
    above.  ``ends="nearest"``: before the first / after the last known
    point, the nearest known value.  ``ends="forward"``: a leading gap stays
    NULL and a trailing gap takes the last value (pandas' default).
    Meant for small, distinct x (ages), not for raw fact rows.
    """
    ks = _cols(keys)
    before = Window.partitionBy(*ks).orderBy(x).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # backward, the rows from x on come first: linear, where a frame up to the last row is read again for each
    after = Window.partitionBy(*ks).orderBy(F.col(x).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df
    for c in cols:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col(x).alias("x"), F.col(c).alias("v")))
        p = F.last(known, ignorenulls=True).over(before)
        n = F.last(known, ignorenulls=True).over(after)
        span = n["x"] - p["x"]
        line = p["v"] + (n["v"] - p["v"]) * (F.col(x) - p["x"]) / span
        tail = [p["v"], n["v"]] if ends == "nearest" else [p["v"]]
        out = out.withColumn(c, F.coalesce(F.col(c), F.when(span > 0, line), *tail))
    return out


def row_numbers(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """Global 0-based row number by ``order`` without a single-task window.

    Range-partition by the order keys, sort inside each partition, take
    the position inside the partition, and add the row count of all
    earlier partitions (a table with one row per partition).  The ranged
    rows are checkpointed to the shared folder first, so both uses see the
    same partitioning and an executor loss does not re-sample the ranges.
    """
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    out = ranged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_off") + local).drop("_pid", "_mid", "_off")


def group_positions(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "pos",
                    size: str = "n") -> DataFrame:
    """0-based position ``name`` inside each group by ``order``, and the group's row count ``size``.

    As :func:`row_numbers`, but per group: a group of any size spreads over
    the range partitions it covers.  A partition's run of a group knows its
    first position from the runs of the same group in earlier partitions,
    one small row for each partition and group that meet.
    """
    ranged = (df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
              .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", 33))
    runs = ranged.groupBy("_pid", *group).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*group)
    runs = runs.select(F.col("_pid").alias("_run"), *[F.col(c).alias(f"_g_{c}") for c in group], "_first",
                       (F.sum("_rows").over(whole.orderBy("_pid")) - F.col("_rows")).alias("_before"),
                       F.sum("_rows").over(whole).alias(size))
    same = F.col("_pid") == F.col("_run")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    out = ranged.join(runs, same).withColumn(name, F.col("_mid") - F.col("_first") + F.col("_before"))
    return out.select(*df.columns, name, size)


def batch_numbers(df: DataFrame, order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    """``batch = floor(row_no / size)`` over a global order."""
    out = row_numbers(df, order, "_row_no")
    return (out.withColumn(name, F.floor(F.col("_row_no") / size).cast("bigint"))
            .withColumnRenamed("_row_no", "row_no"))


def row_range(df: DataFrame, order: Sequence[str], start: int = 0, end: int | None = None) -> DataFrame:
    """Rows ``start..end`` (0-based, inclusive) of a global order."""
    out = row_numbers(df, order, "row_no")
    cond = F.col("row_no") >= start
    if end is not None:
        cond = cond & (F.col("row_no") <= end)
    return out.filter(cond)


def pick_index(n: Column, *parts: Column, seed: str = "0") -> Column:
    """Repeatable 'random' index in ``[0, n)`` from md5 of the parts."""
    h = F.md5(F.concat_ws("|", F.lit(seed), *[p.cast("string") for p in parts]))
    return F.pmod(F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint"), n)
