"""W18 W19 — filling gaps by row position over a whole table, in two passes.

The original interpolates along the sorted rows of all customers: a row's value
depends on the nearest known rows before and after it, however far away.  A
window over the whole table would be one task; here the table is range-partitioned
by its order.

* Pass 1: each range partition gives one summary row per column: its first and last
  known value with their positions.  A window over the summaries of a column (as
  many rows as partitions) carries the last known one forward and the next one
  backward, past partitions that know none.
* Pass 2: each partition fills its rows from the known rows inside, and from the carried
  ones beyond its ends.

The order should end in a unique column, so that ties neither depend on
the input nor fall into one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _numbered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows with their range partition ``_part`` and global position ``_pos``, written once."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = (df.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    rows = rows.withColumn("_part", F.shiftright("_mid", 33))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))  # a row per partition
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    starts = counts.select(F.col("_part").alias("_p"), (before - F.shiftleft("_part", 33)).alias("_shift"))
    return rows.join(starts, F.col("_part") == F.col("_p")).withColumn("_pos", F.col("_mid") + F.col("_shift")).drop(
        "_mid", "_p", "_shift")


def _carried(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(_p, _before, _after): per partition and column (by index) the nearest known (pos, v) beyond its ends."""
    known = [F.when(F.col(c).isNotNull(), F.struct("_pos", F.col(c).cast("double").alias("v"))) for c in cols]
    ends = rows.groupBy("_part").agg(*[f(k).alias(f"{n}{i}") for i, k in enumerate(known) for n, f in (("f", F.min), ("l", F.max))])
    flat = ends.select("_part", F.posexplode(F.array(*[
        F.struct(F.col(f"f{i}").alias("f"), F.col(f"l{i}").alias("l")) for i in range(len(cols))])).alias("c", "e"))
    up, down = (Window.partitionBy("c").orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
                for o in (F.col("_part").asc(), F.col("_part").desc()))
    flat = flat.select("_part", "c", F.last("e.l", True).over(up).alias("b"), F.last("e.f", True).over(down).alias("a"))
    return flat.groupBy(F.col("_part").alias("_p")).agg(*[
        F.max(F.when(F.col("c") == i, F.col(s))).alias(f"{s}{i}") for i in range(len(cols)) for s in ("b", "a")])


def fill_by_position(df: DataFrame, order: Sequence[Column], cols: Sequence[str], method: str = "linear") -> DataFrame:
    """NULLs of ``cols`` filled along the rows in ``order``; other rows and columns unchanged.

    ``linear``: on the line between the nearest known rows, by position; before the
    first known row NULL, after the last one its value.  ``forward``: the value of
    the last known row before, NULL before the first.
    """
    rows = _numbered(df, order)
    met = rows.join(_carried(rows, cols), F.col("_part") == F.col("_p"))
    # both ways from the first row on: a frame that ends at the last row would be
    # read again for every row, the square of a partition
    before, after = (Window.partitionBy("_part").orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
                     for o in (F.col("_pos").asc(), F.col("_pos").desc()))
    out = met
    for i, c in enumerate(cols):
        known = F.when(F.col(c).isNotNull(), F.struct("_pos", F.col(c).cast("double").alias("v")))
        p = F.coalesce(F.last(known, True).over(before), F.col(f"b{i}"))
        value = p["v"]
        if method == "linear":
            n = F.coalesce(F.last(known, True).over(after), F.col(f"a{i}"))
            line = p["v"] + (n["v"] - p["v"]) * (F.col("_pos") - p["_pos"]) / (n["_pos"] - p["_pos"])
            value = F.when(p.isNotNull() & n.isNotNull(), line).otherwise(p["v"])
        out = out.withColumn(f"_new{i}", F.coalesce(F.col(c).cast("double"), value))
    new = {c: F.col(f"_new{i}").cast(df.schema[c].dataType).alias(c) for i, c in enumerate(cols)}
    return out.select(*[new.get(c, F.col(c)) for c in df.columns])
