"""A15 S9 — exact distinct counts that add up over batches.

A batch's distinct ids are kept as bitmaps: one row of 32,768 ids per bucket.  Bitmaps of
several batches merge by OR, so the distinct count over any set of batches is
exact and needs the small bitmap table only, never the rows again.  Ids are whole
numbers from 0 on.

Ids that rows would only get by a join (the products of a name) are counted without it.
Ids joined to the same keys always come together, so their smallest stands for all of
them, and their number is written in binary: an id in the bitmap of slice k stands for
2^k ids.  Such bitmaps merge by OR as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _bitmaps(flat: DataFrame, batch: str) -> DataFrame:
    """Bitmaps of distinct (batch, measure, slice, id) rows, which are dealt by bitmap: rows are
    a few bytes, a bitmap of them in each task would be 4 KB."""
    flat = flat.withColumn("bucket", F.bitmap_bucket_number("id"))
    return flat.repartition(batch, "measure", "slice", "bucket").groupBy(batch, "measure", "slice", "bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def batch_bitmaps(df: DataFrame, batch: str, ids: Sequence[str]) -> DataFrame:
    """(batch, measure, slice 0, bucket, bits): the ids of each batch; NULL ids are not counted."""
    flat = df.select(batch, F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("id")) for c in ids])).alias("e"))
    flat = flat.select(batch, "e.measure", F.lit(0).alias("slice"), "e.id").filter("id IS NOT NULL")
    return _bitmaps(flat.distinct(), batch)


def joint_ids(members: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """(on, id, n): for each key the smallest ids of the groups of ids found under the same keys, and the groups' sizes."""
    pairs = members.select(F.struct(*on).alias("_key"), F.col(column).cast("long").alias("id")).dropna("any", subset=["id"])
    keys = pairs.groupBy("id").agg(F.array_sort(F.collect_set("_key")).alias("_keys"))
    groups = keys.groupBy("_keys").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    return groups.select(F.explode("_keys").alias("_key"), "id", "n").select("_key.*", "id", "n")


def member_bitmaps(df: DataFrame, batch: str, ids: Sequence[str], members: DataFrame, on: Sequence[str]) -> DataFrame:
    """(batch, measure, slice, bucket, bits): as :func:`batch_bitmaps` of ``df`` joined with ``members``, for ids of ``members``."""
    out = None
    for c in ids:
        met = df.select(batch, *on).join(joint_ids(members, on, c), list(on)).select(batch, "id", "n").distinct()
        slices = F.filter(F.sequence(F.lit(0), F.length(F.bin("n")) - 1), lambda k: F.call_function("shiftright", F.col("n"), k) % 2 == 1)
        one = _bitmaps(met.select(batch, F.lit(c).alias("measure"), F.explode(slices).alias("slice"), "id"), batch)
        out = one if out is None else out.unionByName(one)
    return out


def merge_bitmaps(bitmaps: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, measure, slice, bucket, bits): the bitmaps of all batches together, or per ``keep``."""
    return bitmaps.groupBy(*keep, "measure", "slice", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, measure, ids): distinct ids, over all batches or per ``keep``."""
    stands_for = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slice"))
    return merge_bitmaps(bitmaps, keep).groupBy(*keep, "measure").agg(F.sum(F.bitmap_count("bits") * stands_for).alias("ids"))


def run_statistics(df: DataFrame, batch: str, ids: Sequence[str], members: DataFrame | None = None,
                   on: Sequence[str] = ()) -> DataFrame:
    """Per batch, and with batch NULL over the run: rows and the distinct count of each id column.

    The run's row comes from the batches' bitmaps and row counts.  With ``members`` the rows are
    those of ``df`` joined with it by the ``on`` columns, which may be far more than both
    hold; they are counted, not built.  Ids may be columns of either table.
    """
    if members is None:
        bitmaps = batch_bitmaps(df, batch, ids)
        rows = df.groupBy(batch).agg(F.count(F.lit(1)).alias("rows"))
    else:
        met = df.join(members.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), list(on))
        rows = met.groupBy(batch).agg(F.sum("_n").alias("rows"))
        own, theirs = [c for c in ids if c in df.columns], [c for c in ids if c not in df.columns]
        bitmaps = [batch_bitmaps(met, batch, own)] if own else []
        bitmaps += [member_bitmaps(df, batch, theirs, members, on)] if theirs else []
        bitmaps = bitmaps[0] if len(bitmaps) == 1 else bitmaps[0].unionByName(bitmaps[1])
    run = rows.agg(F.lit(None).cast(rows.schema[batch].dataType).alias(batch), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    counts = distinct_counts(bitmaps, [batch]).unionByName(
        distinct_counts(bitmaps).withColumn(batch, F.lit(None).cast(rows.schema[batch].dataType)))
    wide = counts.groupBy(F.col(batch).alias("_b")).agg(*[
        F.max(F.when(F.col("measure") == c, F.col("ids"))).alias(f"distinct_{c}") for c in ids])
    out = rows.unionByName(run).join(wide, F.col(batch).eqNullSafe(F.col("_b")), "left")
    return out.select(batch, "rows", *[F.coalesce(f"distinct_{c}", F.lit(0).cast("long")).alias(f"distinct_{c}") for c in ids])
