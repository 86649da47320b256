"""Sharding (operator 6): minimax contiguous partition, law ``bytes``.

Rows of equal text form one atomic group.  Groups stand in the order of their
digest; a shard is a contiguous run of groups, and the partition is the one
whose largest shard is smallest: binary search on the capacity, each capacity
checked greedily (fill a shard up to it, then cut), and the cuts of the smallest
feasible capacity are used: among the cuts that keep to it, those nearest to even shares.
The partition is contiguous over the groups that are left after the next step.

A group larger than an even share of what is left to deal (at most ``shards``
of them) takes a shard of its own first, else its size would be the capacity
of all the others; the rest is dealt to the other shards.

Scale: sizes are prefix-summed in two levels (inside digest buckets, over bucket
totals).  The search runs on a summary of the prefix sums with at most ``bins``
rows: per bin of prefix space its first and last group end.  Cutting at a
bin's first end gives a feasible capacity, cutting at the searched position
itself a lower bound; only the bins between the two that a cut may fall into are
looked up again in finer bins, until both agree: the result is exact, and the
driver holds at most ``bins`` rows at a time.  A group with any share of the
rows is numbered in ``sqrt(rows)`` cells.  Everything is DataFrame functions.

Results for odd input: a NULL text has no bytes and groups with empty texts;
rows with equal ids are numbered in any fixed order of their columns; repeated
rows each get a slot; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import full_text, row_hash, written

ROW_BYTES = 16


def greedy(ends, firsts, total: int, shards: int, capacity: int, upper: bool, strict: bool = True) -> list[int] | None:
    """Cuts for ``capacity`` over binned prefix sums, or None if ``shards`` are too few.

    ``ends``: last group end per bin, ``firsts``: first one.  ``upper`` takes the
    searched position itself inside a bin (no cut can lie further), else
    the bin's first end (a real cut).  Not ``strict``: the first cuts, whatever is left.
    """
    cuts, at = [], 0
    while total - at > capacity:
        reach = at + capacity
        j = bisect.bisect_right(ends, reach)  # bins wholly within reach
        best = ends[j - 1] if j else 0
        if j < len(ends) and firsts[j] <= reach:
            best = min(reach, ends[j]) if upper else firsts[j]
        if best <= at or len(cuts) + 1 >= shards:
            return None if strict else cuts
        at = best
        cuts.append(at)
    return cuts


def search(ends, firsts, total: int, shards: int, low: int, upper: bool) -> tuple[int, list[int]]:
    """Smallest capacity that ``greedy`` accepts, with its cuts."""
    high = total
    while low < high:
        mid = (low + high) // 2
        if greedy(ends, firsts, total, shards, mid, upper) is None:
            low = mid + 1
        else:
            high = mid
    return low, greedy(ends, firsts, total, shards, low, upper) or []


def balanced(known: list[int], total: int, shards: int, capacity: int) -> list[int]:
    """Cuts at ``known`` group ends, no shard above ``capacity``, each as near an even share as that allows."""
    low = [total]  # lowest place of each cut from the last one back: what follows must still fit
    for _ in range(shards - 1):
        x = low[-1] - capacity
        low.append(0 if x <= 0 else known[bisect.bisect_left(known, x)])
    cuts, at = [], 0
    for k in range(1, shards):
        a = bisect.bisect_left(known, max(low[shards - k], at))
        b = bisect.bisect_right(known, at + capacity) - 1
        i = bisect.bisect_left(known, total * k // shards, a, b + 1)
        near = [known[j] for j in (i - 1, i) if a <= j <= b]
        at = min(near, key=lambda e: abs(e - total * k // shards), default=at)
        cuts.append(at)
    return cuts


def minimax_cuts(prefix: DataFrame, total: int, largest: int, shards: int, bins: int = 32768) -> list[int]:
    """Cut positions (group ends) of the smallest largest shard.

    ``prefix``: one row per group, ``end`` = inclusive prefix sum of sizes.
    """
    if total <= 0 or shards <= 1:
        return []
    low = max(-(-total // shards), largest)
    table: dict[int, int] = {}  # last end -> first end of its bin
    windows = [(0, total)]
    while True:
        span = sum(b - a for a, b in windows)
        width = max(1, -(-span // bins))
        inside = F.lit(False)
        for a, b in windows:
            inside = inside | ((F.col("end") > a) & (F.col("end") <= b))
        found = (prefix.filter(inside).groupBy(F.floor(F.col("end") / width).alias("bin"))
                 .agg(F.min("end").alias("first"), F.max("end").alias("last")).collect())
        table = {e: f for e, f in table.items() if not any(a < e <= b for a, b in windows)}
        table.update((r["last"], r["first"]) for r in found)
        ends = sorted(table)
        firsts = [table[e] for e in ends]
        least, _ = search(ends, firsts, total, shards, low, True)
        most, _ = search(ends, firsts, total, shards, least, False)
        if least == most or width == 1:
            break
        # cut k lies between its lowest place at the least and its highest at the largest capacity
        lo = greedy(ends, firsts, total, shards, least, False, strict=False)
        hi = greedy(ends, firsts, total, shards, most, True, strict=False)
        windows, low, before = [], least, span
        for k in range(shards - 1):
            a = lo[k] if k < len(lo) else total
            b = min(total, hi[k] if k < len(hi) else total)
            i = bisect.bisect_left(ends, a)
            j = min(bisect.bisect_left(ends, b), len(ends) - 1)
            while i <= j and firsts[i] == ends[i]:
                i += 1
            while i <= j and firsts[j] == ends[j]:
                j -= 1
            if i <= j:
                if windows and windows[-1][1] >= firsts[i] - 1:
                    windows[-1] = (windows[-1][0], max(windows[-1][1], ends[j]))
                else:
                    windows.append((firsts[i] - 1, ends[j]))
        if not windows:
            break
        if 2 * sum(b - a for a, b in windows) > before:  # always on the way to bins of one position
            bins *= 2
    return balanced(sorted({*ends, *firsts}), total, shards, most)


def shard_documents(docs: DataFrame, shards: int = 40, bins: int = 32768, buckets: int = 4096) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = full_text(docs).cast("binary")
    sized = docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"), row_hash(docs).alias("row"))
    sized = written(sized, "sized")
    rows = sized.count()
    spread = max(1, math.isqrt(rows))
    cell = F.pmod(F.xxhash64("doc_id", "row"), F.lit(spread)).alias("cell")
    sized = sized.withColumn("cell", cell)
    bucket = (F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % buckets).alias("bucket")
    cells = written(sized.groupBy("digest", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
                    .withColumn("bucket", bucket), "cells")
    groups = cells.groupBy("bucket", "digest").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    groups = written(groups, "groups")
    # groups above an even share take a shard each
    top = groups.orderBy(F.col("bytes").desc(), "digest").limit(shards).select("digest", "bytes").collect()
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    left, alone = shards, []
    for g in top:
        if left <= 1 or g["bytes"] * left <= total:
            break
        alone.append(bytes(g["digest"]))
        total, left = total - g["bytes"], left - 1
    largest = next((g["bytes"] for g in top[len(alone):]), 0)
    own = F.lit(None).cast("int")
    for k, d in enumerate(alone):
        own = F.when(F.col("digest") == F.lit(d), F.lit(left + k)).otherwise(own)
    groups = groups.withColumn("own", own)
    rest = groups.filter("own IS NULL")
    offsets = (rest.groupBy("bucket").agg(F.sum("bytes").alias("b"))
               .select("bucket", (F.sum("b").over(Window.orderBy("bucket")) - F.col("b")).alias("offset")))
    inside = Window.partitionBy("bucket").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    prefix = written(rest.withColumn("run", F.sum("bytes").over(inside)).join(offsets, "bucket")
                     .select("digest", (F.col("run") + F.col("offset")).alias("end")), "prefix")
    cuts = minimax_cuts(prefix, total, largest, left, bins)
    shard = F.lit(0)
    for c in cuts:
        shard = shard + (F.col("end") > c).cast("int")
    placed = (prefix.select("digest", shard.cast("int").alias("shard"))
              .union(groups.filter("own IS NOT NULL").select("digest", F.col("own").cast("int"))))
    cells = written(cells.join(placed, "digest"), "placed")
    # slots: rows before the cell, over (shard, bucket) totals and inside them
    base = cells.groupBy("shard", "bucket").agg(F.sum("n").alias("b"))
    base = base.select("shard", "bucket", (F.sum("b").over(Window.partitionBy("shard").orderBy("bucket"))
                                           - F.col("b")).alias("base"))
    order = Window.partitionBy("shard", "bucket").orderBy("digest", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cells.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).join(base, ["shard", "bucket"])
              .select("digest", "cell", "shard", (F.col("base") + F.col("before")).alias("start")))
    numbered = sized.withColumn("i", F.row_number().over(Window.partitionBy("digest", "cell").orderBy("doc_id", "row")))
    return (numbered.join(starts, ["digest", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("start") + F.col("i") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
