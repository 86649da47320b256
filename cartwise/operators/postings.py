"""Exact top-N partners for items that hold many hot keys (used by :mod:`pairs`).

``score(a, b)`` adds the weights that ``a`` gives to the keys both hold.  One
posting list per key would name almost every item; here lists are kept per
*set* of keys, and an item reads them from the most selective on and stops as
soon as nothing unread can reach its best ``top_n``.

* Items with the same keys and partition are one signature that offers its first
  ``top_n + 1`` ids: copies never make a list longer.
* Keys fall into G groups by field, so that no item holds more than ``MOST`` keys of a
  group.  The list of r keys of a group names the signatures that hold all of them.
* Reading all lists of ``r[g]`` keys of ``a`` in every group finds each signature that
  shares at least ``r[g]`` keys of some group with ``a``.  Every other one shares at most
  ``r[g] - 1`` keys of each group, so its score is at most the sum over groups of the
  ``r[g] - 1`` largest weights there: the bound of what is unread.
* An (item, partition) whose ``top_n``-th score is above this bound is done.  For
  the others the widest group goes on to sets of one key less, until all are done or single
  keys have been read, after which nothing is unread.

Lists are read by one equi join per round on (hash of the set, partition), only for open
(item, partition) pairs, and a found pair is scored from its whole keys; equal hashes of
different sets cost a comparison, never a result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .keys import top_k_per_key

MOST = 10  # keys of an item in one group: at most 252 sets of one size


def in_group(keys: Column, g: int, groups: int) -> Column:
    return F.filter(keys, lambda x: F.pmod(x["f"], F.lit(groups)) == g)


def sets_of(keys: Column, g: int, groups: int, size: int) -> Column:
    """Hashes of all sets of ``size`` keys that ``keys`` holds in group ``g``."""
    mine = F.transform(in_group(keys, g, groups), lambda x: x["k"])
    if size == 1:
        return F.transform(mine, lambda k: F.xxhash64(F.lit(g), F.array(k)))
    masks = F.filter(F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), F.size(mine)) - 1),
                     lambda m: F.bit_count(m) == size)
    return F.transform(masks, lambda m: F.xxhash64(F.lit(g), F.filter(
        mine, lambda k, i: F.call_function("getbit", m, i) == 1)))


def group_sizes(frames: Sequence[DataFrame], column: str, groups: int) -> list[int]:
    """Most keys of a row in each group, over all frames."""
    out = [0] * groups
    for df in frames:
        row = df.agg(*[F.coalesce(F.max(F.size(in_group(F.col(column), g, groups))), F.lit(0)) for g in range(groups)]).first()
        out = [max(x, y) for x, y in zip(out, row)]
    return out


def grouping(frames: Sequence[DataFrame], column: str) -> list[int]:
    """Sizes of as few groups as hold at most ``MOST`` keys of any row (64 groups at most)."""
    widest = max(df.agg(F.coalesce(F.max(F.size(column)), F.lit(0))).first()[0] for df in frames)
    groups = max(1, -(-widest // MOST))
    while True:
        sizes = group_sizes(frames, column, groups)
        if max(sizes) <= MOST or groups >= 64:
            return sizes
        groups += max(1, groups // 2)


def unread_bound(keys: Column, sizes: Sequence[int], read: Sequence[int]) -> Column:
    """Largest score of a signature that no list of ``read[g]`` keys names."""
    total = F.lit(0.0)
    for g, r in enumerate(read):
        if r > 1:
            weights = F.sort_array(F.transform(in_group(keys, g, len(sizes)), lambda x: x["w"]), asc=False)
            total = total + F.aggregate(F.slice(weights, 1, r - 1), F.lit(0.0), lambda acc, w: acc + w)
    return total


def top_by_sets(lefts: DataFrame, rights: DataFrame, a: str, b: str, part: Sequence[str], dis: Sequence[str],
                top_n: int, order: Sequence[Column], trace: list | None = None) -> DataFrame:
    """(a, b, *part, score, shared): for each (a, partition) its best ``top_n`` right items, or all if fewer.

    ``lefts``: (a, _l_<dis>, f, k, w) and ``rights``: (b, *part, *dis, f, k), one row per item and key;
    ``f`` is a hash of the key's field.  ``order`` sorts score, shared and b; the bound needs the
    score first.  ``trace`` collects the number of pairs scored in each round.
    """
    ensure_checkpoint_dir(lefts.sparkSession)
    ldis = [f"_l_{c}" for c in dis]
    p = F.to_json(F.struct(*[F.col(c) for c in part]), {"ignoreNullFields": "false"}) if part else F.lit("")
    whole = rights.groupBy(b, *part, *dis).agg(F.array_sort(F.collect_list(F.struct("f", "k"))).alias("_keys"))
    first = top_k_per_key(whole, [*part, *dis, "_keys"], [F.col(b).asc()], top_n + 1)
    sigs = first.groupBy(*part, *dis, "_keys").agg(F.array_sort(F.collect_list(b)).alias("_ids"))
    sigs = sigs.withColumn("_p", p).withColumn("_sid", F.monotonically_increasing_id()).checkpoint(eager=True)
    held = sigs.select("_p", F.explode("_keys.k").alias("k")).distinct()
    mine = lefts.join(held.select("k").distinct(), "k", "left_semi").groupBy(a, *ldis).agg(
        F.array_sort(F.collect_list(F.struct("f", "k", "w"))).alias("_mine")).checkpoint(eager=True)
    # an open (item, partition) shares a key, so each of them has a result
    open_ = mine.select(a, F.explode("_mine.k").alias("k")).join(held, "k").select(a, "_p").distinct().checkpoint(eager=True)
    sizes = grouping([sigs.withColumnRenamed("_keys", "_x"), mine.withColumnRenamed("_mine", "_x")], "_x")
    groups = len(sizes)
    read = [s // 2 + 1 if s <= MOST else 1 for s in sizes]
    turn, best = list(range(groups)), None
    while True:
        asked = open_.join(mine, a).select(a, "_p", F.explode(F.array_distinct(F.concat(
            *[sets_of(F.col("_mine"), g, groups, read[g]) for g in turn]))).alias("_h"))
        lists = sigs.select("_sid", "_p", F.explode(F.array_distinct(F.concat(
            *[sets_of(F.col("_keys"), g, groups, read[g]) for g in turn]))).alias("_h"))
        met = asked.join(lists, ["_h", "_p"]).select(a, "_sid").distinct()
        both = met.join(mine, a).join(sigs, "_sid")
        for c in dis:
            both = both.filter(~F.col(f"_l_{c}").eqNullSafe(F.col(c)))
        common = F.filter("_mine", lambda x: F.exists("_keys", lambda y: y["k"] == x["k"]))
        both = both.select(a, *part, "_p", "_ids", common.alias("_common"))
        found = both.select(a, *part, "_p", F.explode("_ids").alias(b), F.size("_common").alias("shared"),
                            F.aggregate(F.transform("_common", lambda x: x["w"]), F.lit(0.0), lambda s, w: s + w).alias("score"))
        found = found.filter(F.col(a) != F.col(b)).select(a, b, *part, "_p", "score", F.col("shared").cast("long").alias("shared"))
        if trace is not None:
            trace.append(met.count())
        if best is not None:
            found = found.unionByName(best).dropDuplicates([a, b, "_p"])
        best = top_k_per_key(found, [a, "_p"], order, top_n).checkpoint(eager=True)
        if all(r == 1 for r in read):
            break
        reached = best.groupBy(a, "_p").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last")).filter(F.col("n") == top_n)
        done = reached.join(mine, a).filter(F.col("last") > unread_bound(F.col("_mine"), sizes, read) + 1e-9).select(a, "_p")
        open_ = open_.join(done, [a, "_p"], "left_anti").checkpoint(eager=True)
        if not open_.limit(1).count():
            break
        widest = max(range(groups), key=lambda g: read[g])
        read[widest] -= 1
        turn = [widest]
    return best.drop("_p")
