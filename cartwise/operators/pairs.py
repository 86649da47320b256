"""Top-N partners by shared keys, without expanding hot keys into all pairs.

``score(a, b) = Σ weight(k)`` over keys k that left item ``a`` and right
item ``b`` share; the result is the best ``top_n`` partners ``b`` per
``(a, partition of b)``, ordered by score desc, shared-key count desc,
``b`` asc.  Used by the companion job (R2) and similar products (R11).

A plain equi join on the key emits n_a(k) * n_b(k) rows for every key, which
explodes when one value is shared by a large part of the catalog.  Keys are
split by their right-side frequency:

* cold keys (at most ``hot_threshold`` right rows) are joined directly —
  every left row meets at most ``hot_threshold`` partners per key;
* hot keys are never joined item to item.  A right item with at most
  ``max_subset`` (4) hot keys is indexed under every non-empty subset of
  them (at most 15 entries), keeping only the first ``top_n + 1`` ids per
  (subset, partition, distinct-constraint value), and with one such constraint
  twice as many per (subset, partition); a left item looks up its
  own hot-key subsets of up to that size, extended level by level only
  while some right item holds the set (apriori pruning, lossless because
  every subset of an indexed set is indexed).  Right items with more hot keys
  go through the posting lists of :mod:`postings`, read until nothing unread
  can reach an item's best ``top_n``.
* candidates get their full score from their own keys (a handful per item);
  hot keys and their sets are numbers, not texts, so that what a task holds
  does not grow with the keys' lengths.

Exactness: a right item holding all keys of a subset P scores at least the
weight of P with at least |P| shared keys (weights >= 0), so it ranks at or
above every item whose overlap with ``a`` is exactly P; if an item is not
among the first ``top_n + 1`` ids holding its overlap, ``top_n`` others
(plus possibly ``a`` itself) rank above it.  A partner sharing a cold key
is a cold pair and is scored in full anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .keys import top_k_per_key
from .postings import top_by_sets

DEFAULT_HOT_THRESHOLD = 32
ROWS_PER_TASK = 25_000  # (item, key) rows: each brings up to some ten candidates
SET_SHARES = 8  # a set's items are cut in as many shares before they meet


def pair_top_n(left: DataFrame, right: DataFrame, keys: Sequence[str], *,
               left_id: str = "a", right_id: str = "b", weight: str | None = None,
               partition: Sequence[str] = (), distinct_on: Sequence[str] = (),
               top_n: int = 1, hot_threshold: int = DEFAULT_HOT_THRESHOLD,
               tie_by_shared: bool = True, materialize: bool = True,
               max_subset: int = 4, trace: list | None = None) -> DataFrame:
    """Best ``top_n`` right items per (left item, right partition).

    ``left``: rows (left_id, *keys, [weight], *distinct_on); one row per
    (left_id, key) — weights of duplicate rows are summed.
    ``right``: rows (right_id, *partition, *keys, *distinct_on).
    ``distinct_on``: a pair only counts when these columns differ
    (``IS DISTINCT FROM``: NULL vs value differs, NULL vs NULL does not).
    ``partition`` and ``distinct_on`` are attributes of an item (one value
    per item, as a product's category and brand are).
    ``tie_by_shared=False`` orders by score, then id only; the exactness
    argument then needs strictly positive weights.
    ``max_subset``: items with at most this many hot keys use the subset
    index (a right item adds 2^s - 1 entries, a left item looks up its
    subsets of up to this size); items with more use posting lists.
    ``materialize``: checkpoint the keyed left and right rows (shared
    checkpoint folder) — five branches read them, and their column sets
    differ, so Spark could not reuse one computation otherwise.
    ``trace``: takes the numbers of pairs that posting lists scored, round by round.
    Returns (left_id, right_id, *partition, score double, shared bigint, pair_rank int).
    """
    a, b = left_id, right_id
    ks, part, dis = list(keys), list(partition), list(distinct_on)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    lk = (left.select(a, *ks, *dis, w.alias("_w"))
          .groupBy(a, *ks, *dis).agg(F.sum("_w").alias("_w")))
    rk = right.select(b, *part, *ks, *dis).distinct()
    lk = lk.select(a, *ks, *[F.col(c).alias(f"_l_{c}") for c in dis], "_w")
    field = F.xxhash64(*[F.col(c) for c in ks[:-1]]) if len(ks) > 1 else F.xxhash64(*ks)

    def allowed(df):
        cond = F.col(a) != F.col(b)
        for c in dis:
            cond = cond & ~F.col(f"_l_{c}").eqNullSafe(F.col(c))
        return df.filter(cond)

    # hot keys by number: rows and sets hold eight bytes a key, whatever its text.
    # The counts are written, so a number stays with its key in all branches
    spark = left.sparkSession
    ensure_checkpoint_dir(spark)
    held = rk.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    hot = held.filter(F.col("_n") > hot_threshold).select(*ks, F.monotonically_increasing_id().alias("_k"))
    lk, rk = lk.join(hot, ks, "left"), rk.join(hot, ks, "left")
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect
        cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(cores, (held.agg(F.sum("_n")).first()[0] or 0) // ROWS_PER_TASK)
    if materialize:
        # spread by item before the checkpoint: the candidate joins fan out
        # from these rows and must not inherit one coalesced partition; the
        # partitions grow in number, not in size
        lk = lk.repartition(n, a).checkpoint(eager=True)
        rk = rk.repartition(n, b).checkpoint(eager=True)

    # hot keys: (a, _k, _w) and (b, _k)
    ldis = [f"_l_{c}" for c in dis]
    lh = lk.filter(F.col("_k").isNotNull()).select(a, "_k", field.alias("_f"), "_w", *ldis)
    rh = rk.filter(F.col("_k").isNotNull()).select(b, *part, *dis, "_k", field.alias("_f"))

    # cold keys: bounded fan-out per left row
    cold = allowed(lk.filter(F.col("_k").isNull()).drop("_k")
                   .join(rk.filter(F.col("_k").isNull()).drop("_k"), ks)).select(a, b, *part, "_w", F.lit(1).alias("_c"))

    # right items' hot-key sets
    sig = rh.repartition(n, b).groupBy(b, *part, *dis).agg(F.array_sort(F.collect_list("_k")).alias("_sig"))
    small = sig.filter(F.size("_sig") <= max_subset)
    large = sig.filter(F.size("_sig") > max_subset)

    # subset index: every non-empty subset of a small hot-key set (bit masks)
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.size("_sig")).cast("int") - 1)
    subsets = F.transform(masks, lambda m: F.filter(
        "_sig", lambda x, i: F.floor(m / F.pow(F.lit(2), i)) % 2 == 1))
    index = small.select(b, *part, *dis, F.explode(subsets).alias("_set"))
    # cut in shares of each set's items first, so that a set held by very many is no single task.
    # Sets are dealt to n parts by number, here and below: AQE would merge them into one a core,
    # and what such a task holds grows with the catalog
    share = F.pmod(F.xxhash64(b), F.lit(SET_SHARES))
    index = index.withColumn("_share", share).repartition(n, "_set", "_share")
    index = top_k_per_key(index, ["_set", *part, *dis, "_share"], [F.col(b).asc()], top_n + 1).drop("_share")
    index = top_k_per_key(index.repartition(n, "_set"), ["_set", *part, *dis], [F.col(b).asc()], top_n + 1)
    if len(dis) == 1:
        # whichever value a left item leaves out, at most top_n + 1 of these are its own,
        # so its first top_n + 1 of the others are among twice as many, however many values there are
        index = top_k_per_key(index, ["_set", *part], [F.col(b).asc(), F.col(dis[0]).asc()], 2 * (top_n + 1))

    # a left item with few hot keys looks up all their subsets
    own = lh.repartition(n, a).groupBy(a).agg(F.array_sort(F.collect_set("_k")).alias("_sig"))
    few = own.filter(F.size("_sig") <= max_subset)
    if dis:
        # a set counts for the attributes under which the item holds its first key
        held_by = lh.repartition(n, a).groupBy(a, *ldis).agg(F.collect_set("_k").alias("_held"))
        sets = few.join(held_by, a).select(a, *ldis, "_held", F.explode(subsets).alias("_set")).filter(
            F.array_contains("_held", F.element_at("_set", 1))).drop("_held")
    else:
        sets = few.select(a, F.explode(subsets).alias("_set"))
    wider = own.filter(F.size("_sig") > max_subset).select(a)
    if wider.limit(1).count():
        # one with more: its hot-key subsets of size 1..max_subset, keys in sorted
        # order; a set is only extended if some right item holds it (every
        # subset of an indexed set is indexed too, so nothing is lost)
        lw = lh.join(wider, a, "left_semi")
        existing = index.select("_set").distinct()
        level = lw.select(a, *ldis, F.array("_k").alias("_set"), F.col("_k").alias("_last"))
        level = level.repartition(n, "_set").join(existing, "_set", "left_semi")
        lookups = [level]
        for _ in range(max_subset - 1):
            nxt = lw.select(a, F.col("_k").alias("_k2"))
            level = (level.repartition(n, a).join(nxt, a).filter(F.col("_k2") > F.col("_last"))
                     .select(a, *ldis, F.concat("_set", F.array("_k2")).alias("_set"), F.col("_k2").alias("_last")))
            level = level.repartition(n, "_set").join(existing, "_set", "left_semi")
            lookups.append(level)
        for more in lookups:
            sets = sets.unionByName(more.select(a, *ldis, "_set"))
    sets = sets.repartition(n, "_set")
    sub = allowed(sets.join(index, "_set")).select(a, b, *part, F.lit(0.0).alias("_w"), F.lit(0).alias("_c"))

    # each candidate once, with its cold share; then the hot share: b's own hot
    # keys met by a's, both as arrays of one row an item
    met = cold.unionByName(sub).repartition(n, a).groupBy(a, b, *part).agg(F.sum("_w").alias("_cs"), F.sum("_c").alias("_cc"))
    theirs = rh.repartition(n, b).groupBy(b).agg(F.collect_list("_k").alias("_theirs"))
    mine = lh.repartition(n, a).groupBy(a).agg(F.collect_list(F.struct("_k", "_w")).alias("_mine"))
    met = met.join(theirs, b, "left").repartition(n, a).join(mine, a, "left")
    times = F.transform("_mine", lambda x: F.struct(
        x["_w"].alias("w"), F.size(F.filter("_theirs", lambda k: k == x["_k"])).alias("n")))
    both = F.col("_mine").isNotNull() & F.col("_theirs").isNotNull()
    hot_score = F.when(both, F.aggregate(times, F.lit(0.0), lambda s, x: s + x["w"] * x["n"])).otherwise(0.0)
    hot_count = F.when(both, F.aggregate(times, F.lit(0), lambda s, x: s + x["n"])).otherwise(0)
    cands = met.select(a, b, *part, (F.col("_cs") + hot_score).alias("score"), (F.col("_cc") + hot_count).alias("shared"))

    order = [F.col("score").desc(), F.col("shared").desc(), F.col(b).asc()]
    if not tie_by_shared:
        order = [order[0], order[2]]
    # items with more hot keys, if there are any
    many = large.select(b, *part, *dis)
    if many.limit(1).count():
        wide = rh.join(many.select(b, *[F.col(c).alias(f"_m_{c}") for c in part + dis]), b)
        for c in part + dis:
            wide = wide.filter(F.col(c).eqNullSafe(F.col(f"_m_{c}")))
        more = top_by_sets(
            lh.select(a, *ldis, F.col("_f").alias("f"), F.col("_k").alias("k"), F.col("_w").alias("w")),
            wide.select(b, *part, *dis, F.col("_f").alias("f"), F.col("_k").alias("k")),
            a, b, part, dis, top_n, order, trace)
        cands = cands.unionByName(more).groupBy(a, b, *part).agg(F.max(F.struct("score", "shared")).alias("_m")).select(
            a, b, *part, "_m.score", "_m.shared")
    # scores are sums of (rounded) weights: 9 digits make equal sums equal
    # whatever the summation order
    best = cands.select(a, b, *part, F.round("score", 9).alias("score"), F.col("shared").cast("bigint").alias("shared"))
    return top_k_per_key(best, [a, *part], order, top_n, rank_col="pair_rank")
