"""J14 — points in ranges of one or two dimensions as an equi join.

An axis of 2**bits cells is a binary tree: node 1 is the whole axis, node ``2**bits
+ c`` the cell c, and the parent of a node is half its number.  A range of cells
is the union of at most 2 * bits nodes (its canonical nodes), and a cell lies in the
range exactly if one of the ``bits + 1`` nodes above it is among them.  A rectangle
is the product of the nodes of both axes, a point the product of both paths, so
"point in rectangle" is equality of a node pair, found once.  A range thus costs
the logarithm of its length, not its length.

Cells are whole units of ``scale`` per value; values outside the axis go to its
ends.  A range's first and last cells can hold points outside it, so the exact
bounds are compared afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 11  # 2048 cells: months up to 170 years, weights up to 204.7 kg in tenths


def cell_of(value: Column, scale: int = 1, bits: int = BITS) -> Column:
    """The cell that holds a value; NULL for NULL."""
    top = (1 << bits) - 1
    return F.when(value.isNotNull(), F.least(F.greatest(F.floor(value * scale), F.lit(0)), F.lit(top)).cast("int"))


def path_of(cell: Column, bits: int = BITS) -> Column:
    """The nodes above a cell, itself and the whole axis included; only the whole axis for NULL."""
    steps = F.sequence(F.lit(0), F.lit(bits))
    up = F.transform(steps, lambda k: F.call_function("shiftright", cell + (1 << bits), k))
    return F.when(cell.isNull(), F.array(F.lit(1))).otherwise(up)


def nodes_of(first: Column, last: Column, bits: int = BITS) -> Column:
    """Canonical nodes of the cells first..last; a NULL end is the axis's."""
    leaf = 1 << bits
    begin = F.struct((F.coalesce(first, F.lit(0)) + leaf).alias("lo"), (F.coalesce(last, F.lit(leaf - 1)) + leaf + 1).alias("hi"),
                     F.array().cast("array<int>").alias("nodes"))

    def level(s: Column, k: Column) -> Column:
        lo, hi = s["lo"], s["hi"]  # nodes lo..hi - 1 of this level are left to cover
        left = (lo < hi) & (lo % 2 == 1)
        rest = F.when(left, lo + 1).otherwise(lo)
        right = (rest < hi) & (hi % 2 == 1)
        top = F.when(right, hi - 1).otherwise(hi)
        none = F.array().cast("array<int>")
        return F.struct(F.when(rest < top, F.floor(rest / 2)).otherwise(F.lit(0)).cast("int").alias("lo"),
                        F.when(rest < top, F.floor(top / 2)).otherwise(F.lit(0)).cast("int").alias("hi"),
                        F.concat(s["nodes"], F.when(left, F.array(lo)).otherwise(none),
                                 F.when(right, F.array(hi - 1)).otherwise(none)).alias("nodes"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(bits)), begin, level, lambda s: s["nodes"])


def pairs(a: Column, b: Column) -> Column:
    """All pairs of two node lists, as one number each."""
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: x.cast("long") * (1 << 32) + y)))
