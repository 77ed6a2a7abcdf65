"""Intervals of whole numbers as few aligned blocks, so that containment is an equi-join.

A block of level l holds the 2^l numbers whose quotient by 2^l is its number. An interval of n numbers is tiled by at most two
blocks a level, 2 log2(n) in all; a number lies in one block of each level. Thus a number meets an interval that holds it
under exactly one (level, block), however long the interval is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shifted(n: Column, level: Column) -> Column:
    """n / 2^level rounded down, also below zero."""
    return F.call_function("shiftright", n, level)


def _block(level: Column, number: Column) -> Column:
    return F.struct(level.alias("level"), number.alias("block"))


def cover(first: Column, last: Column) -> Column:
    """The aligned blocks that tile first..last (longs), as an array of (level, block); empty when last < first, NULL when one is NULL."""
    first, last = first.cast("long"), last.cast("long")

    def ends(level: Column) -> Column:
        lo = -_shifted(-first, level)  # first block of the level that starts inside
        hi = _shifted(last + 1, level)  # first block that does not end inside
        lo_odd, hi_odd = F.pmod(lo, F.lit(2)) == 1, F.pmod(hi, F.lit(2)) == 1
        left = F.when(lo_odd & (lo < hi), _block(level, lo))
        right = F.when(hi_odd & (lo + lo_odd.cast("long") < hi), _block(level, hi - 1))
        return F.array(left, right)

    # One level more than can be needed, as a logarithm may fall just below a whole number.
    top = F.ceil(F.log2((F.greatest(last - first, F.lit(0)) + 1).cast("double"))).cast("int") + 1
    tiles = F.flatten(F.transform(F.sequence(F.lit(0), top), ends))
    return F.when(first.isNotNull() & last.isNotNull(), F.filter(tiles, lambda b: b.isNotNull()))


def holders(n: Column, levels: Column) -> Column:
    """The block of each of the `levels` that holds n, as an array of (level, block)."""
    n = n.cast("long")
    return F.transform(levels, lambda level: _block(level, _shifted(n, level)))
