"""Array expressions that Spark lacks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often and however deep in lambdas the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def running_sums(values: Column) -> Column:
    """Running totals of an array of longs.

    Spark's array functions can't carry a total from element to element without copying the array, so the sums are
    taken in blocks: totals of whole blocks first, then the rest within the block.
    """
    zero = F.lit(0).cast("long")
    total = lambda part: F.aggregate(part, zero, lambda a, x: a + x)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def sums(v: Column) -> Column:
        n_blocks = F.ceil(F.size(v) / BLOCK).cast("int")
        blocks = F.transform(upto(n_blocks), lambda b: total(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
        before = bind(blocks, lambda s: F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b))))
        return bind(before, lambda p: F.transform(v, lambda _, i: F.get(p, F.floor(i / BLOCK).cast("int")) + total(
            F.slice(v, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1))))

    return bind(values, sums)
