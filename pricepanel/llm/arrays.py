"""Array expressions whose cost grows with the array, not with its square."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Elements of a block: an array grown by appending is copied at each step, so only arrays of this
#: size, and one of the blocks' totals, are grown so.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used, also within lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _grown(lengths: Column) -> Column:
    """Sums of all elements before each."""
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(lengths, none, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))["out"]


def starts(lengths: Column) -> Column:
    """Sums of all elements before each element, for an array of long."""

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, n: a + n))
        return F.flatten(F.zip_with(F.transform(blocks, _grown), _grown(totals), lambda inner, before: F.transform(inner, lambda x: x + before)))

    def cut(all_: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor(F.greatest(F.size(all_) - 1, F.lit(0)) / BLOCK).cast("int"))
        return F.transform(places, lambda k: F.slice(all_, k * BLOCK + 1, F.lit(BLOCK)))

    return let(lengths, lambda all_: let(cut(all_), of_blocks))
