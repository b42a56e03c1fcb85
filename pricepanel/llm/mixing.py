"""Mixing sources to target weights by weighted fair queueing.

Each document of a source, in shuffled order, gets the virtual finish time at which its last
word would be sent if the sources shared one line by weight: words of the source so far, divided
by the source's target.  A second pass over the source continues the count.  All copies are then
sorted by finish time over all sources, and the line is cut at the total budget.  Documents are
sent in packets of a few words, so a very long one neither blocks the line nor misses the cut.

Running totals are taken in two steps, totals of ranges first and rows within a range second, so
neither a hot source nor the whole table is sorted in one task.  Packets that finish after the cut
are not sorted at all.

Defined cases: a null or blank text has size 0 and is never taken; null sources form one source,
sorted last; repeated rows count as documents of their own; an empty table gives an empty result.
Documents are compared by the digest of their id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pricepanel.session import saved

WORD = r"[^\x20\x09-\x0D]+"
PACKET = 256
ROWS_PER_RANGE = 2_000
MOST_RANGES = 65_536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """Words each source should give: ``sizes(source, source_size)`` plus ``target``.

    Sources in code-point order, nulls last, take the weights in turn.  They share ``share`` times
    all words by weight; none gets more than ``most`` times its own, and what that leaves is shared
    again by weight until none is above.  One row per source: the running sums go over those only.
    """
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    s = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("weight", turn)
    s = s.withColumn("room", F.col("source_size") * F.lit(most))
    by_room = W.orderBy(F.col("room") / F.col("weight"), F.col("rank")).rowsBetween(W.unboundedPreceding, -1)
    total = W.partitionBy()
    s = s.withColumns({
        "spent": F.coalesce(F.sum("room").over(by_room), F.lit(0)), "used": F.coalesce(F.sum("weight").over(by_room), F.lit(0)),
        "all_words": F.sum("source_size").over(total), "all_weight": F.sum("weight").over(total),
    })
    s = s.withColumn("level", (F.col("all_words") * F.lit(share) - F.col("spent")) / (F.col("all_weight") - F.col("used")))
    full = F.col("room") / F.col("weight") <= F.col("level")
    s = s.withColumn("open_level", F.max(F.when(~full, F.struct(-F.col("room") / F.col("weight"), -F.col("rank"), F.col("level"))))
                     .over(total).getField("level"))
    return s.select("source", "source_size", F.when(full, F.col("room").cast("double")).otherwise(F.col("weight") * F.col("open_level")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per document.

    ``row_col`` names a column that tells rows apart, also those of one id; it is returned too.
    """
    ref = [] if row_col is None else ["ref"]
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    sized = saved(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), key.alias("key"),
                              word_count(F.col(text_col)).alias("size"), *[F.col(row_col).alias(r) for r in ref]), "mix-sizes")
    rows, total = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(MOST_RANGES, max(1, rows // ROWS_PER_RANGE))
    slots = min(MOST_RANGES, max(1, (rows + total // PACKET) // ROWS_PER_RANGE))
    sized = sized.withColumn("part", F.floor(F.conv(F.substring("key", 1, 4), 16, 10).cast("long") * ranges / 65536))

    parts = sized.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    goals = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, share, most)
    before = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("part_size").over(before), F.lit(0))).withColumnRenamed("source", "s")
    parts = parts.join(goals.withColumnRenamed("source", "g"), F.col("s").eqNullSafe(F.col("g"))).withColumnRenamed("part", "p")
    within = W.partitionBy("source", "part").orderBy("key", "size")
    d = sized.withColumns({"so_far": F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0)), "row": F.row_number().over(within)})
    d = d.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))

    # the packets of all copies, by finish time
    copies = F.sequence(F.lit(0), F.lit(most - 1))
    packets = F.sequence(F.lit(0), F.floor(F.greatest(F.col("size") - 1, F.lit(0)) / PACKET))
    c = d.withColumn("copy", F.explode(copies)).withColumn("packet", F.explode(packets))
    c = c.withColumn("words", F.least(F.lit(PACKET), F.col("size") - F.col("packet") * PACKET))
    start = F.col("copy") * F.col("source_size") + F.col("before") + F.col("so_far") - F.col("size")
    c = c.withColumn("finish", F.coalesce(F.try_divide(start + F.col("packet") * PACKET + F.col("words"), F.col("target")), F.lit(0.0)))
    c = c.withColumn("slot", F.least(F.floor(F.col("finish") * slots), F.lit(4 * slots)))
    budget = int(total * share)
    earlier = W.orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    line = c.groupBy("slot").agg(F.sum("words").alias("slot_words"))
    line = saved(line.select("slot", F.coalesce(F.sum("slot_words").over(earlier), F.lit(0)).alias("ahead")), "mix-line")
    last = line.where(F.col("ahead") < budget).agg(F.coalesce(F.max("slot"), F.lit(-1))).first()[0]
    # nothing is taken beyond the slot of the cut: of the packets there only the first of each
    # document goes on, to a slot of its own kind, so that the late end of the line is not one group
    late, first = F.col("slot") > last, (F.col("copy") == 0) & (F.col("packet") == 0)
    aside = F.lit(last + 1) + F.pmod(F.xxhash64("key", "row"), F.lit(slots))
    c = c.where(~late | first).withColumn("slot", F.when(late, aside).otherwise(F.col("slot")))
    in_slot = W.partitionBy("slot").orderBy("finish", F.col("source").asc_nulls_last(), "key", "copy", "packet", "size", "row")
    c = c.withColumn("sent", F.coalesce(F.sum("words").over(in_slot.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    c = c.join(line.where(F.col("ahead") < budget), "slot", "left")
    left = F.lit(budget) - F.coalesce("ahead", F.lit(budget)) - F.col("sent")
    c = c.withColumn("taken", F.greatest(F.lit(0), F.least(F.col("words"), left)))
    return (c.groupBy("source", "part", "row", "doc_id", "key", "size", "source_size", "target", *ref).agg(F.sum("taken").alias("taken"))
            .select("doc_id", "source", "size", "source_size", "target", "taken", *[F.col(r).alias(row_col) for r in ref]))
