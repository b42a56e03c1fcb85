"""Importance resampling towards a target distribution, drawn by exact selection.

Features are runs of one to three words, hashed to buckets.  A bucket's gain is the log of its
smoothed share in the target over its smoothed share in the corpus; a document's weight is the sum
of the gains of its features, computed for whole arrays of features.  A random number of the
Gumbel distribution, made from the digest of the id, is added: the documents of highest score are
then a draw without replacement in proportion to the weights.

How many are drawn is a share of the documents, so the score of the last one drawn must be found
exactly.  That is a weighted median of medians: the keys that remain stand in runs of at most
``CHUNK``; each run gives its median and size, and the weighted median of these splits the
remaining keys so that a quarter at least lies on either side.  Both sides are counted, and the
one without the cut is given up.  What remains is rewritten when it has fallen to a quarter, so
all rounds together read about as much as the first two.  Only medians and counts reach the
driver: one row per run.  The winners are sorted by ranges, with counts per range, not in one task.

The documents are read twice, for the counts of the buckets and for the weights; only counts and
one small row per document are shuffled or written.

Defined cases: null and empty texts have no features, weight 0 and are not drawn; a null id counts
as an empty one in the digest and comes last in ties; repeated rows are drawn each, rows equal in
score and id by their number of features; empty tables give an empty result, an empty target
leaves every gain to the corpus; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pricepanel.llm import crc
from pricepanel.llm.words import LOWER, NOT_ALNUM, pieces, split
from pricepanel.session import saved, ship

BUCKETS = 10_000
#: Words taken at once, so that memory does not grow with a text's length.
BLOCK_WORDS = 200_000
#: Keys of one median.
CHUNK = 200_000
#: So many keys at most are searched in one piece.
FEW = 20_000
ROWS_PER_RANGE = 2_000
MOST_RANGES = 4_096


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text and bucket of every run of one to three words, block by block of words."""
    data = LOWER[data]
    begin, end, first = split(data, offsets, NOT_ALNUM)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for lo in range(0, len(begin), BLOCK_WORDS):
        a, hi = max(0, lo - 2), min(len(begin), lo + BLOCK_WORDS)
        d, n = doc[a:hi], end[a:hi] - begin[a:hi]
        word = crc.raw_words(data, begin[a:hi], end[a:hi])
        # runs that end at a word of this block
        new = lo - a
        yield d[new:], crc.finished(word[new:], n[new:]) % buckets
        two = np.flatnonzero(d[1:] == d[:-1])
        pair, pair_n = np.zeros(len(d), np.uint32), np.zeros(len(d), np.int64)
        pair[two] = crc.joined(word[two], word[two + 1], n[two + 1])
        pair_n[two] = n[two] + 1 + n[two + 1]
        at = two[two + 1 >= new]
        yield d[at], crc.finished(pair[at], pair_n[at]) % buckets
        at = two[np.isin(two + 1, two)]
        at = at[at + 2 >= new]
        yield d[at], crc.finished(crc.joined(pair[at], word[at + 2], n[at + 2]), pair_n[at] + 1 + n[at + 2]) % buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts by bucket; each task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, data, offsets in pieces(b):
                for _, bucket in features(data, offsets, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    counts = texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket int, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, in thousandths of a nat, rounded down."""

    def dense(counts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for bucket, n in counts.collect():  # one row per bucket
            out[bucket] = n
        return out

    s, t = dense(bucket_counts(corpus, text_col, buckets)), dense(bucket_counts(target, text_col, buckets))
    all_s, all_t = int(s.sum()) + buckets, int(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log(((x + 1) * all_s) / ((y + 1) * all_t))) for x, y in zip(t.tolist(), s.tolist())], np.int64)


def noise(doc_id: Column, seed: int = 42) -> Column:
    """A number of the Gumbel distribution in thousandths, from the digest of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in batches:
            n_words, n, weight = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for lo, hi, data, offsets in pieces(b):
                one, all_n, sums = np.zeros((3, hi - lo), np.int64)
                for k, (doc, bucket) in enumerate(features(data, offsets, len(gain))):
                    found = np.bincount(doc, minlength=hi - lo)
                    all_n += found
                    one += found if k % 3 == 0 else 0  # every third part is the single words
                    sums += np.bincount(doc, weights=gain[bucket], minlength=hi - lo).astype(np.int64)
                n_words.append(one), n.append(all_n), weight.append(sums)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(np.concatenate(x)) for x in (n_words, n, weight))],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


#: Keys in the order of drawing: the score falls, then id, features and row rise.
_KEY = ["score", "no_id", "doc_id", "n_features", "row"]


def _after(key: tuple, strict: bool = True) -> Column:
    """Rows that come after ``key`` in the order of drawing (or are it)."""
    score, *rest = key
    beyond = F.col("score") < score
    equal = F.col("score") == score
    for name, value in zip(_KEY[1:], rest):
        beyond, equal = beyond | (equal & (F.col(name) > value)), equal & (F.col(name) == value)
    return beyond if strict else beyond | equal


def _sorted(t: pa.Table | pa.RecordBatch) -> np.ndarray:
    """Positions of the rows in the order of drawing."""
    c = [t.column(name).to_numpy(zero_copy_only=False) for name in _KEY]
    return np.lexsort((c[4], c[3], c[2], c[1], -c[0]))


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The median key of each run of rows, and their number."""

    def median(run: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(run)
        at = int(_sorted(t)[(t.num_rows - 1) // 2])
        return pa.RecordBatch.from_arrays([*(t.column(k).slice(at, 1).combine_chunks() for k in _KEY), pa.array([t.num_rows], pa.int64())], [*_KEY, "size"])

    run, rows = [], 0
    for b in batches:
        if b.num_rows:
            run.append(b)
            rows += b.num_rows
        if rows >= CHUNK:
            yield median(run)
            run, rows = [], 0
    if run:
        yield median(run)


def cutoff(keys: DataFrame, wanted: int) -> tuple | None:
    """The key of the ``wanted``-th row (from 1) in the order of drawing; None if there are fewer.

    ``keys`` holds ``_KEY``, all numbers, no two rows alike.
    """
    remaining = keys.select(*_KEY)
    stored = size = remaining.count()
    if not 0 < wanted <= size:
        return None
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in remaining.schema) + ", size long"
    while size > FEW:
        medians = remaining.mapInArrow(_medians, schema).toArrow()  # one row per CHUNK keys or task
        order = _sorted(medians)
        heavy = np.cumsum(medians.column("size").to_numpy()[order])
        at = int(order[np.searchsorted(heavy, (heavy[-1] + 1) // 2)])
        pivot = tuple(medians.column(k)[at].as_py() for k in _KEY)
        below = remaining.where(_after(pivot)).count()
        upto = size - below  # rows up to the pivot
        if wanted <= upto:
            remaining, size = remaining.where(~_after(pivot)), upto
        else:
            remaining, size, wanted = remaining.where(_after(pivot)), below, wanted - upto
        if size * 4 <= stored or size <= FEW:
            remaining, stored = saved(remaining, "selection"), size
    t = remaining.toArrow()  # at most FEW rows
    at = int(_sorted(t)[wanted - 1])
    return tuple(t.column(k)[at].as_py() for k in _KEY)


def ranked(rows: DataFrame, n: int) -> DataFrame:
    """``rank`` from 1 in the order of drawing, for ``n`` rows: sorted by ranges, then moved on by
    the rows of the ranges before."""
    ranges = max(1, min(MOST_RANGES, n // ROWS_PER_RANGE))
    order = [F.col("score").desc(), *(F.col(k) for k in _KEY[1:])]
    line = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    line = saved(line.withColumns({"range": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "drawn")
    sizes = line.groupBy("range").agg(F.count("*").alias("rows"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    sizes = sizes.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return line.join(F.broadcast(sizes), "range").withColumn("rank", F.col("before") + F.col("place") + 1).drop("range", "place", "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document: ``percent`` of those with
    ``least_words`` words are drawn and ranked."""
    ship(docs.sparkSession)
    gain = gains(docs.select(F.col(text_col).alias("text")), target.select(F.col(target_col).alias("text")))
    scored = weights(docs, gain, id_col, text_col)
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("row", F.monotonically_increasing_id())
    # the digits of an id serve in the order of drawing; a null id comes last
    scored = saved(scored.withColumn("no_id", F.col("doc_id").isNull().cast("int")), "importance")
    keys = scored.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")))
    fit = F.col("n_words") >= least_words
    wanted = scored.where(fit).count() * percent // 100
    last = cutoff(keys.where(fit), wanted)
    undrawn = scored.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    if last is None:
        return undrawn
    id_type = scored.schema["doc_id"].dataType
    drawn = ranked(keys.where(fit & ~_after(last)), wanted)
    drawn = drawn.withColumn("doc_id", F.when(F.col("no_id") == 0, F.col("doc_id")).cast(id_type)).select(*undrawn.columns)
    rest = keys.where(~fit | _after(last)).withColumn("doc_id", F.when(F.col("no_id") == 0, F.col("doc_id")).cast(id_type))
    return drawn.unionByName(rest.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))
