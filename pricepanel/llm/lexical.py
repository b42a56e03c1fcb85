"""Ranked lexical search by dense blocked matrix products.

Items are taken in tiles, each with the compact vocabulary of its own terms; documents in tiles
too.  A tile of impacts (documents by terms) times a tile of item weights (terms by items) gives
the scores of all its pairs in one BLAS product.  All numbers are integers: a tile's vocabulary
is cut where the sum of the largest possible products would reach 2^53, so every partial sum is
exact in float64 whatever its order, and partial sums are added in 64-bit integers.

Of each tile all documents that reach the tile's k-th best score of an item go on, ties included;
a task keeps the k best of its documents for each item, and the k best over all tasks are the
result.  Equal scores go by id.  The k best of each item and task is all that is shuffled.

The documents are read once for the counts (documents, terms, and the documents that hold each
item term) and once for the scores.  Items are sent to the tasks in shards of at most about
``SHARD_BYTES`` of distinct texts (a longer text is a shard by itself), and the documents are
read twice for each shard; all counts are over all documents, so shards change no score.

Terms are compared by a 64-bit hash of their bytes.

Defined cases: null and empty texts have no terms and are never ranked, nor do they count as
documents; items without terms return nothing; equal rows of the items are one item, an id with
several texts is ranked for each; documents without an id come last in ties, repeated rows are
ranked each; empty tables give an empty result; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from pricepanel.llm.words import NOT_ALNUM, pieces, text_bytes, words
from pricepanel.session import ship

SHARD_BYTES = 4 << 20
TILE_ITEMS = 256
#: Cells of one tile of impacts.
TILE_CELLS = 1 << 20
IMPACT = 1_000_000_000
#: No impact is as large.
MOST_IMPACT = IMPACT // 1000
EXACT = 1 << 53
#: Ids sort before those that are missing.
_NO_ID = np.iinfo(np.int64).max


def terms(data: np.ndarray, offsets: np.ndarray):
    return words(data, offsets, separator=NOT_ALNUM)


@dataclass
class Shard:
    """Some items: the hashes of their terms and how often each item holds each."""

    ids: pa.Array
    vocabulary: np.ndarray  # sorted hashes
    item: np.ndarray
    term: np.ndarray
    times: np.ndarray


def read_shard(ids: pa.Array, texts: pa.Array) -> Shard:
    w = terms(*text_bytes(texts))
    vocabulary, term = np.unique(w.hashes, return_inverse=True)
    pair, times = np.unique(w.doc * max(1, len(vocabulary)) + term, return_counts=True)
    return Shard(ids, vocabulary, pair // max(1, len(vocabulary)), pair % max(1, len(vocabulary)), times)


def shards(items: DataFrame) -> Iterator[Shard]:
    """The distinct items in shards of at most about ``SHARD_BYTES`` of text."""
    src = items.select(F.col("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total, longest = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.coalesce(F.max(F.octet_length("text")), F.lit(0))).first()
    n = max(1, -(-total // SHARD_BYTES))
    part = F.pmod(F.xxhash64("text", "item_id"), F.lit(n))
    big = F.octet_length("text") > SHARD_BYTES
    for s in range(n):
        t = src.where(~big & (part == s)).toArrow().sort_by([("item_id", "ascending"), ("text", "ascending")])
        if t.num_rows:
            yield read_shard(t.column("item_id").combine_chunks(), t.column("text").combine_chunks())
    if longest > SHARD_BYTES:
        for row in src.where(big).toLocalIterator():
            yield read_shard(pa.array([row.item_id], pa.int64()), pa.array([row.text], pa.large_string()))


@dataclass
class Tile:
    """Some items of a shard; ``parts`` cut its vocabulary so that partial sums stay exact."""

    items: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray]]  # terms of the shard, and term x item weights


def tiles(shard: Shard, weight: np.ndarray) -> list[Tile]:
    """Item tiles, given the weight of each term of the shard."""
    out, limit = [], (EXACT - 1) // MOST_IMPACT
    n_items = len(shard.ids)
    for lo in range(0, n_items, TILE_ITEMS):
        items = np.arange(lo, min(n_items, lo + TILE_ITEMS))
        here = np.flatnonzero((shard.item >= lo) & (shard.item < lo + TILE_ITEMS))
        vocabulary, column = np.unique(shard.term[here], return_inverse=True)
        total = weight[shard.term[here]] * shard.times[here]
        parts = []
        # a weight beyond the limit goes on to a further layer of the same terms
        while (total > 0).any():
            now = np.minimum(total, limit)
            most = np.zeros(len(vocabulary), np.int64)
            np.maximum.at(most, column, now)
            # first term of each part: the sums of the parts stay within the limit
            starts, so_far = [0], 0
            for v, m in enumerate(most.tolist()):
                if so_far + m > limit:
                    starts.append(v)
                    so_far = 0
                so_far += m
            for a, b in zip(starts, [*starts[1:], len(vocabulary)]):
                for c in range(a, b, TILE_CELLS // TILE_ITEMS):
                    d = min(b, c + TILE_CELLS // TILE_ITEMS)
                    pick = np.flatnonzero((column >= c) & (column < d) & (now > 0))
                    if len(pick):
                        cells = np.zeros((d - c, len(items)))
                        cells[column[pick] - c, shard.item[here[pick]] - lo] = now[pick]
                        parts.append((vocabulary[c:d], cells))
            total = total - now
        out.append(Tile(items, parts))
    return out


def _held(w, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, vocabulary term and number of occurrences, for terms of the vocabulary."""
    if not len(vocabulary) or not len(w.hashes):
        none = np.empty(0, np.int64)
        return none, none, none
    at = np.minimum(np.searchsorted(vocabulary, w.hashes), len(vocabulary) - 1)
    known = np.flatnonzero(vocabulary[at] == w.hashes)
    pair, times = np.unique(w.doc[known] * len(vocabulary) + at[known], return_counts=True)
    return pair // len(vocabulary), pair % len(vocabulary), times


def statistics(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with terms, terms, and the documents that hold each term of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        n, total, df = 0, 0, np.zeros(len(known), np.int64)
        for b in batches:
            for _, _, data, offsets in pieces(b):
                w = terms(data, offsets)
                n, total = n + int((w.counts > 0).sum()), total + len(w.hashes)
                df += np.bincount(_held(w, known)[1], minlength=len(known))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, some]), pa.array(np.r_[n, total, df[some]])], ["term", "n"])

    counts = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row a term of the shard
    t, n = counts.column("term").to_numpy(), counts.column("n").to_numpy()
    df = np.zeros(len(vocabulary) + 2, np.int64)
    df[t + 2] = n
    return int(df[0]), int(df[1]), df[2:]


class Best:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item, self.doc, self.score = np.empty((3, 0), np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, items: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: documents by items."""
        least = self.least[items]
        if len(ids) > self.k:
            least = np.maximum(least, np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k])
        d, i = np.nonzero(scores >= least)  # ties of the k-th included
        if len(d):
            self.parts.append((items[i], ids[d], scores[d, i]))
            self.waiting += len(d)
            if self.waiting > 200_000:
                self.settle()

    def settle(self) -> None:
        item, doc, score = (np.concatenate(x) for x in zip((self.item, self.doc, self.score), *self.parts))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = np.flatnonzero(place == self.k - 1)
        self.least[item[full]] = score[full]
        keep = place < self.k
        self.item, self.doc, self.score = item[keep], doc[keep], score[keep]
        self.parts, self.waiting = [], 0


def scores(ids: np.ndarray, w, shard: Shard, item_tiles: list[Tile], n: int, total: int, best: Best) -> None:
    """Score some texts against all items of the shard and keep the best."""
    doc, term, tf = _held(w, shard.vocabulary)
    size = 25 + 75 * w.counts[doc] * n // max(1, total)
    impact = (IMPACT * tf) // (1000 * tf + 8 * size)
    place = np.empty(len(shard.vocabulary), np.int64)
    for tile in item_tiles:
        place[:] = -1
        for part, _ in tile.parts:
            place[part] = 0
        mine = np.flatnonzero(place[term] == 0) if len(term) else np.empty(0, np.int64)
        rows, row = np.unique(doc[mine], return_inverse=True)
        width = max((len(part) for part, _ in tile.parts), default=1)
        per = max(1, TILE_CELLS // width)
        edge = np.searchsorted(row, np.arange(0, len(rows) + per, per))
        for k, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
            lo, hi = k * per, min(len(rows), (k + 1) * per)
            if lo >= hi:
                break
            sums = np.zeros((hi - lo, len(tile.items)), np.int64)
            for part, cells in tile.parts:
                place[part] = np.arange(len(part))
                at = np.full(len(shard.vocabulary), -1, np.int64) if len(tile.parts) > 1 else place
                if len(tile.parts) > 1:
                    at[part] = place[part]
                column = at[term[mine[a:b]]]
                have = column >= 0
                block = np.zeros((hi - lo, len(part)))
                block[row[a:b][have] - lo, column[have]] = impact[mine[a:b]][have]
                sums += (block @ cells).astype(np.int64)
            best.add(tile.items, ids[rows[lo:hi]], sums)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, of those above 0."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    kind, found = "shard int, item long, item_id long, doc_id long, score long", None
    for number, shard in enumerate(shards(items)):
        n, total, df = statistics(src, shard.vocabulary)
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        shared = spark.sparkContext.broadcast((shard, tiles(shard, weight)))  # bounded by SHARD_BYTES of text

        def run(batches: Iterator[pa.RecordBatch], shared=shared, n=n, total=total, number=number) -> Iterator[pa.RecordBatch]:
            shard, item_tiles = shared.value
            best = Best(len(shard.ids), k)
            for b in batches:
                ids = b.column("doc_id").fill_null(_NO_ID).to_numpy()
                for lo, hi, data, offsets in pieces(b):
                    scores(ids[lo:hi], terms(data, offsets), shard, item_tiles, n, total, best)
            best.settle()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(best.item), number), pa.int32()), pa.array(best.item), shard.ids.take(pa.array(best.item)),
                 pa.array(best.doc, pa.int64(), mask=best.doc == _NO_ID), pa.array(best.score)], ["shard", "item", "item_id", "doc_id", "score"])

        part = src.mapInArrow(run, kind)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    line = W.partitionBy("shard", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
