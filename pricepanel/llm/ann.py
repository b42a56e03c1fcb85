"""Nearest neighbours by adaptive dimension scan.

Vectors are rotated at random, so that any first few dimensions are a fair sample of the whole,
and kept by list of an inverted file in blocks of columns.  A query goes through the blocks of
its probed lists column block by column block: after each, the partial distance of a candidate is
an estimate of its distance, and candidates whose estimate is too far above the worst distance
kept so far, for a test of given strength, are given up.  Survivors get exact scores.  The queries
of a block go together, tile by tile: each column block is one product of matrices.

The largest inner product is the least distance after each vector is extended by one dimension
that brings all to the same length; queries get a zero there.

The same vector often stands in many rows: vectors are searched once per distinct value, with
the least ids that could be among the nearest, and lists are cut into blocks of bounded size, so no
group of copies and no crowded list meets in one task.  Centres are fitted on a sample of bounded
size; every row is indexed.

Defined cases: vectors that are null, empty, all zero, or hold a null or a non-finite number, take
no part, as candidates or as queries, and so do null ids and vectors of other dimensions than
most; ids may repeat, a row counts once per id and vector; ties go to the smaller id; fewer
candidates than asked for give all of them; an empty table gives an empty result; other columns
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from pricepanel.session import saved, ship

SAMPLE = 16_384  # rows the centres are fitted on, at most
BLOCK_ROWS = 2_048
COLUMNS = 16  # dimensions of a column block
TILE = 1 << 19  # pairs of queries and candidates looked at together


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (doubles), key: rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    d = df.select(F.col(id_col).cast("long").alias("id"), v.alias("vec")).where(F.col("id").isNotNull() & F.col("vec").isNotNull() & F.coalesce(ok, F.lit(False)))
    return d.withColumn("key", F.sha2(F.concat_ws(",", F.transform("vec", lambda x: (x + 0.0).cast("string"))), 256))


def kmeans(x: np.ndarray, lists: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    r = np.random.default_rng(seed)
    c = x[r.choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=lists)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def scan_tile(queries: np.ndarray, columns: list[np.ndarray], best: np.ndarray, k: int, strength: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (query, candidate) of a tile's pairs that survive the tests of each query against
    its distance ``best``, and are among its k + 1 nearest survivors, ties kept.

    A column block is one product of matrices; candidates that all queries gave up are left out
    of the next.
    """
    dim = sum(c.shape[1] for c in columns)
    live = np.arange(len(columns[0]))
    partial = np.zeros((len(queries), len(live)))
    keep = np.ones(partial.shape, bool)
    seen, scale = 0, 0.0
    for c in columns:
        c, z = c[live], queries[:, seen:seen + c.shape[1]]
        n = (c * c).sum(1)
        partial += n + (z * z).sum(1)[:, None] - 2 * (z @ c.T)
        seen += c.shape[1]
        scale += n.max(initial=0) + (z * z).sum(1).max(initial=0)
        # a sum of products is exact to the scale of the vectors, not of their distance
        bound = best if seen == dim else best * (1 + strength / np.sqrt(seen)) ** 2 * (seen / dim)
        many = keep.sum(1) > k
        keep &= (partial <= (bound + 1e-9 * scale)[:, None]) | ~many[:, None]
        used = keep.any(0)
        if seen < dim and 2 * used.sum() < len(live):
            live, partial, keep = live[used], partial[:, used], keep[:, used]
    partial[~keep] = np.inf
    if len(live) > k + 1:
        keep &= partial <= np.partition(partial, k, axis=1)[:, k:k + 1] + 1e-9 * scale
    asks, found = np.nonzero(keep)
    return asks, live[found]


def search(df: DataFrame, k: int = 20, query_every: int = 20, probes: float = 0.7, strength: float = 2.1, id_col: str = "vec_id",
           vec_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every row whose id is divisible by
    ``query_every``, by largest inner product.

    ``probes``: part of the lists a query looks into; ``strength`` of the test that gives up
    candidates (larger: fewer are lost).
    """
    spark = df.sparkSession
    ship(spark)
    empty = "query_id long, rank int, vec_id long, score double"
    rows = usable(df, id_col, vec_col)
    size = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if size is None:
        return spark.createDataFrame([], empty)
    dim = size["dim"]
    rows = saved(rows.where(F.size("vec") == dim).groupBy("id", "key").agg(F.first("vec").alias("vec")), "vectors")
    # of equal vectors only the least ids can be among the nearest: k, and one more for the query itself
    by_key = W.partitionBy("key").orderBy("id")
    head = rows.withColumn("n", F.row_number().over(by_key)).where(F.col("n") <= k + 1)
    distinct = saved(head.where("n = 1").select("key", "id", "vec"), "distinct")
    total, longest = distinct.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)))).first()

    lists = int(max(1, min(4096, round(np.sqrt(total) / 2))))
    chosen = distinct.orderBy(F.xxhash64("id", "key")).limit(min(sample, 64 * lists)).toPandas()
    train = np.stack(chosen.vec.map(np.asarray).to_list())
    extend = lambda x: np.concatenate([x, np.sqrt(np.maximum(0, longest**2 - (x * x).sum(1)))[:, None]], 1)
    turn = rotation(dim + 1)
    centres = kmeans(extend(train) @ turn, min(lists, len(train)))
    lists = len(centres)
    probed = max(1, min(lists, int(np.ceil(lists * probes))))
    blocks = max(1, -(-total // (lists * BLOCK_ROWS)))  # blocks of an even list
    shared = spark.sparkContext.broadcast((turn, centres))  # at most 4096 centres

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, c = shared.value
        for b in batches:
            if len(b):
                y = extend(np.stack(b.vec.map(np.asarray).to_list())) @ turn
                b["list"] = np.argmin((c * c).sum(1) - 2 * y @ c.T, axis=1)
                yield b[["key", "id", "vec", "list"]]

    placed = saved(distinct.mapInPandas(assign, "key string, id long, vec array<double>, list long"), "lists")
    held = placed.groupBy("list").agg(F.count("*").alias("held")).withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("held") / BLOCK_ROWS)))
    cand = placed.join(held.select("list", "parts"), "list").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    cand = cand.select("list", "part", "id", "vec", F.lit(False).alias("asks"), F.lit("").alias("key"), F.lit(None).cast("double").alias("near"))

    asking = rows.where(F.col("id") % query_every == 0).select(F.col("id").alias("query_id"), "key")
    asked = distinct.join(asking.select("key").distinct(), "key", "left_semi")

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, c = shared.value
        for b in batches:
            if len(b):
                x = np.stack(b.vec.map(np.asarray).to_list())
                y = np.concatenate([x, np.zeros((len(x), 1))], 1) @ turn
                order = np.argsort((c * c).sum(1) - 2 * y @ c.T, axis=1, kind="stable")[:, :probed]
                out = b.loc[b.index.repeat(order.shape[1]), ["key", "vec"]].reset_index(drop=True)
                out["list"] = order.ravel()
                yield out

    routed = asked.mapInPandas(route, "key string, vec array<double>, list long").join(held.select("list", "parts"), "list")
    routed = routed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    routed = routed.select("list", "part", F.lit(None).cast("long").alias("id"), "vec", F.lit(True).alias("asks"), "key", F.lit(None).cast("double").alias("near"))

    def scan(block: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        """All queries of a block against its candidates, distinct vectors both."""
        turn, _ = shared.value
        if not len(block) or not len(ask):
            return pd.DataFrame({"key": [], "id": [], "score": []})
        x = np.stack(block.vec.map(np.asarray).to_list())
        ids = block.id.to_numpy()
        y = extend(x) @ turn
        columns = [np.ascontiguousarray(y[:, s:s + COLUMNS]) for s in range(0, y.shape[1], COLUMNS)]
        first = y[:min(len(x), 4 * k)]
        keys, found, scores = [], [], []
        step = max(1, TILE // len(x))
        for at in range(0, len(ask), step):
            v = np.stack(ask.vec.iloc[at:at + step].map(np.asarray).to_list())
            z = np.concatenate([v, np.zeros((len(v), 1))], 1) @ turn
            d = (first * first).sum(1) + (z * z).sum(1)[:, None] - 2 * (z @ first.T)
            best = np.partition(d, k, axis=1)[:, k] if len(first) > k else np.full(len(v), np.inf)
            i, j = scan_tile(z, columns, best * (1 + 1e-9), k, strength)
            s = (x[j] * v[i]).sum(1)
            order = np.lexsort((ids[j], -s, i))
            i, j, s = i[order], j[order], s[order]
            top = np.arange(len(i)) - np.searchsorted(i, i) <= k
            keys.append(ask.key.to_numpy()[at + i[top]])
            found.append(ids[j[top]])
            scores.append(s[top])
        return pd.DataFrame({"key": np.concatenate(keys), "id": np.concatenate(found), "score": np.concatenate(scores)})

    # queries of a block in chunks, so that a list that all ask for is not one group either
    chunks = max(1, -(-int(asked.count() * probed) // (lists * BLOCK_ROWS)))
    chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    c_side = cand.withColumn("chunk", chunk).select("list", "part", "chunk", "id", "vec")
    q_side = routed.withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int")).select("list", "part", "chunk", "key", "vec")
    group = ["list", "part", "chunk"]
    near = q_side.groupBy(*group).cogroup(c_side.groupBy(*group)).applyInPandas(lambda q, c: scan(c, q), "key string, id long, score double")

    # the nearest distinct vectors of each query vector, then the rows that have them
    best = W.partitionBy("key").orderBy(F.desc("score"), "id")
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).select("key", F.col("id").alias("near_id"), "score")
    same = head.select(F.col("key").alias("near_key"), F.col("id").alias("vec_id"))
    to_key = distinct.select(F.col("id").alias("near_id"), F.col("key").alias("near_key"))
    per_key = near.join(to_key, "near_id").join(same, "near_key")
    per_key = per_key.withColumn("n", F.row_number().over(W.partitionBy("key").orderBy(F.desc("score"), "vec_id"))).where(F.col("n") <= k + 1)
    result = asking.join(per_key.select("key", "vec_id", "score"), "key").where("query_id != vec_id")
    rank = F.row_number().over(W.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    return result.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
