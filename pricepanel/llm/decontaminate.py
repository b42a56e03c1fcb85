"""Benchmark decontamination: BM25 over an inverted index of test items, block-max pruning, and a
check of question and answer.

Every passage of every training text is a query.  The index holds, for each term, the items with
their BM25 impact, in blocks of items, with the largest impact of each block.  A passage is
dropped when the sum of its terms' largest impacts cannot reach any threshold; of the rest, only
blocks whose largest impacts can reach a threshold of the block are scored exactly.  Both bounds
are sums of maxima, so no item above its threshold is lost.

An item's threshold is a share of the least score that any run of its words of half a passage's
length reaches: a text that holds the item has a passage that holds such a run.  Hits are
confirmed on the words around them: the three-word shingles of the item's question and those of
its answer must both be there to a large part.

The index is built per shard of items; the number of shards keeps each below ``SHARD_BYTES``, and
the corpus is read once per shard.  Terms are weighed by counts over all items, so shards change
no score and no threshold.  Each distinct text is indexed once; the ids of its items are joined to
the hits.

The question of an item is its first two thirds of words, the answer the rest.

Defined cases: null and empty texts and items match nothing; an item without words is no item;
repeated rows are searched each; an item id may repeat; of equal matches the earliest place
counts; empty tables give an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricepanel.llm.words import Words, distinct, mix, pieces, text_bytes, words
from pricepanel.session import saved, ship

PASSAGE = 64  # words; passages begin every half passage
HALF = PASSAGE // 2
BLOCK = 8  # items
K1, B = 1.2, 0.75
GRAM = 3
SHARD_BYTES = 4 << 20
#: (passage, term, block) sums held at once.
_AT_ONCE = 4_000_000


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of runs of k words (of the whole, if shorter)."""
    k = min(k, len(h))
    if not k:
        return np.empty(0, np.uint64)
    n = len(h) - k + 1
    g = np.full(n, k, np.uint64)
    for j in range(k):
        g = mix(g) + h[j:j + n]
    return np.unique(mix(g))


@dataclass
class Index:
    ids: np.ndarray
    terms: np.ndarray  # sorted hashes
    first: np.ndarray  # postings of each term, by item
    items: np.ndarray
    impacts: np.ndarray
    most: np.ndarray  # largest impact of each term
    block_first: np.ndarray  # blocks of each term
    blocks: np.ndarray
    block_most: np.ndarray
    thresholds: np.ndarray
    block_threshold: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]
    lengths: np.ndarray


@dataclass
class Counts:
    """Of all items: how many have words, their mean number of words, and for some terms, by rising
    hash, the items that hold each."""

    items: int
    mean_length: float
    terms: np.ndarray
    df: np.ndarray


def build_index(ids: np.ndarray, texts: pa.Array, share: float, counts: Counts | None = None) -> Index:
    """The index of some texts, weighed by ``counts``, or by their own."""
    data, offsets = text_bytes(texts)
    w = words(data, offsets, trimmed=True)
    have = w.counts > 0
    runs = [w.hashes[a:b] for a, b in zip(w.first[:-1], w.first[1:]) if b > a]
    lengths, ids = w.counts[have], ids[have]
    n = len(runs)
    owner = np.repeat(np.arange(n), lengths)
    every = np.concatenate(runs) if runs else np.empty(0, np.uint64)
    terms, term = np.unique(every, return_inverse=True)
    pair, tf = np.unique(term.astype(np.int64) * max(n, 1) + owner, return_counts=True)
    t, item = pair // max(n, 1), pair % max(n, 1)
    df = np.bincount(t, minlength=len(terms))
    if counts is None:
        counts = Counts(n, lengths.mean() if n else 1.0, terms, df)
    df = counts.df[np.searchsorted(counts.terms, terms)] if len(terms) else df
    idf = np.log1p((counts.items - df + 0.5) / (df + 0.5))
    norm = K1 * (1 - B + B * lengths / max(1.0, counts.mean_length))
    impact = idf[t] * tf * (K1 + 1) / (tf + norm[item])
    first = np.searchsorted(t, np.arange(len(terms) + 1))
    most = np.maximum.reduceat(impact, first[:-1]) if len(t) else np.empty(0)

    key = t * ((n + BLOCK - 1) // BLOCK + 1) + item // BLOCK
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    block_most = np.maximum.reduceat(impact, start) if len(start) else np.empty(0)
    block_first = np.searchsorted(t[start], np.arange(len(terms) + 1))

    thresholds = np.empty(n)
    at = np.concatenate([[0], np.cumsum(lengths)])
    for i in range(n):
        own = term[at[i]:at[i + 1]]
        value = {x: impact[first[x] + np.searchsorted(item[first[x]:first[x + 1]], i)] for x in set(own.tolist())}
        run = min(HALF, len(own))
        thresholds[i] = share * min(sum(value[x] for x in set(own[s:s + run].tolist())) for s in range(len(own) - run + 1))
    block_threshold = np.minimum.reduceat(thresholds, np.arange(0, n, BLOCK)) if n else np.empty(0)
    cut = [max(1, round(len(r) * 2 / 3)) for r in runs]
    return Index(ids, terms, first, item, impact, most, block_first, (item // BLOCK)[start], block_most, thresholds, block_threshold,
                 [_grams(r[:c], GRAM) for r, c in zip(runs, cut)], [_grams(r[c:], GRAM) for r, c in zip(runs, cut)], lengths)


def _spread(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions first[x]..first[x+1] for each x of ``which``, and the x's own position."""
    n = first[which + 1] - first[which]
    row = np.repeat(np.arange(len(which)), n)
    return np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[which], n), row


def candidates(w: Words, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All (text, first word of the passage, item, score) above the item's threshold."""
    none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    if not len(w.hashes) or not len(index.terms):
        return none
    at = np.minimum(np.searchsorted(index.terms, w.hashes), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[at] == w.hashes)
    if not len(known):
        return none
    term = at[known]
    # halves of passages, numbered so that those of two texts never join
    halves = -(-w.counts // HALF) + 1
    half_first = np.concatenate([[0], np.cumsum(halves)])
    doc = w.doc[known]
    half = half_first[doc] + (known - w.first[doc]) // HALF
    key = np.unique(half * len(index.terms) + term)  # distinct terms of each half
    half, term = key // len(index.terms), key % len(index.terms)
    bound = np.bincount(half, weights=index.most[term], minlength=half_first[-1] + 1)
    passage = np.flatnonzero(bound[:-1] + bound[1:] >= index.block_threshold.min())  # of halves p and p + 1
    if not len(passage):
        return none
    lo = np.searchsorted(half, np.arange(half_first[-1] + 2))
    out = []
    per = max(1, _AT_ONCE // max(1, len(index.block_threshold) * 64))
    for s in range(0, len(passage), per):
        out.append(_scored(passage[s:s + per], term, lo, index))
    p, item, score = (np.concatenate(x) for x in zip(*out))
    d = np.searchsorted(half_first, p, "right") - 1
    return d, (p - half_first[d]) * HALF, item, score


def _scored(passage: np.ndarray, term: np.ndarray, lo: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, item, score) above threshold of the given passages."""
    begin, n = lo[passage], lo[passage + 2] - lo[passage]
    row = np.repeat(np.arange(len(passage)), n)
    t = term[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)]
    key = np.unique(row * len(index.terms) + t)  # terms that both halves hold count once
    row, t = key // len(index.terms), key % len(index.terms)

    blocks = len(index.block_threshold)
    pos, of = _spread(index.block_first, t)
    bound = np.bincount(row[of] * blocks + index.blocks[pos], weights=index.block_most[pos], minlength=len(passage) * blocks)
    live = bound.reshape(len(passage), blocks) >= index.block_threshold
    go = live.any(axis=1)[row]
    row, t = row[go], t[go]

    pos, of = _spread(index.first, t)
    item, r = index.items[pos], row[of]
    go = live[r, item // BLOCK]
    key, impact = r[go] * len(index.ids) + item[go], index.impacts[pos[go]]
    pair, inverse = np.unique(key, return_inverse=True)
    score = np.bincount(inverse, weights=impact, minlength=len(pair))
    r, item = pair // len(index.ids), pair % len(index.ids)
    hit = score >= index.thresholds[item]
    return passage[r[hit]], item[hit], score[hit]


def _overlap(part: np.ndarray, around: np.ndarray) -> float:
    return float(np.isin(part, around).mean()) if len(part) else 1.0


def matches(w: Words, index: Index, overlap: float) -> list[tuple[int, int, int, float, float, float]]:
    """(text, item, first word, score, question overlap, answer overlap): the best confirmed
    match of each text and item."""
    best: dict[tuple[int, int], tuple] = {}
    for d, start, item, score in zip(*(x.tolist() for x in candidates(w, index))):
        reach = int(index.lengths[item])
        a = max(w.first[d], w.first[d] + start - reach)
        b = min(w.first[d + 1], w.first[d] + start + PASSAGE + reach)
        # parts of fewer words than a gram are looked for as they are
        around = np.concatenate([_grams(w.hashes[a:b], k) for k in range(1, GRAM + 1)])
        in_q, in_a = _overlap(index.question[item], around), _overlap(index.answer[item], around)
        if in_q >= overlap and in_a >= overlap:
            found = (-min(in_q, in_a), -score, start, in_q, in_a)
            if (d, item) not in best or found < best[d, item]:
                best[d, item] = found
    return [(d, item, f[2], -f[1], f[3], f[4]) for (d, item), f in sorted(best.items())]


def _item_terms(items: DataFrame) -> DataFrame:
    """term, items, words: the distinct terms of each item, counted per task; term NULL has the
    items with words, and their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, total = 0, 0
            for _, _, data, offsets in pieces(b):
                w = words(data, offsets, trimmed=True)
                n, total = n + int((w.counts > 0).sum()), total + len(w.hashes)
                terms, df = np.unique(distinct(w.hashes, w.first)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(df.astype(np.int64)), pa.array(np.zeros(len(terms), np.int64))],
                                                 ["term", "items", "words"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([n], pa.int64()), pa.array([total], pa.int64())], ["term", "items", "words"])

    found = items.select("text").mapInArrow(run, "term long, items long, words long")
    return found.groupBy("term").agg(F.sum("items").alias("items"), F.sum("words").alias("words"))


def prepared(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, text, text_key."""
    src = items.select(F.col(id_col).alias("item_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return src.withColumn("text_key", F.xxhash64("text"))


def indexes(items: DataFrame, share: float) -> Iterator[Index]:
    """The index of each shard of the distinct texts of ``prepared`` items, each of at most about
    ``SHARD_BYTES`` of text; ids are keys of texts."""
    counts = saved(_item_terms(items), "item-terms")
    whole = counts.where(F.col("term").isNull()).first()
    n, mean = (whole["items"], whole["words"] / max(1, whole["items"])) if whole else (0, 1.0)
    texts = items.select("text_key", "text").distinct()
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_BYTES))
    for s in range(shards):
        part = texts.where(F.pmod("text_key", F.lit(shards)) == s)
        t = part.toArrow().sort_by([("text_key", "ascending"), ("text", "ascending")])
        # as many terms as the shard's texts have
        own = counts.join(_item_terms(part).select("term"), "term", "left_semi").toArrow()
        terms = own.column("term").to_numpy().view(np.uint64)
        order = np.argsort(terms)
        weighed = Counts(n, mean, terms[order], own.column("items").to_numpy()[order])
        index = build_index(t.column("text_key").to_numpy(), t.column("text").combine_chunks(), share, weighed)
        if len(index.ids):
            yield index


def find(docs: DataFrame, items: DataFrame, share: float = 0.6, overlap: float = 0.6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, first_word, score, question_overlap, answer_overlap: texts that hold test
    items.

    ``share``: part of an item's least own score that a passage must reach; ``overlap``: part of
    the question's and of the answer's three-word shingles that must stand around the passage.
    """
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_key long, first_word long, score double, question_overlap double, answer_overlap double"
    found, items = None, prepared(items)
    for index in indexes(items, share):
        shared = spark.sparkContext.broadcast(index)  # bounded by SHARD_BYTES of text

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo, hi, data, offsets in pieces(b):
                    hits = matches(words(data, offsets, trimmed=True), shared.value, overlap)
                    if hits:
                        d, item, start, score, in_q, in_a = zip(*hits)
                        yield pa.RecordBatch.from_arrays(
                            [b.column("doc_id").slice(lo, hi - lo).take(pa.array(d)), pa.array(shared.value.ids[list(item)], pa.int64()), pa.array(start, pa.int64()),
                             pa.array(score), pa.array(in_q), pa.array(in_a)], ["doc_id", "text_key", "first_word", "score", "question_overlap", "answer_overlap"])

        part = src.mapInArrow(run, kind)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], kind)
    ids = items.select("text_key", F.col("item_id").cast("long").alias("item_id"))
    return found.join(ids, "text_key").select("doc_id", "item_id", "first_word", "score", "question_overlap", "answer_overlap")


def clean(docs: DataFrame, items: DataFrame, share: float = 0.6, overlap: float = 0.6) -> DataFrame:
    """The documents that hold no test item, with all their columns; read once per shard, nothing
    is shuffled."""
    spark = docs.sparkSession
    ship(spark)
    columns, schema = docs.columns, docs.schema
    for index in indexes(prepared(items), share):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                held = np.zeros(b.num_rows, bool)
                for lo, _, data, offsets in pieces(b):
                    for hit in matches(words(data, offsets, trimmed=True), shared.value, overlap):
                        held[lo + hit[0]] = True
                yield b.filter(pa.array(~held))

        docs = docs.mapInArrow(run, schema).select(*columns)
    return docs
