"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages.  Each passage is encoded from its bytes and words; a gated
attention network (tanh times sigmoid) gives each passage a weight within its document, the
weighted sum of the passages represents the document, and a logistic layer scores it.  Only
documents have labels: which passages speak for a low quality is learned.

The network is fitted on the driver on at most ``sample`` labelled documents at hand, the ones with the
least digest of their id, and of these on as many as have ``SAMPLE_PASSAGES`` passages together,
bounds that do not depend on the corpus; texts of more than ``LONGEST`` passages are scored, but
not learned from.  Every document is scored, by its whole text; each task holds the passages of
about a megabyte of text.

Features come from the text alone.

Defined cases: null and empty texts are one passage without words; repeated rows are scored each;
of labels that disagree the mean decides, from a half on 1, null labels and ids are left out;
without any usable label all documents score the prior of a half; an empty table gives an empty
result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pricepanel.llm.words import mix, pieces, split, text_bytes, words
from pricepanel.session import saved, ship

PASSAGE = 64  # words
HASHED = 64
SAMPLE = 6_000
SAMPLE_PASSAGES = 300_000
LONGEST = 20_000

_CLASSES = np.zeros((256, 8), np.float32)  # upper, lower, digit, white, sentence mark, other mark, repeated mark sign, beyond ASCII
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b] = [65 <= _b < 91, 97 <= _b < 123, 48 <= _b < 58, _c in " \t\n\r\x0b\x0c", _c in ".,;:'\"()-", 33 <= _b < 127 and not _c.isalnum() and _c not in ".,;:'\"()-", _c in "|#$%&*!", _b >= 128]


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the first passage of each text (and their number)."""
    w = words(data, offsets)
    n = w.counts
    count = np.maximum(1, -(-n // PASSAGE))
    first = np.concatenate([[0], np.cumsum(count)])
    total = int(first[-1])
    within = np.arange(len(w.hashes)) - np.repeat(w.first[:-1], n)
    of = np.repeat(first[:-1], n) + within // PASSAGE  # passage of each word
    size = np.bincount(of, minlength=total).astype(np.float32)
    # bytes of a passage: from its first word to the next passage's
    edge = np.empty(total + 1, np.int64)
    edge[:-1] = np.repeat(offsets[:-1], count)
    starts = np.flatnonzero(within % PASSAGE == 0)
    edge[of[starts]] = w.starts[starts]
    edge[first[:-1]] = offsets[:-1]
    edge[-1] = offsets[-1]
    length = np.maximum(1, np.diff(edge)).astype(np.float32)
    columns = [np.log1p(size) / 4, np.log1p(length) / 6]
    for k in range(_CLASSES.shape[1]):
        run = np.concatenate([[0], np.cumsum(_CLASSES[data, k], dtype=np.float64)])
        columns.append(((run[edge[1:]] - run[edge[:-1]]) / length).astype(np.float32))
    same = np.zeros(len(data) + 1)
    if len(data) > 1:
        same[2:] = np.cumsum((data[1:] == data[:-1]) & (_CLASSES[data[1:], 6] > 0))
    columns.append(((same[edge[1:]] - same[edge[:-1]]) / length).astype(np.float32))
    per = np.maximum(1, size)
    long_word = np.bincount(of, weights=(w.ends - w.starts), minlength=total) / per
    again = np.zeros(len(w.hashes))
    if len(again) > 1:
        again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (of[1:] == of[:-1])
    key = np.unique(of.astype(np.uint64) * np.uint64(1 << 32) + (w.hashes >> np.uint64(32)))
    kinds = np.bincount((key >> np.uint64(32)).astype(np.int64), minlength=total)
    columns += [np.log1p(long_word) / 3, np.bincount(of, weights=again, minlength=total) / per, kinds / per]
    last = data[np.maximum(w.ends - 1, 0)] if len(w.ends) else np.empty(0, np.uint8)
    begin = data[w.starts] if len(w.starts) else last
    columns.append(np.bincount(of, weights=_CLASSES[last, 6], minlength=total) / per)
    columns.append(np.bincount(of, weights=_CLASSES[begin, 0], minlength=total) / per)
    style = np.stack([np.asarray(c, np.float32) for c in columns], 1)
    slot = (mix(w.hashes) & np.uint64(HASHED - 1)).astype(np.int64)
    sign = np.where(w.hashes & np.uint64(1), 1.0, -1.0)
    bag = np.bincount(of * HASHED + slot, weights=sign, minlength=total * HASHED).reshape(total, HASHED) / np.sqrt(per)[:, None]
    return np.concatenate([style, bag.astype(np.float32)], 1), first


def _per_group(f, x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return f.reduceat(x, first[:-1], axis=0)


@dataclass
class Network:
    """Gated attention over passages: weights, and the scaling of the features."""

    centre: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def empty(n_features: int, hidden: int = 16, code: int = 24, seed: int = 7) -> "Network":
        r = np.random.default_rng(seed)
        draw = lambda a, b: r.normal(0, 1 / np.sqrt(a), (a, b))
        return Network(np.zeros(n_features), np.ones(n_features), {
            "E": draw(n_features, code), "e": np.zeros(code), "V": draw(code, hidden), "U": draw(code, hidden), "a": draw(hidden, 1)[:, 0],
            "o": draw(code, 1)[:, 0] * 0.1, "b": np.zeros(1)})

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        p, n = self.weights, np.diff(first)
        x = np.clip((x - self.centre) / self.scale, -8, 8)
        h = np.tanh(x @ p["E"] + p["e"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (v * u) @ p["a"]
        s = np.exp(s - np.repeat(_per_group(np.maximum, s, first), n))
        attention = s / np.repeat(_per_group(np.add, s, first), n)
        z = _per_group(np.add, attention[:, None] * h, first)
        score = 1 / (1 + np.exp(-np.clip(z @ p["o"] + p["b"][0], -30, 30)))
        return x, h, v, u, attention, z, score

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward(x, first)[-1]

    def gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.weights, np.diff(first)
        x, h, v, u, attention, z, score = self.forward(x, first)
        d = importance * (score - y)
        g = {"o": z.T @ d, "b": np.array([d.sum()])}
        dz = np.repeat(d[:, None] * p["o"], n, axis=0)  # per passage: how its document's code moves the loss
        dh = attention[:, None] * dz
        da = (h * dz).sum(1)
        ds = attention * (da - np.repeat(_per_group(np.add, attention * da, first), n))
        g["a"] = (v * u).T @ ds
        dv, du = ds[:, None] * p["a"] * u * (1 - v * v), ds[:, None] * p["a"] * v * u * (1 - u)
        g["V"], g["U"] = h.T @ dv, h.T @ du
        dh = (dh + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
        g["E"], g["e"] = x.T @ dh, dh.sum(0)
        return g


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 5e-3, decay: float = 1e-4, seed: int = 11) -> Network:
    """Adam on the log loss; both labels weigh the same in total only as far as a factor of 3."""
    net = Network.empty(x.shape[1])
    if not len(y):
        net.weights["o"][:] = 0
        return net
    net.centre, net.scale = x.mean(0), x.std(0) + 1e-3
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    ratio = np.clip((1 - share) / share, 1 / 3, 3)
    importance = np.where(y > 0.5, np.sqrt(ratio), 1 / np.sqrt(ratio))
    r, moment, square, step = np.random.default_rng(seed), {}, {}, 0
    for epoch in range(epochs):
        order = r.permutation(len(y))
        for s in range(0, len(y), batch):
            pick = np.sort(order[s:s + batch])
            n = np.diff(first)[pick]
            begin = np.concatenate([[0], np.cumsum(n)])
            rows = np.arange(begin[-1]) - np.repeat(begin[:-1], n) + np.repeat(first[pick], n)
            g = net.gradient(x[rows], begin, y[pick], importance[pick] / len(pick))
            step += 1
            for k, d in g.items():
                d = d + decay * net.weights[k]
                moment[k] = 0.9 * moment.get(k, 0) + 0.1 * d
                square[k] = 0.999 * square.get(k, 0) + 0.001 * d * d
                net.weights[k] = net.weights[k] - rate * (0.5 if epoch > epochs // 2 else 1) * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return net


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label_col: str = "quality") -> Network:
    """Fit on the labelled documents outside the held-out fold, at most ``sample`` of them."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg(label_col) >= 0.5).cast("double").alias("y"))
    # labels without a document take no place in the sample
    known = known.join(docs.select(F.col("doc_id").alias("id")).distinct(), F.col("doc_id") == F.col("id"), "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumnRenamed("doc_id", "id")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in pieces(b):
                x, first = encode(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(lo, hi - lo) for c in ("doc_id", "y")] + [pa.array([x[s:e].astype(np.float16).tobytes() for s, e in zip(first[:-1], first[1:])], pa.binary()),
                                                                                pa.array(np.diff(first).astype(np.int64))], ["doc_id", "y", "x", "passages"])

    # at most ``sample`` ids: small enough to send to every task, so no text moves
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "y", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    bags = rows.mapInArrow(encoded, f"doc_id {kind}, y double, x binary, passages long").where(F.col("passages") <= LONGEST)
    bags = bags.groupBy("doc_id").agg(F.min(F.struct("x", "y", "passages")).alias("bag")).select("doc_id", "bag.*")
    bags = saved(bags, "sample")
    # one window over at most ``sample`` small rows
    so_far = F.sum("passages").over(W.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, 0))
    fits = bags.select(F.col("doc_id").alias("id"), so_far.alias("so_far")).where(F.col("so_far") <= SAMPLE_PASSAGES)
    got = bags.join(F.broadcast(fits), F.col("doc_id") == F.col("id"), "left_semi").select("doc_id", "x", "y").toArrow().sort_by("doc_id")
    width = encode(*text_bytes(pa.array([""])))[0].shape[1]
    bags = [np.frombuffer(v.as_buffer(), np.float16).reshape(-1, width) for v in got.column("x")]
    x = np.concatenate(bags).astype(np.float64) if bags else np.empty((0, width))
    return fit(x, np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64), got.column("y").to_numpy())


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [np.empty(0)]
            for _, _, data, offsets in pieces(b):
                scores.append(network.score(*encode(data, offsets)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.concatenate(scores))], ["doc_id", "score"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, cut: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    ship(docs.sparkSession)
    scored = score(docs, train(docs, labels, sample))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    ship(docs.sparkSession)
    network = train(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = np.concatenate([np.empty(0), *(network.score(*encode(data, offsets)) for _, _, data, offsets in pieces(b))])
            yield b.filter(pa.array(scores >= cut))

    return docs.mapInArrow(run, docs.schema)
