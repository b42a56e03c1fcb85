"""Language-model scores from an n-gram trie in Elias-Fano code.

The corpus is cut into chunks of whole texts.  A chunk sends its distinct words and its distinct
word pairs, each once with its training count, to shards by hash; a shard adds the counts up, builds
its part of the trie, looks up every key the chunks sent, and answers each chunk with an array as
long as what it sent.  So every word and every pair travels once per chunk, however often it
occurs, a hot word is a few bytes, and no table of the corpus is sent to every task or the driver.

Trie of a shard: level one has the contexts (first words) as a monotone sequence, level two the
successors of each context, stored relative to it, with a monotone pointer sequence from each
context to its first successor; all three in Elias-Fano code (low bits as they are, high bits
unary), flat byte arrays that can be mapped from a file as they stand.  Probabilities are one
byte each: the logarithm of the pair's joint probability in steps of 2^(1/6).  A pair is found by
the place of its context and then by a successor search among the context's own.

Smoothing: p(w) = (c(w) + 1) / (N + V + 1), and p(w | h) = (c(hw) + m p(w)) / (c(h) + m) where
c(hw) comes from the quantised joint probability; the first word of a text follows the end token.

Words are known by 64-bit hashes, pairs by two 32-bit halves; a pair's place is wrong only if both
halves agree with another pair's.

Defined cases: null and empty texts have the end token only; held-out texts are scored, not
learned from; without training texts all counts are 0; repeated rows count each; rows may share
ids; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from pricepanel.llm.words import mix, pieces, split, word_hashes
from pricepanel.session import saved, ship

END = np.uint64(0x5EED0FE11D0C5EED)
CHUNK_WORDS = 800_000
#: Keys a shard is meant to hold.
SHARD_KEYS = 1_500_000
STEPS = 6  # codes per doubling
_32 = np.uint64(32)
_LOW32 = np.uint64(0xFFFFFFFF)


class EliasFano:
    """A non-decreasing sequence of numbers below 2^63: low bits plain, high bits unary."""

    def __init__(self, values: np.ndarray, universe: int) -> None:
        n = len(values)
        self.n, self.shift = n, max(0, int(np.floor(np.log2(max(1, universe) / max(1, n))))) if n else 0
        v = values.astype(np.uint64)
        s = np.uint64(self.shift)
        width = -(-self.shift // 8)  # whole bytes, so that a place is found by its number
        low = v & ((np.uint64(1) << s) - np.uint64(1))
        self.low = low.view(np.uint8).reshape(n, 8)[:, :width].copy() if n else np.empty((0, width), np.uint8)
        high = (v >> s).astype(np.int64)
        ones = high + np.arange(n)
        self.bits = np.packbits(np.bincount(ones, minlength=1).astype(bool), bitorder="little") if n else np.empty(0, np.uint8)

    @property
    def size(self) -> int:
        return self.low.nbytes + self.bits.nbytes

    def decode(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.bits, bitorder="little"))[:self.n]
        full = np.zeros((self.n, 8), np.uint8)
        full[:, :self.low.shape[1]] = self.low
        return (((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.shift)) | full.view(np.uint64)[:, 0])


class Trie:
    """Contexts, pointers, successors and quantised joint probabilities of word pairs."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, total: int) -> None:
        context = keys >> _32
        new = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(keys) else np.empty(0, np.int64)
        self.contexts = EliasFano(context[new], 1 << 32)
        self.pointers = EliasFano(np.r_[new, len(keys)], len(keys) + 1)
        rank = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(keys)])).astype(np.uint64)
        self.successors = EliasFano((rank << _32) | (keys & _LOW32), max(1, len(new)) << 32)  # relative to the context's number
        self.codes = quantise(counts, total)
        self.total = total

    @property
    def size(self) -> int:
        return self.contexts.size + self.pointers.size + self.successors.size + self.codes.nbytes

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The code of each of some sorted keys, 0 where it is not in the trie."""
        out = np.zeros(len(keys), np.uint8)
        if not len(self.codes):
            return out
        contexts, pointers, successors = self.contexts.decode(), self.pointers.decode().astype(np.int64), self.successors.decode()
        at = np.minimum(np.searchsorted(contexts, keys >> _32), len(contexts) - 1)
        known = contexts[at] == keys >> _32
        want = (at.astype(np.uint64) << _32) | (keys & _LOW32)
        place = np.searchsorted(successors, want)  # the first successor not below
        inside = known & (place < pointers[at + 1])
        place = np.minimum(place, len(successors) - 1)
        hit = inside & (successors[place] == want)
        out[hit] = self.codes[place[hit]]
        return out


def quantise(counts: np.ndarray, total: int) -> np.ndarray:
    """A byte for log2(count / total); 0 is none.  Code 255 is the largest probability."""
    c = np.maximum(counts, 0).astype(np.float64)
    top = np.log2(max(1, total))
    steps = 254 / max(top, 254 / STEPS)
    code = np.where(c > 0, 255 - np.minimum(254, np.round((top - np.log2(np.maximum(c, 1))) * steps)), 0)
    return code.astype(np.uint8)


def joint(codes: np.ndarray, total: int) -> np.ndarray:
    """Joint probabilities for codes."""
    top = np.log2(max(1, total))
    steps = 254 / max(top, 254 / STEPS)
    return np.where(codes > 0, 2.0 ** ((codes.astype(np.float64) - 255) / steps), 0)


def trains(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 != 2, F.lit(True))


_PARTS = "chunk string, shard long, words binary, word_counts binary, pairs binary, pair_counts binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in chunks of about ``CHUNK_WORDS`` words, compressed: read twice, as text is smaller
    than the numbers of its words.  ``learned``: tokens of the training texts."""
    task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

    def out() -> pa.RecordBatch:
        ids, trains, lengths, data, counts = zip(*held)
        trains, lengths, data, counts = (np.concatenate(x) for x in (trains, lengths, data, counts))
        ids = pa.concat_arrays(ids)
        one = {"chunk": pa.array([f"{task}-{number}"]), "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)}
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        packed = pa.compress(data.tobytes(), codec="zstd", asbytes=True)
        one |= {k: pa.array([x], pa.binary()) for k, x in (("trains", trains.tobytes()), ("offsets", offsets.tobytes()), ("texts", packed))}
        one |= {"size": pa.array([len(data)], pa.int64()), "learned": pa.array([int((counts + 1)[trains].sum())], pa.int64())}
        return pa.RecordBatch.from_pydict(one)

    for b in batches:
        for lo, hi, data, offsets in pieces(b):
            part = b.slice(lo, hi - lo)
            held.append((part.column("doc_id"), part.column("trains").to_numpy(zero_copy_only=False), np.diff(offsets), data, np.diff(split(data, offsets)[2])))
            size += len(data)
            if size >= 6 * CHUNK_WORDS:
                yield out()
                number, held, size = number + 1, [], 0
    if held:
        yield out()


class Chunk:
    """The distinct words and pairs of a chunk, both by mixed hash, and where its tokens are in
    them."""

    def __init__(self, trains: bytes, offsets: bytes, texts: bytes, size: int) -> None:
        self.trains = np.frombuffer(trains, bool)
        data = np.frombuffer(pa.decompress(texts, decompressed_size=size, codec="zstd", asbytes=True), np.uint8) if size else np.empty(0, np.uint8)
        hashes, counts = word_hashes(data, np.frombuffer(offsets, np.int64))
        n = counts + 1  # and the end token
        self.first = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        last = self.first[1:] - 1
        w = np.empty(self.first[-1], np.uint64)
        inside = np.ones(len(w), bool)
        inside[last] = False
        w[inside], w[last] = hashes, END
        before = np.empty_like(w)
        before[1:] = w[:-1]
        before[self.first[:-1]] = END
        # dealt and sorted by all bits of a key, so that no context is hot
        self.words, self.of_word = np.unique(mix(w), return_inverse=True)
        self.word = np.empty_like(self.words)
        self.word[self.of_word] = w
        pair = (mix(before) & ~_LOW32) | (mix(w) >> _32)
        self.pairs, self.of_pair = np.unique(mix(pair), return_inverse=True)
        self.pair = np.empty_like(self.pairs)
        self.pair[self.of_pair] = pair
        learns = np.repeat(self.trains, n)
        self.word_counts = np.bincount(self.of_word[learns], minlength=len(self.words)).astype(np.uint32)
        self.pair_counts = np.bincount(self.of_pair[learns], minlength=len(self.pairs)).astype(np.uint32)


def _of(table) -> Iterator[tuple[str, Chunk]]:
    for r in table.select(["chunk", "trains", "offsets", "texts", "size"]).to_pylist():
        yield r["chunk"], Chunk(r["trains"], r["offsets"], r["texts"], r["size"])


def _cut(chunks: DataFrame, shards: int) -> DataFrame:
    """A row per chunk and shard with the keys the chunk sends there, if any: never more rows than
    keys, however many chunks and shards there are."""
    edges = (np.arange(1, shards, dtype=np.float64) * (2.0**64 / shards)).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                for name, c in _of(b.slice(i, 1)):
                    of_word, of_pair = (np.searchsorted(edges, x, "right") for x in (c.words, c.pairs))
                    used = np.union1d(of_word, of_pair)
                    wc, pc = ((np.searchsorted(x, used, "left"), np.searchsorted(x, used, "right")) for x in (of_word, of_pair))
                    cells = lambda x, at: pa.array([x[s:e].tobytes() for s, e in zip(*at)], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(used)), pa.array(used), cells(c.word, wc), cells(c.word_counts, wc), cells(c.pair, pc), cells(c.pair_counts, pc)],
                        [x.split()[0] for x in _PARTS.split(", ")])

    return chunks.mapInArrow(run, _PARTS)


def _merge(blobs: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in blobs])
    n = np.concatenate([np.frombuffer(x, np.uint32) for x in counts]).astype(np.float64)
    kinds, inverse = np.unique(keys, return_inverse=True)
    return kinds, np.bincount(inverse, weights=n, minlength=len(kinds)).astype(np.int64)


def _answer(total: int):
    """Of one shard: the trie from what all chunks sent, and the answer to each chunk."""

    def run(table: pa.Table) -> pa.Table:
        col = lambda c: [x or b"" for x in table.column(c).to_pylist()]
        sent_words, sent_pairs = col("words"), col("pairs")
        kinds, counts = _merge(sent_words, col("word_counts"))
        pairs, pair_counts = _merge(sent_pairs, col("pair_counts"))
        trie = Trie(pairs[pair_counts > 0], pair_counts[pair_counts > 0], total)
        codes = trie.find(pairs)
        word_answers = [counts[np.searchsorted(kinds, np.frombuffer(x, np.uint64))].astype(np.uint32).tobytes() for x in sent_words]
        pair_answers = [codes[np.searchsorted(pairs, np.frombuffer(x, np.uint64))].tobytes() for x in sent_pairs]
        return pa.table({"chunk": table.column("chunk"), "shard": table.column("shard"), "word_answer": pa.array(word_answers, pa.binary()),
                         "pair_answer": pa.array(pair_answers, pa.binary()), "known": pa.array([int((counts > 0).sum())] * len(sent_words), pa.int64())})

    return run


def _sum_up(total: int, kinds: int, weight: float):
    """Of one chunk: the scores of its texts from all answers."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("shard").to_numpy())
        pick = lambda c: [answers.column(c)[int(i)].as_py() or b"" for i in order]
        count = np.frombuffer(b"".join(pick("word_answer")), np.uint32).astype(np.float64)
        code = np.frombuffer(b"".join(pick("pair_answer")), np.uint8)
        ((_, t),) = _of(chunk)
        first = t.first
        c = count[t.of_word]
        p = (c + 1) / (total + kinds + 1)
        end = c[first[1:] - 1]  # the end token follows every text: its count is the first word's context's
        before = np.empty_like(c)
        before[1:] = c[:-1]
        before[first[:-1]] = end
        both = joint(code, total)[t.of_pair] * total
        both = np.minimum(both, before)
        full = (both + weight * p) / (before + weight)
        add = lambda x: np.add.reduceat(x, first[:-1])
        ids = chunk.column("ids").combine_chunks().flatten()
        return pa.table({"doc_id": ids, "held_out": ~t.trains, "n_tokens": np.diff(first), "n_known": add((c > 0).astype(np.int64)), "base_score": add(np.log10(p)), "score": add(np.log10(full))})

    return run


def score(docs: DataFrame, weight: float = 4.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per text.

    ``weight``: how many observations the unigram estimate counts for (m).
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), trains(F.col(id_col)).alias("trains"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    # the texts are read once; all that follows starts from the stored chunks
    chunks = saved(src.mapInArrow(_chunks, f"chunk string, ids array<{kind}>, trains binary, offsets binary, texts binary, size long, learned long"), "lm-chunks")
    size, learned = chunks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("size", "learned")]).first()
    shards = int(max(1, -(-size // (6 * SHARD_KEYS))))
    answers = saved(_cut(chunks, shards).groupBy("shard").applyInArrow(
        _answer(learned), "chunk string, shard long, word_answer binary, pair_answer binary, known long"), "lm-answers")
    kinds = answers.groupBy("shard").agg(F.max("known").alias("known")).agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    scores = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _sum_up(learned, kinds, weight), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(learned).cast("long").alias("train_tokens"), "base_score", "score")
