"""Importance resampling and lexical search against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pricepanel.llm import crc, importance, lexical

DOCS = "doc_id long, text string, score string, row string, rank string, weight string, item string, shard string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", "v", "u", "t") for i, t in rows], DOCS)


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, score string")


def some_texts(n, seed=5):
    r = np.random.default_rng(seed)
    names = [f"Wort{i}" for i in range(60)] + ["ÜBER", "naïve", "x1", "a", "B"]
    p = 1 / np.arange(1, len(names) + 1)
    texts = [", ".join(r.choice(names, int(r.integers(1, 90)), p=p / p.sum())) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)]


ODD = [(1000, None), (1001, ""), (1002, " -- !"), (None, "a b wort1 " * 30), (None, None), (7, "again and again " * 20), (7, "again and again " * 20),
       (1003, "w" * 5000 + " wort1 " + "é" * 3000), (1004, "long wort2 text " * 100_000)]


def test_checksums_of_runs():
    words = ["a", "bc", "é" * 40, "x" * 9000, "1"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    end = np.cumsum([len(w.encode()) for w in words])
    begin = np.r_[0, end[:-1]]
    raw, n = crc.raw_words(data, begin, end), end - begin
    two = crc.joined(raw[:-1], raw[1:], n[1:])
    three = crc.joined(two[:-1], raw[2:], n[2:])
    for got, size, k in ((raw, n, 1), (two, n[:-1] + 1 + n[1:], 2), (three, n[:-2] + 2 + n[1:-1] + n[2:], 3)):
        assert crc.finished(got, size).tolist() == [zlib.crc32(" ".join(words[i:i + k]).encode()) for i in range(len(words) - k + 1)]


def runs(text):
    w = terms(text)
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain_resample(rows, target, percent=5, least=20):
    found = [(i, *runs(t)) for i, t in rows]
    s, t = Counter(b for x in found for b in x[2]), Counter(b for x in target for b in runs(x)[1])
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10_000)]
    out = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, None])
    fit = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    for k, x in enumerate(fit[:len(fit) * percent // 100]):
        x[5] = k + 1
    return sorted(((x[0], x[1], x[2], x[3], x[5]) for x in out), key=str)


def test_resample_is_exact(spark, monkeypatch):
    monkeypatch.setattr(importance, "FEW", 60)
    monkeypatch.setattr(importance, "CHUNK", 16)
    monkeypatch.setattr(importance, "ROWS_PER_RANGE", 20)
    monkeypatch.setattr(importance, "BLOCK_WORDS", 1_000)
    rows = some_texts(300) + ODD
    target = ["wort1 wort2 wort3 naïve", None, "", "B a wort7"]
    for percent in (5, 60):
        got = importance.resample(docs(spark, rows).repartition(5), items(spark, enumerate(target)), percent)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == plain_resample(rows, target, percent)


def test_resample_of_copies_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(importance, "FEW", 60)
    monkeypatch.setattr(importance, "CHUNK", 7)
    rows = [(3, "one two three four five " * 5)] * 90 + some_texts(30)
    got = importance.resample(docs(spark, rows).repartition(4), items(spark, []), 50)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_resample(rows, [], 50)
    assert importance.resample(docs(spark, []), items(spark, [(1, "a")])).collect() == []
    few = importance.resample(docs(spark, rows[:1] + ODD[:3]), items(spark, [(1, "a")])).collect()
    assert [r["rank"] for r in few] == [None] * 4


def test_cutoff_key(spark, monkeypatch):
    monkeypatch.setattr(importance, "FEW", 30)
    monkeypatch.setattr(importance, "CHUNK", 10)
    r = np.random.default_rng(1)
    keys = sorted({(int(a), int(b), int(c), 0, k) for k, (a, b, c) in enumerate(zip(r.integers(-3, 3, 200), r.integers(0, 2, 200), r.integers(0, 9, 200)))},
                  key=lambda x: (-x[0], *x[1:]))
    frame = spark.createDataFrame(keys, "score long, no_id int, doc_id long, n_features long, row long").repartition(6)
    for wanted in (1, 77, 200):
        assert importance.cutoff(frame, wanted) == keys[wanted - 1]
    assert importance.cutoff(frame, 0) is None and importance.cutoff(frame, 201) is None


def plain_search(rows, queries, k=10):
    held = [(i, Counter(terms(t))) for i, t in rows]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(queries):
        found = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n // total
            s = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, times in Counter(terms(text)).items() if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, rank + 1, None if x[1] else x[2], -x[0]) for rank, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


QUERIES = [(1, "wort1, Wort1 über naïve"), (2, "wort9"), (3, "unknown term"), (4, None), (5, "..."), (6, "again wort2"), (6, "a B"), (1, "wort1, Wort1 über naïve"), (None, "x1 x1"),
           (8, "wort3 " * 3_000 + "a")]


@pytest.mark.parametrize("shrink", ["none", "tiles", "shards", "limit"])
def test_search_is_exact(spark, monkeypatch, shrink):
    if shrink == "tiles":
        monkeypatch.setattr(lexical, "TILE_ITEMS", 2)
        monkeypatch.setattr(lexical, "TILE_CELLS", 6)
    if shrink == "shards":
        monkeypatch.setattr(lexical, "SHARD_BYTES", 60)
    if shrink == "limit":  # partial sums must be cut: weights are up to some thousands
        monkeypatch.setattr(lexical, "EXACT", lexical.MOST_IMPACT * 9_000)
    rows = some_texts(200) + ODD + [(2000 + i, "wort9 wort9") for i in range(40)]
    got = lexical.search(docs(spark, rows).repartition(4), items(spark, QUERIES))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_search(rows, QUERIES)


def test_parts_of_a_tile_stay_exact():
    shard = lexical.read_shard(pa.array([1, 2]), pa.array(["a " * 900_000 + "b c", "b " * 10]))
    weight = np.array([20_000, 15_000, 9_000])[:len(shard.vocabulary)]
    parts = [cells for tile in lexical.tiles(shard, weight) for _, cells in tile.parts]
    assert len(parts) > 2 and all(cells.sum(0).max() * lexical.MOST_IMPACT < lexical.EXACT for cells in parts)
    assert sum(cells.sum() for cells in parts) == (weight[shard.term] * shard.times).sum()


def test_search_of_nothing(spark):
    assert lexical.search(docs(spark, []), items(spark, QUERIES)).collect() == []
    assert lexical.search(docs(spark, some_texts(3)), items(spark, [])).collect() == []
