"""Operators over the whole corpus, against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np

from pricepanel.llm import ann, decontaminate, mixing, neardup, ngram_lm, quality
from tests.llm.test_texts import docs, plain_words


def prose(r, n):
    return " ".join(r.choice(["the", "of", "and"]) if r.random() < 0.3 else f"w{r.randint(0, 5000)}" for _ in range(n))


def shingle_set(t, k):
    w = plain_words(t)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def plain_components(rows, k=4):
    s, up = [shingle_set(t, k) for _, t, _ in rows], list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    least = {}
    for i, (d, _, _) in enumerate(rows):
        least[top(i)] = min(d, least.get(top(i), d))
    return sorted((d, len(s[i]), least[top(i)]) for i, (d, _, _) in enumerate(rows))


def test_near_duplicates(spark):
    r = random.Random(2)
    rows = [(1000 + i, t, "s") for i, t in enumerate([None, "", " ", "a B c", "A b  C", "a b", "w " * 50_000])]
    for f in range(4):  # families of edited copies, at and below the limit
        base = prose(r, 80).split()
        for i in range(25):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(80)] = f"e{r.randint(0, 30)}"
            rows.append((f * 100 + i, " ".join(w), "s"))
    rows += [(500 + i, prose(r, 60), "s") for i in range(30)] + [(700 + i, rows[10][1], "t") for i in range(5)]
    got = neardup.near_duplicates(docs(spark, rows)).collect()
    assert sorted((g.doc_id, g.n_shingles, g.component_id) for g in got) == plain_components(rows)
    assert all(g.kept == (g.doc_id == g.component_id) for g in got)
    kept = sorted(x.doc_id for x in neardup.keep_one(docs(spark, rows), k=4).collect())
    assert kept == sorted({c for _, _, c in plain_components(rows)})
    assert neardup.near_duplicates(docs(spark, [])).count() == 0


def test_repeated_ids_keep_one_row(spark):
    t = prose(random.Random(1), 50)
    out = neardup.keep_one(docs(spark, [(1, t, "a"), (1, t, "a"), (1, t + " more", "a"), (None, "other words here now", "b")])).collect()
    assert len(out) == 2


def test_super_minhash_estimates_similarity():
    r = np.random.default_rng(0)
    a = r.integers(1, 2**63, 400, dtype=np.uint64)
    b = np.concatenate([a[:300], r.integers(1, 2**63, 100, dtype=np.uint64)])
    s = neardup.super_minhash(np.concatenate([a, b, a[:3]]), np.array([0, 400, 800, 800, 803]), 160)
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.12 and np.isinf(s[2]).all() and np.isfinite(s[3]).all()
    # every place is filled, each step of an element at another place
    assert sorted(np.floor(neardup.super_minhash(a[:1], np.array([0, 1]), 40))[0].tolist()) == list(range(40))


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] >= 2 * sizes[s]}
        if not full:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in full}
        left, free = left - sum(2 * sizes[s] for s in full), free - full
    return target


def test_fair_mix(spark):
    r = random.Random(4)
    rows = [(i, "w " * (r.choice([0, 5, 50, 3000]) if r.random() < 0.05 else r.randint(0, 80)), r.choice(["b", "a", None, "hot", "hot", "hot", "z"])) for i in range(600)]
    rows += [(3, "twice the row", "a")] * 2 + [(900, None, "only")]
    got = mixing.mix(docs(spark, rows)).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    goal, taken = plain_targets(sizes), collections.Counter()
    assert sorted((g.doc_id, g.size) for g in got) == sorted((i, len((t or "").split())) for i, t, _ in rows)
    for g in got:
        assert math.isclose(g.target, goal[g.source], rel_tol=1e-9, abs_tol=1e-9) and g.source_size == sizes[g.source] and 0 <= g.taken <= 2 * g.size
        taken[g.source] += g.taken
    assert all(abs(taken[s] - goal[s]) <= 300 for s in sizes) and abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs(spark, rows)).repartition(3).collect()))
    assert mixing.mix(docs(spark, [])).count() == 0


def test_fair_mix_of_a_hot_source_with_a_small_weight(spark):
    """Every word of every document, against one sorted line of all packets."""
    r = random.Random(14)
    rows = [(i, "w " * r.randint(0, 700), "s00b" if r.random() < 0.25 else f"s{r.randint(0, 30):02}") for i in range(1500)]
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    goal, line, at, size = plain_targets(sizes), [], collections.Counter(), {}
    assert goal["s00b"] < sizes["s00b"] / 2  # most of its packets finish long after the cut
    for i, t, s in sorted(rows, key=lambda x: hashlib.md5(str(x[0]).encode()).hexdigest()):
        n = size[i] = len(t.split())
        for copy in (0, 1):
            for p in range(0, n, 256):
                w = min(256, n - p)
                line.append(((copy * sizes[s] + at[s] + p + w) / goal[s], s, i, w))
        at[s] += n
    left, want = int(1.5 * sum(sizes.values())), collections.Counter()
    for _, _, i, w in sorted(line):
        want[i] += min(w, left)
        left -= min(w, left)
    got = {g.doc_id: g.taken for g in mixing.mix(docs(spark, rows)).collect()}
    assert got == {i: want[i] for i in size}


def test_decontamination(spark):
    r = random.Random(6)
    items = [(i, prose(r, n)) for i, n in enumerate([6, 15, 38, 59, 300, 2])] + [(90, None), (91, "")]
    rows = [(i, prose(r, 300) + " " + t.upper() + ", " + prose(r, 200), "s") for i, t in items if t]
    rows += [(50, items[3][1][:120], "s"), (51, None, "s"), (52, "", "s"), (53, prose(r, 20_000), "s"), (54, items[2][1], "s"), (54, items[2][1], "s")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.find(docs(spark, rows), bench).collect()
    assert {(g.doc_id, g.item_id) for g in got if g.item_id != 5} == {(i, i) for i in range(5)} | {(54, 2)}
    assert sum(g.doc_id == 54 for g in got) == 2
    kept = [x.doc_id for x in decontaminate.clean(docs(spark, rows), bench.where("item_id != 5")).collect()]
    assert sorted(kept) == [5, 50, 51, 52, 53]
    assert decontaminate.find(docs(spark, rows), bench.limit(0)).count() == 0 and decontaminate.find(docs(spark, []), bench).count() == 0


def test_pruning_loses_nothing():
    import pyarrow as pa

    from pricepanel.llm.words import text_bytes, words
    r = random.Random(8)
    items = [prose(r, r.randint(5, 60)) for _ in range(40)]
    index = decontaminate.build_index(np.arange(40), pa.array(items), 0.15)
    w = words(*text_bytes(pa.array([prose(r, 500) + " " + items[3] for _ in range(3)])), trimmed=True)
    got = {(d, p, i): s for d, p, i, s in zip(*(x.tolist() for x in decontaminate.candidates(w, index)))}
    want = {}
    for d in range(3):
        h = w.hashes[w.first[d]:w.first[d + 1]]
        for p in range(0, len(h) + decontaminate.HALF, decontaminate.HALF):
            t = np.flatnonzero(np.isin(index.terms, h[p:p + decontaminate.PASSAGE]))
            score = np.zeros(40)
            for x in t:
                score[index.items[index.first[x]:index.first[x + 1]]] += index.impacts[index.first[x]:index.first[x + 1]]
            want |= {(d, p, i): score[i] for i in np.flatnonzero(score >= index.thresholds).tolist()}
    assert got.keys() >= {k for k in want if want[k] > index.thresholds[k[2]] + 1e-9} and got.keys() <= want.keys()
    assert len(want) > 3


def test_quality(spark):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        t = prose(r, 200)
        if bad:  # only a part of the text is bad
            t = t + " " + " ".join(f"{x.upper()}!!" for x in prose(r, 80).split())
        rows.append((i, t, "s"))
        labels.append((i, 0 if bad else 1, 0))
    rows += [(900, None, "s"), (901, "", "s"), (901, "x " * 100_000, "s")]
    lab = spark.createDataFrame(labels + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs(spark, rows), lab).collect()
    assert len(got) == len(rows) and all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.3) for g in got)
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) for g in got)
    truth = {i: q for i, q, _ in labels}
    held = [g for g in got if g.held_out and g.doc_id in truth]
    assert np.mean([g.predicted == truth[g.doc_id] for g in held]) > 0.95
    assert quality.classify(docs(spark, rows[:5]), lab.limit(0)).count() == 5 and quality.classify(docs(spark, []), lab).count() == 0
    assert quality.keep_good(docs(spark, rows), lab).columns == docs(spark, []).columns


def test_quality_gradient():
    r = np.random.default_rng(1)
    x, first, y, w = r.normal(size=(9, 5)), np.array([0, 2, 3, 9]), np.array([1.0, 0, 1]), np.array([0.5, 1, 2])
    net = quality.Network.empty(5)

    def loss():
        p = net.score(x, first)
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    g = net.gradient(x, first, y, w)
    for k, v in net.weights.items():
        i = tuple(0 for _ in v.shape)
        v[i] += 1e-5
        up = loss()
        v[i] -= 2e-5
        assert abs((up - loss()) / 2e-5 - g[k][i]) < 1e-5
        v[i] += 1e-5


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, label int, key string, score string")


def test_nearest(spark):
    r = np.random.default_rng(9)
    rows = [(i, r.normal(size=24).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[7][1]) for i in range(100)]  # a group of copies
    rows += [(3000, None), (3020, [0.0] * 24), (3040, [float("nan")] * 24), (3060, [None] + [1.0] * 23), (3080, [1.0]), (None, rows[0][1])]
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and len(v) == 24 and None not in v and np.isfinite(v).all() and any(v)]
    ids, x = np.array([g[0] for g in good]), np.stack([g[1] for g in good])
    got = collections.defaultdict(list)
    for g in ann.search(vectors(spark, rows)).orderBy("query_id", "rank").collect():
        got[g.query_id].append((g.rank, g.vec_id, g.score))
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        s = (x * x[ids == q][0]).sum(1)
        order = [int(ids[j]) for j in np.lexsort((ids, -s)) if ids[j] != q][:20]
        assert [f[0] for f in found] == list(range(1, 21)) and all(math.isclose(sc, s[ids == v][0], rel_tol=1e-12, abs_tol=1e-12) for _, v, sc in found)
        assert [f[1:] for f in found] == sorted((f[1:] for f in found), key=lambda f: (-f[1], f[0]))
        hits += len(set(order) & {f[1] for f in found})
    assert hits / (20 * len(got)) >= 0.9
    few = ann.search(vectors(spark, rows[:5])).collect()
    assert sorted((g.query_id, g.vec_id) for g in few) == [(0, i) for i in range(1, 5)]
    assert ann.search(vectors(spark, [])).count() == 0


def test_tile_keeps_the_nearest_of_each_query():
    r = np.random.default_rng(4)
    y, z = r.normal(size=(300, 40)) + 50, r.normal(size=(70, 40)) + 50
    y[100:130] = y[5]  # ties are kept
    z[0] = y[5]
    d = ((z[:, None] - y) ** 2).sum(2)
    columns = [y[:, :16], y[:, 16:32], y[:, 32:]]
    for strength, least in ((1e9, 1.0), (2.1, 0.95)):
        asks, found = ann.scan_tile(z, columns, np.sort(d, 1)[:, 90], 20, strength)
        kept = set(zip(asks.tolist(), found.tolist()))
        near = {(q, c) for q in range(70) for c in np.nonzero(d[q] <= np.sort(d[q])[20])[0].tolist()}
        assert len(kept & near) >= least * len(near) and (least < 1 or kept == near)
    assert {c for q, c in near if q == 0} == {5, *range(100, 130)} <= {c for q, c in kept if q == 0}
    asks, found = ann.scan_tile(z, [c[:8] for c in columns], np.full(70, np.inf), 20, 2.1)
    assert len(found) == 70 * 8


def test_language_model(spark):
    r = random.Random(12)
    rows = [(i, prose(r, r.randint(1, 120)), "s") for i in range(300)] + [(800, None, "s"), (801, "", "s"), (802, "the of " * 30_000, "s"), (5, "twice", "s"), (5, "twice", "s")]
    got = sorted((g.doc_id, g.n_tokens, g.n_known, g.held_out, g.train_tokens, g.base_score, g.score) for g in ngram_lm.score(docs(spark, rows)).collect())
    toks = [plain_words(t) + [None] for _, t, _ in rows]
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _, _ in rows]
    c = collections.Counter(w for x, k in zip(toks, train) if k for w in x)
    b = collections.Counter(p for x, k in zip(toks, train) if k for p in zip([None] + x[:-1], x))
    n, v = sum(c.values()), len(c)
    p = lambda w: (c[w] + 1) / (n + v + 1)
    want = sorted((i, len(x), sum(c[w] > 0 for w in x), not k, n, sum(math.log10(p(w)) for w in x), sum(math.log10((b[h, w] + 4 * p(w)) / (c[h] + 4)) for h, w in zip([None] + x[:-1], x)))
                  for (i, _, _), x, k in zip(rows, toks, train))
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=0.07)
    assert ngram_lm.score(docs(spark, [])).count() == 0


def test_elias_fano_and_trie():
    r = np.random.default_rng(2)
    for values in (np.sort(r.integers(0, 2**40, 1000)), np.zeros(5, int), np.arange(10), np.empty(0, int)):
        assert ngram_lm.EliasFano(values, int(values.max(initial=0)) + 1).decode().tolist() == values.tolist()
    keys = np.unique(r.integers(0, 2**63, 2000, dtype=np.uint64) & ~np.uint64(0xFFFF << 32))
    counts = r.integers(1, 500, len(keys))
    trie = ngram_lm.Trie(keys, counts, int(counts.sum()))
    found = ngram_lm.joint(trie.find(keys), trie.total) * trie.total
    assert np.allclose(found, counts, rtol=0.13) and not trie.find(keys[:50] + np.uint64(1)).any() and trie.size < 16 * len(keys)


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(21)
    clean = [(i, prose(r, 120), f"s{i % 3}") for i in range(300)]
    bad = [(400 + i, " ".join(f"{x.upper()}!!" for x in prose(r, 100).split()), "s0") for i in range(100)]
    item = prose(r, 30)
    leak, copies = [(600, prose(r, 80) + " " + item + " " + prose(r, 40), "s1")], [(700 + i, clean[i][1] + " tail", "s2") for i in range(20)]
    secret = [(800, prose(r, 60) + " password=abcdefghijklmnop123 " + prose(r, 60), "s1")]
    frame = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in clean + bad + leak + copies + secret], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _, _ in clean] + [(i, 0, 0) for i, _, _ in bad], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage, out = frame, {}
    for name, fn in corpus_pipeline.STAGES[:-1]:
        stage = fn(spark, stage, str(tmp_path))
        assert stage.columns == frame.columns
        out[name] = {x.doc_id: x.text for x in stage.collect()}
    kept = {i for i, _, _ in clean}
    assert kept <= out["quality"].keys() and not {i for i, _, _ in bad} & out["quality"].keys()
    assert kept <= out["near duplicates"].keys() and not {i for i, _, _ in copies} & out["near duplicates"].keys()
    assert kept <= out["test items"].keys() and 600 not in out["test items"]
    assert out["secrets"].keys() == out["test items"].keys() and "[SECRET]" in out["secrets"][800]
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x.doc_id for x in mixed} <= out["secrets"].keys() and all(x.taken > 0 for x in mixed)
    assert corpus_pipeline.ORACLE_SQL is None and not re.search("limit", str(corpus_pipeline.STAGES).lower())
