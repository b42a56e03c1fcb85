"""Rows of one id, and labels without documents, in the pipeline's stages."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from pricepanel.llm import quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_rows_of_one_id_are_mixed_each(spark, tmp_path):
    rows = [(1, "a b c d", "en", "s", 7), (1, "a b c d", "en", "s", 7), (1, "w " * 300, "en", "t", 600), (None, "x y", "en", None, 3), (None, "x y z", "en", "s", 5),
            (2, None, "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS)
    df.repartition(3).write.parquet(str(tmp_path / "d"))
    stored = corpus_pipeline.mixed(spark, spark.read.parquet(str(tmp_path / "d")), "").collect()
    made = corpus_pipeline.mixed(spark, df, "").collect()
    key = lambda r: (r.doc_id or 0, r.text or "", r.source or "")
    assert sorted(map(key, stored)) == sorted(map(key, made)) and stored[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars", "target", "taken"]
    for r in stored:
        assert 0 < r.taken <= 2 * len(r.text.split())
    total = sum(len((r[1] or "").split()) for r in rows)
    assert sum(r.taken for r in stored) <= 1.5 * total


def test_labels_without_documents_take_no_place_in_the_sample(spark, monkeypatch):
    r = np.random.default_rng(1)
    rows = [(i, "##$$ %% buy now !!! " * 20 if i % 2 else " ".join(r.choice(["plain", "words", "of", "a", "text"], 80)), "en", "s", 1) for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)], "doc_id long, quality int")
    others = spark.createDataFrame([(i, i % 2) for i in range(1000, 9000)], "doc_id long, quality int")
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, first, y, **k: seen.append((x, first, y)) or fit(x, first, y, **k))
    alone = quality.train(docs, labels, sample=60)
    beside = quality.train(docs, labels.unionByName(others), sample=60)
    assert len(seen[0][2]) == len(seen[1][2]) == 60 and all((a == b).all() for a, b in zip(seen[0], seen[1]))
    assert all((alone.weights[k] == beside.weights[k]).all() for k in alone.weights)
    got = {x.doc_id: x.predicted for x in quality.classify(docs, labels.unionByName(others)).select("doc_id", F.col("predicted")).collect()}
    assert np.mean([got[i] == 1 - i % 2 for i in range(120)]) > 0.95


def test_shards_of_items_change_nothing(spark, monkeypatch):
    from pricepanel.llm import decontaminate

    r = np.random.default_rng(3)
    names = np.array([f"w{i}" for i in range(300)])
    texts = [" ".join(r.choice(names, int(r.integers(12, 60)))) for _ in range(60)]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[0]) for i in range(40)] + [(200, None), (201, " -- ")], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join([*r.choice(names, 100), texts[i % 60], *r.choice(names, 80)]), "en", "s", 1) for i in range(90)], DOCS)
    total = sum(map(len, texts))
    found = []
    for size in (1 << 20, total // 7):
        monkeypatch.setattr(decontaminate, "SHARD_BYTES", size)
        assert len(list(decontaminate.indexes(decontaminate.prepared(items), 0.6))) == (1 if size > total else 8)
        found.append(sorted(map(tuple, decontaminate.find(docs, items).collect())))
    assert found[0] == found[1] and {(d, i) for d, i, *_ in found[0]} >= {(d, d % 60) for d in range(90)} | {(60, 100 + i) for i in range(40)}
    assert decontaminate.clean(docs, items).count() == 0
