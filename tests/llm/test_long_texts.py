"""One text with very many matches, one conversation with very many turns."""

import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricepanel.llm import arrays, chat, privacy, secrets

MANY = 50_000


@pytest.mark.parametrize("n", [0, 1, 2, arrays.BLOCK, arrays.BLOCK + 1, 5 * arrays.BLOCK + 7])
def test_sums_before_each_element(spark, n):
    lengths = np.random.default_rng(n).integers(0, 9, n).tolist()
    got = spark.createDataFrame([(lengths,)], "a array<bigint>").select(arrays.starts(F.col("a"))).first()[0]
    assert got == [sum(lengths[:i]) for i in range(n)]


def test_many_hex_runs(spark):
    text = " ".join(f"{i:016x}" for i in range(MANY))
    df = spark.createDataFrame([(1, text), (2, "x"), (3, None)], "doc_id long, text string").select(
        "doc_id", F.size(secrets.candidates(F.coalesce("text", F.lit("")))).alias("n"), F.expr("1").alias("one"))
    t = time.time()
    assert {r.doc_id: r.n for r in df.collect()} == {1: MANY, 2: 0, 3: 0}
    assert time.time() - t < 40
    found = spark.createDataFrame([(text,)], "text string").select(secrets.located(F.col("text"), "[0-9a-f]{16}").alias("m")).first()["m"]
    assert [m["at"] for m in found[:3]] == [0, 17, 34] and found[-1]["at"] == 17 * (MANY - 1) and found[-1]["hit"] == f"{MANY - 1:016x}"


def test_many_turns(spark):
    rows = spark.range(MANY).select(F.lit(5).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                    F.concat(F.lit("é[INST] "), "id").alias("text"))
    t = time.time()
    got = chat.report(chat.format_conversations(rows)).collect()
    assert time.time() - t < 60
    said = "".join(f"é[INST] {i}" for i in range(1, MANY, 2))
    assert [(r.n_turns, r.loss_chars) for r in got] == [(MANY, len(said))]
    import hashlib

    assert got[0].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_many_addresses():
    text = " ".join(f"word{i % 7} a{i}@example.org" for i in range(MANY))
    t = time.time()
    spans = privacy.base_spans(text)
    rows = privacy._neighbours(text, spans)
    assert len(spans) == MANY and time.time() - t < 20
    few = text[:2000]
    spans = privacy.base_spans(few)
    want = []
    for s, k, e in spans:
        w = [x for x in privacy._near(few, s, e) if not any(x[0] < q and p < x[1] for p, _, q in spans)]
        want += [(few[s:e], h) for h in privacy.hash_words([few[p:q] for p, q in w]).tolist()] if w else []
    assert [(r["value"], r["term"]) for r in privacy._neighbours(few, spans)] == want and len(rows) > MANY


def test_pairs_of_texts_whichever_way(spark):
    r = np.random.default_rng(4)
    held = {(int(t), int(x)) for t, x in zip(r.integers(0, 40, 600), r.integers(0, 20, 600))}
    holding = {(int(x), int(e)) for x, e in zip(r.integers(0, 20, 300), r.integers(0, 50, 300))} | {(7, e) for e in range(50)}
    pairs = {(int(e), int(t)) for e, t in zip(r.integers(0, 50, 120), r.integers(0, 40, 120))} | {(3, t) for t in range(40)}
    frame = lambda rows, names: spark.createDataFrame(sorted(rows), names)
    got = Counter(tuple(x) for x in privacy.pairs_held(frame(held, "term long, text_key long"), frame(holding, "text_key long, entity long"),
                                                       frame(pairs, "entity long, term long")).collect())
    for e, t in pairs:
        assert got[e, t] == len({x for term, x in held if term == t} & {x for x, entity in holding if entity == e}), (e, t)
