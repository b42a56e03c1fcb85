"""Near duplicates by SuperMinHash, banding, verification and union of links.

Each distinct shingle walks a random permutation of the signature's places, one place per step;
in step j it offers the value j + r, and each place keeps the least value offered.  As values of
later steps are larger, a text is done as soon as the largest of its places is below the next
step: long texts need one or two steps, and no place is left to chance as with independent hashes.

Texts with the same shingle set are one class.  Classes that agree in all rows of a band meet in a
bucket.  In a bucket all are first compared with its most central member, which links a large group
of copies at a cost that grows with its size; classes that then still belong to different components
are compared with each other, unless their differences from that member rule a link out: sets that
differ from it in D and E can be similar only if D and E have much in common, and what a set
differs in alone nobody shares.  That bound leaves out the pairs of a large family of edited
copies without looking at them, and no link.  Links are confirmed on whole sets.

Chance: classes at the limit of 0.8 share no band of 32 with probability 3e-6.

Defined cases: texts without words (null too) have no shingles and stay alone; a text of fewer
words than a shingle has its word sequence as its only shingle; rows with the same text share a
component, also with the same id; a component's id is the least id of its rows; an empty table
gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricepanel.llm.filters import passes, slot_filter
from pricepanel.llm.words import distinct, mix, pieces, shingles, words
from pricepanel.session import saved, ship

BANDS, ROWS = 32, 5
_LOW32, _32 = np.uint64(0xFFFFFFFF), np.uint64(32)
_SECOND = np.uint64(0xA0761D6478BD642F)


def super_minhash(values: np.ndarray, first: np.ndarray, places: int) -> np.ndarray:
    """Signatures of sets of 64-bit hashes: one row of ``places`` numbers per set.

    Empty sets have infinities.
    """
    sets = len(first) - 1
    least = np.full(sets * places, np.inf)
    owner = np.repeat(np.arange(sets), np.diff(first))
    seed = values
    order = None
    for j in range(places):
        draw = mix(seed + np.uint64(j * 0x9E3779B97F4A7C15 % 2**64))
        pick = (j + (((draw & _LOW32) * np.uint64(places - j)) >> _32)).astype(np.int64)
        if j == 0:
            place = pick
        else:
            at = np.arange(len(order))
            place = order[at, pick].astype(np.int64)
            order[at, pick] = order[:, j]
            order[:, j] = place
        np.minimum.at(least, owner * places + place, j + (draw >> _32).astype(np.float64) / 2.0**32)
        open_sets = least.reshape(sets, places).max(axis=1) >= j + 1
        go_on = open_sets[owner]
        if not go_on.any():
            break
        if order is None:
            order = np.broadcast_to(np.arange(places, dtype=np.uint8 if places < 256 else np.int32), (int(go_on.sum()), places)).copy()
            at, k0 = np.arange(len(order)), pick[go_on]
            order[at, k0] = 0
            order[:, 0] = k0
        elif not go_on.all():
            order = order[go_on]
        seed, owner = seed[go_on], owner[go_on]
    return least.reshape(sets, places)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per set and band."""
    bits = signatures[:, :bands * rows].view(np.uint64).reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, r])
    return key


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[first[1:]] - total[first[:-1]]


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct(*shingles(words(data, offsets), k))


def fingerprints(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key, n, set_a, set_b (a 128-bit digest of the set), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in pieces(b):
                v, first = _sets(data, offsets, k)
                n = np.diff(first)
                keys = band_keys(super_minhash(v, first, bands * rows), bands, rows)
                have = n > 0
                ends = np.concatenate([[0], np.cumsum(np.where(have, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[have].ravel().view(np.int64)))
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(n.astype(np.int64)), pa.array(_sums(mix(v), first).view(np.int64)),
                     pa.array(_sums(mix(v ^ _SECOND), first).view(np.int64)), lists],
                    ["doc_id", "text_key", "n", "set_a", "set_b", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text_key", "text").mapInArrow(run, f"doc_id {kind}, text_key long, n long, set_a long, set_b long, bands array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """node, shingles: the whole sets, as sorted 64-bit hashes, of the texts in
    ``wanted(node, text_key, doc_id)``."""
    flags = slot_filter(wanted, "text_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(passes(flags, b.column("text_key").to_numpy())))
            for lo, hi, data, offsets in pieces(b):
                v, first = _sets(data, offsets, k)
                part = b.slice(lo, hi - lo)
                sets = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(v.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), sets], ["doc_id", "text_key", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = docs.select("doc_id", "text_key", "text").mapInArrow(run, f"doc_id {kind}, text_key long, shingles array<long>")
    sets = sets.withColumnRenamed("doc_id", "d").withColumnRenamed("text_key", "t")
    return (wanted.join(sets, (F.col("text_key") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")))
            .groupBy("node").agg(F.first("shingles").alias("shingles")))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose whole sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            x, y = (batch.column(c) for c in ("x", "y"))
            (xs, xo), (ys, yo) = ((c.values.to_numpy(), c.offsets.to_numpy()) for c in (x, y))
            for i in range(batch.num_rows):
                u, v = xs[xo[i]:xo[i + 1]], ys[yo[i]:yo[i + 1]]
                both = np.sort(np.concatenate([u, v]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(u) + len(v) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x, y = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


SALTS = 16


def _looked_up(rows: DataFrame, key: str, table: DataFrame, at: str, value: str) -> DataFrame:
    """``rows`` with ``value`` of the row of ``table`` whose unique ``at`` is their ``key`` (NULL if
    none).  Rows of one key are spread by their ``spread`` over some salts, and the table is asked
    once per key and salt, so that a key many rows look up is not one task."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("spread"), F.lit(SALTS)))
    asked = salted.select(F.col(key).alias("k"), F.col("salt").alias("s")).distinct()
    answers = asked.join(table.select(F.col(at).alias("t"), F.col(value).alias(value)), F.col("k") == F.col("t"), "left").drop("t")
    return salted.join(answers, (F.col(key) == F.col("k")) & (F.col("salt") == F.col("s")), "left").drop("k", "s", "salt", "spread")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component: the least node reachable over links (a, b), by passing labels on and
    following them; every round is a table in the shared folder."""
    both = saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    for _ in range(most_rounds):
        near = _looked_up(both.withColumn("spread", F.col("a")), "b", labels, "node", "component").groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        jump = step.select(F.col("node").alias("at"), F.col("new").alias("beyond"))
        ahead = _looked_up(step.withColumn("spread", F.col("node")), "new", jump, "at", "beyond")
        moved = saved(ahead.select("node", "old", F.least("new", "beyond").alias("component")), "labels")
        labels = moved.select("node", "component")
        if moved.where(F.col("old") != F.col("component")).isEmpty():
            return labels
    raise RuntimeError("links did not settle")


def _sized(pairs: DataFrame, percent: int) -> DataFrame:
    """Sets can only be similar if their sizes are."""
    return pairs.where(100 * F.least("n", "other_n") >= percent * F.greatest("n", "other_n"))


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """head, node, differs, common of ``pairs(head, node)``: in how many shingles the node differs
    from the head, and in how many of these some other node of that head differs too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (xs, xo), (ys, yo) = ((c.values.to_numpy(), c.offsets.to_numpy()) for c in (batch.column("x"), batch.column("y")))
            found = [np.setxor1d(xs[xo[i]:xo[i + 1]], ys[yo[i]:yo[i + 1]], assume_unique=True) for i in range(batch.num_rows)]
            ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *found])))
            yield pa.RecordBatch.from_arrays([batch.column("head"), batch.column("node"), lists], ["head", "node", "shingles"])

    x, y = sets.select(F.col("node").alias("head"), F.col("shingles").alias("x")), sets.select("node", F.col("shingles").alias("y"))
    each = pairs.join(x, "head").join(y, "node").select("head", "node", "x", "y").mapInArrow(run, "head long, node long, shingles array<long>")
    each = saved(each, "differences")
    by_shingle = each.select("head", "node", F.explode("shingles").alias("shingle")).groupBy("head", "shingle").agg(F.count("*").alias("sets"), F.min("node").alias("node"))
    alone = by_shingle.where("sets = 1").groupBy("head", "node").agg(F.count("*").alias("alone"))
    each = each.select("head", "node", F.size("shingles").cast("long").alias("differs"))
    return each.join(alone, ["head", "node"], "left").withColumn("common", F.col("differs") - F.coalesce("alone", F.lit(0))).drop("alone")


def across(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one bucket and different components that could be links;
    ``members(bucket, head, node, n)``."""
    m = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = m.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    m = saved(m.join(split.select("bucket"), "bucket"), "open").where("node != head")  # the head is done
    m = m.join(differences(m.select("head", "node").distinct(), sets), ["head", "node"])
    m = m.join(m.groupBy("node").agg(F.array_sort(F.collect_set("bucket")).alias("buckets")), "node")  # one per band at most
    other = m.select("bucket", *[F.col(c).alias(f"other_{c}") for c in ("node", "n", "component", "differs", "common", "buckets")])
    least = F.col("differs") + F.col("other_differs") - 2 * F.least("common", "other_common")  # shingles only one of the two has
    possible = (100 + percent) * least <= (100 - percent) * (F.col("n") + F.col("other_n"))
    once = F.array_min(F.array_intersect("buckets", "other_buckets")) == F.col("bucket")
    pairs = m.join(other, "bucket").where((F.col("node") < F.col("other_node")) & (F.col("component") != F.col("other_component")) & possible & once)
    return pairs.select(F.col("node").alias("a"), F.col("other_node").alias("b"))


def groups(docs: DataFrame, k: int, percent: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key, n, component, component_id of ``docs(doc_id, text, text_key)``; no
    component where there are no words."""
    prints = saved(fingerprints(docs, k, bands, rows), "prints")
    classes = prints.where("n > 0").groupBy("set_a", "set_b", "n").agg(F.min(F.struct("doc_id", "text_key")).alias("least"), F.first("bands").alias("bands"))
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    filed = classes.select("node", "n", F.explode("bands").alias("bucket"))
    met = filed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = saved(filed.join(met, "bucket"), "members")
    # the head of a bucket is the member that meets most others in all its buckets: the least edited
    central = members.groupBy("node").agg(F.sum("size").alias("meets"))
    heads = members.join(central, "node").groupBy("bucket").agg(F.max(F.struct("meets", "node", "n")).alias("head"))
    members = saved(members.join(heads, "bucket").select("bucket", "head", "node", "n"), "members")
    first = members.select("node", "n", F.col("head.node").alias("other"), F.col("head.n").alias("other_n")).where("node != other").distinct()
    pairs = _sized(first, percent).select(F.col("other").alias("a"), F.col("node").alias("b"))
    wanted = members.select("node").distinct().join(classes.select("node", "least.doc_id", "least.text_key"), "node")
    sets = saved(shingle_sets(docs, wanted, k), "sets")
    links = saved(confirmed(pairs, sets, percent), "links")
    labels = components(links)
    more = saved(confirmed(across(members.select("bucket", F.col("head.node").alias("head"), "node", "n"), labels, sets, percent), sets, percent), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    known = classes.select("set_a", "set_b", "n", "node", F.col("least.doc_id").alias("least_id")).join(labels, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    heads = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = known.join(heads, "component").select("set_a", "set_b", "n", "component", "component_id")
    return prints.select("doc_id", "text_key", "n", "set_a", "set_b").join(known, ["set_a", "set_b", "n"], "left").drop("set_a", "set_b")


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document.

    Documents are linked when 100 * intersection >= percent * union of their k-word shingles.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("text_key"))
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return groups(src, k, percent, bands, rows).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents without their near duplicates: of each group the one with the least id stays
    (of rows that share that id, one).  Texts without words are no copies of each other; of rows
    with the same id and text one stays."""
    ship(docs.sparkSession)
    key = F.coalesce(F.xxhash64("text"), F.lit(0))
    found = groups(docs.select("doc_id", "text", key.alias("text_key")), k, percent, BANDS, ROWS)
    heads = found.where("n > 0").groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("least")).select("least.*")
    heads = heads.unionByName(found.where("n = 0").select("doc_id", "text_key"))
    mark = [F.xxhash64("doc_id", "text_key"), F.xxhash64("text_key", "doc_id")]
    heads = heads.select(mark[0].alias("_a"), mark[1].alias("_b"))
    marked = docs.withColumn("text_key", key).withColumns({"_a": mark[0], "_b": mark[1]})
    return marked.join(heads, ["_a", "_b"], "left_semi").dropDuplicates(["_a", "_b"]).select(*docs.columns)
