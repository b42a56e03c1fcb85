"""Personal data, and terms that give it away.

Base spans are e-mail addresses, IP addresses, card and phone numbers.  Each distinct value is a
protected entity.  Words that stand near an entity may reveal it too: from the whole corpus we
count how many distinct texts hold a word, an entity, and both.  A word discloses the share of the
entity's information that knowing the word gives,

    log2(p(entity | word) / p(entity)) / -log2 p(entity)

and is generalised from ``generalise`` on, removed from ``remove`` on, wherever it stands: far from
the entity and in texts without it too.  A word seen near an entity in one context only says nothing about co-occurrence and is left alone.  All counts are of distinct
texts (by their hash), however many rows hold copies of a text.

Each text is read by itself; counts are combined per task before the shuffle, so neither a common
word nor an entity that many texts hold meets in one task row by row.  Only texts that have copies
or hold an entity with candidate terms send their words one by one.

Defined cases: null and empty texts have no spans; repeated rows are read each; rows may share
ids; an empty table gives an empty result; other columns are kept out of the way by name.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricepanel.llm.filters import passes, slot_filter
from pricepanel.llm.words import pieces, words
from pricepanel.session import saved, ship

KINDS = ("email", "ip", "card", "phone")
_DIGIT = re.compile(r"[0-9]")
_LEFT = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Words on either side of an entity that count as its context.
CONTEXT_WORDS = 8
CONTEXT_CHARS = 400


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards, so that a long run of letters is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            a = at
            while a > done and text[a - 1] in _LOCAL:
                a -= 1
            if a < at:
                yield a, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans of a text, by start, then kind as listed."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if len(m[0]) >= 14:
                d = _NOT_DIGIT.sub("", m[0])
                if 14 <= len(d) <= 19 and luhn(d):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def _near(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Whole words next to a span."""
    a, b = max(0, start - CONTEXT_CHARS), min(len(text), end + CONTEXT_CHARS)
    left = [(a + m.start(), a + m.end()) for m in _WORD.finditer(text[a:start])]
    right = [(end + m.start(), end + m.end()) for m in _WORD.finditer(text[end:b])]
    left = [x for x in left if (x[0] > a or a == 0) and x[1] < start]
    right = [x for x in right if (x[1] < b or b == len(text)) and x[0] > end]
    return left[-CONTEXT_WORDS:] + right[:CONTEXT_WORDS]


def hash_words(items: list[str]) -> np.ndarray:
    """64-bit hashes, as signed numbers, the same as those of words in texts."""
    data = " ".join(items).encode()
    return words(np.frombuffer(data, np.uint8), np.array([0, len(data)])).hashes.view(np.int64)


def _neighbours(text: str, found: list[tuple[int, int, int]]) -> list[dict]:
    """The words next to each span that are no part of a span, and their context."""
    begins = [s for s, _, _ in found]
    furthest = list(itertools.accumulate((e for _, _, e in found), max))  # end of any span up to each
    said: list[tuple[int, str, list[str]]] = []
    for s, k, e in found:
        # spans that begin before a word ends: does one of them end behind its begin?
        w = [(p, q) for p, q in _near(text, s, e) if not (n := bisect.bisect_left(begins, q)) or furthest[n - 1] <= p]
        if w:
            said.append((k, text[s:e].lower(), [text[p:q] for p, q in w]))
    hashes = iter(hash_words([x for _, _, terms in said for x in ("\x01".join(terms), *terms)]).tolist())
    rows = []
    for k, value, terms in said:
        context = next(hashes)
        rows += [{"kind": k, "value": value, "context": context, "term": next(hashes)} for _ in terms]
    return rows


_FOUND = ("row long, spans array<struct<start:long,kind:int,end:long>>, entities array<struct<kind:int,value:string>>, "
          "near array<struct<kind:int,value:string,context:long,term:long>>")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    close = pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.string()), ("context", pa.int64()), ("term", pa.int64())]))
    entity = pa.list_(pa.struct([("kind", pa.int32()), ("value", pa.string())]))
    for b in batches:
        spans, entities, near = [], [], []
        for text in b.column("text").to_pylist():
            found = base_spans(text) if text else []
            spans.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
            entities.append([{"kind": k, "value": v} for k, v in sorted({(k, text[s:e].lower()) for s, k, e in found})])
            near.append(_neighbours(text, found))
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(spans, span), pa.array(entities, entity), pa.array(near, close)],
                                          ["row", "spans", "entities", "near"])


def text_words(docs: DataFrame, keep: np.ndarray, marked: np.ndarray) -> DataFrame:
    """term, text_key, texts: words of ``docs(text, text_key)`` let through by a filter of word hashes.

    Texts let through by ``marked``, a filter of text keys, give a row of each of their words;
    of the others, which must be distinct, words are counted, without a key.  Both filters are
    of fixed size and let some others through: the join after it drops the words, and a text
    marked without need is counted by its own rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["term", "text_key", "texts"]
        held: list[np.ndarray] = []
        single: list[tuple[np.ndarray, np.ndarray]] = []
        seen: set[int] = set()

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                t, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.nulls(len(t), pa.int64()), pa.array(n.astype(np.int64))], names)
            if single:
                t, k = (np.concatenate(x) for x in zip(*single))
                yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(k), pa.array(np.ones(len(t), np.int64))], names)
            held.clear()
            single.clear()

        for b in batches:
            keys = b.column("text_key").to_numpy(zero_copy_only=False)
            mark = passes(marked, keys)
            again = np.zeros(len(keys), bool)
            for i in np.flatnonzero(mark).tolist():
                again[i] = int(keys[i]) in seen
                seen.add(int(keys[i]))
            for lo, hi, data, offsets in pieces(b):
                w = words(data, offsets)
                pick = passes(keep, w.hashes) & ~again[lo:hi][w.doc]
                h, d = w.hashes[pick], w.doc[pick]
                order = np.lexsort((h, d))
                h, d = h[order], d[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                h, d = h[new], d[new]
                one = mark[lo:hi][d]
                held.append(h[~one])
                single.append((h[one], keys[lo:hi][d[one]]))
                if sum(map(len, held)) + sum(len(t) for t, _ in single) > 2_000_000:
                    yield from out()
        yield from out()

    return docs.select("text", "text_key").mapInArrow(count, "term long, text_key long, texts long")


def places(docs: DataFrame, keep: np.ndarray) -> DataFrame:
    """text_key, term, start, end: where words let through by a filter of word hashes stand, in
    code points; copies of a text give the same rows, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            keys = b.column("text_key").to_numpy(zero_copy_only=False)
            again = np.zeros(len(keys), bool)
            for lo, hi, data, offsets in pieces(b):
                w = words(data, offsets)
                pick = np.flatnonzero(passes(keep, w.hashes))
                doc = w.doc[pick]
                for i in np.unique(doc).tolist():
                    again[lo + i] = int(keys[lo + i]) in seen
                    seen.add(int(keys[lo + i]))
                new = ~again[lo:hi][doc]
                pick, doc = pick[new], doc[new]
                if not len(pick):
                    continue
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                before = chars[offsets[doc]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[lo:hi][doc]), pa.array(w.hashes[pick].view(np.int64)), pa.array(chars[w.starts[pick]] - before), pa.array(chars[w.ends[pick]] - before)],
                    ["text_key", "term", "start", "end"])

    return docs.select("text", "text_key").mapInArrow(run, "text_key long, term long, start long, end long")


def pairs_held(held: DataFrame, holding: DataFrame, pairs: DataFrame) -> DataFrame:
    """entity, term, once for each text that holds both: ``held(term, text_key)``, ``holding(text_key,
    entity)`` and the tried ``pairs(entity, term)``.

    A text's words are paired with its entities, or its entities with the words tried for them and
    these looked up in the text, whichever makes fewer rows for that text: neither a list of many
    entities nor an entity tried with many words is multiplied out.  Pairs that were not tried may
    be among them.
    """
    tried = pairs.groupBy("entity").agg(F.count("*").alias("tried"))
    sizes = holding.join(tried, "entity").groupBy("text_key").agg(F.count("*").alias("entities"), F.sum("tried").alias("tried"))
    sizes = held.groupBy("text_key").agg(F.count("*").alias("words")).join(sizes, "text_key")
    turned = sizes.where(F.col("words") * F.col("entities") > F.col("tried")).select("text_key")
    direct = held.join(turned, "text_key", "left_anti").join(holding, "text_key")
    looked_up = holding.join(turned, "text_key", "left_semi").join(pairs, "entity").join(held, ["text_key", "term"], "left_semi")
    return direct.select("entity", "term").unionByName(looked_up.select("entity", "term"))


def find(docs: DataFrame, generalise: float = 0.5, remove: float = 0.8, least_contexts: int = 2,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, text_key, spans(start, kind, end, name, action): base spans and disclosing
    terms, one row per text."""
    ship(docs.sparkSession)
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      F.xxhash64(text_col).alias("text_key"))
    kept = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_key long"
    found = saved(src.mapInArrow(_with_ids(_find), f"{kept}, {_FOUND}"), "privacy")
    entity = F.xxhash64("kind", "value").alias("entity")
    near = found.where(F.size("near") > 0).select(F.explode("near").alias("n")).select("n.*").select(entity, "term", "context")

    # terms of an entity: words near it in several contexts
    pairs = near.groupBy("entity", "term", "context").agg(F.lit(1).alias("one")).groupBy("entity", "term").agg(F.count("*").alias("contexts"))
    pairs = saved(pairs.where(F.col("contexts") >= least_contexts).select("entity", "term"), "privacy-pairs")
    # the texts that hold these entities, each text once
    holding = found.where(F.size("entities") > 0).select("text_key", F.explode("entities").alias("e")).select("text_key", "e.*").select("text_key", entity)
    holding = saved(holding.distinct().join(pairs.select("entity").distinct(), "entity", "left_semi"), "privacy-holding")
    copies = found.groupBy("text_key").agg(F.count("*").alias("copies"))
    copied = copies.where(F.col("copies") > 1).select("text_key")
    marked = slot_filter(holding.select("text_key").unionByName(copied), "text_key")
    counted = saved(text_words(src, slot_filter(pairs, "term"), marked), "privacy-words")
    held = saved(counted.where(F.col("text_key").isNotNull()).select("term", "text_key").distinct(), "privacy-held")
    # how many distinct texts hold a term, an entity, both, and how many there are
    texts = counted.where(F.col("text_key").isNull()).select("term", "texts").unionByName(held.select("term", F.lit(1).cast("long").alias("texts")))
    texts = texts.groupBy("term").agg(F.sum("texts").alias("texts"))
    holders = holding.groupBy("entity").agg(F.count("*").alias("holders"))
    together = pairs_held(held, holding, pairs).groupBy("entity", "term").agg(F.count("*").alias("together"))
    total = F.lit(float(max(2, copies.count())))
    known = F.least(F.col("holders") / total, F.lit(0.5))
    given = F.col("together") / F.col("texts")
    share = F.log2(given / known) / -F.log2(known)
    strong = pairs.join(together, ["entity", "term"]).join(holders, "entity").join(texts, "term").withColumn("share", share)
    strong = strong.where(F.col("share") >= generalise).groupBy("term").agg(F.max("share").alias("share"))
    strong = saved(strong, "privacy-strong")
    # where these terms stand, in all texts
    term_spans = places(src, slot_filter(strong, "term")).join(strong, "term").groupBy("text_key", "start", "end").agg(F.max("share").alias("share"))
    term_spans = term_spans.groupBy("text_key").agg(F.collect_list(F.struct(
        "start", F.lit(len(KINDS)).alias("kind"), "end", F.lit("term").alias("name"),
        F.when(F.col("share") >= remove, "remove").otherwise("generalise").alias("action"))).alias("terms"))
    names = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                                                   F.element_at(names, s["kind"] + 1).alias("name"), F.lit("replace").alias("action")))
    out = found.select("row", "doc_id", "text_key", base.alias("base")).join(term_spans, "text_key", "left")
    # a word that is part of a base span goes with it
    apart = F.filter("terms", lambda t: ~F.exists("base", lambda s: (t["start"] < s["end"]) & (s["start"] < t["end"])))
    return out.select("doc_id", "row", "text_key", F.array_sort(F.concat("base", F.coalesce(apart, F.array()))).alias("spans"))


def _with_ids(fn):
    """Carry the id columns past a function of texts."""

    def run(batches):
        for b in batches:
            for o in fn([b]):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), *o.columns], ["doc_id", "text_key", *o.schema.names])

    return run


def report(found: DataFrame) -> DataFrame:
    """Counts by kind, hash of the base spans, all spans."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["name"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(listed(F.filter("spans", lambda s: s["name"] != "term")), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"), count("term").alias("n_term"))


def sanitised(text: str, spans: list[tuple[int, int, str, str]]) -> str:
    """A text without what its spans (start, end, name, action) cover; where spans overlap the
    union is replaced once, by the first."""
    out, at = [], 0
    for start, end, name, action in sorted(spans):
        if start >= at:
            out.append(text[at:start])
            out.append({"replace": f"[{name.upper()}]", "generalise": "[TERM]", "remove": ""}[action])
        at = max(at, end)
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """The documents with base spans replaced by their kind and disclosing terms generalised or
    removed."""
    spans = find(docs, **options).where(F.size("spans") > 0)
    spans = spans.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.first("spans").alias("_spans"))
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left")
    clean = F.udf(lambda t, s: t if not s or t is None else sanitised(t, [(x.start, x.end, x.name, x.action) for x in s]), "string")
    return joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(clean("text", "_spans"))).select(*docs.columns)
