"""Secret scan with corpus-wide ownership of each candidate.

Candidates are the base patterns (assignments, access keys, long hex runs) and, besides, long
mixed strings that look drawn at random.  Each candidate value is hashed, and its copies are
counted by distinct repositories and distinct owners over the whole corpus: a value that many
owners have was copied from an example; one that a single owner has looks live.

Only DataFrame functions are used.  Matches are located by marking them in the text, cutting it
there, and adding up the lengths of the cuts, so positions are code points.  The counts go by
distinct (value, owner) first and are combined before the shuffle, so a value copied a million
times is one row per task.

Defined cases: a null text is empty and has no spans; repeated rows are scanned each; null owners
count as one owner; a text that holds the marker character keeps its positions; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricepanel.llm.arrays import let, starts
from pricepanel.session import saved

#: The base patterns, in the order in which spans of the same start are listed. Fixed values.
KEY_WORDS = "password|passwd|secret|token|api_?key"
ASSIGN = rf"""(?i:{KEY_WORDS})["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = rf"""^(?i:{KEY_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE_KINDS = ("assign", "access", "hex")
SHORTEST = {"assign": 12, "access": 18, "hex": 16}
#: The method's own kind: strings of one owner that mix digits with letters of both cases. Whole
#: runs; what they hold is asked of the value, wherever in it the digits stand.
MIXED = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}"

MARK, OTHER = "\x01", "\x02"


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of a pattern: array of (at, hit), ``at`` in code points."""
    parts = F.split(F.regexp_replace(F.translate(text, MARK, OTHER), f"({pattern})", f"{MARK}$1{MARK}"), MARK, -1)

    def hits(parts: Column) -> Column:
        placed = F.zip_with(starts(F.transform(parts, lambda x: F.length(x).cast("long"))), parts, lambda at, x: F.struct(at.alias("at"), x.alias("hit")))
        return F.filter(placed, lambda x, i: i % 2 == 1)

    return let(parts, hits)


def _value(kind: str, hit: Column) -> Column:
    return F.regexp_extract(hit, ASSIGN_VALUE, 1) if kind == "assign" else hit


def _span(kind: str, rank: int):
    return lambda m: F.struct(
        m["at"].alias("start"), (m["at"] + F.length(m["hit"])).alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
        _value(kind, m["hit"]).alias("value"))


def _long_enough(kind: str):
    return lambda m: F.length(m["value"]) >= SHORTEST[kind]


def candidates(text: Column) -> Column:
    """Array of (start, end, rank, kind, value) of the base matches and the mixed strings."""
    has_digit_run = text.rlike(r"[0-9a-f]{16}")
    worth = {"assign": text.rlike(rf"(?i:{KEY_WORDS})"), "access": text.contains("AKIA"), "hex": has_digit_run, "mixed": text.rlike(MIXED)}
    # a run is taken whole by its pattern, so asking for the least length finds the same runs
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": r"[0-9a-f]{16,}", "mixed": MIXED}
    none = F.array().cast("array<struct<start:bigint,end:bigint,rank:int,kind:string,value:string>>")
    found = []
    for rank, (kind, pattern) in enumerate(patterns.items()):
        spans = F.transform(located(text, pattern), _span(kind, rank))
        if kind == "mixed":
            spans = F.filter(spans, lambda m: m["value"].rlike("[A-Z]") & m["value"].rlike("[a-z]") & m["value"].rlike("[0-9].*[0-9].*[0-9]"))
        else:
            spans = F.filter(spans, _long_enough(kind))
        found.append(F.when(worth[kind], spans).otherwise(none))
    return F.concat(*found)


def listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")


def scan(docs: DataFrame, most_owners: int = 2, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", repository_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """doc_id, text_key, spans(start, end, rank, kind, value, owners, repositories, live).

    One row per document.  ``live`` marks a value that at most ``most_owners`` owners have; base
    spans stay in the list either way, mixed strings only where live.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    repository = F.xxhash64(*[F.col(c) for c in repository_cols])
    found = saved(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(owner_col).cast("string"), F.lit("\x00")).alias("owner"),
                              repository.alias("repository"), F.monotonically_increasing_id().alias("row"), candidates(text).alias("spans")), "secrets")
    each = found.where(F.size("spans") > 0).withColumn("m", F.explode("spans")).withColumn("value_hash", F.sha2("m.value", 256))
    copies = each.groupBy("value_hash", "owner", "repository").agg(F.count("*").alias("copies"))
    # a value's owners and repositories: counted over distinct rows, not collected
    by_owner = copies.groupBy("value_hash", "owner").agg(F.count("*").alias("repositories"), F.sum("copies").alias("copies"))
    held = by_owner.groupBy("value_hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("copies").alias("copies"))
    judged = each.join(held, "value_hash").withColumn("live", F.col("owners") <= most_owners)
    judged = judged.where((F.col("m.kind") != "mixed") | F.col("live"))
    per_doc = judged.groupBy("row").agg(F.collect_list(F.struct(
        "m.start", "m.end", "m.rank", "m.kind", "m.value", "owners", "repositories", "live")).alias("spans"))
    return found.drop("spans", "owner", "repository").join(per_doc, "row", "left").withColumn("spans", F.coalesce("spans", F.array()))


def report(scanned: DataFrame) -> DataFrame:
    """The digest of a scan: counts by kind, hash of the base spans, all spans."""
    base = F.filter("spans", lambda m: m["kind"] != "mixed")
    count = lambda kind: F.size(F.filter("spans", lambda m: m["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda m: m["live"])).cast("long").alias("n_live"))


def redact(docs: DataFrame, with_text: str = "[SECRET]", most_owners: int = 2) -> DataFrame:
    """The documents with live-looking secrets replaced; widely copied examples stay.

    Values are replaced wherever they stand in a text that was found to hold them.
    """
    spans = scan(docs, most_owners).where(F.exists("spans", lambda m: m["live"]))
    live = F.transform(F.filter("spans", lambda m: m["live"]), lambda m: m["value"])
    values = spans.select(F.col("doc_id").alias("_id"), F.array_distinct(live).alias("_values")).groupBy("_id").agg(
        F.array_distinct(F.flatten(F.collect_set("_values"))).alias("_values"))
    # longest first; of equal length by code point, so that reruns agree
    by_length = lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0)
    longest_first = F.array_sort(F.coalesce("_values", F.array()), by_length)
    text = F.aggregate(longest_first, F.col("text"), lambda t, v: F.replace(t, v, F.lit(with_text)))
    joined = docs.join(values, docs["doc_id"].eqNullSafe(values["_id"]), "left")
    out = joined.withColumn("text", F.when(F.col("_values").isNull(), F.col("text")).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_values").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
