"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn, read back by a parser of the same grammar, and compared
with its source.  Where they differ, the texts that a reader would take for markers (or that hold
the escape character) are escaped and the conversation is rendered and read again; if it still
differs, all its texts are escaped, after which no marker can stand inside a text.

Grammar: ``<s>[TAG] body [/TAG]</s>`` per turn, nothing between turns.  TAG is INST (user),
ANSWER (assistant), SYS (system) or ``ROLE hex`` with the role's bytes for any other role.  A body
holds no marker.  Escaped texts have a backslash after the first character of each marker, and
backslashes doubled; reading drops a backslash and keeps what follows.

Only DataFrame functions are used.  A conversation is one row of the result, as its hash and its
text are one sequence; conversations are independent of each other.

Defined cases: null texts and roles are empty; rows of the same turn are ordered by role, then
text, repeated rows are kept; a null turn comes first; a null conversation id is an id; an empty
table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricepanel.llm.arrays import let, starts

TAGS = {"user": "INST", "assistant": "ANSWER", "system": "SYS"}
_ANGLE, _SQUARE = r"<(?=/?s>)", r"\[(?=/?(?:INST|ANSWER|SYS)\]|ROLE |/ROLE\])"
MARKER = rf"{_ANGLE}|{_SQUARE}"
TURN = r"(?s)<s>\[(INST|ANSWER|SYS|ROLE [0-9A-F]*)\] (.*?) \[/(?:INST|ANSWER|SYS|ROLE)\]</s>"


def escape(text: Column) -> Column:
    t = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(t, _ANGLE, r"<\\"), _SQUARE, r"[\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _tag(role: Column) -> Column:
    tag = F.concat(F.lit("ROLE "), F.hex(F.encode(role, "UTF-8")))
    for r, t in TAGS.items():
        tag = F.when(role == r, F.lit(t)).otherwise(tag)
    return tag


def _role(tag: Column) -> Column:
    role = F.decode(F.unhex(F.substring(tag, 6, 1 << 30)), "UTF-8")
    for r, t in TAGS.items():
        role = F.when(tag == t, F.lit(r)).otherwise(role)
    return role


def _open(role: Column) -> Column:
    return F.concat(F.lit("<s>["), _tag(role), F.lit("] "))


def _close(role: Column) -> Column:
    return F.concat(F.lit(" [/"), F.split_part(_tag(role), F.lit(" "), F.lit(1)), F.lit("]</s>"))


def render(turns: Column) -> Column:
    """Text of an array of (role, body)."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_open(t["role"]), t["body"], _close(t["role"]))), "")


def parse(text: Column) -> Column:
    """Array of (role, body) read from a rendered text; null if it does not follow the grammar."""
    whole, tags, bodies = (F.regexp_extract_all(text, F.lit(TURN), F.lit(g)) for g in (0, 1, 2))
    turns = F.transform(F.arrays_zip(tags.alias("tag"), bodies.alias("body")),
                        lambda t: F.struct(_role(t["tag"]).alias("role"), unescape(t["body"]).alias("body")))
    follows = (F.array_join(whole, "") == text) & ~F.exists(bodies, lambda b: b.rlike(MARKER))
    return F.when(follows, turns)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turns(role, body), formatted, level, loss(start, end).

    ``level`` is 0 where the plain rendering read back identically, 1 where some texts were
    escaped, 2 where all were.  ``loss`` has the code-point range of each assistant body in
    ``formatted``.
    """
    empty = F.lit("")
    one = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), empty).alias("role"), F.coalesce(F.col(text_col), empty).alias("body"))
    c = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("rows"))
    c = c.select("conv_id", F.transform("rows", lambda t: F.struct(t["role"].alias("role"), t["body"].alias("body"))).alias("turns"))

    c = c.withColumn("sent", F.col("turns")).withColumn("formatted", render(F.col("sent"))).withColumn("level", F.lit(0))
    conflict = lambda t: t["body"].rlike(MARKER) | ~_same(unescape(t["body"]), t["body"])
    for level, touched in ((1, conflict), (2, lambda t: F.lit(True))):
        differs = ~_same(parse(F.col("formatted")), F.col("turns"))
        c = c.withColumn("_differs", differs)
        escaped = _escaped(touched)
        c = c.withColumns({"sent": F.when(F.col("_differs"), escaped).otherwise(F.col("sent")), "level": F.when(F.col("_differs"), F.lit(level)).otherwise(F.col("level"))})
        c = c.withColumn("formatted", F.when(F.col("_differs"), render(F.col("sent"))).otherwise(F.col("formatted")))
    return c.select("conv_id", "turns", "formatted", "level", loss_ranges(F.col("sent")).alias("loss"))


def _escaped(touched) -> Column:
    return F.transform("turns", lambda t: F.struct(t["role"].alias("role"), F.when(touched(t), escape(t["body"])).otherwise(t["body"]).alias("body")))


def loss_ranges(sent: Column) -> Column:
    """Where the assistant bodies stand in the text rendered from ``sent``."""
    lengths = F.transform(sent, lambda t: (F.length(_open(t["role"])) + F.length(t["body"]) + F.length(_close(t["role"]))).cast("long"))

    def placed(t: Column, at: Column) -> Column:
        begin = (at + F.length(_open(t["role"]))).cast("int")
        return F.struct(t["role"].alias("role"), begin.alias("start"), (begin + F.length(t["body"])).alias("end"))

    said = F.filter(F.zip_with(sent, starts(lengths), placed), lambda r: r["role"] == "assistant")
    return F.transform(said, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))


def under_mask(formatted: Column, loss: Column) -> Column:
    """The text of each loss range, escapes and all.  Turns are cut once, and each range is taken
    from the assistant turn it lies in."""

    def cut(turns: Column) -> Column:
        placed = F.zip_with(turns, starts(F.transform(turns, lambda t: F.length(t["whole"]).cast("long"))),
                            lambda t, at: F.struct(t["whole"].alias("whole"), t["tag"].alias("tag"), at.alias("at")))
        said = F.filter(placed, lambda t: _role(t["tag"]) == "assistant")
        return F.zip_with(said, loss, lambda t, r: F.substring(t["whole"], (r["start"] - t["at"] + 1).cast("int"), r["end"] - r["start"]))

    whole, tags = (F.regexp_extract_all(formatted, F.lit(TURN), F.lit(g)) for g in (0, 1))
    return let(F.arrays_zip(whole.alias("whole"), tags.alias("tag")), cut)


def report(formatted: DataFrame) -> DataFrame:
    """Digest of the formatted conversations, from what their text reads back to."""
    f = formatted.withColumn("read", parse(F.col("formatted")))
    said = F.transform(under_mask(F.col("formatted"), F.col("loss")), unescape)
    f = f.withColumn("learned", F.array_join(said, ""))
    lines = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["body"], F.lit("\n"))), "")
    return f.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
