"""Token counts with the whole-token shortcut.

A byte-level BPE first cuts a text into pre-tokens and merges each by itself.  Before any text is
read, the vocabulary is tried against the merges: the strings that come back as one token are
the *whole* tokens.  A pre-token that is such a string counts as one without merging; only the
rest are merged, each distinct one once per task as long as it stays in the table of known ones.

Defined cases: null and empty texts have 0 bytes and 0 tokens; every row is counted by itself, so
repeated rows and ids, and further columns, do not matter; special strings inside a text count
as the library takes them by default, one token each.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from pricepanel.session import ship

#: White space as Unicode defines it; the regular-expression module would add four control codes.
SPACE = r"\t-\r \x85\xa0  -     　"
#: The published pre-token pattern of the byte-level vocabulary. Fixed value.
PRE_TOKEN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The same cut for texts of ASCII and Latin letters only, where the classes are short ranges.
LATIN = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
LATIN_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^\t-\r {LATIN}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
NOT_LATIN = rf"[^\x00-\x7f{LATIN}]"
#: Most distinct pre-tokens a worker keeps; others are merged again when they come back.
KNOWN_LIMIT = 1_200_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def whole_tokens(tokenizer) -> set[str]:
    """Vocabulary strings that the merges turn into exactly themselves."""
    merge = tokenizer.model.tokenize
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    return {v for v in tokenizer.get_vocab(with_added_tokens=False) if v not in added and len(merge(v)) == 1}


def plain_byte_level(spec: dict) -> bool:
    """Whether a tokenizer file is cut by the published pattern and nothing else."""
    pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
    return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and spec["model"].get("type") == "BPE"
            and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")))


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Callable[[str], int]:
    """A function that counts the tokens of a text, for a tokenizer file; a worker keeps it."""
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if not plain_byte_level(spec):  # another kind of file: the library as it is
        return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
    letters, merge, whole = byte_letters(), tokenizer.model.tokenize, whole_tokens(tokenizer)
    back = {c: b for b, c in enumerate(letters)}

    class Known(dict):
        """Tokens of each pre-token seen; whole tokens are there from the start."""

        def __missing__(self, piece: str) -> int:
            n = len(merge("".join([letters[b] for b in piece.encode()])))
            if len(self) < KNOWN_LIMIT and len(piece) <= 64:
                self[piece] = n
            return n

    known = Known()
    for v in whole:
        try:
            known[bytes(back[c] for c in v).decode()] = 1
        except (KeyError, UnicodeDecodeError):  # half a character: never a pre-token
            pass
    of, any_cut, latin_cut = known.__getitem__, regex.compile(PRE_TOKEN).findall, re.compile(LATIN_TOKEN).findall
    not_latin = re.compile(NOT_LATIN).search

    def cut(text: str) -> list[str]:
        return any_cut(text) if not_latin(text) else latin_cut(text)

    special = [t["content"] for t in spec.get("added_tokens") or [] if t["content"]]
    if not special:
        return lambda text: sum(map(of, cut(text)))
    at_special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))

    def count(text: str) -> int:
        if not any(s in text for s in special):
            return sum(map(of, cut(text)))
        parts = at_special.split(text)
        return len(parts) - 1 + sum(sum(map(of, cut(p))) for p in parts)

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text.

    ``path`` is a tokenizer file present on every machine, as the public ones installed with
    the libraries are.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for b in batches:
            n_bytes = pc.fill_null(pc.binary_length(b.column("text")), 0).cast(pa.int64())
            n_tokens = [count(t) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), n_bytes, pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
