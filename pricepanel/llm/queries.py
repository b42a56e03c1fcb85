"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricepanel.llm import ann, chat, decontaminate, extract, importance, lexical, mixing, neardup, ngram_lm, privacy, quality, secrets, tokens
from pricepanel.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401

TOKENIZER = "byte_bpe_50k.json"


@query("op1_test_leaks")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_private_spans")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.report(privacy.find(table(spark, sf_dir, "documents")))


@query("op3_dimension_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


# Markers and escapes as in chat.py: a text is escaped where it holds a marker or would change
# when read; every marker and backslash in it then takes one character more.
_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
tagged AS (
  SELECT *, CASE role WHEN 'user' THEN 4 WHEN 'assistant' THEN 6 WHEN 'system' THEN 3
                 ELSE 5 + 2 * octet_length(encode(role)) END AS tag_chars,
         CASE role WHEN 'user' THEN 4 WHEN 'assistant' THEN 6 WHEN 'system' THEN 3 ELSE 4 END AS end_chars,
         len(regexp_extract_all(text, '</?s>|\[/?(?:INST|ANSWER|SYS)\]|\[ROLE |\[/ROLE\]')) AS markers,
         length(text) - length(replace(text, '\', '')) AS slashes,
         regexp_replace(text, '(?s)\\(.)', '\1', 'g') <> text AS changes
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(tag_chars + end_chars + length(text) + 14 + CASE WHEN markers > 0 OR changes THEN markers + slashes ELSE 0 END) AS BIGINT) AS formatted_chars
FROM tagged GROUP BY conv_id
"""


@query("op4_chat_format", _CHAT_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    trap = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trap)
    return chat.report(chat.format_conversations(rows))


@query("op5_attention_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][rank % 3 + 1] AS weight, 2 * source_size AS room FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(room) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY room::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, CASE WHEN room::DOUBLE / weight <= level THEN room::DOUBLE ELSE weight * (
    SELECT arg_min(level, room::DOUBLE / weight) FROM levels WHERE room::DOUBLE / weight > level) END AS target
  FROM levels),
line AS (
  SELECT d.*, t.source_size, t.target, row_number() OVER () AS id, sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT *, unnest([0, 1]) AS copy FROM line),
packets AS (SELECT *, unnest(range(0, greatest(size, 1), 256)) AS pos FROM copies),
timed AS (
  SELECT *, least(256, size - pos) AS words, coalesce((copy * source_size + start + pos + least(256, size - pos))::DOUBLE / nullif(target, 0), 0) AS finish
  FROM packets),
sent AS (
  SELECT *, coalesce(sum(words) OVER (ORDER BY finish, source NULLS LAST, key, copy, pos, size, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM timed)
SELECT doc_id, size::BIGINT AS size, source_size, target, sum(greatest(0, least(words, floor((SELECT sum(size) FROM sized) * 1.5)::BIGINT - ahead)))::BIGINT AS taken
FROM sent GROUP BY id, doc_id, size, source_size, target
"""


@query("op6_fair_mix", _MIX_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


@query("op7_super_minhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_trie_lm")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"))


@query("op9_owned_secrets")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


# The checksum goes byte by byte over a table made from its polynomial; each run of words that
# occurs is read once.
_RESAMPLE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i AS b, i::UBIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS tab FROM bits WHERE k = 8),
worded AS (
  SELECT 'd' AS kind, row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 't', row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
spread AS (SELECT kind, id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM worded),
ahead AS (SELECT kind, id, w, lead(w) OVER line AS w2, lead(w, 2) OVER line AS w3 FROM spread WINDOW line AS (PARTITION BY kind, id ORDER BY i)),
runs AS (SELECT kind, id, w AS feature FROM ahead UNION ALL SELECT kind, id, w || ' ' || w2 FROM ahead WHERE w2 IS NOT NULL
         UNION ALL SELECT kind, id, w || ' ' || w2 || ' ' || w3 FROM ahead WHERE w3 IS NOT NULL),
texts AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM runs)),
buckets AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, len(h), 2), lambda p: ('0x' || substr(h, p, 2))::UBIGINT)),
         lambda c, b: xor(c >> 8, tab[(xor(c, b) % 256)::BIGINT + 1])), 4294967295) % 10000 AS bucket
  FROM texts, crc),
hits AS (SELECT kind, id, bucket, count(*) AS n FROM runs JOIN buckets USING (feature) GROUP BY ALL),
counts AS (SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::BIGINT AS s, coalesce(sum(n) FILTER (kind = 't'), 0)::BIGINT AS t FROM hits GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1) * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts),
weighed AS (
  SELECT d.id, any_value(d.doc_id) AS doc_id, any_value(len(d.w)) AS words, coalesce(sum(n), 0)::BIGINT AS n_features, coalesce(sum(n * gain), 0)::BIGINT AS weight,
         ('0x' || substr(sha256('42:' || coalesce(CAST(any_value(d.doc_id) AS VARCHAR), '')), 1, 8))::BIGINT AS h
  FROM worded d LEFT JOIN hits ON hits.kind = 'd' AND hits.id = d.id LEFT JOIN gains USING (bucket) WHERE d.kind = 'd' GROUP BY d.id),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score, words >= 20 AS fit FROM weighed),
placed AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST, n_features) AS r, count(*) FILTER (fit) OVER () AS all_fit FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND r <= all_fit * 5 // 100 THEN r END AS rank FROM placed
"""


@query("op11_importance_resample", _RESAMPLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_block_labeller")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


_SEARCH_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
sized AS (SELECT id, doc_id, len(w) AS n, w, count(*) OVER () AS docs, sum(len(w)) OVER () AS total FROM split WHERE len(w) > 0),
held AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(w) AS term FROM sized) GROUP BY ALL),
used AS (SELECT term, count(*) AS df FROM held GROUP BY term),
items AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
          FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS term FROM items) GROUP BY ALL),
scored AS (
  SELECT item, item_id, id, doc_id,
         sum(times * floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN used USING (term) JOIN held USING (term) JOIN sized USING (id) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op13_lexical_search", _SEARCH_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
