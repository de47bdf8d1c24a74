"""One query per operator, each over its whole table, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalign.llm import block_tables, chat_format, class_lm, common, decontaminate, exact_dedup, extract_html, mixing, piece_table, prefix_trie, simhash, suffix_dedup, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLE_SQL[name] = sql
        return build

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Escapes of the chat template, and what one conversation looks like in it.
_ESC = r"replace(replace(replace(replace(replace({}, '\', '\\'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<s>', '<\s>'), '</s>', '<\/s>')"
_CHATS = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM turns
), said AS (
  SELECT *, before IS NOT DISTINCT FROM role AS merged, length(""" + _ESC.format("role") + ") AS r, length(" + _ESC.format("text") + r""") AS t FROM marked
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(t + CASE WHEN merged THEN 3 ELSE 7 + r + 8 + 4 END) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""


@query("op1_chat_format", _CHATS)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return chat_format.digest(chat_format.format_chats(turns.unionByName(probe)))


@query("op2_warc", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM g""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.fresh_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read(spark, path, with_payload=False))


@query("op4_exact_dedup", """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(table(spark, sf_dir, "documents"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query("op10_html_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_html.extract(table(spark, sf_dir, "pages"))


@query("op6_class_lm")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(table(spark, sf_dir, "documents"))


@query("op8_decontaminate")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.strip(table(spark, sf_dir, "documents")).drop("kept")


@query("op13_fill_in_middle", r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents
), h AS (
  SELECT *, len(units) AS n, CAST('0x' || hex[1:8] AS BIGINT) % (len(units) + 1) AS a, CAST('0x' || hex[9:16] AS BIGINT) % (len(units) + 1) AS b,
         CAST('0x' || hex[17:24] AS BIGINT) % 100 AS c, CAST('0x' || hex[25:32] AS BIGINT) % 100 AS d FROM t
), p AS (
  SELECT doc_id, text, n, array_to_string(units[1:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(units[greatest(a, b) + 1:], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90 THEN 'plain'
              WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_table.digest(table(spark, sf_dir, "documents"))


@query("op12_block_tables")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_tables.digest(table(spark, sf_dir, "documents"))


@query("op11_prefix_trie", r"""
WITH placed AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), left(coalesce(text, ''), 64), text) AS pos FROM conversations
), convs AS (
  SELECT c, c - c % 20 AS first, CAST(xor(list_reduce(
           [CAST(4294967295 AS UBIGINT)] || flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: [CAST(ascii(s) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0])),
           lambda a, b: CASE WHEN xor(a, b) % 2 = 1 THEN xor(xor(a, b) >> 1, CAST(3988292384 AS UBIGINT)) ELSE xor(a, b) >> 1 END),
         CAST(4294967295 AS UBIGINT)) % 4 AS BIGINT) AS h FROM placed GROUP BY c
), sizes AS (
  SELECT v.*, least(h, coalesce((SELECT max(pos) FROM placed p WHERE p.c = v.first), 0)) AS taken FROM convs v
), turns AS (
  SELECT v.c, p.pos AS depth, p.role, p.text FROM sizes v JOIN placed p ON p.c = v.first AND p.pos <= v.h
  UNION ALL SELECT v.c, v.taken + p.pos - v.h, p.role, p.text FROM sizes v JOIN placed p ON p.c = v.c AND p.pos > v.h
  UNION ALL SELECT c, 0, '', '' FROM sizes
), keyed AS (
  SELECT c, depth, text, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY depth) AS chain FROM turns
), linked AS (
  SELECT c, depth, text, sha256(chain) AS key, lag(sha256(chain)) OVER (PARTITION BY c ORDER BY depth) AS above, depth = max(depth) OVER (PARTITION BY c) AS last FROM keyed
), nodes AS (
  SELECT key, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(above) AS above, any_value(text) AS text,
         string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last) AS ends FROM linked GROUP BY key
), sizes_of AS (
  SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.above = n.key) AS n_children, (n_convs - 1) * len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS saved FROM nodes n
), below AS (SELECT DISTINCT a.key AS top, d.key FROM linked a JOIN linked d ON a.c = d.c AND d.depth >= a.depth
), sums AS (
  SELECT b.top, sum(CAST(s.n_children = 0 AS BIGINT)) AS n_leaves, sum(s.saved) AS saved_tokens FROM below b JOIN sizes_of s ON s.key = b.key GROUP BY b.top
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM sizes_of n JOIN sums s ON s.top = n.key LEFT JOIN nodes p ON p.key = n.above""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
