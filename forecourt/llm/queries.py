"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import (bpe, decontaminate, language, lines, paragraphs, prefixtrie, ranking, replytrees, sharding,
                           simhash, toxicity, vectors, wordpiece)
from forecourt.llm.common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ship(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encoding_digest(table(spark, sf_dir, "documents"),
                               vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(table(spark, sf_dir, "documents"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op4_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return replytrees.conversation_digest(rows.unionByName(more))


@query
def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding(table(spark, sf_dir, "documents"))


@query
def op9_wordpiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  vocabulary("word_bpe_49k.json")).drop("text")


@query
def op11_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_ASCII}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op6_decontamination"] = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, x.part AS part, len(x.part) AS size FROM (
        SELECT item_id, unnest([{{'part': w[i:i + least(10, len(w)) - 1]}} FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS x
        FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
    SELECT doc_id, size, i, w[i:i + size - 1] AS part FROM (
        SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS (SELECT p.doc_id, p.i, p.size, v.item_id FROM places p JOIN windows v ON p.size = v.size AND p.part = v.part),
hits AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id),
per_doc AS (
    SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(p.n, 0) AS BIGINT) AS n_items, sha256(coalesce(p.ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN per_doc p USING (doc_id)
"""

ORACLES["op4_reply_trees"] = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
turns AS (
    SELECT *, length(regexp_replace(role, '[\\<:]|###', '\\\0', 'g')) AS role_chars,
           length(regexp_replace(text, '[\\<]|###', '\\\0', 'g')) AS text_chars FROM said)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(16 + role_chars + text_chars) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLES["op11_ranking"] = rf"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_ASCII}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY item_id, term),
docs AS (SELECT row_number() OVER () AS r, doc_id, len(w) AS n, w FROM words),
totals AS (SELECT count(*) FILTER (n > 0) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM docs),
tf AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals),
worth AS (
    SELECT r, term, weights.w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nn) // ll))) AS s
    FROM tf JOIN weights USING (term) JOIN docs USING (r), totals),
scores AS (
    SELECT item_id, r, CAST(sum(times * s) AS BIGINT) AS score FROM asked JOIN worth USING (term) GROUP BY item_id, r),
placed AS (
    SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scores JOIN docs USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""

ORACLES["op13_prefix_trie"] = r"""
WITH crc_table AS (
    SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i:
        CASE WHEN (c & 1) = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, x)) AS t),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
        list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ord(CAST(conv_id AS VARCHAR)[i]) AS BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), crc_table),
told AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, t) AS pos FROM told),
rebuilt AS (
    SELECT o.conv_id, pos, t, words FROM own o JOIN convs c ON o.conv_id = c.conv_id AND pos > h
    UNION ALL SELECT c.conv_id, pos, t, words FROM own o JOIN convs c ON o.conv_id = c.base AND pos <= h),
steps AS (SELECT conv_id, t, words, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS d FROM rebuilt),
prefixes AS (
    SELECT conv_id, d, words, string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS path FROM steps
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lasts AS (SELECT conv_id, max(d) AS d FROM prefixes GROUP BY conv_id),
ends AS (
    SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM prefixes JOIN lasts USING (conv_id, d) GROUP BY path),
nodes AS (
    SELECT path, d, left(path, greatest(CAST(32 * (d - 1) AS BIGINT), 0)) AS up, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words
    FROM prefixes GROUP BY path, d),
kids AS (SELECT up AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY up),
below AS (
    SELECT left(path, CAST(32 * k AS BIGINT)) AS path, sum(leaf) AS leaves, sum(saved) AS saved
    FROM (SELECT path, unnest(range(d + 1)) AS k, CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf, (nodes.n - 1) * words AS saved
          FROM nodes LEFT JOIN kids USING (path)) GROUP BY 1)
SELECT nodes.conv_id, CAST(nodes.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, nodes.n AS n_convs, coalesce(kids.n, 0) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN below USING (path) LEFT JOIN kids USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes p ON nodes.d > 0 AND p.path = nodes.up
"""
