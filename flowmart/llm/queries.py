"""The operators as queries over the driver tables, and the SQL with the same result where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmart.llm import (
    decontamination, exact, extraction, importance, language, packing, secret_scan, shards, simhash, suffix_dedup, urls, warc, whitening,
)
from flowmart.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: The tokenizer of packing and of the secret scan's dictionary.
TOKENIZER = "word_bpe_49k.json"
SHARDS = 8


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op1_language_mixture")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = language.fold() == 1
    found = language.predict(docs.select("doc_id", "text"), language.fit(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "languages")


@query("op2_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM p)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(hex, 1 + 5 * CAST(i // 4 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM g""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


@query("op3_url_trust")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages"))


def _crc_table() -> str:
    """The 256 remainders of CRC-32 by its polynomial, for SQL that has no such function."""
    def remainder(b: int) -> int:
        for _ in range(8):
            b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        return b
    return "[" + ", ".join(str(remainder(b)) for b in range(256)) + "]"


def _jumps(shards: int) -> str:
    return f"""WITH RECURSIVE j(doc_id, k, b, j) AS (
    SELECT DISTINCT doc_id, CAST(doc_id AS HUGEINT) + CASE WHEN doc_id < 0 THEN 18446744073709551616 ELSE 0 END, 0::BIGINT, 0::BIGINT FROM documents
    UNION ALL
    SELECT doc_id, n, j, CAST(floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((n // 8589934592)::DOUBLE + 1))) AS BIGINT)
    FROM (SELECT doc_id, j, (k * 2862933555777941757 + 1) % 18446744073709551616 AS n FROM j WHERE j < {shards}))
  SELECT doc_id, CAST(b AS INT) AS b FROM j WHERE j >= {shards}"""


@query("op4_jump_hash", f"""
WITH a AS ({_jumps(SHARDS)}), g AS ({_jumps(SHARDS + 1)}),
d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(size - 1), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
  lambda x, y: xor(x >> 8, list_extract({_crc_table()}, CAST(xor(x & 255, y) AS BIGINT) + 1))), 4294967295::BIGINT) AS text_crc32 FROM d)
SELECT c.doc_id, size, text_crc32, 'key' AS law, a.b AS shard,
  row_number() OVER (PARTITION BY a.b ORDER BY c.doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, g.b AS grown_shard
FROM c JOIN a ON a.doc_id = c.doc_id JOIN g ON g.doc_id = c.doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.place(read_table(spark, sf_dir, "documents"), SHARDS)


@query("op5_sum_of_squares_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op6_simhash_pigeonring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(read_table(spark, sf_dir, "documents"))


@query("op7_main_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read_table(spark, sf_dir, "pages"))


@query("op8_template_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op9_exact_dedup", """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicate_groups(read_table(spark, sf_dir, "documents"))


@query("op10_secret_forest")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return found.select("doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"), "score", "secret")


@query("op11_importance_resampling", f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
f AS (SELECT doc_id, f, count(*) AS n FROM (SELECT doc_id, unnest(w) AS f FROM d) GROUP BY ALL),
g AS (SELECT f, count(*) AS n FROM (SELECT unnest(w) AS f FROM b) GROUP BY ALL),
h AS (SELECT f, hex(encode(f)) AS x, octet_length(encode(f)) AS size FROM (SELECT f FROM f UNION SELECT f FROM g)),
k AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(size), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
  lambda x, y: xor(x >> 8, list_extract({_crc_table()}, CAST(xor(x & 255, y) AS BIGINT) + 1))), 4294967295::BIGINT) % 10000 AS bucket FROM h),
s AS (SELECT bucket, sum(n) AS s FROM f JOIN k USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM g JOIN k USING (f) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
  / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM s FULL JOIN t USING (bucket)),
w AS (SELECT doc_id, sum(n * gain)::BIGINT AS weight FROM f JOIN k USING (f) JOIN gain USING (bucket) GROUP BY doc_id),
a AS (SELECT d.doc_id, len(d.w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
  CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN w USING (doc_id)),
v AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296::DOUBLE)))::BIGINT AS score FROM a),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM v WHERE n_features >= 20)
SELECT v.*, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM v LEFT JOIN r USING (doc_id)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op12_chebyshev_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long")).drop("residual")


@query("op13_suffix_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.drop_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
