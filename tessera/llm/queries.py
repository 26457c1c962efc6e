"""The registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, chunks, exact, langid, minhash, mixing, packing, pii, repair, sharding, simhash, variants, warc

#: Bytes of text that a shard of op10 holds at most.
SHARD_BYTES = 2 << 20
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), tokenizer_path(), limit=4096, closing_id=1)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(_documents(spark, sf_dir), width=4, rule=simhash.BITS64, seed=42)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.classify(_documents(spark, sf_dir), text="text", declared="lang", host="source", kept=["doc_id", "lang", "source"])
    return found.select("row.doc_id", F.col("row.lang").alias("declared"), F.col("row.source").alias("host"), "text_language", "language", "posterior", "accepted")


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op3's operator on the evidence it is made for: what a page declares in its markup, its address's suffix and its host."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = pages.select("page_id", "url", langid.markup_language(F.col("html")).alias("declared"), langid.markup_text(F.col("html")).alias("text"))
    found = langid.classify(rows, text="text", declared="declared", host="url", key="page_id", kept=["page_id", "declared", "url"])
    return found.select("row.page_id", "row.declared", langid.suffix_of(F.col("row.url")).alias("suffix"), "text_language", "language", "posterior", "accepted")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_spans(_documents(spark, sf_dir))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.nearest(vectors, F.col("vec_id") % 100 == 0, k=10)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir), share=1.5, ceiling=2.0, weights=(3.0, 1.0, 2.0))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_documents(spark, sf_dir))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_documents(spark, sf_dir), SHARD_BYTES)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.groups(variants.vocabulary(_documents(spark, sf_dir)))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair.report(conversations, repair.damaged(conversations))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(_documents(spark, sf_dir), width=4)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_best_fit_packing, op2_simhash_near_dedup, op3_language_id, op4_exact_dedup, op5_warc, op6_substring_dedup, op7_nearest_neighbours, op8_mixing, op9_personal_data, op10_sharding, op11_spelling_variants, op12_conversation_repair, op13_minhash_near_dedup, page_languages)
    return {f.__name__: f for f in found}


OP4_SQL = r"""
WITH t AS (
    SELECT doc_id, length(coalesce(text, '')) AS size, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
), r AS (
    SELECT *, row_number() OVER w AS nth, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, text_sha256 FROM r
"""

OP5_SQL = """
WITH t AS (
    SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS payload_digest FROM pages
), r AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM t)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM r
"""

OP10_SQL = f"""
WITH t AS (
    SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h FROM documents
), e AS (SELECT t.*, d::INT AS depth, (h >> (60 - d::INT)) AS prefix FROM t, range(0, 61) g(d)),
b AS (SELECT depth, prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM e GROUP BY ALL HAVING sum(bytes) <= {SHARD_BYTES} OR min(h) = max(h)),
m AS (SELECT e.*, shard_bytes, shard_rows, row_number() OVER (PARTITION BY doc_id ORDER BY e.depth) AS nth FROM e JOIN b USING (depth, prefix))
SELECT doc_id, bytes, depth, (prefix << (60 - depth))::BIGINT AS shard, shard_bytes, shard_rows FROM m WHERE nth = 1
"""

OP13_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
           ELSE list_distinct([array_to_string(words[i : i + 3], ' ') FOR i IN range(1, len(words) - 2)]) END AS shingles FROM w
), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS common FROM e x JOIN e y USING (shingle) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * common >= 80 * (na + nb - common)),
both_ways AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, t.b FROM reach r JOIN both_ways t ON r.b = t.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, len(shingles)::BIGINT AS n_shingles, least(s.doc_id, coalesce(low.b, s.doc_id)) AS component_id, s.doc_id = least(s.doc_id, coalesce(low.b, s.doc_id)) AS kept
FROM s LEFT JOIN low ON low.a = s.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op13_minhash_near_dedup": OP13_SQL, "op4_exact_dedup": OP4_SQL, "op5_warc": OP5_SQL, "op10_sharding": OP10_SQL}
