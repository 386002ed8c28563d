"""The registered corpus queries: thin wrappers that derive the digest columns from the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regstat.llm import decision_list, decontaminate, hard_negatives, near_dup, piece_encoding, prefix_trie, quality_ranker, records, repeats, secret_scan, sharding, toxicity, url_filter
from regstat.llm.common import staged, table

SHARDS = 40
PIECE_MODEL = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_ranker.rank(docs, quality_ranker.train(docs, table(spark, sf_dir, "labels")))


def op2_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding.encode(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup(table(spark, sf_dir, "documents"))


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.dedup(table(spark, sf_dir, "documents"), width=2)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decision_list.judge(docs, decision_list.train(docs, table(spark, sf_dir, "labels")))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op9_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = records.write_records(table(spark, sf_dir, "documents"), records.fresh_folder(spark), tokenizer_path(WORD_TOKENIZER), END_ID)
    return records.with_starts(staged(records.read_records(index), "read-back")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_ranker": op1_quality_ranker,
    "op2_piece_encoding": op2_piece_encoding,
    "op3_repeats": op3_repeats,
    "op4_near_dup": op4_near_dup,
    "op5_toxicity": op5_toxicity,
    "op6_decontaminate": op6_decontaminate,
    "op7_decision_list": op7_decision_list,
    "op8_url_filter": op8_url_filter,
    "op9_records": op9_records,
    "op10_sharding": op10_sharding,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_secret_scan": op12_secret_scan,
    "op13_hard_negatives": op13_hard_negatives,
}

PREFIX_TRIE_SQL = """
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS body,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
digits AS (
    SELECT DISTINCT c, [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')] AS bytes FROM turns),
convs AS (
    SELECT c, xor(list_reduce([4294967295::BIGINT] || bytes, lambda crc, b: list_reduce([xor(crc, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END)), 4294967295::BIGINT) % 6 AS h
    FROM digits),
rebuilt AS (
    SELECT v.c, 0 AS half, t.pos, t.role, t.body FROM convs v JOIN turns t ON t.c = v.c - v.c % 100 AND t.pos <= v.h
    UNION ALL
    SELECT v.c, 1, t.pos, t.role, t.body FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h),
whole AS (
    SELECT v.c, coalesce(list({'role': role, 'body': body} ORDER BY half, pos) FILTER (WHERE pos IS NOT NULL), []) AS s
    FROM convs v LEFT JOIN rebuilt r ON r.c = v.c GROUP BY v.c),
members AS (
    SELECT c, unnest(range(0, len(s) + 1)) AS d, s FROM whole),
nodes AS (
    SELECT d, s[1:d] AS name, min(c) AS conv_id, count(*) AS n_convs, min(CASE WHEN d = 0 THEN 0 ELSE length(s[d].body) END) AS chars,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(s) = d), '')) AS ends_sha256
    FROM members GROUP BY d, s[1:d]),
family AS (
    SELECT d - 1 AS d, name[1:d - 1] AS name, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
counted AS (
    SELECT n.*, coalesce(f.n, 0) AS n_children FROM nodes n LEFT JOIN family f ON f.d = n.d AND f.name = n.name),
below AS (
    SELECT d, name, unnest(range(0, d + 1)) AS up, n_children = 0 AS leaf, (n_convs - 1) * chars AS saved FROM counted),
sums AS (
    SELECT up AS d, name[1:up] AS name, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM below GROUP BY 1, 2)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN sums s ON s.d = c.d AND s.name = c.name LEFT JOIN nodes p ON p.d = c.d - 1 AND p.name = c.name[1:c.d - 1]
"""

HARD_NEGATIVES_SQL = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS alike, list_inner_product(a.v, r.v)::BIGINT AS score
    FROM whole a JOIN whole r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % 100 = 0),
positive AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

#: Full-table SQL exists only where it can express the operator.
ORACLE_SQL: dict[str, str] = {
    "op11_prefix_trie": PREFIX_TRIE_SQL,
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}
