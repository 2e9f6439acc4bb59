"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm.alignment import cross_alignment
from riskspark.llm.decontaminate import contamination
from riskspark.llm.licenses import licenses
from riskspark.llm.line_dedup import dedup_lines
from riskspark.llm.minhash import near_duplicates
from riskspark.llm.packing import pack
from riskspark.llm.personal_data import personal_data
from riskspark.llm.ppm import ppm_scores
from riskspark.llm.quality_rules import quality_rules
from riskspark.llm.source_audit import source_audit
from riskspark.llm.substring_dedup import remove_repeats
from riskspark.llm.token_cache import token_counts
from riskspark.llm.warc import archive_round_trip
from riskspark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "failed_rules")


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over all documents, from a cache that starts empty, so that all is encoded."""
    out = token_counts(table(spark, sf_dir, "documents"), scratch_path(spark, "token-cache"),
                       public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def pack_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


def licenses_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def near_duplicates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4).select(
        "doc_id", "n_shingles", "component_id", "kept")


NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
    SELECT doc_id, w, least(4, len(w)) AS k, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT a AS node, a AS seen FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.seen),
low AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id,
       coalesce(component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.node = w.doc_id
"""


def personal_data_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


DECONTAMINATE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
gram AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
    FROM iw WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM gram),
windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, windows.n, i, item_id FROM windows JOIN gram USING (g)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(xs, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def substring_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def ppm_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document in five, by the checksum of its id, is held out of training."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    return ppm_scores(table(spark, sf_dir, "documents"), held_out)


def alignment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def source_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit(table(spark, sf_dir, "documents"))


SOURCE_AUDIT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + 1000000000 * CAST(coalesce(c.n, 0) + 1 AS HUGEINT) // (coalesce(total, 0) + v) AS p,
         1 + 1000000000 * CAST(lang_n + 1 AS HUGEINT) // (lang_total + v) AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source)
       LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
more AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM more) QUALIFY part = 'pair' OR rank <= 200
"""


QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_risk_controlled_rules": (quality_query, None),
    "op2_token_cache": (token_counts_query, None),
    "op3_sentence_rule_licenses": (licenses_query, None),
    "op4_concat_and_cut": (pack_query, None),
    "op5_offset_preserving_pii": (personal_data_query, None),
    "op6_two_level_capture_index": (warc_query, WARC_SQL),
    "op7_fast_sketch_near_duplicates": (near_duplicates_query, NEAR_DUPLICATES_SQL),
    "op8_ngram_decontamination": (decontaminate_query, DECONTAMINATE_SQL),
    "op9_fuzzy_line_dedup": (line_dedup_query, None),
    "op10_lyndon_group_substring_dedup": (substring_dedup_query, None),
    "op11_ppm_scores": (ppm_query, None),
    "op12_pair_bitmap_alignment": (alignment_query, None),
    "op13_chunk_factorized_audit": (source_audit_query, SOURCE_AUDIT_SQL),
}
