"""The queries of this package, each over its whole table, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm import (
    alignment,
    collocations,
    exact,
    licences,
    main_text,
    packing,
    quality,
    repeats,
    secret_scan,
    simhash,
    tiling,
    tokens,
    warc,
)
from tallymill.llm.common import table


TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 512


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths: each is filed under its source, in directories of 400 and of 20."""
    docs = table(spark, sf_dir, "documents")
    parts = F.col("source"), F.expr("doc_id div 400"), F.expr("doc_id div 20 % 20"), F.concat("doc_id", F.lit(".txt"))
    return licences.scan_licences(docs.withColumn("path", F.concat_ws("/", *parts)), "path")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True)
    return found.drop("mark")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    counts = tokens.prefix_counts(table(spark, sf_dir, "documents"), path, budgets=(TOKEN_LIMIT,), keep=False)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(table(spark, sf_dir, "pages"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)
    aligned = alignment.align(table(spark, sf_dir, "documents"), *paths, digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: found for name, found in globals().items() if name.startswith("op") and callable(found)}


_EXACT = """
    WITH digests AS (
        SELECT doc_id, sha256(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
    FROM digests"""

_CAPTURES = """
    WITH payloads AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
        FROM pages),
    stored AS (
        SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM payloads)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
    FROM stored"""

_PHRASES = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
    sizes AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM lists GROUP BY lang),
    places AS (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM lists, range(1, 6) lengths(k)),
    counts AS (
        SELECT lang, array_to_string(list_slice(words, i, i + k - 1), ' ') AS phrase, k, count(*) AS f
        FROM places GROUP BY ALL HAVING count(*) >= 100),
    kept AS (
        SELECT * FROM counts c WHERE k >= 2 AND NOT EXISTS (
            SELECT 1 FROM counts d
            WHERE d.lang = c.lang AND d.k > c.k AND 100 * d.f >= 100 * c.f AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))),
    cuts AS (
        SELECT lang, phrase, f, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS words FROM kept),
    parts AS (
        SELECT cuts.lang, cuts.phrase, cuts.f AS a, cut, x.f AS l, y.f AS r, n,
               CAST((1000::HUGEINT * cuts.f * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
        FROM cuts JOIN sizes USING (lang)
        JOIN counts x ON x.lang = cuts.lang AND x.phrase = array_to_string(list_slice(words, 1, cut), ' ')
        JOIN counts y ON y.lang = cuts.lang AND y.phrase = array_to_string(list_slice(words, cut + 1, len(words)), ' ')),
    best AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM best QUALIFY rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": _EXACT, "op7_warc": _CAPTURES, "op13_phrase_collocations": _PHRASES}
