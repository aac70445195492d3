"""Registered queries of the training-data operators and their DuckDB oracles.

Every query applies its operator, with its production parameters, to the whole
intended table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import END, START, chats
from .common import table
from .decontaminate import find_leaks
from .html_text import extract
from .line_chunks import dedup_chunks
from .lm_score import lm_scores
from .mixing import mix
from .periodic import periodic_runs, run_report, with_loops
from .quality import quality_report
from .secret_scan import secret_report
from .sharding import shard_report
from .simhash import near_duplicates
from .warc import round_trip
from .whitening import whiten


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_chunks(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"), widely=True)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats(table(spark, sf_dir, "conversations"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(periodic_runs(with_loops(table(spark, sf_dir, "documents"))))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_line_dedup, op2_html_text, op3_simhash, op4_secret_scan, op5_decontamination,
        op6_quality_rules, op7_warc, op8_sharding, op9_chat, op10_mixing,
        op11_periodic_runs, op12_lm_scores, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    """Oracles where SQL gives the whole result; the others have brute-force tests."""
    return {
        "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
             min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM d""",
        "op9_chat": f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS place
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY place) AS turns
      FROM t GROUP BY conv_id),
prefixes AS (SELECT DISTINCT turns[1:k] AS turns
             FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM c)),
ends AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS copies FROM c GROUP BY turns)
SELECT conv_id, CAST(len(turns) AS BIGINT) AS n_turns, copies,
       array_to_string(list_transform(turns, lambda x: '{START}' || x.role || chr(10) || x.text
         || '{END}' || chr(10)), '') AS chat
FROM ends WHERE turns NOT IN (SELECT turns FROM prefixes)""",
    }
