"""The queries of this package and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, html_text, language_model, licenses, near_dedup, neighbours, packing, quality, secrets, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_ledger": secrets.query,
        "op2_near_duplicates": near_dedup.query,
        "op3_pattern_packing": packing.query,
        "op4_maxent_scores": language_model.query,
        "op5_main_text": html_text.query,
        "op6_nearest_vectors": neighbours.query,
        "op7_benchmark_hits": decontaminate.query,
        "op8_web_archive": warc.query,
        "op9_quality_scores": quality.query,
        "op10_license_digests": licenses.query,
    }


_WARC = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT page_id, n, d, CASE WHEN n >= 100 AND page_id <> min(page_id) OVER (PARTITION BY d) THEN min(page_id) OVER (PARTITION BY d) END AS r FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN r IS NULL THEN 'response' ELSE 'revisit' END AS record_type, r AS refers_to FROM f
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_web_archive": _WARC, "op10_license_digests": licenses.sql()}
