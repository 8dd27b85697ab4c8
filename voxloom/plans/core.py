"""All registered queries of the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxloom.plans import alignments, curation, diarization, interval_queries, records, signals, streams  # noqa: F401
from voxloom.plans.registry import ORACLE, QUERIES


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Quality tiers of transcripts by language with their total."""
    return curation.tier_report(spark, sf)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
