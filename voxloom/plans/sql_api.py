"""Operators by name in SQL: temporary functions, table functions and views of a session."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from voxloom.operators.align import repair_timestamps
from voxloom.session import read_table

#: SQL functions that stay expressions of the plan.
EXPRESSIONS = {
    "words_per_minute": ("n BIGINT, d DOUBLE", "DOUBLE", "n / greatest(d, 0.001D) * 60"),
    "characters_per_minute": ("t STRING, d DOUBLE", "DOUBLE", "CASE WHEN d > 0 THEN length(t) / d * 60 END"),
    "overlap_seconds": ("a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE", "DOUBLE", "greatest(least(b, d) - greatest(a, c), 0.0D)"),
    "leading_label": ("t STRING", "STRING", "substring_index(t, '_', 1)"),
}


class ChunkPlan:
    """Table function: number, start and end of the chunks of a recording."""

    def eval(self, duration: float, chunk: float, overlap: float) -> Iterator[tuple[int, float, float]]:
        if duration is None or duration <= 0:
            return
        at = 0
        while True:
            start = at * (chunk - overlap)
            yield at, start, min(start + chunk, duration)
            if start + chunk >= duration:
                return
            at += 1


def register(spark: SparkSession, sf_dir: str | None = None, tables: tuple[str, ...] = ()) -> list[str]:
    """Register the functions, and tables of a folder as views; gives the names."""
    for name, (args, returns, body) in EXPRESSIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}")

    @F.pandas_udf("array<int>")
    def repaired(stamps: pd.Series) -> pd.Series:
        return stamps.map(lambda v: None if v is None else repair_timestamps(list(v)))

    spark.udf.register("repair_timestamps", repaired)
    spark.udtf.register("chunk_plan", F.udtf(ChunkPlan, returnType="chunk_index: int, chunk_start: double, chunk_end: double"))
    for t in tables:
        if sf_dir and os.path.basename(t) == t:
            read_table(spark, sf_dir, t).createOrReplaceTempView(t)
    return [*EXPRESSIONS, "repair_timestamps", "chunk_plan", *tables]
