"""Alignment operators: repair of timestamps, and results of chunks put together again."""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.spans import offset_spans
from voxloom.functions.text import merge_languages, merge_texts

#: Runs of at most so many outliers take the value of the nearer neighbour.
NEAR_RUN = 2


def longest_rising(values: list[float]) -> list[int]:
    """Places of a longest subsequence that never falls; of several the one built from the earliest places.

    Places that end subsequences of one length have falling values, so the
    earliest fitting predecessor is found by binary search.
    """
    tails: list[float] = []
    levels: list[list[int]] = []
    level_of, parent = [], []
    for i, v in enumerate(values):
        k = bisect_right(tails, v)
        if k == len(tails):
            tails.append(v)
            levels.append([])
        else:
            tails[k] = v
        before = -1
        if k:
            row = levels[k - 1]
            lo, hi = 0, len(row) - 1
            while lo < hi:
                mid = (lo + hi) // 2
                if values[row[mid]] <= v:
                    hi = mid
                else:
                    lo = mid + 1
            before = row[lo]
        levels[k].append(i)
        level_of.append(k)
        parent.append(before)
    if not levels:
        return []
    i, out = levels[-1][0], []
    while i >= 0:
        out.append(i)
        i = parent[i]
    return out[::-1]


def repair_timestamps(values: list[float]) -> list[int]:
    """Timestamps that never fall: outliers take a neighbour's value, longer runs are interpolated."""
    keep = longest_rising(values)
    out = [float(v) for v in values]
    for a, b in zip([-1, *keep], [*keep, len(values)]):
        run = b - a - 1
        if run <= 0:
            continue
        left = out[a] if a >= 0 else None
        right = out[b] if b < len(values) else None
        for k in range(1, run + 1):
            if left is None or right is None:
                out[a + k] = right if left is None else left
            elif run <= NEAR_RUN:
                out[a + k] = left if k <= run + 1 - k else right
            else:
                out[a + k] = left + (right - left) / (run + 1) * k
    return [int(v) for v in out]


def repaired(stamps: Column) -> Column:
    """Column of repaired timestamps; null for null."""

    @F.pandas_udf("array<int>")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else repair_timestamps(list(v)))

    return run(stamps)


def merge_chunks(results: DataFrame, parent: str = "orig_index", index: str = "chunk_index", text: str = "text", language: str = "language", spans: str | None = None, offset: str = "offset_sec", separator: str = "") -> DataFrame:
    """One row per recording from its chunks' results in order: text, languages, and spans moved by the chunks' offsets.

    A recording's chunks are bounded by its length over the chunk length.
    """
    fields = [F.col(index).alias("i"), F.col(text).alias("t"), F.col(language).alias("l")]
    if spans:
        fields.append(offset_spans(F.col(spans), F.col(offset)).alias("s"))
    grouped = results.groupBy(parent).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_c"))
    part = lambda name: F.transform("_c", lambda c: c[name])
    out = [parent, merge_languages(part("l")).alias("language"), merge_texts(part("t"), separator).alias("text"), F.size("_c").alias("n_chunks")]
    if spans:
        out.append(F.flatten(F.filter(part("s"), lambda s: s.isNotNull())).alias("time_stamps"))
    return grouped.select(*out)


def timeline(spans: Column) -> Column:
    """Spans of a timeline: those with both times and a positive length."""
    return F.filter(spans, lambda s: F.coalesce(s["end_time"] > s["start_time"], F.lit(False)))
