"""Problem 2: overlapping and gapped time intervals.

Method: an ordered disjoint-interval map for each entity, kept as keyed state;
an insertion locates the intervals it touches by binary search, merges them and
updates the gaps.  The streaming form (``voxloom.streaming.intervals``) keeps the
map in the state store.  In a batch an entity may hold a third of all rows, so
its map is cut along time: rows with the same start are first joined map-side,
each stretch of ``BUCKET_MS`` has a map of its own of at most as many entries as
it has milliseconds, and windows over a few numbers of each stretch carry
overlaps and gaps across the cuts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.session import stage

#: Milliseconds of a stretch; also the most entries that one map can have.
BUCKET_MS = 600_000
#: A pause longer than this is a break, not a gap.
MAX_GAP_MS = 600_000


class IntervalMap:
    """Disjoint intervals in order; touching ones are joined.

    An interval whose end is not after its start is left out.
    """

    def __init__(self, starts: list[int] | None = None, ends: list[int] | None = None):
        self.starts = list(starts or [])
        self.ends = list(ends or [])

    def add(self, start: int, end: int) -> None:
        """Insert an interval: binary search for those it touches, which it then replaces."""
        if end <= start:
            return
        first = bisect_left(self.ends, start)
        last = bisect_right(self.starts, end)
        if first < last:
            start, end = min(start, self.starts[first]), max(end, self.ends[last - 1])
        self.starts[first:last] = [start]
        self.ends[first:last] = [end]

    def periods(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, self.ends))

    def gaps(self, longest: int = MAX_GAP_MS) -> list[tuple[int, int]]:
        """From the end of each period to the next one's start, where that is no break."""
        return [(e, s) for e, s in zip(self.ends, self.starts[1:]) if s - e <= longest]


def clean_segments(df: DataFrame, entity: list[str], start: str = "start_time", end: str = "end_time", speaker: str | None = "spk_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``entity..., start_ms, end_ms`` and the columns of ``keep`` of the segments that count.

    Left out are null and NaN times, ends not after the start, and null or blank
    speakers; a speaker counts without outer blanks and in lower case.
    """
    s, e = F.col(start).cast("double"), F.col(end).cast("double")
    keys = [F.lower(F.regexp_replace(c, r"(?U)^\s+|(?<!\s)\s+$", "")).alias(c) if c == speaker else F.col(c) for c in entity]
    rows = df.where(s.isNotNull() & e.isNotNull() & ~F.isnan(s) & ~F.isnan(e) & (e > s)).select(
        *keys, F.round(s * 1000).cast("long").alias("start_ms"), F.round(e * 1000).cast("long").alias("end_ms"), *keep
    )
    if speaker in entity:
        rows = rows.where(F.col(speaker) != "")
    # A segment that rounds to nothing covers no time.
    return rows.where("end_ms > start_ms")


def _keyed(df: DataFrame, entity: list[str]) -> DataFrame:
    """The entity as one struct, in which a null is a value like any other."""
    return df.select(F.struct(*entity).alias("key"), *[c for c in df.columns if c not in entity])


def _stretches(segments: DataFrame, entity: list[str], bucket_ms: int) -> DataFrame:
    """``key, bucket, starts, ends``: the disjoint periods of each stretch of time in order, from an interval map."""
    # Rows with one start become one, before the shuffle and after it.
    firsts = segments.groupBy(*entity, "start_ms").agg(F.max("end_ms").alias("end_ms"))
    bucket = F.floor(F.col("start_ms") / bucket_ms).cast("long")
    names = [*entity, "bucket"]
    keyed = firsts.withColumn("bucket", bucket).repartition(*names).sortWithinPartitions(*names, "start_ms")

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The stretches come one after another; one map is held at a time."""
        key, state, held, size = None, IntervalMap(), [], 0
        for pdf in batches:
            for *k, s, e in zip(*(pdf[c] for c in names), pdf["start_ms"], pdf["end_ms"]):
                k = tuple(None if pd.isna(x) else x for x in k)
                if k != key:
                    if key is not None:
                        held.append((*key, state.starts, state.ends))
                        size += len(state.starts)
                    key, state = k, IntervalMap()
                state.add(int(s), int(e))
            if size > 50_000:
                yield pd.DataFrame(held, columns=[*names, "starts", "ends"])
                held, size = [], 0
        if key is not None:
            held.append((*key, state.starts, state.ends))
        yield pd.DataFrame(held, columns=[*names, "starts", "ends"])

    types = {f.name: f.dataType.simpleString() for f in keyed.schema.fields}
    schema = ", ".join(f"`{c}` {types[c]}" for c in names) + ", starts array<long>, ends array<long>"
    return _keyed(keyed.mapInPandas(local, schema), entity)


SPAN = "array<struct<kind:string,start_ms:long,end_ms:long>>"


def _spans(segments: DataFrame, entity: list[str], bucket_ms: int, longest: int) -> DataFrame:
    """``entity..., kind, start_ms, end_ms`` of periods and gaps, each found once.

    The maps of the stretches are staged.  A window over one number per stretch
    tells how far earlier ones reach; what begins before that belongs to an
    earlier period.  Periods and gaps between two starts of one stretch are
    whole.  The last period of a stretch ends where the next stretch that begins
    one of its own says, as far as everything before that start reaches, and the
    gap behind it lies before that start; a second window, over the stretches
    that begin a period, tells it.
    """
    maps = stage(_stretches(segments, entity, bucket_ms), "stretches")
    in_order = Window.partitionBy("key").orderBy("bucket")
    far = maps.select("key", "bucket", F.get("ends", F.size("ends") - 1).alias("far"))
    carried = far.select(
        "key", "bucket", F.max("far").over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("carry"),
        F.max("far").over(Window.partitionBy("key")).alias("whole"),
    )
    # Starts and ends rise, so what an earlier period holds is the first n of them.
    held = F.size(F.filter("starts", lambda x: x <= F.col("carry")))
    joined = maps.join(carried, ["key", "bucket"]).withColumn("n", F.when(F.col("carry").isNull(), 0).otherwise(held))
    joined = joined.where(F.col("n") < F.size("starts"))
    last = F.size("starts") - 1
    at = lambda c, i: F.get(F.col(c), i)
    span = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("start_ms"), b.alias("end_ms"))
    places = F.when(F.col("n") < last, F.sequence(F.col("n"), last - 1)).otherwise(F.array().cast("array<int>"))
    gap = lambda a, b: F.when(b - a <= longest, span("gap", a, b))
    inner = F.flatten(F.transform(places, lambda i: F.array(span("period", at("starts", i), at("ends", i)), gap(at("ends", i), at("starts", i + 1)))))
    inside = joined.select("key", F.explode(F.filter(inner.cast(SPAN), lambda x: x.isNotNull())).alias("s"))
    outer = joined.select(
        "key", "bucket", "whole", at("starts", last).alias("start_ms"), at("starts", F.col("n")).alias("first"),
        F.greatest("carry", at("ends", F.col("n") - 1)).alias("before"),
    )
    closed = outer.select(
        "key", "start_ms", F.coalesce(F.lead("before").over(in_order), F.col("whole")).alias("end_ms"), F.lead("first").over(in_order).alias("next")
    )
    ending = F.array(span("period", F.col("start_ms"), F.col("end_ms")), gap(F.col("end_ms"), F.col("next")))
    across = closed.select("key", F.explode(F.filter(ending.cast(SPAN), lambda x: x.isNotNull())).alias("s"))
    return inside.unionByName(across).select("key.*", "s.*")


def covered_periods(segments: DataFrame, entity: list[str], bucket_ms: int = BUCKET_MS) -> DataFrame:
    """``entity..., start_ms, end_ms``: each longest stretch covered by an entity's segments, touching ones joined."""
    return _spans(segments, entity, bucket_ms, -1).drop("kind")


def periods_and_gaps(df: DataFrame, entity: list[str] | None = None, speaker: str | None = "spk_id", longest: int = MAX_GAP_MS, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """``entity..., kind, start_ms, end_ms``: continuous periods and the gaps between them.

    An empty table gives no rows; columns beside the entity and the times are
    not read.  A null in a column of the entity other than the speaker is a
    value of its own.
    """
    entity = entity or ["file_name", "spk_id"]
    return _spans(clean_segments(df, entity, speaker=speaker), entity, bucket_ms, longest).select(*entity, "kind", "start_ms", "end_ms")
