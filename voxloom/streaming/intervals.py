"""Periods and gaps of a stream of segments: an interval map for each entity in the state store."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from voxloom.operators.intervals import MAX_GAP_MS, IntervalMap, clean_segments

STATE = "starts array<long>, ends array<long>, version long"


def interval_updates(stream: DataFrame, entity: list[str] | None = None, longest_gap: int = MAX_GAP_MS, speaker: str | None = "spk_id") -> DataFrame:
    """After each micro-batch all periods and gaps of every entity that it touched, for entities of bounded length.

    ``interval_changes`` tells only what changed and forgets what is over.

    Rows are ``entity..., version, kind, start_ms, end_ms``; those of the highest
    version of an entity are its present state, those of lower ones are history.
    Segments may come late and in any order: inserting is the same in every one.
    """
    entity = entity or ["file_name", "spk_id"]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        starts, ends, version = state.get if state.exists else ([], [], 0)
        held = IntervalMap(starts, ends)
        for pdf in batches:
            for s, e in zip(pdf["start_ms"], pdf["end_ms"]):
                held.add(int(s), int(e))
        state.update((held.starts, held.ends, version + 1))
        rows = [(*key, version + 1, "period", s, e) for s, e in held.periods()] + [(*key, version + 1, "gap", s, e) for s, e in held.gaps(longest_gap)]
        yield pd.DataFrame(rows, columns=[*entity, "version", "kind", "start_ms", "end_ms"])

    clean = clean_segments(stream, entity, speaker=speaker)
    types = {f.name: f.dataType.simpleString() for f in clean.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in entity) + ", version long, kind string, start_ms long, end_ms long"
    return clean.groupBy(*entity).applyInPandasWithState(step, schema, STATE, "update", GroupStateTimeout.NoTimeout)


OPEN_STATE = "starts array<long>, ends array<long>, gone long, seen long"


def changed(before: set[tuple], after: set[tuple]) -> list[tuple]:
    """Rows that went and rows that came, as (change, row...)."""
    return [("remove", *x) for x in sorted(before - after)] + [("add", *x) for x in sorted(after - before)]


def interval_changes(
    stream: DataFrame, arrived: str, delay: str = "1 hour", horizon_ms: int = 3_600_000, entity: list[str] | None = None,
    longest_gap: int = MAX_GAP_MS, speaker: str | None = "spk_id",
) -> DataFrame:
    """What each micro-batch changes: ``entity..., change, kind, start_ms, end_ms`` with ``add`` and ``remove`` of periods and gaps.

    Periods that end more than ``horizon_ms`` before the entity's furthest end
    are over and leave the state; of a segment that begins before them comes one
    row ``late`` instead of a change, so nothing is lost unseen.  An entity of
    which nothing arrived for ``delay``, by the watermark on ``arrived``, leaves
    the state whole.  The state is bounded by the horizon and the entities that
    are active, and what goes out by what changed.
    """
    entity = entity or ["file_name", "spk_id"]
    names = [*entity, "change", "kind", "start_ms", "end_ms"]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([], columns=names)
            return
        starts, ends, gone, seen = state.get if state.exists else ([], [], None, 0)
        held = IntervalMap(starts, ends)
        told = lambda: {("period", *p) for p in held.periods()} | {("gap", *g) for g in held.gaps(longest_gap)}
        before, late = told(), []
        for pdf in batches:
            for s, e, at in zip(pdf["start_ms"], pdf["end_ms"], pdf["arrived_ms"]):
                seen = max(seen, int(at))
                if gone is not None and s <= gone:
                    late.append(("add", "late", int(s), int(e)))
                else:
                    held.add(int(s), int(e))
        rows = changed(before, told()) + late
        # The newest of the periods that are over stays for the gap behind it.
        while len(held.ends) > 1 and held.ends[1] < held.ends[-1] - horizon_ms:
            gone = held.ends.pop(0)
            held.starts.pop(0)
        state.update((held.starts, held.ends, gone, seen))
        state.setTimeoutTimestamp(max(seen, state.getCurrentWatermarkMs()) + delay_ms)
        yield pd.DataFrame([(*key, *r) for r in rows], columns=names)

    delay_ms = int(pd.Timedelta(delay).total_seconds() * 1000)
    clean = clean_segments(stream, entity, speaker=speaker, keep=(arrived,)).withWatermark(arrived, delay)
    clean = clean.withColumn("arrived_ms", F.unix_millis(arrived))
    types = {f.name: f.dataType.simpleString() for f in clean.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in entity) + ", change string, kind string, start_ms long, end_ms long"
    return clean.groupBy(*entity).applyInPandasWithState(step, schema, OPEN_STATE, "append", GroupStateTimeout.EventTimeTimeout)
