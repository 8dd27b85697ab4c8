"""Streams of audio of any step size, cut again into equal chunks for a recogniser.

The state of a session is its rest of samples, the text so far and a counter.
Chunks go out as soon as they are full; the rest goes out when the session ends,
by an end mark or after ``ttl_seconds`` without input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Inactive sessions are closed after so many seconds.
TTL_SECONDS = 600
OUTPUT = "session_id string, chunk_id long, n_samples long, first_sample long, level double, is_tail boolean"
STATE = "rest array<float>, chunk_id long, emitted long"


@dataclass(frozen=True)
class StreamConfig:
    """Settings of a stream; wrong ones are refused when it is made."""

    chunk_seconds: float = 2.0
    rate: int = 16_000
    unfixed_chunks: int = 2
    unfixed_tokens: int = 5
    ttl_seconds: int = TTL_SECONDS
    language: str | None = None

    def __post_init__(self):
        if self.chunk_seconds <= 0 or self.rate <= 0:
            raise ValueError("chunk_seconds and rate must be positive")
        if self.unfixed_chunks < 0 or self.unfixed_tokens < 0 or self.ttl_seconds <= 0:
            raise ValueError("unfixed_chunks and unfixed_tokens must not be negative, ttl_seconds must be positive")

    @property
    def chunk_samples(self) -> int:
        return max(1, int(round(self.chunk_seconds * self.rate)))


def as_float(samples) -> np.ndarray:
    """One dimension of float samples; 16-bit integers are divided by 32768."""
    x = np.asarray(samples).reshape(-1)
    return x.astype(np.float32) / np.float32(32768.0) if x.dtype == np.int16 else x.astype(np.float32)


def rolled_back(tokens: list, chunk_id: int, config: StreamConfig, decode=None, flush: bool = False) -> list:
    """Tokens kept as the prefix of the next chunk.

    The first chunks have none; later ones lose the last tokens, and more while
    the text they decode to ends in a broken character.  At the end of a stream
    at least one token stays, and broken characters are not looked at.
    """
    if chunk_id < config.unfixed_chunks:
        return []
    if flush:
        return tokens[: max(1, len(tokens) - config.unfixed_tokens)]
    end = max(0, len(tokens) - config.unfixed_tokens)
    while end > 0 and decode is not None and "�" in decode(tokens[:end]):
        end -= 1
    return tokens[:end]


def cut(rest: np.ndarray, more: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Full chunks of the samples so far, and what remains."""
    joined = np.concatenate([rest, more]) if len(rest) else more
    n = len(joined) // size
    return [joined[k * size : (k + 1) * size] for k in range(n)], joined[n * size :]


def rechunk_stream(stream: DataFrame, config: StreamConfig | None = None) -> DataFrame:
    """Chunks of a stream of ``session_id, seq, pcm, is_final``.

    Inputs of one micro-batch are taken in order of ``seq``; null samples count
    as none.  The same chunks come out for any split into micro-batches.
    """
    settings = config or StreamConfig()
    size = settings.chunk_samples

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rest, number, emitted = state.get if state.exists else ([], 0, 0)
        rest = np.asarray(rest, dtype=np.float32)
        rows, closed = [], False

        def emit(part: np.ndarray, tail: bool) -> None:
            nonlocal number, emitted
            rows.append((key[0], number, len(part), emitted, float(np.sqrt((part.astype(np.float64) ** 2).mean())) if len(part) else 0.0, tail))
            number, emitted = number + 1, emitted + len(part)

        if state.hasTimedOut:
            closed = True
        else:
            parts = list(batches)
            pdf = pd.concat(parts).sort_values("seq", kind="stable") if parts else pd.DataFrame(columns=["pcm", "is_final"])
            for pcm, final in zip(pdf["pcm"], pdf["is_final"]):
                full, rest = cut(rest, as_float(pcm) if pcm is not None else np.zeros(0, np.float32), size)
                for part in full:
                    emit(part, False)
                closed = closed or bool(final)
        if closed:
            if len(rest):
                emit(rest, True)
            state.remove()
        else:
            state.update((rest.tolist(), number, emitted))
            state.setTimeoutDuration(settings.ttl_seconds * 1000)
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in OUTPUT.split(", ")])

    return stream.groupBy("session_id").applyInPandasWithState(step, OUTPUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def rechunk_batch(rows: DataFrame, config: StreamConfig | None = None) -> DataFrame:
    """The same chunks from a table of inputs; sessions are read in order of ``seq``, one input held at a time."""
    settings = config or StreamConfig()
    size = settings.chunk_samples
    ordered = rows.repartition("session_id").sortWithinPartitions("session_id", "seq")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [f.split()[0] for f in OUTPUT.split(", ")]
        key, rest, number, emitted = None, np.zeros(0, np.float32), 0, 0

        def row(part: np.ndarray, tail: bool) -> tuple:
            return (key, number, len(part), emitted, float(np.sqrt((part.astype(np.float64) ** 2).mean())), tail)

        for pdf in batches:
            out = []
            for session, pcm in zip(pdf["session_id"], pdf["pcm"]):
                if session != key:
                    if key is not None and len(rest):
                        out.append(row(rest, True))
                    key, rest, number, emitted = session, np.zeros(0, np.float32), 0, 0
                full, rest = cut(rest, as_float(pcm) if pcm is not None else np.zeros(0, np.float32), size)
                for part in full:
                    out.append(row(part, False))
                    number, emitted = number + 1, emitted + len(part)
            yield pd.DataFrame(out, columns=columns)
        if key is not None and len(rest):
            yield pd.DataFrame([row(rest, True)], columns=columns)

    return ordered.select("session_id", "pcm").mapInPandas(run, OUTPUT)
