"""External models as functions over batches: one load for each worker, faults kept to their row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.spans import segment_struct
from voxloom.functions.text import parse_asr_output
from voxloom.operators.align import merge_chunks
from voxloom.operators.audio import MAX_ALIGN_SECONDS, quiet_chunks


@dataclass
class BatchModel:
    """A model: ``load`` builds it once in a worker, ``predict`` answers a list of inputs.

    ``result_type`` is the Spark type of an answer.
    """

    name: str
    load: Callable[[], Any]
    predict: Callable[[Any, list], list]
    result_type: str = "string"
    batch_size: int = 8


def replay_model(name: str, answers: dict, result_type: str = "string", default: Any = None) -> BatchModel:
    """A model that repeats recorded answers, for tests."""
    return BatchModel(name, lambda: answers, lambda table, inputs: [table.get(x, default) for x in inputs], result_type)


def _answer(model: BatchModel, loaded: Any, inputs: list) -> list[tuple[Any, str | None]]:
    """Answers of a batch; if it fails, each input is asked alone and a failing one is recorded."""
    try:
        got = model.predict(loaded, inputs)
        if len(got) != len(inputs):
            raise ValueError(f"{len(got)} answers to {len(inputs)} inputs")
        return [(x, None) for x in got]
    except Exception as e:  # noqa: BLE001
        if len(inputs) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        return [pair for x in inputs for pair in _answer(model, loaded, [x])]


def apply_model(df: DataFrame, model: BatchModel, input_col: str, output_col: str = "result", skip_blank: str | None = None) -> DataFrame:
    """The rows with ``output_col`` (the answer), ``<output_col>_error`` and ``<output_col>_model``.

    Null inputs, and blank ones where ``skip_blank`` gives their answer, do not
    reach the model.
    """
    fields = df.schema.fields

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loaded = None
        for pdf in batches:
            out: list[tuple[Any, str | None]] = [(None, None)] * len(pdf)
            todo = []
            for k, x in enumerate(pdf[input_col]):
                if x is None:
                    continue
                if skip_blank is not None and isinstance(x, str) and not x.strip():
                    out[k] = (skip_blank, None)
                else:
                    todo.append((k, x))
            if todo and loaded is None:
                loaded = model.load()
            for at in range(0, len(todo), model.batch_size):
                part = todo[at : at + model.batch_size]
                for (k, _), pair in zip(part, _answer(model, loaded, [x for _, x in part])):
                    out[k] = pair
            yield pdf.assign(**{output_col: pd.Series([a for a, _ in out], index=pdf.index, dtype=object), f"{output_col}_error": [e for _, e in out], f"{output_col}_model": model.name})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return df.mapInPandas(run, f"{schema}, `{output_col}` {model.result_type}, `{output_col}_error` string, `{output_col}_model` string")


def diarize(audio: DataFrame, model: BatchModel, id_col: str, samples: str) -> DataFrame:
    """``file_name, seg_id, start_time, end_time, spk_id`` of a model that answers each waveform with lines ``start end speaker``.

    Lines that are not of that form are left out; a null waveform gives none.
    """
    answered = apply_model(audio.select(F.col(id_col).cast("string").alias("file_name"), F.col(samples).alias("wav")), model, "wav", "lines")
    rows = answered.select("file_name", F.posexplode("lines").alias("p", "line")).select("file_name", "p", segment_struct(F.col("line")).alias("s"))
    good = rows.where(F.col("s.start_time").isNotNull() & F.col("s.end_time").isNotNull() & F.col("s.speaker").isNotNull())
    return good.select("file_name", F.col("p").cast("long").alias("seg_id"), "s.start_time", "s.end_time", F.col("s.speaker").alias("spk_id"))


def recognised(chunks: DataFrame, asr: BatchModel, aligner: BatchModel | None = None, language: str | None = None, separator: str = " ") -> DataFrame:
    """``orig_index, language, text, n_chunks`` and, with an aligner, ``time_stamps`` of recordings whose chunks are ``id, chunk_index, offset_sec, chunk``."""
    raw = apply_model(chunks, asr, "chunk", "raw")
    forced = F.lit(language) if language else None
    parsed = raw.select("id", "chunk_index", "offset_sec", parse_asr_output(F.col("raw"), forced).alias("p")).select("id", "chunk_index", "offset_sec", "p.*")
    if aligner:
        parsed = apply_model(parsed, aligner, "text", "spans")
    return merge_chunks(parsed.withColumnRenamed("id", "orig_index"), spans="spans" if aligner else None, separator=separator)


@dataclass
class Recogniser:
    """The recognition pipeline over recorded or real models: chunks, answers, languages, spans, whole recordings."""

    asr: BatchModel
    aligner: BatchModel | None = None
    max_seconds: float = 1200.0
    languages: list[str] = field(default_factory=list)

    def transcribe(self, audio: DataFrame, id_col: str, samples: str, language: str | None = None, context: str = "") -> DataFrame:
        """``orig_index, language, text, n_chunks`` and, with an aligner, ``time_stamps``."""
        if language is not None and self.languages and language not in self.languages:
            raise ValueError(f"language {language!r} is not supported")
        limit = min(self.max_seconds, MAX_ALIGN_SECONDS) if self.aligner else self.max_seconds
        chunks = quiet_chunks(audio, samples, id_col, max_seconds=limit).withColumn("context", F.lit(context))
        return recognised(chunks, self.asr, self.aligner, language, separator="")
