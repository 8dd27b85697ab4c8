"""Functions on arrays of time spans, alignments and lengths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<text:string,start_time:double,end_time:double>>"


def duration_seconds(samples: Column, rate: Column | int) -> Column:
    """Length of a waveform in seconds; 0 for a null one."""
    return F.coalesce(F.array_size(samples), F.lit(0)) / (F.lit(rate) if isinstance(rate, int) else rate)


def uniform_alignments(words: Column, duration: Column, places: int | None = 3) -> Column:
    """End times of words spread evenly over a recording, to three places unless told otherwise."""
    n = F.size(words)
    even = lambda i: F.least((i + 1) * duration / n, duration)
    return F.transform(words, lambda _, i: even(i) if places is None else F.round(even(i), places))


def word_entry(text: Column, duration: Column, places: int | None = 3) -> Column:
    """Struct of ``words`` and ``alignments`` of a manifest: the words and a closing empty one with even end times.

    A text without words gives ``speech`` and an empty word with the last tenth
    of a second between them.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")
    full = F.array_append(words, F.lit(""))
    has = F.size(words) > 0
    return F.struct(
        F.when(has, full).otherwise(F.array(F.lit("speech"), F.lit(""))).alias("words"),
        F.when(has, uniform_alignments(full, duration, places)).otherwise(F.array(F.greatest(duration - 0.1, F.lit(0.0)), duration)).alias("alignments"),
    )


def sound_spans(spans: Column) -> Column:
    """Spans with a positive length and a text that is not blank."""
    return F.filter(spans, lambda s: (s["end_time"] > s["start_time"]) & (F.trim(F.coalesce(s["text"], F.lit(""))) != ""))


def two_halves(spans: Column, duration: Column, first: str = "speech_part1", second: str = "speech_part2") -> Column:
    """The spans, or two halves of the recording where there are fewer than two."""
    half = duration / 2
    make = lambda t, a, b: F.struct(F.lit(t).alias("text"), a.cast("double").alias("start_time"), b.cast("double").alias("end_time"))
    return F.when(F.size(spans) < 2, F.array(make(first, F.lit(0.0), half), make(second, half, duration))).otherwise(spans)


def triples_to_spans(triples: Column) -> Column:
    """``[start, end, word]`` lists read as strings into spans; a list of another length is left out."""
    kept = F.filter(triples, lambda t: F.size(t) == 3)
    return F.transform(kept, lambda t: F.struct(F.trim(t[2]).alias("text"), t[0].try_cast("double").alias("start_time"), t[1].try_cast("double").alias("end_time")))


def end_times(spans: Column) -> Column:
    """Struct of ``words`` and ``alignments`` (end times) of the sound spans; ``speech`` at 1.0 where there is none."""
    kept = sound_spans(spans)
    has = F.size(kept) > 0
    return F.struct(
        F.when(has, F.transform(kept, lambda s: F.trim(s["text"]))).otherwise(F.array(F.lit("speech"))).alias("words"),
        F.when(has, F.transform(kept, lambda s: s["end_time"])).otherwise(F.array(F.lit(1.0))).alias("alignments"),
    )


def offset_spans(spans: Column, offset: Column) -> Column:
    """Spans moved by an offset, to three places."""
    return F.transform(
        spans,
        lambda s: F.struct(s["text"].alias("text"), F.round(s["start_time"] + offset, 3).alias("start_time"), F.round(s["end_time"] + offset, 3).alias("end_time")),
    )


def pair_timestamps(words: Column, stamps_ms: Column) -> Column:
    """Two timestamps in milliseconds for each word into spans in seconds; missing ones are null."""
    at = lambda i: (F.get(stamps_ms, i) / 1000.0)
    return F.transform(words, lambda w, i: F.struct(w.alias("text"), at(i * 2).alias("start_time"), at(i * 2 + 1).alias("end_time")))


def stamp_tokens(output: Column) -> Column:
    """The numbers of ``<|n|>`` or ``<n>`` time marks in an aligner's output."""
    return F.transform(F.regexp_extract_all(output, F.lit(r"<\|?(\d+)\|?>"), F.lit(1)), lambda x: x.cast("int"))


def within_duration(alignments: Column, duration: Column) -> Column:
    """Whether the last alignment lies inside the recording; an empty list does."""
    return F.coalesce(F.array_max(alignments) <= duration, F.lit(True))


def feature_length(samples: Column) -> Column:
    """Frames behind the convolutions for a number of feature frames: full hundreds give 13 each."""
    left = F.pmod(samples, F.lit(100))
    halved = F.floor((left - 1) / 2) + 1
    again = F.floor((halved - 1) / 2) + 1
    return (F.floor((again - 1) / 2) + 1 + F.floor(samples / 100) * 13).cast("long")


def value_chunks(values: Column, size: int) -> Column:
    """(start, end) places of runs whose values lie in the same block of ``size``; values must not fall."""
    block = F.transform(values, lambda v: F.floor(v / size).cast("long"))
    starts = F.filter(F.sequence(F.lit(0), F.size(values) - 1), lambda i: (i == 0) | (F.get(block, i) != F.get(block, i - 1)))
    ends = lambda k: F.coalesce(F.get(starts, k + 1), F.size(values))
    runs = F.transform(starts, lambda s, k: F.struct(s.alias("start"), ends(k).alias("end")))
    return F.when(F.size(values) > 0, runs).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def _positions(mask: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(mask), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ones = pc.fill_null(pc.list_flatten(mask), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    run = np.concatenate([[0], np.cumsum(ones)])
    out = np.where(ones == 0, 1, run[1:] - np.repeat(run[offsets[:-1]], sizes) - 1)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out.astype(np.int32)), mask=mask.is_null())


def mask_positions(mask: Column) -> Column:
    """Running count of ones less one, and 1 where the mask is 0; null for null, and a null entry counts as 0."""
    return F.arrow_udf(_positions, "array<int>")(mask.cast("array<int>"))


def label_mask(ids: Column, prefix: Column, ignore: int = -100) -> Column:
    """Labels of a training row: the ids, with the first ``prefix`` of them ignored."""
    return F.transform(ids, lambda x, i: F.when(i < prefix, F.lit(ignore)).otherwise(x))


def long_spans(spans: Column, least: float = 0.01) -> Column:
    """Spans longer than ``least`` seconds."""
    return F.filter(spans, lambda s: F.coalesce(s["end_time"] - s["start_time"] > least, F.lit(False)))


def enough_alignments(alignments: Column, least: int = 2) -> Column:
    """Whether a row has so many alignments; a null list has none."""
    return F.coalesce(F.size(alignments) >= least, F.lit(False))


def window_label(labels: Column, at: Column, size: float = 2.0) -> Column:
    """The label of the window of ``size`` seconds that holds a moment; null beyond the last one."""
    return F.get(labels, F.floor(at / size).cast("int"))


def rttm_line(name: Column, start: Column, end: Column, speaker: Column, standard: bool = True) -> Column:
    """One RTTM line to three places; the second number is the length, or the end time where ``standard`` is off."""
    second = end - start if standard else end
    return F.format_string("SPEAKER %s 1 %.3f %.3f <NA> <NA> %s <NA> <NA>", name, start, second, speaker)


def segment_struct(line: Column) -> Column:
    """``start end speaker`` in one string into a struct; nulls where a part is missing."""
    part = F.split(F.trim(line), r"\s+")
    return F.struct(F.get(part, F.lit(0)).try_cast("double").alias("start_time"), F.get(part, F.lit(1)).try_cast("double").alias("end_time"), F.get(part, F.lit(2)).alias("speaker"))
