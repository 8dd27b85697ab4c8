"""Speaker segments: windows, overlaps, gap segmentation, diarization documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.spans import rttm_line
from voxloom.functions.text import name_parts

NO_SPEAKER = "na"


def fixed_windows(segments: DataFrame, file: str = "file_name", start: str = "start_time", end: str = "end_time", speaker: str = "spk_id", size: int = 2) -> DataFrame:
    """``file, w_start, w_end, speakers``: the distinct speakers of each window of ``size`` seconds, ``na`` for none.

    Windows start at the multiples of the size below the whole part of the last
    end plus one size.  A segment is in a window when the two overlap by more
    than a point.  Each segment meets only its own windows: it is exploded to
    their numbers and grouped, so there is no interval join.
    """
    ends = segments.groupBy(file).agg(F.max(end).alias("_last"))
    grid = ends.where("_last is not null").select(
        file, F.explode(F.sequence(F.lit(0), F.greatest(F.ceil((F.floor("_last") + size) / size).cast("int") - 1, F.lit(0)))).alias("_w")
    )
    first = F.floor(F.col(start) / size).cast("int")
    last = (F.ceil(F.col(end) / size) - 1).cast("int")
    hits = segments.where((F.col(end) > F.col(start)) & F.col(speaker).isNotNull()).select(
        file, speaker, F.explode(F.sequence(F.greatest(first, F.lit(0)), F.greatest(last, first, F.lit(0)))).alias("_w")
    )
    # Repeats go map-side first, so a window of many segments of one speaker is one row.
    spoken = hits.distinct().groupBy(file, "_w").agg(F.array_sort(F.collect_set(speaker)).alias("speakers"))
    return grid.join(spoken, [file, "_w"], "left").select(
        file, (F.col("_w") * size).alias("w_start"), ((F.col("_w") + 1) * size).alias("w_end"), F.coalesce("speakers", F.array(F.lit(NO_SPEAKER))).alias("speakers")
    )


def overlap_length(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length of the overlap of two intervals, 0 for none."""
    return F.greatest(F.least(a_end, b_end) - F.greatest(a_start, b_start), F.lit(0.0))


def overlap_join(left: DataFrame, right: DataFrame, key: str, bucket: float = 30.0, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Pairs of intervals of one key that overlap; the right side's columns get the prefix ``r_``.

    Both sides are exploded to buckets of time and joined on key and bucket; a
    pair is kept in the bucket where its overlap begins, so it comes out once.
    Long intervals cost one row per bucket, never a join of all with all.
    """
    def cut(df: DataFrame, prefix: str) -> DataFrame:
        named = df.select(*[F.col(f"`{c}`").alias(prefix + c if c != key else c) for c in df.columns])
        s, e = F.col(prefix + start), F.col(prefix + end)
        return named.where(e > s).withColumn("_b", F.explode(F.sequence(F.floor(s / bucket).cast("long"), F.floor(e / bucket).cast("long"))))

    pairs = cut(left, "").join(cut(right, "r_"), [key, "_b"])
    begin = F.greatest(F.col(start), F.col("r_" + start))
    ok = (begin < F.least(F.col(end), F.col("r_" + end))) & (F.col("_b") == F.floor(begin / bucket).cast("long"))
    return pairs.where(ok).drop("_b")


def gap_segments(rows: DataFrame, file: str, words: str = "words", alignments: str = "alignments", gap: float = 1.5, keep: tuple[str, ...] = ()) -> DataFrame:
    """Words cut into segments where neighbouring alignments lie more than ``gap`` apart.

    One row per segment and row of the input: ``file``, ``keep``, ``segment``
    (from 0), its words and alignments.  Rows without words or alignments give
    none; surplus ones of the longer list are left out.  Arrays are cut in place
    by their break points, so nothing is shuffled.
    """
    n = F.least(F.size(words), F.size(alignments))
    # Break points: the start, every place behind a long gap, and the end.
    base = rows.where((F.size(words) > 0) & (F.size(alignments) > 0)).withColumn("_n", n)
    inner = F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: (i == 0) | (F.get(F.col(alignments), i) - F.get(F.col(alignments), i - 1) > gap))
    cut = base.withColumn("_from", inner).select(file, *keep, words, alignments, "_n", "_from", F.posexplode("_from").alias("segment", "_at"))
    until = F.coalesce(F.get("_from", F.col("segment") + 1), F.col("_n"))
    part = lambda c: F.slice(c, F.col("_at") + 1, until - F.col("_at"))
    return cut.select(file, *keep, "segment", part(words).alias(words), part(alignments).alias(alignments))


def gap_sessions(rows: DataFrame, key: str, at: Column, gap: float) -> DataFrame:
    """Rows numbered by session: a new one begins where more than ``gap`` lies behind the row before."""
    w = Window.partitionBy(key).orderBy("_at")
    step = rows.withColumn("_at", at).withColumn("_new", F.coalesce((F.col("_at") - F.lag("_at").over(w) > gap).cast("int"), F.lit(1)))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return step.withColumn("session", F.sum("_new").over(running).cast("long")).drop("_new")


def running_reach(segments: DataFrame, file: str, start: str = "start_time", end: str = "end_time", bucket: float = 600.0) -> DataFrame:
    """Each segment with ``reach``, the furthest end up to it in order of start.

    Within a stretch of ``bucket`` seconds by a window; how far the stretches
    before reach, by a window over one row for each, so no task holds a file.
    """
    cut = segments.withColumn("_b", F.floor(F.col(start) / bucket).cast("long"))
    before = Window.partitionBy(file).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut.groupBy(file, "_b").agg(F.max(end).alias("_far")).select(F.col(file).alias("_f"), F.col("_b").alias("_c"), F.max("_far").over(before).alias("_carry"))
    inside = Window.partitionBy(file, "_b").orderBy(start, end).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = cut.join(carried, F.col(file).eqNullSafe(F.col("_f")) & F.col("_b").eqNullSafe(F.col("_c")), "left")
    return joined.withColumn("reach", F.greatest(F.max(end).over(inside), F.col("_carry"))).drop("_b", "_f", "_c", "_carry")


def file_summary(segments: DataFrame, file: str = "file_name", start: str = "start_time", end: str = "end_time", speaker: str = "spk_id") -> DataFrame:
    """Segments, distinct speakers, last end and total length of each file."""
    return segments.groupBy(file).agg(
        F.count("*").alias("n_segments"),
        F.count_distinct(speaker).alias("n_speakers"),
        F.max(end).alias("last_end"),
        F.sum(F.when(F.col(end) > F.col(start), F.col(end) - F.col(start))).alias("total_span"),
    )


def diarization_documents(segments: DataFrame, file: str = "file_name", start: str = "start_time", end: str = "end_time", speaker: str = "spk_id", position: str = "seg_id", bucket: float | None = None) -> DataFrame:
    """One document for each file: parts of its name, number of speakers, and its segments by start, then input position.

    A document holds all segments of its file, as its format wants; ``bucket``
    gives one document for each stretch of so many seconds of a file instead,
    which bounds a document of an endless recording.
    """
    keys = [F.col(file)] + ([F.floor(F.col(start) / bucket).cast("long").alias("part")] if bucket else [])
    entry = F.struct(F.col(start).alias("start_time"), F.col(position).alias("_p"), F.col(end).alias("end_time"), F.col(speaker).alias("spk_id"))
    grouped = segments.groupBy(*keys).agg(F.count_distinct(speaker).alias("num_speaker"), F.array_sort(F.collect_list(entry)).alias("_e"))
    part = name_parts(F.col(file))
    return grouped.select(
        file, *(["part"] if bucket else []), part["sub_folder"].alias("sub_folder"), part["id"].alias("id"), "num_speaker",
        F.transform("_e", lambda x: F.struct(x["start_time"].alias("start_time"), x["end_time"].alias("end_time"), x["spk_id"].alias("spk_id"))).alias("speaker_diarization"),
    )


def rttm_lines(segments: DataFrame, file: str = "file_name", start: str = "start_time", end: str = "end_time", speaker: str = "spk_id", standard: bool = True) -> DataFrame:
    """RTTM lines with their file, start and speaker for ordering; segments with a null part are left out."""
    ok = segments.where(F.col(start).isNotNull() & F.col(end).isNotNull() & F.col(speaker).isNotNull())
    return ok.select(file, speaker, start, rttm_line(F.col(file), F.col(start), F.col(end), F.col(speaker), standard).alias("value"))


def hysteresis_segments(frames: DataFrame, key: list[str], frame: str, probability: str, frame_seconds: float, onset: float = 0.877, offset: float = 0.427, pad_onset: float = 0.0, pad_offset: float = 0.0, min_on: float = 0.487, min_off: float = 0.245) -> DataFrame:
    """Speech segments from frame probabilities: on at ``onset``, off below ``offset``, short pauses filled, short segments dropped.

    A frame between the thresholds keeps the state before it, which the last
    decided frame gives.
    """
    w = Window.partitionBy(*key).orderBy(frame)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mark = F.when(F.col(probability) >= onset, 1).when(F.col(probability) < offset, 0)
    state = frames.withColumn("_on", F.coalesce(F.last(mark, ignorenulls=True).over(upto), F.lit(0)))
    step = state.withColumn("_new", (F.col("_on") != F.coalesce(F.lag("_on").over(w), F.lit(-1))).cast("int"))
    runs = step.withColumn("_run", F.sum("_new").over(upto)).where("_on = 1").groupBy(*key, "_run").agg(F.min(frame).alias("_a"), F.max(frame).alias("_b"))
    spans = runs.select(*key, F.greatest(F.col("_a") * frame_seconds - pad_onset, F.lit(0.0)).alias("_s"), ((F.col("_b") + 1) * frame_seconds + pad_offset).alias("_e"))
    by = Window.partitionBy(*key).orderBy("_s")
    far = F.max("_e").over(by.rowsBetween(Window.unboundedPreceding, -1))
    joined = spans.withColumn("_new", F.coalesce((F.col("_s") - far >= min_off).cast("int"), F.lit(1)))
    islands = joined.withColumn("_g", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = islands.groupBy(*key, "_g").agg(F.min("_s").alias("start_time"), F.max("_e").alias("end_time"))
    return out.where(F.col("end_time") - F.col("start_time") >= min_on).drop("_g")
