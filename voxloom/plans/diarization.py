"""Speaker segments: windows, documents, overlaps, gap segmentation, speech and silence."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import spans as S
from voxloom.functions import text as T
from voxloom.operators import audio, intervals, segments
from voxloom.plans.registry import query
from voxloom.session import read_table

_OK = "SELECT * FROM diar_segments WHERE NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time AND spk_id IS NOT NULL"


def _segments(spark, sf):
    rows = read_table(spark, sf, "diar_segments")
    return rows.where("not isnan(start_time) and not isnan(end_time) and end_time > start_time and spk_id is not null")


@query(
    rf"""WITH s AS ({_OK}), l AS (SELECT file_name, max(end_time) AS m FROM s GROUP BY 1),
  g AS (SELECT file_name, unnest(range(0, floor(m)::BIGINT + 2, 2)) AS w FROM l),
  h AS (SELECT DISTINCT file_name, spk_id, unnest(range((floor(start_time / 2) * 2)::BIGINT, ceil(end_time / 2)::BIGINT * 2, 2)) AS w FROM s),
  a AS (SELECT file_name, w, list(spk_id ORDER BY spk_id) AS speakers FROM h GROUP BY 1, 2)
  SELECT file_name, w AS w_start, w + 2 AS w_end, coalesce(speakers, ['na']) AS speakers FROM g LEFT JOIN a USING (file_name, w)"""
)
def speaker_windows(spark, sf):
    """Distinct speakers in each two seconds of a file."""
    return segments.fixed_windows(_segments(spark, sf))


@query(
    rf"""WITH s AS ({_OK}) SELECT file_name, count(*) AS n_segments, count(DISTINCT spk_id) AS n_speakers, max(end_time) AS last_end,
    round(sum(end_time - start_time), 4) AS total_span FROM s GROUP BY 1"""
)
def file_summaries(spark, sf):
    return segments.file_summary(_segments(spark, sf)).withColumn("total_span", F.round("total_span", 4))


@query(
    rf"""WITH s AS ({_OK}) SELECT file_name, count(*) AS num_speaker_rows, count(DISTINCT spk_id) AS num_speaker,
    array_to_string(string_split(file_name, '_')[1:3], '_') AS sub_folder, array_to_string(string_split(file_name, '_')[4:], '_') AS id,
    list(start_time ORDER BY start_time, seg_id) AS starts, list(spk_id ORDER BY start_time, seg_id) AS speakers FROM s GROUP BY 1"""
)
def diarization_files(spark, sf):
    """One document for each file, its segments stably ordered by start."""
    docs = segments.diarization_documents(_segments(spark, sf))
    part = lambda c: F.transform("speaker_diarization", lambda x: x[c])
    return docs.select("file_name", F.size("speaker_diarization").cast("long").alias("num_speaker_rows"), "num_speaker", "sub_folder", "id", part("start_time").alias("starts"), part("spk_id").alias("speakers"))


@query(rf"""WITH s AS ({_OK}) SELECT file_name, printf('SPEAKER %s 1 %.3f %.3f <NA> <NA> %s <NA> <NA>', file_name, start_time, end_time, spk_id) AS value FROM s""")
def rttm_with_ends(spark, sf):
    """RTTM lines in the form that holds end times."""
    return segments.rttm_lines(_segments(spark, sf), standard=False).select("file_name", "value")


@query(
    rf"""WITH s AS ({_OK}),
  p AS (SELECT a.file_name, a.seg_id AS x, b.seg_id AS y, least(a.end_time, b.end_time) - greatest(a.start_time, b.start_time) AS o
        FROM s a JOIN s b ON a.file_name = b.file_name AND a.seg_id < b.seg_id AND a.spk_id <> b.spk_id
        AND a.start_time < b.end_time AND b.start_time < a.end_time)
  SELECT file_name, count(*) AS n_overlaps, round(sum(o), 4) AS overlap_sec FROM p GROUP BY 1"""
)
def speaker_overlaps(spark, sf):
    """Overlaps of different speakers in each file: pairs met in buckets of time, counted where they meet."""
    rows = _segments(spark, sf).select("file_name", "seg_id", "spk_id", "start_time", "end_time")
    pairs = segments.overlap_join(rows, rows, "file_name").where("seg_id < r_seg_id and spk_id <> r_spk_id")
    length = segments.overlap_length(F.col("start_time"), F.col("end_time"), F.col("r_start_time"), F.col("r_end_time"))
    return pairs.groupBy("file_name").agg(F.count("*").alias("n_overlaps"), F.round(F.sum(length), 4).alias("overlap_sec"))


@query(
    r"""WITH s AS (SELECT file_name, round(start_time * 1000)::BIGINT AS s, round(end_time * 1000)::BIGINT AS e FROM diar_segments
    WHERE NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time),
  m AS (SELECT *, max(e) OVER (PARTITION BY file_name ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM s WHERE e > s)
  SELECT file_name, sum(greatest(e - greatest(s, coalesce(far, s)), 0))::BIGINT AS speech_ms,
         (max(e) - min(s) - sum(greatest(e - greatest(s, coalesce(far, s)), 0)))::BIGINT AS silence_ms FROM m GROUP BY 1"""
)
def speech_and_silence(spark, sf):
    """Time covered by any speaker of a file, and what is left between its first and last moment."""
    clean = intervals.clean_segments(read_table(spark, sf, "diar_segments"), ["file_name"], speaker=None)
    p = intervals.covered_periods(clean, ["file_name"])
    speech = F.sum(F.col("end_ms") - F.col("start_ms"))
    return p.groupBy("file_name").agg(speech.alias("speech_ms"), (F.max("end_ms") - F.min("start_ms") - speech).alias("silence_ms"))


@query(
    rf"""WITH s AS ({_OK}) SELECT seg_id, max(end_time) OVER (PARTITION BY file_name ORDER BY start_time, end_time
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reach FROM s"""
)
def furthest_ends(spark, sf):
    return segments.running_reach(_segments(spark, sf), "file_name").select("seg_id", "reach")


@query(
    r"""WITH a AS (SELECT file_name, generate_subscripts(speakers, 1) AS i, unnest(speakers) AS x FROM diar_short),
  b AS (SELECT file_name, i, x.start_time AS t, coalesce(x.start_time - lag(x.start_time) OVER (PARTITION BY file_name ORDER BY i) > 1.5, i = 1) AS fresh FROM a),
  c AS (SELECT *, sum(coalesce(fresh, false)::INT) OVER (PARTITION BY file_name ORDER BY i) - 1 AS segment FROM b)
  SELECT file_name, segment::BIGINT AS segment, list(t ORDER BY i) AS alignments FROM c GROUP BY 1, 2"""
)
def gap_segments(spark, sf):
    """Starts of segments cut where more than one and a half seconds lie between neighbours."""
    rows = read_table(spark, sf, "diar_short").select("file_name", F.transform("speakers", lambda s: s["speaker"]).alias("words"), F.transform("speakers", lambda s: s["start_time"]).alias("alignments"))
    return segments.gap_segments(rows, "file_name").select("file_name", F.col("segment").cast("long").alias("segment"), "alignments")


@query(
    r"""WITH c AS (SELECT tr_id, duration_sec AS d, CASE WHEN duration_sec <= 30 THEN 1 ELSE ceil((duration_sec - 30) / 29) + 1 END::BIGINT AS n FROM transcript_rows WHERE duration_sec > 0),
  e AS (SELECT tr_id, d, unnest(range(n)) AS chunk_index FROM c)
  SELECT tr_id, chunk_index, (chunk_index * 29)::DOUBLE AS chunk_start, least(chunk_index * 29 + 30, d) AS chunk_end FROM e"""
)
def chunk_plans(spark, sf):
    """Thirty-second chunks with a second of overlap for each recording."""
    rows = read_table(spark, sf, "transcript_rows").where("duration_sec > 0").select("tr_id", F.posexplode(audio.chunk_plan(F.col("duration_sec"))).alias("chunk_index", "c"))
    return rows.select("tr_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("c.start").alias("chunk_start"), F.col("c.end").alias("chunk_end"))


@query(
    r"""WITH w AS (SELECT tr_id, duration_sec AS d, list_filter(regexp_split_to_array(coalesce(transcription, ''), '[\t\n\v\f\r \x{85}\p{Z}]+'), lambda x: x <> '') AS ws
    FROM transcript_rows WHERE duration_sec > 0),
  f AS (SELECT tr_id, d, CASE WHEN len(ws) > 0 THEN list_append(ws, '') ELSE ['speech', ''] END AS words, len(ws) > 0 AS has FROM w)
  SELECT tr_id, len(words) AS n_words, CASE WHEN has THEN list_transform(range(1, len(words) + 1), lambda i: least(i * d / len(words), d))
    ELSE [greatest(d - 0.1, 0.0), d] END AS alignments FROM f"""
)
def uniform_alignments(spark, sf):
    """Words of a manifest with evenly spread end times."""
    rows = read_table(spark, sf, "transcript_rows").where("duration_sec > 0")
    return rows.select("tr_id", S.word_entry(F.col("transcription"), F.col("duration_sec"), places=None).alias("e")).select("tr_id", F.size("e.words").cast("long").alias("n_words"), F.col("e.alignments").alias("alignments"))


@query(
    r"""SELECT file_name, list_transform(speakers, lambda x: struct_pack(t := x.speaker, a := round(x.start_time + 12.5, 3), b := round(x.end_time + 12.5, 3))) AS moved
  FROM diar_short WHERE speakers IS NOT NULL"""
)
def moved_spans(spark, sf):
    """Spans moved by an offset."""
    rows = read_table(spark, sf, "diar_short").where("speakers is not null")
    spans = F.transform("speakers", lambda s: F.struct(s["speaker"].alias("text"), s["start_time"].alias("start_time"), s["end_time"].alias("end_time")))
    return rows.select("file_name", F.transform(S.offset_spans(spans, F.lit(12.5)), lambda s: F.struct(s["text"].alias("t"), s["start_time"].alias("a"), s["end_time"].alias("b"))).alias("moved"))


@query(
    r"""SELECT file_name, len(list_filter(speakers, lambda x: x.end_time > x.start_time AND trim(coalesce(x.speaker, '')) <> '')) AS n_sound,
    list_max(list_transform(speakers, lambda x: x.end_time)) <= 60 AS within FROM diar_short WHERE speakers IS NOT NULL AND len(speakers) > 0"""
)
def checked_spans(spark, sf):
    """Sound spans counted, and whether all lie within a minute."""
    rows = read_table(spark, sf, "diar_short").where("speakers is not null and size(speakers) > 0")
    spans = F.transform("speakers", lambda s: F.struct(s["speaker"].alias("text"), s["start_time"].alias("start_time"), s["end_time"].alias("end_time")))
    return rows.select("file_name", F.size(S.sound_spans(spans)).cast("long").alias("n_sound"), S.within_duration(F.transform("speakers", lambda s: s["end_time"]), F.lit(60.0)).alias("within"))


@query(
    r"""WITH k AS (SELECT file_name, list_transform(speakers, lambda x: coalesce(trim(x.speaker), '')) AS s FROM diar_short WHERE speakers IS NOT NULL),
  f AS (SELECT file_name, list_filter(s, lambda x: x <> '') AS s FROM k)
  SELECT file_name, coalesce(array_to_string(list_transform(list_filter(range(1, len(s) + 1), lambda i: i = 1 OR s[i] <> s[i - 1]), lambda i: s[i]), ','), '') AS merged FROM f"""
)
def merged_labels(spark, sf):
    """Labels in order, neighbours that repeat joined."""
    rows = read_table(spark, sf, "diar_short").where("speakers is not null")
    return rows.select("file_name", T.merge_languages(F.transform("speakers", lambda s: s["speaker"])).alias("merged"))


@query(
    r"""SELECT tr_id, regexp_replace(regexp_extract(source_audio_path, '[^/]*$'), '\.[^.]*$', '') AS stem,
    coalesce(list_extract(string_split(source_audio_path, '/'), -2), '') AS folder, replace(source_audio_path, '/', '_') AS flat
  FROM transcript_rows WHERE source_audio_path IS NOT NULL"""
)
def path_parts(spark, sf):
    p = F.col("source_audio_path")
    return read_table(spark, sf, "transcript_rows").where(p.isNotNull()).select("tr_id", T.file_stem(p).alias("stem"), T.parent_folder(p).alias("folder"), T.flat_id(p).alias("flat"))
