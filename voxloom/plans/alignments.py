"""Spans, alignments and waveforms: queries over operators on arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import spans as S
from voxloom.functions import text as T
from voxloom.operators import align, audio, joins, simulate
from voxloom.plans.registry import query
from voxloom.session import read_table


def _spans(rows):
    return F.transform("speakers", lambda s: F.struct(s["speaker"].alias("text"), s["start_time"].alias("start_time"), s["end_time"].alias("end_time")))


@query(r"""
  WITH f AS (SELECT row_id, text_features.word_count AS n, text_features.true_duration AS d, least(text_features.word_count / 2.3, text_features.true_duration) AS talk
             FROM feature_rows WHERE text_features.true_duration > 0 AND text_features.word_count >= 0)
  SELECT row_id, n, CASE WHEN n > 0 THEN (d - talk) / 2 END AS first_start, CASE WHEN n > 0 THEN (d - talk) / 2 + n * (talk / n) END AS last_end FROM f""")
def word_spans(spark, sf):
    """Equal spans of the words over the guessed talk time."""
    f = lambda name: F.col(f"text_features.{name}")
    rows = read_table(spark, sf, "feature_rows").where("text_features.true_duration > 0 and text_features.word_count >= 0")
    spans = rows.select("row_id", T.word_spans(f("word_count"), f("true_duration")).alias("s"))
    n = F.size("s")
    return spans.select("row_id", n.cast("long").alias("n"), F.get("s", F.lit(0))["start_time"].alias("first_start"), F.get("s", n - 1)["end_time"].alias("last_end"))


@query(r"""
  SELECT file_name, CASE WHEN len(speakers) < 2 THEN ['speech_part1', 'speech_part2'] ELSE list_transform(speakers, lambda s: s.speaker) END AS texts,
         CASE WHEN len(speakers) < 2 THEN 5.0 ELSE speakers[1].end_time END AS first_end FROM diar_short WHERE speakers IS NOT NULL""")
def halved_spans(spark, sf):
    """Two halves where there are fewer than two spans."""
    rows = read_table(spark, sf, "diar_short").where("speakers is not null")
    got = rows.select("file_name", S.two_halves(_spans(rows), F.lit(10.0)).alias("s"))
    return got.select("file_name", F.transform("s", lambda x: x["text"]).alias("texts"), F.col("s")[0]["end_time"].alias("first_end"))


@query(r"""
  WITH k AS (SELECT file_name, list_filter(speakers, lambda x: x.end_time > x.start_time AND trim(coalesce(x.speaker, '')) <> '') AS s FROM diar_short WHERE speakers IS NOT NULL)
  SELECT file_name, CASE WHEN len(s) > 0 THEN list_transform(s, lambda x: trim(x.speaker)) ELSE ['speech'] END AS words,
         CASE WHEN len(s) > 0 THEN list_transform(s, lambda x: x.end_time) ELSE [1.0::DOUBLE] END AS alignments FROM k""")
def span_ends(spark, sf):
    """End times of the sound spans, with a stand-in for none."""
    rows = read_table(spark, sf, "diar_short").where("speakers is not null")
    return rows.select("file_name", S.end_times(_spans(rows)).alias("e")).select("file_name", "e.words", "e.alignments")


@query(r"""
  SELECT file_name, len(list_filter(speakers, lambda x: coalesce(x.end_time - x.start_time > 0.01, false))) AS n_long, coalesce(len(speakers) >= 2, false) AS enough FROM diar_short""")
def usable_spans(spark, sf):
    """Spans longer than a hundredth, and whether there are at least two."""
    rows = read_table(spark, sf, "diar_short")
    return rows.select("file_name", F.size(S.long_spans(_spans(rows))).cast("long").alias("_n"), F.col("speakers")).select(
        "file_name", F.when(F.col("speakers").isNotNull(), F.col("_n")).alias("n_long"), S.enough_alignments(F.col("speakers")).alias("enough")
    )


@query(r"""
  WITH s AS (SELECT file_name, list_transform(speakers, lambda x: x.speaker) AS w, flatten(list_transform(speakers, lambda x: [round(x.start_time * 1000)::INTEGER, round(x.end_time * 1000)::INTEGER])) AS t
             FROM diar_short WHERE speakers IS NOT NULL)
  SELECT file_name, list_transform(range(1, len(w) + 1), lambda i: t[2 * i - 1] / 1000) AS starts, list_transform(range(1, len(w) + 1), lambda i: t[2 * i] / 1000) AS ends FROM s""")
def paired_timestamps(spark, sf):
    """Two timestamps in milliseconds for each word, as spans in seconds."""
    rows = read_table(spark, sf, "diar_short").where("speakers is not null")
    ms = lambda x: F.round(x * 1000).cast("int")
    stamps = F.flatten(F.transform("speakers", lambda s: F.array(ms(s["start_time"]), ms(s["end_time"]))))
    got = rows.select("file_name", S.pair_timestamps(F.transform("speakers", lambda s: s["speaker"]), stamps).alias("s"))
    return got.select("file_name", F.transform("s", lambda x: x["start_time"]).alias("starts"), F.transform("s", lambda x: x["end_time"]).alias("ends"))


@query("SELECT vec_id, len(embedding) / 16 AS seconds, list_transform(embedding, lambda x: round((x * 1000)::DOUBLE)::INTEGER) AS ticks FROM embeddings")
def signal_seconds(spark, sf):
    """Length of each signal at sixteen samples a second, and its samples as whole numbers."""
    x = F.col("embedding")
    return read_table(spark, sf, "embeddings").select("vec_id", S.duration_seconds(x, 16).alias("seconds"), F.transform(x, lambda v: F.round((v * 1000).cast("double")).cast("int")).alias("ticks"))


@query(r"""
  WITH v AS (SELECT file_name, list_sort(list_filter(list_transform(speakers, lambda x: floor(x.start_time * 10)::BIGINT), lambda x: x IS NOT NULL)) AS v FROM diar_short WHERE speakers IS NOT NULL),
  p AS (SELECT file_name, i - 1 AS p, v[i] // 50 AS b FROM (SELECT file_name, v, unnest(range(1, len(v) + 1)) AS i FROM v)),
  g AS (SELECT file_name, b, min(p) AS a, max(p) + 1 AS z FROM p GROUP BY 1, 2)
  SELECT file_name, list(a::INTEGER ORDER BY a) AS starts, list(z::INTEGER ORDER BY a) AS ends FROM g GROUP BY 1""")
def index_chunks(spark, sf):
    """Runs of values of the same block; files without values have none and are left out."""
    rows = read_table(spark, sf, "diar_short").where("speakers is not null")
    values = F.array_sort(F.filter(F.transform("speakers", lambda s: F.floor(s["start_time"] * 10).cast("long")), lambda x: x.isNotNull()))
    got = rows.select("file_name", values.alias("v")).where(F.size("v") > 0).select("file_name", S.value_chunks(F.col("v"), 50).alias("c"))
    return got.select("file_name", F.transform("c", lambda x: x["start"]).alias("starts"), F.transform("c", lambda x: x["end"]).alias("ends"))


@query(r"""
  WITH m AS (SELECT vec_id, list_transform(embedding, lambda x: (x > 0)::INTEGER) AS m FROM embeddings)
  SELECT vec_id, list_transform(range(1, len(m) + 1), lambda i: CASE WHEN m[i] = 0 THEN 1 ELSE list_sum(m[1:i])::INTEGER - 1 END) AS places FROM m""")
def mask_places(spark, sf):
    """Position ids from a mask."""
    mask = F.transform("embedding", lambda x: (x > 0).cast("int"))
    return read_table(spark, sf, "embeddings").select("vec_id", S.mask_positions(mask).alias("places"))


@query("SELECT tr_id, [idx::INTEGER, num_chunks] AS stamps FROM transcript_rows WHERE idx IS NOT NULL AND num_chunks IS NOT NULL")
def read_stamps(spark, sf):
    """Numbers of time marks in an aligner's output."""
    rows = read_table(spark, sf, "transcript_rows").where("idx is not null and num_chunks is not null")
    out = F.concat(F.lit("a<|"), F.col("idx").cast("string"), F.lit("|>b <"), F.col("num_chunks").cast("string"), F.lit("> c"))
    return rows.select("tr_id", S.stamp_tokens(out).alias("stamps"))


@query(r"""
  SELECT tr_id, list_transform([0.0, 2.0, 3.9, 100000.0], lambda t: chunk_transcriptions[floor(t / 2)::BIGINT + 1]) AS labels FROM transcript_rows WHERE chunk_transcriptions IS NOT NULL""")
def labels_at(spark, sf):
    """Labels of two-second windows at some moments; here chunk texts stand for labels."""
    rows = read_table(spark, sf, "transcript_rows").where("chunk_transcriptions is not null")
    at = [S.window_label(F.col("chunk_transcriptions"), F.lit(t)) for t in (0.0, 2.0, 3.9, 100000.0)]
    return rows.select("tr_id", F.array(*at).alias("labels"))


@query(r"""
  WITH c AS (SELECT tr_id, config_key, generate_subscripts(chunk_transcriptions, 1) AS i, unnest(chunk_transcriptions) AS t FROM transcript_rows)
  SELECT tr_id, coalesce(max(split_part(config_key, '_', 1)), '') AS language, coalesce(string_agg(nullif(t, ''), '' ORDER BY i), '') AS text, count(*)::INTEGER AS n_chunks, count(*)::INTEGER AS n_stamps,
         round((max(i) - 1) * 29 + 0.5, 3)::DOUBLE AS last_end FROM c GROUP BY 1""")
def joined_chunks(spark, sf):
    """Results of chunks put together again: texts, languages, and spans moved by their chunk's offset."""
    rows = read_table(spark, sf, "transcript_rows").select("tr_id", "config_key", F.posexplode("chunk_transcriptions").alias("chunk_index", "text"))
    spans = F.array(F.struct(F.col("text").alias("text"), F.lit(0.0).alias("start_time"), F.lit(0.5).alias("end_time")))
    results = rows.select("tr_id", "chunk_index", "text", F.substring_index("config_key", "_", 1).alias("language"), (F.col("chunk_index") * 29).cast("double").alias("offset_sec"), spans.alias("spans"))
    merged = align.merge_chunks(results, parent="tr_id", spans="spans")
    return merged.select("tr_id", "language", "text", "n_chunks", F.size("time_stamps").alias("n_stamps"), F.get("time_stamps", F.size("time_stamps") - 1)["end_time"].alias("last_end"))


# ---------------------------------------------------------------- waveforms
@query(r"""
  WITH c AS (SELECT vec_id, embedding, unnest(range(CASE WHEN len(embedding) <= 30 THEN 1 ELSE ceil((len(embedding) - 30) / 20.0)::BIGINT + 1 END)) AS i FROM embeddings)
  SELECT vec_id, i::INTEGER AS chunk_index, i * 2.0 AS offset_sec, embedding[i * 20 + 1 : i * 20 + 30] AS chunk FROM c""")
def overlapping_chunks(spark, sf):
    """Chunks of three seconds with one of overlap, at ten samples a second."""
    got = audio.overlapping_chunks(read_table(spark, sf, "embeddings"), "embedding", "vec_id", rate=10, chunk_seconds=3.0, overlap_seconds=1.0)
    return got.select(F.col("id").alias("vec_id"), "chunk_index", "offset_sec", "chunk")


@query(r"""
  WITH RECURSIVE s AS (SELECT vec_id, list_transform(embedding, lambda x: abs(round((x * 100)::DOUBLE))) AS x FROM embeddings),
  w AS (SELECT vec_id, x, list_transform(range(1, len(x) - 2), lambda i: x[i] + x[i + 1] + x[i + 2] + x[i + 3]) AS e FROM s),
  c AS (
    SELECT vec_id, x, e, 0::BIGINT AS p, 0::BIGINT AS k FROM w
    UNION ALL
    SELECT vec_id, x, e, (lo + list_position(e[lo + 1 : hi], list_min(e[lo + 1 : hi])) - 1
             + list_position(x[lo + list_position(e[lo + 1 : hi], list_min(e[lo + 1 : hi])) : lo + list_position(e[lo + 1 : hi], list_min(e[lo + 1 : hi])) + 3],
                             list_min(x[lo + list_position(e[lo + 1 : hi], list_min(e[lo + 1 : hi])) : lo + list_position(e[lo + 1 : hi], list_min(e[lo + 1 : hi])) + 3])) - 1)::BIGINT, k + 1
    FROM (SELECT *, greatest(p, p + 24 - 8) AS lo, least(len(x), p + 24 + 8) - 4 + 1 AS hi FROM c WHERE p + 24 < len(x)))
  SELECT vec_id::VARCHAR AS id, k::INTEGER AS chunk_index, p / 8 AS offset_sec FROM c""")
def quiet_chunks(spark, sf):
    """Chunks of at most about three seconds cut where it is quiet, at eight samples a second."""
    signal = F.transform("embedding", lambda x: F.round((x * 100).cast("double")).cast("float"))
    rows = read_table(spark, sf, "embeddings").select("vec_id", signal.alias("wav"))
    return audio.quiet_chunks(rows, "wav", "vec_id", rate=8, max_seconds=3.0, search=1.0).select("id", "chunk_index", "offset_sec")


@query(r"""
  WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: round((x * 100)::DOUBLE)) AS v FROM embeddings),
  s AS (SELECT vec_id, list_transform(range(1, len(v) - 2), lambda i: v[i] + v[i + 1] + v[i + 2] + v[i + 3]) AS sums FROM v)
  SELECT vec_id, sums, list_position(sums, list_min(sums)) - 1 AS quietest FROM s""")
def moving_minima(spark, sf):
    """Moving sums of four, and the place of the least."""
    v = F.transform("embedding", lambda x: F.round((x * 100).cast("double")))
    return read_table(spark, sf, "embeddings").select("vec_id", audio.moving_sums(v, 4).alias("m")).select("vec_id", "m.sums", F.col("m.quietest").cast("int").alias("quietest"))


@query(r"""
  SELECT vec_id, list_transform(range(1, len(embedding) + 1), lambda i: list_sort([coalesce(CASE WHEN i > 1 THEN embedding[i - 1] END, 0.0::FLOAT), embedding[i], coalesce(embedding[i + 1], 0.0::FLOAT)])[2]::DOUBLE) AS smooth FROM embeddings""")
def smoothed_signals(spark, sf):
    """Running median of three with zeros beyond the ends."""
    return read_table(spark, sf, "embeddings").select("vec_id", audio.smoothed(F.col("embedding").cast("array<double>")).alias("smooth"))


@query("SELECT vec_id, list_transform(range(1, 33), lambda i: ((embedding[i] + embedding[i + 32])::FLOAT / 2)::FLOAT) AS wav FROM embeddings")
def mono_signals(spark, sf):
    """Two channels averaged; here the halves of a vector."""
    halves = F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))
    return read_table(spark, sf, "embeddings").select("vec_id", audio.mono(halves).alias("wav"))


@query(r"""
  WITH p AS (SELECT vec_id, embedding AS e, list_transform(range(0, 96), lambda k: k * 63 / 95) AS places FROM embeddings)
  SELECT vec_id, list_transform(places, lambda a: round(e[floor(a)::BIGINT + 1]::DOUBLE + (a - floor(a)) * (e[least(floor(a)::BIGINT + 2, 64)]::DOUBLE - e[floor(a)::BIGINT + 1]::DOUBLE), 3)) AS wav FROM p""")
def resampled_signals(spark, sf):
    """Signals at one and a half times their rate, by linear interpolation."""
    # A missing vector has only missing samples.
    signal = F.coalesce("embedding", F.array_repeat(F.lit(None).cast("float"), 64))
    return read_table(spark, sf, "embeddings").select("vec_id", F.transform(audio.resampled(signal, 16, 24), lambda x: audio.rounded(x, 3)).alias("wav"))


@query(r"""
  WITH i AS (SELECT vec_id, list_transform(embedding, lambda x: round((x * 100)::DOUBLE)::INTEGER) AS v FROM embeddings)
  SELECT vec_id, list_transform(v, lambda x: (x / 32768.0)::FLOAT) AS from_int16, list_transform(v, lambda x: ((x + 100 - 128) / 128.0)::FLOAT) AS from_uint8,
         list_transform(v, lambda x: (x * 1000 / 2147483648.0)::FLOAT) AS from_int32 FROM i""")
def integer_signals(spark, sf):
    """Samples of several integer types as floats."""
    v = F.transform("embedding", lambda x: F.round((x * 100).cast("double")).cast("int"))
    rows = read_table(spark, sf, "embeddings").select("vec_id", v.alias("v"))
    return rows.select(
        "vec_id", audio.samples_to_float(F.col("v"), "int16").alias("from_int16"),
        audio.samples_to_float(F.transform("v", lambda x: x + 100), "uint8").alias("from_uint8"),
        audio.samples_to_float(F.transform("v", lambda x: x * 1000), "int32").alias("from_int32"),
    )


@query(r"""
  SELECT t, round(0.54 - 0.46 * cos(2 * pi() * t / 19), 6) AS hamming, round(0.5 - 0.5 * cos(2 * pi() * t / 19), 6) AS hann, round(sin(pi() * (t + 0.5) / 20), 6) AS cosine FROM range(10) r(t)""")
def half_windows(spark, sf):
    """Rising halves of the windows that fade a sentence."""
    kinds = ("hamming", "hann", "cosine")
    rows = list(zip(range(10), *[[float(x) for x in audio.half_window(10, k)] for k in kinds]))
    return spark.createDataFrame(rows, "t long, hamming double, hann double, cosine double").select("t", *[F.round(k, 6).alias(k) for k in kinds])


@query(r"""
  SELECT vec_id, round(list_sum(list_transform(list_filter(embedding, lambda x: x > 0), lambda x: x::DOUBLE * x::DOUBLE)) / len(list_filter(embedding, lambda x: x > 0)), 8) AS power FROM embeddings""")
def masked_power(spark, sf):
    """Mean power over the samples that a mask keeps."""
    x = F.col("embedding")
    return read_table(spark, sf, "embeddings").select("vec_id", F.round(audio.mean_power(x, F.transform(x, lambda v: (v > 0).cast("int"))), 8).alias("power"))


@query()
def voice_tiers(spark, sf):
    """The acoustic rules on voice features of the vectors, drawn out to half a second; the rules alone have SQL in intensity_rules."""
    wave = F.flatten(F.array_repeat(F.col("embedding"), 125))
    rows = read_table(spark, sf, "embeddings").select("vec_id", audio.voice_features(wave).alias("f"))
    return rows.select("vec_id", audio.acoustic_tier(F.col("f")).alias("tier"), F.col("f.loud_range").alias("loud_range"))


@query()
def session_sounds(spark, sf):
    """Length and level of simulated sessions with their sound, the voices made from vectors."""
    words = read_table(spark, sf, "transcript_rows").where("duration_sec > 0 and transcription is not null")
    entry = words.select(F.col("config_key").alias("speaker_id"), S.word_entry(F.col("transcription"), F.col("duration_sec")).alias("e"))
    config = simulate.SessionConfig(sessions=10, speakers=2, seconds=20.0)
    made = simulate.simulate_sessions(spark, entry.select("speaker_id", F.col("e.words").alias("words"), F.col("e.alignments").alias("alignments")), config)
    voices = joins.numbered(read_table(spark, sf, "embeddings").select("embedding", "vec_id"), [F.col("vec_id")], "n")
    names = joins.numbered(made.select("speaker").distinct(), [F.col("speaker")], "n")
    clips = names.join(voices, "n").select("speaker", F.flatten(F.array_repeat(F.col("embedding"), 20)).alias("wav"))
    sounds = simulate.session_waveforms(made, clips, config, rate=1000)
    return sounds.select("session", F.size("wav").alias("n_samples"), F.round(audio.mean_power(F.col("wav")), 6).alias("power"))
