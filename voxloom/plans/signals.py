"""Signals and streams: levels, frames, windows over time, chunks, models, simulation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voxloom.functions import spans as S
from voxloom.operators import align, audio, joins, models, reports, segments, simulate
from voxloom.plans.registry import query
from voxloom.session import read_table, utc
from voxloom.streaming import rechunk, windows


@query("SELECT vec_id, list_max(list_transform(embedding, lambda x: abs(x)))::DOUBLE AS peak, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / len(embedding), 8) AS power FROM embeddings")
def signal_levels(spark, sf):
    """Peak and mean power of each vector taken as a signal."""
    x = F.col("embedding")
    return read_table(spark, sf, "embeddings").select("vec_id", audio.peak(x).cast("double").alias("peak"), F.round(audio.mean_power(x), 8).alias("power"))


@query(r"""
  WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: (x * 4)::FLOAT) AS e FROM embeddings),
       m AS (SELECT vec_id, e, list_max(list_transform(e, lambda x: abs(x))) AS top FROM p)
  SELECT vec_id, list_transform(e, lambda x: round((CASE WHEN top > 1 THEN x / top ELSE x END)::DOUBLE, 4)) AS wav FROM m""")
def normalised_signals(spark, sf):
    """Signals louder than full scale are brought down to it."""
    loud = F.transform("embedding", lambda x: (x * 4).cast("float"))
    return read_table(spark, sf, "embeddings").select("vec_id", F.transform(audio.normalise(loud, clip=True), lambda x: F.round(x.cast("double"), 4)).alias("wav"))


@query(r"""
  WITH n AS (SELECT label, sum(len(embedding))::BIGINT AS total FROM embeddings GROUP BY 1),
       c AS (SELECT label, total, unnest(range(0, CAST(ceil(total / 100.0) AS BIGINT))) AS chunk_id FROM n)
  SELECT label::VARCHAR AS session_id, chunk_id, least(100, total - chunk_id * 100) AS n_samples, chunk_id * 100 AS first_sample FROM c""")
def rechunked_signals(spark, sf):
    """Vectors of one label as a stream of samples, cut into chunks of a hundred."""
    rows = read_table(spark, sf, "embeddings").select(F.col("label").cast("string").alias("session_id"), F.col("vec_id").alias("seq"), F.col("embedding").alias("pcm"))
    config = rechunk.StreamConfig(chunk_seconds=1.0, rate=100)
    return rechunk.rechunk_batch(rows, config).select("session_id", "chunk_id", "n_samples", "first_sample")


@query(r"""
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
         event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2, 3""")
def hourly_events(spark, sf):
    events = read_table(spark, sf, "events").withColumn("ts", utc("ts"))
    out = windows.windowed_counts(events, "ts", ["event_type"], "1 hour", value=F.col("value"))
    out = out.withColumn("total", F.round("total", 4))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query(r"""
  WITH o AS (SELECT user_id, ts, coalesce((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 7200000000, true) AS fresh FROM events),
       s AS (SELECT user_id, ts, sum(fresh::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o)
  SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, sf):
    """Sessions of users: a new one begins after more than two hours."""
    events = read_table(spark, sf, "events").withColumn("ts", utc("ts"))
    return windows.session_counts(events, "ts", ["user_id"], "2 hours").select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")


@query(r"""
  WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
  SELECT event_id, value - lag(value) OVER w AS step,
         round(sum(value) OVER (PARTITION BY user_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), 4) AS moving_sum,
         list_sort([coalesce(lag(value) OVER w, 0.0), value, coalesce(lead(value) OVER w, 0.0)])[2] AS smooth
  FROM o WINDOW w AS (PARTITION BY user_id ORDER BY p)""")
def event_series(spark, sf):
    """First difference, moving sum of four, and median of three with zeros beyond the ends."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    v = F.col("value")
    triple = F.array(F.coalesce(F.lag(v).over(w), F.lit(0.0)), v, F.coalesce(F.lead(v).over(w), F.lit(0.0)))
    return read_table(spark, sf, "events").select(
        "event_id", (v - F.lag(v).over(w)).alias("step"), F.round(F.sum(v).over(w.rowsBetween(0, 3)), 4).alias("moving_sum"), F.get(F.array_sort(triple), F.lit(1)).alias("smooth")
    )


@query(r"""
  SELECT event_type, round(quantile_cont(value, 0.95) - quantile_cont(value, 0.05), 6) AS pitch_range, round(median(value), 6) AS middle, round(stddev_pop(value), 6) AS spread,
         max(value) - min(value) AS full_range FROM events GROUP BY 1""")
def value_spread(spark, sf):
    """Percentile range, median, population deviation and full range; quantiles by numbering, so no task holds a type."""
    v, events = F.col("value"), read_table(spark, sf, "events")
    ranks = joins.at_ranks(events, "event_type", "value", [0.05, 0.5, 0.95])
    of = lambda q: F.max(F.when(F.col("share") == q, F.col("quantile")))
    quantiles = ranks.groupBy("event_type").agg(F.round(of(0.95) - of(0.05), 6).alias("pitch_range"), F.round(of(0.5), 6).alias("middle"))
    moments = events.groupBy("event_type").agg(F.round(F.stddev_pop(v), 6).alias("spread"), (F.max(v) - F.min(v)).alias("full_range"))
    return moments.join(quantiles, "event_type", "left").select("event_type", "pitch_range", "middle", "spread", "full_range")


@query(r"""
  WITH f AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding) AS x FROM embeddings)
  SELECT vec_id, CASE WHEN max(abs(x)) > 0.3 OR stddev_pop(x) > 0.2 THEN 'High Intensity' ELSE 'Neutral' END AS tier FROM f GROUP BY 1""")
def intensity_rules(spark, sf):
    """The acoustic rules on features that are scaled from the vectors."""
    x = F.explode("embedding")
    f = read_table(spark, sf, "embeddings").select("vec_id", x.alias("x")).groupBy("vec_id").agg(F.max(F.abs("x")).alias("m"), F.stddev_pop("x").alias("s"))
    voice = F.struct(
        F.lit("Stable voice").alias("tremor_label"), F.when(F.col("m") > 0.3, 41.0).otherwise(0.0).alias("loud_range"), F.lit(0.0).alias("loud_std"),
        F.lit(0.0).alias("pitch_std"), F.when(F.col("s") > 0.2, 151.0).otherwise(0.0).alias("pitch_range"), F.lit("Normal").alias("rhythm_variability_label"),
    )
    return f.select("vec_id", audio.acoustic_tier(voice).alias("tier"))


@query("SELECT row_id, upper(text) AS answer FROM feature_rows WHERE text IS NOT NULL")
def model_answers(spark, sf):
    """A batch model over all texts; here one that answers in capitals."""
    model = models.BatchModel("capitals", lambda: str.upper, lambda f, xs: [f(x) for x in xs], batch_size=64)
    rows = read_table(spark, sf, "feature_rows").where("text is not null").select("row_id", "text")
    return models.apply_model(rows, model, "text", "answer").where("answer_error is null").select("row_id", "answer")


@query()
def repaired_timestamps(spark, sf):
    """Starts of the segments in diar_short made to never fall; compared with brute force in the tests."""
    rows = read_table(spark, sf, "diar_short").where("speakers is not null")
    stamps = F.transform("speakers", lambda s: (s["start_time"] * 1000).cast("int"))
    return rows.select("file_name", align.repaired(F.filter(stamps, lambda x: x.isNotNull())).alias("stamps"))


@query()
def simulated_sessions(spark, sf):
    """Sessions made from the words of transcripts; seeded, so the same at every run."""
    rows = read_table(spark, sf, "transcript_rows").where("duration_sec > 0 and transcription is not null")
    entry = rows.select(F.col("config_key").alias("speaker_id"), S.word_entry(F.col("transcription"), F.col("duration_sec")).alias("e"))
    manifest = entry.select("speaker_id", F.col("e.words").alias("words"), F.col("e.alignments").alias("alignments"))
    return simulate.simulate_sessions(spark, manifest, simulate.SessionConfig(sessions=20, speakers=3)).select("session", "turn", "speaker", "start_time", "end_time", F.size("words").alias("n_words"))


@query(r"""
  WITH f AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, abs(unnest(embedding))::DOUBLE * 6 AS p FROM embeddings),
  m AS (SELECT *, CASE WHEN p >= 0.877 THEN 1 WHEN p < 0.427 THEN 0 END AS mark FROM f),
  s AS (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY vec_id ORDER BY i ROWS UNBOUNDED PRECEDING), 0) AS state FROM m),
  n AS (SELECT *, (state <> coalesce(lag(state) OVER (PARTITION BY vec_id ORDER BY i), -1))::INT AS fresh FROM s),
  r AS (SELECT *, sum(fresh) OVER (PARTITION BY vec_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM n),
  g AS (SELECT vec_id, run, min(i) * 0.25 AS s, (max(i) + 1) * 0.25 AS e FROM r WHERE state = 1 GROUP BY 1, 2),
  j AS (SELECT *, coalesce((s - max(e) OVER (PARTITION BY vec_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= 0.245)::INT, 1) AS fresh FROM g),
  k AS (SELECT *, sum(fresh) OVER (PARTITION BY vec_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS isle FROM j)
  SELECT vec_id, min(s)::DOUBLE AS start_time, max(e)::DOUBLE AS end_time FROM k GROUP BY vec_id, isle HAVING max(e) - min(s) >= 0.487""")
def speech_decisions(spark, sf):
    """Speech segments from frame probabilities with two thresholds."""
    frames = read_table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "x")).select("vec_id", "i", (F.abs("x").cast("double") * 6).alias("p"))
    return segments.hysteresis_segments(frames, ["vec_id"], "i", "p", 0.25)


@query(r"""
  WITH v AS (SELECT vec_id, vec_id * 37 % 400 AS n FROM embeddings)
  SELECT vec_id, ((((n % 100 - 1) // 2 + 1 - 1) // 2 + 1 - 1) // 2 + 1 + n // 100 * 13)::BIGINT AS frames FROM v WHERE n % 100 > 0""")
def feature_lengths(spark, sf):
    """Frames behind the convolutions."""
    rows = read_table(spark, sf, "embeddings").select("vec_id", (F.col("vec_id") * 37 % 400).alias("n")).where("n % 100 > 0")
    return rows.select("vec_id", S.feature_length(F.col("n")).alias("frames"))


@query("SELECT arg_max(path, step) AS path FROM (SELECT 'out/checkpoint-' || vec_id AS path, vec_id AS step FROM embeddings)")
def latest_checkpoints(spark, sf):
    rows = read_table(spark, sf, "embeddings").select(F.concat(F.lit("out/checkpoint-"), F.col("vec_id").cast("string")).alias("path"))
    return reports.latest_checkpoint(rows)
