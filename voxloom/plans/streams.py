"""Streams run to their end over a table, and properties that simulations and repairs must have."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.operators import align, audio, simulate
from voxloom.plans import signals
from voxloom.plans.interval_queries import PERIODS_SQL
from voxloom.plans.registry import query
from voxloom.session import mounted, read_table, scratch_folder
from voxloom.sources import readers, writers
from voxloom.streaming import intervals as interval_streams


def _run(stream, spark, name: str, mode: str):
    """Everything that a stream gives until its input is read."""
    at, marks = scratch_folder(spark, name), scratch_folder(spark, f"{name}-marks")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", marks).trigger(availableNow=True)
    writer.foreachBatch(lambda df, _: df.write.mode("append").parquet(at)).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(at)


@query(PERIODS_SQL)
def streamed_periods(spark, sf):
    """Periods and gaps of a stream of segments, from the maps in its state when it has read everything."""
    table = read_table(spark, sf, "diar_segments")
    at = scratch_folder(spark, "segments")
    table.select("file_name", "spk_id", "start_time", "end_time").repartition(3).write.parquet(at)
    stream = spark.readStream.schema("file_name STRING, spk_id STRING, start_time DOUBLE, end_time DOUBLE").option("maxFilesPerTrigger", 2).parquet(at)
    told = _run(interval_streams.interval_updates(stream), spark, "periods", "update")
    newest = told.groupBy("file_name", "spk_id").agg(F.max("version").alias("version"))
    return told.join(newest, ["file_name", "spk_id", "version"]).select("file_name", "spk_id", "kind", "start_ms", "end_ms")


# ---------------------------------------------------------------- properties
@query("SELECT 20::BIGINT AS n_sessions, 0::BIGINT AS beyond_end, 0::BIGINT AS self_overlaps, 0::BIGINT AS strangers FROM range(1)")
def session_faults(spark, sf):
    """What no simulated session may have: sentences beyond its end, over one's own last one, or of more speakers than asked for."""
    made = signals.simulated_sessions(spark, sf)
    before = F.max("end_time").over(Window.partitionBy("session", "speaker").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1))
    marked = made.withColumn("before", before)
    faults = marked.agg(
        F.count_distinct("session").alias("n_sessions"), F.count_if(F.col("end_time") > 60.001).alias("beyond_end"),
        F.count_if(F.col("start_time") < F.col("before") - 1e-3).alias("self_overlaps"),
    )
    crowd = made.groupBy("session").agg(F.count_distinct("speaker").alias("n")).agg(F.count_if(F.col("n") > 3).alias("strangers")).first().strangers
    return faults.withColumn("strangers", F.lit(crowd).cast("long"))


@query("SELECT * FROM (VALUES ('speakers', true), ('silence', true), ('dominance', true), ('volume', true), ('good', false)) t(setting, refused)")
def refused_settings(spark, sf):
    """Settings of a simulation that are refused when they are made."""
    tries = {"speakers": {"speakers": 0}, "silence": {"mean_silence": 0.6, "mean_overlap": 0.5}, "dominance": {"speakers": 30}, "volume": {"min_volume": 2.0}, "good": {}}
    rows = []
    for name, settings in tries.items():
        try:
            simulate.SessionConfig(**settings)
            rows.append((name, False))
        except ValueError:
            rows.append((name, True))
    return spark.createDataFrame(rows, "setting string, refused boolean")


@query("SELECT n AS speakers, true AS whole, true AS floored, true AS changes FROM range(2, 6) t(n)")
def speaker_choice(spark, sf):
    """Shares of turns that add up to one with a floor each, and changes of speaker about as often as asked for."""
    rows = []
    for n in range(2, 6):
        config = simulate.SessionConfig(speakers=n, seed=n)
        rng = np.random.default_rng(n)
        shares = [np.diff(simulate.dominance(config, rng), prepend=0) for _ in range(200)]
        who, changed = 0, 0
        for _ in range(2000):
            k = simulate.next_speaker(who, np.cumsum(shares[0]), config, rng)
            changed, who = changed + (k != who), k
        rows.append((n, bool(np.allclose([s.sum() for s in shares], 1)), bool(min(s.min() for s in shares) >= config.min_dominance - 1e-9), abs(changed / 2000 - config.turn_probability) < 0.04))
    return spark.createDataFrame(rows, "speakers long, whole boolean, floored boolean, changes boolean")


@query("SELECT file_name, len(list_filter(list_transform(speakers, lambda x: x.start_time), lambda x: x IS NOT NULL)) AS n, 0::BIGINT AS falls FROM diar_short WHERE speakers IS NOT NULL")
def repair_faults(spark, sf):
    """Repaired timestamps are as many as before and never fall."""
    stamps = F.filter(F.transform("speakers", lambda s: (s["start_time"] * 1000).cast("int")), lambda x: x.isNotNull())
    rows = read_table(spark, sf, "diar_short").where("speakers is not null").select("file_name", align.repaired(stamps).alias("r"))
    falls = F.size(F.filter(F.transform("r", lambda x, i: x < F.get(F.col("r"), i - 1)), lambda b: b))
    return rows.select("file_name", F.size("r").cast("long").alias("n"), falls.cast("long").alias("falls"))


@query("SELECT tr_id, CASE WHEN num_chunks + 15 >= 20 THEN 'xaby' ELSE 'x' || repeat('ab', num_chunks + 15) || 'y' END AS collapsed FROM transcript_rows WHERE num_chunks IS NOT NULL")
def collapsed_loops(spark, sf):
    """Loops of a short pattern taken back to one copy where they are long enough."""
    rows = read_table(spark, sf, "transcript_rows").where("num_chunks is not null")
    looped = F.concat(F.lit("x"), F.repeat(F.lit("ab"), F.col("num_chunks") + 15), F.lit("y"))
    return rows.select("tr_id", T.collapse_repetitions(looped).alias("collapsed"))


@query("SELECT tr_id, chunk_transcriptions[1 : greatest(len(chunk_transcriptions) - 5, 1)] AS kept FROM transcript_rows WHERE chunk_transcriptions IS NOT NULL")
def rolled_back_tokens(spark, sf):
    """All but the last five tokens, but one at least; here chunk texts stand for tokens."""
    rows = read_table(spark, sf, "transcript_rows").where("chunk_transcriptions is not null")
    return rows.select("tr_id", T.roll_back_tokens(F.col("chunk_transcriptions"), 5, 1).alias("kept"))


@query(r"""
  SELECT * FROM (VALUES ('silence', 'Normal', 0.0::DOUBLE, 'Normal', 'Stable voice', 'Flat: Monotone'), ('tone', 'Normal', NULL, 'Normal', 'Stable voice', NULL))
    t(wave, loudness_label, loud_range, pitch_label, tremor_label, rhythm_variability_label)""")
def tone_features(spark, sf):
    """Voice features of silence and of a steady tone, whose level at the ends and rhythm are left open."""
    tone = np.sin(np.arange(16000) * 2 * np.pi * 200 / 16000)
    rows = spark.createDataFrame([("silence", [0.0] * 8000), ("tone", tone.tolist())], "wave string, wav array<float>")
    f = rows.select("wave", audio.voice_features(F.col("wav")).alias("f")).select("wave", "f.*")
    quiet = F.col("wave") == "silence"
    return f.select("wave", "loudness_label", F.when(quiet, F.col("loud_range")).alias("loud_range"), "pitch_label", "tremor_label", F.when(quiet, F.col("rhythm_variability_label")).alias("rhythm_variability_label"))


@query("SELECT 'model' AS key, 'asr' AS value UNION ALL SELECT 'rate', '16000'")
def config_settings(spark, sf):
    """Settings of a YAML file."""
    import os

    at = mounted(scratch_folder(spark, "config"))
    os.makedirs(at, exist_ok=True)
    with open(f"{at}/settings.yaml", "w", encoding="utf-8") as f:
        f.write("model: asr\nrate: 16000\n")
    return spark.createDataFrame([(k, str(v)) for k, v in readers.config_file(f"{at}/settings.yaml").items()], "key string, value string")


@query("SELECT 'a&amp;b' AS shown, 2::BIGINT AS bars, 'metadata.json, page.html' AS packed FROM range(1)")
def packed_timeline(spark, sf):
    """A page with a token timeline, packed with its metadata."""
    import os
    import zipfile

    at = mounted(scratch_folder(spark, "page"))
    os.makedirs(f"{at}/in", exist_ok=True)
    page = writers.timeline_html("tokens", [("a&b", 0.0, 1.0), ("c", 1.0, 2.5), ("left out", None, 3.0), ("left out", 3.0, 3.0)])
    with open(f"{at}/in/page.html", "w", encoding="utf-8") as f:
        f.write(page)
    names = sorted(n for n in zipfile.ZipFile(writers.archive(f"{at}/in", f"{at}/out.zip", {"tokens": 2})).namelist() if not n.endswith("/"))
    shown = "a&amp;b" if "a&amp;b" in page else ""
    return spark.createDataFrame([(shown, page.count('class="token"'), ", ".join(names))], "shown string, bars long, packed string")
