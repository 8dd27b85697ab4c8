"""Sources and sinks, written and read again, and operators on records."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from voxloom.functions import spans as S
from voxloom.functions import text as T
from voxloom.functions import verdict as V
from voxloom.operators import audio, joins, models, reports
from voxloom.plans import sql_api
from voxloom.plans.registry import query
from voxloom.session import mounted, read_table, scratch_folder, stage
from voxloom.sources import readers, writers


# ---------------------------------------------------------------- sources and sinks
@query("SELECT tr_id, transcription, duration_sec FROM transcript_rows")
def json_lines_copy(spark, sf):
    """Results as JSON lines, nulls and all."""
    at = scratch_folder(spark, "lines")
    writers.json_lines(read_table(spark, sf, "transcript_rows").select("tr_id", "transcription", "duration_sec"), at)
    return readers.json_lines(spark, at, "tr_id BIGINT, transcription STRING, duration_sec DOUBLE", strict=True)


@query("SELECT n_nationkey, n_name, 'nations.json' AS file FROM nation")
def json_array_copy(spark, sf):
    """A pretty JSON array of a small table, read with the name of its file."""
    import os

    at = mounted(scratch_folder(spark, "array"))
    os.makedirs(at, exist_ok=True)
    writers.json_array(read_table(spark, sf, "nation").select("n_nationkey", "n_name"), f"{at}/nations.json", ["n_nationkey"])
    return readers.json_array(spark, f"file://{at}/nations.json", "n_nationkey INT, n_name STRING")


@query("SELECT CASE WHEN lang IN ('en', 'ms') THEN 'train' ELSE 'validation' END AS split, sample_id::VARCHAR AS audio, text, lang AS prompt FROM lang_samples")
def named_splits(spark, sf):
    """Two files of training rows in one table, named by split."""
    rows = read_table(spark, sf, "lang_samples").select(F.col("sample_id").cast("string").alias("audio"), "text", F.col("lang").alias("prompt"))
    at = {name: scratch_folder(spark, name) for name in ("train", "validation")}
    first = F.col("prompt").isin("en", "ms")
    writers.json_lines(rows.where(first), at["train"])
    writers.json_lines(rows.where(~first), at["validation"])
    return readers.json_splits(spark, **at).select("split", "audio", "text", "prompt")


@query("SELECT config_key, nullif(label, '') AS label, count(*) AS n FROM feature_rows GROUP BY 1, 2")
def tier_folders(spark, sf):
    """One folder for each set and tier, counted from what was written."""
    at = scratch_folder(spark, "tiers")
    writers.tiers(read_table(spark, sf, "feature_rows").select("row_id", "config_key", "label"), at)
    return spark.read.schema("row_id BIGINT, config_key STRING, label STRING").json(at).groupBy("config_key", "label").agg(F.count("*").alias("n"))


_SOUND = "NOT isnan(start_time) AND NOT isnan(end_time) AND end_time > start_time AND trim(spk_id) <> ''"


@query(
    rf"""SELECT file_name AS file, printf('%.3f', start_time)::DOUBLE AS start_time, printf('%.3f', end_time)::DOUBLE AS end_time, count(*) AS n
  FROM diar_segments WHERE {_SOUND} GROUP BY 1, 2, 3"""
)
def rttm_copy(spark, sf):
    """RTTM files with end times, written and read."""
    at = scratch_folder(spark, "rttm")
    rows = read_table(spark, sf, "diar_segments").where("not isnan(start_time) and not isnan(end_time) and end_time > start_time and trim(spk_id) <> ''")
    writers.rttm(rows.withColumn("spk_id", F.regexp_replace("spk_id", r"\s+", "_")), at, standard=False)
    return readers.rttm(spark, at, end_time=True).groupBy("file", "start_time", "end_time").agg(F.count("*").alias("n"))


@query(
    rf"""SELECT file_name, count(*) AS n, list(start_time ORDER BY start_time, seg_id)[1] AS first_start FROM diar_segments WHERE {_SOUND} GROUP BY 1"""
)
def diarization_copy(spark, sf):
    """Diarization documents of ten minutes at most, written and read, and what they hold of each file."""
    from voxloom.operators import segments

    at = scratch_folder(spark, "documents")
    rows = read_table(spark, sf, "diar_segments").where("not isnan(start_time) and not isnan(end_time) and end_time > start_time and trim(spk_id) <> ''")
    writers.diarization_json(segments.diarization_documents(rows, bucket=600.0), at)
    schema = "file_name STRING, part BIGINT, speaker_diarization ARRAY<STRUCT<start_time: DOUBLE, end_time: DOUBLE, spk_id: STRING>>"
    read = spark.read.schema(schema).json(at)
    return read.groupBy("file_name").agg(F.sum(F.size("speaker_diarization")).alias("n"), F.min(F.col("speaker_diarization")[0]["start_time"]).alias("first_start"))


def _waves(spark, sf) -> str:
    at = mounted(scratch_folder(spark, "waves"))
    writers.wav_files(read_table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("name"), F.col("embedding").alias("wav")), at).write.format("noop").mode("overwrite").save()
    return f"file://{at}"


@query(r"""
  SELECT vec_id, len(embedding) AS n_samples,
         list_sum(list_transform(embedding, lambda x: round(least(greatest(x::DOUBLE, -1.0), 1.0) * 32767)))::BIGINT AS total FROM embeddings""")
def wav_copy(spark, sf):
    """Waveforms as 16-bit files, written and read."""
    back = readers.wav_files(spark, _waves(spark, sf))
    total = F.aggregate("wav", F.lit(0).cast("long"), lambda a, x: a + F.round(x.cast("double") * 32768).cast("long"))
    return back.select(T.file_stem(F.col("path")).cast("long").alias("vec_id"), F.size("wav").cast("long").alias("n_samples"), total.alias("total"))


@query("SELECT vec_id || '.wav' AS name, vec_id::VARCHAR AS stem, row_number() OVER (ORDER BY vec_id || '.wav') - 1 AS position FROM embeddings")
def listed_files(spark, sf):
    """A folder's files in order of their paths."""
    listing = readers.file_listing(spark, _waves(spark, sf), "*.wav")
    return readers.sorted_listing(listing).select("name", "stem", "position")


@query("SELECT word FROM common_words")
def lexicon_words(spark, sf):
    """First words of a lexicon's lines."""
    at = scratch_folder(spark, "lexicon")
    read_table(spark, sf, "common_words").select(F.concat(F.lit(" "), "word", F.lit("  a b c\n\n")).alias("value")).write.text(at)
    return readers.lexicon(spark, at)


@query("SELECT id, 50::BIGINT AS n_samples, 0.0::DOUBLE AS level FROM range(20) r(id)")
def silent_waves(spark, sf):
    """Silence made where it is used."""
    waves = readers.synthetic(spark, 20, 50, "silence")
    return waves.select("id", F.size("wav").cast("long").alias("n_samples"), audio.mean_power(F.col("wav")).alias("level"))


@query("SELECT 0::BIGINT AS n_rows, 3::BIGINT AS n_columns")
def missing_source(spark, sf):
    """A source that does not exist is an empty table with its columns."""
    none = readers.json_lines(spark, f"{sf}/no-such-folder", "audio STRING, text STRING, prompt STRING")
    return none.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(none.columns)).cast("long"))


@query("SELECT tr_id, audio_id FROM transcript_rows")
def dataset_columns(spark, sf):
    """Only the columns asked for."""
    return readers.dataset(spark, f"{sf}/transcript_rows.parquet", "tr_id BIGINT, audio_id STRING", ["tr_id", "audio_id"])


@query(r"""
  WITH r AS (SELECT tr_id, unnest([source_audio_path, 'https://host/' || audio_id, 'data:audio/wav;base64,' || audio_id, repeat('A', 300)]) AS ref FROM transcript_rows)
  SELECT tr_id, ref, CASE WHEN ref LIKE 'http%' THEN 'url' WHEN ref LIKE 'data:audio%' OR length(ref) > 256 THEN 'base64' ELSE 'path' END AS kind FROM r""")
def reference_kinds(spark, sf):
    """What kind of audio reference a value is."""
    refs = F.array(F.col("source_audio_path"), F.concat(F.lit("https://host/"), "audio_id"), F.concat(F.lit("data:audio/wav;base64,"), "audio_id"), F.repeat(F.lit("A"), F.lit(300)))
    rows = read_table(spark, sf, "transcript_rows").select("tr_id", F.explode(refs).alias("ref"))
    return rows.select("tr_id", "ref", T.input_kind(F.col("ref")).alias("kind"))


@query("SELECT tr_id, length('https://host/' || audio_id)::BIGINT AS n_samples, NULL::VARCHAR AS error FROM transcript_rows WHERE audio_id IS NOT NULL")
def fetched_audio(spark, sf):
    """Audio named by a URL, here fetched from a stand-in that answers with as many samples as the URL has letters."""
    rows = read_table(spark, sf, "transcript_rows").where("audio_id is not null").select("tr_id", F.concat(F.lit("https://host/"), "audio_id").alias("ref"))
    got = readers.referenced_audio(rows, "ref", lambda ref: readers.encode_wav(np.zeros(len(ref))))
    return got.select("tr_id", F.size("wav").cast("long").alias("n_samples"), "error")


@query("SELECT config_key, tr_id // 1000 AS block, count(*) AS n, min(tr_id) AS first_id FROM transcript_rows GROUP BY 1, 2")
def speaker_blocks(spark, sf):
    """Samples of each speaker in order, in blocks."""
    got = reports.speaker_samples(read_table(spark, sf, "transcript_rows").select("config_key", "tr_id", "audio_id"), "config_key", "tr_id")
    return got.select("config_key", "block", F.size("samples").cast("long").alias("n"), F.col("samples")[0]["tr_id"].alias("first_id"))


# ---------------------------------------------------------------- records
@query(r"""
  WITH p AS (SELECT *, (row_number() OVER (ORDER BY tr_id) - 1) // 8 AS batch FROM transcript_rows),
       o AS (SELECT DISTINCT batch FROM p WHERE coalesce(error, '') <> '' OR transcription IS NULL)
  SELECT tr_id, batch FROM p WHERE batch IN (SELECT batch FROM o)""")
def open_batches(spark, sf):
    """Batches of eight that are not wholly done, with all their rows."""
    rows = joins.numbered(read_table(spark, sf, "transcript_rows").select("tr_id", "error", "transcription"), [F.col("tr_id")])
    done = (F.coalesce("error", F.lit("")) == "") & F.col("transcription").isNotNull()
    return joins.unfinished_batches(rows, rows, "tr_id", "position", 8, done).select("tr_id", "batch")


@query(r"""
  SELECT config_key, idx, max_by(tr_id, tr_id) FILTER (coalesce(error, '') = '' AND coalesce(transcription, '') <> '') AS tr_id
  FROM transcript_rows WHERE config_key IS NOT NULL AND idx IS NOT NULL GROUP BY 1, 2
  HAVING max_by(tr_id, tr_id) FILTER (coalesce(error, '') = '' AND coalesce(transcription, '') <> '') IS NOT NULL""")
def checkpointed_results(spark, sf):
    """Results written in two rounds, each of which rewrites the whole in order; the second has the last deliveries."""
    at = scratch_folder(spark, "results")
    rows = read_table(spark, sf, "transcript_rows").where("config_key is not null and idx is not null").withColumn("k", F.concat_ws("/", "config_key", F.col("idx").cast("string")))
    good = rows.where(~T.failed_transcript(F.col("transcription"), F.col("error"))).select("k", "config_key", "idx", "tr_id")
    writers.checkpointed(joins.last_by(good, ["k"], -F.col("tr_id")), at, "k", ["config_key", "idx"])
    return writers.checkpointed(joins.last_by(good, ["k"], F.col("tr_id")), at, "k", ["config_key", "idx"]).select("config_key", "idx", "tr_id")


@query("SELECT label AS value, 'label' AS kind, count(*) AS n FROM feature_rows GROUP BY 1 UNION ALL SELECT lang, 'lang', count(*) FROM documents GROUP BY 1")
def united_labels(spark, sf):
    """Rows of two sources in one table, counted."""
    a = read_table(spark, sf, "feature_rows").select(F.col("label").alias("value"), F.lit("label").alias("kind"))
    b = read_table(spark, sf, "documents").select(F.lit("lang").alias("kind"), F.col("lang").alias("value"))
    return joins.union_all(a, b).groupBy("value", "kind").agg(F.count("*").alias("n"))


@query(r"""
  SELECT file_name, coalesce(speakers[1].speaker, 'none') AS first_speaker, file_name AS spk FROM diar_short""")
def first_speakers(spark, sf):
    """First element with a fallback, and a key written over by the file's name."""
    rows = read_table(spark, sf, "diar_short").withColumn("spk", F.lit("x"))
    named = rows.select("file_name", T.first_element(F.transform("speakers", lambda s: s["speaker"]), F.lit("none")).alias("first_speaker"), "spk")
    return joins.with_key(named, "spk", F.col("file_name"))


@query("SELECT tr_id, config_key FROM (SELECT *, row_number() OVER (ORDER BY tr_id) - 1 AS p FROM transcript_rows) WHERE p = 5")
def sixth_row(spark, sf):
    """One row by its position."""
    return joins.row_at(joins.numbered(read_table(spark, sf, "transcript_rows").select("tr_id", "config_key"), [F.col("tr_id")]), "position", 5).drop("position")


@query("SELECT row_id, 'x' AS a, language AS b, CASE WHEN label IS NULL THEN NULL ELSE 'new' END AS c FROM feature_rows")
def overridden_settings(spark, sf):
    """Settings of a row put over the defaults."""
    base = F.create_map(F.lit("a"), F.lit("x"), F.lit("b"), F.lit("old"))
    own = F.when(F.col("label").isNull(), F.create_map(F.lit("b"), F.col("language"))).otherwise(F.create_map(F.lit("b"), F.col("language"), F.lit("c"), F.lit("new")))
    m = T.override_map(base, own)
    rows = read_table(spark, sf, "feature_rows").select("row_id", m.alias("m"))
    return rows.select("row_id", *[F.try_element_at("m", F.lit(k)).alias(k) for k in "abc"])


@query("SELECT n_nationkey, 'context ' || n_nationkey AS context, 'en' AS language FROM nation")
def batch_contexts(spark, sf):
    """A context for each row and one language for all."""
    rows = joins.numbered(read_table(spark, sf, "nation").select(F.col("n_nationkey")), [F.col("n_nationkey")])
    given = joins.constant_or_per_row(rows, "context", [f"context {k}" for k in range(25)], "position")
    return joins.constant_or_per_row(given, "language", "en", "position").drop("position")


@query(r"""
  SELECT tr_id, CASE WHEN transcription IS NULL THEN NULL WHEN trim(regexp_replace(transcription, '\s', ' ', 'g')) = '' THEN 'blank'
                     WHEN position('?' IN transcription) > 0 THEN NULL ELSE length(transcription)::VARCHAR END AS answer,
         coalesce(position('?' IN transcription) > 0, false) AS failed FROM transcript_rows""")
def answered_transcripts(spark, sf):
    """A batch model that counts characters and fails on questions: blank texts skip it, faults stay with their row."""
    def count(_, texts):
        if any("?" in t for t in texts):
            raise ValueError("a question")
        return [str(len(t)) for t in texts]

    model = models.BatchModel("lengths", lambda: None, count)
    rows = read_table(spark, sf, "transcript_rows").select("tr_id", "transcription")
    got = models.apply_model(rows, model, "transcription", "answer", skip_blank="blank")
    return got.select("tr_id", "answer", F.col("answer_error").isNotNull().alias("failed"))


@query("SELECT vec_id::VARCHAR AS file_name, i AS seg_id, i * 1.5 AS start_time, i * 1.5 + 1 AS end_time, 'speaker_' || (i % 2) AS spk_id FROM embeddings, range(3) r(i)")
def diarized_waves(spark, sf):
    """A diarization model's answers as segments; here one that finds three turns in everything and adds a broken line."""
    lines = [f"{i * 1.5} {i * 1.5 + 1} speaker_{i % 2}" for i in range(3)] + ["not a segment"]
    model = models.BatchModel("three turns", lambda: None, lambda _, waves: [lines for _ in waves], "array<string>")
    return models.diarize(read_table(spark, sf, "embeddings"), model, "vec_id", "embedding")


@query(r"""
  WITH r AS (SELECT row_id, coalesce(language, 'None') AS l, coalesce(audio_id, '') AS t FROM feature_rows),
       s AS (SELECT row_id, t, regexp_replace(l, '^\s+|\s+$', '', 'g') AS l FROM r)
  SELECT row_id, CASE WHEN lower(l) LIKE 'none%' THEN '' ELSE concat(upper(left(l, 1)), lower(substr(l, 2))) END AS language, t AS text FROM s""")
def tagged_answers(spark, sf):
    """Language and text of recognisers' raw answers about a recording's id."""
    raw = F.concat(F.lit("language "), F.coalesce("language", F.lit("None")), F.lit("<asr_text>"), F.coalesce("audio_id", F.lit("")))
    return read_table(spark, sf, "feature_rows").select("row_id", T.parse_asr_output(raw).alias("p")).select("row_id", "p.language", "p.text")


@query("SELECT row_id, 'High' AS intensity, nullif(trim(label), '') AS emotion, NULL::VARCHAR AS sections FROM feature_rows")
def labelled_answers(spark, sf):
    """Fields of answers in plain text."""
    raw = F.concat(F.lit("Intensity: High\nemotion:  "), F.coalesce("label", F.lit("")), F.lit("\nReasoning: none"))
    got = read_table(spark, sf, "feature_rows").select("row_id", V.labelled_answer(raw).alias("a"))
    return got.select("row_id", "a.intensity", "a.emotion", "a.sections")


@query("SELECT row_id, CASE WHEN label = 'discard' THEN idx::VARCHAR END AS idx, label = 'discard' AS is_object FROM feature_rows WHERE label IS NOT NULL")
def json_arguments(spark, sf):
    """Arguments that must be JSON objects; here lists and broken ones stand beside them."""
    rows = read_table(spark, sf, "feature_rows").where("label is not null")
    arg = F.when(F.col("label") == "discard", F.to_json(F.struct("idx"))).when(F.col("label") == "neutral", "[1, 2]").otherwise('{"idx": ')
    got = rows.select("row_id", V.json_argument(arg).alias("m"))
    return got.select("row_id", F.try_element_at("m", F.lit("idx")).alias("idx"), F.col("m").isNotNull().alias("is_object"))


@query(r"""SELECT row_id, CASE WHEN lower(coalesce(label, '')) LIKE '%discard%' THEN 'discard' WHEN text_features.wpm > 150 THEN 'highly_emotional' ELSE 'neutral' END AS decision FROM feature_rows""")
def final_decisions(spark, sf):
    """Text tier and voice tier in one decision; the voice's stands in for by the speed."""
    voice = F.when(F.col("text_features.wpm") > 150, "High Intensity").otherwise("Neutral")
    return read_table(spark, sf, "feature_rows").select("row_id", audio.combined_decision(F.col("label"), voice).alias("decision"))


@query(r"""
  SELECT tr_id, '<|im_start|>system' || chr(10) || coalesce(config_key, '') || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
           || '<|audio_start|><|audio_pad|><|audio_end|><|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prefix,
         list_transform(range(1, len(chunk_transcriptions) + 1), lambda i: CASE WHEN i <= num_chunks // 2 THEN -100 ELSE length(chunk_transcriptions[i])::INTEGER END) AS labels
  FROM transcript_rows WHERE chunk_transcriptions IS NOT NULL AND num_chunks IS NOT NULL""")
def training_rows(spark, sf):
    """Prefix of a training row, and its labels with the prefix masked."""
    rows = read_table(spark, sf, "transcript_rows").where("chunk_transcriptions is not null and num_chunks is not null")
    ids = F.transform("chunk_transcriptions", F.length)
    return rows.select("tr_id", T.training_prefix(F.col("config_key")).alias("prefix"), S.label_mask(ids, F.floor(F.col("num_chunks") / 2)).alias("labels"))


@query("SELECT tr_id, 'a <|pad|> b'[:2] || repeat('<|pad|>', num_chunks) || ' b' AS prompt FROM transcript_rows WHERE num_chunks IS NOT NULL")
def expanded_prompts(spark, sf):
    """A placeholder repeated as often as there are chunks."""
    rows = read_table(spark, sf, "transcript_rows").where("num_chunks is not null")
    return rows.select("tr_id", T.expand_placeholder(F.lit("a <|pad|> b"), "<|pad|>", F.col("num_chunks")).alias("prompt"))


@query("""SELECT file_name, '<|audio_start|><|audio_pad|><|audio_end|>' || array_to_string(list_transform(speakers, lambda s: s.speaker || '<timestamp><timestamp>'), '') AS prompt
  FROM diar_short WHERE speakers IS NOT NULL""")
def aligner_prompts(spark, sf):
    """Prompts of the aligner; here the labels of a file stand for words."""
    rows = read_table(spark, sf, "diar_short").where("speakers is not null")
    return rows.select("file_name", T.aligner_prompt(F.transform("speakers", lambda s: s["speaker"])).alias("prompt"))


@query(r"""
  SELECT row_id, list_filter(regexp_split_to_array(regexp_replace(regexp_replace(coalesce(text, ''),
    '([\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2CEAF}])', ' \1 ', 'g'), '[^\p{L}\p{N}'']', ' ', 'g'), ' +'), lambda x: x <> '') AS tokens
  FROM feature_rows""")
def mixed_tokens(spark, sf):
    """Chinese characters and runs of other letters."""
    return read_table(spark, sf, "feature_rows").select("row_id", T.chinese_mixed_tokens(F.col("text")).alias("tokens"))


@query("SELECT config_key, array_to_string(list_transform(string_split(replace(config_key, '_', ' '), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS name FROM feature_rows GROUP BY 1")
def display_names(spark, sf):
    """Names of sets as a person reads them."""
    return read_table(spark, sf, "feature_rows").select("config_key").distinct().select("config_key", T.title_display(F.col("config_key")).alias("name"))


@query(r"""
  WITH t AS (SELECT tr_id, duration_sec AS d, length(transcription) AS n FROM transcript_rows WHERE duration_sec > 0),
  e AS (SELECT tr_id, d, n, unnest(range(CASE WHEN d <= 30 THEN 1 ELSE ceil((d - 30) / 29)::BIGINT + 1 END)) AS i FROM t)
  SELECT tr_id, n / greatest(d, 0.001) * 60 AS wpm, i::INTEGER AS chunk_index, (i * 29)::DOUBLE AS chunk_start FROM e""")
def sql_functions(spark, sf):
    """Registered functions and a table function, called by name from SQL over a registered view."""
    sql_api.register(spark, sf, ("transcript_rows",))
    return spark.sql(
        "SELECT tr_id, words_per_minute(length(transcription), duration_sec) AS wpm, c.chunk_index, c.chunk_start "
        "FROM transcript_rows, LATERAL chunk_plan(duration_sec, 30.0D, 1.0D) c WHERE duration_sec > 0"
    )


@query("SELECT k.config_key, true AS even FROM (SELECT DISTINCT config_key FROM transcript_rows WHERE config_key IS NOT NULL) k")
def even_decks(spark, sf):
    """Whether the decks of simulated sessions use every speaker as often as any other, within one."""
    from voxloom.operators.simulate import speaker_permutations

    names = [r.config_key for r in read_table(spark, sf, "transcript_rows").where("config_key is not null").select("config_key").distinct().orderBy("config_key").collect()]
    decks = speaker_permutations(names, min(2, len(names)), 50, 3)
    uses = spark.createDataFrame([(str(s),) for deck in decks for s in deck], "config_key string").groupBy("config_key").agg(F.count("*").alias("n"))
    whole = stage(uses, "decks")
    ends = whole.agg(F.min("n").alias("lo"), F.max("n").alias("hi")).first()
    return whole.select("config_key", F.lit((ends.hi or 0) - (ends.lo or 0) <= 1).alias("even"))


@query("SELECT 'idx' || vec_id || '_' || label || '.wav' AS name FROM embeddings")
def audited_files(spark, sf):
    """Copies of files under names for listening."""
    at = _waves(spark, sf)
    path = F.concat(F.lit(f"{mounted(at)}/"), F.col("vec_id").cast("string"), F.lit(".wav"))
    rows = read_table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("string").alias("audio_id"), path.alias("source_audio_path"))
    copies = writers.audit_copies(rows, mounted(scratch_folder(spark, "audit")), index="vec_id")
    return copies.select(F.substring_index("path", "/", -1).alias("name"))


@query("SELECT doc_id, octet_length(encode(text)) % 4 = 0 AS whole FROM documents WHERE text IS NOT NULL")
def posted_chunks(spark, sf):
    """Whether a posted body holds whole samples; here texts stand for bodies."""
    return read_table(spark, sf, "documents").where("text is not null").select("doc_id", readers.valid_chunk(F.encode("text", "UTF-8")).alias("whole"))


@query("SELECT * FROM (VALUES (0::BIGINT, 4::BIGINT, 16000, 2.0::DOUBLE), (1, 3, 8000, 3.0)) t(id, n_samples, sr, total)")
def held_waves(spark, sf):
    """Waveforms that the caller holds, mono, with their rates."""
    got = readers.in_memory(spark, [(np.array([[1.0, 0.0, 1.0, 0.0], [1.0, 0.0, 1.0, 0.0]]), 16000), (np.ones(3), 8000)])
    return got.select("id", F.size("wav").cast("long").alias("n_samples"), "sr", F.aggregate("wav", F.lit(0.0), lambda a, x: a + x.cast("double")).alias("total"))


@query(r"""
  SELECT vec_id::VARCHAR AS orig_index, 'English' AS language, '24 24 16' AS text, 3::INTEGER AS n_chunks,
         [0.0, 3.0, 6.0]::DOUBLE[] AS starts FROM embeddings""")
def recognised_signals(spark, sf):
    """Recognition and alignment of recordings by stand-in models: chunks, answers, spans, and whole recordings again."""
    signal = F.transform(F.sequence(F.lit(1), F.size("embedding")), lambda i: F.when(i % 24 == 1, 0.0).otherwise(1.0).cast("float"))
    rows = read_table(spark, sf, "embeddings").select("vec_id", signal.alias("wav"))
    asr = models.BatchModel("lengths", lambda: None, lambda _, waves: [f"language english<asr_text>{len(w)}" for w in waves])
    kind = "array<struct<text:string,start_time:double,end_time:double>>"
    aligner = models.BatchModel("one span", lambda: None, lambda _, texts: [[{"text": t, "start_time": 0.0, "end_time": 1.0}] for t in texts], kind)
    chunks = audio.quiet_chunks(rows, "wav", "vec_id", rate=8, max_seconds=3.0, search=0.25)
    spoken = models.recognised(chunks, asr, aligner)
    return spoken.select("orig_index", "language", "text", "n_chunks", F.transform("time_stamps", lambda x: x["start_time"]).alias("starts"))
