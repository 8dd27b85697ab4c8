"""Transcript curation: text features, tiers, verdicts and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.functions import verdict as V
from voxloom.operators import joins, reports
from voxloom.plans.registry import query
from voxloom.session import read_table, spread


def with_features(df: DataFrame, text: Column, duration: Column, lang: Column) -> DataFrame:
    """The rows with tokens and the text features, each computed once."""
    tokens = df.withColumn("words", T.language_tokens(text, lang)).withColumn("_d", duration).withColumn("_lang", lang)
    counted = tokens.withColumn("word_count", F.size("words").cast("long"))
    timed = counted.withColumn("talk_time", T.estimated_talk_time(F.col("word_count"), F.col("_d"))).withColumn("wpm", T.words_per_minute(F.col("word_count"), F.col("_d")))
    return timed.withColumn("speech_ratio", F.col("talk_time") / T.safe_duration(F.col("_d"))).withColumns(
        {"word_repetition": T.word_repetition(F.col("words")), "redundancy_score": T.redundancy(F.col("words"))}
    )


def with_tier(df: DataFrame) -> DataFrame:
    """The rows of ``with_features`` with ``tier`` and the rule that discarded them."""
    args = [F.col(c) for c in ("wpm", "speech_ratio", "word_repetition", "redundancy_score", "_lang")]
    return df.withColumn("tier", T.quality_tier(*args)).withColumn("reason", T.discard_reason(*args))


def _lang() -> Column:
    return F.substring_index("config_key", "_", 1)


def _rows(spark, sf) -> DataFrame:
    return read_table(spark, sf, "feature_rows").where("text_features is not null and text_features.true_duration is not null")


def _featured(spark, sf) -> DataFrame:
    # Counting words over Arrow batches is worth a core for each part of a small table.
    return with_features(spread(_rows(spark, sf), "row_id", waves=1), F.col("text"), F.col("text_features.true_duration"), _lang())


_TOKENS = r"""
  WITH b AS (
    SELECT row_id, config_key, split_part(config_key, '_', 1) AS lang, text_features.true_duration AS d,
           replace(replace(coalesce(text, ''), '<Speaker1>:', ''), '<Speaker2>:', '') AS body
    FROM feature_rows WHERE text_features IS NOT NULL AND text_features.true_duration IS NOT NULL),
  w AS (
    SELECT row_id, config_key, lang, d, list_transform(regexp_extract_all(body, CASE lang
      WHEN 'zh' THEN '[一-鿿]' WHEN 'ta' THEN '[஀-௿]+|[a-zA-Z0-9]+' ELSE '[a-zA-Z0-9]+' END), lambda x: lower(x)) AS words FROM b),
  m AS (
    SELECT *, len(words) AS n, least(len(words) / 2.3, d) AS talk, len(words) / greatest(d, 0.001) * 60 AS wpm,
           least(len(words) / 2.3, d) / greatest(d, 0.001) AS ratio FROM w),
  s AS (
    SELECT *,
      CASE WHEN n >= 5 THEN round(len(list_filter(range(1, n - 3), lambda i: len(list_filter(words[i:i+2],
        lambda x: len(list_filter(words[i:i+4], lambda y: y = x)) >= 3)) > 0)) / (n - 4), 4) ELSE 0.0 END AS rep,
      CASE WHEN n >= 3 THEN round(((n - 2) - len(list_distinct(list_transform(range(1, n - 1),
        lambda i: array_to_string(words[i:i+2], ' '))))) / (n - 2), 4) ELSE 0.0 END AS red FROM m),
  t AS (
    SELECT *, CASE WHEN wpm < CASE lang WHEN 'zh' THEN 110 WHEN 'ta' THEN 50 ELSE 70 END THEN 'slow'
                   WHEN ratio < 0.5 THEN 'little_speech'
                   WHEN rep > CASE lang WHEN 'zh' THEN 0.5 ELSE 0.4 END THEN 'stutter'
                   WHEN red > 0.4 THEN 'redundant' END AS reason FROM s)
"""


@query(_TOKENS + "SELECT row_id, n AS word_count, talk AS talk_time, wpm, ratio AS speech_ratio FROM m")
def text_metrics(spark, sf):
    return _featured(spark, sf).select("row_id", "word_count", "talk_time", "wpm", "speech_ratio")


@query(_TOKENS + "SELECT row_id, rep AS word_repetition FROM s")
def stutter_windows(spark, sf):
    return _featured(spark, sf).select("row_id", "word_repetition")


@query(_TOKENS + "SELECT row_id, red AS redundancy_score FROM s")
def ngram_redundancy(spark, sf):
    return _featured(spark, sf).select("row_id", "redundancy_score")


@query(_TOKENS + "SELECT row_id, CASE WHEN reason IS NULL THEN 'neutral' ELSE 'discard' END AS tier, reason FROM t")
def quality_tiers(spark, sf):
    return with_tier(_featured(spark, sf)).select("row_id", "tier", "reason")


@query(
    _TOKENS
    + r"""SELECT coalesce(lang, 'TOTAL') AS lang, count(*) AS n_rows, count(reason) AS n_hits,
            round(count(reason) / count(*) * 100, 2) AS hit_pct FROM t GROUP BY ROLLUP (lang)"""
)
def tier_report(spark, sf):
    """The flagship: tokens, metrics, repetition, redundancy, tier, and the share discarded by language with its total."""
    rows = with_tier(_featured(spark, sf)).select(F.col("_lang").alias("lang"), "reason")
    return reports.share_report(rows, "lang", F.col("reason").isNotNull())


@query(r"""
  SELECT row_id, length(text) / text_features.true_duration * 60 AS cpm FROM feature_rows
  WHERE text IS NOT NULL AND text_features.true_duration > 0 AND text_features.speech_ratio >= 0.7
    AND length(text) / text_features.true_duration * 60 >= 600""")
def fast_speech(spark, sf):
    """Conjunctive thresholds; rows without a duration are dropped."""
    d = F.col("text_features.true_duration")
    cpm = T.characters_per_minute(F.col("text"), d)
    return read_table(spark, sf, "feature_rows").where((d > 0) & (F.col("text_features.speech_ratio") >= 0.70)).select("row_id", cpm.alias("cpm")).where("cpm >= 600")


@query(r"""
  WITH t AS (SELECT tr_id, config_key, idx, arg_max(struct_pack(a := transcription, d := duration_sec, e := error), tr_id) OVER (PARTITION BY config_key, idx) AS x,
                    row_number() OVER (PARTITION BY config_key, idx ORDER BY tr_id DESC) AS r FROM transcript_rows),
       l AS (SELECT config_key, idx, x FROM t WHERE r = 1)
  SELECT f.row_id, coalesce(length(l.x.a), 0) AS n_chars, l.x.d AS duration_sec, l.config_key IS NOT NULL AS found
  FROM feature_rows f LEFT JOIN l ON f.config_key = l.config_key AND f.idx = l.idx""")
def transcript_lookup(spark, sf):
    """Left lookup of transcripts by set and number; of repeated deliveries the last counts."""
    key = F.concat_ws("/", "config_key", F.col("idx").cast("string"))
    left = read_table(spark, sf, "feature_rows").select("row_id", key.alias("k"))
    right = read_table(spark, sf, "transcript_rows").select(key.alias("k2"), "tr_id", "transcription", "duration_sec")
    joined = joins.lookup_join(left, right, "k", "k2", F.col("tr_id"))
    return joined.select("row_id", F.coalesce(F.length("transcription"), F.lit(0)).alias("n_chars"), "duration_sec", F.col("tr_id").isNotNull().alias("found"))


@query(r"""
  SELECT tr_id, CASE WHEN coalesce(error, '') <> '' OR coalesce(transcription, '') = '' THEN 'discard' ELSE 'pending' END AS label
  FROM transcript_rows""")
def failed_transcripts(spark, sf):
    failed = T.failed_transcript(F.col("transcription"), F.col("error"))
    return read_table(spark, sf, "transcript_rows").select("tr_id", F.when(failed, "discard").otherwise("pending").alias("label"))


@query(r"""
  SELECT coalesce(config_key, 'none') AS config_key, idx, count(*) AS n FROM transcript_rows t
  WHERE NOT EXISTS (SELECT 1 FROM transcript_rows d WHERE d.tr_id = t.tr_id AND coalesce(d.error, '') = '' AND d.transcription IS NOT NULL)
  GROUP BY 1, 2""")
def unfinished_transcripts(spark, sf):
    """What is left to do: rows that have no result yet."""
    rows = read_table(spark, sf, "transcript_rows")
    done = (F.coalesce("error", F.lit("")) == "") & F.col("transcription").isNotNull()
    left = joins.unfinished(rows, rows, "tr_id", done)
    return left.groupBy(F.coalesce("config_key", F.lit("none")).alias("config_key"), "idx").agg(F.count("*").alias("n"))


@query(r"""
  WITH old AS (SELECT tr_id, concat(coalesce(config_key, ''), '/', coalesce(idx::VARCHAR, '')) AS k, duration_sec,
                      coalesce(error, '') = '' AND coalesce(transcription, '') <> '' AS done FROM transcript_rows),
       new AS (SELECT tr_id, k, duration_sec FROM old WHERE done QUALIFY row_number() OVER (PARTITION BY k ORDER BY tr_id DESC) = 1)
  SELECT tr_id, k, duration_sec FROM old WHERE k NOT IN (SELECT k FROM new) UNION ALL SELECT tr_id, k, duration_sec FROM new""")
def redelivered_results(spark, sf):
    """The whole table, where the last delivery with a result replaces all rows of its set and number; keys without a result stay."""
    key = F.concat(F.coalesce("config_key", F.lit("")), F.lit("/"), F.coalesce(F.col("idx").cast("string"), F.lit("")))
    rows = read_table(spark, sf, "transcript_rows").withColumn("k", key)
    last = rows.where(~T.failed_transcript(F.col("transcription"), F.col("error"))).groupBy("k").agg(F.max_by(F.struct("tr_id", "duration_sec"), "tr_id").alias("r"))
    return joins.upsert(rows.select("tr_id", "k", "duration_sec"), last.select("k", "r.tr_id", "r.duration_sec"), "k")


@query(r"""
  SELECT tr_id, coalesce(array_to_string(list_filter(chunk_transcriptions, lambda x: x IS NOT NULL AND x <> ''), ' '), NULL) AS merged,
         array_to_string(list_filter(chunk_transcriptions, lambda x: x IS NOT NULL AND x <> ''), '') AS joined FROM transcript_rows""")
def merged_chunks(spark, sf):
    parts = F.col("chunk_transcriptions")
    return read_table(spark, sf, "transcript_rows").select("tr_id", T.merge_texts(parts, " ").alias("merged"), T.merge_texts(parts, "").alias("joined"))


@query(r"""
  SELECT row_id, lower(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}'']', '', 'g')) AS cleaned,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '')) AS n_words FROM feature_rows""")
def cleaned_tokens(spark, sf):
    text = F.coalesce("text", F.lit(""))
    return read_table(spark, sf, "feature_rows").select("row_id", F.lower(T.clean_token(text)).alias("cleaned"), F.size(F.filter(F.split(text, r"[\t\n\f\r ]+"), lambda w: w != "")).cast("long").alias("n_words"))


@query(r"""
  WITH w AS (
    SELECT row_id, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '[\t\n\v\f\r \x{85}\p{Z}]+'),
      lambda x: regexp_replace(x, '[^\p{L}\p{N}'']', '', 'g')), lambda x: x <> '') AS ws FROM feature_rows)
  SELECT row_id, flatten(list_transform(ws, lambda x: regexp_extract_all(x,
    '[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2CEAF}]|[^\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2CEAF}]+'))) AS tokens FROM w""")
def alignment_tokens(spark, sf):
    return read_table(spark, sf, "feature_rows").select("row_id", T.aligner_tokens(F.col("text")).alias("tokens"))


@query()
def collapsed_texts(spark, sf):
    """Texts whose loops of characters or short patterns are taken back to one copy.

    DuckDB's expressions have no back references, so there is no SQL.
    """
    rows = read_table(spark, sf, "feature_rows").where("text is not null").select("row_id", "text", T.collapse_repetitions(F.col("text")).alias("collapsed"))
    return rows.where("collapsed <> text").select("row_id", F.length("text").alias("n_before"), F.length("collapsed").alias("n_after"))


@query()
def parsed_answers(spark, sf):
    """Language and text of recognisers' raw answers, put together from labels and texts."""
    rows = read_table(spark, sf, "feature_rows")
    raw = F.concat(F.lit("language "), F.coalesce("language", F.lit("None")), F.lit("<asr_text>"), F.coalesce("text", F.lit("")))
    return rows.select("row_id", T.parse_asr_output(raw).alias("p")).select("row_id", "p.language", F.length("p.text").alias("n_chars"))


_VERDICTS = r"""
  WITH d AS (SELECT doc_id, lang, text AS raw FROM documents WHERE source = 'llm_verdict'),
  b AS (
    SELECT *, trim(replace(replace(CASE WHEN regexp_matches(raw, '(?s)\{.*\}') THEN regexp_extract(raw, '(?s)\{.*\}') ELSE raw END,
      '```json', ''), '```', ''), ' ' || chr(9) || chr(10) || chr(13)) AS body FROM d),
  p AS (SELECT *, coalesce(json_valid(body) AND json_type(try_cast(body AS JSON)) = 'OBJECT', false) AS ok FROM b),
  v AS (
    SELECT *, CASE WHEN ok THEN CASE WHEN json_type(body, '$.Verdict') = 'NULL' THEN 'NONE' ELSE upper(coalesce(json_extract_string(body, '$.Verdict'), '')) END END AS value,
      regexp_matches(upper(raw), '"VERDICT": ?"KEEP"') AS k, regexp_matches(upper(raw), '"VERDICT": ?"DISCARD"') AS x FROM p)
"""


def _answers(spark, sf) -> DataFrame:
    return read_table(spark, sf, "documents").where("source = 'llm_verdict'").select("doc_id", "lang", F.col("text").alias("raw"))


@query(
    _VERDICTS
    + r"""SELECT doc_id,
      CASE WHEN coalesce(raw, '') = '' THEN 'ERROR' WHEN ok THEN value WHEN k THEN 'KEEP' WHEN x THEN 'DISCARD' ELSE 'UNKNOWN' END AS analysis,
      CASE WHEN coalesce(raw, '') = '' THEN 'UNKNOWN' WHEN ok THEN value WHEN x THEN 'DISCARD' ELSE 'KEEP' END AS audit FROM v"""
)
def verdicts(spark, sf):
    """Verdicts in answers that may be fenced or broken, by the rules of analysis and of audit."""
    raw = F.col("raw")
    return _answers(spark, sf).select("doc_id", V.analysis_verdict(raw).alias("analysis"), V.audit_verdict(raw).alias("audit"))


@query(
    r"""WITH d AS (SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(text, '') AS raw FROM documents WHERE source = 'llm_verdict'),
  f AS (SELECT *, trim(replace(replace(CASE WHEN regexp_matches(raw, '(?s)\{.*\}') THEN regexp_extract(raw, '(?s)\{.*\}') ELSE raw END,
      '```json', ''), '```', ''), ' ' || chr(9) || chr(10) || chr(13)) AS b0 FROM d),
  b AS (SELECT *, CASE WHEN length(b0) - length(replace(b0, '{', '')) > length(b0) - length(replace(b0, '}', '')) THEN b0 || '}' ELSE b0 END AS body FROM f),
  p AS (SELECT *, coalesce(json_valid(body) AND json_type(try_cast(body AS JSON)) = 'OBJECT', false) AS ok FROM b),
  v AS (
    SELECT lang, CASE WHEN raw = '' THEN 'ERROR'
      WHEN ok THEN CASE WHEN upper(coalesce(json_extract_string(body, '$.Verdict'), '')) LIKE '%KEEP%' THEN 'KEEP'
                        WHEN upper(coalesce(json_extract_string(body, '$.Verdict'), '')) LIKE '%DISCARD%' THEN 'DISCARD' ELSE 'ERROR' END
      WHEN regexp_matches(upper(raw), '"VERDICT": ?"KEEP"') THEN 'KEEP'
      WHEN regexp_matches(upper(raw), '"VERDICT": ?"DISCARD"') THEN 'DISCARD' ELSE 'ERROR' END AS r FROM p)
  SELECT coalesce(lang, 'TOTAL') AS lang, count(*) AS n_rows, count(*) FILTER (r = 'KEEP') AS n_keep, count(*) FILTER (r = 'DISCARD') AS n_discard,
         count(*) FILTER (r = 'ERROR') AS n_error, round(count(*) FILTER (r = 'KEEP') / count(*) * 100, 1) AS keep_pct
  FROM v GROUP BY ROLLUP (lang)"""
)
def verdict_report(spark, sf):
    return reports.verdict_report(_answers(spark, sf), "lang", V.report_verdict(F.col("raw")))


@query(
    _VERDICTS
    + r"""SELECT doc_id, CASE WHEN NOT ok THEN []::VARCHAR[] WHEN json_type(body, '$.Emotion_Label') = 'ARRAY'
      THEN list_transform(json_extract_string(body, '$.Emotion_Label[*]'), lambda x: lower(x))
      WHEN json_extract_string(body, '$.Emotion_Label') IS NULL THEN []::VARCHAR[]
      ELSE [lower(json_extract_string(body, '$.Emotion_Label'))] END AS labels FROM v"""
)
def answer_labels(spark, sf):
    return _answers(spark, sf).select("doc_id", V.answer_labels(F.col("raw")).alias("labels"))


@query(r"""
  SELECT doc_id, regexp_matches(coalesce(text, ''), '(?i)"Verdict":\s*"DISCARD"') AS discards,
         position('TRUE' IN upper(coalesce(list_extract(string_split(text, 'Transcript:'), -1), ''))) > 0 AS says_true
  FROM documents WHERE source = 'llm_verdict'""")
def answer_tests(spark, sf):
    raw = F.col("raw")
    return _answers(spark, sf).select("doc_id", V.has_verdict(raw, "DISCARD").alias("discards"), V.answer_is_true(raw).alias("says_true"))


@query(r"""
  WITH c AS (SELECT config_key, language, count(*) AS n, min(row_id) AS f FROM feature_rows
             WHERE language IS NOT NULL AND language NOT IN ('unknown') GROUP BY 1, 2)
  SELECT config_key, language, n, row_number() OVER (PARTITION BY config_key ORDER BY n DESC, f, language) AS rank
  FROM c QUALIFY rank <= 3""")
def top_language_labels(spark, sf):
    """The three most frequent labels of each set, of equally frequent ones the one seen first."""
    return reports.top_labels(read_table(spark, sf, "feature_rows"), "config_key", "language", F.col("row_id"), exclude=("unknown",))


@query(r"""
  WITH h AS (SELECT config_key, row_id, row_id // 10000 AS b FROM feature_rows WHERE label IN ('discard', 'Discard')),
       l AS (SELECT config_key, b, array_to_string(list(row_id ORDER BY row_id), ', ') AS ids FROM h GROUP BY 1, 2),
       n AS (SELECT config_key, row_number() OVER (PARTITION BY config_key ORDER BY b) - 1 AS block, ids FROM l)
  SELECT g.config_key, coalesce(n.block, 0) AS block, coalesce(n.ids, 'None.') AS ids
  FROM (SELECT DISTINCT config_key FROM feature_rows) g LEFT JOIN n USING (config_key)""")
def discarded_ids(spark, sf):
    return reports.id_lists(read_table(spark, sf, "feature_rows"), "config_key", F.lower("label") == "discard", "row_id")


@query(r"""
  SELECT g.code, count(f.row_id) AS n_rows FROM (VALUES ('en'), ('zh'), ('ms_3'), ('x')) g(code)
  LEFT JOIN feature_rows f ON starts_with(f.config_key, g.code) GROUP BY 1""")
def set_prefixes(spark, sf):
    """Rows whose set begins with a code."""
    codes = spark.createDataFrame([("en",), ("zh",), ("ms_3",), ("x",)], "code string")
    return joins.prefix_counts(codes, read_table(spark, sf, "feature_rows"), "code", "config_key")


@query(r"""
  WITH a AS (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS position FROM feature_rows),
       b AS (SELECT tr_id, row_number() OVER (ORDER BY tr_id) - 1 AS position FROM transcript_rows)
  SELECT position, row_id, tr_id FROM a JOIN b USING (position)""")
def zipped_rows(spark, sf):
    """Rows of two tables by their position, as many as the shorter one has."""
    a, b = read_table(spark, sf, "feature_rows").select("row_id"), read_table(spark, sf, "transcript_rows").select("tr_id")
    return joins.zip_join(a, b, [F.col("row_id")], [F.col("tr_id")])


@query("SELECT doc_id FROM documents WHERE coalesce(audio_id, '') <> '' AND audio_id IN (SELECT audio_id FROM transcript_rows)")
def documents_with_audio(spark, sf):
    """Documents whose recording exists."""
    docs = read_table(spark, sf, "documents").select("doc_id", "audio_id")
    return joins.existing_files(docs, read_table(spark, sf, "transcript_rows"), "audio_id", "audio_id").select("doc_id")


@query(r"""
  WITH t AS (SELECT tr_id, config_key, split_part(audio_id, '_', 1) AS rec FROM transcript_rows WHERE audio_id IS NOT NULL),
       f AS (SELECT row_id, split_part(audio_id, '_', 1) AS rec FROM feature_rows WHERE audio_id IS NOT NULL)
  SELECT rec, count(*) AS n_pairs FROM f JOIN t USING (rec) GROUP BY rec""")
def recording_pairs(spark, sf):
    """Inner join of feature rows and transcripts on the cleaned id, counted by recording.

    Counting before the join keeps a hot recording at one row a side.
    """
    t = read_table(spark, sf, "transcript_rows").where("audio_id is not null").groupBy(T.leading_label(F.col("audio_id")).alias("rec")).agg(F.count("*").alias("a"))
    f = read_table(spark, sf, "feature_rows").where("audio_id is not null").groupBy(T.leading_label(F.col("audio_id")).alias("rec")).agg(F.count("*").alias("b"))
    return joins.stem_join(f, t, F.col("rec"), F.col("rec")).select("rec", (F.col("a") * F.col("b")).alias("n_pairs"))


@query("SELECT count(*) FILTER (text IS NOT NULL) AS processed, count(*) FILTER (text IS NULL) AS skipped FROM feature_rows")
def processed_rows(spark, sf):
    return reports.processed_counts(read_table(spark, sf, "feature_rows"), F.col("text").isNotNull())


@query("SELECT label, count(*) AS n FROM feature_rows GROUP BY label")
def label_frequencies(spark, sf):
    return reports.frequencies(read_table(spark, sf, "feature_rows"), "label")


@query("SELECT row_id, row_id % 2 AS worker, row_id // 8 AS batch FROM feature_rows")
def dispatched_rows(spark, sf):
    """Round-robin worker and batch of each row."""
    rows = read_table(spark, sf, "feature_rows").select("row_id")
    return joins.batches(joins.round_robin(rows, "row_id", 2), "row_id", 8).withColumn("worker", F.col("worker").cast("long"))


@query("SELECT row_id, config_key FROM feature_rows ORDER BY row_id LIMIT 100")
def first_hundred(spark, sf):
    """The head of a table in a given order."""
    return joins.head(read_table(spark, sf, "feature_rows").select("row_id", "config_key"), [F.col("row_id")], 100)


@query(r"""
  WITH l AS (SELECT row_id, trim(regexp_replace(coalesce(language, ''), '^\s+|\s+$', '', 'g')) AS label FROM feature_rows),
  n AS (SELECT row_id, lower(label) AS low, CASE WHEN label <> '' THEN concat(upper(left(label, 1)), lower(substr(label, 2))) END AS title FROM l)
  SELECT row_id, CASE WHEN low IN ('en', 'english') THEN 'English' WHEN low IN ('zh', 'chinese') THEN 'Chinese' ELSE title END AS name,
         coalesce(title IN ('Chinese', 'English', 'Cantonese', 'Arabic', 'German', 'French', 'Spanish', 'Portuguese', 'Indonesian', 'Italian',
           'Korean', 'Russian', 'Thai', 'Vietnamese', 'Japanese', 'Turkish', 'Hindi', 'Malay', 'Dutch', 'Swedish', 'Danish', 'Finnish', 'Polish',
           'Czech', 'Filipino', 'Persian', 'Greek', 'Romanian', 'Hungarian', 'Macedonian'), false) AS supported FROM n""")
def labelled_languages(spark, sf):
    """Name and support of the label of every row; a null or blank label has no name and is not supported."""
    title = T.language_name(F.col("language"))
    low = F.lower(title)
    name = F.when(low.isin("en", "english"), "English").when(low.isin("zh", "chinese"), "Chinese").otherwise(title)
    return read_table(spark, sf, "feature_rows").select("row_id", name.alias("name"), T.is_supported_language(F.col("language")).alias("supported"))


@query("SELECT row_id, coalesce(nullif(audio_id, ''), nullif(config_key, ''), '') AS id, concat('clip_', idx) AS clip, replace(config_key, '_', '') AS bare FROM feature_rows")
def row_ids(spark, sf):
    """First id that is there, generated ids, and ids without a prefix."""
    return read_table(spark, sf, "feature_rows").select(
        "row_id", T.first_nonempty(F.col("audio_id"), F.col("config_key")).alias("id"), T.generated_id("clip", F.col("idx")).alias("clip"), T.drop_id_prefix(F.col("config_key"), F.lit("")).alias("bare")
    )


@query(r"""SELECT row_id, replace(replace('Language: {lang}. Text: {text}', '{lang}', coalesce(language, '')), '{text}', coalesce(text, '')) AS prompt FROM feature_rows""")
def rendered_prompts(spark, sf):
    return read_table(spark, sf, "feature_rows").select("row_id", T.render_prompt("Language: {lang}. Text: {text}", lang=F.col("language"), text=F.col("text")).alias("prompt"))


@query("SELECT row_id, text_features.true_duration AS true_duration, text_features.wpm AS wpm, 'x' AS extra FROM feature_rows WHERE text_features IS NOT NULL")
def reshaped_features(spark, sf):
    """A field dropped from a struct, another struct merged in, nested fields read with defaults."""
    f = F.col("text_features").dropFields("word_repetition", "redundancy_score")
    rows = read_table(spark, sf, "feature_rows").where("text_features is not null").select("row_id", F.struct(f["true_duration"].alias("true_duration"), f["wpm"].alias("wpm"), F.lit("x").alias("extra")).alias("s"))
    return rows.select("row_id", "s.*")
