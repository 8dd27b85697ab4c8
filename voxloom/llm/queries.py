"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import lang, mixing, pieces, pii, quality, repetition, tokens, truncation, turns
from voxloom.llm.lm import PieceModel
from voxloom.session import read_table


def _model(spark: SparkSession, sf: str) -> PieceModel:
    """The language model: clean samples, common words, and feature rows whose label agrees."""
    labelled = read_table(spark, sf, "feature_rows").select(F.col("row_id").alias("id"), "text", "language")
    return lang.fit_model(spark, read_table(spark, sf, "lang_samples"), read_table(spark, sf, "common_words"), labelled)


def p1_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Clean turns of the texts of feature_rows with their words."""
    return turns.speaker_turns(read_table(spark, sf, "feature_rows"), read_table(spark, sf, "lang_samples"))


def p1_diar_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of the arrays of diar_short."""
    return turns.diarized_turns(read_table(spark, sf, "diar_short")).select("rec_key", "turn_no", "speaker_no")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    text = p1_turns(spark, sf).select(F.lit("feature_rows").alias("src"), "rec_key", "turn_no", "speaker_no")
    return text.unionByName(p1_diar_turns(spark, sf).withColumn("src", F.lit("diar_short")))


def p3_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """The pieces of every oversized chunk text."""
    items = pieces.oversized_chunks(read_table(spark, sf, "transcript_rows"))
    return pieces.split_items(items).withColumnRenamed("id", "tr_id")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    table = read_table(spark, sf, "transcript_rows")
    split = pieces.split_items(pieces.oversized_chunks(table)).where("piece_no = 1").select("id", "chunk_no", "kind")
    return split.unionByName(pieces.short_recordings(table)).withColumnRenamed("id", "tr_id")


def p4_languages(spark: SparkSession, sf: str) -> DataFrame:
    """Language, confidence and segments of every row of feature_rows."""
    found = lang.languages(read_table(spark, sf, "feature_rows"), _model(spark, sf), keep=("language",))
    return found.select(F.col("id").alias("row_id"), "language", "main_lang", "confidence", "segments")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    found = lang.languages(read_table(spark, sf, "feature_rows"), _model(spark, sf), keep=("language",))
    # Both kinds of faults read the detected languages; staged, they are detected once.
    return lang.label_faults(lang.staged(found)).withColumnRenamed("id", "row_id")


def p5_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics, distance from prose and contributions of every row of feature_rows."""
    got = quality.text_quality(read_table(spark, sf, "feature_rows"), _model(spark, sf), read_table(spark, sf, "common_words"))
    return got.withColumnRenamed("id", "row_id")


def p5_stale(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose features do not fit the text."""
    return quality.stale_features(read_table(spark, sf, "feature_rows")).withColumnRenamed("id", "row_id")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    kinds = p5_statistics(spark, sf).where("kind is not null").select("row_id", "kind")
    return kinds.unionByName(p5_stale(spark, sf).withColumn("kind", F.lit("stale")))


def p6_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated share and longest repeat of every row of feature_rows."""
    return repetition.repetition(read_table(spark, sf, "feature_rows")).select(F.col("id").alias("row_id"), "repeated_share", "longest_repeat", "n_words")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.repetitive(read_table(spark, sf, "feature_rows"), _model(spark, sf)).withColumnRenamed("id", "row_id")


def p7_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, cut rows and their share for each set."""
    return truncation.cut_rates(truncation.truncated(read_table(spark, sf, "feature_rows"), _model(spark, sf)))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.truncated(read_table(spark, sf, "feature_rows"), _model(spark, sf)).where("cut").select(F.col("id").alias("row_id"))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.encode_texts(read_table(spark, sf, "documents"))


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The chosen documents with their repeats."""
    return mixing.mix(read_table(spark, sf, "documents"), read_table(spark, sf, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual share of tokens of each source."""
    return mixing.mix(read_table(spark, sf, "documents"), read_table(spark, sf, "mix_targets"))[1]


def p10_sanitised(spark: SparkSession, sf: str) -> DataFrame:
    """The texts with placeholders in the place of mentions and of the terms that disclose an entity."""
    seen = pii.observed(read_table(spark, sf, "documents"))
    disclosure = pii.learned(seen)
    got = pii.generalised(pii.sanitised(seen, disclosure), disclosure)
    return got.select(F.col("id").alias("doc_id"), "clean_text", F.size("mentions").alias("n_mentions"), "n_terms")


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    seen = pii.observed(read_table(spark, sf, "documents"))
    found = pii.sanitised(seen, pii.learned(seen)).select("id", F.explode("mentions").alias("m"))
    return found.select(F.col("id").alias("doc_id"), F.col("m.pos").alias("pos"), F.col("m.kind").alias("kind"))


def queries() -> dict:
    """The queries by name."""
    own = [
        p1_found, p1_turns, p1_diar_turns, p3_found, p3_pieces, p4_found, p4_languages, p5_found, p5_statistics, p5_stale,
        p6_found, p6_shares, p7_found, p7_rates, p8_ids, p9_mix, p9_shares, p10_found, p10_sanitised,
    ]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """Equivalent SQL where there is one."""
    stale = r"""
      WITH t AS (
        SELECT row_id, text_features f, split_part(config_key, '_', 1) AS lang,
               replace(replace(coalesce(text, ''), '<Speaker1>:', ''), '<Speaker2>:', '') AS body
        FROM feature_rows WHERE text_features IS NOT NULL),
      w AS (
        SELECT row_id, f, len(regexp_extract_all(body, CASE lang
          WHEN 'zh' THEN '[一-鿿]' WHEN 'ta' THEN '[஀-௿]+|[a-zA-Z0-9]+' ELSE '[a-zA-Z0-9]+' END)) AS n FROM t),
      e AS (
        SELECT row_id, f, n, n / f.true_duration * 60 AS wpm,
               least(n / 2.3, f.true_duration) / f.true_duration AS ratio FROM w)
      SELECT row_id FROM e
      WHERE f.word_count <> n OR abs(f.wpm - wpm) > 0.01 * wpm OR abs(f.speech_ratio - ratio) > 0.01 * ratio"""
    diar = r"""
      WITH s AS (
        SELECT file_name, generate_subscripts(speakers, 1) AS i, unnest(speakers) AS x FROM diar_short),
      k AS (
        SELECT file_name, i, coalesce(x.start_time, 'nan'::DOUBLE) AS st,
               coalesce(nullif(regexp_replace(regexp_extract(x.speaker, '(\d+)', 1), '^0+(\d)', '\1'), ''),
                        lower(trim(x.speaker))) AS spk
        FROM s WHERE trim(coalesce(x.speaker, '')) <> ''),
      o AS (
        SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY st, i) AS p,
               lag(spk) OVER (PARTITION BY file_name ORDER BY st, i) AS before FROM k),
      f AS (SELECT file_name, spk, min(p) AS first_at FROM o GROUP BY 1, 2),
      r AS (SELECT file_name, spk, row_number() OVER (PARTITION BY file_name ORDER BY first_at) AS speaker_no FROM f)
      SELECT o.file_name AS rec_key, row_number() OVER (PARTITION BY o.file_name ORDER BY p) AS turn_no, r.speaker_no
      FROM o JOIN r USING (file_name, spk) WHERE before IS NULL OR before <> spk"""
    chunks = r"""
      WITH c AS (
        SELECT tr_id, generate_subscripts(chunk_transcriptions, 1) AS chunk_no, unnest(chunk_transcriptions) AS t
        FROM transcript_rows),
      b AS (SELECT * FROM c WHERE length(t) > 500),
      m AS (
        SELECT tr_id, chunk_no, regexp_split_to_array(
          regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[\r\n]', chr(1), 'g'),
            '(<Speaker[0-9]+>:)', chr(1) || '\1', 'g'), '([.!?…])\s', '\1' || chr(1), 'g'), '([。！？])', '\1' || chr(1), 'g'),
          chr(1)) AS parts FROM b)
      SELECT tr_id, chunk_no::BIGINT AS chunk_no,
             CASE WHEN list_max([length(trim(x, ' ' || chr(9))) FOR x IN parts]) > 500 THEN 'hard' ELSE 'clean' END AS kind FROM m
      UNION ALL
      SELECT tr_id, 0::BIGINT, 'span' FROM transcript_rows
      WHERE NOT isnan(duration_sec)
        AND num_chunks < CASE WHEN duration_sec <= 30 THEN 1 ELSE ceil((duration_sec - 1) / 29) END"""
    return {"p1_diar_turns": diar, "p3_found": chunks, "p5_stale": stale}
