"""Schemas of the data model; sources are always read with one, never by inference."""

from __future__ import annotations

SPAN = "STRUCT<start_time: DOUBLE, end_time: DOUBLE, text: STRING>"
WORD = "STRUCT<word: STRING, start_time: DOUBLE, end_time: DOUBLE>"
FEATURES = "STRUCT<true_duration: DOUBLE, talk_time: DOUBLE, speech_ratio: DOUBLE, wpm: DOUBLE, word_count: BIGINT, word_repetition: DOUBLE, redundancy_score: DOUBLE>"

SAMPLE_ROW = (
    "id STRING, context STRUCT<audio: STRUCT<array: ARRAY<FLOAT>, sampling_rate: INT, path: STRING>, text: STRING>, "
    "other_attributes STRUCT<audio_id: STRING, hf_id: STRING, meta_psudo: STRUCT<transcription: STRING, "
    "speaker_diarization: ARRAY<STRUCT<speaker: STRING>>, emotion_2s: ARRAY<STRING>>>"
)
AUDIO_CHUNK = "orig_index BIGINT, chunk_index INT, offset_sec DOUBLE, sr INT, wav ARRAY<FLOAT>"
TRANSCRIPT_ROW = (
    "idx BIGINT, audio_id STRING, transcription STRING, reference_text STRING, duration_sec DOUBLE, chunked BOOLEAN, "
    "num_chunks INT, chunk_transcriptions ARRAY<STRING>, source_audio_path STRING, error STRING, emotion_subfolder STRING"
)
TIMED_TRANSCRIPT = "index BIGINT, text STRING, language STRING, timestamps ARRAY<STRUCT<start: DOUBLE, end: DOUBLE, text: STRING>>"
FEATURE_ROW = f"index BIGINT, audio_id STRING, text STRING, label STRING, reason STRING, emotion_subfolder STRING, source_audio_path STRING, text_features {FEATURES}"
LLM_ROW = FEATURE_ROW + ", instruct_model_results STRUCT<full_response: STRING, model_used: STRING>"
DIARIZATION_SHORT = "file_name STRING, num_speaker BIGINT, speakers ARRAY<STRUCT<start_time: DOUBLE, end_time: DOUBLE, speaker: STRING>>"
DIARIZATION_LONG = "file_name STRING, sub_folder STRING, id STRING, num_speaker BIGINT, speaker_diarization ARRAY<STRUCT<start_time: DOUBLE, end_time: DOUBLE, spk_id: STRING>>"
RTTM_ROW = "type STRING, file STRING, channel INT, t0 DOUBLE, t1 DOUBLE, ortho STRING, stype STRING, name STRING, conf STRING, slat STRING"
WINDOW_ROW = "file STRING, w_start INT, w_end INT, speakers ARRAY<STRING>"
MANIFEST_ROW = "audio_filepath STRING, duration DOUBLE, speaker_id STRING, text STRING, words ARRAY<STRING>, alignments ARRAY<DOUBLE>"
MANIFEST_WORDS = f"audio_filepath STRING, duration DOUBLE, speaker_id STRING, text STRING, words ARRAY<{WORD}>"
MANIFEST_TRIPLES = "audio_filepath STRING, duration DOUBLE, speaker_id STRING, text STRING, alignments ARRAY<ARRAY<STRING>>"
ASR_RESULT = "language STRING, text STRING, time_stamps ARRAY<STRUCT<text: STRING, start_time: DOUBLE, end_time: DOUBLE>>"
STREAM_CHUNK = "session_id STRING, seq BIGINT, pcm ARRAY<FLOAT>, is_final BOOLEAN"
FINETUNE_ROW = "audio STRING, text STRING, prompt STRING"
