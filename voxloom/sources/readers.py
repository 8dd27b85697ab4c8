"""Readers.  Every source has a schema; a source that does not exist is an empty table of it."""

from __future__ import annotations

import io
import struct
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import schemas
from voxloom.operators.audio import RATE, resample_linear, to_mono


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any file of a pattern, is there."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def guarded(spark: SparkSession, path: str, schema: str, read) -> DataFrame:
    """What ``read`` gives, or an empty table where the path does not exist."""
    return read() if exists(spark, path) else spark.createDataFrame([], schema)


def dataset(spark: SparkSession, path: str, schema: str = schemas.SAMPLE_ROW, columns: list[str] | None = None) -> DataFrame:
    """A columnar dataset on disk; only the columns asked for are read."""
    df = guarded(spark, path, schema, lambda: spark.read.parquet(path))
    return df.select(*columns) if columns else df


def flat_samples(samples: DataFrame) -> DataFrame:
    """Nested samples with their columns named by path; audio stays an array until it is used."""
    return samples.select(
        "id", F.col("context.audio.array").alias("wav"), F.col("context.audio.sampling_rate").alias("sr"), F.col("context.audio.path").alias("path"),
        F.col("context.text").alias("text"), F.col("other_attributes.audio_id").alias("audio_id"), F.col("other_attributes.hf_id").alias("hf_id"),
        F.col("other_attributes.meta_psudo").alias("meta"),
    )


def cast_audio(flat: DataFrame, rate: int = RATE) -> DataFrame:
    """Flat samples at one rate: each waveform mono and resampled from its own ``sr``; a row without audio keeps nulls."""

    @F.pandas_udf("array<float>")
    def cast(waves: pd.Series, rates: pd.Series) -> pd.Series:
        return pd.Series([None if w is None or pd.isna(r) else resample_linear(np.asarray(w, dtype=np.float32), int(r), rate).tolist() for w, r in zip(waves, rates)])

    return flat.withColumn("wav", cast("wav", "sr")).withColumn("sr", F.when(F.col("wav").isNotNull(), F.lit(rate)))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold a JSON array of objects or a single object, with the name of each row's file."""
    read = lambda: spark.read.schema(schema).json(path, multiLine=True).select("*", F.col("_metadata.file_name").alias("file"))
    return guarded(spark, path, schema + ", file STRING", read)


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """One JSON object on each line; blank lines are skipped, broken ones too unless ``strict`` (``broken_lines`` has them)."""
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    return guarded(spark, path, schema, lambda: spark.read.schema(schema).option("mode", mode).json(path))


def broken_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``file, line``: the lines that are neither blank nor an object of the schema, so that none is lost unseen."""
    bad = lambda: (
        spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))
        .where(F.trim("line") != "")
        .withColumn("_row", F.from_json("line", f"{schema}, _bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
        .where(F.col("_row._bad").isNotNull() | F.col("_row").isNull()).drop("_row")
    )
    return guarded(spark, path, "file STRING, line STRING", bad)


def json_splits(spark: SparkSession, schema: str = schemas.FINETUNE_ROW, **paths: str) -> DataFrame:
    """Several JSON-lines files in one table, named by ``split``."""
    frames = [json_lines(spark, p, schema).withColumn("split", F.lit(name)) for name, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def rttm(spark: SparkSession, path: str, end_time: bool = False) -> DataFrame:
    """RTTM lines as ``file, start_time, end_time, speaker``; ``end_time`` says that the second number is one."""
    schema = "file STRING, start_time DOUBLE, end_time DOUBLE, speaker STRING"

    def read() -> DataFrame:
        part = F.split(F.trim("value"), r"\s+")
        at = lambda i: F.get(part, F.lit(i))
        second = at(4).try_cast("double")
        return spark.read.text(path).where(at(0) == "SPEAKER").select(
            at(1).alias("file"), at(3).try_cast("double").alias("start_time"),
            (second if end_time else at(3).try_cast("double") + second).alias("end_time"), at(7).alias("speaker"),
        )

    return guarded(spark, path, schema, read)


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    """The first word of each line that is not blank."""
    return guarded(spark, path, "word STRING", lambda: spark.read.text(path).select(F.get(F.split(F.trim("value"), r"\s+"), F.lit(0)).alias("word")).where("word <> ''"))


def config_file(path: str) -> dict:
    """A YAML file of settings."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def file_listing(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """Paths and sizes of files, contents not read, with what their names tell."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    schema = "path STRING, length BIGINT, name STRING, stem STRING, folder STRING"
    from voxloom.functions.text import file_stem, parent_folder

    def read() -> DataFrame:
        return reader.load(path).select(
            "path", "length", F.substring_index("path", "/", -1).alias("name"), file_stem(F.col("path")).alias("stem"), parent_folder(F.col("path")).alias("folder")
        )

    return guarded(spark, path, schema, read)


def sorted_listing(listing: DataFrame) -> DataFrame:
    """A listing in order of its paths, numbered from 0 in ``position``."""
    from voxloom.operators.joins import numbered

    return numbered(listing, [F.col("path")]).orderBy("path")


def decode_wav(data: bytes, rate: int = RATE) -> np.ndarray:
    """Samples of a PCM WAV file: mono floats at the wanted rate."""
    with wave.open(io.BytesIO(data)) as f:
        width, channels, source = f.getsampwidth(), f.getnchannels(), f.getframerate()
        raw = f.readframes(f.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 2:
        x = np.frombuffer(raw, "<i2").astype(np.float32) / 32768
    elif width == 4:
        x = np.frombuffer(raw, "<i4").astype(np.float32) / 2147483648
    else:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        value = b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16
        x = np.where(value >= 1 << 23, value - (1 << 24), value).astype(np.float32) / (1 << 23)
    if channels > 1:
        x = x.reshape(-1, channels).mean(axis=1)
    return resample_linear(x, source, rate)


def encode_wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    """A 16-bit mono WAV file of float samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.clip(np.nan_to_num(np.asarray(samples, dtype=np.float64)), -1, 1) * 32767).round().astype("<i2").tobytes())
    return out.getvalue()


def _decoded(files: DataFrame, decode, rate: int) -> DataFrame:
    """Files with their samples; one that cannot be read has an error instead."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    row = (path, decode(bytes(content)), rate, None)
                except (wave.Error, EOFError, ValueError, struct.error) as e:
                    row = (path, None, rate, f"{type(e).__name__}: {e}")
                yield pd.DataFrame([row], columns=["path", "wav", "sr", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, wav array<float>, sr int, error string")


def wav_files(spark: SparkSession, path: str, rate: int = RATE, pattern: str = "*.wav") -> DataFrame:
    """WAV files as mono waveforms at the wanted rate, read where they lie."""
    read = lambda: _decoded(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path), lambda b: decode_wav(b, rate), rate)
    return guarded(spark, path, "path STRING, wav ARRAY<FLOAT>, sr INT, error STRING", read)


def raw_pcm_files(spark: SparkSession, path: str, rate: int = RATE, pattern: str = "*.raw") -> DataFrame:
    """Headerless 16-bit little-endian files as waveforms; an odd last byte is left out."""
    decode = lambda b: np.frombuffer(b[: len(b) // 2 * 2], "<i2").astype(np.float32) / 32768
    read = lambda: _decoded(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path), decode, rate)
    return guarded(spark, path, "path STRING, wav ARRAY<FLOAT>, sr INT, error STRING", read)


def base64_audio(value: Column) -> Column:
    """Bytes of an audio reference in base64, with or without a data prefix; null where it is none."""
    return F.try_to_binary(F.regexp_replace(value, r"^data:audio[^,]*,", ""), F.lit("base64"))


def referenced_audio(rows: DataFrame, value: str, fetch: Callable[[str], bytes], rate: int = RATE) -> DataFrame:
    """The rows with ``kind``, ``wav`` and ``error`` of audio named by a URL, base64 or a path.

    ``fetch`` gives the bytes of a URL or path; it runs in the workers, and what
    it raises is the row's error.  A null reference gives nulls.
    """
    from voxloom.functions.text import input_kind

    named = rows.withColumn("kind", F.when(F.col(value).isNotNull(), input_kind(F.col(value)))).withColumn("_held", F.when(F.col("kind") == "base64", base64_audio(F.col(value))))
    names = [f.name for f in named.schema.fields if f.name != "_held"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for ref, kind, held in zip(pdf[value], pdf["kind"], pdf["_held"]):
                wav = error = None
                if ref is not None:
                    try:
                        wav = decode_wav(bytes(held) if kind == "base64" else fetch(ref), rate)
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"
                out.append((wav, error))
            yield pdf[names].assign(wav=[w for w, _ in out], error=[e for _, e in out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields if f.name != "_held")
    return named.mapInPandas(run, f"{schema}, wav array<float>, error string")


def in_memory(spark: SparkSession, arrays: list[tuple[np.ndarray, int]]) -> DataFrame:
    """Waveforms held by the caller, mono, with their rates."""
    rows = [(i, to_mono(x).astype(float).tolist(), int(sr)) for i, (x, sr) in enumerate(arrays)]
    return spark.createDataFrame(rows, "id BIGINT, wav ARRAY<FLOAT>, sr INT")


def synthetic(spark: SparkSession, n: int, samples: int, kind: str = "noise", seed: int = 0) -> DataFrame:
    """Waveforms of noise or silence, made where they are used."""
    if kind not in ("noise", "silence"):
        raise ValueError(f"no such waveform: {kind}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            waves = [np.random.default_rng([seed, int(i)]).random(samples, dtype=np.float32) if kind == "noise" else np.zeros(samples, np.float32) for i in pdf["id"]]
            yield pd.DataFrame({"id": pdf["id"], "wav": waves})

    return spark.range(n).mapInPandas(run, "id long, wav array<float>")


def chunk_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """A stream of audio chunks from files that arrive in a folder."""
    return spark.readStream.schema(schemas.STREAM_CHUNK).option("maxFilesPerTrigger", max_files).json(path)


def valid_chunk(body: Column) -> Column:
    """Whether a posted body of float samples has whole ones."""
    return F.octet_length(body) % 4 == 0
