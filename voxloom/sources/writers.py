"""Writers."""

from __future__ import annotations

import html
import json
import os
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.spans import rttm_line


def json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object on each line, in as many files as there are partitions; nulls are written."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def json_array(df: DataFrame, path: str, order: list[str], limit: int = 100_000) -> int:
    """One pretty JSON array in one file, for results a person reads.

    Refuses more than ``limit`` rows, which belong in ``json_lines``.
    """
    rows = df.orderBy(*order).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "pretty": "true"}).alias("j")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; write JSON lines instead")
    with open(path, "w", encoding="utf-8") as f:
        f.write("[\n" + ",\n".join(r.j for r in rows) + "\n]\n")
    return len(rows)


def tiers(df: DataFrame, path: str, by: tuple[str, ...] = ("config_key", "label"), mode: str = "overwrite", files: int = 8) -> None:
    """One folder for each set and tier; a hot tier is spread over several files."""
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c not in by][:1]), F.lit(files))
    df.withColumn("_salt", salt).repartition(*by, "_salt").drop("_salt").write.mode(mode).partitionBy(*by).option("ignoreNullFields", "false").json(path)


def diarization_json(documents: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Diarization documents, one object on each line, by file."""
    documents.write.mode(mode).option("ignoreNullFields", "false").json(path)


def rttm(segments: DataFrame, path: str, file: str = "file_name", start: str = "start_time", end: str = "end_time", speaker: str = "spk_id", standard: bool = True, mode: str = "overwrite") -> None:
    """RTTM lines sorted by file, speaker and start."""
    ok = segments.where(F.col(start).isNotNull() & F.col(end).isNotNull() & F.col(speaker).isNotNull())
    lines = ok.repartition(file).sortWithinPartitions(file, speaker, start)
    lines.select(rttm_line(F.col(file), F.col(start), F.col(end), F.col(speaker), standard).alias("value")).write.mode(mode).text(path)


def wav_files(df: DataFrame, folder: str, name: str = "name", samples: str = "wav", rate: int = 16_000) -> DataFrame:
    """Write each waveform to ``folder``/``name``.wav where its row lies; gives the paths and sizes.

    The folder must be one that all executors share.  A file is written under a
    name of its own and then moved, so a repeated task leaves one whole file.
    """
    from voxloom.sources.readers import encode_wav

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for pdf in batches:
            rows = []
            for n, wav in zip(pdf["n"], pdf["w"]):
                target = os.path.join(folder, f"{n}.wav")
                part = f"{target}.{os.getpid()}.part"
                data = encode_wav(wav, rate)
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, target)
                rows.append((target, len(data)))
            yield pd.DataFrame(rows, columns=["path", "length"])

    return df.where(F.col(samples).isNotNull()).select(F.col(name).alias("n"), F.col(samples).alias("w")).mapInPandas(run, "path string, length long")


def audit_copies(rows: DataFrame, folder: str, index: str = "index", audio_id: str = "audio_id", source: str = "source_audio_path") -> DataFrame:
    """Copy source files to ``idx<index>_<audio_id>.wav``; rows without a source are left out.

    Gives the copies' paths.  Runs where the rows lie, on shared folders.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for pdf in batches:
            done = []
            for i, a, s in zip(pdf["i"], pdf["a"], pdf["s"]):
                if s and os.path.exists(s):
                    target = os.path.join(folder, f"idx{i}_{a}.wav")
                    shutil.copy2(s, target)
                    done.append((i, a, target))
            yield pd.DataFrame(done, columns=["index", "audio_id", "path"])

    src = rows.select(F.col(index).cast("long").alias("i"), F.col(audio_id).alias("a"), F.col(source).alias("s"))
    return src.mapInPandas(run, "index long, audio_id string, path string")


def archive(folder: str, target: str, metadata: dict | None = None) -> str:
    """A zip file of a local folder, with ``metadata.json`` in it where there is some; gives its path."""
    if metadata is not None:
        with open(os.path.join(folder, "metadata.json"), "w", encoding="utf-8") as f:
            json.dump(metadata, f, ensure_ascii=False, indent=2, sort_keys=True)
    return shutil.make_archive(target.removesuffix(".zip"), "zip", folder)


def checkpointed(new: DataFrame, path: str, key: str, order: list[str]) -> DataFrame:
    """Results so far with new ones put over those of the same key, written anew as a whole in order; gives what is there now.

    Each rewrite is a folder of its own, ``v`` and its number; the highest
    finished one counts, so a rewrite that breaks off leaves the one before.
    """
    from voxloom.operators.joins import upsert

    spark = new.sparkSession
    version, old = latest_version(spark, path)
    merged = new if old is None else upsert(old, new, key)
    target = f"{path.rstrip('/')}/v{version + 1:06d}"
    merged.orderBy(*order).write.parquet(target)
    return spark.read.schema(merged.schema).parquet(target)


def latest_version(spark, path: str) -> tuple[int, DataFrame | None]:
    """Number and rows of the last finished rewrite; 0 and none where there is none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/v*/_SUCCESS")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    last = max((f.getPath().getParent().toString() for f in found or []), default=None)
    return (0, None) if last is None else (int(last.rsplit("/v", 1)[1]), spark.read.parquet(last))


def timeline_html(title: str, spans: list[tuple[str, float, float]]) -> str:
    """A page with one bar for each token of a timeline; spans without both times or of no length are left out."""
    ok = [(t, a, b) for t, a, b in spans if a is not None and b is not None and b > a]
    end = max((b for *_, b in ok), default=1.0)
    bars = "\n".join(
        f'<div class="token" style="left:{100 * a / end:.3f}%;width:{100 * (b - a) / end:.3f}%" title="{a:.3f}-{b:.3f}">{html.escape(t)}</div>'
        for t, a, b in ok
    )
    return f'<!doctype html><meta charset="utf-8"><title>{html.escape(title)}</title><div class="timeline">\n{bars}\n</div>\n'


def append_results(new: DataFrame, path: str, key: str) -> None:
    """Append results whose key is not there yet, so that a broken run can go on; nothing is written again."""
    from voxloom.sources.readers import exists

    spark = new.sparkSession
    if exists(spark, path):
        new = new.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
    new.write.mode("append").parquet(path)
