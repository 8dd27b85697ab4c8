import json
import time

import numpy as np
from pyspark.sql import functions as F

from voxloom import schemas
from voxloom.sources import readers, writers
from voxloom.streaming import rechunk


def test_json_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"index": 1, "text": "x"}, {"index": 2}]))
    (tmp_path / "b.json").write_text(json.dumps({"index": 3, "text": "one"}))
    got = readers.json_array(spark, str(tmp_path / "*.json"), schemas.FEATURE_ROW)
    assert sorted((r["index"], r.text, r.file) for r in got.collect()) == [(1, "x", "a.json"), (2, None, "a.json"), (3, "one", "b.json")]
    (tmp_path / "c.jsonl").write_text('{"audio":"a","text":"t"}\n\n{broken\n{"audio":"b"}\n')
    assert readers.json_lines(spark, str(tmp_path / "c.jsonl"), schemas.FINETUNE_ROW).count() == 2
    assert readers.json_lines(spark, str(tmp_path / "none.jsonl"), schemas.FINETUNE_ROW).columns == ["audio", "text", "prompt"]
    two = readers.json_splits(spark, train=str(tmp_path / "c.jsonl"), validation=str(tmp_path / "none.jsonl"))
    assert {r.split for r in two.collect()} == {"train"}


def test_rttm_both_ways(spark, tmp_path):
    segs = spark.createDataFrame([("f", 0.32, 1.28, "s1"), ("f", 2.0, 3.5, "s0"), ("f", None, 1.0, "s0")], "file_name string, start_time double, end_time double, spk_id string")
    for standard in (True, False):
        path = str(tmp_path / f"r{standard}")
        writers.rttm(segs, path, standard=standard)
        got = sorted((r.file, round(r.start_time, 3), round(r.end_time, 3), r.speaker) for r in readers.rttm(spark, path, end_time=not standard).collect())
        assert got == [("f", 0.32, 1.28, "s1"), ("f", 2.0, 3.5, "s0")]


def test_audio_files(spark, tmp_path):
    wave = np.sin(np.arange(1600) / 10)
    df = spark.createDataFrame([("a", wave.tolist()), ("b", None)], "name string, wav array<float>")
    assert [r.path for r in writers.wav_files(df, str(tmp_path / "w")).collect()] == [str(tmp_path / "w" / "a.wav")]
    (tmp_path / "w" / "bad.wav").write_bytes(b"nonsense")
    got = {r.path.split("/")[-1]: r for r in readers.wav_files(spark, str(tmp_path / "w")).collect()}
    assert np.allclose(got["a.wav"].wav, wave, atol=1e-4) and got["bad.wav"].wav is None and got["bad.wav"].error
    (tmp_path / "x.raw").write_bytes(np.array([0, 16384, -32768], "<i2").tobytes() + b"z")
    assert readers.raw_pcm_files(spark, str(tmp_path)).first().wav == [0.0, 0.5, -1.0]
    listed = readers.file_listing(spark, str(tmp_path), "*.wav").collect()
    assert {(r.stem, r.folder) for r in listed} == {("a", "w"), ("bad", "w")}
    copies = writers.audit_copies(spark.createDataFrame([(1, "k", str(tmp_path / "w/a.wav")), (2, "m", "/no"), (3, "n", None)], "index int, audio_id string, source_audio_path string"), str(tmp_path / "audit"))
    assert [r.path.split("/")[-1] for r in copies.collect()] == ["idx1_k.wav"]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "en_30", "keep"), (2, "en_30", "discard")], "index long, config_key string, label string")
    writers.tiers(df, str(tmp_path / "t"))
    assert spark.read.json(str(tmp_path / "t" / "config_key=en_30" / "label=keep")).count() == 1
    assert writers.json_array(df, str(tmp_path / "a.json"), ["index"]) == 2 and json.loads((tmp_path / "a.json").read_text())[1]["label"] == "discard"
    writers.append_results(df, str(tmp_path / "done"), "index")
    writers.append_results(df.union(df.withColumn("index", F.col("index") + 1)), str(tmp_path / "done"), "index")
    assert sorted(r["index"] for r in spark.read.parquet(str(tmp_path / "done")).collect()) == [1, 2, 3]


ROWS = [("s", i, [float(i)] * n, i == 5) for i, n in enumerate([3, 7, 0, 12, 5, 4])] + [("t", 0, [1.0] * 10, False), ("t", 1, None, True)]


def test_stream_cuts_like_the_batch(spark, tmp_path):
    config = rechunk.StreamConfig(chunk_seconds=1.0, rate=8)
    batch = {tuple(r) for r in rechunk.rechunk_batch(spark.createDataFrame(ROWS, schemas.STREAM_CHUNK), config).collect()}
    assert sum(r[2] for r in batch if r[0] == "s") == 31
    for k in range(0, len(ROWS), 2):
        spark.createDataFrame(ROWS[k : k + 2], schemas.STREAM_CHUNK).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = readers.chunk_stream(spark, str(tmp_path / "in"), 1)
    q = rechunk.rechunk_stream(stream, config).writeStream.format("memory").queryName("rc").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    # Processing-time timeouts keep a stream busy for ever, so it is stopped when it has read everything.
    until = time.time() + 90
    while sum(p["numInputRows"] for p in q.recentProgress) < len(ROWS) and time.time() < until:
        time.sleep(0.5)
    q.stop()
    assert {tuple(r) for r in spark.table("rc").collect()} == batch


def test_roll_back():
    config = rechunk.StreamConfig(unfixed_chunks=2, unfixed_tokens=2)
    assert rechunk.rolled_back([1, 2, 3], 1, config) == []
    assert rechunk.rolled_back([1, 2, 3], 2, config) == [1]
    assert rechunk.rolled_back([1, 2, 3, 4], 2, config, decode=lambda t: "�" if len(t) == 2 else "ok") == [1]
    assert rechunk.rolled_back([1], 2, config, flush=True) == [1]
