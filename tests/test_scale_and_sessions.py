"""Hot keys, staged results, streams with bounded state, sound of sessions."""

import io
import json
import os
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom import session
from voxloom.functions import spans as S
from voxloom.functions import text as T
from voxloom.functions import verdict as V
from voxloom.operators import audio, intervals, joins, segments, simulate
from voxloom.sources import readers, writers


def test_reach_of_a_hot_file(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 10 else "b", s, s + rng.choice([1.0, 30.0, 4000.0])) for i, s in enumerate(rng.uniform(0, 9000) for _ in range(800))]
    rows += [("n", None, None)]
    want, far = [], {}
    for f, s, e in sorted((r for r in rows if r[1] is not None)):
        far[f] = max(far.get(f, e), e)
        want.append((f, s, e, far[f]))
    df = spark.createDataFrame(rows, "file_name string, start_time double, end_time double")
    got = segments.running_reach(df, "file_name", bucket=100.0).where("start_time is not null").collect()
    assert sorted(tuple(r) for r in got) == want


def test_quantiles_and_numbers_of_a_hot_group(spark):
    rng = random.Random(8)
    rows = [("hot" if i % 10 else "b", rng.choice([1.0, 2.0, rng.uniform(0, 9), None])) for i in range(900)]
    got = {(r.g, r.share): r.quantile for r in joins.at_ranks(spark.createDataFrame(rows, "g string, v double"), "g", "v", [0.05, 0.5, 1.0]).collect()}
    for g in ("hot", "b"):
        v = [x for k, x in rows if k == g and x is not None]
        assert all(abs(got[g, q] - np.quantile(v, q)) < 1e-9 for q in (0.05, 0.5, 1.0))
    placed = joins.numbered(spark.createDataFrame(rows, "g string, v double"), [F.col("v")], by=["g"], parts=5).collect()
    assert all(sorted(r.position for r in placed if r.g == g) == list(range(sum(r.g == g for r in placed))) for g in ("hot", "b"))


def test_staged_results_go_with_their_block(spark):
    with session.staging(spark):
        held = session.stage(spark.range(10), "probe")
        folder = session.mounted(held.inputFiles()[0]).rsplit("/", 1)[0]
        assert held.count() == 10 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_a_large_input_is_not_spread(spark):
    df = spark.range(100)
    assert session.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * session.PYTHON_WAVES
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1b")
    try:
        assert session.spread(df) is df
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_stream_of_changes_keeps_a_bounded_state(spark, tmp_path):
    from voxloom.streaming.intervals import interval_changes

    schema = "file_name string, spk_id string, start_time double, end_time double, arrived_at timestamp"
    batches = [
        [("f", "a", 0.0, 10.0), ("f", "a", 20.0, 30.0)], [("f", "a", 9.0, 21.0)], [("f", "a", 5000.0, 5001.0), ("f", "a", 9000.0, 9001.0)], [("f", "a", 1.0, 2.0), ("f", "a", 9001.0, 9002.0)],
    ]
    for k, rows in enumerate(batches):
        spark.createDataFrame([(*r, None) for r in rows], schema).withColumn("arrived_at", F.lit(f"2026-01-01 00:0{k}:00").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    q = interval_changes(stream, "arrived_at", "10 minutes", horizon_ms=1_000_000).writeStream.format("memory").queryName("chg").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    rows = [tuple(r)[2:] for r in spark.table("chg").collect()]
    state = {}
    for change, kind, a, b in rows:
        state[kind, a, b] = state.get((kind, a, b), 0) + (1 if change == "add" else -1)
    live = {k for k, n in state.items() if n}
    assert ("late", 1000, 2000) in live and ("period", 0, 30000) in live and ("period", 9000000, 9002000) in live
    assert ("gap", 10000, 20000) not in live and all(n in (0, 1) for n in state.values())


def brute_cuts(x, full, near, width):
    cuts, start = [], 0
    while len(x) - start > full:
        target = start + full
        first, stop = max(start, target - near), min(len(x), target + near)
        sums = [(sum(abs(v) for v in x[k : k + width]), k) for k in range(first, stop - width + 1)]
        cut = target
        if len(sums) > 1:
            k = min(sums)[1]
            cut = min((abs(v), i) for i, v in enumerate(x[k : k + width], k))[1]
        start = max(cut, start + 1)
        cuts.append(start)
    return cuts


def test_quiet_cuts_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        x = rng.integers(-9, 9, int(rng.integers(0, 200))).astype(float)
        assert audio.quiet_cuts(x, rate=8, max_seconds=3.0, search=1.0) == brute_cuts(x.tolist(), 24, 8, 4)
    assert audio.quiet_cuts(np.zeros(0), 8, 3.0) == [] and audio.quiet_cuts(np.zeros(24), 8, 3.0) == []


def brute_repetition(words, window=5, times=3):
    n = len(words) - window + 1
    return 0.0 if n < 1 else sum(any(f.count(w) >= times for w in f) for f in (words[i : i + window] for i in range(n))) / n


def test_repetition_kernels_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice("abc") for _ in range(rng.randint(0, 25))]) for i in range(300)] + [(900, None), (901, ["a"] * 50_000), (902, [])]
    df = spark.createDataFrame(rows, "i int, w array<string>")
    got = {r.i: r for r in df.select("i", T.word_repetition(F.col("w")).alias("s"), T.redundancy(F.col("w")).alias("r")).collect()}
    for i, w in rows:
        w = w or []
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        assert abs((got[i].s or 0.0) - brute_repetition(w)) < 1e-4
        assert abs((got[i].r or 0.0) - ((len(grams) - len(set(grams))) / len(grams) if grams else 0.0)) < 1e-4


def test_mask_positions_of_long_and_null_masks(spark):
    df = spark.createDataFrame([(1, [1, 0, 1, 1]), (2, None), (3, []), (4, [1] * 100_000), (5, [0, None, 1])], "i int, m array<int>")
    got = {r.i: r.p for r in df.select("i", S.mask_positions(F.col("m")).alias("p")).collect()}
    assert got[1] == [0, 1, 1, 2] and got[2] is None and got[3] == [] and got[4][-1] == 99_999 and got[5] == [1, 1, 0]


def test_json_arguments(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("[1]",), ('{"a": ',), ('{"a": 1} {"b": 2}',), (None,), ("",), (" {} ",)], "v string")
    assert [r.m for r in df.select(V.json_argument(F.col("v")).alias("m")).collect()] == [{"a": "1", "b": "x"}, None, None, None, None, None, {}]


def test_a_plan_reads_each_answer_once(spark):
    df = spark.createDataFrame([("x",)], "raw string").select(V.report_verdict(F.col("raw")).alias("v"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("jsontostructs") <= 2 and plan.count("regexp_replace") < 12


def test_broken_lines_are_kept(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"audio":"a"}\n\n{broken\n{"audio":"b"}\n')
    got = readers.broken_lines(spark, str(tmp_path / "c.jsonl"), "audio STRING")
    assert [(r.file, r.line) for r in got.collect()] == [("c.jsonl", "{broken")] and readers.broken_lines(spark, str(tmp_path / "no"), "audio STRING").count() == 0


def test_references_and_rates(spark):
    def fetch(ref):
        if "gone" in ref:
            raise FileNotFoundError(ref)
        return readers.encode_wav(np.full(100, 0.5))

    rows = spark.createDataFrame([("https://h/a",), ("https://h/gone",), (None,), ("data:audio/wav;base64,AAAA",)], "ref string")
    got = {r.ref: r for r in readers.referenced_audio(rows, "ref", fetch).collect()}
    assert len(got["https://h/a"].wav) == 100 and got["https://h/gone"].error.startswith("FileNotFoundError")
    assert got[None].wav is None and got[None].error is None and got["data:audio/wav;base64,AAAA"].error
    flat = spark.createDataFrame([("a", [0.0, 1.0] * 400, 8000), ("b", None, None)], "id string, wav array<float>, sr int")
    cast = {r.id: r for r in readers.cast_audio(flat).collect()}
    assert len(cast["a"].wav) == 1600 and cast["a"].sr == 16000 and cast["b"].wav is None and cast["b"].sr is None


def test_results_are_rewritten_whole(spark, tmp_path):
    at = str(tmp_path / "r")
    writers.checkpointed(spark.createDataFrame([(3, "c"), (1, "a")], "id int, v string"), at, "id", ["id"])
    got = writers.checkpointed(spark.createDataFrame([(2, "b"), (3, "C")], "id int, v string"), at, "id", ["id"])
    assert [(r.id, r.v) for r in got.orderBy("id").collect()] == [(1, "a"), (2, "b"), (3, "C")]
    os.makedirs(f"{at}/v000009")  # a rewrite that broke off does not count
    assert writers.latest_version(spark, at)[0] == 2


def test_archive_and_timeline(tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text("x")
    made = writers.archive(str(tmp_path / "d"), str(tmp_path / "out.zip"), {"n": 1})
    names = zipfile.ZipFile(io.BytesIO(open(made, "rb").read()))
    assert set(names.namelist()) >= {"a.txt", "metadata.json"} and json.loads(names.read("metadata.json")) == {"n": 1}
    page = writers.timeline_html("t<", [("a&b", 0.0, 1.0), ("c", None, 2.0), ("d", 2.0, 2.0)])
    assert page.count('class="token"') == 1 and "a&amp;b" in page and "t&lt;" in page


def test_rows_and_contexts(spark):
    df = joins.numbered(spark.createDataFrame([(5,), (7,)], "x int"), [F.col("x")])
    assert [r.c for r in joins.constant_or_per_row(df, "c", ["a", "b"], "position").orderBy("x").collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        joins.constant_or_per_row(df, "c", ["a"], "position")


def test_sound_and_annotations_of_sessions(spark, tmp_path):
    config = simulate.SessionConfig(sessions=2, speakers=1, seconds=2.0)
    rows = [(0, 0, "a", 0.0, 1.0, 1.0, ["x", "y"], [0.5, 1.0]), (0, 1, "b", 0.5, 1.5, 0.5, ["z"], [1.5]), (1, 0, "c", 0.0, 1.0, 1.0, ["w"], [1.0])]
    made = spark.createDataFrame(rows, simulate.SESSION_SCHEMA)
    clips = spark.createDataFrame([("a", [1.0] * 30), ("b", [1.0] * 7), ("c", None)], "speaker string, wav array<float>")
    got = {r.session: np.array(r.wav) for r in simulate.session_waveforms(made, clips, config, rate=100, fade=0.05).collect()}
    assert len(got[0]) == 200 and got[0][30] == 1.0 and got[0][70] == 1.5 and got[0][120] == 0.5 and got[0][180] == 0 and 0 < got[0][0] < 0.2
    assert not got[1].any()
    noise = spark.createDataFrame([(0, [1.0, -1.0])], "noise_no long, wav array<float>")
    noisy = {r.session: np.array(r.wav) for r in simulate.with_noise(simulate.session_waveforms(made, clips, config, rate=100), noise, 20.0).collect()}
    assert noisy[0][190] != 0 and not noisy[1].any()
    paths = simulate.annotations(made, config, str(tmp_path / "s"))
    assert len(paths) == 8 and spark.read.text(paths[0]).count() == 3 and spark.read.text(str(tmp_path / "s" / "ctm")).count() == 4
    assert "seconds: 2.0" in [r.value for r in spark.read.text(str(tmp_path / "s" / "params.yaml")).collect()]
    first = json.loads(spark.read.text(str(tmp_path / "s" / "json")).first().value)
    assert first == {"audio_filepath": "session_0.wav", "offset": 0.0, "duration": 1.0, "label": "a", "text": "x y"}
    h = simulate.room_response((5.0, 4.0, 3.0), (1.0, 1.0, 1.0), (3.0, 2.0, 1.5))
    assert h.argmax() == np.flatnonzero(h)[0] and abs(h.argmax() / 16000 * 343 - np.linalg.norm([2, 1, 0.5])) < 0.05


def test_periods_over_many_stretches_and_a_hot_speaker(spark):
    rng = random.Random(6)
    rows = [("f", "hot" if i % 10 else "b", s, s + rng.choice([0.2, 5.0, 900.0])) for i, s in enumerate(rng.uniform(0, 20_000) for _ in range(700))]
    df = spark.createDataFrame(rows, "file_name string, spk_id string, start_time double, end_time double")
    for bucket in (1_000, 60_000, 10**9):
        got = {tuple(r) for r in intervals.periods_and_gaps(df, bucket_ms=bucket).collect()}
        want = set()
        for k in ("hot", "b"):
            m = intervals.IntervalMap()
            for _, spk, s, e in rows:
                if spk == k:
                    m.add(round(s * 1000), round(e * 1000))
            want |= {("f", k, "period", *p) for p in m.periods()} | {("f", k, "gap", *g) for g in m.gaps()}
        assert got == want
