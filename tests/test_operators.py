import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.operators import align, audio, joins, models, reports, segments, simulate


def test_lookup_last_wins_and_keeps_nulls(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, None), (None, 5, "x")], "k int, n int, v string")
    got = {(r.k, r.v): r.r_v for r in joins.lookup_join(left, right, "k", "k", F.col("n"), {"v": "none"}).collect()}
    assert got == {(1, "a"): "new", (2, "b"): None, (3, None): "none", (None, "d"): "none"}


def test_numbering_and_zip(spark):
    a = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("x"))
    got = joins.numbered(a, [F.col("x")]).orderBy("x").collect()
    assert [r.position for r in got] == list(range(1000))
    b = spark.range(30).select(F.col("id").alias("x"))
    z = joins.zip_join(a, b, [F.col("x")], [F.desc("x")]).orderBy("position").collect()
    assert len(z) == 30 and z[0].x == 0 and z[0].r_x == 29


def test_resume_and_upsert(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, r string")
    assert [r.id for r in joins.unfinished(rows, rows, "id", F.col("r").isNotNull()).collect()] == [2]
    new = spark.createDataFrame([(2, "B", 1)], "id int, r string, extra int")
    assert {(r.id, r.r, r.extra) for r in joins.upsert(rows, new, "id").collect()} == {(1, "a", None), (2, "B", 1), (3, "c", None)}


def brute_windows(segs):
    last = max(e for _, e, _ in segs)
    return [(w, sorted({k for s, e, k in segs if s < w + 2 and e > w and e > s}) or ["na"]) for w in range(0, int(last) + 2, 2)]


def test_windows(spark):
    rng = random.Random(2)
    segs = [(s, s + rng.choice([0.4, 2.0, 5.5]), f"s{rng.randint(0, 2)}") for s in [rng.choice([2.0, 3.9, rng.uniform(0, 40)]) for _ in range(25)]]
    df = spark.createDataFrame([("f", *s) for s in segs], "file_name string, start_time double, end_time double, spk_id string")
    got = [(r.w_start, r.speakers) for r in segments.fixed_windows(df).orderBy("w_start").collect()]
    assert got == brute_windows(segs)


def test_overlap_pairs(spark):
    rng = random.Random(4)
    iv = [(i, s, s + rng.choice([1.0, 45.0, 100.0])) for i, s in enumerate(rng.uniform(0, 200) for _ in range(40))]
    df = spark.createDataFrame([("f", *x) for x in iv], "file_name string, i int, start_time double, end_time double")
    got = sorted((r.i, r.r_i) for r in segments.overlap_join(df, df, "file_name").collect())
    assert got == sorted((a, b) for a, s, e in iv for b, s2, e2 in iv if s < e2 and s2 < e)


def test_gap_segments(spark):
    df = spark.createDataFrame([("f", ["a", "b", "c", "d"], [0.0, 1.5, 3.0001, 3.1]), ("g", [], []), ("h", ["x"], [1.0]), ("n", None, None)], "f string, words array<string>, alignments array<double>")
    got = sorted((r.f, r.segment, r.words) for r in segments.gap_segments(df, "f").collect())
    assert got == [("f", 0, ["a", "b"]), ("f", 1, ["c", "d"]), ("h", 0, ["x"])]


def test_hysteresis(spark):
    p = [0.1, 0.9, 0.5, 0.5, 0.1, 0.95, 0.1, 0.1, 0.1, 0.9]
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(p)], "k string, i int, p double")
    got = [(r.start_time, r.end_time) for r in segments.hysteresis_segments(df, ["k"], "i", "p", 1.0, min_off=1.5, min_on=2.0).collect()]
    assert got == [(1.0, 6.0)]


def test_reports(spark):
    df = spark.createDataFrame([("a", True), ("a", False), (None, True)], "g string, h boolean")
    got = {r.g: (r.n_rows, r.n_hits, r.hit_pct) for r in reports.share_report(df, "g", F.col("h")).collect()}
    assert got == {"a": (2, 1, 50.0), "none": (1, 1, 100.0), "TOTAL": (3, 2, 66.67)}
    empty = reports.share_report(df.where("false"), "g", F.col("h")).collect()
    assert empty == []
    lab = spark.createDataFrame([("a", x, i) for i, x in enumerate(["sad", "joy", "joy", "sad", "calm", "neutral", None, "zen", "fear"])], "g string, l string, i int")
    assert [r.l for r in reports.top_labels(lab, "g", "l", F.col("i")).orderBy("rank").collect()] == ["sad", "joy", "calm"]
    ids = reports.id_lists(spark.createDataFrame([("a", 2, True), ("a", 1, True), ("b", 3, False)], "g string, i long, h boolean"), "g", F.col("h"), "i")
    assert {r.g: r.ids for r in ids.collect()} == {"a": "1, 2", "b": "None."}


def brute_rising(data):
    n = len(data)
    best, back = [1] * n, [-1] * n
    for i in range(n):
        for j in range(i):
            if data[j] <= data[i] and best[j] + 1 > best[i]:
                best[i], back[i] = best[j] + 1, j
    i, out = (best.index(max(best)) if n else -1), []
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def test_rising_and_repair():
    rng = random.Random(3)
    for _ in range(500):
        v = [rng.randint(0, 8) for _ in range(rng.randint(0, 14))]
        assert align.longest_rising(v) == brute_rising(v)
        fixed = align.repair_timestamps(v)
        assert fixed == sorted(fixed)
    assert align.repair_timestamps([0, 9, 1, 2]) == [0, 0, 1, 2]


def test_quiet_chunks_tile():
    rng = np.random.default_rng(0)
    x = rng.normal(size=16000 * 5).astype(np.float32)
    x[20000:22000] = 0
    cuts = audio.quiet_cuts(x, 16000, 1.5, 0.5)
    assert cuts == sorted(set(cuts)) and all(0 < c < len(x) for c in cuts) and 20000 <= cuts[0] < 22000
    assert audio.quiet_cuts(x[:16000], 16000, 1.5) == []


def test_chunks(spark):
    df = spark.createDataFrame([(1, [0.1] * 95), (2, []), (3, None)], "id int, w array<float>")
    got = [(r.id, r.chunk_index, len(r.chunk)) for r in audio.overlapping_chunks(df, "w", "id", 10, 3.0, 1.0).orderBy("id", "chunk_index").collect()]
    assert got == [(1, 0, 30), (1, 1, 30), (1, 2, 30), (1, 3, 30), (1, 4, 15), (2, 0, 0)]
    out = spark.createDataFrame([([0.5, -2.0, float("nan")],)], "w array<float>").select(audio.normalise(F.col("w"))).first()[0]
    assert out == [0.25, -1.0, 0.0]


def test_resampled_is_rounded_as_in_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from voxloom.plans import core

    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.choice([-0.0003, 0.0005, -0.0005, 0.0015, -0.0, 0.25, -1.0005, 7.0625], 64)]) for i in range(60)]
    rows += [(100, [None] + [0.5] * 63), (101, [float("nan"), float("inf")] + [-1e-5] * 62), (102, None)]
    rows += [(200 + i, [float(x) for x in rng.normal(scale=0.2, size=64)]) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    # repr tells -0.0 from 0.0, and nothing is rounded.
    want = {r[0]: repr(r[1]) for r in con.execute(core.oracle_sql()["resampled_signals"]).fetchall()}
    got = {r.vec_id: repr(r.wav) for r in core.queries()["resampled_signals"](spark, str(tmp_path)).collect()}
    assert got == want and "-0.0," in got[101]
    same = spark.createDataFrame([([0.5, None, float("inf"), 1.0],), ([],), (None,)], "w array<float>").select(audio.resampled(F.col("w"), 8, 8).alias("a"), audio.resampled(F.col("w"), 8, 16).alias("b")).collect()
    assert same[0].a == [0.5, None, float("inf"), 1.0] and len(same[0].b) == 8 and same[1].b == [] and same[2].b is None


def test_voice(spark):
    tone = (0.5 * np.sin(2 * np.pi * 220 * np.arange(16000) / 16000)).astype(float).tolist()
    rows = spark.createDataFrame([(0, tone), (1, [0.0] * 8000), (2, []), (3, None)], "id int, w array<float>").select("id", audio.voice_features(F.col("w")).alias("f")).orderBy("id").collect()
    assert abs(np.median(audio.yin(np.array(tone))) - 220) < 1
    assert rows[1].f.tremor_label == "Stable voice" and rows[2].f.loud_range == 0.0 and rows[3].f.loud_range is None
    assert list(audio.median_filter(np.array([3.0, 1.0, 2.0]))) == [1.0, 2.0, 1.0]


def test_models_keep_faults_to_their_row(spark):
    def predict(_, xs):
        if "bad" in xs:
            raise ValueError("no")
        return [x.upper() for x in xs]

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, " "), (4, None)], "id int, t string")
    got = {r.id: (r.result, r.result_error is None) for r in models.apply_model(df, models.BatchModel("m", lambda: 0, predict), "t", skip_blank="").collect()}
    assert got == {1: ("A", True), 2: (None, False), 3: ("", True), 4: (None, True)}


def test_recogniser(spark):
    wave = spark.createDataFrame([("x", [0.1] * 40), ("y", [0.2] * 5)], "id string, w array<float>")
    asr = models.BatchModel("asr", lambda: 0, lambda _, xs: [f"language english<asr_text>{len(x)}" for x in xs])
    got = {r.orig_index: (r.language, r.text) for r in models.Recogniser(asr).transcribe(wave, "id", "w").collect()}
    assert got == {"x": ("English", "40"), "y": ("English", "5")}


def test_simulation():
    config = simulate.SessionConfig(seconds=30, speakers=2)
    pool = [("a", [(["x", "y", ""], [0.4, 0.9, 1.2])]), ("b", [(["q"], [0.7])])]
    rows = simulate.build_session(3, pool, config)
    assert rows == simulate.build_session(3, pool, config) and rows
    for who in "ab":
        mine = [(r[3], r[4]) for r in rows if r[2] == who]
        assert all(a[1] <= b[0] + 1e-6 for a, b in zip(mine, mine[1:]))
    decks = simulate.speaker_permutations(["a", "b", "c"], 2, 6, 1)
    assert all(len(set(d)) == 2 for d in decks) and {x: sum(x in d for d in decks) for x in "abc"} == {"a": 4, "b": 4, "c": 4}
    with pytest.raises(ValueError):
        simulate.SessionConfig(speakers=0)


def test_simulation_draws_from_all_samples_of_all_speakers(spark):
    rows = [(f"s{i:04}", ["w"], [0.5]) for i in range(2100)] + [("s2099", [f"x{j:03}"], [0.5]) for j in range(300)]
    df = spark.createDataFrame(rows + [(None, ["n"], [0.5]), ("s0000", [], [])], "speaker_id string, words array<string>, alignments array<double>")
    got = simulate.simulate_sessions(spark, df, simulate.SessionConfig(sessions=700, speakers=3, seconds=30.0)).collect()
    assert {r.session for r in got} == set(range(700))
    assert len({r.speaker for r in got}) > 1900 and any(r.speaker >= "s2000" for r in got)
    one = df.where("speaker_id = 's2099'")
    config = simulate.SessionConfig(sessions=40, speakers=1, seconds=60.0)
    drawn = {tuple(r) for r in simulate.simulate_sessions(spark, one, config).selectExpr("session", "turn", "speaker", "to_json(words)", "end_time").collect()}
    words = {w for r in drawn for w in json.loads(r[3])}
    assert len(words) > 290
    few = simulate.simulate_sessions(spark, one, config, draws=1).selectExpr("session", "turn", "speaker", "to_json(words)", "end_time").collect()
    assert {tuple(r) for r in few} == drawn
    assert simulate.simulate_sessions(spark, one.where("false"), config).count() == 0
