import math
import random

from hypothesis import given
from hypothesis import strategies as st

from voxloom.operators import intervals as I


def brute(pairs):
    out = []
    for s, e in sorted(p for p in pairs if p[1] > p[0]):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60))))
def test_map_in_any_order(pairs):
    m = I.IntervalMap()
    for p in pairs:
        m.add(*p)
    assert m.periods() == brute(pairs)
    assert m.gaps(10) == [(a[1], b[0]) for a, b in zip(m.periods(), m.periods()[1:]) if b[0] - a[1] <= 10]


SCHEMA = "seg_id long, file_name string, spk_id string, start_time double, end_time double, kind string, key string, bucket long, start_ms string"


def rows(seed=3):
    """One hot speaker, long segments over many stretches, dirty rows, clashing extra columns, repeats."""
    rng, out = random.Random(seed), []
    for i in range(1500):
        s = rng.choice([rng.uniform(0, 9000), rng.uniform(0, 50)])
        e = s + rng.choice([0.5, 3, 700, 2500, 0, -1, 0.0004])
        out.append((i, rng.choice(["a", "a", "a", "b", None]), rng.choice(["S_0 ", "s_0", " s_1", "", None, "　s_1"]), s, e, "x", "y", 7, "z"))
    out += [(9001, "a", "s_0", None, 1.0, "", "", 0, ""), (9002, "a", "s_0", 1.0, math.nan, "", "", 0, ""), (9003, "a", "s_0", math.nan, 2.0, "", "", 0, "")]
    return out + out[:40]


def expected(data):
    groups = {}
    for _, f, k, s, e, *_ in data:
        if s is None or e is None or math.isnan(s) or math.isnan(e) or e <= s or not (k or "").strip():
            continue
        groups.setdefault((f, k.strip().lower()), []).append((math.floor(s * 1000 + 0.5), math.floor(e * 1000 + 0.5)))
    out = set()
    for (f, k), pairs in groups.items():
        p = brute(pairs)
        out |= {(f, k, "period", *x) for x in p}
        out |= {(f, k, "gap", a[1], b[0]) for a, b in zip(p, p[1:]) if b[0] - a[1] <= I.MAX_GAP_MS}
    return out


def test_periods_and_gaps(spark):
    data = rows()
    got = I.periods_and_gaps(spark.createDataFrame(data, SCHEMA)).collect()
    assert {tuple(r) for r in got} == expected(data) and len(got) == len(expected(data))


def test_empty_and_all_null(spark):
    assert I.periods_and_gaps(spark.createDataFrame([], SCHEMA)).count() == 0
    assert I.periods_and_gaps(spark.createDataFrame([(1, None, None, None, None, None, None, None, None)], SCHEMA)).count() == 0


def test_stream_ends_in_the_same_state(spark, tmp_path):
    from voxloom.streaming.intervals import interval_updates

    data = [r for r in rows(5) if r[1] is not None][:300]
    for k in range(3):
        spark.createDataFrame(data[k::3], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{k}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    q = interval_updates(stream).writeStream.format("memory").queryName("upd").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT file_name, spk_id, kind, start_ms, end_ms FROM (SELECT *, max(version) OVER (PARTITION BY file_name, spk_id) v FROM upd) WHERE version = v")
    assert {tuple(r) for r in got.collect()} == expected(data)
