import json
import re
from collections import Counter

from pyspark.sql import functions as F

from voxloom.functions import spans as S
from voxloom.functions import text as T
from voxloom.functions import verdict as V


def values(spark, col, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], schema).select(col).collect()]


def test_tokens_and_tags(spark):
    df = spark.createDataFrame([("<Speaker1>: Hello (err) 2 你好", "en"), ("<Speaker3>: ab", "en"), ("你好 ok", "zh"), ("அம்மா ok!", "ta"), (None, "en"), ("", "ms")], "t string, l string")
    got = [r[0] for r in df.select(T.language_tokens(F.col("t"), F.col("l"))).collect()]
    assert got == [["hello", "err", "2"], ["speaker3", "ab"], ["你", "好"], ["அம்மா", "ok"], [], []]


def brute_stutter(w):
    n = len(w)
    return 0.0 if n < 5 else sum(max(Counter(w[i : i + 5]).values()) >= 3 for i in range(n - 4)) / (n - 4)


def test_repetition_and_redundancy(spark):
    import random

    rng = random.Random(1)
    rows = [[rng.choice("abcd") for _ in range(rng.randint(0, 14))] for _ in range(150)]
    df = spark.createDataFrame([(w,) for w in rows], "w array<string>")
    got = df.select("w", T.word_repetition(F.col("w")), T.redundancy(F.col("w"))).collect()
    for w, rep, red in got:
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        assert abs(rep - brute_stutter(w)) < 1e-4
        assert abs(red - ((len(grams) - len(set(grams))) / len(grams) if grams else 0)) < 1e-4


def brute_collapse(text, limit=20):
    text = re.sub(r"(.)\1{%d,}" % limit, r"\1", text, flags=re.S)
    return re.sub(r"(?=.{%d})(.{1,20}?)\1{%d,}" % (2 * limit, limit - 1), r"\1", text, flags=re.S)


def test_collapse(spark):
    rows = ["a" * 20, "a" * 21, "a" * 40 + "b", "ab" * 19, "ab" * 20, "xy" + "abc" * 30 + "z", "", "line\n" * 25]
    assert values(spark, T.collapse_repetitions(F.col("x")), rows) == [brute_collapse(x) for x in rows]


def test_answers_of_recognisers(spark):
    rows = ["language Chinese<asr_text>你好 ", "language english\n\n<asr_text>Hi", "plain text", "language None<asr_text>", "language None<asr_text>oh", None, "  ", "language <asr_text>x", "<asr_text>y"]
    got = [tuple(r) for r in values(spark, T.parse_asr_output(F.col("x")), rows)]
    assert got == [("Chinese", "你好"), ("English", "Hi"), ("", "plain text"), ("", ""), ("", "oh"), ("", ""), ("", ""), ("", "x"), ("", "y")]
    forced = [tuple(r) for r in values(spark, T.parse_asr_output(F.col("x"), F.lit("Malay")), ["language None<asr_text>a", ""])]
    assert forced == [("Malay", "language None<asr_text>a"), ("", "")]


VERDICTS = [
    '{"Verdict": "KEEP", "Emotion_Label": ["Happy", "Sad"]}', '```json\n{"Verdict": "discard"}\n```', 'I think {"Verdict": "KEEP"} fits.', '{"Verdict": "KEEP"',
    '{"Verdict": "KEEP"} {"Verdict": "DISCARD"}', "{'Verdict': 'KEEP'}", 'no braces but "Verdict": "KEEP"', '{"Emotion_Label": "Calm"}', '{"Verdict": null}', '{"Verdict": ["KEEP"]}', '{"verdict": "KEEP"}', "", None,
]


def strict(raw, repair=False):
    m = re.search(r"\{.*\}", raw, re.S)
    body = (m.group() if m else raw).replace("```json", "").replace("```", "").strip()
    if repair and body.count("{") > body.count("}"):
        body += "}"
    try:
        got = json.loads(body)
        return got if isinstance(got, dict) else None
    except ValueError:
        return None


def test_verdicts(spark):
    report = values(spark, V.report_verdict(F.col("x")), VERDICTS)
    for raw, got in zip(VERDICTS, report):
        parsed = strict(raw or "", True)
        if parsed is not None:
            v = str(parsed.get("Verdict", "")).upper()
            want = "KEEP" if "KEEP" in v else "DISCARD" if "DISCARD" in v else "ERROR"
        else:
            want = "KEEP" if re.search('"VERDICT": ?"KEEP"', (raw or "").upper()) else "ERROR"
        assert got == want, raw
    audit = values(spark, V.audit_verdict(F.col("x")), ["", '{"Verdict": "DISCARD"', "what", '{"Verdict": null}'])
    assert audit == ["UNKNOWN", "DISCARD", "KEEP", "NONE"]
    labels = values(spark, V.answer_labels(F.col("x")), VERDICTS[:2] + VERDICTS[7:8] + ["broken {"])
    assert labels == [["happy", "sad"], [], ["calm"], []]
    assert values(spark, V.answer_is_true(F.col("x")), ["FALSE Transcript: true", "true Transcript: no", None]) == [True, False, False]


def test_paths_and_ids(spark):
    assert values(spark, T.file_stem(F.col("x")), ["a/b/c.wav", "c", ".x", "d.tar.gz"]) == ["c", "c", ".x", "d.tar"]
    assert values(spark, T.name_parts(F.col("x"))["id"], ["a_b_c_d_e", "a_b"]) == ["d_e", ""]
    assert values(spark, T.drop_id_prefix(F.col("x"), F.lit("happy_wav")), ["happy_1_happy_2"]) == ["1_2"]
    assert values(spark, T.language_name(F.col("x")), ["cHINESE", " ", None]) == ["Chinese", None, None]
    assert values(spark, T.merge_languages(F.col("x")), [["A", "", "A", None, "B", "A"], []], "x array<string>") == ["A,B,A", ""]


def test_spans(spark):
    assert values(spark, S.uniform_alignments(F.col("x"), F.lit(2.0)), [["a", "b", "c"]], "x array<string>") == [[0.667, 1.333, 2.0]]
    e = values(spark, S.word_entry(F.col("x"), F.lit(3.0)), ["a b", None])
    assert [list(r.words) for r in e] == [["a", "b", ""], ["speech", ""]] and e[1].alignments == [2.9, 3.0]
    assert [[tuple(y) for y in x] for x in values(spark, S.value_chunks(F.col("x"), 10), [[1, 5, 12, 13, 31], []], "x array<int>")] == [[(0, 2), (2, 4), (4, 5)], []]
    assert values(spark, S.mask_positions(F.col("x")), [[0, 1, 1]], "x array<int>") == [[1, 0, 1]]
    assert values(spark, S.pair_timestamps(F.col("x"), F.array(F.lit(100), F.lit(250))), [["a", "b"]], "x array<string>")[0][0].end_time == 0.25


def test_verdicts_of_deeply_nested_answers(spark):
    deep = '{"a": ' * 12 + "[[[[[[1]]]]]]" + "}" * 12
    rows = [(1, '{"Verdict":  "keep", "x": ' + deep + "}"), (2, '{"Verdict":  "keep", "x": ' + deep + '} {"y": 1}'), (3, '{"Verdict":  "keep", "x": "}{"}'), (4, '{"Verdict":  "keep"}}')]
    df = spark.createDataFrame(rows, "id int, raw string").select("id", V.analysis_verdict(F.col("raw")).alias("v"))
    assert {r.id: r.v for r in df.collect()} == {1: "KEEP", 2: "UNKNOWN", 3: "KEEP", 4: "UNKNOWN"}


def test_a_label_without_a_value_takes_nothing_from_the_next_line(spark):
    raw = "Intensity: High\nEmotion:\nReasoning: none"
    got = spark.createDataFrame([(raw,)], "raw string").select(V.labelled_answer(F.col("raw")).alias("a")).first().a
    assert got.intensity == "High" and got.emotion is None and got.reasoning == "none" and got.sections is None
