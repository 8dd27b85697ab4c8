import random

from hypothesis import given, settings
from hypothesis import strategies as st

from voxloom.llm import pieces, speech, turns

CLEAN = ["The driver washed the old map.", "Saya makan nasi di pasar.", "老师打开了窗户。", "Nobody told me anything!", "¿Quién dijo que no?"]
WEIGHTS = turns.fit(CLEAN)


def found(text):
    return [(t["turn_no"], t["speaker_no"], t["words"]) for t in turns.clean_turns(text, WEIGHTS)]


def test_styles_timestamps_and_fillers():
    text = "[9.5s] <Speaker1>: hmm, Late one. [1.0s] SPEAKER_02: (ah) First, one. 说话人1：(laughs) **Speaker 2:** um... [12.0s] spk_1> Last one"
    assert found(text) == [(1, 1, "First, one."), (2, 2, "Late one. Last one")]
    assert found("S1: hello there. S1: again. S2: bye") == [(1, 1, "hello there. again."), (2, 2, "bye")]
    assert found("no label here") == found("") == found(None) == found("  ") == []
    assert found("<Speaker1>: (ah) um... [speaker2] 嗯，") == []


def test_turn_without_timestamp_follows_its_neighbour():
    text = "(00:00:05.0) <Speaker1>: b\n<Speaker2>: c\n(00:00:01.5) <Speaker3>: a"
    assert [w for *_, w in found(text)] == ["a", "b", "c"]


def test_annotation_inside_a_chinese_word():
    assert found("<Speaker1>: 我们, (err), 再试一次吧。") == [(1, 1, "我们再试一次吧。")]
    assert found("<Speaker1>: <nois, (err), e> S2: （笑(oh)声） S1: 好") == [(1, 1, "好")]


def test_segmentation_of_held_out_transcripts():
    data = turns.synthetic_transcripts(["Otra frase distinta.", "Kami pergi ke sungai.", "My cousin saw a boat."], n=150, seed=99)
    right = sum({turns.candidates(t)[k].head for k in turns.decode(t, turns.candidates(t), WEIGHTS)} == truth for t, truth in data)
    assert right / len(data) > 0.85


def test_diarized_arrays(spark):
    rows = [
        ("a", [(5.0, 6.0, "Speaker 1"), (1.0, 2.0, "spk0"), (1.0, 2.0, "spk0"), (3.0, 4.0, " SPEAKER_00 "), (4.0, 5.0, " "), (7.0, 8.0, None), (8.0, 9.0, "speaker1")]),
        ("b", []), ("c", None), (None, [(1.0, 2.0, "Host"), (2.0, 3.0, "host ")]),
    ]
    df = spark.createDataFrame(rows, "file_name string, speakers array<struct<start_time:double,end_time:double,speaker:string>>")
    assert sorted((r.rec_key or "", r.turn_no, r.speaker_no) for r in turns.diarized_turns(df).collect()) == [("", 1, 1), ("a", 1, 1), ("a", 2, 2)]


def test_spark_turns_over_dirty_rows(spark):
    df = spark.createDataFrame([(1, "<Speaker1>: hi", "x"), (2, None, "x"), (3, "", "x"), (4, "S1: a. " * 3000, "x"), (1, "<Speaker1>: hi", "x")], "row_id long, text string, rec_key string")
    samples = spark.createDataFrame([(t,) for t in CLEAN], "text string")
    got = sorted((r.rec_key, r.turn_no) for r in turns.speaker_turns(df, samples).collect())
    assert got == [("1", 1), ("1", 1), ("4", 1)]
    assert turns.speaker_turns(df.where("false"), samples).count() == 0


def check(text, limit, overlap):
    got = pieces.split_text(text, limit, overlap)
    if not text:
        assert got == []
        return
    assert got[0][0] == 0 and got[-1][1] == len(text)
    cuts = set(pieces.boundaries(text))
    for (a, b, how), (c, d, _) in zip(got, got[1:]):
        assert b - a <= limit and c <= b < d and b - c <= overlap
        assert b - c == overlap or c in cuts
        assert how == "hard" or b in cuts
    assert got[-1][1] - got[-1][0] <= limit


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab .。!\n", max_size=120), st.integers(2, 30), st.integers(0, 10))
def test_pieces(text, limit, overlap):
    check(text, limit, min(overlap, limit - 1))


def test_kinds_and_long_texts():
    assert pieces.kind_of("x" * 501) == "hard" and pieces.kind_of("x" * 500) is None and pieces.kind_of(None) is None
    assert pieces.kind_of("word. " * 100) == "clean" and pieces.kind_of("a" * 300 + "<Speaker2>:" + "b" * 300) == "clean"
    assert pieces.kind_of(" " * 300 + "a" * 400) == "clean"
    rng = random.Random(1)
    check("".join(rng.choice("abc . 。\n") for _ in range(50_000)), 500, 50)
    words = pieces.split_text("one two three four five six", 3, 1, unit="words")
    assert [("one two three four five six"[a:b]).split() for a, b, _ in words] == [["one", "two", "three"], ["three", "four", "five"], ["five", "six"]]


def test_items_in_spark(spark):
    df = spark.createDataFrame(
        [(1, ["ok", None, "x" * 1200, ""], 1, 100.0, "a"), (2, None, 1, 30.0, "b"), (3, [], None, 500.0, "c"), (4, ["a"], 2, float("nan"), "d"), (5, ["a"], 1, 30.5, "e")],
        "tr_id long, chunk_transcriptions array<string>, num_chunks int, duration_sec double, text string",
    )
    got = pieces.split_items(pieces.oversized_chunks(df)).collect()
    assert {(r.id, r.chunk_no, r.kind) for r in got} == {(1, 3, "hard")} and len(got) == 3
    assert sorted((r.id, r.kind) for r in pieces.short_recordings(df).collect()) == [(1, "span"), (5, "span")]


def test_timestamps_of_every_notation():
    for mark, want in [("(00:01:02.5)", 62.5), ("[9.51s]", 9.51), ("<0:02.3>", 2.3), ("[01:09]", 69.0), ("00:00:01,787", 1.787)]:
        assert abs(speech.timestamp_seconds(mark) - want) < 1e-9
        assert speech.TIMESTAMP.fullmatch(mark)


def best_over_all_edges(text, cands, weights):
    n = len(cands)
    best, back = [0.0] + [float("-inf")] * n, [0] * (n + 1)
    for i in range(n):
        for j in range(i + 1, n + 1):
            score = best[i] + float(turns._span_features(text, cands, i, j) @ weights)
            if score > best[j]:
                best[j], back[j] = score, i
    path, j = [], n
    while j > 0:
        path.append(back[j])
        j = back[j]
    return path[::-1], best[n]


def path_score(text, cands, path, weights):
    return sum(float(turns._span_features(text, cands, i, j) @ weights) for i, j in zip(path, [*path[1:], len(cands)]))


def test_a_turn_passes_over_any_number_of_mentions():
    said = " and then ".join(f"they asked speaker {k}: why" for k in range(2, 9))
    assert [n for _, n, _ in found(f"<Speaker1>: The note says {said}.\n<Speaker2>: Yes.")] == [1, 2]
    rng = random.Random(5)
    for text, _ in turns.synthetic_transcripts(["One two three.", "Four.", ""], n=120, seed=3):
        cands = turns.candidates(text)
        for weights in (WEIGHTS, *([rng.gauss(0, 2) for _ in WEIGHTS] for _ in range(4))):
            weights = WEIGHTS * 0 + weights
            path, score = best_over_all_edges(text, cands, weights)
            assert abs(path_score(text, cands, turns.decode(text, cands, weights), weights) - score) < 1e-6


def test_mentions_stay_in_the_words():
    got = found("<Speaker1>: They asked Speaker 2: why he left.\n<Speaker2>: Yes.")
    assert [n for _, n, _ in got] == [1, 2] and got[0][2] == "They asked Speaker 2: why he left."


def test_labels_of_other_words_are_candidates_that_the_model_turns_down():
    text = "<Speaker1>: Part 2: the map. Room 14: the boat.\n[3] the river.\n<Speaker2>: Chapter 9: nobody."
    assert len(turns.candidates(text)) == 6
    assert [(n, w) for _, n, w in found(text)] == [(1, "Part 2: the map. Room 14: the boat. [3] the river."), (2, "Chapter 9: nobody.")]
    assert found("Part 2: the map. Room 14: the boat.") == found("1) the map 2) the boat") == []


def test_digits_of_any_script_and_length(spark):
    wide, long = "<Speaker１>： hello there. <Speaker٢>: again.", "<Speaker" + "7" * 5000 + ">: hello."
    assert [n for _, n, _ in found(wide)] == [1, 2] and found(long) == [(1, 1, "hello.")]
    df = spark.createDataFrame([(1, wide), (2, long)], "row_id long, text string")
    samples = spark.createDataFrame([(t,) for t in CLEAN], "text string")
    assert sorted((r.rec_key, r.speaker_no) for r in turns.speaker_turns(df, samples).collect()) == [("1", 1), ("1", 2), ("2", 1)]
