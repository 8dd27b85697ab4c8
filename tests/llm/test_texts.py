import os
import random

import numpy as np
import pytest

from voxloom.llm import kinds, lang, lm, pii, quality, queries, repetition, truncation

needs_pieces = pytest.mark.skipif(not os.path.exists(os.path.join(lm.TOKENIZER_DIR, "piece_bpe_32k.model")), reason="no public vocabulary here")

WORDS = {
    "en": (["the driver", "my cousin", "a nurse", "our teacher"], ["washed", "opened", "forgot"], ["the old map.", "a small boat.", "the kitchen window."]),
    "ms": (["pemandu itu", "kakak saya", "jururawat", "cikgu kami"], ["mencuci", "membuka", "melupakan"], ["peta lama.", "perahu kecil.", "tingkap dapur."]),
    "es": (["el conductor", "mi prima", "una enfermera", "la maestra"], ["lavó", "abrió", "olvidó"], ["el mapa viejo.", "una barca pequeña.", "la ventana."]),
    "zh": (["司机", "我表哥", "护士", "老师"], ["打开了", "忘记了", "修好了"], ["旧地图。", "小船。", "厨房的窗户。"]),
    "ta": (["ஓட்டுநர் ", "என் நண்பர் ", "செவிலியர் ", "ஆசிரியர் "], ["பழைய வீட்டை ", "படகை ", "கதவை "], ["திறந்தார்.", "மறந்தார்.", "கழுவினார்."]),
}


def sentence(code, rng):
    return ("" if code in ("zh", "ta") else " ").join(rng.choice(p) for p in WORDS[code])


def model():
    rng = random.Random(0)
    return lm.train([(c, sentence(c, rng)) for c in WORDS for _ in range(30)], lm.load_pieces())


@pytest.fixture(scope="module")
def m():
    return model()


@needs_pieces
def test_forward_sums_all_segmentations():
    pieces = {"▁a", "a", "b", "ab", "▁ab", "▁"}
    p = {x: np.array([0.1 * (k + 1)]) for k, x in enumerate(sorted(pieces))}
    got = lm.PieceModel.of(("x",), p, {s: np.array([0.0]) for s in ("latin", "han", "tamil", "other")}).word("aab")[0]

    def total(s):
        return 1.0 if not s else sum(p[s[:k]][0] * total(s[k:]) for k in range(1, len(s) + 1) if s[:k] in p)

    assert abs(got - np.log(total("▁aab"))) < 1e-9


@needs_pieces
def test_a_long_run_is_summed_over_all_its_segmentations(m):
    p = {"▁": np.array([0.1]), "a": np.array([0.2]), "b": np.array([0.1]), "ab": np.array([0.05]), "ba": np.array([0.02])}
    model = lm.PieceModel.of(("x",), p, {s: np.array([0.0]) for s in ("latin", "han", "tamil", "other")})
    run = "▁" + "ab" * 3000
    alpha, scale = [1.0] + [0.0] * len(run), 0.0
    for j in range(1, len(run) + 1):
        alpha[j] = sum(alpha[j - n] * p[run[j - n : j]][0] for n in (1, 2) if j >= n and run[j - n : j] in p)
        if alpha[j] < 1e-100:
            scale += np.log(alpha[j])
            alpha[j - 1], alpha[j] = alpha[j - 1] / alpha[j], 1.0
    assert abs(model.word("ab" * 3000)[0] - np.log(alpha[-1]) - scale) < 1e-6
    han = "司机打开了旧地图我表哥忘记了小船护士修好了厨房的窗户" * 8
    assert len(han) > 200 and m.langs[int(m.word(han).argmax())] == "zh"


@needs_pieces
def test_samples_are_bounded_by_language(spark):
    rows = [(c, f"{c} {i}") for c in ("en", "zh", "ta") for i in range(50)]
    got = lang.bounded(spark.createDataFrame(rows, "lang string, text string"), "lang", "text", 7).collect()
    assert {c: sum(r.lang == c for r in got) for c in ("en", "zh", "ta")} == {"en": 7, "zh": 7, "ta": 7}


def same_model(got, want):
    rows = {p: got.table[i] for i, p in enumerate(got.pieces)}
    return got.langs == want.langs and got.pieces == want.pieces and np.allclose([rows[p] for p in want.pieces], want.table[: len(want.pieces)], rtol=1e-4, atol=1e-9)


@needs_pieces
def test_a_model_is_fitted_to_all_rows(spark):
    rng = random.Random(11)
    samples = [(c, sentence(c, rng)) for c in WORDS for _ in range(30)] + [("en", f"the driver washed {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}q{chr(97 + i // 676)}") for i in range(1500)]
    words = [("en", f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}") for i in range(1200)] + [("zh", "司机"), ("en", None), (None, "x")]
    a, b = spark.createDataFrame(samples + [("en", None), ("xx", "y")], "lang string, text string"), spark.createDataFrame(words, "lang string, word string")
    given = samples + [(c, w) for c, w in words if c and w]
    pieces = lm.load_pieces()
    assert same_model(lang.fit_model(spark, a, b), lm.train(given, pieces))
    # More rows of a language than any bound had, one of them long, one wrongly labelled, one twice.
    turns = [(c, [sentence(c, rng) for _ in range(4)]) for c in ("es", "zh") for _ in range(700)] + [("ms", [sentence("ms", rng) for _ in range(900)])]
    rows = [(i, "\n".join(f"<Speaker1>: {x}" for x in xs), c) for i, (c, xs) in enumerate(turns)] + [(9000, sentence("ta", rng) * 5, "en"), (9001, None, "en"), (9002, " ", "es")]
    rows.append(rows[0])
    assert len(rows[1400][1]) > 20_000
    labelled = spark.createDataFrame(rows, "id long, text string, language string")
    spoken = [(c, s) for c, xs in turns + turns[:1] for s in xs]
    assert same_model(lang.fit_model(spark, a, b, labelled), lm.train(given + spoken, pieces))
    assert same_model(lang.fit_model(spark, a, b, labelled.where("false")), lm.train(given, pieces))


@needs_pieces
def test_units_of_words_are_summed_apart(m):
    p = {"▁": 0.1, "a": 0.2, "b": 0.1, "c": 0.3, "ab": 0.05, "▁a": 0.02, "bca": 0.04}
    longer = lm._finder([x for x in p if len(x) > 1])
    assert lm.units_of("abcaccb", longer) == ["▁abca", "c", "c", "b"] and lm.units_of("", longer) == ["▁"]
    model = lm.PieceModel.of(("x",), {x: np.array([v]) for x, v in p.items()}, {s: np.array([0.0]) for s in lm.SCRIPTS})

    def total(s):
        return 1.0 if not s else sum(p[s[:k]] * total(s[k:]) for k in range(1, len(s) + 1) if s[:k] in p)

    assert abs(model.word("abcaccb")[0] - sum(np.log(total(u)) for u in lm.units_of("abcaccb", longer))) < 1e-9


@needs_pieces
def test_language_of_held_out_sentences(m):
    rng = random.Random(7)
    tests = [(c, sentence(c, rng) + " " + sentence(c, rng)) for c in WORDS for _ in range(40)]
    right = sum(m.langs[int(m.posterior(t).argmax())] == c for c, t in tests)
    assert right == len(tests)
    assert m.posterior("12 !!") is None


@needs_pieces
def test_main_language_segments_and_labels(spark, m):
    rng = random.Random(3)
    mixed = f"<Speaker1>: {sentence('zh', rng)}{sentence('zh', rng)} <Speaker2>: {sentence('en', rng)} <Speaker1>: {sentence('zh', rng)} ok。"
    rows = [
        (1, mixed, "zh-MY", "x"), (2, mixed, "English ", "x"), (3, mixed, None, "x"), (4, mixed, "und", "x"), (5, None, "en", "x"), (6, " ", "en", "x"),
        (7, "- map\n- boat\n- soup\n- rice", "en", "x"), (8, "fbwclq rrtzz qqxkp mnvbz", "en", "x"), (9, sentence("es", rng), "ta", "x"),
        (10, "<Speaker1>: " + sentence("ms", rng) * 2000, "msa", "x"),
    ]
    df = spark.createDataFrame(rows, "row_id long, text string, language string, id string")
    found = lang.languages(df, m, keep=("language",))
    got = {(r.id, r.kind, r.lang) for r in lang.label_faults(found).collect()}
    assert got == {(1, "segment", "en"), (2, "segment", "en"), (3, "segment", "en"), (4, "segment", "en"), (2, "wrong", "zh"), (3, "missing", "zh"), (4, "missing", "zh"), (9, "wrong", "es")}
    assert lang.languages(df.where("false"), m, keep=("language",)).count() == 0


@needs_pieces
def test_kinds(m):
    assert kinds.text_kind("| a | 1 | ok |\n|---|---|---|\n| b | 2 | no |", m) == "table"
    assert kinds.text_kind("id,item,n\n0,map,3\n1,boat,4", m) == "table"
    assert kinds.text_kind("the map, a boat, the window, my cousin", m) == "list"
    assert kinds.text_kind("Xk3/9fQz0PplmW2+Zr8T", m) == "junk" and kinds.text_kind("#$%^ &*() {}|", m) == "junk"
    assert kinds.text_kind("the driver opened the window. my cousin forgot the map.", m) == "prose" and kinds.text_kind(" \n", m) == "blank"


@needs_pieces
def test_quality(spark, m):
    rng = random.Random(5)
    rows = [(i, " ".join(sentence(c, rng) for _ in range(5)), "x") for i, c in enumerate(["en", "ms", "zh", "es", "ta"] * 60)]
    rows += [(1000, "- the map\n- a boat\n- the window\n- a nurse", "x"), (1001, "qzx wvb 99 $$ ## kkt//", "x"), (1002, None, "x"), (1003, "", "x"), (1004, "a;1;2\nb;3;4\nc;5;6", "x"), (1005, "yeah " * 20000, "x")]
    df = spark.createDataFrame(rows, "row_id long, text string, kind string")
    words = spark.createDataFrame([("en", "the"), ("en", "a"), ("zh", "了"), (None, "x"), ("en", None)], "lang string, word string")
    got = {r.id: r for r in quality.text_quality(df, m, words).collect()}
    assert {i: r.kind for i, r in got.items() if r.kind} == {1000: "list", 1001: "junk", 1004: "table"}
    assert all(abs(sum(r.contributions) - r.distance) < 1e-6 for r in got.values()) and got[1002].n_words == 0
    assert quality.text_quality(df.where("false"), m, words).count() == 0


@needs_pieces
def test_a_small_language_and_many_common_words(spark, m):
    rng = random.Random(9)
    rows = [(i, " ".join(sentence("en", rng) for _ in range(5))) for i in range(300)] + [(1000 + i, " ".join(sentence("ta", rng) for _ in range(5))) for i in range(12)]
    words = spark.createDataFrame([("en", f"word{i}") for i in range(25_000)] + [("ta", "என்"), ("ta", "படகை"), ("ta", "கதவை")], "lang string, word string")
    got = {r.id: r for r in quality.text_quality(spark.createDataFrame(rows, "row_id long, text string"), m, words).collect()}
    assert max(got[1000 + i].common_word_share for i in range(12)) > 0
    assert all(got[1000 + i].kind is None for i in range(12)) and sum(got[i].kind is not None for i in range(300)) == 0


def test_stale(spark):
    f = lambda n, w, r, d=30.0: (d, 0.0, r, w, n, 0.0, 0.0)
    rows = [
        (1, "en_30", "<Speaker1>: a b c", f(3, 6.0, 3 / 2.3 / 30)), (2, "en_30", "a b c", f(4, 6.0, 3 / 2.3 / 30)), (3, "zh_30", "你好 a", f(2, 4.0, 2 / 2.3 / 30)),
        (4, "ta_30", "அம்மா ok", f(2, 4.1, 2 / 2.3 / 30)), (5, "en_30", None, f(0, 0.0, 0.0)), (6, "en_30", "a", None), (7, "en_30", "<Speaker3>: a", f(2, 4.0, 2 / 2.3 / 30)),
    ]
    schema = "row_id long, config_key string, text string, text_features struct<true_duration:double,talk_time:double,speech_ratio:double,wpm:double,word_count:long,word_repetition:double,redundancy_score:double>"
    assert sorted(r.id for r in quality.stale_features(spark.createDataFrame(rows, schema)).collect()) == [2, 4]


def brute_share(words, least=5):
    marked = [False] * len(words)
    for i in range(len(words) - least + 1):
        if any(words[j : j + least] == words[i : i + least] for j in range(i)):
            marked[i : i + least] = [True] * least
    return sum(marked) / len(words) if len(words) >= least else 0.0


def test_repetition_against_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice("pqrs") for _ in range(rng.randint(0, 60))]
        share, longest, n = repetition.repeated_share(" ".join(words))
        assert abs(share - brute_share(words)) < 1e-12 and n == len(words)
    han = "今天天气很好我们去公园"
    assert repetition.repeated_share(han * 2)[0] == 0.5 and repetition.repeated_share("甲乙丙丁戊己庚" + "x" + "甲乙丙丁戊己庚")[0] == 0
    assert repetition.repeated_share(None) == (0.0, 0, 0) and repetition.repeated_share("word " * 30000)[0] > 0.99


@needs_pieces
def test_repetitive_prose_is_found_in_one_python_pass(spark, m, tmp_path, monkeypatch):
    rng = random.Random(3)
    once = "the driver opened the old map."
    listed = "the map, a boat, the window, my cousin, the map, a boat, the window, my cousin"
    table = "id,item,n\n0,the old map,3\n0,the old map,3\n0,the old map,3"
    junk = "xkqz fjwv zzxq pvkx qjzw " * 6
    rows = [(1, once * 3), (2, once), (3, None), (4, ""), (5, listed), (6, table), (7, junk), (8, "<Speaker1>: " + listed), (9, "司机打开了旧地图。" * 2), (1, once * 3)]
    rows += [(100 + i, " ".join(sentence("en", rng) for _ in range(8))) for i in range(60)]
    spark.createDataFrame(rows, "row_id long, text string").write.parquet(str(tmp_path / "feature_rows.parquet"))
    monkeypatch.setattr(queries, "_model", lambda spark, sf: m)
    high = [(i, t) for i, t in rows if repetition.repeated_share(t)[0] >= repetition.MIN_SHARE]
    assert {5, 6, 7} <= {i for i, _ in high}
    found = queries.p6_found(spark, str(tmp_path))
    got = sorted(r.row_id for r in found.collect())
    assert got == sorted(i for i, t in high if kinds.text_kind(t, m) == "prose")
    assert [i for i in got if i < 100] == [1, 1, 8, 9]
    # Every further Python stage of a task is a worker with a model of its own.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "EvalPython" not in plan


@needs_pieces
def test_the_fit_holds_the_words_of_a_part_at_a_time(m, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(sentence("en", rng) for _ in range(rng.randint(1, 6))) for _ in range(300)] + [" ".join(sentence("en", rng) for _ in range(400)), ""]
    codes = [rng.choice(["en", "ms"]) for _ in texts]
    monkeypatch.setattr(lang, "_PART", 10**9, raising=False)
    whole = list(lang.agreeing_sentences(texts, codes, m))
    monkeypatch.setattr(lang, "_PART", 2000, raising=False)
    asked, posteriors = [], m.posteriors
    monkeypatch.setattr(m, "posteriors", lambda given: asked.append(len(given)) or posteriors(given))
    assert list(lang.agreeing_sentences(texts, codes, m)) == whole and len(whole) > 300
    # The long text goes alone; every other part is a small share of the batch.
    assert sorted(asked)[-1] == 400 and sorted(asked)[-2] < 120 and list(lang.agreeing_sentences([], [], m)) == []


def test_cuts_of_held_out_texts():
    rng = random.Random(1)
    def text():
        return " ".join(f"<Speaker{rng.randint(1, 2)}>: " + sentence(rng.choice(["en", "ms", "es"]), rng) for _ in range(4))

    examples = [(truncation.features(t, near), cut) for _ in range(500) for t, near, cut in truncation.artificial(text(), rng, False)]
    weights = truncation.train(examples)
    held = [x for _ in range(150) for x in truncation.artificial(text(), rng, False)]
    right = sum((truncation.probability(t, near, weights) >= 0.5) == bool(cut) for t, near, cut in held)
    assert right / len(held) > 0.93


@needs_pieces
def test_cut_rows_and_limits(spark, m):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        t = " ".join(f"<Speaker{rng.randint(1, 2)}>: " + sentence("en", rng) for _ in range(rng.randint(2, 9)))
        rows.append((i, "en_30", t[:200], "x"))
    rows += [(900, "en_30", None, "x"), (901, "en_30", " ", "x"), (902, None, "<Speaker1>: the dri", "x"), (903, "en_30", "- map\n- boat\n- nurse\n- win", "x"), (904, "en_30", "<Speaker1>: " + sentence("en", rng) * 5000, "x")]
    df = spark.createDataFrame(rows, "row_id long, config_key string, text string, source string")
    assert truncation.set_limits(df) == {"en_30": ("chars", 200)}
    found = truncation.truncated(df, m).cache()
    got = {r.id for r in found.where("cut").collect()}
    want = {r[0] for r in rows[:400] if len(r[2]) == 200 and not r[2].endswith(".")} | {902}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.03 * len(rows)
    assert {r.source: r.n_rows for r in truncation.cut_rates(found).collect()} == {"en_30": 404, None: 1}
    assert truncation.truncated(df.where("false"), m).count() == 0


def test_a_limit_of_few_characters(spark):
    df = spark.createDataFrame([(i, "en_s", "the driver opened it"[:12] if i % 4 else "short one.") for i in range(200)] + [(500 + i, "en_s", "the map is o") for i in range(100)], "row_id long, config_key string, text string")
    assert truncation.set_limits(df) == {"en_s": ("chars", 12)}


NAMES = [(a, b) for a in ("Ashwyn", "Ashrel", "Quenndon", "Quennara", "Velmith", "Velmara") for b in ("Oaksling", "Oaksmere", "Grayfield", "Grayling", "Fennmere", "Fennfield")]


def pii_docs():
    rng, docs = random.Random(6), []
    for i in range(300):
        n = rng.choice(NAMES)
        docs.append((i, rng.choice([f"My name is {n[0]} {n[1]}. The boat is here.", f"Please thank {n[0]} {n[1]} for the map.", f"{n[0]} {n[1]} opened the window.", "The driver opened the window. Nobody saw the boat."]), "x"))
    return docs


def test_mentions_and_placeholders(spark):
    docs = pii_docs() + [
        (1000, "Call me on +60100949589 or (03) 0987-4307, mail a.b at mail dot test.", "x"), (1001, "IC number 760612-70-7812, order 2025-03-11-0004, job 997788005125.", "x"),
        (1002, "I live at Flat 3, 203 Saltgrass Road, Lower Brindle 00417. 我住在白榆区青禾路138号3楼。", "x"), (1003, None, "x"), (1004, "", "x"),
        (1005, "Quenndon Oaksmere forgot the map.", "x"), (1006, "x" * 100000 + " a@b.test", "x"), (1006, "x" * 100000 + " a@b.test", "x"),
        (1007, "zero one zero zero eight zero seven five nine eight tonight. 打我电话０１００７７６９２２", "x"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string, id string")
    d = pii.learn(df)
    got = {r.id: r for r in pii.sanitise(df, d).collect()}
    spans = lambda i: [(x.pos, x.kind) for x in got[i].mentions]
    assert spans(1000) == [(11, "phone"), (27, "phone"), (48, "email")]
    assert spans(1001) == [(10, "id")] and spans(1002) == [(10, "address"), (62, "address")]
    assert spans(1003) == spans(1004) == [] and got[1003].clean_text is None and got[1004].clean_text == ""
    assert got[1005].clean_text == "[NAME] forgot the map." and spans(1006) == [(100001, "email")] and spans(1007) == [(0, "phone"), (65, "phone")]
    wrong = 0
    for i, text, _ in pii_docs():
        want = next((text.index(f"{a} {b}") for a, b in NAMES if f"{a} {b}" in text), None)
        wrong += [p for p, k in spans(i) if k == "name"] != ([] if want is None else [want])
    assert wrong <= 3
    assert pii.sanitise(df.where("false"), d).count() == 0 and pii.learn(df.where("false")).tokens == 0


def test_forms_without_counts_are_no_mentions():
    text = "Call me on +60100949589, write to a.b@mail.test, My name is Ashwyn Oaksling, 我叫蔺棠。 IC number 760612-70-7812. I live at 203 Saltgrass Road."
    assert len(pii.structured(text)) == 4 and pii.mentions(text, pii.Disclosure.of([])) == []


def test_phones_with_mixed_separators_and_names_of_three_words(spark):
    docs = [(i, f"me llamo {a} {b} {c}. Llámeme al 012-34{i % 10} 67{i % 7}9.") for i, (a, b, c) in enumerate([("Maria", "Elena", "Lopez"), ("Mario", "Elias", "Lopera"), ("Marina", "Elena", "Lozano")] * 30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.clean_text for r in pii.sanitise(df, pii.learn(df)).collect()} == {"me llamo [NAME]. Llámeme al [PHONE]."}


def test_a_form_that_never_stands_near_a_cue_is_no_mention(spark):
    docs = [(i, f"Write to u{i}@mail.test now. The boat is here.") for i in range(60)] + [(100 + i, f"Meet me at the dot on map {i} again.") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.id: [x.kind for x in r.mentions] for r in pii.sanitise(df, pii.learn(df)).collect()}
    assert all(got[i] == ["email"] for i in range(60)) and all(got[100 + i] == [] for i in range(60))


def test_terms_that_disclose_an_entity_are_generalised(spark):
    docs = pii_docs() + [(1000 + i, f"My name is Quenndon Oaksmere. They call me stormpetrel on day {i}.", "x") for i in range(6)] + [(2000 + i, f"They call me here on day {i}. The boat is mine.", "x") for i in range(60)]
    docs += [(3000 + i, "My name is Velmara Grayling. The thundermole is mine.", "x") for i in range(6)]
    df = spark.createDataFrame(docs, "doc_id long, text string, id string")
    seen = pii.observed(df)
    d = pii.learned(seen)
    got = {r.id: r for r in pii.generalised(pii.sanitised(seen, d), d).collect()}
    assert all(got[1000 + i].clean_text == f"My name is [NAME]. They call me [TERM] on day {i}." and got[1000 + i].n_terms == 1 for i in range(6))
    # Copies of one text bear a term out once.
    assert got[3000].clean_text == "My name is [NAME]. The thundermole is mine." and got[2000].n_terms == 0 and len(got) == len(docs)


def test_numbers_and_cues_of_a_long_text_are_linear():
    import time

    text, began = "tel 1234567 x " * 100_000, time.time()
    counts = pii.TermCounts()
    counts.add(text, pii.structured(text))
    assert time.time() - began < 30


HAN_NAMES = [a + b for a in "蔺砚筠荞" for b in ("棠", "澜", "渡", "知野", "若初", "云晴")] + ["慕容" + b for b in ("知野", "若初", "云晴", "棠澜")]


def test_chinese_names_of_two_to_four_characters(spark):
    rng, docs = random.Random(8), []
    for i in range(600):
        n = rng.choice(HAN_NAMES)
        docs.append((i, rng.choice([f"我叫{n}。今天开会。", f"谢谢{n}，我们走吧。", f"{n}老师刚才打开了窗户。", f"昨天{n}打开了窗户。", "昨天老师打开了窗户，今天我们开会。"])))
    docs += [(1000 + i, f"我叫{n}。") for i, n in enumerate(HAN_NAMES)] + [(2000 + i, f"昨天{n}打开了窗户。") for i, n in enumerate(HAN_NAMES)] + [(3000, "我叫蔺棠今天开会。"), (3001, "昨天老师打开了窗户。"), (3002, "昨天老师打开了窗户，今天我们开会。" * 3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.id: r.clean_text for r in pii.sanitise(df, pii.learn(df)).collect()}
    assert all(got[1000 + i] == "我叫[NAME]。" and got[2000 + i] == "昨天[NAME]打开了窗户。" for i in range(len(HAN_NAMES)))
    assert got[3000] == "我叫[NAME]今天开会。" and got[3001] == "昨天老师打开了窗户。"


def test_names_of_more_than_two_words(spark):
    long = ["Quenndon Oaksmere Grayling", "Ashwyn Velmith binti Fennfield", "Velmara Ashrel Oaksling Grayfield"]
    docs = pii_docs() + [(1000 + i, f"My name is {n}. The boat is here.", "x") for i, n in enumerate(long * 3)] + [(2000 + i, f"Yesterday {n} opened the window.", "x") for i, n in enumerate(long)]
    tamil = "மதுசுடரன் வேலவூரான் மலைரசூரன்"
    docs += [(3000 + i, f"என் பெயர் {a} {b}. நன்றி", "x") for i, (a, b) in enumerate([tamil.split()[:2], tamil.split()[1:], tamil.split()[::2]] * 20)] + [(4000, f"நேற்று {tamil} வந்தார்.", "x")]
    docs += [(5000, "நேற்று அவர் இங்கே வந்தார். நாங்கள் படகை பார்த்தோம். " * 5000, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, id string")
    got = {r.id: r.clean_text for r in pii.sanitise(df, pii.learn(df)).collect()}
    assert all(got[1000 + i] == "My name is [NAME]. The boat is here." for i in range(9))
    assert all(got[2000 + i] == "Yesterday [NAME] opened the window." for i in range(3))
    assert got[4000] == "நேற்று [NAME] வந்தார்."
    said = "My name is Nur Aisyah binti Hassan and I"
    assert [said[a:b] for a, b in pii.name_slots(said)] == ["Nur", "Aisyah", "binti", "Hassan"]


@needs_pieces
def test_one_long_text_through_every_operator(m):
    """Two million characters, each operator with a time limit that only linear work meets."""
    import time

    from voxloom.llm import pieces, tokens, turns

    rng = random.Random(1)
    said = [f"<Speaker{rng.randint(1, 3)}>: {sentence(rng.choice(list(WORDS)), rng)} call me on 012-345 {rng.randint(1000, 9999)} or a{rng.randint(1, 99)}@b.test, part {rng.randint(1, 9)}: (ah). " for _ in range(20_000)]
    text = "".join(said)
    assert len(text) > 1_500_000
    weights, encoder = turns.fit(["One sentence stands here.", "Another one."], rounds=5), tokens.PrefixEncoder.load()

    def personal():
        counts, spans = pii.TermCounts(), pii.structured(text)
        counts.add(text, spans)
        return len(pii.mentions(text, pii.Disclosure.of(counts.rows()), spans))

    work = {
        "turns": lambda: turns.clean_turns(text, weights), "language": lambda: lang.detect(text, m), "statistics": lambda: quality.statistics(text, m, {}),
        "repetition": lambda: repetition.repeated_share(text), "cut": lambda: truncation.probability(text, "no", np.zeros((1 << truncation.BITS) + 2)),
        "pieces": lambda: pieces.split_text(text, 500, 50), "tokens": lambda: encoder.encode(text), "personal": personal,
    }
    for name, f in work.items():
        began = time.time()
        assert f(), name
        assert time.time() - began < 60, name
