import os
import random

import pytest

from voxloom.llm import mixing, tokens

needs_vocabulary = pytest.mark.skipif(not os.path.exists(os.path.join(tokens.TOKENIZER_DIR, tokens.VOCABULARY)), reason="no public vocabulary here")
TEXTS = [None, "", " ", "\n\n", "Hello world", "<|endoftext|> <s> [CLS]", "你好，世界", "அம்மா வீட்டில்", "a" * 3000, "  two  spaces\t\n x", "don't I'VE we'll", "😀👍🏽 𝄞 ﬁlm", "x​y ﻿", "0123456789" * 30]


@pytest.fixture(scope="module")
def encoder():
    return tokens.PrefixEncoder.load()


@needs_vocabulary
def test_ids_equal_the_public_tokenizer(spark, encoder):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(tokens.TOKENIZER_DIR, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    want = [t.encode(x or "", add_special_tokens=False).ids for x in TEXTS]
    assert [encoder.encode(x) for x in TEXTS] == want
    df = spark.createDataFrame([(i, x, "y") for i, x in enumerate(TEXTS)], "doc_id long, text string, ids string")
    assert {r.doc_id: r.ids for r in tokens.encode_texts(df).collect()} == dict(enumerate(want))
    assert {r.doc_id: r.n_tokens for r in tokens.count_tokens(df).collect()} == {i: len(x) for i, x in enumerate(want)}
    assert tokens.encode_texts(df.where("false")).count() == 0


@needs_vocabulary
def test_prefix_table_equals_merging(encoder):
    rng = random.Random(1)
    for _ in range(300):
        data = bytes(rng.choice(b"abcdeinorst  th") for _ in range(rng.randint(1, 25)))
        last = []
        encoder.extend(data, last, len(data) // 2)
        encoder.extend(data, last)
        for end in range(1, len(data) + 1):
            assert encoder.walk(last[:end]) == encoder.merge(data[:end])


@needs_vocabulary
def test_appends_and_edits(encoder):
    rng, letters = random.Random(3), "abc  \n'the12你த"
    for _ in range(300):
        x = tokens.EncodedText(encoder, "".join(rng.choice(letters) for _ in range(rng.randint(0, 40))))
        for _ in range(4):
            a = rng.randint(0, len(x.text))
            new = "".join(rng.choice(letters) for _ in range(rng.randint(0, 5)))
            if rng.random() < 0.4:
                x.append(new)
            else:
                x.edit(a, rng.randint(a, min(len(x.text), a + 6)), new)
            assert x.ids == encoder.encode(x.text)
    x = tokens.EncodedText(encoder, "some words and more words. " * 2000)
    x.edit(20000, 20003, "zz")
    assert x.encoded < 10 and x.ids == encoder.encode(x.text)


@needs_vocabulary
def test_a_change_costs_what_it_touches(encoder):
    x = tokens.EncodedText(encoder, "a" * 20_000)
    x.append("bc")
    assert x.bytes_encoded == 2 and x.ids == encoder.encode("a" * 20_000 + "bc")
    x.edit(19_990, 20_002, "xyz")
    assert x.bytes_encoded <= 16 and x.ids == encoder.encode(x.text)
    rng = random.Random(9)
    y = tokens.EncodedText(encoder, " ".join("word" * rng.randint(1, 40) for _ in range(900)))
    for _ in range(60):
        a = rng.randint(0, len(y.text))
        y.edit(a, rng.randint(a, min(len(y.text), a + rng.choice([0, 3, 400]))), rng.choice(["", " ", "zz", "\n\n", "long" * 50]))
        assert y.ids == encoder.encode(y.text) and "".join(str(p.size) for b in y.blocks for p in b)
    assert sum(y.sizes) == len(y.text)


def naive(weights, seats, caps):
    got = [0] * len(weights)
    for _ in range(seats):
        best = max(((w / (2 * g + 1), -i) for i, (w, g, c) in enumerate(zip(weights, got, caps)) if w > 0 and g < c), default=None)
        if best is None:
            break
        got[-best[1]] += 1
    return got


def test_apportionment():
    rng = random.Random(1)
    for _ in range(1500):
        n, seats = rng.randint(1, 7), rng.randint(0, 250)
        weights = [rng.choice([0, rng.random(), rng.randint(1, 5) / 10]) for _ in range(n)]
        caps = [rng.choice([seats, rng.randint(0, 80)]) for _ in range(n)]
        assert mixing.sainte_lague(weights, seats, caps) == naive(weights, seats, caps)


def test_apportionment_of_one_large_and_many_small_parties():
    assert mixing.sainte_lague([90.0] + [0.55] * 20, 101)[0] == 82
    rng = random.Random(4)
    for _ in range(200):
        weights = [rng.choice([50.0, 90.0, 400.0])] + [rng.choice([0.3, 0.55, 1.0, 1.0]) for _ in range(rng.randint(1, 40))]
        rng.shuffle(weights)
        seats = rng.randint(0, 300)
        caps = [rng.choice([seats, seats, rng.randint(0, 60)]) for _ in weights]
        assert mixing.sainte_lague(weights, seats, caps) == naive(weights, seats, caps)
    many = mixing.sainte_lague([0.5, 0.3, 0.2], 10**11)
    assert sum(many) == 10**11 and abs(many[0] - 5 * 10**10) <= 1


@needs_vocabulary
def test_shards_in_groups(spark, monkeypatch):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, "word " * rng.randint(1, 30), "ab"[i % 3 == 0]) for i in range(900)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 3)], "source string, target_share double, max_repeats int")
    monkeypatch.setattr(mixing, "GROUP_SHARDS", 3)
    sized = mixing.sized_documents(docs)
    quotas, plan = mixing.plan_quotas(sized, targets, shard_tokens=500)
    rows, want = quotas.collect(), {r.source: r.quota_tokens for r in plan.collect()}
    assert len(rows) > 6 and {s: sum(r.quota_tokens for r in rows if r.source == s) for s in want} == want
    assert all(r.quota_tokens <= r.shard_tokens * r.max_repeats for r in rows)


@needs_vocabulary
def test_mix(spark):
    rng = random.Random(2)
    sizes = {"big": 600, "mid": 200, "small": 30, "other": 50}
    rows = [(i, "word " * rng.randint(1, 40), s, "x") for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    rows += [(5000, None, "big", "x"), (5001, "", "mid", "x"), (5002, "words", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, repeats string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 3), ("small", 0.2, 4), ("absent", 0.1, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    chosen, report = mixing.mix(docs, targets)
    chosen, report = chosen.collect(), {r.source: r for r in report.collect()}
    assert len({r.doc_id for r in chosen}) == len(chosen) and all(1 <= r.repeats <= {"big": 1, "mid": 3, "small": 4}[r.source] for r in chosen)
    assert abs(report["small"].mixed_tokens - 4 * report["small"].source_tokens) <= 0.05 * report["small"].mixed_tokens
    assert report["absent"].mixed_tokens == 0 and abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9
    assert abs(report["big"].actual_share / report["mid"].actual_share - 5 / 3) < 0.1
    assert all(r.source in sizes and r.doc_id < 5000 for r in chosen)
    again, _ = mixing.mix(docs, targets)
    assert {(r.doc_id, r.repeats) for r in again.collect()} == {(r.doc_id, r.repeats) for r in chosen}
    none, empty = mixing.mix(docs.where("false"), targets)
    assert none.count() == 0 and {r.mixed_tokens for r in empty.collect()} == {0}
