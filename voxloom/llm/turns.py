"""Problem 1: speech transcripts into clean speaker turns.

Method: a semi-Markov conditional model over whole turns.  Candidates for the
start of a turn are all places where something is built like a label, a word
and a number with a mark behind them ("Part 2:", "[3]", "Q1:"), whether or not
it is spelt like a speaker, together with a timestamp next to it.  A
segmentation is a choice of candidates, or of none; its score is the sum of the scores of its turns, each a weighted sum
of features of the label (spelling, place in the line), of the pause (timestamp
given, time since the turn before) and of the lexical continuity across the
boundary (does a sentence end before it and one begin after it).  The weights
are fitted by conditional likelihood (forward sums over all segmentations) on
transcripts that are put together from clean sample sentences; decoding is the
best path.  Non-speech spans are removed when a turn is rebuilt; a candidate that
does not start a turn is what was said there, and stays.

Null and blank texts, and texts without any label, give no turns.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm import speech
from voxloom.session import spread

FEATURES = [
    "turns", "bracketed", "plain", "line_start", "after_stop", "after_comma", "mid_sentence", "before_capital",
    "before_lower", "mention", "timestamp", "no_timestamp", "pause_long", "time_back", "style_repeats",
    "inside_bracketed", "inside_plain", "inside_mention", "inside_stop", "inside_timestamp", "log_words", "empty",
    "other_word", "other_line_start", "other_timestamp", "other_repeats", "inside_other",
]
_INDEX = {f: i for i, f in enumerate(FEATURES)}
# Features of the candidates that a turn passes over, with those that they add up.
_INSIDE = (("inside_other", "other_word"), ("inside_bracketed", "bracketed"), ("inside_plain", "plain"), ("inside_mention", "mention"), ("inside_stop", "after_stop"), ("inside_timestamp", "timestamp"))
_GAP = re.compile(r"[\s,，]*\Z")


class Candidate:
    """A possible start of a turn: where its head begins and its words begin, its number, time and features."""

    __slots__ = ("head", "body", "number", "seconds", "x", "label")

    def __init__(self, head, body, number, seconds, x, label=None):
        self.head, self.body, self.number, self.seconds, self.x, self.label = head, body, number, seconds, x, label


def _ends_stop(before: str) -> bool:
    return bool(re.search(r"[.!?。！？…)\]>）*:：][\s\"”’]*\Z", before))


def candidates(text: str) -> list[Candidate]:
    """The candidates of a text with the features of each as the head of a turn."""
    known = speech.label_spans(text)
    stamps = [(*m.span(), m.group()) for m in speech.TIMESTAMP.finditer(text)]
    others = speech.numbered_spans(text, sorted([x[:2] for x in known] + [x[:2] for x in stamps]))
    labels = sorted([(*x, False) for x in known] + [(*x, True) for x in others])
    if not labels:
        return []
    by_end = {}
    for a, b, mark in stamps:
        by_end[b] = (a, mark)
    stamp_after = {a: (b, mark) for a, b, mark in stamps}

    def before(pos: int):
        p = pos
        while p > 0 and text[p - 1] in " \t,，":
            p -= 1
        return by_end.get(p)

    def after(pos: int):
        p = pos
        while p < len(text) and text[p] in " \t,，":
            p += 1
        return stamp_after.get(p)

    # Timestamps stand before the labels of a text or after them, as most of its labels show.
    leading = sum(before(a) is not None for a, _, _ in known) >= sum(after(b) is not None for _, b, _ in known)
    styles = [re.sub(r"\d+", "9", text[a:b]).strip() for a, b, *_ in labels]
    uses = Counter(styles)
    out = []
    for k, (a, b, number, other) in enumerate(labels):
        head, body, seconds = a, b, None
        if leading and (hit := before(a)):
            head, seconds = hit[0], speech.timestamp_seconds(hit[1])
        elif not leading and (hit := after(b)):
            body, seconds = hit[0], speech.timestamp_seconds(hit[1])
        prior, following = text[max(0, head - 40) : head], text[body : body + 40].lstrip(" \t,，")
        bracketed = text[a] in "<*[说" or "_" in text[a:b] or text[b - 1] == ">"
        x = np.zeros(len(FEATURES))
        x[_INDEX["turns"]] = 1
        x[_INDEX["bracketed" if bracketed else "plain"]] = 1
        line = head == 0 or not prior.strip() or bool(re.search(r"[\r\n]\s*\Z", prior))
        stop = line or _ends_stop(prior)
        comma = bool(re.search(r"[,，]\s*\Z", prior))
        x[_INDEX["line_start"]] = line
        x[_INDEX["after_stop"]] = stop
        x[_INDEX["after_comma"]] = comma
        x[_INDEX["mid_sentence"]] = not (stop or comma)
        first = following[:1]
        x[_INDEX["before_lower"]] = first.islower()
        x[_INDEX["before_capital"]] = bool(first) and not first.islower()
        x[_INDEX["mention"]] = not bracketed and not (stop or comma) and first.islower() and seconds is None
        x[_INDEX["timestamp" if seconds is not None else "no_timestamp"]] = 1
        x[_INDEX["style_repeats"]] = uses[styles[k]] > 1
        x[_INDEX["other_word"]] = other
        x[_INDEX["other_line_start"]] = other and line
        x[_INDEX["other_timestamp"]] = other and seconds is not None
        x[_INDEX["other_repeats"]] = other and uses[styles[k]] > 1
        out.append(Candidate(head, body, number, seconds, x, (a, b)))
    return out


def _span_features(text: str, cands: list[Candidate], i: int, j: int) -> np.ndarray:
    """Features of the turn that begins at candidate i and ends before candidate j."""
    x = cands[i].x.copy()
    end = cands[j].head if j < len(cands) else len(text)
    inner = cands[i + 1 : j]
    for name, of in _INSIDE:
        x[_INDEX[name]] = sum(c.x[_INDEX[of]] for c in inner)
    n = len(text[cands[i].body : end].split())
    x[_INDEX["log_words"]] = math.log1p(n) / 5
    x[_INDEX["empty"]] = n == 0
    _pause(x, cands, i)
    return x


def _pause(x: np.ndarray, cands: list[Candidate], i: int) -> None:
    """Set the features of the time between candidate i and the one before."""
    if i and cands[i].seconds is not None and cands[i - 1].seconds is not None:
        gap = cands[i].seconds - cands[i - 1].seconds
        x[_INDEX["pause_long"]] = gap > 5
        x[_INDEX["time_back"]] = gap < 0


def _passed(c: Candidate) -> np.ndarray:
    """Features that a candidate adds to the turn that passes over it."""
    x = np.zeros(len(FEATURES))
    for name, of in _INSIDE:
        x[_INDEX[name]] += c.x[_INDEX[of]]
    return x


def _lattice(text: str, cands: list[Candidate]) -> list[tuple[int, int, np.ndarray]]:
    n = len(cands)
    return [(i, j, _span_features(text, cands, i, j)) for i in range(n) for j in range(i + 1, n + 1)]


def decode(text: str, cands: list[Candidate], weights: np.ndarray) -> list[int]:
    """The candidates that start turns on the best path; the first may be passed over too."""
    n = len(cands)
    if n == 1:
        return [0]
    heads, passed = [], [0.0]
    inside = np.zeros(len(FEATURES))
    for name, of in _INSIDE:
        inside[_INDEX[of]] += weights[_INDEX[name]]
    for i, c in enumerate(cands):
        x = c.x.copy()
        _pause(x, cands, i)
        heads.append(float(x @ weights))
        passed.append(passed[-1] + float(c.x @ inside))
    words = [m.span() for m in re.finditer(r"\S+", text)]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    stop = [c.head for c in cands] + [len(text)]
    upto, since = [bisect_left(starts, p) for p in stop], [bisect_right(ends, c.body) for c in cands]
    per_log, per_empty = float(weights[_INDEX["log_words"]]) / 5, float(weights[_INDEX["empty"]])

    def log(k: int) -> float:
        return per_log * math.log1p(k)

    def count(i: int, j: int) -> int:
        return max(0, upto[j] - since[i]) if stop[j] > cands[i].body else 0

    def length(i: int, j: int) -> float:
        k = count(i, j)
        return log(k) if k else per_empty

    # A turn from i to j scores base(i) + passed[j] + length(i, j), and only the last part depends on both.  Of two starts
    # whose turns differ by d words the lengths draw nearer with every j, so a start that another one beats by more than
    # the widest difference to come is left out: the result is exact, and long texts stay about linear.
    back, live, best = [0] * (n + 1), [], 0.0
    for j in range(1, n + 1):
        base, k = best + heads[j - 1] - passed[j], count(j - 1, j)
        kept, useless = [], False
        for i, b in live:
            d, k1 = since[j - 1] - since[i], max(k, 1)
            gap, some = log(k1 + d) - log(k1), log(d + 1)
            if not (base > b + max(0.0, gap) and (k or base + per_empty > b + max(0.0, per_empty, some))):
                kept.append((i, b))
            useless = useless or b + min(0.0, gap) >= base and (k > 0 or b + min(0.0, per_empty, some) >= base + per_empty)
        live = kept if useless else [*kept, (j - 1, base)]
        best, back[j] = -math.inf, j - 1
        for i, b in live:
            if b + passed[j] + length(i, j) > best:
                best, back[j] = b + passed[j] + length(i, j), i
    path, j = [], n
    while j > 0:
        path.append(back[j])
        j = back[j]
    return path[::-1]


def _prepare(text: str, truth: set[int]) -> tuple[int, list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Candidates, edges, their features, and which edges the true segmentation has."""
    cands = candidates(text)
    n = len(cands)
    edges = _lattice(text, cands)
    starts = sorted(k for k in range(n) if k == 0 or cands[k].head in truth)
    pairs = set(zip(starts, starts[1:] + [n]))
    return n, [(i, j) for i, j, _ in edges], np.array([x for *_, x in edges]), np.array([(i, j) in pairs for i, j, _ in edges])


def _gradient(n: int, edges: list[tuple[int, int]], x: np.ndarray, gold: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Gradient of the log likelihood of one labelled transcript."""
    score = (x @ weights).tolist()
    alpha, beta = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
    alpha[0] = beta[n] = 0.0
    for (i, j), s in zip(edges, score):
        alpha[j] = float(np.logaddexp(alpha[j], alpha[i] + s))
    for (i, j), s in zip(reversed(edges), reversed(score)):
        beta[i] = float(np.logaddexp(beta[i], beta[j] + s))
    p = np.array([math.exp(min(0.0, alpha[i] + s + beta[j] - alpha[n])) for (i, j), s in zip(edges, score)])
    return (gold - p) @ x


def synthetic_transcripts(sentences: list[str], n: int = 200, seed: int = 7) -> list[tuple[str, set[int]]]:
    """Transcripts of known segmentation: clean sentences under labels of every style, with
    timestamps, dropped stops and sentences that merely mention a speaker."""
    rng = random.Random(seed)
    styles = ["<Speaker{}>: ", "<speaker {}>： ", "**Speaker {}:** ", "[speaker{}] ", "SPEAKER_0{}: ", "<Speaker{}> ", "spk_{}> ", "Speaker {}: ", "S{}: ", "说话人{}："]
    mentions = ["they asked Speaker {}: why", "as in S{}: above", "the note says Speaker {}: unknown voice"]
    decoys = ["Part {}: ", "[{}] ", "see note {}) ", "Chapter {}: ", "({}) ", "Q{}: ", "room {}: ", "{}) ", "第{}: ", "v{}: ", "<{}> ", "**Day {}:** "]
    out = []
    for _ in range(n):
        main, text, truth, clock = rng.choice(styles), "", set(), 0.0
        stamped, joint = rng.random() < 0.4, rng.choice(["\n", " ", ", ", "\n\n", "  "])
        for k in range(rng.randint(2, 8)):
            if k:
                text += joint
            truth.add(len(text))
            if stamped and rng.random() < 0.8:
                clock += rng.choice([-3, 2, 4, 9])
                text += f"[{abs(clock):.1f}s] "
            text += (main if rng.random() < 0.7 else rng.choice(styles)).format(rng.randint(0, 3))
            body = rng.choice(["", "", "(ah), ", "hmm, ", "<noise>, ", "err, "]) + " ".join(rng.choice(sentences) for _ in range(rng.randint(1, 3)))
            draw = rng.random()
            if draw < 0.15:
                body = body.rstrip(".!?。！？")
            elif draw < 0.35:
                body = rng.choice(["(hm)", "[music]", "um...", "", "yeah yeah yeah yeah yeah", body[: rng.randint(1, 30)], body.lower()])
            elif draw < 0.45:
                body += " " + rng.choice(mentions).format(rng.randint(0, 3)) + "."
            elif draw < 0.65:
                place, told = rng.random(), rng.choice(decoys).format(rng.randint(0, 40))
                body = told + body if place < 0.25 else f"{body}\n{told}{rng.choice(sentences)}" if place < 0.5 else f"{body} {told}{rng.choice(sentences)}"
            text += body
        out.append((text, truth))
    return out


def fit(sentences: list[str], rounds: int = 120, rate: float = 0.5, ridge: float = 0.0005) -> np.ndarray:
    """Weights by gradient ascent on the conditional likelihood of synthetic transcripts."""
    weights, step = np.zeros(len(FEATURES)), np.full(len(FEATURES), 1e-6)
    data = [_prepare(text, truth) for text, truth in synthetic_transcripts(sentences)]
    for _ in range(rounds):
        grad = sum(_gradient(*d, weights) for d in data) / len(data) - ridge * weights
        step += grad**2
        weights = weights + rate * grad / np.sqrt(step)
    return weights


#: Weights fitted by this driver, by the sentences they were fitted to.
_FITTED: dict[tuple[str, ...], np.ndarray] = {}


def clean_turns(text: str | None, weights: np.ndarray) -> list[dict]:
    """The clean turns of one text in order, neighbours of one speaker joined.

    Turns stand by timestamp; one without stays behind the turn it follows.
    Speakers are numbered from 1 by their first clean turn.
    """
    if not text:
        return []
    cands = candidates(text)
    if not cands:
        return []
    starts = decode(text, cands, weights)
    # The first candidate has none before it that could hold it: it starts a turn only if its own score says so.
    if float(cands[starts[0]].x @ weights) < float(_passed(cands[starts[0]]) @ weights):
        starts = starts[1:]
    blocks: list[tuple[float, list[dict]]] = []
    for k, i in enumerate(starts):
        end = cands[starts[k + 1]].head if k + 1 < len(starts) else len(text)
        body = text[cands[i].body : end]
        turn = {"number": cands[i].number, "start_s": cands[i].seconds, "body": body}
        if cands[i].seconds is not None or not blocks:
            blocks.append((cands[i].seconds if cands[i].seconds is not None else -math.inf, [turn]))
        else:
            blocks[-1][1].append(turn)
    blocks.sort(key=lambda b: b[0])
    merged: list[dict] = []
    numbers: dict[str, int] = {}
    for _, turns in blocks:
        for t in turns:
            blank = speech.blanked(t["body"])
            if not speech.clean_words(t["body"], blank):
                continue
            words = speech.clean_text(t["body"], blank)
            if merged and merged[-1]["number"] == t["number"]:
                merged[-1]["words"] += " " + words
                continue
            numbers.setdefault(t["number"], len(numbers) + 1)
            merged.append({"number": t["number"], "start_s": t["start_s"], "words": words})
    return [{"turn_no": k + 1, "speaker_no": numbers[t["number"]], "start_s": t["start_s"], "words": t["words"]} for k, t in enumerate(merged)]


def speaker_turns(df: DataFrame, samples: DataFrame, id_col: str = "row_id", text_col: str = "text", max_samples: int = 5000) -> DataFrame:
    """One row per clean turn: ``rec_key``, ``turn_no``, ``speaker_no``, ``start_s``, ``words``.

    ``samples`` (``text``) holds clean sentences for the fit, of which at most
    ``max_samples``, chosen by hash, are used.  Other columns of ``df`` are not carried.
    """
    chosen = samples.select("text").where("text is not null").orderBy(F.xxhash64("text"), "text").limit(max_samples)
    sentences = sorted(r.text for r in chosen.collect())
    key = tuple(sentences or ["A sentence stands here."])
    if key not in _FITTED:
        _FITTED.clear()
        _FITTED[key] = fit(list(key))
    weights = _FITTED[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (key, t["turn_no"], t["speaker_no"], t["start_s"], t["words"])
                for key, text in zip(pdf["rec_key"], pdf["text"])
                for t in clean_turns(text, weights)
            ]
            yield pd.DataFrame(rows, columns=["rec_key", "turn_no", "speaker_no", "start_s", "words"])

    # A text without a digit has no label: such rows need not cross to Python.
    src = df.select(F.col(id_col).cast("string").alias("rec_key"), F.col(text_col).alias("text"))
    src = src.where(F.col("text").rlike(r"\p{Nd}"))
    return spread(src, "rec_key").mapInPandas(run, "rec_key string, turn_no long, speaker_no long, start_s double, words string")


def diarized_turns(df: DataFrame, id_col: str = "file_name", array_col: str = "speakers") -> DataFrame:
    """Turns of arrays of ``(start_time, end_time, speaker)``, in the JVM alone.

    Elements that are null or have a null or blank speaker are dropped; the rest
    stand by start (equal starts by place, null and NaN starts last), neighbours
    of one speaker joined.  A label's number tells speakers apart; a label
    without one counts by its spelling, without case and outer blanks.  Empty
    and null arrays give no rows.
    """
    label = lambda x: F.lower(F.regexp_replace(x["speaker"], r"(?U)^\s+|(?<!\s)\s+$", ""))
    number = lambda x: F.regexp_extract(x["speaker"], r"(\d+)", 1)
    kept = F.filter(
        F.transform(
            F.col(array_col),
            lambda x, i: F.struct(
                F.coalesce(x["start_time"], F.lit(float("nan"))).alias("s"),
                i.alias("i"),
                F.when(number(x) != "", F.regexp_replace(number(x), r"^0+(?=\d)", "")).otherwise(F.nullif(label(x), F.lit(""))).alias("k"),
            ),
        ),
        lambda x: x["k"].isNotNull(),
    )
    keyed = df.select(F.col(id_col).cast("string").alias("rec_key"), F.array_sort(kept).alias("t"))
    joined = keyed.select(
        "rec_key",
        F.filter("t", lambda x, i: (i == 0) | (x["k"] != F.get(F.col("t"), i - 1)["k"])).alias("t"),
    )
    named = joined.select("rec_key", "t", F.array_distinct(F.transform("t", lambda x: x["k"])).alias("ks"))
    return named.select("rec_key", "ks", F.posexplode("t").alias("p", "x")).select(
        "rec_key",
        (F.col("p") + 1).cast("long").alias("turn_no"),
        F.array_position("ks", F.col("x.k")).cast("long").alias("speaker_no"),
        F.col("x.s").alias("start_s"),
    )
