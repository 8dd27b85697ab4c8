"""Simulated sessions of several speakers, built from single-speaker samples.

One session is one seeded unit of work: its id decides its speakers, turns,
pauses and overlaps, so sessions can be made anywhere and again.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.spans import rttm_line
from voxloom.operators import joins
from voxloom.operators.audio import half_window
from voxloom.session import stage


@dataclass(frozen=True)
class SessionConfig:
    """Settings of a simulation; wrong ones are refused when it is made."""

    sessions: int = 10
    speakers: int = 2
    seconds: float = 60.0
    turn_probability: float = 0.875
    sentence_k: float = 0.4
    sentence_p: float = 0.05
    mean_silence: float = 0.15
    mean_overlap: float = 0.10
    dominance_std: float = 0.11
    min_dominance: float = 0.05
    min_volume: float = 1.0
    max_volume: float = 1.0
    seed: int = 42

    def __post_init__(self):
        if self.sessions < 0 or self.speakers < 1 or self.seconds <= 0:
            raise ValueError("sessions, speakers and seconds must be positive")
        for name in ("turn_probability", "mean_silence", "mean_overlap", "sentence_p"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie between 0 and 1")
        if self.mean_silence + self.mean_overlap >= 1:
            raise ValueError("silence and overlap must leave room for speech")
        if not 0 < self.min_dominance * self.speakers <= 1:
            raise ValueError("min_dominance must leave room for every speaker")
        if self.min_volume > self.max_volume:
            raise ValueError("min_volume must not exceed max_volume")


def speaker_permutations(speakers: list[str], per_session: int, sessions: int, seed: int) -> list[list[str]]:
    """Speakers of each session: shuffled decks, so that all are used as evenly as can be."""
    rng, out, deck = np.random.default_rng(seed), [], []
    if per_session > len(speakers):
        raise ValueError("more speakers a session than there are")
    for _ in range(sessions):
        chosen: list[str] = []
        while len(chosen) < per_session:
            if not deck:
                deck = list(rng.permutation(speakers))
            fresh = next((s for s in deck if s not in chosen), None)
            if fresh is None:
                deck = list(rng.permutation(speakers))
                continue
            deck.remove(fresh)
            chosen.append(fresh)
        out.append(chosen)
    return out


def dominance(config: SessionConfig, rng: np.random.Generator) -> np.ndarray:
    """Cumulative share of turns of each speaker, none below the least."""
    share = np.clip(rng.normal(1 / config.speakers, config.dominance_std, config.speakers), 0, None)
    share = share / share.sum() if share.sum() else np.full(config.speakers, 1 / config.speakers)
    room = 1 - config.min_dominance * config.speakers
    return np.cumsum(config.min_dominance + room * share)


def raise_missing(cumulative: np.ndarray, seen: set[int], factor: float = 2.0) -> np.ndarray:
    """Larger shares for speakers who have not spoken yet."""
    share = np.diff(cumulative, prepend=0)
    share[[k for k in range(len(share)) if k not in seen]] *= factor
    return np.cumsum(share / share.sum())


def next_speaker(previous: int | None, cumulative: np.ndarray, config: SessionConfig, rng: np.random.Generator) -> int:
    """The next speaker: a change with the turn probability, the new one by dominance."""
    n = len(cumulative)
    if n == 1 or previous is not None and rng.random() > config.turn_probability:
        return previous or 0
    while True:
        k = min(int(np.searchsorted(cumulative, rng.random() * cumulative[-1])), n - 1)
        if k != previous:
            return k


def build_session(session: int, speakers: list[tuple[str, list[tuple[list[str], list[float]]]]], config: SessionConfig, draw: Callable[[int], tuple[list[str], list[float]]] | None = None) -> list[tuple]:
    """Sentences of one session as (session, turn, speaker, start, end, volume, words, word ends).

    ``speakers`` holds for each one its samples of words and their end times;
    ``draw`` gives a speaker's next sample, if not any of those at random.  A
    sentence's length is a negative binomial draw plus one; words are taken from
    samples at their alignments.  A pause or an overlap goes before each
    sentence, whichever brings the session nearer its means; nobody overlaps
    themselves.
    """
    rng = np.random.default_rng([config.seed, session])
    config_n = SessionConfig(**{**config.__dict__, "speakers": len(speakers)})
    cumulative = dominance(config_n, rng)
    volume = rng.uniform(config.min_volume, config.max_volume, len(speakers))
    rows, now, last_end = [], 0.0, [0.0] * len(speakers)
    previous, silence, overlap, seen = None, 0.0, 0.0, set()
    while now < config.seconds and len(rows) < 100_000:
        if now > config.seconds / 2 and len(seen) < len(speakers):
            cumulative = raise_missing(cumulative, seen)
        who = next_speaker(previous, cumulative, config_n, rng)
        words, ends, offset = [], [], 0.0
        wanted = int(rng.negative_binomial(config.sentence_k, config.sentence_p)) + 1
        samples = speakers[who][1]
        while len(words) < wanted and samples:
            w, a = draw(who) if draw else samples[int(rng.integers(len(samples)))]
            at = 0.0
            for word, end in zip(w, a):
                if word and len(words) < wanted:
                    words.append(word)
                    ends.append(offset + (end - at))
                    offset = ends[-1]
                at = end
            if not any(w):
                break
        length = ends[-1] if ends else 0.0
        if length <= 0:
            break
        start = now
        if rows:
            if silence <= config.mean_silence * max(now, 1e-9) or who == previous:
                pause = float(rng.exponential(config.mean_silence * length + 1e-3))
                start, silence = now + pause, silence + pause
            elif overlap < config.mean_overlap * now:
                back = min(float(rng.exponential(config.mean_overlap * length + 1e-3)), length, now)
                start = max(now - back, last_end[who])
                overlap += now - start
        start = max(start, last_end[who])
        end = min(start + length, config.seconds)
        if end <= start:
            break
        kept = [(w, round(start + e, 3)) for w, e in zip(words, ends) if start + e <= end + 1e-9]
        rows.append((session, len(rows), speakers[who][0], round(start, 3), round(end, 3), float(volume[who]), [w for w, _ in kept], [e for _, e in kept]))
        last_end[who], previous, now = end, who, max(now, end)
        seen.add(who)
    return rows


SESSION_SCHEMA = "session long, turn long, speaker string, start_time double, end_time double, volume double, words array<string>, word_ends array<double>"


class OutOfDraws(Exception):
    """A session wants more samples of a speaker than were drawn for it."""


def _handed_out(drawn: list[list[tuple[list[str], list[float]]]]):
    """The drawn samples of each speaker in turn."""
    left = [iter(d) for d in drawn]

    def draw(who: int) -> tuple[list[str], list[float]]:
        for sample in left[who]:
            return sample
        raise OutOfDraws

    return draw


def simulate_sessions(spark: SparkSession, manifest: DataFrame, config: SessionConfig, speaker: str = "speaker_id", draws: int | None = None) -> DataFrame:
    """Sentences of all sessions, drawn from all samples of all speakers.

    The samples stand numbered speaker by speaker.  The n-th draw of a session
    from a speaker is a hash of both and n, so numbers are drawn first and only
    the samples they name are joined and reach a worker.  ``draws`` are made for
    each speaker of a session at first; sessions that want more are built again
    with four times as many, with the same result as if all had been made at
    once.  The driver holds one number per speaker and the decks of the sessions.
    """
    # Staged before it is filtered and ranged, so that computed words are computed once.
    rows = stage(manifest.select(F.col(speaker).cast("string").alias("speaker"), "words", "alignments"), "manifest").where(F.col("speaker").isNotNull() & (F.size("words") > 0))
    samples = stage(joins.numbered(rows, [F.col("speaker"), F.col("words"), F.col("alignments")], "sample"), "samples")
    speakers = stage(joins.numbered(samples.groupBy("speaker").agg(F.min("sample").alias("first"), F.count("*").alias("n")), [F.col("speaker")], "who"), "speakers")
    count = speakers.count()
    if not count:
        return spark.createDataFrame([], SESSION_SCHEMA)
    decks = speaker_permutations(range(count), min(config.speakers, count), config.sessions, config.seed)
    slots = spark.createDataFrame([(k, slot, int(who)) for k, deck in enumerate(decks) for slot, who in enumerate(deck)], "session long, slot int, who long")
    pending = slots.join(speakers, "who").select("session", "slot", "speaker", "first", "n")
    names = [f.split()[0] for f in SESSION_SCHEMA.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        session = int(pdf["session"].iloc[0])
        pdf = pdf.sort_values(["slot", "draw"])
        mine = [(who, list(zip(g["words"], g["alignments"]))) for (_, who), g in pdf.groupby(["slot", "speaker"], sort=True)]
        try:
            made = build_session(session, mine, config, _handed_out([d for _, d in mine]))
        except OutOfDraws:
            made = [(session, *[None] * (len(names) - 1))]
        return pd.DataFrame(made, columns=names)

    draws, done = draws or 8 + int(config.seconds / 4), []
    while True:
        number = F.pmod(F.xxhash64(F.lit(config.seed), "session", "slot", "draw"), F.col("n"))
        drawn = pending.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).select("session", "slot", "draw", (F.col("first") + number).alias("sample"))
        built = stage(drawn.join(samples, "sample").groupBy("session").applyInPandas(run, SESSION_SCHEMA), "sessions")
        done.append(built.where("turn is not null"))
        short = built.where("turn is null").select("session")
        if short.isEmpty():
            return reduce(DataFrame.unionByName, done)
        pending, draws = pending.join(short, "session", "left_semi"), draws * 4


def session_waveforms(sessions: DataFrame, clips: DataFrame, config: SessionConfig, rate: int = 16_000, fade: float = 0.01, window: str = "hamming") -> DataFrame:
    """``session, wav``: the sound of each session, as long as the session's settings say.

    ``clips`` has one waveform (``wav``) of each ``speaker``, from which each
    sentence takes its own part, round and round; a sentence's ends are faded by
    half windows, its volume set, and overlaps added up.  A session's rows are
    bounded by its length.  A speaker without a clip is silent.
    """
    size = int(config.seconds * rate)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out, used = np.zeros(size), {}
        for r in pdf.sort_values("turn").itertuples():
            a, b = int(r.start_time * rate), min(size, int(r.end_time * rate))
            if b <= a or r.wav is None or not len(r.wav):
                continue
            clip, at = np.asarray(r.wav, dtype=np.float64), used.get(r.speaker, 0)
            part = np.take(clip, np.arange(at, at + b - a), mode="wrap") * r.volume
            used[r.speaker] = (at + b - a) % len(clip)
            n = min(int(fade * rate), (b - a) // 2)
            if n:
                part[:n] *= half_window(n, window)
                part[-n:] *= half_window(n, window, start=False)
            out[a:b] += part
        return pd.DataFrame({"session": [int(pdf["session"].iloc[0])], "wav": [out.astype(np.float32)]})

    named = clips.select("speaker", "wav").dropDuplicates(["speaker"])
    rows = sessions.select("session", "turn", "speaker", "start_time", "end_time", "volume").join(named, "speaker", "left")
    return rows.groupBy("session").applyInPandas(run, "session long, wav array<float>")


def with_noise(sessions: DataFrame, noise: DataFrame, snr_db: float, samples: str = "wav") -> DataFrame:
    """Sessions with background noise at a ratio of powers; ``noise`` has waveforms numbered from 0 in ``noise_no``, of which each session takes one by its number."""
    n = noise.count()
    if not n:
        return sessions
    picked = noise.select("noise_no", F.col(samples).alias("_noise"))
    joined = sessions.withColumn("noise_no", F.pmod(F.col("session"), F.lit(n))).join(picked, "noise_no", "left")
    return joined.withColumn(samples, at_snr(F.col(samples), F.col("_noise"), snr_db)).drop("_noise", "noise_no")


def session_rttm(sessions: DataFrame) -> DataFrame:
    """One RTTM line for each sentence, with the session's name and the sentence's number."""
    name = F.format_string("session_%d", "session")
    return sessions.select("session", "turn", rttm_line(name, F.col("start_time"), F.col("end_time"), F.col("speaker")).alias("value"))


def session_json(sessions: DataFrame) -> DataFrame:
    """One JSON object for each sentence: file, offset, duration, speaker and words."""
    entry = F.struct(
        F.format_string("session_%d.wav", "session").alias("audio_filepath"), F.col("start_time").alias("offset"),
        F.round(F.col("end_time") - F.col("start_time"), 3).alias("duration"), F.col("speaker").alias("label"), F.array_join("words", " ").alias("text"),
    )
    return sessions.select("session", "turn", F.to_json(entry).alias("value"))


def annotations(sessions: DataFrame, config: SessionConfig, folder: str) -> list[str]:
    """Write RTTM, JSON and CTM lines, the lists of files and ``params.yaml`` under a folder; gives the paths."""
    kinds = {"rttm": session_rttm(sessions), "json": session_json(sessions), "ctm": ctm_lines(sessions)}
    at = folder.rstrip("/")
    for kind, lines in kinds.items():
        lines.orderBy("session", "turn", *(["p"] if kind == "ctm" else [])).select("value").write.mode("overwrite").text(f"{at}/{kind}")
    names = sessions.select("session").distinct().orderBy("session")
    for kind in ("wav", *kinds):
        names.select(F.concat(F.lit(f"{at}/{kind}/"), F.format_string(f"session_%d.{kind}", "session")).alias("value")).write.mode("overwrite").text(f"{at}/{kind}_list")
    params = "".join(f"{k}: {v}\n" for k, v in sorted(config.__dict__.items())).rstrip("\n")
    sessions.sparkSession.createDataFrame([(params,)], "value string").coalesce(1).write.mode("overwrite").text(f"{at}/params.yaml")
    return [*(f"{at}/{k}" for k in kinds), *(f"{at}/{k}_list" for k in ("wav", *kinds)), f"{at}/params.yaml"]


def room_response(size: tuple[float, float, float], source: tuple[float, float, float], microphone: tuple[float, float, float], rate: int = 16_000, absorption: float = 0.4, order: int = 3, speed: float = 343.0) -> np.ndarray:
    """Impulse response of a box-shaped room by mirror images of the source up to an order of reflections.

    Every image adds an impulse at its distance over the speed of sound, weaker
    by the distance and by the walls it was mirrored in.
    """
    reflect, reach = np.sqrt(1.0 - absorption), range(-order, order + 1)
    hits: list[tuple[int, float]] = []
    for counts in itertools.product(reach, repeat=3):
        walls = sum(abs(k) for k in counts)
        if walls > order:
            continue
        image = [k * x + (s if k % 2 == 0 else x - s) for k, x, s in zip(counts, size, source)]
        distance = max(0.1, float(np.linalg.norm(np.subtract(image, microphone))))
        hits.append((round(distance / speed * rate), reflect**walls / (4 * np.pi * distance)))
    out = np.zeros(max(k for k, _ in hits) + 1)
    for k, gain in hits:
        out[k] += gain
    return out


def ctm_lines(sessions: DataFrame) -> DataFrame:
    """One CTM line for each word: session, channel, start, length, word."""
    word = sessions.select("session", "turn", "start_time", F.posexplode(F.arrays_zip("words", "word_ends")).alias("p", "w"), "word_ends")
    begin = F.coalesce(F.get("word_ends", F.col("p") - 1), F.col("start_time"))
    return word.select("session", "turn", "p", F.format_string("session_%d 1 %.3f %.3f %s 0", "session", begin, F.greatest(F.col("w.word_ends") - begin, F.lit(0.0)), "w.words").alias("value"))


def at_snr(signal: Column, noise: Column, snr_db: float) -> Column:
    """Signal plus noise, repeated as needed, at a ratio of powers in decibels."""

    @F.pandas_udf("array<float>")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(x, y):
            if a is None:
                out.append(None)
                continue
            a = np.asarray(a, dtype=np.float64)
            b = np.resize(np.asarray(b if b is not None and len(b) else [0.0], dtype=np.float64), len(a))
            power = float((b**2).mean()) if len(b) else 0.0
            gain = np.sqrt((a**2).mean() / (power * 10 ** (snr_db / 10))) if power > 0 and len(a) else 0.0
            out.append((a + gain * b).astype(np.float32))
        return pd.Series(out)

    return run(signal, noise)


def convolved(signal: Column, response: Column) -> Column:
    """A waveform convolved with an impulse response, as long as the waveform."""

    @F.pandas_udf("array<float>")
    def run(x: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([None if a is None or b is None else np.convolve(np.asarray(a, float), np.asarray(b, float))[: len(a)].astype(np.float32) for a, b in zip(x, h)])

    return run(signal, response)
