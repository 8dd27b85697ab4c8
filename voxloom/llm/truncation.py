"""Problem 7: text cut off by field limits.

Method: intact values are cut artificially, within words, sentences, labels and
annotations, to create positives; whole values, whole leading sentences and
those without their last stop are negatives.  A hashed logistic regression on
the closing characters and words, the punctuation, the build of the last
sentence and the length against the set's limit is trained on a bounded sample
of them, then scores every record.  The limits of the sets come from the
lengths of all rows.

Null and blank texts, lists, tables and unreadable texts are never cut.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm import speech
from voxloom.llm.kinds import text_kind
from voxloom.llm.lm import PieceModel
from voxloom.session import spread, stage

BITS = 18
WIDTH = 40
#: A spike in the lengths is a limit from so many rows, and from this share of the set's unfinished texts, on.
LIMIT_ROWS, LIMIT_SHARE = 3, 0.12
_STOP_END = re.compile(r"[.!?。！？][\"”’')\]）》」]*\s*[,，]?\s*$")
_ELLIPSIS = re.compile(r"(?:…|\.{3})\s*$")
_ANNOTATION_END = re.compile(r"(?:" + speech.ANNOTATION.pattern + r")[\s,，.]*$", re.I)
_LABEL_END = re.compile(r"(?:" + "|".join(speech.LABEL_STYLES) + r")\s*$", re.I)
_TIME_END = re.compile(r"(?:" + "|".join(speech.TIMESTAMP_STYLES) + r")\s*$")
#: What is left of a label, an annotation or a timestamp that is not closed.
_OPEN = re.compile(
    r"(?:<[^<>\n]{0,14}|\[[^\[\]\n]{0,14}|[(（][^()（）\n]{0,14}|!\(?|\*\*[^*\n]{0,14}|(?<!\*)\*[a-z]{0,9}|\*\*[^*\n]{1,14}\*"
    r"|(?:^|[\s,，])(?:s|sp|spk|spk_|spea|speak|speake|speaker|speaker ?\d*|speaker_\d*|spk_\d*|s\d+|说|说话|说话人|说话人\d*)"
    r"|(?:^|[\s,，])\d{1,2}:\d{0,2}(?::\d{0,2})?(?:[.,]\d{0,2})?)$",
    re.I,
)
_HAN = re.compile(r"[一-鿿]")


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode()) & ((1 << BITS) - 1)


def closing(text: str) -> tuple[str, bool]:
    """The text without an ellipsis at its end, and whether there was one; a filler keeps its own."""
    whole = text.rstrip()
    if not whole.endswith(("…", "...")):
        return whole, False
    return whole.rstrip(".…").rstrip(), True


def features(text: str, at_limit: str) -> list[int]:
    """Hashed features of how a text ends."""
    core, ellipsis = closing(text)
    spans = speech.label_spans(core)
    body = core[spans[-1][1] :] if spans else core
    bare = speech.ANNOTATION.sub(" ", speech.TIMESTAMP.sub(" ", body)).rstrip(" ,，")
    last = re.split(r"[.!?。！？]+(?=\s|$|[一-鿿])|[\r\n]+", bare)
    sentence = last[-1].strip() if last else ""
    finished = bool(_STOP_END.search(core))
    words = speech.words_of(sentence)
    only_filler = bool(speech.words_of(bare)) and not speech.clean_words(bare)
    end = (
        "stop" if finished
        else "annotation" if _ANNOTATION_END.search(core)
        else "label" if _LABEL_END.search(core)
        else "time" if _TIME_END.search(core)
        else "broken" if core.endswith("�")
        else "open" if _OPEN.search(core[-20:])
        else "comma" if core[-1:] in ",，、;；:："
        else "letter"
    )
    f = [f"end={end}", f"limit={at_limit}", f"end={end}|limit={at_limit}", f"ellipsis={ellipsis}|filler={only_filler}", f"ellipsis={ellipsis}|end={end}"]
    if end in ("letter", "annotation", "comma") and not only_filler:
        if _HAN.search(sentence[-3:]):
            s = re.sub(r"\s+", "", sentence)
            tail = [s[-k:] for k in (1, 2, 3, 4, 6)]
            start = s[:2]
        else:
            tail = [" ".join(words[-k:]).lower() for k in (1, 2, 3)] + [sentence[-2:].lower(), sentence[-3:].lower(), sentence[-4:].lower()]
            start = " ".join(words[:2]).lower()
        commas = min(2, len(re.findall(r"[,，]", sentence)))
        f += [f"t{k}={t}" for k, t in enumerate(tail)]
        f += [f"t{k}={t}|{end}" for k, t in enumerate(tail[:3])]
        f += [f"s={start}|c={commas}", f"s={start}|c={commas}|t={tail[0]}", f"s={start}|t={tail[1]}", f"s={start}|t={tail[2]}"]
        f += [f"n={min(len(words), 12)}", f"gap={core[-1:].isspace()}", f"empty={not sentence}|{end}"]
        f += [f"whole={not sentence and bool(bare)}|{end}"]
    return [_hash(x) for x in f[:WIDTH]]


def sentence_ends(text: str) -> list[int]:
    """Places just behind the stop of a sentence."""
    return [m.end() for m in re.finditer(r"[.!?](?=\s|$)|[。！？]", text)]


def artificial(text: str, rng: random.Random, has_limit: bool) -> list[tuple[str, str, int]]:
    """Artificially cut and whole variants of one intact text as (text, place against the limit, cut)."""
    out = [(text, "no", 0)]
    ends = [e for e in sentence_ends(text) if e > 12] or [len(text)]
    for _ in range(3):
        whole = text[: rng.choice(ends)]
        bare = whole.rstrip().rstrip(".!?。！？")
        near = "at" if has_limit and rng.random() < 0.01 else "no"
        draw = rng.random()
        if draw < 0.5:
            out.append((bare, near, 0))
        elif draw < 0.6:
            out.append((bare + rng.choice([" (ah)", " [music]", ", okay", " lah"]), near, 0))
        elif draw < 0.8:
            out.append((whole + rng.choice([" (ah)", " [music]", " *cough*", " （笑声）", "\n<Speaker1>: (hm)"]), near, 0))
        else:
            label = rng.choice(["\n<Speaker1>: ", " [speaker2] ", ", 说话人1：", "\nS2: ", " Speaker 1: "])
            out.append((whole + label + rng.choice(["hmm...", "um...", "呃，", "嗯", "ம்ம்...", "err...", "(oh)", "aa..."]), near, 0))
    marks = [m.span() for p in (speech.LABEL, speech.ANNOTATION, speech.TIMESTAMP) for m in p.finditer(text) if m.end() - m.start() > 2 and m.start() > 5]
    for k in range(4):
        if k == 0 and marks:
            a, b = rng.choice(marks)
            at = rng.randint(a + 1, b - 1)
        else:
            at = rng.randint(max(2, len(text) // 5), max(3, len(text) - 2))
        cut = text[:at]
        if _STOP_END.search(cut) or at >= len(text) - 1 or _whole(text, at):
            continue
        draw = rng.random()
        cut = cut + "…" if draw < 0.1 else cut + "..." if draw < 0.2 else cut + "�" if draw < 0.25 else cut
        out.append((cut, "at" if has_limit and rng.random() < 0.6 else "no", 1))
    return out


def _whole(text: str, at: int) -> bool:
    """Whether the text before a place is whole: nothing but a stop or marks stand between it and a sentence's end."""
    rest = re.match(r"[^.!?。！？\n]*[.!?。！？]?", text[at:]).group()
    before = speech.ANNOTATION.sub("", speech.LABEL.sub("", text[:at])).rstrip(" ,，\n")
    return not speech.words_of(rest) or bool(_STOP_END.search(before)) and not _OPEN.search(text[:at][-20:])


def train(examples: list[tuple[list[int], int]], epochs: int = 8, rate: float = 0.3, ridge: float = 1e-6, seed: int = 5) -> np.ndarray:
    """Weights of the hashed logistic regression; the last slot is the bias."""
    size = (1 << BITS) + 2
    weights, steps = np.zeros(size), np.full(size, 1e-6)
    if not examples:
        return weights
    index = np.full((len(examples), WIDTH + 1), size - 1)  # the very last slot stays 0
    for r, (f, _) in enumerate(examples):
        index[r, : len(f)] = f
        index[r, WIDTH] = size - 2
    y = np.array([c for _, c in examples], dtype=float)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 128):
            rows = order[at : at + 128]
            z = weights[index[rows]].sum(axis=1)
            g = 1 / (1 + np.exp(-z)) - y[rows]
            used, where = np.unique(index[rows], return_inverse=True)
            grad = np.bincount(where.ravel(), weights=np.repeat(g, WIDTH + 1), minlength=len(used)) / len(rows) + ridge * weights[used]
            steps[used] += grad**2
            weights[used] -= rate * grad / np.sqrt(steps[used])
            weights[size - 1] = 0.0
    return weights


def probability(text: str, at_limit: str, weights: np.ndarray) -> float:
    """Probability that a text was cut."""
    z = float(weights[features(text, at_limit)].sum() + weights[-2])
    return 1 / (1 + float(np.exp(-max(-30.0, min(30.0, z)))))


def limit_table(df: DataFrame, set_col: str = "config_key", text_col: str = "text") -> DataFrame:
    """``source, unit, n``: the limit of each set that has one, from the lengths of all rows.

    Counted are texts that do not end in a stop.  A limit in bytes may leave up
    to three bytes of a character away, or put a mark in their place.
    Characters go before bytes where they explain about as many rows.
    """
    text = F.col(text_col)
    unfinished = df.where(text.isNotNull() & F.col(set_col).isNotNull() & (F.length(text) > 0)).where(~text.rlike(r"[.!?。！？)\]）*]\s*$") | text.rlike(r"\.\.\.\s*$"))
    sized = unfinished.select(F.col(set_col).alias("s"), F.explode(F.map_from_arrays(F.array(F.lit("chars"), F.lit("bytes")), F.array(F.length(text), F.octet_length(text)))).alias("unit", "n"))
    counts = sized.groupBy("s", "unit", "n").agg(F.count("*").alias("c"))
    # Each length of bytes also stands for a limit up to three bytes away; the sums are over lengths, not rows.
    near = counts.select("s", "unit", F.explode(F.when(F.col("unit") == "chars", F.array("n")).otherwise(F.sequence(F.col("n"), F.col("n") + 3))).alias("n"), "c")
    summed = near.groupBy("s", "unit", "n").agg(F.sum("c").alias("c"))
    best = summed.groupBy("s", "unit").agg(F.max_by("n", F.struct("c", "n")).alias("n"), F.max("c").alias("c"))
    total = counts.where("unit = 'chars'").groupBy("s").agg(F.sum("c").alias("t"))
    spikes = best.join(total, "s").where((F.col("c") >= LIMIT_ROWS) & (F.col("c") >= LIMIT_SHARE * F.col("t")))
    of = lambda unit: F.max(F.when(F.col("unit") == unit, F.struct("c", "unit", "n")))
    both = spikes.groupBy("s").agg(of("chars").alias("x"), of("bytes").alias("y"))
    picked = F.when(F.col("x").isNull() | (F.col("y.c") > 1.3 * F.col("x.c")), F.col("y")).otherwise(F.col("x"))
    return both.select(F.col("s").alias("source"), picked.alias("p")).select("source", "p.unit", "p.n")


def set_limits(df: DataFrame, set_col: str = "config_key", text_col: str = "text") -> dict[str, tuple[str, int]]:
    """The limits as a dictionary, to look at; the operators join the table."""
    return {r.source: (r.unit, r.n) for r in limit_table(df, set_col, text_col).collect()}


def against_limit(text: str, limit: tuple[str, int] | None) -> str:
    """``at``, ``over`` or ``no``: where the length of a text lies against its set's limit."""
    if limit is None:
        return "no"
    unit, n = limit
    size = len(text) if unit == "chars" else len(text.encode("utf-8", "surrogatepass"))
    slack = 0 if unit == "chars" else 3
    return "at" if n - slack <= size <= n else "over" if size > n else "no"


#: Weights fitted by this driver, by the hash of the examples.
_FITTED: dict[str, np.ndarray] = {}


def fit(rows: DataFrame, max_rows: int = 6000, max_chars: int = 20_000, seed: int = 11) -> np.ndarray:
    """Train on artificial cuts of at most ``max_rows`` intact texts of at most ``max_chars``, chosen by hash of the id.

    ``rows`` has ``id``, ``text`` and ``unit``, which is null where the set has
    no limit.  The cuts are made where the texts lie; their hashed features
    reach the driver.
    """
    intact = rows.where(F.length("text") <= max_chars).where(F.col("text").rlike(r"[.!?。！？]\s*$") & ~F.col("text").rlike(r"\.\.\.\s*$"))
    chosen = intact.select(F.xxhash64("id").alias("h"), "text", F.col("unit").isNotNull().alias("limited")).orderBy("h", "text").limit(max_rows)

    def cuts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for h, t, limited in zip(pdf["h"], pdf["text"], pdf["limited"]):
                if speech.LABEL.search(t) or len(speech.words_of(t)) > 3:
                    rng = random.Random(f"{seed} {h}")
                    out += [(h, features(v, near), cut) for v, near, cut in artificial(t, rng, bool(limited))]
            yield pd.DataFrame(out, columns=["h", "f", "cut"])

    made = spread(chosen, "h", waves=1).mapInPandas(cuts, "h long, f array<int>, cut int").collect()
    examples = sorted((r.h, r.cut, list(r.f)) for r in made)
    key = hashlib.blake2b(repr(examples).encode()).hexdigest()
    if key not in _FITTED:
        _FITTED.clear()
        _FITTED[key] = train([(f, cut) for _, cut, f in examples])
    return _FITTED[key]


def truncated(df: DataFrame, model: PieceModel, id_col: str = "row_id", set_col: str = "config_key", text_col: str = "text", max_rows: int = 6000) -> DataFrame:
    """``id, source, p_cut, cut`` of every row.

    A text that ends in a stop without an ellipsis is whole by definition, as are lists, tables and junk.
    """
    src = df.select(F.col(id_col).alias("id"), F.col(set_col).alias("source"), F.col(text_col).alias("text"))
    # One row per set; staged, so that its size is known when it is joined.
    limits = stage(limit_table(df, set_col, text_col), "limits")
    rows = src.join(limits, "source", "left")
    weights = df.sparkSession.sparkContext.broadcast(fit(rows, max_rows).astype(np.float32))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # Only texts that may be cut are asked for their kind.
            ps = [
                probability(text, against_limit(text, None if unit is None else (unit, int(n))), weights.value) if text is not None and text.strip() else 0.0
                for text, unit, n in zip(pdf["text"], pdf["unit"], pdf["n"])
            ]
            open_ = [p >= 0.5 and not (_STOP_END.search(t) and not _ELLIPSIS.search(t)) for p, t in zip(ps, pdf["text"])]
            model.warm(w for t, o in zip(pdf["text"], open_) if o for w in speech.words_of(t.lower()))
            cuts = [bool(o) and text_kind(t, model) == "prose" for t, o in zip(pdf["text"], open_)]
            yield pdf[["id", "source"]].assign(p_cut=ps, cut=cuts)

    return spread(rows, "id").mapInPandas(run, "id long, source string, p_cut double, cut boolean")


def cut_rates(found: DataFrame) -> DataFrame:
    """Rows, cut rows and their share for each source."""
    return found.groupBy("source").agg(
        F.count("*").alias("n_rows"), F.count_if("cut").alias("n_cut"), F.round(F.count_if("cut") / F.count("*"), 6).alias("cut_share")
    )
