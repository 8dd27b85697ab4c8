"""Problem 5: per-document text quality statistics.

Method: robust Mahalanobis distance.  Every text gets a vector of statistics;
for each language the mean and covariance of prose are found from all rows by
concentration steps that start at the medians and leave out the rows that lie
far off.  Covariances are drawn towards the one that all languages share, as if
it had been seen in ``PRIOR_ROWS`` rows, so a language of any number of rows is
measured in the same way.  A row from distance ``DISTANCE`` on is no usual prose,
and the contributions of its statistics, which add up to the distance, name it:
``table`` or ``list`` where the share of columns or of items alone carries it
that far, else ``junk`` where words, letters, symbols and language weigh more
than stops, else ``odd``.  Lengths of phrases and commas are part of the
distance, but speak for no kind.  A kind that the form of the text denies (``kinds.py``, an exact check)
is ``odd`` as well: prose of an unusual build.

Null, empty and blank texts get statistics of zeros and no kind.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm import kinds, speech
from voxloom.llm.lm import PieceModel
from voxloom.session import spread, stage

STATS = [
    "mean_word_length", "symbol_ratio", "digit_ratio", "stop_line_share", "common_word_share", "stops_per_word",
    "commas_per_word", "letters_share", "log_probability", "phrase_length", "column_share", "item_share",
]
#: The kind that a statistic speaks for.
SPEAKS_FOR = {
    "column_share": "table", "item_share": "list", "stop_line_share": "odd", "stops_per_word": "odd",
    "symbol_ratio": "junk", "digit_ratio": "junk", "letters_share": "junk", "log_probability": "junk", "mean_word_length": "junk", "common_word_share": "junk",
}
#: Squared distance from which on a row is no prose.
DISTANCE = 20.0
#: Rows that the covariance shared by all languages counts for, and the rounds of concentration.
PRIOR_ROWS, STEPS = 20.0, 3

_HAN = re.compile(r"[一-鿿]")
_SYMBOL = re.compile(r"[^\w\s஀-௿.,!?;:'\"，。！？、…()\[\]<>\-]|_")
_CLOSED_LINE = re.compile(r"[.!?。！？…][\"”’')\]\s,，]*$")
_STOPS = re.compile(r"[.!?…]+(?=\s|$)|[。！？]")
_COMMAS = re.compile(r"[,，、;|\t•]")
_PHRASE = re.compile(r"[.!?。！？…,，、;|\t•\r\n]+")
_LINE = re.compile(r"[\r\n]+")


def statistics(text: str, model: PieceModel, common: dict[str, frozenset[str]]) -> tuple[str | None, int, list[float]]:
    """Language, number of words and the statistics of one text, marks of speech left out."""
    body = speech.strip_marks(text)
    words = speech.words_of(body)
    lower = [w.lower() for w in words]
    spoken = [w for w in lower if not w.isdigit()]
    scores, chars = model.scored(spoken)
    lang = model.langs[int(scores.argmax())] if chars else None
    han = _HAN.findall(body)
    apart = [w for w in lower if not _HAN.match(w)] if han else lower
    n = len(han) + len(apart)
    dense = "".join(body.split()) or " "
    lines = [x for x in _LINE.split(body) if x.strip()]
    letters = sum(map(len, spoken))
    known = common.get(lang, frozenset())
    shared = sum(c in known for c in han) + sum(w in known for w in apart)
    columns, items = kinds.structure(text, model)
    vector = [
        letters / max(1, len(spoken)) if not han else len(dense) / max(1, n),
        len(_SYMBOL.findall(dense)) / len(dense),
        len(re.findall(r"\d", dense)) / len(dense),
        sum(bool(_CLOSED_LINE.search(x)) for x in lines) / max(1, len(lines)),
        shared / max(1, n),
        min(1.0, len(_STOPS.findall(body)) / max(1, n)),
        min(1.0, len(_COMMAS.findall(body)) / max(1, n)),
        letters / len(dense),
        max(-16.0, float(scores.max() / chars)) if chars else -16.0,
        math.log(max(1, n) / max(1, sum(bool(re.search(r"\w", x)) for x in _PHRASE.split(body)))),
        columns,
        items,
    ]
    return lang, n, vector


def text_statistics(df: DataFrame, model: PieceModel, common_words: DataFrame, id_col: str = "row_id", text_col: str = "text") -> DataFrame:
    """``id, lang, n_words, blank, form`` and one column for each statistic.

    ``common_words`` (``lang``, ``word``) is a list of common words of the
    model's languages, all of which each worker holds.  ``form`` is what the
    text would be by its form alone.
    """
    common: dict[str, set[str]] = {}
    for r in common_words.where(F.col("lang").isin(*model.langs) & F.col("word").isNotNull()).select("lang", F.lower("word").alias("word")).distinct().collect():
        common.setdefault(r.lang, set()).add(r.word)
    held = df.sparkSession.sparkContext.broadcast({k: frozenset(v) for k, v in common.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            model.warm(w for t in pdf["text"] if t is not None for x in (speech.strip_marks(t), t) for w in speech.words_of(x.lower()))
            out = []
            for key, text in zip(pdf["id"], pdf["text"]):
                blank = text is None or not text.strip()
                lang, n, v = (None, 0, [0.0] * len(STATS)) if blank else statistics(text, model, held.value)
                out.append((key, lang, n, blank, kinds.text_kind(text, model), *v))
            yield pd.DataFrame(out, columns=["id", "lang", "n_words", "blank", "form", *STATS])

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = "id long, lang string, n_words long, blank boolean, form string, " + ", ".join(f"{s} double" for s in STATS)
    return spread(src, "id").mapInPandas(run, schema)


#: Least variance of each statistic, in its own unit.
FLOOR = np.array([0.5, 0.02, 0.03, 0.25, 0.06, 0.02, 0.06, 0.04, 0.8, 0.15, 0.05, 0.05]) ** 2

Model = dict[str | None, tuple[np.ndarray, np.ndarray]]


def _parts(pdf: pd.DataFrame, model: Model) -> np.ndarray:
    """The contributions of each row's statistics to its squared distance."""
    x = pdf[STATS].to_numpy(dtype=float)
    parts = np.zeros_like(x)
    langs = pdf["lang"].to_numpy(dtype=object)
    for lang in set(langs):
        at = np.array([y == lang for y in langs])
        mean, inverse = model.get(lang, model[None])
        d = x[at] - mean
        parts[at] = d * (d @ inverse)
    return parts


def _near_moments(read: DataFrame, model: Model, centres: dict[str | None, np.ndarray]) -> dict[str | None, tuple[float, np.ndarray, np.ndarray]]:
    """Rows, sum and products about the language's centre of the rows within ``DISTANCE``, by language.

    Added up in each task, then over tasks in Spark: one number for each entry
    of a language's sums reaches the driver.
    """
    k = len(STATS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str | None, np.ndarray] = {}
        for pdf in batches:
            near = pdf[_parts(pdf, model).sum(axis=1) < DISTANCE]
            for lang, g in near.groupby("lang", dropna=False):
                lang = None if pd.isna(lang) else lang
                d = g[STATS].to_numpy(dtype=float) - centres.get(lang, centres[None])
                sums[lang] = sums.get(lang, 0.0) + np.concatenate([[len(g)], d.sum(axis=0), (d.T @ d).ravel()])
        rows = [(lang, i, v) for lang, row in sums.items() for i, v in enumerate(row)]
        yield pd.DataFrame(rows, columns=["lang", "i", "v"])

    added = read.select("lang", *STATS).mapInPandas(run, "lang string, i int, v double").groupBy("lang", "i").agg(F.sum("v").alias("v")).collect()
    out: dict[str | None, np.ndarray] = {}
    for r in added:
        out.setdefault(r.lang, np.zeros(1 + k + k * k))[r.i] = r.v
    return {lang: (row[0], row[1 : k + 1], row[k + 1 :].reshape(k, k)) for lang, row in out.items()}


def prose_model(stats: DataFrame, steps: int = STEPS) -> Model:
    """Mean and inverse covariance of prose by language, by concentration steps over all rows; None stands for any other."""
    read = stats.where("not blank")
    rows = read.groupBy("lang").agg(
        F.count("*").alias("n"),
        *[F.percentile_approx(s, F.lit([0.25, 0.5, 0.75]), 1000).alias(s) for s in STATS],
    ).collect()
    model: Model = {}
    centres: dict[str | None, np.ndarray] = {}
    for r in rows:
        q = np.array([r[s] for s in STATS])
        spread_ = np.maximum((q[:, 2] - q[:, 0]) / 1.349, np.sqrt(FLOOR))
        model[r.lang], centres[r.lang] = (q[:, 1], np.diag(1.0 / spread_**2)), q[:, 1]
    # A text without a language is measured like the language of most rows.
    most = max((r for r in rows if r.lang is not None), key=lambda r: (r.n, r.lang), default=None)
    model[None] = model[most.lang] if most else (np.zeros(len(STATS)), np.diag(1.0 / FLOOR))
    centres[None] = model[None][0]
    for _ in range(steps if most else 0):
        sums = {x: v for x, v in _near_moments(read, model, centres).items() if x is not None}
        if not sums:
            break
        scatter = {x: (p - np.outer(s, s) / n) for x, (n, s, p) in sums.items()}
        shared = sum(scatter.values()) / sum(n for n, _, _ in sums.values())
        for lang, (n, s, _) in sums.items():
            cov = (scatter[lang] + PRIOR_ROWS * shared) / (n + PRIOR_ROWS)
            model[lang] = (centres[lang] + s / n, np.linalg.inv(cov + np.diag(FLOOR)))
        model[None] = (model[most.lang][0], np.linalg.inv(shared + np.diag(FLOOR)))
    return model


def distances(stats: DataFrame, model: Model) -> DataFrame:
    """The rows with ``distance`` (squared), ``contributions``, which add up to it, and the kind that these name."""
    fields = stats.schema.fields
    groups = ["table", "list", "junk", "odd"]
    voice = np.array([[SPEAKS_FOR.get(s) == g for g in groups] for s in STATS], dtype=float)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = _parts(pdf, model)
            total = parts.sum(axis=1)
            weight = parts @ voice
            named = ["table" if t >= DISTANCE else "list" if i >= DISTANCE else "junk" if j > o else "odd" for t, i, j, o in weight]
            kind = [g if d >= DISTANCE and not b else None for g, d, b in zip(named, total, pdf["blank"])]
            yield pdf.assign(distance=total, contributions=list(parts), named=kind)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", distance double, contributions array<double>, named string"
    return stats.mapInPandas(run, schema)


def text_quality(df: DataFrame, model: PieceModel, common_words: DataFrame, id_col: str = "row_id", text_col: str = "text") -> DataFrame:
    """Statistics, distance, contributions, ``named``, ``outlier`` and ``kind`` of every row.

    ``named`` is what the contributions say of a row beyond the distance.
    ``kind`` is it where the form of the text agrees (the exact check), and
    ``outlier`` has ``odd`` for the other rows beyond the distance: list, table,
    junk and odd account for all of them.
    """
    stats = stage(text_statistics(df, model, common_words, id_col, text_col), "quality")
    kind = F.when(F.col("named") == F.col("form"), F.col("named"))
    return distances(stats, prose_model(stats)).withColumns({"kind": kind, "outlier": F.when(F.col("named").isNotNull(), F.coalesce(kind, F.lit("odd")))})


def counted_words(text, lang):
    """Column: number of words by the language of the set; a null text counts as empty."""
    body = F.coalesce(text, F.lit(""))
    for tag in ("<Speaker1>:", "<Speaker2>:"):
        body = F.replace(body, F.lit(tag), F.lit(""))
    count = lambda p: F.regexp_count(body, F.lit(p))
    return (
        F.when(lang == "zh", count(r"[一-鿿]"))
        .when(lang == "ta", count(r"[஀-௿]+|[a-zA-Z0-9]+"))
        .otherwise(count(r"[a-zA-Z0-9]+"))
        .cast("long")
    )


def stale_features(df: DataFrame, id_col: str = "row_id", tolerance: float = 0.01) -> DataFrame:
    """Ids of rows whose ``word_count``, ``wpm`` or ``speech_ratio`` does not fit the text; all in the JVM.

    A null struct is no case; nor is a null field, or a ratio where the duration
    is null, NaN or not above 0.
    """
    f = lambda name: F.col(f"text_features.{name}")
    d = F.when((f("true_duration") > 0) & ~F.isnan(f("true_duration")), f("true_duration"))
    off = lambda given, true: F.coalesce(F.abs(given - true) > F.lit(tolerance) * true, F.lit(False))

    def wrong(n):
        return F.coalesce(f("word_count") != n, F.lit(False)) | off(f("wpm"), n / d * 60) | off(f("speech_ratio"), F.least(n / 2.3, d) / d)

    # Bound to a variable, the words are counted once for each row.
    counted = counted_words(F.col("text"), F.substring_index("config_key", "_", 1))
    return df.where(F.col("text_features").isNotNull()).where(F.exists(F.array(counted), wrong)).select(F.col(id_col).alias("id"))
