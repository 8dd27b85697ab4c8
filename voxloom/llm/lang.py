"""Problem 4: missing or wrong document language labels.

Method: segmentation-marginalised unigrams (``lm.py``).  Every sentence gets
its posterior over languages; the language of most sentences is the text's main
one (ties: the one with more letters, then the order of the languages).  A turn
all of whose sentences are in one further language is a segment of its own.
A sentence whose best posterior is below ``SURE`` follows its turn, or the main
language where the whole turn is unsure.

Null, blank, list, table and unreadable texts have no language.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.llm import speech
from voxloom.llm.kinds import text_kind
from voxloom.llm.lm import LANGS, PieceModel, UnitCounter, load_pieces, told, train_counts
from voxloom.llm.speech import words_of
from voxloom.session import spread, stage, staging

#: A sentence's language counts from this posterior on.
SURE = 0.9
#: Characters of the texts whose words the fit holds at a time; those of a whole batch would take many times its size.
_PART = 200_000

# Names of the languages as labels spell them, without case, region and outer blanks.
LANGUAGE_NAMES = {
    "en": ["en", "eng", "english"],
    "ms": ["ms", "msa", "may", "zsm", "malay", "bahasa melayu", "bahasa malaysia", "melayu"],
    "zh": ["zh", "zho", "chi", "cmn", "chinese", "mandarin", "中文", "汉语", "华语"],
    "ta": ["ta", "tam", "tamil", "தமிழ்"],
    "es": ["es", "spa", "spanish", "español", "espanol", "castellano"],
}
_CODES = {name: code for code, names in LANGUAGE_NAMES.items() for name in names}
# Labels that name no language.
NO_LANGUAGE = ["", "none", "null", "unknown", "und", "nan", "n/a", "na", "?", "-", "other", "auto", "mul", "zxx"]


def label_code(label):
    """Column: code of the language that a label names; empty where it names none; the label itself where it names another one."""
    plain = F.lower(F.regexp_replace(F.coalesce(label, F.lit("")), r"(?U)^\s+|(?<!\s)\s+$", ""))
    base = F.regexp_replace(plain, r"[-_][a-z0-9]{2,4}$", "")
    table = F.create_map(*[F.lit(x) for pair in _CODES.items() for x in pair])
    known = F.coalesce(F.try_element_at(table, plain), F.try_element_at(table, base))
    return F.when(plain.isin(NO_LANGUAGE), F.lit("")).otherwise(F.coalesce(known, plain))


def bounded(rows: DataFrame, group: str, text: str, most: int) -> DataFrame:
    """At most ``most`` rows of each group, chosen by hash of the text, so that no group or alphabet falls out."""
    order = Window.partitionBy(group).orderBy(F.xxhash64(text), text)
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most).drop("_rank")


#: Models fitted by this driver, by the hash of what they were fitted to.
_FITTED: dict[str, PieceModel] = {}


def _fitted(spark: SparkSession, inputs, make) -> PieceModel:
    """The model that ``make`` gives for these inputs, fitted once for all queries of a driver and sent to each worker once."""
    key = hashlib.blake2b(repr((spark.sparkContext.applicationId, inputs)).encode("utf-8", "replace")).hexdigest()
    if key not in _FITTED:
        if len(_FITTED) > 8:
            _FITTED.clear()
        _FITTED[key] = make()
    return _FITTED[key].share(spark)


def _contents(rows: DataFrame, *columns: str) -> tuple:
    """Number of the rows and sums of their hashes, which tell one table from another in any order of its rows."""
    hashes = [F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)") for seed in (0, 1)]
    return tuple(rows.agg(F.count("*"), *[F.sum(h) for h in hashes]).first())


def fit_model(spark: SparkSession, samples: DataFrame, words: DataFrame | None = None, labelled: DataFrame | None = None) -> PieceModel:
    """Train on all labelled text.

    All sentences (``lang``, ``text``) and common words (``lang``, ``word``) of
    the model's languages give a first model.  All ``labelled`` rows (``id``,
    ``text``, ``language``) whose label agrees with that model then add the
    wordings of real speech; a row counts as often as it stands in the table.
    Words are counted where the rows lie, so nothing but sums for the pieces of
    the vocabulary reaches the driver.
    """
    clean = samples.where(F.col("lang").isin(*LANGS) & F.col("text").isNotNull()).select("lang", "text")
    if words is not None:
        clean = clean.unionByName(words.where(F.col("lang").isin(*LANGS) & F.col("word").isNotNull()).select("lang", F.col("word").alias("text")))
    pieces = load_pieces()
    vocabulary = hashlib.blake2b("\n".join(pieces).encode()).hexdigest()
    given = _contents(clean, "lang", "text")
    counter = UnitCounter(spark, pieces)
    schema = "lang string, unit string, n long"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield counter.counted(zip(pdf["lang"], pdf["text"]))

    read = spread(clean, "lang", "text", waves=1).mapInPandas(count, schema)

    def trained(counts: DataFrame) -> PieceModel:
        with staging(spark):
            return train_counts(stage(counts.groupBy("lang", "unit").agg(F.sum("n").alias("n")), "units"), pieces)

    model = _fitted(spark, (vocabulary, given), lambda: trained(read))
    if labelled is None or not model.langs:
        return model
    usable = labelled.select("id", "text", label_code(F.col("language")).alias("code")).where(F.col("text").isNotNull() & F.col("code").isin(*model.langs))

    def agree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield counter.counted(agreeing_sentences(list(pdf["text"]), list(pdf["code"]), model))

    def refined() -> PieceModel:
        return trained(read.unionByName(spread(usable, "id").mapInPandas(agree, schema)))

    return _fitted(spark, (vocabulary, given, _contents(usable, "code", "text")), refined)


def agreeing_sentences(texts: list[str], codes: list[str], model: PieceModel) -> Iterator[tuple[str, str]]:
    """Sentences of the texts whose label the model bears out, without those it is certain belong elsewhere; scored many at a time."""
    for part in _parts(texts):
        yield from _agreeing(texts[part], codes[part], model)


def _parts(texts: list[str]) -> Iterator[slice]:
    """Neighbouring texts of at most ``_PART`` characters together; a longer one goes alone."""
    start = size = 0
    for k, t in enumerate(texts):
        if k > start and size + len(t) > _PART:
            yield slice(start, k)
            start, size = k, 0
        size += len(t)
    if texts:
        yield slice(start, len(texts))


def _agreeing(texts: list[str], codes: list[str], model: PieceModel) -> Iterator[tuple[str, str]]:
    """``agreeing_sentences`` of one part; scored all together."""
    warm_kinds(texts, model)
    prose = [(t, code) for t, code in zip(texts, codes) if text_kind(t, model) == "prose"]
    read = [sentences_by_turn(t) for t, _ in prose]
    parsed = [[(no, [told(s) for s in own]) for no, own in turns] for turns in read]
    posts = iter(model.posteriors([words for turns in parsed for _, own in turns for words, _ in own]))
    for (text, code), sentences, turns in zip(prose, read, parsed):
        scored = [(no, [(next(posts), n) for _, n in own]) for no, own in turns]
        sure = [(no, [(p, n) for p, n in own if p is not None]) for no, own in scored]
        main, confidence, _ = detect(text, model, [(no, own) for no, own in sure if own])
        if main != code or confidence < 0.7:
            continue
        k = model.langs.index(code)
        for (_, own), (_, found) in zip(sentences, scored):
            yield from ((code, s) for s, (post, _) in zip(own, found) if post is not None and post[k] > 1e-5)


def sentences_by_turn(text: str) -> list[tuple[int, list[str]]]:
    """The turns of a text by number, each with its sentences."""
    return [(no + 1, speech.sentences_of(speech.clean_text(raw))) for no, raw in enumerate(speech.raw_turns(text))]


def warm_kinds(texts: Iterable[str | None], model: PieceModel) -> None:
    """Score the words by which the kinds of texts are told, all together; whole texts are scored only where no label tells that they are speech."""
    model.warm(w for t in texts if t is not None and not speech.LABEL.search(t) for w in words_of(t.lower()))


def parsed_turns(text: str) -> list[tuple[int, list[tuple[list[str], int]]]]:
    """The turns of a text by number, each with its sentences' words as evidence and their letters."""
    return [(no, [told(s) for s in own]) for no, own in sentences_by_turn(text)]


Turns = list[tuple[int, list[tuple[np.ndarray, int]]]]


def scored_turns(texts: list[str], model: PieceModel) -> list[Turns]:
    """For each text its turns by number, each with the posterior and letters of its sentences that have letters; scored all together."""
    parsed = [parsed_turns(t) for t in texts]
    posts = iter(model.posteriors([words for turns in parsed for _, own in turns for words, _ in own]))
    out = []
    for turns in parsed:
        sure = [(no, [(p, n) for (_, n), p in zip(own, [next(posts) for _ in own]) if p is not None]) for no, own in turns]
        out.append([(no, own) for no, own in sure if own])
    return out


def detect(text: str, model: PieceModel, turns: Turns | None = None) -> tuple[str | None, float, list[tuple[int, str, float]]]:
    """Main language, its confidence, and (turn number, language, confidence) of turns in another one.

    The confidence of a text is the mean over its sentences of the posterior of
    the main language, weighted by letters; of a turn likewise.  ``turns`` are
    the text's ``scored_turns`` where they are known.
    """
    turns = scored_turns([text], model)[0] if turns is None else turns
    votes, letters = Counter(), Counter()
    for _, sentences in turns:
        for post, n in sentences:
            if post.max() >= SURE:
                k = int(post.argmax())
                votes[k] += 1
                letters[k] += n
    if not votes:
        total = sum((post * n for _, ss in turns for post, n in ss), np.zeros(len(model.langs)))
        if not turns:
            return None, 0.0, []
        main = int(total.argmax())
    else:
        main = max(votes, key=lambda k: (votes[k], letters[k], -k))
    weight = sum(n for _, ss in turns for _, n in ss)
    confidence = sum(float(post[main]) * n for _, ss in turns for post, n in ss) / weight
    others = []
    for no, sentences in turns:
        found = {int(post.argmax()) for post, _ in sentences if post.max() >= SURE}
        if len(found) == 1 and found != {main}:
            k = found.pop()
            n = sum(m for _, m in sentences)
            others.append((no, model.langs[k], sum(float(post[k]) * m for post, m in sentences) / n))
    return model.langs[main], confidence, others


def languages(df: DataFrame, model: PieceModel, id_col: str = "row_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id``, ``main_lang``, ``confidence``, ``segments`` (turn, language, confidence) and the columns of ``keep``.

    ``main_lang`` is null for null, blank, list, table and unreadable texts.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # All words of a batch are scored together first.
            parsed = scored_turns([t or "" for t in pdf["text"]], model)
            warm_kinds(pdf["text"], model)
            got = [
                detect(t, model, p) if t is not None and text_kind(t, model) == "prose" else (None, 0.0, [])
                for t, p in zip(pdf["text"], parsed)
            ]
            yield pdf.drop(columns="text").assign(
                main_lang=[g[0] for g in got],
                confidence=[g[1] for g in got],
                segments=[[{"turn_no": n, "lang": x, "confidence": c} for n, x, c in g[2]] for g in got],
            )

    src = df.select(F.col(id_col).alias("id"), *[F.col(c) for c in keep], F.col(text_col).alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name != "text")
    schema = f"{fields}, main_lang string, confidence double, segments array<struct<turn_no:long,lang:string,confidence:double>>"
    return spread(src, "id").mapInPandas(run, schema)


def staged(found: DataFrame) -> DataFrame:
    """The detected languages, computed once for several uses."""
    return stage(found.drop("confidence"), "languages")


def label_faults(found: DataFrame, label_col: str = "language") -> DataFrame:
    """``id, kind, lang`` of missing and wrong labels and of segments in a further language."""
    code = label_code(F.col(label_col))
    known = found.where("main_lang is not null")
    label = known.select(
        "id",
        F.when(code == "", "missing").when(code != F.col("main_lang"), "wrong").alias("kind"),
        F.col("main_lang").alias("lang"),
    ).where("kind is not null")
    segments = known.select("id", F.lit("segment").alias("kind"), F.explode(F.array_distinct(F.transform("segments", lambda s: s["lang"]))).alias("lang"))
    return label.unionByName(segments)


__all__ = ["LANGS", "detect", "fit_model", "label_code", "label_faults", "languages", "staged"]
