"""Segmentation-marginalised unigram models of languages over a fixed public vocabulary.

A word's probability in a language is the sum over all its segmentations into
pieces of the vocabulary; the forward algorithm adds them up.  Pieces never
cross a word's border, so a text's score is the sum of its words' scores and a
word need be scored once.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.speech import words_of
from voxloom.session import spread

#: Where the public vocabularies lie; a parameter, never copied.
TOKENIZER_DIR = os.environ.get("VOXLOOM_TOKENIZERS", "/opt/tokenizers")
LANGS = ("en", "ms", "zh", "ta", "es")
MARK = "▁"
SCRIPTS = ("latin", "han", "tamil", "other")
_CACHE_WORDS = 200_000
#: Cells of the table of one batch of words in the forward algorithm; longer words go alone.
_CELLS = 400_000
#: Expected uses are added up over tasks as whole numbers, so that their order does not matter; all of a language's make up this many bits.
_BITS = 52
_RUN = re.compile(r"(.{1,4}?)\1{3,}")


def load_pieces(path: str | None = None) -> list[str]:
    """The pieces of the vocabulary in lower case, without control and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or os.path.join(TOKENIZER_DIR, "piece_bpe_32k.model"))
    ids = range(sp.get_piece_size())
    return sorted({sp.id_to_piece(i).lower() for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))})


def script_of(ch: str) -> str:
    """Rough script of one character."""
    o = ord(ch)
    if 0x0B80 <= o <= 0x0BFF:
        return "tamil"
    if 0x3400 <= o <= 0x9FFF:
        return "han"
    if o < 0x250 or 0x300 <= o <= 0x36F:
        return "latin"
    return "other"


class Lattice:
    """The pieces in a batch of words: for each the word, its end and length there, and its number."""

    def __init__(self, words: list[str], finder, singles: set[str], floor: dict[str, int]):
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        found: list[tuple[int, int, int, int]] = []
        for k, w in enumerate(words):
            found += [(k, end + 1, n, piece) for end, (n, piece) in finder.iter(w)]
            if not singles.issuperset(w):
                found += [(k, i + 1, 1, floor[script_of(c)]) for i, c in enumerate(w) if c not in singles]
        edges = np.array(found, dtype=np.int64).reshape(-1, 4)
        self.word, self.end, self.piece = edges[:, 0], edges[:, 1], edges[:, 3]
        self.start = self.end - edges[:, 2]

    def _steps(self, at: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """For each place in order: the edges that meet there, by word, and where each word's begin."""
        order = np.lexsort((self.word, at))
        places, first = np.unique(at[order], return_index=True)
        out = []
        for p, part in zip(places.tolist(), np.split(order, first[1:])):
            w = self.word[part]
            out.append((p, part, np.flatnonzero(np.r_[True, w[1:] != w[:-1]])))
        return out

    def forward(self, logs: np.ndarray) -> np.ndarray:
        """log of the sum over all segmentations of each beginning of each word; ``logs`` has a row for each piece."""
        alpha = np.full((len(self.sizes), int(self.sizes.max()) + 1, logs.shape[1]), -np.inf)
        alpha[:, 0] = 0.0
        for p, edges, heads in self._steps(self.end):
            w = self.word[edges]
            alpha[w[heads], p] = np.logaddexp.reduceat(alpha[w, self.start[edges]] + logs[self.piece[edges]], heads, axis=0)
        return alpha

    def backward(self, logs: np.ndarray) -> np.ndarray:
        """The same of each ending."""
        beta = np.full((len(self.sizes), int(self.sizes.max()) + 1, logs.shape[1]), -np.inf)
        beta[np.arange(len(self.sizes)), self.sizes] = 0.0
        for p, edges, heads in reversed(self._steps(self.start)):
            w = self.word[edges]
            beta[w[heads], p] = np.logaddexp.reduceat(beta[w, self.end[edges]] + logs[self.piece[edges]], heads, axis=0)
        return beta


def _batches(words: Iterable[str]) -> list[list[str]]:
    """Words in batches of about equal length and a bounded table."""
    out: list[list[str]] = []
    for w in sorted(words, key=len):
        if not out or (len(out[-1]) + 1) * (len(w) + 1) > _CELLS:
            out.append([])
        out[-1].append(w)
    return out


def _finder(pieces: list[str]):
    """An automaton that finds every piece in a word, with its length and number."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for k, p in enumerate(pieces):
        out.add_word(p, (len(p), k))
    out.make_automaton()
    return out


#: What a worker has built from broadcasts, last used last.  No stage needs more than two; a model that is done with goes with its words.
_BUILT: dict[int, tuple[object, object]] = {}
_BUILT_MOST = 3


def _once(state: object, build: Callable):
    """What ``build`` makes of the value of a broadcast, built once in each worker while it is in use."""
    hit = _BUILT.pop(id(state), None)
    while hit is None and len(_BUILT) >= _BUILT_MOST:
        del _BUILT[next(iter(_BUILT))]
    _BUILT[id(state)] = hit or (state, build(state))
    return _BUILT[id(state)][1]


def _of_broadcast(shared) -> PieceModel:
    """The model of a broadcast, built once in each worker."""
    return _once(shared.value, lambda state: PieceModel(*state))


class PieceModel:
    """Piece probabilities of each language and the forward algorithm over them.

    ``table`` has a row of probabilities by language for each of ``pieces``, and
    behind them one for each script: the probability of a character that no
    piece covers (a stand-in for the byte fallback).  Its size is that of the
    vocabulary.  Words of any length are summed over all their segmentations.
    """

    def __init__(self, langs: tuple[str, ...], pieces: list[str], table: np.ndarray):
        self.langs, self.pieces, self.table = tuple(langs), pieces, table
        with np.errstate(divide="ignore"):
            self._logs = np.log(table)
        self._find = _finder(pieces) if pieces else None
        self._singles = {p for p in pieces if len(p) == 1}
        self._floor = {x: len(pieces) + k for k, x in enumerate(SCRIPTS)}
        self._cache: dict[str, np.ndarray] = {}
        self._shared = None

    @classmethod
    def of(cls, langs: tuple[str, ...], probs: dict[str, np.ndarray], floor: dict[str, np.ndarray]) -> PieceModel:
        pieces = sorted(probs)
        return cls(langs, pieces, np.array([*(probs[p] for p in pieces), *(floor[x] for x in SCRIPTS)]).reshape(-1, len(langs)))

    def share(self, spark) -> PieceModel:
        """Sent to the executors as a broadcast from now on."""
        if self._shared is None:
            self._shared = spark.sparkContext.broadcast((self.langs, self.pieces, self.table))
        return self

    def __reduce__(self):
        if self._shared is not None:
            return _of_broadcast, (self._shared,)
        return PieceModel, (self.langs, self.pieces, self.table)

    def warm(self, words: Iterable[str]) -> None:
        """Score words that are not kept yet, many at a time."""
        new = {w for w in words if w not in self._cache}
        if len(self._cache) + len(new) > _CACHE_WORDS:
            self._cache.clear()
        for batch in _batches(new):
            lattice = Lattice([MARK + w for w in batch], self._find, self._singles, self._floor)
            alpha = lattice.forward(self._logs)
            self._cache.update(zip(batch, alpha[np.arange(len(batch)), lattice.sizes]))

    def word(self, word: str) -> np.ndarray:
        """log P(word) per language, kept for the next time."""
        hit = self._cache.get(word)
        if hit is None:
            self.warm([word])
            hit = self._cache[word]
        return hit

    def scored(self, words: list[str]) -> tuple[np.ndarray, int]:
        """Sum of the log probabilities of words in lower case per language, and their characters; numbers are left out."""
        rows = [self.word(w) for w in words if not w.isdigit()]
        return (np.add.reduce(rows) if rows else np.zeros(len(self.langs))), sum(len(w) for w in words if not w.isdigit())

    def score(self, text: str) -> tuple[np.ndarray, int]:
        """Sum of the words' log probabilities per language, and the characters scored."""
        return self.scored(words_of(text.lower()))

    def posterior(self, text: str) -> np.ndarray | None:
        """P(language | text) under equal priors; None for a text without letters.

        A word that is repeated is evidence once, so a loop over one ambiguous
        word stays ambiguous.
        """
        return self.posteriors([told(text)[0]])[0]

    def posteriors(self, texts: list[list[str]]) -> list[np.ndarray | None]:
        """The same of many texts, each the words that ``told`` gives."""
        kept = [[w for w in words if not w.isdigit()] for words in texts]
        self.warm(w for words in kept for w in words)
        sizes = np.array([len(words) for words in kept], dtype=np.int64)
        full = np.flatnonzero(sizes)
        out: list[np.ndarray | None] = [None] * len(texts)
        if len(full):
            rows = np.array([self.word(w) for words in kept for w in words])
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            total = np.add.reduceat(rows, starts, axis=0)
            e = np.exp(total - total.max(axis=1, keepdims=True))
            for k, p in zip(full.tolist(), e / e.sum(axis=1, keepdims=True)):
                out[k] = p
        return out


def told(text: str) -> tuple[list[str], int]:
    """The different words of a text in lower case, loops inside them taken back, and the letters of all its words."""
    low = text.lower()
    words = words_of(low)
    letters = sum(map(len, words))
    if _RUN.search(low):
        words = words_of(_RUN.sub(r"\1\1", low))
    return list(dict.fromkeys(words)), letters


def train(samples: list[tuple[str, str]], pieces: list[str], langs: tuple[str, ...] = LANGS, rounds: int = 4, background: float = 0.1) -> PieceModel:
    """Fit piece probabilities by expectation maximisation over all segmentations.

    ``samples`` are (language, text).  ``background`` is the share of the
    probability that is spread evenly over the vocabulary, so no piece is
    impossible.  Languages without a sample are left out.
    """
    langs = tuple(x for x in langs if any(lang == x for lang, _ in samples))
    counts: dict[str, Counter] = {x: Counter() for x in langs}
    for lang, text in samples:
        if lang in counts:
            counts[lang].update(w for w in words_of(text.lower()) if not w.isdigit())
    chars = {lang: {c for w in counts[lang] for c in w} for lang in langs}
    known = _known(pieces, chars)
    finder, singles = _finder(known), {p for p in known if len(p) == 1}
    lattices = {lang: [] for lang in langs}
    for lang in langs:
        for words in _batches(counts[lang]):
            lattices[lang].append((Lattice([MARK + w for w in words], finder, singles, {}), np.array([counts[lang][w] for w in words], dtype=float)))

    def expected(logs: np.ndarray) -> np.ndarray:
        out = np.zeros((len(known), len(langs)))
        for k, lang in enumerate(langs):
            for lattice, n in lattices[lang]:
                out[:, k] += np.bincount(lattice.piece, weights=_uses(lattice, n, logs[:, k : k + 1]), minlength=len(known))
        return out

    return _maximised(expected, langs, known, pieces, chars, rounds, background)


def _known(pieces: list[str], chars: dict[str, set[str]]) -> list[str]:
    """The vocabulary and the characters that were met."""
    return sorted(set(pieces).union({MARK}, *chars.values()))


def _uses(lattice: Lattice, n: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """How often each edge of a lattice is expected to be used by ``n`` of each of its words."""
    alpha, beta = lattice.forward(logs)[:, :, 0], lattice.backward(logs)[:, :, 0]
    whole = alpha[np.arange(len(n)), lattice.sizes]
    w = lattice.word
    return np.exp(alpha[w, lattice.start] + logs[lattice.piece, 0] + beta[w, lattice.end] - whole[w]) * n[w]


def _maximised(
    expected: Callable[[np.ndarray], np.ndarray], langs: tuple[str, ...], known: list[str], pieces: list[str], chars: dict[str, set[str]], rounds: int, background: float
) -> PieceModel:
    """The rounds of expectation maximisation; ``expected`` gives the uses of each known piece by language."""
    vocabulary = set(pieces)
    even = 1.0 / max(len(vocabulary), 1)
    p = np.zeros((len(known), len(langs)))
    for _ in range(rounds if langs else 0):
        uses = expected(np.log(0.98 * p + 0.02 * even))
        total = uses.sum(axis=0)
        p = np.where(uses > 1e-9, uses, 0.0) / np.where(total > 0, total, 1.0)
    # The background of a language lies mostly on the scripts its samples use.
    own = [{script_of(c) for c in chars[lang]} for lang in langs]
    script = {piece: script_of(piece.strip(MARK)[:1] or "a") for piece in known}
    size = Counter(script[x] for x in vocabulary)
    floor = {
        x: np.array([background * (0.9 * (x in mine) / max(1, sum(size[y] for y in mine)) + 0.1 * even) for mine in own])
        for x in SCRIPTS
    }
    probs = {piece: (1 - background) * p[k] + floor[script[piece]] for k, piece in enumerate(known) if piece in vocabulary or p[k].any()}
    return PieceModel.of(langs, probs, {x: row / 16 for x, row in floor.items()})


# ---------------------------------------------------------------- training on tables of any size
def units_of(word: str, longer) -> list[str]:
    """The parts of a word between which no piece lies; ``longer`` finds the pieces of several characters.

    The sum over a word's segmentations is the product of its parts' sums, so
    parts are counted instead of words: a run of Chinese is a few of them.
    """
    word = MARK + word
    joined = bytearray(len(word) + 1)
    for end, (n, _) in longer.iter(word):
        joined[end - n + 2 : end + 1] = b"\1" * (n - 1)
    cuts = [0, *(i for i in range(1, len(word)) if not joined[i]), len(word)]
    return [word[a:b] for a, b in zip(cuts, cuts[1:])]


class UnitCounter:
    """Counts units of texts by language inside a task; the vocabulary is sent as a broadcast."""

    def __init__(self, spark, pieces: list[str]):
        self._pieces = spark.sparkContext.broadcast([p for p in pieces if len(p) > 1])

    def counted(self, samples: Iterable[tuple[str, str]]) -> pd.DataFrame:
        """``lang, unit, n`` of (language, text)."""
        longer = _once(self._pieces.value, _finder)
        words: Counter = Counter()
        for lang, text in samples:
            words.update((lang, w) for w in words_of(text.lower()) if not w.isdigit())
        units: Counter = Counter()
        for (lang, w), n in words.items():
            for u in units_of(w, longer):
                units[lang, u] += n
        return pd.DataFrame([(lang, u, n) for (lang, u), n in units.items()], columns=["lang", "unit", "n"])


def train_counts(counts: DataFrame, pieces: list[str], langs: tuple[str, ...] = LANGS, rounds: int = 4, background: float = 0.1) -> PieceModel:
    """``train`` on a table of ``lang``, ``unit`` and their number ``n``, each unit once.

    Every round adds up the expected uses in tasks and over them; what reaches
    the driver is a number for each piece of the vocabulary and each character.
    """
    spark = counts.sparkSession

    def letters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met = {(lang, c) for pdf in batches for lang, u in zip(pdf["lang"], pdf["unit"]) for c in u}
        yield pd.DataFrame(sorted(met), columns=["lang", "c"])

    rows = counts.select("lang", "unit").mapInPandas(letters, "lang string, c string").distinct().collect()
    langs = tuple(x for x in langs if any(r.lang == x for r in rows))
    chars = {x: {r.c for r in rows if r.lang == x and r.c != MARK} for x in langs}
    size = {r.lang: r.size for r in counts.groupBy("lang").agg(F.sum(F.col("n") * F.length("unit")).alias("size")).collect()}
    parts = np.array([2.0 ** (_BITS - int(size[x]).bit_length()) for x in langs])
    known = _known(pieces, chars)
    shared = spark.sparkContext.broadcast(known)

    def expected(logs: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(logs)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            finder = _once(shared.value, _finder)
            singles = {p for p in shared.value if len(p) == 1}
            total = np.zeros(sent.value.shape, dtype=np.int64)
            for pdf in batches:
                for lang, g in pdf.groupby("lang"):
                    n, k = dict(zip(g["unit"], g["n"])), langs.index(lang)
                    for units in _batches(n):
                        lattice = Lattice(units, finder, singles, {})
                        uses = np.rint(_uses(lattice, np.array([n[u] for u in units], dtype=float), sent.value[:, k : k + 1]) * parts[k])
                        total[:, k] += np.bincount(lattice.piece, weights=uses, minlength=len(total)).astype(np.int64)
            piece, k = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "k": k, "v": total[piece, k]})

        added = spread(counts, "lang", "unit", waves=1).mapInPandas(run, "piece long, k long, v long").groupBy("piece", "k").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(logs.shape)
        out[added["piece"].to_numpy(), added["k"].to_numpy()] = added["v"].to_numpy()
        sent.unpersist()
        return out / parts

    return _maximised(expected, langs, known, pieces, chars, rounds, background)


def mean_log(scores: np.ndarray, chars: int) -> float:
    """Best mean log probability of a character; a text without letters gets the worst."""
    return float(scores.max() / chars) if chars else float("-inf")
