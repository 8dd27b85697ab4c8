"""Problem 6: repetition inside a single document.

Method: a suffix array over the words of a text with its longest common
prefixes; for each place the longest wording that already stood earlier follows
from its neighbours in the array, the spans of all such wordings of sufficient
length are united, and the covered share and the longest repeat are reported.

Null, empty and short texts have share 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.kinds import text_kind
from voxloom.llm.lm import PieceModel
from voxloom.llm.speech import strip_marks, words_of
from voxloom.session import spread

#: A wording counts from so many words, or so many Chinese characters, on.
MIN_WORDS, MIN_HAN = 5, 8
MIN_SHARE = 0.4
_TOKEN = re.compile(r"[㐀-䶿一-鿿]|(?:(?![㐀-䶿一-鿿])[\w஀-௿̀-ͯ'’-])+")


def tokens_of(text: str) -> list[str]:
    """Words in lower case; each Chinese character is one."""
    return [t for t in _TOKEN.findall(strip_marks(text).lower()) if t.strip("-'’_")]


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling on ranks."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        second = np.full(n, -1, dtype=np.int64)
        second[: n - k] = rank[k:] if k < n else second[:0]
        order = np.lexsort((second, rank))
        changed = np.empty(n, dtype=np.int64)
        changed[0] = 0
        changed[1:] = (np.diff(rank[order]) != 0) | (np.diff(second[order]) != 0)
        fresh = np.empty(n, dtype=np.int64)
        fresh[order] = np.cumsum(changed)
        rank = fresh
        if rank[order[-1]] == n - 1:
            return order
        k *= 2


def lcp_array(codes: list[int], sa: list[int]) -> list[int]:
    """lcp[r] is the common prefix of the suffixes at ranks r-1 and r."""
    n = len(sa)
    rank, lcp, h = [0] * n, [0] * n, 0
    for r, i in enumerate(sa):
        rank[i] = r
    for i in range(n):
        r = rank[i]
        if r:
            j = sa[r - 1]
            while i + h < n and j + h < n and codes[i + h] == codes[j + h]:
                h += 1
            lcp[r] = h
            h = max(0, h - 1)
        else:
            h = 0
    return lcp


def longest_earlier(codes: list[int]) -> list[int]:
    """For each place the longest match with an earlier place, overlaps included.

    Places are taken out of the suffix array from the last to the first; the
    neighbours that remain at that time are the closest suffixes that start
    earlier.
    """
    n = len(codes)
    if n < 2:
        return [0] * n
    sa = suffix_array(np.asarray(codes)).tolist()
    lcp = lcp_array(codes, sa) + [0]
    rank = [0] * n
    for r, i in enumerate(sa):
        rank[i] = r
    prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
    out = [0] * n
    for i in range(n - 1, -1, -1):
        r = rank[i]
        up, down = lcp[r], lcp[nxt[r]] if nxt[r] < n else 0
        out[i] = max(up if prev[r] >= 0 else 0, down)
        if nxt[r] < n:
            lcp[nxt[r]] = min(up, down) if prev[r] >= 0 else 0
            prev[nxt[r]] = prev[r]
        if prev[r] >= 0:
            nxt[prev[r]] = nxt[r]
    return out


def repeated_share(text: str | None) -> tuple[float, int, int]:
    """Share of words inside a repeated wording, words of the longest repeat, and words in all.

    A wording counts when it has five words or eight Chinese characters; in a
    mixed one the words count a fifth and the characters an eighth each.
    """
    words = tokens_of(text) if text else []
    n = len(words)
    if n < MIN_WORDS:
        return 0.0, 0, n
    ids: dict[str, int] = {}
    codes = [ids.setdefault(w, len(ids)) for w in words]
    if len(ids) == n:
        return 0.0, 0, n
    earlier = longest_earlier(codes)
    # Eighths and fifths as whole numbers, so that sums are exact.
    weight = np.concatenate([[0], np.cumsum([MIN_WORDS if "㐀" <= w <= "鿿" else MIN_HAN for w in words])])
    marks = np.zeros(n + 1, dtype=np.int64)
    longest = 0
    for i, length in enumerate(earlier):
        if length and weight[i + length] - weight[i] >= MIN_WORDS * MIN_HAN:
            marks[i] += 1
            marks[i + length] -= 1
            longest = max(longest, length)
    return float((np.cumsum(marks[:n]) > 0).sum()) / n, longest, n


def repetition(df: DataFrame, id_col: str = "row_id", text_col: str = "text") -> DataFrame:
    """``id, repeated_share, longest_repeat, n_words`` of each text; whole texts, nothing cut."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [repeated_share(t) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "repeated_share": [g[0] for g in got], "longest_repeat": [g[1] for g in got], "n_words": [g[2] for g in got]})

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return spread(src, "id").mapInPandas(run, "id long, repeated_share double, longest_repeat long, n_words long")


def repetitive(df: DataFrame, model: PieceModel, id_col: str = "row_id", text_col: str = "text") -> DataFrame:
    """``id`` of each prose text of which ``MIN_SHARE`` or more is repeated.

    The kind is told where the share is: no text goes back to the JVM, and a task keeps one Python worker.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # Only texts that repeat enough are asked for their kind.
            high = [repeated_share(t)[0] >= MIN_SHARE for t in pdf["text"]]
            model.warm(w for t, h in zip(pdf["text"], high) if h for w in words_of(t.lower()))
            found = [h and text_kind(t, model) == "prose" for t, h in zip(pdf["text"], high)]
            yield pdf.loc[np.array(found, dtype=bool), ["id"]]

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return spread(src, "id").mapInPandas(run, "id long")
