"""Problem 3: splitting oversized items at natural boundaries.

Method: offsets of tokens with their prefix sums of size, and a sorted array of
boundaries; for each piece a binary search finds the last boundary under the
limit, the next piece steps back by the overlap, and where no boundary lies
under the limit the text is cut hard at it.  A token is a code point for sizes
in characters, or a word where ``unit`` is ``words``.

Null and empty items give no pieces; an item within the limit is one piece.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import spread

LIMIT, OVERLAP = 500, 50
#: Places after which or before which a text may be cut, in rising order of place.
_LINE = re.compile(r"\r\n|\r|\n")
_LABEL = re.compile(r"<Speaker\d+>:")
_STOP_BLANK = re.compile(r"(?<=[.!?…])\s")
_FULL_STOP = re.compile(r"[。！？]")


def boundaries(text: str) -> list[int]:
    """Sorted places where a text may be cut: its start and end, line breaks, before a
    ``<SpeakerN>:``, white space after ``. ! ? …``, after ``。！？``."""
    places = {0, len(text)}
    places.update(m.end() for m in _LINE.finditer(text))
    places.update(m.start() for m in _LABEL.finditer(text))
    places.update(m.start() for m in _STOP_BLANK.finditer(text))
    places.update(m.end() for m in _FULL_STOP.finditer(text))
    return sorted(places)


def longest_stretch(text: str) -> int:
    """Characters of the longest stretch between neighbouring boundaries, outer blanks not counted."""
    b = boundaries(text)
    return max((len(text[i:j].strip()) for i, j in zip(b, b[1:])), default=0)


def kind_of(text: str | None, limit: int = LIMIT) -> str | None:
    """``hard`` or ``clean`` for an oversized text, None for any other."""
    if text is None or len(text) <= limit:
        return None
    return "hard" if longest_stretch(text) > limit else "clean"


def token_offsets(text: str, unit: str = "chars") -> tuple[list[int], list[int]]:
    """Offsets where tokens end and the prefix sums of their sizes, both from 0."""
    if unit == "chars":
        return list(range(len(text) + 1)), list(range(len(text) + 1))
    ends = [m.end() for m in re.finditer(r"\S+\s*", text)]
    return [0, *ends], list(accumulate([1] * len(ends), initial=0))


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP, unit: str = "chars") -> list[tuple[int, int, str]]:
    """Ordered pieces as (start, end, how): ``end`` where the text ends, ``clean`` or ``hard`` cuts.

    Each piece has at most ``limit`` tokens.  Consecutive pieces overlap by
    ``overlap`` tokens, or by fewer where the overlap then starts at a boundary;
    every piece ends further on than the one before.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    ends, sums = token_offsets(text, unit)
    cuts = boundaries(text)
    out, start = [], 0
    reached = 0
    while text and reached < len(text):
        at = bisect_right(ends, start) - 1  # the token that holds the start
        far = bisect_right(sums, sums[at] + limit) - 1
        hard_end = ends[far]
        if hard_end >= len(text):
            out.append((start, len(text), "end"))
            break
        k = bisect_right(cuts, hard_end) - 1
        # The last boundary under the limit that leaves more behind it than the overlap.
        clean = k >= 0 and cuts[k] > max(reached, start) and sums[bisect_right(ends, cuts[k]) - 1] - sums[at] > overlap
        stop, how = (cuts[k], "clean") if clean else (hard_end, "hard")
        out.append((start, stop, how))
        reached = stop
        back = bisect_right(ends, stop) - 1
        low = ends[bisect_left(sums, sums[back] - overlap)] if overlap else stop
        b = bisect_left(cuts, low)
        # A boundary inside the overlap shortens it so that the next piece starts there.
        start = cuts[b] if b < len(cuts) and low <= cuts[b] < stop else low
    return out


def oversized_chunks(df: DataFrame, id_col: str = "tr_id", array_col: str = "chunk_transcriptions", limit: int = LIMIT) -> DataFrame:
    """The elements over ``limit`` code points as ``id, chunk_no, text``; the filter runs in the JVM."""
    return df.select(F.col(id_col).alias("id"), F.posexplode(array_col).alias("p", "text")).where(F.length("text") > limit).select(
        "id", (F.col("p") + 1).cast("long").alias("chunk_no"), "text"
    )


def split_items(items: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, unit: str = "chars") -> DataFrame:
    """One row per piece of ``id, chunk_no, text``: piece number, place, cut and text, with the item's kind."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["id", "chunk_no", "kind", "piece_no", "piece_start", "piece_end", "cut", "piece"]
        for pdf in batches:
            rows = []
            for key, no, text in zip(pdf["id"], pdf["chunk_no"], pdf["text"]):
                kind = kind_of(text, limit) if text is not None else None
                rows += [
                    (key, no, kind, n + 1, a, b, how, text[a:b])
                    for n, (a, b, how) in enumerate(split_text(text or "", limit, overlap, unit))
                ]
            yield pd.DataFrame(rows, columns=columns)

    schema = "id long, chunk_no long, kind string, piece_no long, piece_start long, piece_end long, cut string, piece string"
    return spread(items, "id", "chunk_no").mapInPandas(run, schema)


def needed_chunks(duration):
    """Chunks that a recording needs: 1 up to 30 s, else the ceiling of (duration - 1) / 29."""
    return F.when(duration <= 30, F.lit(1)).otherwise(F.ceil((duration - 1) / 29)).cast("long")


def short_recordings(df: DataFrame, id_col: str = "tr_id") -> DataFrame:
    """Recordings with fewer chunks than their duration needs; nulls and NaN do not count."""
    d = F.col("duration_sec")
    return df.where(d.isNotNull() & ~F.isnan(d) & (F.col("num_chunks") < needed_chunks(d))).select(
        F.col(id_col).alias("id"), F.lit(0).cast("long").alias("chunk_no"), F.lit("span").alias("kind")
    )
