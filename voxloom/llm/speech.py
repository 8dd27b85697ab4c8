"""Marks in transcripts: speaker labels, timestamps, annotations and fillers."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left

# The spellings of speaker labels, each with the number as its only group.
LABEL_STYLES = [
    r"<\s*speaker[\s_-]*(\d+)\s*>\s*[:：]?",
    r"\*\*\s*speaker[\s_-]*(\d+)\s*[:：]\s*\*\*",
    r"\[\s*speaker[\s_-]*(\d+)\s*\]\s*[:：]?",
    r"(?<![A-Za-z0-9_])speaker[\s_-]*(\d+)\s*[:：]",
    r"(?<![A-Za-z0-9_])spk[\s_-]*(\d+)\s*[>:：]",
    r"(?<![A-Za-z0-9_])S(\d+)\s*[:：]",
    r"说话人\s*(\d+)\s*[:：]",
]
LABEL = re.compile("|".join(LABEL_STYLES), re.I)
#: Anything built like a label: a number with a mark behind it, and before it marks and a word or none.
_NUMBER_MARK = re.compile(r"(?<!\d)(\d{1,9})(?!\d)\s*(?:[>\])}]\s*[:：]?|\*\*\s*[:：]?|[:：](?!\d)\s*(?:\*\*)?)")
_BEFORE_NUMBER = re.compile(r"(?:[<\[*({#]{1,2}\s*)?(?:(?<![^\W\d_])[^\W\d_]{1,12}[\s._#-]{0,2})?\Z")

# The notations of timestamps.
TIMESTAMP_STYLES = [
    r"\(\d{1,2}:\d{2}:\d{2}(?:[.,]\d+)?\)",
    r"\[\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d+)?\]",
    r"\[\d+(?:\.\d+)?\s*s\]",
    r"<\d{1,2}:\d{1,2}(?::\d{2})?(?:\.\d+)?>",
    r"(?<![\d:])\d{1,2}:\d{2}:\d{2}[.,]\d{1,3}(?!\d)",
]
TIMESTAMP = re.compile("|".join(TIMESTAMP_STYLES))

# Annotations, and sounds of hesitation that are no words.
ANNOTATION = re.compile(
    r"!?[(（]\s*(?:ah|oh|err|uh|um|hm+|lah|laugh(?:s|ter)?|wah|wow|eh|cough|sigh|noise|music|applause"
    r"|inaudible|笑声|笑|掌声|音乐|噪音|咳嗽)\s*[)）]!?"
    r"|<\s*(?:noise|music|laugh(?:s|ter)?|cough|applause|unk|silence)\s*>"
    r"|\[\s*(?:music|applause|noise|laugh(?:s|ter)?|cough|silence|inaudible|crosstalk)\s*\]"
    r"|\*\s*(?:cough|laughs?|sigh|applause|music|noise)s?\s*\*",
    re.I,
)
FILLERS = frozenset(
    "hmm hm um umm uh uhh err er erm ah aa aah eh mmm mm oh este 嗯 嗯嗯 呃 呃呃 额 ஆஆ ம்ம் ஹ்ம்".split()
)

#: An annotation that another one was put into; the inner one is a NUL by then.
_SPLIT = re.compile(r"([(（<\[*])([^()（）<>\[\]*\x00\n]{0,12})\x00([^()（）<>\[\]*\x00\n]{0,12})([)）>\]*])")


def _rejoined(m: re.Match) -> str:
    """A NUL for an annotation whose two halves make one; anything else stays."""
    whole = m.group(1) + m.group(2).rstrip(" ,，") + m.group(3).lstrip(" ,，") + m.group(4)
    return "\x00" if ANNOTATION.fullmatch(whole) else m.group()


def blank_annotations(text: str) -> str:
    """The text with a NUL in the place of each annotation, also of one with another inside."""
    return _SPLIT.sub(_rejoined, ANNOTATION.sub("\x00", text))


WORD = re.compile(r"[一-鿿㐀-䶿]+|(?:(?![一-鿿㐀-䶿])[\w஀-௿̀-ͯ'’])+")
SENTENCE = re.compile(r"[^.!?。！？…\n\r]+[.!?。！？…]*")


def strip_marks(text: str) -> str:
    """The text without labels, timestamps and annotations, each replaced by a blank."""
    return blank_annotations(TIMESTAMP.sub(" ", LABEL.sub(" ", text))).replace("\x00", " ")


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, Chinese runs apart from others."""
    return [w for w in WORD.findall(text) if w.strip("'’_")]


def blanked(text: str) -> str:
    """A turn with blanks for timestamps and NULs for annotations."""
    return blank_annotations(TIMESTAMP.sub(" ", text))


def clean_words(text: str, blank: str | None = None) -> list[str]:
    """The words of a turn without timestamps, annotations and fillers; ``blank`` is the ``blanked`` text where it is known."""
    out = blanked(text) if blank is None else blank
    return [w for w in words_of(out.replace("\x00", " ")) if w.lower() not in FILLERS]


#: An annotation inside a Chinese word leaves no blank there.
_HAN_GAP = re.compile(r"(?<=[一-鿿])[\s,，]*\x00[\s,，]*(?=[一-鿿])")


def clean_text(text: str, blank: str | None = None) -> str:
    """The readable words of a turn: marks and fillers out, blanks and stray commas mended."""
    out = blanked(text) if blank is None else blank
    out = _HAN_GAP.sub("", out).replace("\x00", " ")
    out = WORD.sub(lambda m: " " if m.group().lower() in FILLERS else m.group(), out)
    out = re.sub(r"\s+", " ", out)
    out = re.sub(r"(?:^|(?<=[.!?。！？]))[\s,，、.…]+", " ", out)
    out = re.sub(r"\s*[,，](?:\s*[,，])+", ",", out)
    return out.strip(" ,，、")


def timestamp_seconds(mark: str) -> float:
    """Seconds of a timestamp in any of the notations."""
    body = mark.strip("()[]<> ").replace(",", ".")
    if body.endswith("s"):
        return float(body[:-1])
    total = 0.0
    for part in body.split(":"):
        total = total * 60 + float(part)
    return total


def number_key(digits: str) -> str:
    """A number of any length and script as plain digits without leading zeros."""
    return "".join(str(unicodedata.digit(c)) for c in digits).lstrip("0") or "0"


def label_spans(text: str) -> list[tuple[int, int, str]]:
    """Places of labels as (start, end, number)."""
    return [(m.start(), m.end(), number_key(m.group(m.lastindex))) for m in LABEL.finditer(text)]


def numbered_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """Places of anything else that is built like a label; ``taken`` are those of labels and timestamps in order."""
    starts = [a for a, _ in taken]
    out: list[tuple[int, int, str]] = []
    for m in _NUMBER_MARK.finditer(text):
        k = bisect_left(starts, m.end()) - 1
        if k < 0 or taken[k][1] <= m.start():
            low = max(taken[k][1] if k >= 0 else 0, out[-1][1] if out else 0, m.start() - 18)
            out.append((m.start() - len(_BEFORE_NUMBER.search(text, low, m.start()).group()), m.end(), number_key(m.group(1))))
    return out


def sentences_of(text: str) -> list[str]:
    """Sentences of a cleaned text; a stop inside a number or without following blank does not cut Latin text."""
    out, last = [], 0
    for m in re.finditer(r"[.!?…]+(?=\s|$|[一-鿿])|[。！？]+|[\n\r]+", text):
        piece = text[last : m.end()].strip()
        if piece:
            out.append(piece)
        last = m.end()
    rest = text[last:].strip()
    if rest:
        out.append(rest)
    return out


def raw_turns(text: str) -> list[str]:
    """The stretches between labels, or the whole text where there is none."""
    spans = label_spans(text)
    if not spans:
        return [text]
    cuts = [s[1] for s in spans]
    ends = [s[0] for s in spans[1:]] + [len(text)]
    return [text[a:b] for a, b in zip(cuts, ends)]
