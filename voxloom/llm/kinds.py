"""Telling natural prose from lists, tables and unreadable text, by form."""

from __future__ import annotations

import re
from collections import Counter

from voxloom.llm.lm import PieceModel, mean_log
from voxloom.llm.speech import LABEL, words_of

#: A text whose best mean log probability of a character is below this is unreadable.
READABLE = -5.2
#: The same for Chinese, where a character is a word.
READABLE_HAN = -9.5
_NUMBER = re.compile(r"^[\s+\-]*[\d.,:%]+\s*$")
_BULLET = re.compile(r"^\s*(?:[-*•·–]\s+|\(?(?:\d{1,3}|[A-Za-z])[.)、]\s+)")
_AMOUNT = re.compile(r"\s+[x×]\s?\d+\s*$", re.I)
_STOP = re.compile(r"[.!?…](?:\s|$)|[。！？]")
_RULE = re.compile(r"^[\s|:+\-=]+$")


def table_columns(text: str) -> int:
    """Columns of a table of two or more rows with a column of numbers or codes; 0 for anything else."""
    lines = [x for x in re.split(r"[\r\n]+", text) if x.strip() and not _RULE.match(x)]
    if len(lines) < 2:
        return 0
    for cut in (r"\|", r"\t", ";", ",", r"\s{2,}"):
        rows = [[c.strip() for c in re.split(cut, x.strip().strip("|") if cut == r"\|" else x.strip())] for x in lines]
        columns, same = Counter(map(len, rows)).most_common(1)[0]
        if columns < 3 or same < max(2, 0.7 * len(rows)):
            continue
        full = [r for r in rows if len(r) == columns]
        numeric = sum(sum(bool(_NUMBER.match(r[k])) for r in full) >= 0.6 * len(full) for k in range(columns))
        if numeric or cut in (r"\|", r"\t"):
            return columns
    return 0


def list_items(text: str) -> list[str]:
    """The items of a list without sentences, bullets and amounts taken off; empty for anything else."""
    if LABEL.search(text):
        return []
    lines = [x.strip() for x in re.split(r"[\r\n]+", text) if x.strip()]
    if len(lines) >= 3:
        items = lines
    else:
        body = " ".join(lines)
        for cut in (r"\s*[•·]\s*", "、", r"\s*;\s*", r"[,，]\s*", r"\s+/\s+|\s+\|\s+"):
            items = [x for x in re.split(cut, body) if x.strip()]
            if len(items) >= 4:
                break
        else:
            return []
    items = [_AMOUNT.sub("", _BULLET.sub("", x)).strip() for x in items]
    if any(_STOP.search(x) for x in items):
        return []
    size = sorted(len(x) / 2 if re.search(r"[一-鿿]", x) else len(words_of(x)) for x in items)
    return items if size[len(size) // 2] <= 6 and size[-1] <= 12 else []


def readability(text: str, model: PieceModel) -> tuple[float, float]:
    """Best mean log probability of a character, and the share of the text that letters make up."""
    body = re.sub(r"\s+", "", text)
    scores, chars = model.score(text)
    letters = sum(len(w) for w in words_of(text) if not w.isdigit())
    return mean_log(scores, chars), letters / max(1, len(body))


def is_junk(text: str, model: PieceModel) -> bool:
    """No readable language: hardly a letter, or letters that no language's model explains."""
    score, letters = readability(text, model)
    if letters < 0.35:
        return True
    han = len(re.findall(r"[一-鿿]", text))
    return score < (READABLE_HAN if han > 0.3 * len(text) else READABLE)


def structure(text: str, model: PieceModel) -> tuple[float, float]:
    """Two statistics of a text's build: the share of its lines that are rows of three or more columns, and of its parts that are readable items."""
    if LABEL.search(text):
        return 0.0, 0.0
    columns = table_columns(text)
    if columns >= 3:
        return 1.0, 0.0
    items = list_items(text)
    return 0.0, float(bool(items) and not is_junk(" ".join(items), model))


def text_kind(text: str | None, model: PieceModel) -> str:
    """``blank``, ``table``, ``list``, ``junk`` or ``prose``."""
    if text is None or not text.strip():
        return "blank"
    if LABEL.search(text):
        return "prose"
    if table_columns(text) >= 3:
        return "table"
    if is_junk(" ".join(items := list_items(text)) or text, model):
        return "junk"
    return "list" if items else "prose"
