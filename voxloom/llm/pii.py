"""Problem 10: personal information inside free text.

Method: information-theoretic sanitisation.  One pass over all documents takes
the candidates (spans in the form of an email, a number or an address, and all
words and Chinese characters) and counts for each term how often it stands in a
protected context, near a cue such as "my name is" or "email", and how often at
all.  Terms of a form are its kind, its shape and its parts; terms of a name are the beginnings, endings and whole forms of words, and the
characters of Chinese names of two to four by place.  They are hashed into a fixed number
of buckets, so what reaches the driver does not grow.  The pointwise mutual
information of a term with the protected context tells how many bits it reveals.
A candidate whose terms exceed the disclosure threshold is a mention and gives
way to a typed placeholder; a form brings no bits of its own, so a corpus in
which nothing stands near a cue has no mention.

Other terms are then held against the entities found: where a term of the same
documents tells an entity nearly as surely as its name does, it is generalised
to ``[TERM]`` in that entity's documents (``revealing_terms``).

Null and empty texts have no mention and stay as they are.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import spread, stage

#: Buckets of the terms of names and of forms, as powers of two.
BITS, FORM_BITS = 18, 16
#: Share of the information of a protected context from which on a form is a mention.
THRESHOLD = 0.63
#: Bits from which on a word is of a name, a single word is a name, and a Chinese name is one.
NAME_WORD, NAME_ALONE, NAME_HAN = 1.5, 4.5, 12.0
#: Most bits that a cue next to a name is worth; a cue alone never makes a mention.
CUE_BITS = 3.0
#: Characters before a form within which a cue protects it, and words that they hold.
REACH, REACH_WORDS = 28, 5
#: Occurrences that a term is taken to have had at the rate of its kind, and a kind at the rate of all places.
PRIOR = 4.0
#: Share of an entity's own information from which on a term discloses it, and the different texts that must bear it out.
DISCLOSING, SUPPORT = 0.9, 3

_WIDE = str.maketrans("０１２３４５６７８９＋（）－．＠", "0123456789+()-.@")
_HAS_WIDE = re.compile("[０-９＋（）－．＠]")

# Words of digits, by language.
_SPOKEN = {
    "en": "zero oh one two three four five six seven eight nine",
    "ms": "kosong sifar satu dua tiga empat lima enam tujuh lapan sembilan",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "ta": "பூஜ்ஜியம் பூஜ்யம் சுழியம் சைபர் ஒன்று இரண்டு மூன்று நான்கு ஐந்து ஆறு ஏழு எட்டு ஒன்பது",
}
_HAN_DIGITS = "零〇一二三四五六七八九幺"

# Words that announce a mention of each kind.
CUES = {
    "name": [
        "my name is", "i am called", "mr", "mrs", "ms", "dr", "prof", "nama saya", "encik", "puan", "me llamo", "mi nombre es",
        "señora", "señor", "sra.", "sr.", "என் பெயர்", "திரு", "திருமதி", "我叫", "我是", "我的名字是",
    ],
    "phone": ["call me", "tel", "hotline", "whatsapp", "phone", "telefon", "talian", "hubungi", "llámeme", "teléfono", "número", "தொலைபேசி", "அழைக்க", "电话", "热线", "手机"],
    "id": ["ic number", "identity card", "passport", "kad pengenalan", "kp", "documento", "carné", "pasaporte", "அடையாள அட்டை", "身份证", "证件", "护照"],
    "email": ["write to", "reach me", "contact", "email", "e-mail", "mail", "emel", "correo", "escriba", "மின்னஞ்சல்", "邮箱", "邮件"],
    "address": ["live at", "lives at", "address", "alamat", "tinggal di", "vivo en", "dirección", "முகவரி", "住在", "地址"],
}

# ---------------------------------------------------------------- forms of emails, numbers and addresses
_AT = r"(?:\s?@\s?|\s?[\[(]\s?at\s?[\])]\s?|\s+(?:at|arroba)\s+)"
_DOT = r"(?:\.|\s?[\[(]\s?(?:dot|punto)\s?[\])]\s?|\s+(?:dot|punto)\s+)"
_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._+\-])[A-Za-z0-9](?:[A-Za-z0-9._+\-]*[A-Za-z0-9_+])?"
    r"(?:\s?[\[(]?\s?\b(?:dot|underscore|dash|plus|punto)\b\s?[\])]?\s?[A-Za-z0-9][A-Za-z0-9_+\-]*){0,4}"
    rf"{_AT}[A-Za-z0-9][A-Za-z0-9\-]*(?:{_DOT}[A-Za-z0-9][A-Za-z0-9\-]*){{0,5}}{_DOT}[A-Za-z]{{2,}}(?![A-Za-z0-9])",
    re.I,
)
_CLEAR = r"(?<![A-Za-z0-9_.+\-/,])"
_END = r"(?![A-Za-z0-9_]|[.\-/,]\d)"
_PHONES = [
    re.compile(r"(?<![\d+])\+\d{1,3}(?:[ .\-]?\(?\d{1,4}\)?){2,5}(?!\d|[.\-]\d)"),
    re.compile(r"(?<!\d)\(\+?\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d|[.\-]\d)"),
    re.compile(_CLEAR + r"0\d{1,3}[ .\-]\d{3,4}[ .\-]\d{3,4}" + _END),
    re.compile(_CLEAR + r"0\d{1,2}-\d{6,8}(?: \d{4})?" + _END),
    re.compile(_CLEAR + r"0\d{8,10}" + _END),
    re.compile(_CLEAR + r"\d{3}-\d{4}" + _END),
]
_SPOKEN_RUN = re.compile(
    "|".join(rf"(?<!\w)(?:{'|'.join(w.split())})(?:[\s,.\-]+(?:double\s+|triple\s+)?(?:{'|'.join(w.split())})(?![\w஀-௿])){{6,}}" for w in _SPOKEN.values())
    + rf"|[{_HAN_DIGITS}](?:[\s,，\-]?[{_HAN_DIGITS}]){{6,}}",
    re.I,
)
_IDS = [
    re.compile(_CLEAR + r"(\d{6})([- ]?)\d{2}\2\d{4}" + _END),
    re.compile(_CLEAR + r"\d{3}-\d{2}-\d{4}" + _END),
    re.compile(r"(?<![A-Za-z0-9])[A-Z]\d{8}" + _END),
]
# Words for streets.
_EN_STREET = r"(?:Street|Road|Avenue|Ave\.?|Lane|Close|Drive|Crescent|Court|Way|Terrace|Boulevard|Blvd\.?|St\.|Rd\.|Ln\.|Dr\.)"
_MS_STREET = r"(?:Jalan|Jln\.?|Lorong|Lrg\.?|Persiaran|Lebuhraya|Lebuh|Pangsapuri|Kampung|Kg\.?|Kondominium|Flat)"
_ES_STREET = r"(?:C/|Calle|Avenida|Avda\.?|Av\.|Plaza|Paseo|Camino|Carrera|Travesía)"
_TA_STREET = r"(?:சாலை|தெரு|சந்து|வீதி|நகர்|தோட்டம்)"
_CAP = r"[A-ZÁÉÍÓÚÑ][\w'’]*"
_ADDRESSES = [
    re.compile(
        r"(?<![\w/])(?:(?:Flat|Unit|Apt\.?|Apartment|Suite|No\.?|Lot|Block|Blk\.?)[ ]*[A-Z]?-?\d[\w/\-]*,? +)?(?:\d{1,4}[A-Za-z]?(?:/\d+)?,? +)?"
        rf"(?:{_CAP} +){{1,3}}{_EN_STREET}(?!\w)(?:,[ ]*{_CAP}(?: +{_CAP}){{0,2}})?(?:,? +\d{{5}})?"
    ),
    re.compile(
        r"(?<![\w/])(?:(?:No\.?|Lot|Blok|Block|Unit|Tingkat)[ ]*[A-Z]?-?\d[\w/\-]*,? +|\d{1,4}[A-Z]?,? +)"
        rf"{_MS_STREET} +(?:{_CAP}|\d+/\d+\w*)(?: +(?:{_CAP}|\d+/\d+\w*)){{0,3}}(?:,[ ]*(?:Taman|Bandar|Seksyen|Kampung)(?: +{_CAP}){{1,2}})?(?:,[ ]*\d{{5}} +{_CAP}(?: +{_CAP})?)?"
    ),
    re.compile(
        rf"(?<!\w){_ES_STREET}[ ]*(?:de +)?(?:l[ao]s? +|el +)?{_CAP}(?: +(?:de +)?(?:l[ao]s? +)?{_CAP}){{0,3}},? +(?:n[.º°][ ]*)?\d+(?:,?[ ]*\d+\s?[ºª°]\s?[A-Z]?)?(?:,[ ]*{_CAP}(?: +{_CAP})?)?"
    ),
    re.compile(rf"(?:எண் +)?(?<!\d)\d{{1,4}}(?:/\d+)?,[ ]*[஀-௿]+(?:\s[஀-௿]+)?\s{_TA_STREET}(?:,[ ]*[஀-௿]+)?"),
    re.compile(r"(?:[一-鿿]{2}(?:省|市|区|县|镇|乡|村|湾|岛|州))*[一-鿿]{2}(?:路|街|巷|道|弄|大道)\d{1,4}(?:弄\d+)?号(?:\d{1,4}(?:室|楼|栋|单元|房))*"),
]


# What a text must hold for a pattern to be worth running; none of these leaves out a match.
_EMAIL_HINT = re.compile(r"@|(?:\bat|arroba)\s?[\])]?\s?[A-Za-z0-9\-]+(?:\.[A-Za-z0-9]|\s?[\[(]?\s?(?:dot|punto))", re.I)
_ADDRESS_HINTS = [
    ("Street", "Road", "Ave", "Lane", "Close", "Drive", "Crescent", "Court", "Way", "Terrace", "Boulevard", "Blvd.", "St.", "Rd.", "Ln.", "Dr."),
    ("Jalan", "Jln", "Lorong", "Lrg", "Persiaran", "Lebuh", "Pangsapuri", "Kampung", "Kg", "Kondominium", "Flat"),
    ("C/", "Calle", "Av", "Plaza", "Paseo", "Camino", "Carrera", "Travesía"),
    ("சாலை", "தெரு", "சந்து", "வீதி", "நகர்", "தோட்டம்"),
    ("号",),
]
_SPOKEN_WORDS = [w.split() for w in _SPOKEN.values()]


def _spoken_digits(text: str) -> bool:
    """Whether a text holds seven words of digits of one language, however they stand."""
    low = text.lower()
    return any(sum(map(low.count, words)) >= 7 for words in _SPOKEN_WORDS) or sum(map(text.count, _HAN_DIGITS)) >= 7


def _digits(s: str) -> int:
    return sum(c.isdigit() for c in s)


def _born(six: str) -> bool:
    return 1 <= int(six[2:4]) <= 12 and 1 <= int(six[4:6]) <= 31


def shape(kind: str, span: str) -> str:
    """Class of a span: its digits as 9, runs of letters as a; of emails and addresses the marks between words."""
    if kind in ("email", "address"):
        return kind + ":" + re.sub(r"[\w஀-௿]+", "", span)
    return kind + ":" + re.sub(r"[^\W\d]+", "a", re.sub(r"\d", "9", span))


_PART = re.compile(r"[^\W\d_]+[஀-௿]*|\d+")

def form_terms(kind: str, span: str) -> list[str]:
    """Terms of a form, its kind first: shape, and the parts that tell it."""
    parts = [x.lower() for x in _PART.findall(span)]
    if kind == "email":
        own = [f"t{parts[-1]}", f"d{parts[-2]}", f"l{parts[0]}"] if len(parts) > 2 else parts
    elif kind == "phone":
        own = [f"p{parts[0]}"]
    elif kind == "address":
        own = [x for x in parts if not x.isdigit()]
    else:
        own = []
    return [kind, shape(kind, span), *[f"{kind}:{x}" for x in own]]


def structured(text: str) -> list[tuple[int, int, str]]:
    """Spans of the forms of emails, addresses, ids and phones, none overlapping."""
    t = text.translate(_WIDE) if _HAS_WIDE.search(text) else text
    found: list[tuple[int, int, str]] = []
    taken = bytearray(len(t))

    def add(a: int, b: int, kind: str) -> None:
        if t[b - 1] == ")" and t.count("(", a, b) < t.count(")", a, b):
            b -= 1
        if b > a and not any(taken[a:b]):
            taken[a:b] = b"\x01" * (b - a)
            found.append((a, b, kind))

    if _EMAIL_HINT.search(t):
        for m in _EMAIL.finditer(t):
            add(m.start(), m.end(), "email")
    for p, hints in zip(_ADDRESSES, _ADDRESS_HINTS):
        for m in p.finditer(t) if any(h in t for h in hints) else ():
            if _digits(m.group()):
                add(m.start(), m.end(), "address")
    for k, p in enumerate(_IDS):
        for m in p.finditer(t):
            if k or _born(m.group(1)):
                add(m.start(), m.end(), "id")
    for m in _SPOKEN_RUN.finditer(t) if _spoken_digits(t) else ():
        add(m.start(), m.end(), "phone")
    for p in _PHONES:
        for m in p.finditer(t):
            if 7 <= _digits(m.group()) <= 13:
                add(m.start(), m.end(), "phone")
    return sorted(found)


# ---------------------------------------------------------------- terms and their counts
_WORD = re.compile(r"[஀-௿]+|(?:(?![一-鿿㐀-䶿஀-௿])[^\W\d_])+(?:['’](?:(?![一-鿿஀-௿])[^\W\d_])+)?")
_HAN2 = re.compile(r"(?=[一-鿿]{2})")
_HAN_RUN = re.compile(r"[一-鿿]*")
#: Characters of a Chinese name.
HAN_LENGTHS = (2, 3, 4)
_LATIN_CUE = re.compile(r"(?<![\w஀-௿])(?:" + "|".join(re.escape(c) for c in CUES["name"] if not re.match(r"[一-鿿]", c)) + r")\.?\s+(?=[\w஀-௿])", re.I)
_HAN_BEFORE = re.compile("|".join(c for c in CUES["name"] if re.match(r"[一-鿿]", c)))
_LINK = re.compile(r"^(?:bin|binti|a/l|a/p|ibn|van|von)$", re.I)
def _announces(words: list[str]) -> re.Pattern:
    """Any of the cues; one in Latin letters is no part of a longer word's middle or end."""
    return re.compile("|".join((r"(?<![^\W\d_])" if c.isascii() else "") + re.escape(c) for c in words), re.I)


#: Cues of one Latin word, counted among the words, and the others, counted in the text.
_SINGLE = [[c for c in v if c.isascii() and c.isalpha()] for k, v in CUES.items() if k != "name"]
_PHRASES = [[c for c in v if not (c.isascii() and c.isalpha())] for k, v in CUES.items() if k != "name"]
_CUE_NEAR = {k: _announces(v) for k, v in CUES.items() if k != "name"}


_PLACEHOLDER = re.compile(r"\[(?:NAME|EMAIL|PHONE|ID|ADDRESS)\]")


def _bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "replace")) & ((1 << BITS) - 1)


def _form_bucket(term: str) -> int:
    """Forms have few terms, and buckets of their own."""
    return (1 << BITS) + (zlib.crc32(term.encode("utf-8", "replace")) & ((1 << FORM_BITS) - 1))


def word_terms(word: str) -> list[str]:
    """Terms of a word: beginnings and endings of three and four letters, and the whole."""
    w = word.lower()
    return [f"b3{w[:3]}", f"b4{w[:4]}", f"e3{w[-3:]}", f"e4{w[-4:]}", f"w{w}"]


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with spans blanked out, places kept."""
    out, at = [], 0
    for a, b, _ in spans:
        out += [text[at:a], "\x00" * (b - a)]
        at = b
    return "".join([*out, text[at:]]) if out else text


_NAME_GAP, _INITIAL_GAP = re.compile(r"[ ]?,?[ ]?"), re.compile(r"\.[ ]?")
_INITIAL = re.compile(r"(?<![\w.])[^\W\d_a-z]\.[ ]?$")


def name_slots(text: str) -> list[tuple[int, int]]:
    """Places of the words that stand where a cue announces a name.

    Two words, links between them not counted, and behind them every link and
    every word with a capital that one blank joins.  Scripts without capitals do
    not show that a third word is of the name: there only two words are learnt.
    """
    out = []
    for m in _LATIN_CUE.finditer(text):
        at, n, want = m.end(), 0, 2
        while True:
            initial = n and text[at - 1 : at].isupper() and at - out[-1][0] == 1
            w = (_INITIAL_GAP if initial else _NAME_GAP).match(text, at)
            hit = _WORD.match(text, w.end())
            if not hit or (n and w.end() == at):
                break
            link = bool(_LINK.match(hit.group()))
            if n >= want and not (w.group() == " " and (link or len(hit.group()) > 1 and hit.group().istitle())):
                break
            if link:
                want += 1
            out.append(hit.span())
            at, n = hit.end(), n + 1
    return out


def han_slots(text: str) -> list[tuple[int, int]]:
    """Places where a cue announces a Chinese name; the end is -1 where more characters follow than a name has."""
    out = []
    for m in _HAN_BEFORE.finditer(text):
        n = _HAN_RUN.match(text, m.end()).end() - m.end()
        if n >= HAN_LENGTHS[0]:
            out.append((m.end(), m.end() + n if n <= HAN_LENGTHS[-1] else -1))
    return out


class TermCounts:
    """Terms of texts, and those of them in a protected context; words are taken apart once, at the end."""

    def __init__(self):
        self.counts: Counter = Counter()
        self.hits: Counter = Counter()
        self.words: Counter = Counter()
        self.named: Counter = Counter()
        self.chars: Counter = Counter()

    def add(self, text: str, spans: list[tuple[int, int, str]]) -> None:
        counts, hits = self.counts, self.hits
        for a, b, kind in spans:
            cued = bool(_CUE_NEAR[kind].search(text[max(0, a - REACH) : a]))
            for term in map(_form_bucket, form_terms(kind, text[a:b].translate(_WIDE))):
                counts[term] += 1
                hits[term] += cued
        low = text.lower()
        for k, phrases in enumerate(_PHRASES):
            hits[-4 - k] += sum(map(low.count, phrases))
        body = masked(text, spans)
        self.words.update(_WORD.findall(body.lower()))
        for a, b in name_slots(body):
            w = body[a:b].lower()
            if not _LINK.match(w):
                self.named[w] += 1
        self.chars.update(body)
        for a, b in han_slots(body):
            hits[-3] += 1
            if b > 0:
                hits[_bucket(f"hn{b - a}")] += 1
            # Where the end is not known, only the characters that any name has.
            for k, c in enumerate(body[a : b if b > 0 else a + HAN_LENGTHS[0]]):
                hits[_bucket(f"h{k}{c}")] += 1

    def rows(self) -> list[tuple[int, int, int]]:
        """(term, count, count in a protected context)."""
        counts, hits = self.counts.copy(), self.hits.copy()
        for c, n in self.chars.items():
            if "一" <= c <= "鿿":
                counts[-3] += n
                counts[_bucket(f"h{c}")] += n
            elif c.isdigit():
                counts[-1] += n
        for k, single in enumerate(_SINGLE):
            hits[-4 - k] += sum(self.words[w] for w in single)
        for w, n in self.words.items():
            named = self.named.get(w, 0)
            counts[-2] += n
            hits[-2] += named
            for term in word_terms(w):
                k = _bucket(term)
                counts[k] += n
                hits[k] += named
        return [(t, counts[t], hits[t]) for t in sorted(set(counts) | set(hits))]


OBSERVED = "id long, text string, spans array<struct<pos:long,end:long,kind:string>>, terms array<struct<term:int,n:long,p:long>>"


def observed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with the spans of its forms, and among them rows without an id that hold the counts of a batch.

    Staged: forms are looked for once, and the counts are added up before a shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen, spans = TermCounts(), []
            for text in pdf["text"]:
                found = structured(text) if text else []
                spans.append([{"pos": a, "end": b, "kind": k} for a, b, k in found])
                if text:
                    seen.add(text, found)
            yield pd.DataFrame({"id": pdf["id"], "text": pdf["text"], "spans": spans, "terms": None})
            terms = [{"term": t, "n": n, "p": p} for t, n, p in seen.rows()]
            yield pd.DataFrame({"id": [None], "text": [None], "spans": [None], "terms": [terms]}).astype({"id": "Int64"})

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return stage(spread(src, "id").mapInPandas(run, OBSERVED), "forms")


def count_terms(seen: DataFrame) -> DataFrame:
    """``term, n, n_protected`` over all documents of ``observed``."""
    rows = seen.where("terms is not null").select(F.explode("terms").alias("t"))
    return rows.groupBy("t.term").agg(F.sum("t.n").alias("n"), F.sum("t.p").alias("n_protected"))


class Disclosure:
    """Bits that terms reveal, by pointwise mutual information with the protected context."""

    def __init__(self, counts: np.ndarray, hits: np.ndarray, totals: dict[int, tuple[int, int]]):
        self.counts, self.hits = counts, hits
        digits, words, han = (totals.get(k, (0, 0)) for k in (-1, -2, -3))
        self.tokens = digits[0] // 3 + words[0] + han[0] // 2
        #: Share of all places that lie near a cue, by kind.
        self.rates = {kind: (REACH_WORDS * totals.get(-4 - k, (0, 0))[1] + 1) / (self.tokens + 1000) for k, kind in enumerate(_CUE_NEAR)}
        self.word_rate = (words[1] + 1) / (words[0] + 200)
        self.han_rate = (han[1] + 1) / (3 * han[0] + 2000)
        #: Bits of a place behind a cue: the information of the protected context, none where no cue was seen.
        self.word_cue = min(CUE_BITS, -math.log2(self.word_rate)) if words[1] else 0.0
        self.han_cue = min(CUE_BITS, -math.log2(self.han_rate)) if han[1] else 0.0
        self._words: dict[str, float] = {}
        self._han: dict[tuple[int, str], float] = {}
        lengths = {n: int(hits[_bucket(f"hn{n}")]) + 8 for n in HAN_LENGTHS}
        #: Bits of the length of a Chinese name, none for the most frequent one.
        self.han_lengths = {n: math.log2(k / max(lengths.values())) for n, k in lengths.items()}

    @classmethod
    def of(cls, rows) -> Disclosure:
        counts, hits = np.zeros((1 << BITS) + (1 << FORM_BITS), dtype=np.int64), np.zeros((1 << BITS) + (1 << FORM_BITS), dtype=np.int64)
        totals = {}
        for term, n, p in rows:
            if term < 0:
                totals[term] = (n, p)
            else:
                counts[term], hits[term] = n, p
        return cls(counts, hits, totals)

    def _bits(self, term: str, rate: float, weight: float) -> float:
        k = _bucket(term)
        return math.log2((self.hits[k] + weight * rate) / (self.counts[k] + weight) / rate)

    def form(self, kind: str, span: str) -> float:
        """Bits of a span in a form: the mean over its terms, each drawn to the rate of its kind where it is rare."""
        rate = p = self.rates[kind]
        bits = []
        for term in form_terms(kind, span.translate(_WIDE)):
            k = _form_bucket(term)
            share = (self.hits[k] + PRIOR * p) / (self.counts[k] + PRIOR)
            if term == kind:
                p = share
            else:
                bits.append(math.log2(share / rate))
        return sum(bits) / len(bits)

    def discloses(self, kind: str, bits: float) -> bool:
        """Whether a form's bits are so large a share of what the protected context itself tells."""
        return bits >= THRESHOLD * -math.log2(self.rates[kind])

    def word(self, word: str) -> float:
        """Bits of a word as part of a name: its beginning and ending, held down by the whole word where that is common."""
        hit = self._words.get(word)
        if hit is None:
            if len(self._words) > 200_000:
                self._words.clear()
            hit = self._words[word] = self._word(word)
        return hit

    def _word(self, word: str) -> float:
        if len(word) < 2:
            return -8.0
        if _LINK.match(word):
            return 0.0
        b3, b4, e3, e4, whole = (self._bits(t, self.word_rate, 2.0) for t in word_terms(word))
        bits = (b3 + b4 + e3 + e4) / 4
        if self.counts[_bucket("w" + word.lower())] >= 12:
            bits = min(bits, whole + 1.0)
        return bits

    def han(self, place: int, c: str) -> float:
        """Bits of a Chinese character at its place in a name."""
        hit = self._han.get((place, c))
        if hit is None:
            n, p = self.counts[_bucket(f"h{c}")], self.hits[_bucket(f"h{place}{c}")]
            rate = self.han_rate
            hit = self._han[place, c] = math.log2((p + 2.0 * rate) / (n + 2.0) / rate)
        return hit

    def han_name(self, name: str) -> float:
        """Bits of characters as a whole Chinese name of their number; beside three, given names stand one place earlier or later."""
        shift = {2: 1, 4: -1}.get(len(name), 0)
        bits = self.han(0, name[0]) + self.han_lengths[len(name)]
        for k, c in enumerate(name[1:], 1):
            bits += max(self.han(k, c), self.han(k + shift, c)) if shift and k + shift > 0 else self.han(k, c)
        return bits


def find_names(body: str, d: Disclosure) -> list[tuple[int, int, float]]:
    """Spans of whole names in a text whose other mentions are blanked out."""
    out: list[tuple[int, int, float]] = []
    slots = {a for a, _ in name_slots(body)}
    # Most texts have no word that could be of a name.
    telling = slots or any(d.word(w) >= NAME_WORD for w in set(_WORD.findall(body)))
    words = [(*m.span(), m.group()) for m in _WORD.finditer(body)] if telling else []
    bits = [d.word(w) + (d.word_cue if a in slots and not _LINK.match(w) else 0.0) for a, _, w in words]
    done = 0
    for k in [i for i, x in enumerate(bits) if x >= NAME_WORD]:
        a, b, w = words[k]
        if k < done:
            continue
        end, total, n, j = b, bits[k], 1, k + 1
        while j < len(words):
            gap = body[words[j - 1][1] : words[j][0]]
            link = bool(_LINK.match(words[j][2]))
            joined = gap == " " or (gap == ", " and n == 1 and j == k + 1 and not link)
            if not joined:
                break
            if link:
                j += 1
                continue
            # Where no capital shows it, a third word must be a name by itself: what follows a name is learnt from cues too.
            if bits[j] < (NAME_ALONE if n > 1 and "஀" <= words[j][2][0] <= "௿" else NAME_WORD):
                break
            end, total, n = words[j][1], total + bits[j], n + 1
            j += 1
        tamil = "஀" <= w[0] <= "௿"
        short = _INITIAL.search(body[max(0, a - 4) : a])
        if short and bits[k] >= NAME_ALONE - 1.5:
            # An initial and one word are a whole name.
            a, n, total = a - (short.end() - short.start()), max(n, 2), total + 2
        if n >= 2 and total >= 2 * NAME_WORD + 1 or n == 1 and bits[k] >= NAME_ALONE and (tamil or a in slots):
            out.append((a, end, total))
            done = j
    best: list[tuple[int, int, float]] = []
    cued = dict(han_slots(body))
    for m in _HAN2.finditer(body):
        at = m.start()
        if d.han(0, body[at]) < 4.0:
            continue
        run, total, end = _HAN_RUN.match(body, at, at + HAN_LENGTHS[-1]).end(), -math.inf, at
        for n in HAN_LENGTHS:
            if at + n > run:
                break
            bits = d.han_name(body[at : at + n]) + (d.han_cue if cued.get(at) in (-1, at + n) else 0.0)
            if bits > total:
                total, end = bits, at + n
        if total >= NAME_HAN:
            if best and at < best[-1][1]:
                if total > best[-1][2]:
                    best[-1] = (at, end, total)
            else:
                best.append((at, end, total))
    return out + best


def mentions(text: str | None, d: Disclosure, spans: list[tuple[int, int, str]] | None = None) -> list[tuple[int, int, str, float]]:
    """Mentions of a text as (start, end, kind, bits) in order of place; ``spans`` are its forms where they are known."""
    if not text:
        return []
    spans = structured(text) if spans is None else spans
    out = [(a, b, kind, bits) for a, b, kind in spans if d.discloses(kind, bits := d.form(kind, text[a:b]))]
    out += [(a, b, "name", bits) for a, b, bits in find_names(masked(text, [x[:3] for x in out]), d)]
    return sorted(out)


def redact(text: str | None, found: list[tuple[int, int, str, float]]) -> str | None:
    """The text with a typed placeholder in the place of every mention."""
    if text is None:
        return None
    out, at = [], 0
    for a, b, kind, _ in found:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def learned(seen: DataFrame) -> Disclosure:
    """The disclosure that the counts of ``observed`` tell; at most 2**BITS + 2**FORM_BITS + 7 rows reach the driver."""
    return Disclosure.of((r.term, r.n, r.n_protected) for r in count_terms(seen).collect())


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Disclosure:
    """Count terms over all documents."""
    return learned(observed(df, id_col, text_col))


FOUND = "id long, mentions array<struct<pos:long,end:long,kind:string,bits:double,entity:long>>, clean_text string, text_key long"


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def entity_key(kind: str, span: str) -> int:
    """Key of the entity that a mention names: its kind, letters and digits, without case."""
    return _key(kind + ":" + "".join(c for c in span.translate(_WIDE).casefold() if c.isalnum()))


def _found(pdf: pd.DataFrame, disclosure: Disclosure) -> pd.DataFrame:
    known = pdf["spans"] if "spans" in pdf else [None] * len(pdf)
    found = [
        mentions(t, disclosure, None if s is None else [(x["pos"], x["end"], x["kind"]) for x in s])
        for t, s in zip(pdf["text"], known)
    ]
    return pd.DataFrame({
        "id": pdf["id"],
        "mentions": [[{"pos": a, "end": b, "kind": k, "bits": x, "entity": entity_key(k, t[a:b])} for a, b, k, x in f] for t, f in zip(pdf["text"], found)],
        "clean_text": [redact(t, f) for t, f in zip(pdf["text"], found)],
        "text_key": [_key(t or "") for t in pdf["text"]],
    })


def sanitise(df: DataFrame, disclosure: Disclosure, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``mentions`` (place, end, kind, bits, entity), ``clean_text`` and ``text_key`` of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _found(pdf, disclosure)

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return spread(src, "id").mapInPandas(run, FOUND)


def sanitised(seen: DataFrame, disclosure: Disclosure) -> DataFrame:
    """The same of the documents of ``observed``, whose forms are known."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _found(pdf, disclosure)

    return seen.where("terms is null").select("id", "text", "spans").mapInPandas(run, FOUND)


def revealing_terms(found: DataFrame, disclosure: Disclosure) -> DataFrame:
    """``id``, ``term``: the words of a document that disclose an entity named in it.

    A word t discloses an entity c when their mutual information reaches
    ``DISCLOSING`` of the entity's own, in at least ``SUPPORT`` different texts.
    With n texts of c among N this needs n(t) <= n ** a * N ** (1 - a), so only
    words so rare are paired with entities; their counts are those of the
    hashed words, which may be too large but never too small.  ``found`` should
    be staged, since it is read twice.
    """
    total = max(1, found.agg(F.count_distinct("text_key").alias("n")).first().n)
    named = found.select("id", "text_key", F.explode(F.array_distinct(F.transform("mentions", lambda m: m["entity"]))).alias("entity"))
    entities = named.groupBy("entity").agg(F.count_distinct("text_key").alias("n")).where(F.col("n") >= SUPPORT)
    docs = named.join(entities, "entity").join(found.select("id", "clean_text"), "id")
    schema = "id long, text_key long, entity long, n long, term string, n_term long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, text_key, entity, n, text in zip(pdf["id"], pdf["text_key"], pdf["entity"], pdf["n"], pdf["clean_text"]):
                most = n**DISCLOSING * total ** (1 - DISCLOSING)
                for w in set(_WORD.findall(_PLACEHOLDER.sub(" ", text).lower())):
                    count = int(disclosure.counts[_bucket("w" + w)])
                    if len(w) > 3 and SUPPORT <= count <= most:
                        out.append((key, text_key, entity, n, w, count))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])

    pairs = stage(docs.select("id", "text_key", "entity", "n", "clean_text").mapInPandas(run, schema), "terms")
    both = pairs.groupBy("entity", "term", "n", "n_term").agg(F.count_distinct("text_key").alias("both"))
    bits = F.log2(F.lit(float(total)) * F.col("both") / (F.col("n") * F.col("n_term")))
    telling = both.where((F.col("both") >= SUPPORT) & (bits >= DISCLOSING * F.log2(F.lit(float(total)) / F.col("n"))))
    return pairs.join(telling.select("entity", "term"), ["entity", "term"]).select("id", "term").distinct()


def generalised(found: DataFrame, disclosure: Disclosure) -> DataFrame:
    """The rows of ``found`` with the revealing words of each text as ``[TERM]``, and their number in ``n_terms``."""
    held = stage(found, "mentions")
    terms = revealing_terms(held, disclosure).groupBy("id").agg(F.array_sort(F.collect_set("term")).alias("_terms"))
    masked_ = F.aggregate("_terms", F.col("clean_text"), lambda text, t: F.regexp_replace(text, F.concat(F.lit(r"(?iU)(?<![\w\[])"), t, F.lit(r"(?![\w\]])")), F.lit("[TERM]")))
    joined = held.join(terms, "id", "left")
    return joined.withColumn("clean_text", F.when(F.col("_terms").isNull(), F.col("clean_text")).otherwise(masked_)).withColumn("n_terms", F.coalesce(F.size("_terms"), F.lit(0))).drop("_terms")
