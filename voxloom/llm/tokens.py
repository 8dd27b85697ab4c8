"""Problem 8: encoding of the whole corpus with a public byte-level BPE tokenizer.

Method: prefix dynamic programming.  For each byte prefix of a piece there is
exactly one token that can come last in the prefix's encoding: the one that
ends there and stands validly behind the last token of the prefix before it.
Storing these last tokens gives the encoding by walking back, lets bytes be
appended exactly, and confines the work of an edit to its surroundings.

Null and empty texts give an empty list; strings that look like special tokens
are ordinary text.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.lm import TOKENIZER_DIR
from voxloom.session import spread

# Fixed value: how byte-level BPE vocabularies of this family cut a text into pieces.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "byte_bpe_50k.tiktoken"
_CACHE = 400_000
#: Pieces longer than this are not kept.
_KEEP = 64


class PrefixEncoder:
    """Byte-level BPE by last tokens of prefixes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        #: Every ending of a token, so that a search backwards from a place knows when to stop.
        self.endings = {b[k:] for b in ranks for k in range(len(b))}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}

    @classmethod
    def load(cls, path: str | None = None) -> PrefixEncoder:
        with open(path or os.path.join(TOKENIZER_DIR, VOCABULARY), "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE: join the pair of lowest rank, leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def follows(self, first: int, second: int) -> bool:
        """Whether the two tokens stay as they are when their bytes stand together."""
        key = (first, second)
        hit = self._pairs.get(key)
        if hit is None:
            if len(self._pairs) > _CACHE:
                self._pairs.clear()
            hit = self._pairs[key] = self.merge(self.bytes_of[first] + self.bytes_of[second]) == [first, second]
        return hit

    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> None:
        """Store the last token of each further prefix of ``data``; ``last[i]`` is that of ``data[:i+1]``."""
        ranks, endings = self.ranks, self.endings
        for end in range(len(last) + 1, (upto or len(data)) + 1):
            found = -1
            start = end - 1
            while start >= 0 and (part := data[start:end]) in endings:
                token = ranks.get(part)
                if token is not None and (start == 0 or self.follows(last[start - 1], token)):
                    found = token
                    break
                start -= 1
            last.append(found)

    def walk(self, last: list[int]) -> list[int]:
        """The encoding that the last tokens tell, read from the end."""
        out, at = [], len(last)
        while at > 0:
            token = last[at - 1]
            out.append(token)
            at -= len(self.bytes_of[token])
        return out[::-1]

    def piece(self, text: str) -> tuple[int, ...]:
        """The ids of one piece."""
        hit = self._pieces.get(text)
        if hit is not None:
            return hit
        data = text.encode("utf-8", "replace")
        whole = self.ranks.get(data)
        if whole is not None:
            ids: tuple[int, ...] = (whole,)
        else:
            last: list[int] = []
            self.extend(data, last)
            ids = tuple(self.walk(last))
        if len(text) <= _KEEP:
            if len(self._pieces) > _CACHE:
                self._pieces.clear()
            self._pieces[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; none for a null or empty one."""
        out: list[int] = []
        for p in PIECES.findall(text) if text else ():
            out.extend(self.piece(p))
        return out


PIECES = regex.compile(PATTERN)


class Piece:
    """One piece of a text: its characters, ids, and for a long one the last token of each of its byte prefixes."""

    __slots__ = ("size", "ids", "last")

    def __init__(self, size: int, ids: tuple[int, ...], last: list[int] | None):
        self.size, self.ids, self.last = size, ids, last


#: Pieces of a block of an ``EncodedText``.
_BLOCK = 256


class EncodedText:
    """A text with its encoding, kept up to date under appends and edits.

    A piece depends on nothing but the characters from its start to a little
    behind its end, so a change is encoded again from the piece before it until
    the pieces meet the old ones.  In a long piece the last tokens of the byte
    prefixes before the change stay as they are and only later ones are found
    anew, so an append costs what is appended.  Pieces stand in blocks, so an
    edit finds its place and moves what follows without a pass over all pieces.
    """

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text = encoder, text
        self.encoded = self.bytes_encoded = 0
        self.blocks: list[list[Piece]] = []
        self.sizes: list[int] = []
        self._replace(0, 0, [self._piece(m.group(), None, 0) for m in PIECES.finditer(text)])

    def _piece(self, chars: str, old: Piece | None, same: int) -> Piece:
        """A piece, from an old one that begins alike for ``same`` bytes."""
        self.encoded += 1
        if len(chars) <= _KEEP:
            self.bytes_encoded += len(chars)
            return Piece(len(chars), self.encoder.piece(chars), None)
        data = chars.encode("utf-8", "replace")
        last = old.last[:same] if old is not None and old.last is not None else []
        self.bytes_encoded += len(data) - len(last)
        self.encoder.extend(data, last)
        return Piece(len(chars), tuple(self.encoder.walk(last)), last)

    def _replace(self, first: int, stop: int, pieces: list[Piece]) -> None:
        """Put pieces in the place of whole blocks."""
        cut = [pieces[k : k + _BLOCK] for k in range(0, len(pieces), _BLOCK)]
        self.blocks[first:stop] = cut
        self.sizes[first:stop] = [sum(p.size for p in c) for c in cut]

    def append(self, more: str) -> None:
        """Add text at the end."""
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in the place of ``text[start:end]``."""
        # The block of the change, and one before it: a run of white space is cut by what follows it.
        at, block = 0, 0
        while block < len(self.blocks) - 1 and at + self.sizes[block] < start:
            at += self.sizes[block]
            block += 1
        first = max(0, block - 1)
        at -= self.sizes[first] if first < block else 0
        held, stop, begins = [], first, []
        place = at

        def take() -> bool:
            """Take up the next block; false where there is none."""
            nonlocal stop, place
            if stop >= len(self.blocks):
                return False
            for p in self.blocks[stop]:
                held.append(p)
                begins.append(place)
                place += p.size
            stop += 1
            return True

        while (not held or place < end) and take():
            pass
        keep = max(0, next((k for k, p in enumerate(held) if begins[k] + p.size >= start), len(held)) - 2)
        begin = begins[keep] if keep < len(held) else at
        shift = len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        self.encoded = self.bytes_encoded = 0
        fresh, k = [], keep
        for m in PIECES.finditer(self.text, begin):
            # Old pieces that end before this one begins, and the first that begins with it or later.
            while True:
                while k < len(held) and (begins[k] < m.start() if begins[k] <= start else begins[k] + shift < m.start()):
                    k += 1
                if k < len(held) or not take():
                    break
            if k < len(held) and begins[k] > end and begins[k] + shift == m.start():
                break
            alike = k < len(held) and begins[k] == m.start() <= start
            same = len(self.text[m.start() : min(start, m.end())].encode("utf-8", "replace")) if alike else 0
            fresh.append(self._piece(m.group(), held[k] if alike else None, same))
        else:
            # The text ended before it met an old piece: none of them stays.
            while take():
                pass
            k = len(held)
        self._replace(first, stop, [*held[:keep], *fresh, *held[k:]])

    @property
    def ids(self) -> list[int]:
        return [i for block in self.blocks for p in block for i in p.ids]


_ENCODER: dict[str, PrefixEncoder] = {}


def _encoder(path: str | None) -> PrefixEncoder:
    """One encoder for each worker process."""
    key = path or ""
    if key not in _ENCODER:
        _ENCODER[key] = PrefixEncoder.load(path)
    return _ENCODER[key]


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), path: str | None = None, rows: int = 500) -> DataFrame:
    """The id, the columns of ``keep`` and ``ids`` (array of int) of every row; ``rows`` go back to the JVM at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids = pa.array([encoder.encode(t) for t in part.column("__text").to_pylist()], type=pa.list_(pa.int32()))
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*columns, ids], names=[*part.schema.names[:-1], "ids"])

    src = df.select(id_col, *keep, F.col(text_col).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return spread(src, id_col).mapInArrow(run, f"{fields}, ids array<int>")


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """The id, the columns of ``keep`` and ``n_tokens`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            n = pa.array([len(encoder.encode(t)) for t in batch.column("__text").to_pylist()], type=pa.int64())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, n], names=[*batch.schema.names[:-1], "n_tokens"])

    src = df.select(id_col, *keep, F.col(text_col).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return spread(src, id_col).mapInArrow(run, f"{fields}, n_tokens long")
