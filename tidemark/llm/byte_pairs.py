"""Byte-level BPE encoding by dynamic programming over byte prefixes, and decoding.

A sequence of tokens is the encoding of its bytes exactly if every two neighbours are the
encoding of theirs. So every prefix of a text has one valid last token, which depends on
the prefixes before it only: the longest token ending there that may follow the last token
of what is left. A table of these last tokens encodes in time linear in the text, grows by
appending, and after an edit needs to be filled anew only until it agrees with what it held.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow

#: Pieces, of so many bytes at most, whose ids a task remembers, and pairs of tokens; it forgets all when there are more.
MEMORY, LONGEST, PAIRS = 400_000, 48, 1_000_000
#: Pieces of a long text handled at once.
PIECES = 1 << 16
#: How many characters after its end a match of a split pattern may depend on.
LOOK = 3


class _Pairs(dict):
    """Which two tokens can be adjacent, worked out when first asked for; keys hold both."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self._of = vocabulary

    def __missing__(self, key: int) -> bool:
        left, right = key >> 32, key & 0xFFFFFFFF
        if len(self) >= PAIRS:
            self.clear()
        self[key] = valid = self._of.merged(self._of.tokens[left] + self._of.tokens[right]) == [left, right]
        return valid


class Vocabulary:
    """Ranks of byte strings, which of them can be adjacent, and which ends where in a text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks), default=1)
        self.adjacent = _Pairs(self)
        self._machine = ahocorasick.Automaton()
        for token, rank in ranks.items():
            # A token that merging its own bytes does not give never occurs, but as a piece by itself.
            if self.merged(token) == [rank]:
                self._machine.add_word(token.decode("latin-1"), (rank, len(token)))
        if ranks:
            self._machine.make_automaton()

    def merged(self, data: bytes) -> list[int]:
        """The definition: join the neighbours of lowest rank, leftmost first, until none are left. For a few bytes only."""
        rank, parts = self.ranks.get, [data[i : i + 1] for i in range(len(data))]
        never = len(self.tokens)
        ranks = [rank(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) < never:
            at = ranks.index(least)
            parts[at : at + 2] = [self.tokens[least]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], never)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], never)
        return [self.ranks[part] for part in parts]

    def ending(self, data: bytes) -> Iterator[tuple[int, tuple[int, int]]]:
        """Place, token and length of every token in ``data``, by its end, longest first."""
        return self._machine.iter(data.decode("latin-1"))


class PrefixTable:
    """The last token of every prefix of some bytes."""

    __slots__ = ("_vocabulary", "data", "last")

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self._vocabulary, self.data = vocabulary, data
        self.last: list[int] = []
        self._fill(data, self.last)

    def _fill(self, data: bytes, last: list[int], settled: int | None = None) -> None:
        """Go on with last tokens where ``last`` ends.

        Stops early where all last tokens that later ones depend on are those of ``self``,
        whose bytes from ``settled`` on are the same as those at the end of ``data``.
        """
        adjacent, longest, at = self._vocabulary.adjacent, self._vocabulary.longest, len(last)
        base = max(0, at - longest + 1)
        shift, same = len(self.data) - len(data), 0
        for end, (token, length) in self._vocabulary.ending(data[base:] if base else data):
            if end + base != at:
                continue  # its last token is found already
            if length > at or adjacent[last[at - length] << 32 | token]:
                last.append(token)
                if settled is not None:
                    same = same + 1 if at >= settled and self.last[at + shift] == token else 0
                    if same == longest:
                        return
                at += 1
        if at != len(data):
            raise ValueError(f"the vocabulary has no token for byte {data[at]}")

    def append(self, data: bytes) -> None:
        self.data += data
        self._fill(self.data, self.last)

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Put ``data`` in place of a range; returns how many prefixes were encoded again."""
        edited, last = self.data[:start] + data + self.data[stop:], self.last[:start]
        self._fill(edited, last, start + len(data))
        reached, shift = len(last), len(self.data) - len(edited)
        self.data, self.last = edited, last + self.last[reached + shift :]
        return reached - start

    def ids(self) -> list[int]:
        tokens, out, at = self._vocabulary.tokens, [], len(self.last)
        while at:
            out.append(self.last[at - 1])
            at -= len(tokens[out[-1]])
        return out[::-1]


class Encoder:
    """Texts to ids: every match of the pattern by itself."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self._known: dict[str, bytes] = {}

    def piece(self, data: bytes) -> list[int]:
        whole = self.vocabulary.ranks.get(data)
        return [whole] if whole is not None else PrefixTable(self.vocabulary, data).ids()

    def _packed(self, pieces: list[str]) -> bytes:
        known = self._known
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            pass
        if len(known) >= MEMORY:
            known.clear()
        long = {}
        for piece in {p for p in pieces if p not in known}:
            data = piece.encode()
            (known if len(data) <= LONGEST else long)[piece] = np.array(self.piece(data), "<u4").tobytes()
        return b"".join([long[p] if p in long else known[p] for p in pieces])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(text) <= PIECES:
            return self._packed(self.pattern.findall(text))
        found, packed = (m[0] for m in self.pattern.finditer(text)), []
        while pieces := list(islice(found, PIECES)):
            packed.append(self._packed(pieces))
        return b"".join(packed)

    def decode(self, packed: bytes) -> bytes:
        """The bytes that ids stand for; an id without a token raises."""
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


class EncodedText:
    """A text and its ids that follow appends and edits, of which only what lies near is encoded again."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self._encoder, self.text = encoder, ""
        self._starts: list[int] = []
        self._tables: list[PrefixTable] = []
        self.replace(0, 0, text)

    def append(self, text: str) -> int:
        return self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, stop: int, text: str) -> int:
        """Put ``text`` in place of a range of characters; returns how many prefixes of pieces were encoded again."""
        edited, shift = self.text[:start] + text + self.text[stop:], len(text) - (stop - start)
        # Pieces that end well before the edit stay, and so do those from the first one that begins behind it as before.
        first = max(0, bisect_left(self._starts, start - LOOK) - 1)
        at = self._starts[first] if self._starts else 0
        old = {s + shift: i for i, s in enumerate(self._starts) if i >= first and s >= stop}
        pieces, kept = [], len(self._starts)
        for match in self._encoder.pattern.finditer(edited, at):
            if match.start() >= start + len(text) and match.start() in old:
                kept = old[match.start()]
                break
            pieces.append((match.start(), match[0].encode()))
        before, tables = self._tables[first:kept], []
        work = sum(self._renewed(tables, before[i] if i < len(before) else None, data) for i, (_, data) in enumerate(pieces))
        self.text = edited
        self._starts = [*self._starts[:first], *(s for s, _ in pieces), *(s + shift for s in self._starts[kept:])]
        self._tables = [*self._tables[:first], *tables, *self._tables[kept:]]
        return work

    def _renewed(self, tables: list[PrefixTable], table: PrefixTable | None, data: bytes) -> int:
        """Add the table of ``data``, made from one of similar bytes if there is one."""
        if table is None:
            tables.append(PrefixTable(self._encoder.vocabulary, data))
            return len(data)
        tables.append(table)
        front = _common(table.data, data)
        back = min(_common(table.data[::-1], data[::-1]), min(len(table.data), len(data)) - front)
        if len(table.data) == len(data) == front:
            return 0
        return table.replace(front, len(table.data) - back, data[front : len(data) - back])

    def ids(self) -> list[int]:
        ranks = self._encoder.vocabulary.ranks
        return [i for t in self._tables for i in ([ranks[t.data]] if t.data in ranks else t.ids())]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 byte strings and their ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(Vocabulary(read_ranks(path)), pattern)


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            ids = pa.array([encoder.encode(text.as_py() or "") for text in batch.column("text")], pa.large_binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids.cast(pa.binary())], names=["doc_id", "ids"])

    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            ids = batch.column("ids")
            decoded = pa.array([None if i is None else encoder.decode(i) for i in (v.as_py() for v in ids)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, decoded], names=["doc_id", "ids", "decoded"])

    return run


def encode_texts(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id`` and ``ids``, little-endian unsigned 32-bit integers in one binary value.

    ``ranks`` is the path of a rank file that every executor has, ``pattern`` splits a text
    into the pieces that are encoded one by one. Null and empty texts have no ids; null and
    repeated doc_ids are rows of their own; an empty table gives an empty one; other columns
    are ignored. Whole texts are encoded in time linear in their length; a task remembers a
    bounded number of short pieces.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(rows, _encode(ranks, pattern), "doc_id long, ids binary")


def decode_ids(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``, the bytes that the ids stand for; null ids give null, unknown ids raise."""
    return in_arrow(encoded.select("doc_id", "ids"), _decode(ranks, pattern), "doc_id long, ids binary, decoded binary")
