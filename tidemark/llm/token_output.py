"""Token ids as binary segments with Elias-Fano document boundaries.

A segment holds the ids of consecutive documents, in ascending ``doc_id`` order, one after
the other (two bytes each where the vocabulary allows, else four), and two Elias-Fano lists:
where each document ends, and the documents' ids. Segments are the rows of a Parquet
dataset, so that Spark's committer, not the tasks, decides what is part of the output.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import chunks, in_arrow, store, texts_of
from tidemark.llm.elias_fano import EliasFano, encode
from tidemark.session import shared_path

END = 2
#: Ids in a segment, beyond which a new one begins; one longer document has a segment of its own.
SEGMENT = 1 << 20
#: Words, of so many bytes at most, whose ids a task remembers; then it forgets them all and starts again.
MEMORY, LONGEST = 600_000, 64
#: Bytes of texts encoded together.
TOGETHER = 4 << 20

# The split into words that byte-level vocabularies of this kind are made with (fixed by the tokenizer's file), by kinds of
# letters: '(?:[stmd]|re|ve|ll)| ?[letters]+| ?[numbers]+| ?[signs]+|\s+(?!\S)|\s+, written out for Latin letters; texts
# with other characters go to the tokenizer whole.
_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
_OTHER = r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-\u024f\u2010-\u2027\u2030-\u205e]"
_FOREIGN, _BLANK, _LETTER, _NUMBER, _SIGN = range(5)


def _kind(char: str) -> int:
    kinds = ((_OTHER, _FOREIGN), (r"\s", _BLANK), (f"[{_LETTERS}]", _LETTER), (f"[{_NUMBERS}]", _NUMBER))
    return next((kind for pattern, kind in kinds if re.match(pattern, char)), _SIGN)


#: The kind of each character up to U+207F, and of each byte that is a character by itself.
_KINDS = np.array([_kind(chr(c)) for c in range(0x2080)], np.uint8)
_BYTES = np.where(np.arange(256) < 0x80, _KINDS[:256], _FOREIGN).astype(np.uint8)


def _kinds(data: np.ndarray) -> np.ndarray:
    """Each byte's kind, that of the character it is part of; foreign where a character is neither Latin nor a common sign."""
    kinds = _BYTES[data]
    high = np.flatnonzero(data >= 0x80)
    if not len(high):
        return kinds
    follows = np.append((data[1:] & 0xC0) == 0x80, [False, False, False])
    lead = data[high]
    for at, more in ((high[(lead >= 0xC2) & (lead <= 0xC9)], 1), (high[lead == 0xE2], 2)):
        for i in range(more):
            at = at[follows[at + i]]
        if more == 1:
            code = (data[at] & 0x1F).astype(np.int64) << 6 | data[at + 1] & 0x3F
        else:
            at = at[data[at + 1] <= 0x81]
            code = 0x2000 | (data[at + 1] & 0x3F).astype(np.int64) << 6 | data[at + 2] & 0x3F
        for i in range(more + 1):
            kinds[at + i] = _KINDS[code]
    return kinds


def _word_starts(data: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the words of the split begin in some texts laid end to end; every byte is part of a word."""
    if not len(data):
        return np.empty(0, np.int64)
    blank, first = kinds == _BLANK, offsets[:-1][offsets[:-1] < len(data)]
    change = kinds[1:] != kinds[:-1]
    change[first[first > 0] - 1] = False
    begins = np.zeros(len(data), bool)
    # A word takes the space before it, so that of blanks before a word the last begins a new one.
    begins[1:] = change & (data[:-1] != 0x20)
    begins[:-1] |= change & blank[:-1]
    begins[first] = True
    # Endings such as 's are words of their own.
    at = np.flatnonzero(begins & (data == 0x27))
    if len(at):
        ends = offsets[np.searchsorted(offsets, at, "right")]
        after = [np.where(at + i < ends, data[np.minimum(at + i, len(data) - 1)], 0) for i in (1, 2)]
        short = np.isin(after[0], np.frombuffer(b"stmd", np.uint8))
        long = np.isin(after[0] * np.int64(256) + after[1], [ord(x) * 256 + ord(y) for x, y in ("re", "ve", "ll")])
        begins[at[short | long] + 1] = False
        for picked, length in ((short, 2), (long, 3)):
            begins[(at + length)[picked & (at + length < ends)]] = True
    return np.flatnonzero(begins)


class _Encoder:
    """Texts to packed ids, the same as the tokenizer gives for whole texts.

    The tokenizer encodes each word of its split by itself, so the distinct words of some
    texts are looked up once each, and those seen before are not encoded again. New words
    with a space in front are encoded together: the ids of a word begin where an id's own
    text begins with a space.
    """

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer, self._kind = Tokenizer.from_file(path), kind
        space = self._tokenizer.pre_tokenizer.pre_tokenize_str(" ")[0][0]
        self._begins = np.zeros(self._tokenizer.get_vocab_size(), bool)
        self._begins[[i for token, i in self._tokenizer.get_vocab().items() if token.startswith(space)]] = True
        # Added tokens are cut out of a text before it is split into words.
        self._cut_out = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        # The place of each known word in a list of words, where the ids of each begin, and the ids.
        self._known: dict[bytes, int] = {}
        self._firsts, self._flat = np.zeros(1, np.int64), np.empty(0, self._kind)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        # The fast form leaves out where in the text each id stands.
        return [np.array(e.ids, self._kind) for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[bytes]) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
        """The words in another order, their ids, and how many each has."""
        spaced, others = [], []
        for w in words:
            (spaced if 1 < len(w) <= LONGEST and w[0] == 0x20 and not w[1:2].isspace() else others).append(w)
        ids, sizes = [], []
        if spaced:
            ids = self._ids([b"".join(spaced).decode()])
            ends = np.append(np.flatnonzero(self._begins[ids[0]]), len(ids[0]))
            if len(ends) != len(spaced) + 1:
                raise ValueError("the tokenizer joins words across spaces")
            sizes.append(np.diff(ends))
        rest = self._ids([w.decode() for w in others])
        return spaced + others, ids + rest, np.concatenate([*sizes, np.array([len(x) for x in rest], np.int64)])

    def _learn(self, words: list[bytes]) -> None:
        words, ids, sizes = self._encode_words(words)
        self._known.update(zip(words, range(len(self._firsts) - 1, len(self._firsts) - 1 + len(words)), strict=True))
        self._firsts = np.concatenate([self._firsts, self._firsts[-1] + np.cumsum(sizes)])
        self._flat = np.concatenate([self._flat, *ids])

    def _split(self, data: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The ids of texts without foreign characters."""
        starts = _word_starts(data, kinds, offsets)
        bounds = np.append(starts, len(data))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self._known) > MEMORY:
            self._forget()
        new = [w for w in distinct if w not in self._known]
        if new:
            self._learn(new)
        at = np.fromiter(map(self._known.__getitem__, distinct), np.int64, len(distinct))
        firsts = self._firsts[at]
        sizes = (self._firsts[at + 1] - firsts)[index := coded.indices.to_numpy()]
        before = np.append(0, np.cumsum(sizes))
        packed = self._flat[np.repeat(firsts[index] - before[:-1], sizes) + np.arange(before[-1])].tobytes()
        for w in new:
            if len(w) > LONGEST:
                del self._known[w]
        ends = (before[np.searchsorted(starts, offsets)] * self._flat.itemsize).tolist()
        return [packed[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        whole = np.zeros(len(texts), bool)
        for token in self._cut_out:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        data, offsets = texts_of(texts)
        for start, stop in chunks(offsets, TOGETHER):
            part, ends, own = data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start], whole[start:stop]
            kinds = _kinds(part)
            own[np.searchsorted(ends, np.flatnonzero(kinds == _FOREIGN), "right") - 1] = True
            if own.any():
                kept = np.repeat(~own, np.diff(ends))
                part, kinds, ends = part[kept], kinds[kept], np.append(0, np.cumsum(np.diff(ends)[~own]))
            split = iter(self._split(part, kinds, ends))
            for row in range(start, stop):
                yield self._ids([texts[row].as_py()])[0].tobytes() if whole[row] else next(split)


@lru_cache(maxsize=1)
def _encoder(path: str, kind: str) -> _Encoder:
    return _Encoder(path, kind)


_SEGMENT = "part int, number int, first long, n_docs long, n_tokens long, width int, ids binary, ends binary, docs binary, null_docs long"


def _write(path: str, end: int, kind: str, most: int):
    width = np.dtype(kind).itemsize
    stop = np.array([end], kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = _encoder(path, kind), 0
        names: list[int | None] = []
        held: list[bytes] = []
        size, part = 0, 0

        def segment() -> pa.RecordBatch:
            known = np.array([name for name in names if name is not None], np.int64)
            lengths = np.array([len(ids) // width for ids in held], np.uint64)
            row = {
                "part": [part], "number": [number], "first": [int(known[0]) if len(known) else None], "n_docs": [len(held)], "n_tokens": [int(lengths.sum())], "width": [width],
                "ids": [b"".join(held)], "ends": [encode(np.cumsum(lengths))],
                # Ids as steps from the least long, so that negative ones can be stored too.
                "docs": [encode(known.view(np.uint64) ^ np.uint64(1 << 63))], "null_docs": [len(held) - len(known)],
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

        for batch in batches:
            for name, packed, at in zip(batch.column("doc_id"), encoder.encode(batch.column("text")), batch.column("part"), strict=True):
                ids = packed + stop
                if held and size + len(ids) > most * width:
                    yield segment()
                    names, held, size, number = [], [], 0, number + 1
                part = at.as_py()
                names.append(name.as_py())
                held.append(ids)
                size += len(ids)
        if held:
            yield segment()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, target: str, end: int = END, ids: int = 50_257, segment: int = SEGMENT) -> None:
    """Write the ids of every whole text, ``end`` after each, to ``target`` in ascending ``doc_id`` order.

    Null texts are empty and hold ``end`` alone; null ids come first; rows that repeat an id
    stay side by side, in the order of their texts. Other columns are ignored. An empty table writes an empty dataset.
    ``ids`` is the size of the vocabulary.
    """
    kind = "<u2" if max(ids - 1, end) < 2**16 else "<u4"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    in_arrow(rows.withColumn("part", F.spark_partition_id()), _write(tokenizer, end, kind, segment), _SEGMENT).write.parquet(target)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], "<u2" if row["width"] == 2 else "<u4").astype("<u4")
            ends = EliasFano(row["ends"]).values().astype(np.int64)
            starts = np.append(0, ends[:-1])
            known = (EliasFano(row["docs"]).values() ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None] * row["null_docs"] + known.tolist(), pa.int64()),
                    pa.array(starts + row["start"], pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_tokens(segments: DataFrame) -> DataFrame:
    """Per document of a written dataset: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    Offsets of segments are summed in two steps, over a part's segments and over the parts,
    so no task sees all segments.
    """
    sizes = segments.select("part", "number", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    parts = parts.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part")
    # One small row a segment, of a size that is known once it is stored: segments stay where they are as long as it can be broadcast.
    starts = store(sizes.select("part", "number", (F.col("part_start") + F.col("inside")).alias("start")), "token-starts")
    full = segments.select("part", "number", "width", "ids", "ends", "docs", "null_docs").join(starts, ["part", "number"])
    return in_arrow(full.select("start", "width", "ids", "ends", "docs", "null_docs"), _documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_dataset(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Write to the shared folder, read back, and describe each document from the files."""
    spark = docs.sparkSession
    target = shared_path(spark, "llm-tokens")
    write_tokens(docs, tokenizer, target, end)
    return read_tokens(spark.read.schema(_SEGMENT).parquet(target))
