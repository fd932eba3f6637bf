"""Benchmark decontamination with an Aho-Corasick automaton over the windows of the test items."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from tidemark.llm.common import added, in_arrow, store

WINDOW = 13
#: Bytes of benchmark text in one automaton, which each task builds for itself: windows overlap, so it takes some 500 bytes for each.
AUTOMATON_BYTES = 512 << 10

#: Every byte that is no part of a word ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` becomes a space, after A-Z became a-z.
_FOLD = bytes(32 if b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128 else b + 32 * (65 <= b <= 90) for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normalised(text: str | None) -> str:
    """The words in lower case with one space around each, a character per UTF-8 byte."""
    words = (text or "").encode("utf-8", "replace").translate(_FOLD).split(b" ")
    return f" {b' '.join(filter(None, words)).decode('latin-1')} "


def windows_of(text: str | None, size: int = WINDOW) -> set[str]:
    """All runs of ``size`` words, or the whole of a shorter text; none if it has no words."""
    words = normalised(text).split(" ")[1:-1] if normalised(text).strip(" ") else []
    return {f" {' '.join(words[i : i + size])} " for i in range(max(1, len(words) - size + 1))} if words else set()


@lru_cache(maxsize=2)
def _automaton(items: tuple[tuple[str, str | None], ...], size: int) -> ahocorasick.Automaton:
    """Windows to their length in words and their items; kept for the later batches of a Python worker."""
    of: dict[str, list[str]] = defaultdict(list)
    for item, text in items:
        for window in windows_of(text, size):
            of[window].append(item)
    machine = ahocorasick.Automaton()
    for window, names in of.items():
        machine.add_word(window, (window.count(" ") - 1, tuple(sorted(set(names)))))
    if of:
        machine.make_automaton()
    return machine


def scan(text: str | None, machine: ahocorasick.Automaton) -> tuple[int, np.ndarray, list[str]]:
    """Number of words, the numbers of the words hit, and the items found, in one pass over the text."""
    line = normalised(text)
    if line == "  ":
        return 0, np.empty(0, np.int64), []
    found = [(end, n, items) for end, (n, items) in machine.iter(line)] if len(machine) else []
    if not found:
        return line.count(" ") - 1, np.empty(0, np.int64), []
    gaps = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(gaps, [end for end, _, _ in found])
    change = np.zeros(len(gaps) + 1, np.int64)
    np.add.at(change, last - [n for _, n, _ in found], 1)
    np.add.at(change, last, -1)
    return len(gaps) - 1, np.flatnonzero(np.cumsum(change)[: len(gaps) - 1] > 0), sorted({item for _, _, items in found for item in items})


def original_spans(text: str, words: np.ndarray) -> list[tuple[int, int]]:
    """Character spans in the text as it is, one for each run of words hit."""
    if not len(words):
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    runs = np.split(words, np.flatnonzero(np.diff(words) != 1) + 1)
    return [(places[run[0]][0], places[run[-1]][1]) for run in runs]


def _blocks(benchmark: DataFrame, most: int) -> Iterator[tuple[tuple[str, str | None], ...]]:
    """Items in blocks of bounded size, one block in the driver at a time."""
    block: list[tuple[str, str | None]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    for item, text in rows.orderBy("item_id", "text").toLocalIterator():
        block.append(("" if item is None else item, text))
        size += len(text or "")
        if size >= most:
            yield tuple(block)
            block, size = [], 0
    yield tuple(block)


def _search(items: tuple[tuple[str, str | None], ...], window: int, names: list[str]):
    """Adds the number of words, the hits and the items found of a block of test items, in columns of these names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(items, window)
        for batch in batches:
            found = [scan(text.as_py(), machine) for text in batch.column("text")]
            columns = [pa.array([n for n, _, _ in found], pa.int64()), pa.array([h for _, h, _ in found], pa.list_(pa.int64())), pa.array([i for _, _, i in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return run


def _unused(columns: list[str], *names: str) -> list[str]:
    """Names that no column has, from those given."""
    taken = {c.lower() for c in columns}
    return [next(n for n in (name + "_" * i for i in range(len(taken) + 1)) if n.lower() not in taken) for name in names]


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        spans = [
            [{"start": a, "stop": b} for a, b in original_spans(text.as_py(), np.array(hit.as_py(), np.int64))] if len(hit) else []
            for text, hit in zip(batch.column("text"), batch.column("hits"), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "n_words", "hits", "items")] + [pa.array(spans, kind)], names=["doc_id", "n_words", "hits", "items", "spans"]
        )


def scanned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES) -> tuple[DataFrame, list[str]]:
    """All columns of ``docs`` with number of words, hits and items, as :func:`contaminated_words` describes them, and the names of these.

    An automaton holds at most ``automaton_bytes`` of items (and one item at least), so its
    size does not grow with the benchmark. A larger benchmark is searched for in several
    passes over the rows, stored once with a number; a later pass writes what it found only.
    """
    names = _unused(docs.columns, "_n_words", "_hits", "_items")
    n_words, hits, items = names
    (row,) = _unused(docs.columns, "_row")

    def searched(rows: DataFrame, block: tuple) -> DataFrame:
        return in_arrow(rows, _search(block, window, names), added(rows, **{n_words: LongType(), hits: ArrayType(LongType()), items: ArrayType(StringType())}))

    blocks = _blocks(benchmark, automaton_bytes)
    first, block = next(blocks), next(blocks, None)
    if block is None:
        return searched(docs, first), names
    rows = store(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = store(searched(rows.select(row, "text"), first).drop("text"), "contaminated")
    parts = found.where(F.size(hits) > 0).select(row, hits, items)
    while block is not None:
        more = searched(rows.select(row, "text"), block).where(F.size(hits) > 0).select(row, hits, items)
        parts = parts.unionByName(store(more, "contaminated"))
        block = next(blocks, None)
    # A row has at most one part from each pass.
    joined = parts.groupBy(row).agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in (hits, items)])
    whole = rows.join(found.select(row, n_words), row).join(joined, row, "left")
    empty = {hits: F.coalesce(hits, F.array().cast("array<bigint>")), items: F.coalesce(items, F.array().cast("array<string>"))}
    return whole.withColumns(empty).select(*docs.columns, *names), names


def contaminated_words(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``hits``, ``items``, ``spans``.

    A window is ``window`` consecutive words of an item, or all words of a shorter one. A
    document word inside any occurrence of a window is hit: ``hits`` holds its number from 0.
    ``items`` lists, sorted as strings, the items with occurring windows, and ``spans`` the
    character ranges hit in the original text. Null and empty texts have no words; items
    without words have no windows; a null item id counts as an empty string; items that
    repeat an id are one item; repeated documents are rows of their own; an empty table on
    either side hits nothing. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, names = scanned(rows, benchmark, window, automaton_bytes)
    rows = rows.select("doc_id", "text", *[F.col(name).alias(c) for name, c in zip(names, ("n_words", "hits", "items"), strict=True)])
    return in_arrow(rows, _spans, "doc_id bigint, n_words bigint, hits array<bigint>, items array<string>, spans array<struct<start:bigint,stop:bigint>>")


def is_contaminated(n_hit: Column, n_words: Column, most: int = 20) -> Column:
    """One word in ``most`` or more is hit."""
    return (n_hit > 0) & (most * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, most: int = 20) -> DataFrame:
    """The report of :func:`contaminated_words`: counts, a digest of the items, and whether ``most * n_hit >= n_words`` with a hit."""
    n_hit = F.size("hits").cast("bigint")
    return contaminated_words(docs, benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated(n_hit, F.col("n_words"), most).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns, found and dropped in one pass."""
    rows, (n_words, hits, _) = scanned(docs, benchmark)
    return rows.where(~is_contaminated(F.size(hits), F.col(n_words))).select(*docs.columns)
