"""Ranked lexical search, term at a time with a limited number of accumulators.

Documents are indexed in blocks: one row holds a block's documents and, for each term that
is asked for, which of them hold it how often. A query's terms are taken rarest first. Each
adds to the accumulators (partial scores) of the documents that hold it, until what the
remaining terms can add at most is less than the kth partial score: from there on no new
accumulator can matter, and the remaining terms only complete those that exist.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import in_arrow, store

#: Documents and postings of a block; a longer document has a block of its own.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 16, 1 << 21
#: Bytes of query text searched for in one pass; a larger set of queries takes several.
QUERY_BYTES = 4 << 20
#: Blocks that are searched first, in so many tasks, for scores that the others have to reach.
FIRST_BLOCKS, FIRST_TASKS = 64, 8
#: Tasks that merge the best rows of one query before they meet.
MERGERS = 32
#: Bytes of one text split at once.
SLICE = 1 << 20

#: Every byte that is no part of a term ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+`` becomes a space, after A-Z became a-z.
_FOLD = bytes(32 if b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128 else b + 32 * (65 <= b <= 90) for b in range(256))


def slices(folded: bytes) -> Iterator[bytes]:
    """Parts of bounded size, cut at spaces; a longer run without a space stays whole."""
    start = 0
    while len(folded) - start > SLICE:
        stop = folded.find(b" ", start + SLICE)
        if stop < 0:
            break
        yield folded[start:stop]
        start = stop
    yield folded[start:] if start else folded


def terms_of(text: str | bytes | None) -> Iterator[list[bytes]]:
    """A text's terms in order, slice by slice."""
    data = text.encode() if isinstance(text, str) else text or b""
    for part in slices(data.translate(_FOLD)):
        yield part.split()


_BLOCK = "part int, number int, n_docs long, n_terms long, docs binary, nameless binary, sizes binary, terms array<int>, dfs array<long>, places binary, counts binary"
_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.binary()]


def _index(vocabulary: dict[bytes, int], block_docs: int, block_postings: int):
    """Rows of text to rows of the index: the documents, and by ascending term the places and counts of its postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        sizes: list[int] = []
        terms: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        postings = 0

        def block() -> pa.RecordBatch:
            term = np.concatenate([*terms, np.empty(0, np.int32)]).astype(np.int32)
            place = np.repeat(np.arange(len(docs), dtype=np.uint32), [len(t) for t in terms])
            count = np.concatenate([*counts, np.empty(0, np.int64)])
            order = np.argsort(term, kind="stable")
            named, df = np.unique(term, return_counts=True)
            nameless = np.array([d is None for d in docs])
            row = [
                part, number, sum(n > 0 for n in sizes), sum(sizes), np.array([d or 0 for d in docs], np.int64).tobytes(), np.packbits(nameless).tobytes(),
                np.array(sizes, np.int64).tobytes(), named.tolist(), df.tolist(), place[order].tobytes(), count[order].tobytes(),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _KINDS, strict=True)], names=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for doc, text in zip(batch.column("doc_id"), texts, strict=True):
                size, found = 0, []
                for words in terms_of(text.as_py()):
                    size += len(words)
                    found += [t for t in map(vocabulary.get, words) if t is not None]
                named, count = np.unique(np.array(found, np.int32), return_counts=True)
                if docs and (len(docs) >= block_docs or postings + len(named) > block_postings):
                    yield block()
                    docs, sizes, terms, counts, postings, number = [], [], [], [], 0, number + 1
                docs.append(doc.as_py())
                sizes.append(size)
                terms.append(named)
                counts.append(count.astype(np.int64))
                postings += len(named)
        if docs:
            yield block()

    return run


class Corpus:
    """Statistics of all documents: N, L and each term's weight."""

    def __init__(self, n_docs: int, n_terms: int, dfs: dict[int, int]):
        self.n_docs, self.n_terms, self.dfs = n_docs, n_terms, dfs
        self.weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in dfs.items()}

    def damping(self, sizes: np.ndarray) -> np.ndarray:
        """m of documents of so many terms."""
        if len(sizes) and int(sizes.max()) * self.n_docs * 50 >= 2**63:
            return np.array([50 + (50 * int(n) * self.n_docs) // self.n_terms for n in sizes], np.int64)
        return 50 + (50 * sizes * self.n_docs) // max(1, self.n_terms)


class Best:
    """The k best of the documents seen: highest score first, then smallest id, then those without an id."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.scores, self.docs, self.nameless = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """A score that a document needs at least to matter."""
        return max(self.floor, int(self.scores[-1])) if len(self.scores) == self.k else self.floor

    def add(self, scores: np.ndarray, docs: np.ndarray, nameless: np.ndarray) -> None:
        scores, docs, nameless = (np.concatenate(p) for p in ((self.scores, scores), (self.docs, docs), (self.nameless, nameless)))
        order = np.lexsort((docs, nameless, -scores))[: self.k]
        self.scores, self.docs, self.nameless = scores[order], docs[order], nameless[order]


class Block:
    """A row of the index with the postings' contributions to scores worked out."""

    def __init__(self, row: dict, corpus: Corpus):
        self.docs = np.frombuffer(row["docs"], np.int64)
        self.nameless = np.unpackbits(np.frombuffer(row["nameless"], np.uint8), count=len(self.docs)).astype(bool)
        places, counts = np.frombuffer(row["places"], np.uint32), np.frombuffer(row["counts"], np.int64)
        damping = corpus.damping(np.frombuffer(row["sizes"], np.int64))[places]
        impacts = (1_000_000_000 * counts) // (1000 * counts + 20 * damping)
        ends = np.cumsum([0, *row["dfs"]]).tolist()
        self.postings = {t: (places[a:b], corpus.weights[t] * impacts[a:b]) for t, a, b in zip(row["terms"], ends[:-1], ends[1:], strict=True)}
        self.bounds = {t: int(scores.max()) for t, (_, scores) in self.postings.items()}

    def search(self, terms: list[int], best: Best, scratch: np.ndarray) -> int:
        """Put the block's documents for the terms, given rarest first, into ``best``; returns how many accumulators were made."""
        terms = [t for t in terms if t in self.postings]
        rest = sum(self.bounds[t] for t in terms)
        if rest == 0 or rest < best.least:
            return 0
        scores, made = scratch[: len(self.docs)], np.empty(0, np.uint32)
        limited = False
        for t in terms:
            if not limited and len(made):
                # The kth partial score so far, or what documents of other blocks have reached already.
                reached = best.least
                if rest >= reached and len(made) >= best.k:
                    reached = max(reached, int(np.partition(scores[made], len(made) - best.k)[len(made) - best.k]))
                limited = rest < reached
            places, gains = self.postings[t]
            if limited:
                # Only accumulators that exist are completed, found in the postings by halving.
                at = np.searchsorted(places, made)
                at[at == len(places)] = 0
                here = places[at] == made
                scores[made[here]] += gains[at[here]]
            else:
                fresh = places[scores[places] == 0]
                scores[places] += gains
                made = np.union1d(made, fresh) if len(made) else fresh
            rest -= self.bounds[t]
        total = scores[made]
        scores[made] = 0
        keep = (total > 0) & (total >= best.least)
        best.add(total[keep], self.docs[made[keep]], self.nameless[made[keep]])
        return len(made)


def _search(queries: list[list[int]], corpus: Corpus, k: int, floors: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(k, floor) for floor in floors]
        scratch = np.empty(0, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, corpus)
                if len(scratch) < len(block.docs):
                    scratch = np.zeros(len(block.docs), np.int64)
                for terms, best in zip(queries, found, strict=True):
                    block.search(terms, best, scratch)
        for number, best in enumerate(found):
            if len(best.scores):
                ids = pa.array(best.docs, pa.int64(), mask=best.nameless)
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(ids), pa.int32()), ids, pa.array(best.scores)], names=["query", "doc_id", "score"])

    return run


_FOUND = "query int, doc_id long, score long"


def _batches(items: DataFrame, most: int) -> Iterator[list[tuple[int | None, set[bytes]]]]:
    """Queries in blocks of bounded size, one in the driver at a time; rows that repeat an id are one query."""
    block: list[tuple[int | None, set[bytes]]] = []
    size = 0
    for name, text in items.orderBy("item_id", "text").toLocalIterator():
        if not block or block[-1][0] != name:
            if size >= most:
                yield block
                block, size = [], 0
            block.append((name, set()))
        block[-1][1].update(t for words in terms_of(text) for t in words)
        size += len(text or "")
    if block:
        yield block


def index(docs: DataFrame, vocabulary: dict[bytes, int], block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The stored index of all rows of ``docs`` for the terms of a vocabulary."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return store(in_arrow(rows, _index(vocabulary, block_docs, block_postings), _BLOCK), "postings")


def best_documents(docs: DataFrame, items: DataFrame, k: int = 50, query_bytes: int = QUERY_BYTES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: ``item_id, rank, doc_id, score``.

    All rows of ``docs`` are indexed and scored exactly. Equal scores are ranked by ascending
    doc_id, rows without an id last; rows that repeat an id are documents of their own. Rows
    of ``items`` that share an id, or have none, are one item with the terms of all. Null and
    empty texts have no terms; an item without terms, or whose terms no document holds, has
    no rows, and an empty table on either side gives none. Other columns are ignored.

    Items are searched for in blocks of ``query_bytes``. For each, one pass over the texts
    writes an index for the items' terms, whose size depends on matches and not on texts. A
    few blocks are searched first; the kth score there is a floor for all others, so that a
    task passes on few rows that cannot matter.
    """
    found = None
    for block in _batches(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")), query_bytes):
        part = _best_of_block(docs, block, k, block_docs)
        found = part if found is None else store(found, "ranked").union(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


def _best_of_block(docs: DataFrame, queries: list[tuple[int | None, set[bytes]]], k: int, block_docs: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*(terms for _, terms in queries))))}
    blocks = index(docs, vocabulary, block_docs)
    n_docs, n_terms = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    pairs = blocks.select(F.explode(F.arrays_zip("terms", "dfs")).alias("pair"))
    dfs = {r["term"]: r["df"] for r in pairs.groupBy(F.col("pair.terms").alias("term")).agg(F.sum("pair.dfs").alias("df")).collect()}
    corpus = Corpus(n_docs, n_terms, dfs)
    asked = [sorted((vocabulary[t] for t in terms if vocabulary[t] in dfs), key=lambda t: (dfs[t], t)) for _, terms in queries]

    early = (F.col("part") < FIRST_BLOCKS) & (F.col("number") == 0)
    first = store(in_arrow(blocks.where(early).coalesce(FIRST_TASKS), _search(asked, corpus, k, [0] * len(asked)), _FOUND), "first-found")
    ordered = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    kth = first.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") == k).select("query", "score").collect()
    floors = [0] * len(asked)
    for query, score in kth:
        floors[query] = score
    rest = in_arrow(blocks.where(~early), _search(asked, corpus, k, floors), _FOUND)

    # Each task gives at most k rows a query; tasks' rows meet in two steps.
    rows = first.union(rest).withColumn("merger", F.pmod(F.xxhash64("doc_id"), F.lit(MERGERS)))
    merging = Window.partitionBy("query", "merger").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    rows = rows.withColumn("rank", F.row_number().over(merging)).where(F.col("rank") <= k).select("query", "doc_id", "score")
    rows = rows.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(queries)], "query int, item_id long")
    return rows.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
