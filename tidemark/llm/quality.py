"""A quality classifier by supervised subword embeddings.

Words, word pairs and character n-grams are hashed to rows of one embedding table; a
document is the average of its rows, read by a softmax. Table and softmax are trained by
stochastic gradient descent in numpy on a bounded sample. Once trained, the table times the
softmax is one number a row, so scoring a text is one average over its features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from tidemark.llm.common import SPACED, added, chunks, in_arrow, mix, multipliers, texts_of, word_hashes
from tidemark.llm.labelled import sample

#: Labelled documents of each class that the classifier is trained on.
SAMPLE = 1_200
BITS, DIMENSIONS = 16, 8
GRAMS = (3, 4, 5)
EPOCHS, RATE = 6, 0.5

_KEEP_CASE = np.arange(256, dtype=np.uint8)
_BYTE = [m.astype(np.uint32) | np.uint32(1) for m in np.split(multipliers(sum(GRAMS) + 8, 71), sum(GRAMS) + 8)]
#: Rows of the table kept for a word that repeats the one before it, and for one that doesn't.
_AGAIN, _FRESH = np.uint16(0), np.uint16(1)


def _row(hashed: np.ndarray) -> np.ndarray:
    shift = hashed.dtype.itemsize * 8 - BITS
    return (hashed >> hashed.dtype.type(shift)).astype(np.uint16)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Kinds of features of some adjacent texts: table rows, and the text each belongs to.

    Character n-grams are runs of UTF-8 bytes, white space included; words are parted by
    white space and keep their case; a word pair counts once as itself and once as a repeat
    or not.
    """
    base, part = offsets[0], data[offsets[0] : offsets[-1]]
    ends = offsets[1:] - base
    texts = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    wide = part.astype(np.uint32) + np.uint32(1)
    used = 0
    for n in GRAMS:
        runs = max(0, len(part) - n + 1)
        hashed = np.zeros(runs, np.uint32)
        for j in range(n):
            hashed += wide[j : j + runs] * _BYTE[used + j]
        used += n
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0x2C1B3C6D)
        whole = np.arange(runs) + n <= ends[texts[:runs]]
        yield _row(hashed)[whole], texts[:runs][whole]
    words, rows = word_hashes(data, offsets, SPACED, _KEEP_CASE)
    yield _row(words), rows
    pair = rows[1:] == rows[:-1]
    left, right = words[:-1][pair], words[1:][pair]
    yield _row(mix(left * np.uint64(0x9E3779B97F4A7C15) + right)), rows[1:][pair]
    yield np.where(left == right, _AGAIN, _FRESH), rows[1:][pair]


#: Weight of each kind in the average: a text has about six bytes a word.
_SHARE = (1.0, 1.0, 1.0, 2.0, 2.0, 6.0)


@dataclass(frozen=True)
class Classifier:
    """Score of each table row (higher: label 1 likelier) and the bias."""

    rows: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probability of label 1 of each text; null and empty texts get the bias alone."""
        data, offsets = texts_of(column)
        out = np.empty(len(column))
        for start, stop in chunks(offsets):
            total, count = np.zeros(stop - start), np.zeros(stop - start)
            for (rows, texts), share in zip(features(data, offsets[start : stop + 1]), _SHARE, strict=True):
                total += share * np.bincount(texts, self.rows[rows], stop - start)
                count += share * np.bincount(texts, minlength=stop - start)
            out[start:stop] = self.bias + total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch.column("text"))
        rows, shares = [], []
        for i in range(len(batch)):
            weights = np.zeros(2**BITS, np.float32)
            for (found, _), share in zip(features(data, offsets[i : i + 2]), _SHARE, strict=True):
                weights += share * np.bincount(found, minlength=2**BITS).astype(np.float32)
            at = np.flatnonzero(weights)
            rows.append(at.astype(np.uint16).tobytes())
            shares.append((weights[at] / max(1.0, float(weights.sum()))).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), pa.array(rows, pa.binary()), pa.array(shares, pa.binary())], names=["label", "rows", "shares"])


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 13) -> Classifier:
    """Stochastic gradient descent, one document a step, the rate falling to nothing.

    Rows move by their share of the document times a fixed gain, so that rare features learn
    as well as common ones. Without examples of both classes the scores are all one half.
    """
    order = np.random.default_rng(seed)
    table = order.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (2**BITS, DIMENSIONS)).astype(np.float32)
    softmax, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    if len({label for label, _, _ in examples}) < 2:
        return Classifier(np.zeros(2**BITS, np.float32), 0.0)
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            label, rows, shares = examples[i]
            step = rate * (1 - done / steps)
            done += 1
            if not len(rows):
                continue
            document = shares @ table[rows]
            logits = document @ softmax + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[label] -= 1
            pull = softmax @ chance
            softmax -= step * np.outer(document, chance)
            bias -= np.float32(step * 0.1) * chance
            table[rows] -= (step * 20) * shares[:, None] * pull
    lean = softmax[:, 1] - softmax[:, 0]
    return Classifier(table @ lean, float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, most: int = SAMPLE) -> Classifier:
    """Train on at most ``most`` labelled documents of each class; only their hashed features reach the driver."""
    texts = sample(docs, labels, "quality", learnable, most)
    rows = in_arrow(texts, _sparse, "label int, rows binary, shares binary").collect()
    examples = [(r["label"], np.frombuffer(r["rows"], np.uint16), np.frombuffer(r["shares"], np.float32)) for r in rows]
    return train(sorted(examples, key=lambda e: (e[0], bytes(e[1]), bytes(e[2]))))


def quality(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """All columns of ``docs`` with ``quality_score``, whole texts read.

    A null or empty text has no features and gets the score of the bias. Rows are scored one
    by one, so repeated rows, null ids and empty tables need no rule. A column already named
    ``quality_score`` is replaced.
    """
    docs = docs.drop("quality_score")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(classifier.scores(batch.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "quality_score"])

    return in_arrow(docs, run, added(docs, quality_score="double"))
