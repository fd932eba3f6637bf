"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Texts are folded first: lower case, without accents, look-alike letters of other scripts,
styled and full-width forms of any plane, digits and signs written for letters, invisible
characters left out. The lexicon holds word beginnings, and whole words where they are
shorter or longer than a beginning; their weights are learned from labelled documents.
"""

from __future__ import annotations

import heapq
import math
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice, takewhile

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import added, in_arrow
from tidemark.llm.labelled import sample

#: Labelled documents of each class that the lexicon is learned from.
SAMPLE = 4_000
#: Letters of a beginning; words of fewer or more are terms as a whole, with a space at their end.
SHORTEST, LONGEST = 4, 12
#: Toxic sample documents that a term must occur in; terms in so large a share of them are all taken.
SUPPORT, COMMON = 4, 0.03
#: Log odds that a term must reach.
LEAST_WEIGHT = 2.0
#: Terms of one toxic document that the choice of the lexicon asks for.
COVER = 2
#: Words over which a fixed number of hits counts half as much.
HALF_WORDS = 2_000
THRESHOLD = 0.3

#: Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "clown fish", "circus clown")

# Look-alikes from other scripts, and digits and signs written for letters.
_ALIKE = {
    **dict(zip("аеорсхуіјѕԁһкмтвн", "aeopcxyijsdhkmtbh", strict=True)),
    **dict(zip("αβεικνορτυχ", "abeiknoptux", strict=True)),
    **dict(zip("ıɑɡ", "iag", strict=True)),
    **dict(zip("013456789@$|", "oieasgtbgasi", strict=True)),
    "l": "i",  # with 1 and | standing for either, both are one letter
}
#: Marks in the table: left out, white space, ``!``, and characters that stand for several letters.
_GONE, _WHITE, _BANG, _SEVERAL = 0, 1, 2, 3
_SPACE = ord(" ")
#: Code points of letters, and of marks and invisible characters beyond them.
_PLANES = (range(0x32400), range(0xE0000, 0xE0200))


def _plain(char: str) -> str:
    """The letters of a character without their marks, lower-cased, look-alikes replaced."""
    parts = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", char).lower())
    bare = "".join(c for c in parts if unicodedata.category(c) not in ("Cf", "Mn", "Me"))
    if len(bare) > 1 and not all("a" <= c <= "z" for c in bare):
        bare = unicodedata.normalize("NFC", bare)  # syllables and the like stay one letter
    return "".join(_ALIKE.get(c, c) for c in bare)


def _fold_table() -> tuple[np.ndarray, dict[int, str]]:
    out, several = np.full(0x110000, _SPACE, np.uint32), {}
    for code in (code for plane in _PLANES for code in plane if not 0xD800 <= code < 0xE000):
        char = chr(code)
        if unicodedata.category(char) in ("Cf", "Mn", "Me"):
            out[code] = _GONE
        elif char.isspace():
            out[code] = _WHITE
        elif char in "!\uff01":
            out[code] = _BANG
        else:
            plain = _plain(char)
            if len(plain) == 1 and plain.isalpha():
                out[code] = ord(plain)
            elif plain.isalpha():
                out[code], several[code] = _SEVERAL, plain
    return out, several


@lru_cache(maxsize=1)
def _folding() -> tuple[np.ndarray, dict[int, str]]:
    return _fold_table()


def fold(text: str) -> str:
    """Folded words between spaces: one space for a run of white space, one more for each other character between words.

    ``!`` is the letter it looks like where a letter follows, and parts words elsewhere.
    """
    table, several = _folding()
    codes = table[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    if (codes == _SEVERAL).any():
        codes = table[np.frombuffer(text.translate(several).encode("utf-32-le", "replace"), np.uint32)]
    codes = np.concatenate([[_WHITE], codes[codes != _GONE], [_WHITE]]).astype(np.uint32)
    bangs = np.flatnonzero(codes == _BANG)
    if len(bangs):
        codes[bangs] = np.where(codes[bangs + 1] > _SPACE, ord("i"), _SPACE)
    white = codes == _WHITE
    codes[white] = _SPACE
    white[1:] &= white[:-1].copy()
    white[0] = False
    return codes[~white].tobytes().decode("utf-32-le")


def _words(line: str) -> int:
    """Words of a folded text."""
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
    return int(((codes[1:] != _SPACE) & (codes[:-1] == _SPACE)).sum())


@dataclass(frozen=True)
class Lexicon:
    """Folded word beginnings with weights, harmless phrases, and the raw score at which a text counts as toxic.

    A term with a space at its end is a whole word.
    """

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    cut: float = 1.0
    machine: list = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "cut": self.cut, "machine": []}

    def automaton(self) -> ahocorasick.Automaton:
        if not self.machine:
            made = ahocorasick.Automaton()
            for term, weight in self.weights.items():
                made.add_word(f" {term}", (len(term) + 1, weight))
            for phrase in self.exceptions:
                key = f" {' '.join(fold(phrase).split())} "
                made.add_word(key, (len(key), None))
            if len(made):
                made.make_automaton()
            self.machine.append(made)
        return self.machine[0]

    def raw(self, text: str | None) -> tuple[float, int]:
        """Summed weights of the words hit, normalised by length, and their number."""
        line = fold(text or "")
        if not len(self.automaton()):
            return 0.0, 0
        hits: dict[int, float] = {}
        harmless: list[tuple[int, int]] = []
        for end, (length, weight) in self.automaton().iter(line):
            start = end - length + 1
            if weight is None:
                harmless.append((start, end))
            else:
                hits[start] = max(weight, hits.get(start, 0.0))
        if harmless and hits:
            harmless.sort()
            kept, until, at = {}, -1, 0
            for start in sorted(hits):
                while at < len(harmless) and harmless[at][0] <= start:
                    until, at = max(until, harmless[at][1]), at + 1
                if start >= until:
                    kept[start] = hits[start]
            hits = kept
        if not hits:
            return 0.0, 0
        return sum(hits.values()) / (1 + math.log2(1 + _words(line) / HALF_WORDS)), len(hits)

    def score(self, raw: float) -> float:
        """0 to 1, with ``cut`` at the threshold."""
        return raw / (raw + self.cut * (1 - THRESHOLD) / THRESHOLD) if raw > 0 else 0.0


def _terms(text: str) -> set[str]:
    """The terms that a lexicon might hold of a text's words."""
    out = set()
    for word in set(fold(text).split()):
        out.update(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))
        if not SHORTEST <= len(word) <= LONGEST:
            out.add(f"{word} ")
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            for term in _terms(text):
                counts[term][label] += 1
    rows = [(term, clean, toxic) for term, (clean, toxic) in counts.items() if toxic]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], names=["term", "clean", "toxic"]
    )


def _held(terms: frozenset[str]):
    def run(batches):
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                found = sorted(_terms(text) & terms)
                if found:
                    yield pa.RecordBatch.from_pydict({"label": pa.array([label], pa.int32()), "terms": pa.array([found], pa.list_(pa.string()))})

    return run


def _cover(held: list[list[str]], odds: dict[str, float]) -> dict[str, float]:
    """The terms chosen with their weights, from the terms that each toxic document of the sample holds.

    The next is the one that helps most documents still short of ``COVER`` terms, by weight.
    What a term gains only falls as others are chosen, so an outdated place in the queue is
    too far forward, and a term is put back when its turn comes.
    """
    having: dict[str, set[int]] = defaultdict(set)
    for i, terms in enumerate(held):
        for term in terms:
            having[term].add(i)
    ordered = sorted(having)
    rank = {term: place for place, term in enumerate(ordered)}
    gain = {term: len(rows) for term, rows in having.items()}
    queue = [(-gain[term] * odds[term], -rank[term]) for term in ordered]
    heapq.heapify(queue)
    weights: dict[str, float] = {}
    need = [COVER] * len(held)
    while queue:
        value, place = heapq.heappop(queue)
        term = ordered[-place]
        if term not in gain:
            continue
        if value != -gain[term] * odds[term]:
            heapq.heappush(queue, (-gain[term] * odds[term], place))
            continue
        if gain[term] < 1 and len(having[term]) < COMMON * len(held):
            del gain[term]
            continue
        weights[term] = odds[term]
        # A shorter form of a chosen term finds its words and others, a longer one fewer of them; neither is wanted unless it tells more.
        longer = takewhile(lambda other: other.startswith(term), islice(ordered, rank[term], None))
        for other in [*longer, *(term[:n] for n in range(1, len(term)))]:
            if other in gain and (other == term or odds[other] < weights[term] + 1):
                del gain[other]
        for i in having[term]:
            need[i] -= 1
            if need[i] == 0:
                for other in held[i]:
                    if other in gain:
                        gain[other] -= 1
    return weights


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, most: int = SAMPLE, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon from at most ``most`` labelled documents of each class.

    Candidates are word beginnings with high log odds of a toxic document. Those common
    among toxic documents are taken; of the others, the fewest that leave each toxic
    document with ``COVER`` terms where it has as many: words that merely come with copies
    of one toxic document add nothing to that, and stay out. Without toxic documents the lexicon is empty and every score 0.
    """
    texts = sample(docs, labels, "toxic", learnable, most).withColumn("label", F.col("label").cast("int"))
    totals = {row["label"]: row["count"] for row in texts.groupBy("label").count().collect()}  # two rows
    counted = in_arrow(texts.repartition(F.xxhash64("text")), _count, "term string, clean long, toxic long")
    counted = counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (totals.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (totals.get(0, 0) + 1))
    counted = counted.where(F.col("toxic") >= SUPPORT).withColumn("weight", odds).where(F.col("weight") >= LEAST_WEIGHT)
    # All of them: what a bounded sample's documents hold SUPPORT times or more.
    groups = {row["term"]: row for row in counted.collect()}
    # Of beginnings that the same documents have, the longest.
    closed = set(groups) - {t[:-1] for t, row in groups.items() if t[:-1] in groups and groups[t[:-1]]["toxic"] == row["toxic"]}
    held = in_arrow(texts.where("label = 1"), _held(frozenset(closed)), "label int, terms array<string>").select("terms").collect()
    weights = _cover([row["terms"] for row in held], {term: float(groups[term]["weight"]) for term in closed})
    lexicon = Lexicon(weights, exceptions)
    raws = in_arrow(texts.select("label", "text"), _raw(lexicon), "label int, raw double").collect()
    return Lexicon(weights, exceptions, _cut([(row["raw"], row["label"]) for row in raws]))


def _cut(raws: list[tuple[float, int]]) -> float:
    """The raw score that parts the sample with the best F1, halfway between its neighbours."""
    toxic = sum(label for _, label in raws)
    values = sorted({raw for raw, _ in raws} | {0.0})
    best, cut = -1.0, 1.0
    at = Counter()
    good = Counter()
    for raw, label in raws:
        at[raw] += 1
        good[raw] += label
    above, hit = sum(at.values()), toxic
    for low, high in zip(values[:-1], values[1:], strict=True):
        above, hit = above - at[low], hit - good[low]
        f1 = 2 * hit / max(1, above + toxic)
        if f1 > best:
            best, cut = f1, (low + high) / 2
    return cut


def _raw(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [lexicon.raw(text.as_py())[0] for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(raws, pa.float64())], names=["label", "raw"])

    return run


def toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All columns of ``docs`` with ``toxicity`` (0 to 1) and ``toxic_hits``, whole texts read.

    Null and empty texts score 0. Rows are scored one by one, so repeated rows, null ids and
    empty tables need no rule. Columns already named ``toxicity`` or ``toxic_hits`` are
    replaced.
    """
    docs = docs.drop("toxicity", "toxic_hits")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicon.raw(text.as_py()) for text in batch.column(at)]
            scores = pa.array([lexicon.score(raw) for raw, _ in found], pa.float64())
            hits = pa.array([n for _, n in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores, hits], names=[*batch.schema.names, "toxicity", "toxic_hits"])

    return in_arrow(docs, run, added(docs, toxicity="double", toxic_hits="long"))
