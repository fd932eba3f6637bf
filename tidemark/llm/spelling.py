"""Spelling variants by k-d trees over letter counts.

A letter put in adds one to one count; a letter replaced takes one from a count and adds one
to another. So the counts of near words differ by at most one upwards and one downwards, and
a box of a k-d tree that a word's counts miss by more holds no word near it. A coarse tree
for each word length deals all words to cells; each word then asks the cells of its length
and of the next whose boxes it does not miss. In a cell, a finer tree finds the counts in
reach, and the letters' order decides.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, store
from tidemark.llm.ranked_search import slices

#: One in so many (document, run) pairs loses a letter.
DROPPED = 199
#: Words shorter than this, or occurring less often, are left out; a form occurs so many times as often as the word.
SHORTEST, LEAST, RATIO = 6, 5, 5
#: Words in a cell, as far as the sample can tell, and the most words that the coarse trees are made from.
CELL, SAMPLE = 1024, 400_000
#: Lengths from this one on share a tree.
POOLED = 64
#: Counts in a leaf of a cell's tree; queries searched for at once; distinct words a task counts before passing them on.
LEAF, TOGETHER, HELD = 32, 4096, 200_000
#: Pairs whose letters are compared at once.
COMPARED = 1 << 18
#: Pairs of words with the same two counts beyond which letters taken out are matched instead of comparing pairs.
PAIRWISE = 4096

#: Runs ``[A-Za-zÀ-ÿ]+`` in Latin-1, where a letter is one byte: A-Z become a-z, all that is no letter a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
#: A letter's place among the counts.
_PLACE = np.array([b - 97 if 97 <= b <= 122 else b - 0xC0 + 26 if b >= 0xC0 else 0 for b in range(256)])
LETTERS = 26 + 64


def runs_of(text: str | None) -> Counter:
    """Lower-cased runs of at least ``SHORTEST`` letters with their numbers; other characters part them."""
    found: Counter = Counter()
    for part in slices((text or "").encode("latin-1", "replace").translate(_FOLD)):
        found.update([w for w in part.split() if len(w) >= SHORTEST])
    return found


def results_of(doc_id: int | None, text: str | None) -> Iterator[tuple[bytes, int]]:
    """A document's words with their numbers after letters were dropped; a null id counts as an empty string."""
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs_of(text).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
        if h % DROPPED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < SHORTEST:
                continue
        yield run, n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def passed_on() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            for word, n in results_of(doc.as_py(), text.as_py()):
                held[word] += n
            if len(held) > HELD:
                yield passed_on()
                held.clear()
    yield passed_on()


def vectors(words: list[bytes]) -> np.ndarray:
    """Letter counts, a row a word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = _PLACE[np.frombuffer(b"".join(words), np.uint8)]
    cells = np.repeat(np.arange(len(words)), lengths) * LETTERS + letters
    return np.bincount(cells, minlength=len(words) * LETTERS).reshape(-1, LETTERS).astype(np.int32)


class Tree:
    """A k-d tree: inner nodes part the counts of one letter at most ``split`` from those above; leaves are numbered."""

    def __init__(self, points: np.ndarray, leaves: int | None = None, size: int = LEAF):
        """Split until there are ``leaves`` of even numbers of points, or until leaves have ``size`` points."""
        self.letter, self.split, self.child, self.leaves = [], [], [], []
        goal = max(1, -(-len(points) // leaves)) if leaves else size
        self._grow(points, goal)

    def _grow(self, points: np.ndarray, goal: int) -> None:
        waiting = [(np.arange(len(points)), -1, 0)]
        while waiting:
            rows, parent, side = waiting.pop()
            here = points[rows]
            node, spread = ~len(self.leaves), None
            if len(rows) > goal:
                spread = here.var(axis=0)
            if spread is None or spread.max() == 0:
                self.leaves.append(rows)
            else:
                node, letter = len(self.letter), int(spread.argmax())
                counts = here[:, letter]
                split = min(int(np.median(counts)), int(counts.max()) - 1)
                self.letter.append(letter)
                self.split.append(split)
                self.child.append([0, 0])
                waiting += [(rows[counts <= split], node, 0), (rows[counts > split], node, 1)]
            if parent >= 0:
                self.child[parent][side] = node

    def home(self, points: np.ndarray) -> np.ndarray:
        """The number of the leaf whose box holds each point."""
        found = np.zeros(len(points), np.int64)
        waiting = [(0 if self.letter else ~0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            if node < 0:
                found[rows] = ~node
            else:
                high = points[rows, self.letter[node]] > self.split[node]
                waiting += [(self.child[node][0], rows[~high]), (self.child[node][1], rows[high])]
        return found

    def reached(self, points: np.ndarray, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, each with the points that its box may hold a neighbour of: one count more, and ``less`` counts fewer, in all."""
        waiting = [(0 if self.letter else ~0, np.arange(len(points)), np.zeros(len(points), np.int32), np.zeros(len(points), np.int32), {}, {})]
        while waiting:
            node, rows, more, fewer, low, high = waiting.pop()
            if not len(rows):
                continue
            if node < 0:
                yield ~node, rows
                continue
            letter, split = self.letter[node], self.split[node]
            counts = points[rows, letter]
            # Counts of this letter are at most ``split`` on the left ...
            over = fewer + np.maximum(counts - split, 0) - (np.maximum(counts - high[letter], 0) if letter in high else 0)
            keep = over <= less
            waiting.append((self.child[node][0], rows[keep], more[keep], over[keep], low, {**high, letter: split}))
            # ... and above it on the right.
            under = more + np.maximum(split + 1 - counts, 0) - (np.maximum(low[letter] - counts, 0) if letter in low else 0)
            keep = under <= 1
            waiting.append((self.child[node][1], rows[keep], under[keep], fewer[keep], {**low, letter: split + 1}, high))


def _marks(points: np.ndarray) -> np.ndarray:
    """Counts as bits, one for each unit of a count up to a limit, in four 64-bit numbers a row."""
    levels = np.where(np.arange(LETTERS) < 26, 4, 2)
    places = np.repeat(np.arange(LETTERS), levels)
    level = np.concatenate([np.arange(n) for n in levels])
    bits = np.zeros((len(points), 256), np.uint8)
    bits[:, : len(places)] = points[:, places] > level
    return np.packbits(bits, axis=1).view(np.uint64)


def near(a: bytes, b: bytes) -> bool:
    """Whether ``b`` is ``a`` with one letter replaced, or put in."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else len(b) == len(a) + 1 and a[i:] == b[i + 1 :])


class Group:
    """Words by their letter counts: ``starts`` bounds the words of each count in ``words``."""

    def __init__(self, words: list[bytes], ns: list[int]):
        order = sorted(range(len(words)), key=lambda i: (keys[i], words[i])) if (keys := [bytes(sorted(w)) for w in words]) else []
        self.words, self.ns = [words[i] for i in order], np.array([ns[i] for i in order], np.int64)
        self.starts = [j for j, i in enumerate(order) if j == 0 or keys[i] != keys[order[j - 1]]]
        self.points = vectors([self.words[j] for j in self.starts])
        self.marks = _marks(self.points)
        self.starts.append(len(words))
        # Letters one after the other, for comparing many words at once; only where all are short.
        self.width = max(map(len, words), default=0)
        if self.width < POOLED:
            flat = np.zeros((len(words), POOLED), np.uint8)
            for j, w in enumerate(self.words):
                flat[j, : len(w)] = np.frombuffer(w, np.uint8)
            self.letters = flat
            self.lengths = np.fromiter(map(len, self.words), np.int64, len(words))


def pairs(data: Group, tree: Tree, asked: Group, less: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of near words: of ``asked``, and of ``data`` with a letter replaced (``less`` 1) or put in."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for leaf, rows in tree.reached(asked.points, less):
        members = tree.leaves[leaf]
        for a in range(0, len(rows), TOGETHER):
            part = rows[a : a + TOGETHER]
            ours, theirs = asked.marks[part][:, None, :], data.marks[members][None, :, :]
            more = np.bitwise_count(theirs & ~ours).sum(axis=2)
            fewer = np.bitwise_count(ours & ~theirs).sum(axis=2)
            x, y = np.nonzero((more <= 1) & (fewer <= less))
            held.append((part[x], members[y]))
            size += len(x)
            if size >= COMPARED:
                yield from _in_order(data, asked, held)
                held, size = [], 0
    if size:
        yield from _in_order(data, asked, held)


def _in_order(data: Group, asked: Group, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of pairs of counts, the pairs of words whose letters are in order."""
    ours, theirs = (np.concatenate(side) for side in zip(*held, strict=True))
    starts, others = np.array(asked.starts), np.array(data.starts)
    wide = others[theirs + 1] - others[theirs]
    sizes = (starts[ours + 1] - starts[ours]) * wide
    large = sizes > PAIRWISE
    for u, v in zip(ours[large].tolist(), theirs[large].tolist(), strict=True):
        mine, yours = range(starts[u], starts[u + 1]), range(others[v], others[v + 1])
        found = _matched(asked.words, mine, asked.points[u], data.words, yours, data.points[v])
        if found:
            q, d = np.array(found, np.int64).T
            yield q, d
    ours, theirs, wide, sizes = ours[~large], theirs[~large], wide[~large], sizes[~large]
    ends = np.cumsum(sizes)
    for a in range(0, int(ends[-1]) if len(ends) else 0, COMPARED):
        # The words of these counts, each with each, so many pairs at once.
        number = np.arange(a, min(a + COMPARED, int(ends[-1])))
        at = np.searchsorted(ends, number, "right")
        within = number - (ends[at] - sizes[at])
        q, d = starts[ours[at]] + within // wide[at], others[theirs[at]] + within % wide[at]
        keep = _compared(asked, q, data, d)
        yield q[keep], d[keep]


def _compared(asked: Group, q: np.ndarray, data: Group, d: np.ndarray) -> np.ndarray:
    """Whether the letters of words agree but for one."""
    if max(data.width, asked.width) >= POOLED:
        return np.fromiter((near(asked.words[i], data.words[j]) for i, j in zip(q.tolist(), d.tolist(), strict=True)), bool, len(q))
    width = max(data.width, asked.width) + 1
    a, b, length = asked.letters[:, :width][q], data.letters[:, :width][d], asked.lengths[q]
    longer = data.lengths[d] - length
    agree = a == b
    same = (width - agree.sum(axis=1)) == 1
    if not (longer == 1).any():
        return same & (longer == 0)
    # Put in: the letters in front agree as they are, those behind one place on.
    places = np.arange(width - 1)
    front = np.where(agree.all(axis=1), width, agree.argmin(axis=1))
    behind = (a[:, :-1] == b[:, 1:]) | (places < front[:, None]) | (places >= length[:, None])
    return np.where(longer == 0, same, (longer == 1) & behind.all(axis=1))


def _matched(ours: list[bytes], mine: range, u: np.ndarray, theirs: list[bytes], yours: range, v: np.ndarray) -> list[tuple[int, int]]:
    """Near words of two large sets with the same counts each: what is left without the letter that differs has to be equal.

    The work is in proportion to the words and the pairs found, not to all pairs.
    """
    change = v - u
    if change.clip(0).sum() != 1 or change.clip(None, 0).sum() < -1:
        return []
    place_of = {int(_PLACE[b]): b for b in [*range(97, 123), *range(0xC0, 0x100)]}
    put = place_of[int(change.argmax())]
    taken = place_of[int(change.argmin())] if change.min() < 0 else None
    known: dict[tuple[int, bytes], list[int]] = {}
    for i in mine:
        w = ours[i]
        for at in [k for k, b in enumerate(w) if b == taken] if taken is not None else [-1]:
            known.setdefault((at, w[:at] + w[at + 1 :] if at >= 0 else w), []).append(i)
    found = set()
    for j in yours:
        w = theirs[j]
        for at in [k for k, b in enumerate(w) if b == put]:
            found.update((i, j) for i in known.get((at if taken is not None else -1, w[:at] + w[at + 1 :]), ()))
    return sorted(found)


def _best(words: np.ndarray, ns: np.ndarray, others: np.ndarray, names: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """Per word: number of near words, and the one of largest number and least letters."""
    ranks = np.empty(len(names), np.int64)
    ranks[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    order = np.lexsort((ranks[others], -ns, words))
    words, ns, others = words[order], ns[order], others[order]
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1])) if len(words) else np.empty(0, np.int64)
    counts = np.diff(np.append(first, len(words)))
    return zip(words[first].tolist(), counts.tolist(), ns[first].tolist(), others[first].tolist(), strict=True)


_NEAR = "word string, n_near long, near_n long, near string"


def _answer(data: Group, tree: Tree, asked: Group, less: int) -> pa.RecordBatch:
    found = list(pairs(data, tree, asked, less))
    q = np.concatenate([f[0] for f in found] or [np.empty(0, np.int64)])
    d = np.concatenate([f[1] for f in found] or [np.empty(0, np.int64)])
    rows = [(asked.words[w], n, most, data.words[o]) for w, n, most, o in _best(q, data.ns[d], d, data.words)]
    # A letter put in is found from the shorter word only, so the longer one is told too.
    longer = np.array([len(data.words[j]) > len(asked.words[i]) for i, j in zip(q.tolist(), d.tolist(), strict=True)], bool)
    rows += [(data.words[w], n, most, asked.words[o]) for w, n, most, o in _best(d[longer], asked.ns[q[longer]], q[longer], asked.words)]
    columns = zip(*rows, strict=True) if rows else ((), (), (), ())
    word, n, most, other = columns
    return pa.RecordBatch.from_arrays(
        [pa.array([w.decode("latin-1") for w in word], pa.string()), pa.array(n, pa.int64()), pa.array(most, pa.int64()), pa.array([w.decode("latin-1") for w in other], pa.string())],
        names=["word", "n_near", "near_n", "near"],
    )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, a cell's own words before those that ask: words held are one cell's, and one batch of questions."""
    cell, words, ns = None, [], []
    data = tree = None
    for batch in batches:
        cells, less = batch.column("cell").to_numpy(), batch.column("less").to_numpy(zero_copy_only=False)
        texts, numbers = [w.encode("latin-1") for w in batch.column("word").to_pylist()], batch.column("n").to_pylist()
        cuts = [0, *(np.flatnonzero((np.diff(cells) != 0) | (np.diff(less) != 0)) + 1).tolist(), len(cells)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if cells[a] != cell:
                cell, words, ns, data = cells[a], [], [], None
            if less[a] < 0:
                words += texts[a:b]
                ns += numbers[a:b]
                continue
            if data is None:
                data = Group(words, ns)
                tree = Tree(data.points)
            for start in range(a, b, TOGETHER):
                stop = min(b, start + TOGETHER)
                yield _answer(data, tree, Group(texts[start:stop], numbers[start:stop]), int(less[a]))


def _deal(trees: dict[int, tuple[int, Tree]]):
    """Words to the cell that holds them (``less`` -1) and to the cells they ask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            pools = np.minimum([len(w) for w in words], POOLED)
            points, out = vectors(words), []
            for pool in np.unique(pools).tolist():
                rows = np.flatnonzero(pools == pool)
                base, tree = trees[pool]
                out.append((rows, base + tree.home(points[rows]), -1))
                for other, less in ((pool, 1), (pool + 1, 0)):
                    if other in trees:
                        base, tree = trees[other]
                        out += [(rows[at], np.full(len(at), base + leaf), less) for leaf, at in tree.reached(points[rows], less)]
            for rows, cells, less in out:
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells, pa.int64()), pa.array([less] * len(rows), pa.int32()), kept.column("word"), kept.column("n")], names=["cell", "less", "word", "n"]
                )

    return run


def _trees(words: DataFrame, cell: int, sample: int) -> dict[int, tuple[int, Tree]]:
    """The coarse tree of each length, with the number of its first cell."""
    pool = F.least(F.length("word"), F.lit(POOLED))
    sizes = {r["pool"]: r["count"] for r in words.groupBy(pool.alias("pool")).count().collect()}
    total = sum(sizes.values())
    kept = words if total <= sample else words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(sample / total * (1 << 30)))
    drawn: dict[int, list[bytes]] = {p: [] for p in sizes}
    for (word,) in kept.select("word").toLocalIterator():
        drawn[min(len(word), POOLED)].append(word.encode("latin-1"))
    trees, base = {}, 0
    for at in sorted(sizes):
        tree = Tree(vectors(drawn[at]), leaves=-(-sizes[at] // cell))
        trees[at] = (base, tree)
        base += len(tree.leaves)
        tree.leaves = [np.empty(0, np.int64)] * len(tree.leaves)
    return trees


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word, n_near, near_n, near`` of every word with a near one, for distinct ``word`` with ``n``.

    The trees are made from at most about ``sample`` words drawn by hash (all, if there are
    fewer); that decides which cells there are, not which words are found: every word is in
    one cell and asks every cell that may hold a near one.
    """
    trees = _trees(words, cell, sample)
    dealt = in_arrow(words, _deal(trees), "cell long, less int, word string, n long")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell", "less")
    # Answers of several cells, and of several batches, about one word.
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    found = in_arrow(dealt, _search, _NEAR).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.m")).alias("near_n"), F.col("best.near").alias("near"))


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``word`` and ``n`` of all words of whole texts that occur ``least`` times, as :func:`results_of` takes them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(rows, _count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def spelling_variants(docs: DataFrame, ratio: int = RATIO, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """Per distinct word of all documents: ``word, form, root, n, n_near, form_n``.

    A word's form is its near word (one letter put in, taken out or replaced) of largest
    ``n``, the smallest in code-point order of equal ones, if that is at least ``ratio``
    times its own; its root is where following forms ends. Null and empty texts have no
    words; a null doc_id counts as an empty string where letters are dropped; repeated rows
    count each; an empty table gives no words; other columns are ignored.
    """
    words = store(word_counts(docs), "words")
    near_by = store(near_words(words, cell, sample).withColumnRenamed("word", "of"), "near-words")
    joined = words.join(near_by, words["word"] == near_by["of"], "left")
    common = F.col("near_n") >= ratio * F.col("n")
    words = store(
        joined.select(
            "word", F.when(common, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(common, F.col("near_n")).alias("form_n")
        ),
        "forms",
    )
    # A form occurs ``ratio`` times as often as its word, so paths are short and never return; each round doubles the step.
    links = words.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("through"), F.col("root").alias("beyond"))
        further = links.join(onward, links["root"] == onward["through"], "left")
        moved = store(further.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    links = links.select(F.col("word").alias("of"), "root")
    return words.join(links, words["word"] == links["of"], "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
