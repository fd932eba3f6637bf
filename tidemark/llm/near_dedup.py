"""Near duplicates by banded MinHash signatures, confirmed on full shingle sets.

There are sixteen trees of eight MinHash values. Sets whose first ``DEPTH`` values in a tree
agree share a bucket, so this is banded LSH of fixed depth; the other values only order the
buckets that are too large for a task. Every two sets of a bucket are candidates: a bucket
is compared in one task, a larger one first in blocks of its order, and then those sets that
are not linked to the bucket's largest group meet every block, in block pairs over tasks.
Candidates whose signatures agree in enough places form clusters, and each cluster is
settled on the whole sets: breadth-first from its smallest set, comparing only with sets
that are not linked yet, so a group of copies costs one comparison per set and no pair list.
A cluster too large for a task is first compared with its smallest set; those it does not
reach meet every block of the cluster, which leaves out no pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACED, chunks, in_arrow, mix, multipliers, store, texts_of, word_hashes
from tidemark.llm.components import connected

WORDS = 5
TREES, VALUES, DEPTH = 16, 8, 3
PERMUTATIONS = TREES * VALUES
#: Candidates' signatures may agree in this much less than the threshold asks for: over four standard deviations.
SLACK = 15
#: Shingles of one cluster settled in one task (8 bytes each).
CLUSTER_SHINGLES = 4_000_000
#: Bits of the bitmap that tells which texts' sets are wanted; with more sets than that, ever more texts are.
MARKS = 1 << 24
#: Sets of a bucket compared in one go.
REGION_ROWS = 4_096

_MIX = multipliers(WORDS + 1, 5)
_SCALE = multipliers(PERMUTATIONS, 17)
_SHIFT = multipliers(PERMUTATIONS, 29)


def shingle_sets(column: pa.Array, k: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles; fewer words make one shingle, none make none."""
    data, offsets = texts_of(column)
    for start, stop in chunks(offsets):
        words, rows = word_hashes(data, offsets[start : stop + 1], SPACED)
        ends = np.searchsorted(rows, np.arange(stop - start + 1))
        runs = np.zeros(max(0, len(words) - k + 1), np.uint64)
        for j in range(k):
            runs += words[j : j + len(runs)] * _MIX[j]
        mix(runs)
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            if b - a >= k:
                yield np.unique(runs[a : b - k + 1])
            elif b > a:
                short = np.append(words[a:b] * _MIX[: b - a], _MIX[WORDS : WORDS + 1] * np.uint64(b - a))
                yield mix(short.sum(dtype=np.uint64, keepdims=True))
            else:
                yield np.empty(0, np.uint64)


def _identity(found: np.ndarray) -> bytes:
    """128 bits that name a set."""
    other = mix(found * np.uint64(0x9E3779B97F4A7C15))
    return np.array([found.sum(dtype=np.uint64), other.sum(dtype=np.uint64)]).tobytes()


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, a row for each (not empty) set."""
    out = np.empty((len(sets), PERMUTATIONS), np.uint64)
    sizes = np.array([len(s) for s in sets])
    ends = np.append(0, np.cumsum(sizes))
    for start, stop in chunks(ends * 8):
        block, at = np.concatenate(sets[start:stop]), ends[start:stop] - ends[start]
        for p in range(PERMUTATIONS):
            out[start:stop, p] = np.minimum.reduceat(block * _SCALE[p] + _SHIFT[p], at)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column(1)))
        full = [s for s in sets if len(s)]
        values = _signatures(full) if full else np.empty((0, PERMUTATIONS), np.uint64)
        labels = np.zeros((len(full), TREES, 2), np.int64)
        for half, (a, b) in enumerate(((0, DEPTH), (DEPTH, VALUES))):
            weights = multipliers(b - a, 41 + half)
            labels[:, :, half] = mix((mix(values.reshape(-1, TREES, VALUES)[:, :, a:b].copy()) * weights).sum(axis=2, dtype=np.uint64)).view(np.int64)
        small = (mix(values) >> np.uint64(56)).astype(np.uint8)
        rows = iter(range(len(full)))
        at = [next(rows) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_identity(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([None if i is None else small[i].tobytes() for i in at], pa.binary()),
                pa.array([None if i is None else labels[i].ravel() for i in at], pa.list_(pa.int64())),
                *batch.columns[2:],
            ],
            names=["doc_id", "n_shingles", "cls", "signature", "labels", *batch.schema.names[2:]],
        )


def _spanning(marks: np.ndarray, names: list[bytes], agree: int) -> Iterator[tuple[bytes, bytes]]:
    """Edges that span the sets whose signatures agree, breadth-first over what is left."""
    left = np.arange(len(names))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            near = (marks[left] == marks[one]).sum(axis=1) >= agree
            for other in left[near]:
                yield names[one], names[other]
                queue.append(other)
            left = left[~near]


_EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _regions(batches: Iterator[pa.RecordBatch], agree: int, most: int) -> Iterator[pa.RecordBatch]:
    """Edges that span the agreeing sets of each bucket of a sorted partition, in blocks of ``most`` sets."""
    key, names, marks = None, [], []

    def settle():
        found = np.frombuffer(b"".join(marks), np.uint8).reshape(-1, PERMUTATIONS)
        edges = list(_spanning(found, names, agree))
        return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.binary()) for i in (0, 1)], schema=_EDGES)

    for batch in batches:
        for tree, label, name, mark in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (tree, label) != key or len(names) == most:
                if len(names) > 1:
                    yield settle()
                key, names, marks = (tree, label), [], []
            names.append(name)
            marks.append(mark)
    if len(names) > 1:
        yield settle()


def _meet(names: list[bytes], marks: np.ndarray, roots: list[bytes], met: np.ndarray, agree: int) -> Iterator[tuple[bytes, bytes]]:
    """Edges that join the groups of sets that agree, one of the two being ``met``; sets of one root are joined already."""
    _, group = np.unique(np.array(roots, object), return_inverse=True)
    base = np.flatnonzero(~met)
    across = np.ascontiguousarray(marks[base].T)
    for one in np.flatnonzero(met):
        apart = group[base] != group[one]
        if not apart.any():
            continue
        near = base[apart & ((across == marks[one][:, None]).sum(axis=0, dtype=np.uint8) >= agree)]
        joined, firsts = np.unique(group[near], return_index=True)
        for i in firsts:
            yield names[near[i]], names[one]
        if len(joined):
            group[np.isin(group, joined)] = group[one]


def _met(batches: Iterator[pa.RecordBatch], agree: int) -> Iterator[pa.RecordBatch]:
    """Edges of :func:`_meet` in each block pair of a sorted partition."""
    key, rows = None, []

    def settle():
        names, marks, roots, met = zip(*rows, strict=True)
        edges = list(_meet(names, np.frombuffer(b"".join(marks), np.uint8).reshape(-1, PERMUTATIONS), roots, np.array(met, bool), agree))
        return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.binary()) for i in (0, 1)], schema=_EDGES)

    for batch in batches:
        for *part, name, mark, root, met in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
            if part != key and rows:
                yield settle()
                rows = []
            key = part
            rows.append((name, mark, root, met))
    if rows:
        yield settle()


def _across_blocks(rows: DataFrame, clusters: DataFrame, agree: int, most: int) -> DataFrame:
    """Edges between the blocks of large buckets, given ``clusters`` of the edges inside blocks.

    Sets of the bucket's largest cluster need not meet each other; each of the others meets
    every set of the bucket, at most about ``most`` of them on either side in one task.
    """
    rows = rows.join(clusters.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    rows = store(rows.select("tree", "label", "cls", "signature", "root"), "large-buckets")
    sizes = rows.groupBy("tree", "label", "root").agg(F.count("*").alias("n"))
    plan = sizes.groupBy("tree", "label").agg(F.sum("n").alias("total"), F.max(F.struct("n", "root")).alias("largest")).where("total > largest.n")
    blocks = [F.ceil(n / most).cast("int").alias(name) for n, name in ((F.col("total"), "blocks"), (F.col("total") - F.col("largest.n"), "rests"))]
    # Stored, so that Spark can broadcast it or split a hot bucket in the join.
    plan = store(plan.select("tree", "label", F.col("largest.root").alias("largest"), *blocks), "bucket-plan")
    placed = rows.join(plan, ["tree", "label"]).withColumn("h", F.xxhash64("cls"))
    held = ["cls", "signature", "root"]
    block, rest = F.expr("pmod(h, blocks)").alias("block"), F.expr("pmod(shiftright(h, 20), rests)").alias("rest")
    base = placed.select("tree", "label", block, F.explode(F.expr("sequence(0, rests - 1)")).alias("rest"), *held, F.lit(False).alias("met"))
    met = placed.where("root <> largest").select("tree", "label", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), rest, *held, F.lit(True).alias("met"))
    part = ["tree", "label", "block", "rest"]
    pairs = base.select(*part, *held, "met").union(met.select(*part, *held, "met")).repartition(*part).sortWithinPartitions(*part)
    return in_arrow(pairs, partial(_met, agree=agree), "a binary, b binary")


def _settle(sets: list[np.ndarray], joined: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges that span the exact links of some sets; those marked ``joined`` count as linked already."""
    sizes = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ids = ids.astype(np.int32)
    bounds = np.append(0, np.cumsum(sizes))
    flag = np.zeros(ids.max() + 1, np.int64)
    edges: list[tuple[int, int]] = []
    start = np.flatnonzero(joined)
    left = np.flatnonzero(~joined)

    def take(rows):
        total = sizes[rows]
        firsts = np.append(0, np.cumsum(total))[:-1]
        return ids[np.repeat(bounds[rows] - firsts, total) + np.arange(total.sum())], firsts

    flat, firsts = take(left)
    queue = list(start)
    while len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
            if not len(left):
                break
            flat, firsts = take(left)
        one = queue.pop()
        own = ids[bounds[one] : bounds[one + 1]]
        flag[own] = 1
        common = np.add.reduceat(flag[flat], firsts)
        flag[own] = 0
        near = 100 * common >= percent * (sizes[left] + sizes[one] - common)
        if near.any():
            for other in left[near]:
                edges.append((one, other))
                queue.append(other)
            left = left[~near]
            flat, firsts = take(left)
    return edges


def _clusters(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Edges of the exact links inside each cluster of a sorted partition, one cluster in memory at a time."""
    key, rows = None, []

    def settle():
        unique = list({row[0]: row for row in rows}.values())
        sets = [np.frombuffer(row[1], np.uint64) for row in unique]
        edges = _settle(sets, np.array([row[2] for row in unique], bool), percent) if len(unique) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([unique[e[i]][0] for e in edges], pa.binary()) for i in (0, 1)], schema=_EDGES)

    for batch in batches:
        for part, name, held, joined in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if part != key and rows:
                yield settle()
                rows = []
            key = part
            rows.append((name, held, joined))
    if rows:
        yield settle()


def _full_sets(batches: Iterator[pa.RecordBatch], marks: bytes) -> Iterator[pa.RecordBatch]:
    """Identity and set of the texts whose ``bit`` is marked."""
    marked = np.frombuffer(marks, np.uint8)
    for batch in batches:
        bits = batch.column("bit").to_numpy()
        picked = batch.column("text").take(pa.array(np.flatnonzero((marked[bits >> 3] >> (bits & 7)) & 1)))
        sets = [s for s in shingle_sets(picked) if len(s)]
        yield pa.RecordBatch.from_arrays([pa.array([_identity(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "held"])


def _marks(bits: DataFrame) -> bytes:
    """A bitmap of ``MARKS`` bits, whatever the size of the table, with each ``bit`` set."""
    chunk = 8 * 4096
    rows = bits.groupBy(F.expr(f"bit div {chunk}").cast("int").alias("chunk")).agg(F.bitmap_construct_agg(F.col("bit") % chunk).alias("marks")).collect()
    out = bytearray(MARKS // 8)
    for row in rows:
        out[row["chunk"] * 4096 : (row["chunk"] + 1) * 4096] = row["marks"]
    return bytes(out)


def _against_first(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for held, first in zip(batch.column("held").to_pylist(), batch.column("first_held").to_pylist(), strict=True):
            a, b = np.frombuffer(held, np.uint64), np.frombuffer(first, np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * common >= percent * (len(a) + len(b) - common))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cluster", "cls", "held")), pa.array(linked, pa.bool_())], names=["cluster", "cls", "held", "joined"])


def _exact_links(members: DataFrame, percent: int, most: int) -> DataFrame:
    """Edges spanning the exact links within clusters of any size."""
    size = F.sum(F.octet_length("held") / 8)
    heavy = store(members.groupBy("cluster").agg(size.alias("total"), F.min("cls").alias("first")).where(F.col("total") > most), "heavy")
    settle = partial(_clusters, percent=percent)

    def settled(rows: DataFrame, part: str) -> DataFrame:
        rows = rows.select(F.expr(part).alias("part"), "cls", "held", "joined")
        return in_arrow(rows.repartition("part").sortWithinPartitions("part"), settle, "a binary, b binary")

    light = settled(members.join(heavy, "cluster", "left_anti").withColumn("joined", F.lit(False)), "cluster")
    if heavy.isEmpty():
        return light
    firsts = members.join(heavy, (members["cls"] == heavy["first"]) & (members["cluster"] == heavy["cluster"]), "left_semi")
    firsts = firsts.select("cluster", F.col("held").alias("first_held"), F.col("cls").alias("first"))
    rows = store(in_arrow(members.join(firsts, "cluster"), partial(_against_first, percent=percent), "cluster binary, cls binary, held binary, joined boolean"), "heavy-rows")
    # What the first set does not reach meets every block; the rest of a block need not meet another block.
    parts = heavy.select("cluster", F.ceil(F.col("total") / most).cast("int").alias("blocks"))
    rest = rows.where("not joined").groupBy("cluster").agg(size.alias("left"))
    parts = parts.join(rest, "cluster").select("cluster", "blocks", F.ceil(F.col("left") / most).cast("int").alias("rests"))
    placed = rows.join(parts, "cluster").withColumn("h", F.xxhash64("cls"))
    block, rest_block = F.expr("pmod(h, blocks)"), F.expr("pmod(shiftright(h, 20), rests)")
    base = placed.select("cluster", "cls", "held", "joined", block.alias("block"), F.explode(F.expr("sequence(0, rests - 1)")).alias("rest"))
    met = placed.where("not joined").select("cluster", "cls", "held", "joined", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), rest_block.alias("rest"))
    crossed = settled(base.union(met), "concat(cluster, encode(concat_ws('/', '', block, rest), 'utf-8'))")
    direct = rows.where("joined").join(firsts.select("cluster", "first"), "cluster").select(F.col("cls").alias("a"), F.col("first").alias("b"))
    return light.union(crossed).union(direct)


def near_duplicates(docs: DataFrame, percent: int = 85, cluster_shingles: int = CLUSTER_SHINGLES, key: Column | None = None, region_rows: int = REGION_ROWS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Two documents are linked when ``100 * common >= percent * union`` over their sets of
    five-word shingles (``percent`` below 80 is refused: the trees would miss links);
    ``component_id`` is the smallest ``doc_id`` reachable over links. Documents without words
    (null, empty, blank) are linked with nothing, not even each other. Fewer than five words
    make one shingle. Rows that repeat an id or a text are rows of their own in one
    component; null ids never name one, and a component of null ids alone has a null id and
    keeps its rows. Other columns are ignored. An empty table gives an empty result.

    With ``key``, a long that tells rows of one id apart, there are two more columns: ``key``
    and ``component``, which names a row's component where ids repeat or are null; it is
    null for documents without words.
    """
    if not 80 <= percent <= 100:
        raise ValueError(f"percent must be 80 to 100, not {percent}")
    carried = [] if key is None else [key.cast("long").alias("key")]
    agree = PERMUTATIONS * (percent - SLACK) // 100
    schema = "doc_id long, n_shingles long, cls binary, signature binary, labels array<long>" + ", key long" * len(carried)
    signed = store(in_arrow(docs.select(F.col("doc_id").cast("long"), "text", *carried), _sign, schema), "signed")
    # Equal sets, the hottest groups, are one class from here on; nothing below grows with copies.
    classes = signed.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"), F.first("labels").alias("labels")
    )
    classes = store(classes, "classes")
    at = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.get("labels", 2 * t))
    trees = classes.select("cls", F.posexplode(at).alias("tree", "label"))
    # Both sides grow with the table, so neither is ever broadcast.
    shared = trees.groupBy("tree", "label").agg(F.count("*").alias("n")).where("n > 1")
    shared = shared.select("tree", "label", (F.col("n") > region_rows).alias("large")).hint("merge")
    shared = store(trees.join(shared, ["tree", "label"]).select("tree", "label", "cls", "large"), "trees")
    held = ["tree", "label", "cls", "signature"]
    regions = partial(_regions, agree=agree, most=region_rows)
    small = shared.where("not large").join(classes.select("cls", "signature"), "cls").select(*held)
    found = store(in_arrow(small.repartition("tree", "label").sortWithinPartitions("tree", "label", "cls"), regions, "a binary, b binary"), "runs")
    large = shared.where("large")
    if large.isEmpty():
        clusters = connected(found)
    else:
        deep = F.get("labels", 2 * F.col("tree") + 1).alias("deep")
        large = store(large.join(classes.select("cls", "signature", "labels"), "cls").select(*held, deep), "large")
        # With ``cls`` in the order, even equal signatures are dealt over partitions.
        order = ["tree", "label", "deep", "cls"]
        runs = large.repartitionByRange(*order).sortWithinPartitions(*order).select(*held)
        clusters = store(connected(found.union(store(in_arrow(runs, regions, "a binary, b binary"), "large-runs"))), "in-blocks")
        across = store(_across_blocks(large.select(*held), clusters, agree, region_rows), "across")
        clusters = connected(clusters.select(F.col("node").alias("a"), F.col("root").alias("b")).union(across))
    # The whole sets of the candidates, once each.
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    wanted = classes.select("cls", "doc_id").join(clusters.select(F.col("node").alias("cls"), F.col("root").alias("cluster")), "cls")
    wanted = store(wanted, "wanted")
    # Sets are made anew where a mark says that the text may be wanted; texts are not shuffled.
    marks = _marks(wanted.select(bit.alias("bit")))
    sets = in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(bit.alias("bit"), "text"), partial(_full_sets, marks=marks), "cls binary, held binary")
    members = sets.join(wanted.select("cls", "cluster"), "cls").dropDuplicates(["cls"]).select("cluster", "cls", "held")
    members = store(members, "members")
    links = connected(store(_exact_links(members, percent, cluster_shingles), "links"))
    rooted = classes.select("cls", "doc_id").join(links.select(F.col("node").alias("cls"), "root"), "cls", "left")
    rooted = rooted.select("cls", "doc_id", F.coalesce("root", "cls").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("cls", "component_id", F.col("root").alias("component"))
    extra = [] if key is None else ["key", "component"]
    out = signed.drop("signature", "labels").join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), *extra)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), *extra)
