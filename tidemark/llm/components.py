"""Connected components of an edge table: forests of chunks, hooking and pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, store

#: Edges whose forest is built in one go inside a task.
CHUNK_EDGES = 1 << 18


def _least(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that the edges lead to."""
    root = np.arange(n)
    while True:
        one, other = root[a], root[b]
        if (one == other).all():
            return root
        np.minimum.at(root, np.maximum(one, other), np.minimum(one, other))
        while (root[root] != root).any():
            root = root[root]


def _forest(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Each node of a chunk of edges with the smallest node it is joined to there, unless that is itself."""
    held, rows = [], 0

    def settle() -> pa.RecordBatch:
        edges = pa.Table.from_batches(held)
        coded = pa.chunked_array([*edges["a"].chunks, *edges["b"].chunks]).combine_chunks().dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = rank[coded.indices.to_numpy()]
        root = _least(at[: len(edges)], at[len(edges) :], len(order))
        nodes = np.flatnonzero(root != np.arange(len(order)))
        return pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(order[i])) for i in (nodes, root[nodes])], names=["a", "b"])

    for batch in batches:
        for start in range(0, len(batch), most):
            part = batch.slice(start, most)
            if rows and rows + len(part) > most:
                yield settle()
                held, rows = [], 0
            held.append(part)
            rows += len(part)
    if rows:
        yield settle()


def connected(edges: DataFrame, rounds: int = 60, chunk: int = CHUNK_EDGES) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node with an edge.

    ``edges`` has columns ``a`` and ``b`` of any ordered type; loops, repeats, nulls and
    either direction are allowed, and nodes only in loops do not appear. In a round, tasks
    make the chunks they read into stars, which leaves a node one smaller neighbour a chunk;
    every node then keeps the smallest of them, to which the others are hooked; and every
    edge moves on to the smallest neighbour of its smaller node, by a sort-merge join whose
    hot keys Spark can split. A round writes two tables to the shared folder. Rounds grow
    with the logarithm of the size; not ending raises. Edges that Python makes are best
    stored first: a task that makes them and their stars at once holds two Python workers.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    pair = edges.schema
    for _ in range(rounds):
        stars = in_arrow(edges.select("a", "b"), partial(_forest, most=chunk), pair)
        hooks = stars.groupBy("a").agg(F.min("b").alias("m"), F.collect_set("b").alias("near"))
        # Stored, so that Spark can broadcast them or split a hot node in the join.
        hooks = store(hooks, "hooks")
        hooked = hooks.select(F.col("a").alias("node"), "m", F.explode("near").alias("b"))
        hooked = hooked.select(F.when(F.col("b") == F.col("m"), F.col("node")).otherwise(F.col("b")).alias("x"), F.col("m").alias("y"), (F.col("b") != F.col("m")).alias("extra"))
        moved = hooked.join(hooks.select(F.col("a").alias("y"), F.col("m").alias("up")), "y", "left")
        moved = moved.select(F.col("x").alias("a"), F.coalesce("up", "y").alias("b"), (F.col("extra") | F.col("up").isNotNull()).alias("open"))
        edges = store(moved, "edges")
        if edges.where("open").isEmpty():
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
