"""Sharding by balanced label propagation: linked documents move towards their neighbours' shards under row quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import spread_rank, store

SHARDS = 40
ROUNDS = 4
#: Most documents linked to one hub; a larger group is a chain of such stars.
STAR = 10_000


def equal_text_links(nodes: DataFrame, star: int) -> DataFrame:
    """``a`` and ``b``, ids of documents with equal texts, as a chain of stars of at most about ``star`` documents.

    A hub per star instead of one per group keeps every degree bounded, and lets a group
    larger than a shard fall into parts that fit.
    """
    sizes = nodes.groupBy("text_key").agg(F.count("*").alias("n")).where("n > 1")
    members = nodes.join(sizes, "text_key").select("text_key", "node", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / star)).alias("part"))
    hubs = store(members.groupBy("text_key", "part").agg(F.min("node").alias("hub")), "hubs")
    spokes = members.join(hubs, ["text_key", "part"]).where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    after = F.lead("hub").over(Window.partitionBy("text_key").orderBy("part"))
    return spokes.union(hubs.select(F.col("hub").alias("a"), after.alias("b")).where("b is not null"))


def _gains(placed: DataFrame, edges: DataFrame) -> DataFrame:
    """Moves that keep more links whole: ``node``, ``shard``, ``target``, ``gain``.

    Of two neighbours only the larger id may move, else both would swap places; a
    neighbourhood's smallest document stays put.
    """
    near = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).unionByName(
        edges.select(F.least("a", "b").alias("node"), F.greatest("a", "b").alias("other"))
    )
    votes = near.join(placed.select(F.col("node").alias("other"), F.col("shard").alias("seen")), "other")
    votes = votes.groupBy("node", "seen").agg(F.count("*").alias("n"), F.max(F.col("other") < F.col("node")).alias("led"))
    best = votes.join(placed, "node").groupBy("node", "shard").agg(
        F.max(F.when(F.col("led"), F.struct("n", (-F.col("seen")).alias("minus")))).alias("best"),
        F.max(F.when(F.col("seen") == F.col("shard"), F.col("n"))).alias("own"),
    )
    gain = F.col("best.n") - F.coalesce("own", F.lit(0))
    return best.select("node", "shard", (-F.col("best.minus")).alias("target"), gain.alias("gain")).where("gain > 0 and target <> shard")


def _ranked(moves: DataFrame) -> DataFrame:
    """Rank in the queue for a shard: a fixed even order, so that no shard's queue is one task's work."""
    return spread_rank(moves, ["target"], F.xxhash64("node", F.lit(7)), [F.col("node")], "place")


def _rounds(linked: DataFrame, edges: DataFrame, room: list[int], rounds: int) -> DataFrame:
    """Run the rounds; ``room`` is the most rows of each shard, never exceeded."""
    placed = linked
    for _ in range(rounds):
        moves = store(_ranked(_gains(placed, edges)), "moves")
        if moves.isEmpty():
            break
        taken = {row["shard"]: row["count"] for row in placed.groupBy("shard").count().collect()}  # one row a shard
        free = F.array(*[F.lit(most - taken.get(j, 0)).cast("long") for j, most in enumerate(room)])
        # A move is granted while its shard has room for it beside all that is there now. What
        # leaves for certain makes room for more, shard by shard in both directions.
        pair = Window.partitionBy("low", "high")
        fits = moves.withColumn("granted", F.col("place") < F.get(free, F.col("target")))
        late = fits.where("not granted").select("node", "shard", "target")
        late = late.withColumns({"low": F.least("shard", "target"), "high": F.greatest("shard", "target")})
        counts = late.groupBy("low", "high").agg(F.count(F.when(F.col("shard") == F.col("low"), 1)).alias("up"), F.count(F.when(F.col("shard") == F.col("high"), 1)).alias("down"))
        swaps = spread_rank(late, ["shard", "target"], F.xxhash64("node", F.lit(9)), [F.col("node")], "at")
        swaps = swaps.join(counts, ["low", "high"]).where("at < least(up, down)").select("node", "target")
        granted = store(fits.where("granted").select("node", "target").union(swaps), "granted")
        placed = placed.join(granted, "node", "left")
        placed = store(placed.select("node", F.coalesce("target", "shard").alias("shard")), "placed")
    return placed


def balanced_shards(docs: DataFrame, edges: DataFrame | None = None, shards: int = SHARDS, rounds: int = ROUNDS, star: int = STAR, key: Column | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` for every row, shards differing by one row at most.

    Rows with equal texts are linked; ``edges`` (columns ``a`` and ``b``, document ids) adds
    links. Linked rows start dealt out evenly, then in each round move to the shard most of
    their neighbours are in, as far as the quotas allow. Rows without links fill the shards
    up to quotas that differ by one. ``slot`` counts a shard's rows from 0. Null texts are
    empty; a null id is placed like any other but ``edges`` cannot name it; rows that repeat
    an id are placed one by one, the first of them carrying the edges. Other columns are
    ignored. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    nodes = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )
    nodes = nodes.withColumns({"text_key": F.struct("h", "text_crc32", "size"), "node": F.monotonically_increasing_id()}).drop("h")
    nodes = store(nodes, "nodes")
    rows = nodes.count()
    room = [rows // shards + (j < rows % shards) for j in range(shards)]
    links = equal_text_links(nodes, max(1, min(star, rows // shards // 4)))
    if edges is not None:
        named = nodes.groupBy("doc_id").agg(F.min("node").alias("node"))
        for end in ("a", "b"):
            edges = edges.join(named.select(F.col("doc_id").alias(end), F.col("node").alias(f"{end}_node")), end)
        links = links.union(edges.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).where("a <> b"))
    links = store(links.distinct(), "links")
    linked = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    order = F.xxhash64("node", F.lit(3))
    dealt = spread_rank(linked, [], order, [F.col("node")], "place")
    placed = store(dealt.select("node", F.pmod("place", F.lit(shards)).cast("int").alias("shard")), "dealt")
    placed = _rounds(placed, links, room, rounds)
    # The rest fills up the quotas, in an order of its own.
    taken = {row["shard"]: row["count"] for row in placed.groupBy("shard").count().collect()}
    ends, total = [], 0
    for j, most in enumerate(room):
        total += most - taken.get(j, 0)
        ends.append(total)
    rest = spread_rank(nodes.join(placed, "node", "left_anti").select("node"), [], order, [F.col("node")], "place")
    bounds = F.array(*[F.lit(end).cast("long") for end in ends])
    rest = rest.select("node", F.size(F.filter(bounds, lambda end: end <= F.col("place"))).cast("int").alias("shard"))
    placed = store(placed.union(rest), "shards")
    slotted = spread_rank(placed, ["shard"], F.xxhash64("node", F.lit(11)), [F.col("node")], "slot")
    return nodes.join(slotted, "node").select("doc_id", "size", "text_crc32", "shard", "slot")
