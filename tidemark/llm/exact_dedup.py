"""Exact duplicates through an extendible-hash index on shared files, in built-in functions only.

A text's key is the 64-bit hash of its normalised form. The directory doubles until each
bucket holds at most ``CAPACITY`` distinct keys; the index is written to the shared folder
by bucket. Only keys that occur more than once have texts to compare. Their copies are
combined by key and bytes before anything is moved; what is left, one entry for each
distinct text, goes to the task that owns its range of buckets and keys, which chains the
entries of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import store

#: Distinct keys in a bucket.
CAPACITY = 65_536
#: The directory has at most ``2 ** DEPTH`` slots; the histogram it is made from is as small.
DEPTH = 14


#: Bits of the bitmap of keys that occur more than once, and of each of its rows.
MARKS, CHUNK = 1 << 24, 8 * 4096


def _bit() -> Column:
    return F.pmod("key", F.lit(MARKS))


def normalised(text: str = "text") -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def directory(counts: list[int], capacity: int) -> list[int]:
    """Bucket of each slot. Starting from one bucket, an overfull one is split in halves, doubling the directory when it has to."""
    depth = len(counts).bit_length() - 1
    slots = [0]
    pending, done = {0: (0, 1)}, 1  # bucket -> first slot and share at the present depth
    totals = {0: sum(counts)}
    for d in range(depth):
        slots = [bucket for bucket in slots for _ in (0, 1)]  # the directory doubles
        pending = {bucket: (2 * first, 2 * share) for bucket, (first, share) in pending.items()}
        width = len(counts) >> (d + 1)
        for bucket, (first, share) in list(pending.items()):
            if totals[bucket] <= capacity:
                continue
            half = first + share // 2
            new, done = done, done + 1
            for slot in range(half, first + share):
                slots[slot] = new
            totals[new] = sum(counts[half * width : (first + share) * width])
            totals[bucket] -= totals[new]
            pending[bucket], pending[new] = (first, share // 2), (half, share - share // 2)
        if all(totals[bucket] <= capacity for bucket in pending):
            return [slots[slot >> (depth - d - 1)] for slot in range(len(counts))]
    return slots if depth else [0] * len(counts)


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` for every row of ``docs``.

    Texts are equal when their normalised forms have the same bytes; a null text is empty,
    and empty texts are equal. The smallest ``doc_id`` of a group is its ``keep_id``, nulls
    last: a group of null ids alone has a null ``keep_id`` and its rows count as kept. Rows
    that repeat an id are rows of their own (both kept if the id is the smallest). Other
    columns are ignored. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("norm")).withColumn("key", F.xxhash64("norm"))
    entries = store(texts.select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256")), "entries")
    keys = entries.groupBy("key").agg(F.count("*").alias("size"), F.min("doc_id").alias("least"))
    keys = store(keys, "keys")
    slot = F.shiftrightunsigned("key", 64 - depth).cast("int")
    counts = [0] * 2**depth
    for row in keys.groupBy(slot.alias("slot")).count().toLocalIterator():
        counts[row["slot"]] = row["count"]
    slots = directory(counts, capacity)
    firsts = [i for i in range(len(slots)) if i == 0 or slots[i] != slots[i - 1]]
    runs = [(slots[a], a, b - 1) for a, b in zip(firsts, [*firsts[1:], len(slots)], strict=True)]
    buckets = docs.sparkSession.createDataFrame(runs, "bucket int, first int, last int")
    # The directory has 2 ** depth slots at most, whatever the size of the table.
    buckets = F.broadcast(buckets.select("bucket", F.explode(F.sequence("first", "last")).alias("slot")))
    index = keys.withColumn("slot", slot).join(buckets, "slot").drop("slot")
    index = index.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key")
    index = store(index, "index")
    # Chains: the distinct texts of each key that occurs more than once, compared byte by byte
    # and combined before the shuffle. A bitmap of fixed size keeps most other texts out of it.
    marks = index.where("size > 1").select(_bit().alias("bit")).groupBy(F.expr(f"bit div {CHUNK}").alias("chunk"))
    marks = F.broadcast(marks.agg(F.bitmap_construct_agg(F.col("bit") % CHUNK).alias("marks")))
    place = F.col("bit") % CHUNK
    byte = F.conv(F.hex(F.substring("marks", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = texts.withColumn("bit", _bit()).join(marks, F.expr(f"bit div {CHUNK}") == F.col("chunk")).where(F.getbit(byte, (place % 8).cast("int")) == 1)
    chained = marked.groupBy("key", "norm").agg(F.count("*").alias("size"), F.min("doc_id").alias("least"))
    # To the owners: a range of (bucket, key) holds all entries of its keys, so chaining them moves nothing more.
    owned = chained.withColumn("slot", slot).join(buckets, "slot").drop("slot").repartitionByRange("bucket", "key")
    chained = owned.withColumn("links", F.count("*").over(Window.partitionBy("bucket", "key"))).where("size > 1 or links > 1")
    chained = store(chained, "chains")
    single = index.where("size = 1").select("key", "size", "least").union(chained.where("links = 1").select("key", "size", "least"))
    out = entries.join(single, "key", "left")
    crossed = chained.where("links > 1").select("key", "norm", "size", "least")
    if not crossed.isEmpty():
        # Two texts with one hash: only these keys' rows meet on the text itself.
        apart = entries.join(crossed.select("key").distinct(), "key", "left_anti").join(single, "key")
        met = texts.join(crossed, ["key", "norm"]).select("key", "doc_id", F.sha2("norm", 256).alias("text_sha256"), "size", "least")
        out = apart.unionByName(met)
    return out.select("doc_id", F.col("least").alias("keep_id"), F.col("size").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("least")).alias("kept"), "text_sha256")
