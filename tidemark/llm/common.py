"""Helpers shared by the operators: stored tables, whole-column byte arrays, ranks without one task."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType
from pyspark.sql.window import Window

from tidemark.session import shared_path

ARCHIVE = "tidemark_code.zip"
#: Bytes of text handled at once inside a task; one longer text is handled alone.
CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words between white space: ``[^\x20\x09-\x0D]``.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, for sessions that were not given it with ``--py-files``."""
    context = spark.sparkContext
    if ARCHIVE in context._python_includes:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / ARCHIVE
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


def in_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def added(df: DataFrame, **kinds: str | DataType) -> StructType:
    """The schema of ``df`` with more columns."""
    out = StructType(list(df.schema.fields))
    for name, kind in kinds.items():
        out.add(name, kind)
    return out


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows, without copying; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if column.null_count == 0 else column.fill_null("").cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, of one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, stop
        row = stop


_TABLE_SEED = 20_011


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, in place (the finaliser of SplitMix64)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def multipliers(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit multipliers; a longer list begins with a shorter one."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, size=n, dtype=np.uint64) | np.uint64(1)


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of some rows in order, and each word's row."""
    base, data = offsets[0], data[offsets[0] : offsets[-1]]
    starts_of_rows = (offsets - base)[:-1]
    inside = is_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = starts_of_rows[starts_of_rows < len(data)]
    begins[first] = inside[first]
    at = np.flatnonzero(inside)
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    firsts = np.searchsorted(at, starts)
    lengths = np.diff(np.append(firsts, len(at)))
    place = at - np.repeat(starts, lengths)
    hashed = (fold[data[at]].astype(np.uint64) + np.uint64(1)) * multipliers(int(lengths.max()), _TABLE_SEED)[place]
    # Rows of one byte range are adjacent, so an empty row owns no start.
    return mix(np.add.reduceat(hashed, firsts)), np.searchsorted(offsets - base, starts, "right") - 1


def spread_rank(df: DataFrame, groups: list[str], order_hash: Column, ties: list[Column], name: str, weight: Column | None = None, bits: int = 10) -> DataFrame:
    """Add ``name``: rows (or weight) that come before a row in its group, in the order of an even 64-bit hash.

    A window over a whole group would put a hot group into one task, so rows are counted by
    the leading bits of the hash first and a window runs inside such a slice only. A group
    has ``2 ** bits`` slices.
    """
    weight = F.lit(1) if weight is None else weight
    df = df.withColumns({"_hash": order_hash, "_weight": weight.cast("long")}).withColumn("_slice", F.shiftrightunsigned(F.col("_hash"), 64 - bits))
    inside = Window.partitionBy(*groups, "_slice").orderBy("_hash", *ties).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = df.groupBy(*groups, "_slice").agg(F.sum("_weight").alias("_slice_weight"))
    slices = slices.select(*groups, "_slice", F.coalesce(F.sum("_slice_weight").over(before), F.lit(0)).alias("_before"))
    ranked = df.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    keys = [ranked[g].eqNullSafe(slices[g]) for g in [*groups, "_slice"]]
    condition = keys[0]
    for key in keys[1:]:
        condition = condition & key
    kept = [ranked[c] for c in df.columns if not c.startswith("_")]
    return ranked.join(slices, condition).select(*kept, (F.col("_before") + F.col("_inside")).alias(name))
