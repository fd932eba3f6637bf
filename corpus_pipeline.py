"""The corpus pipeline: toxic documents go, near duplicates and contaminated documents go, sources are mixed and dealt to shards.

Each stage's rows are written to the shared folder and read back as the next one's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, sharding
from tidemark.llm.common import store, table
from tidemark.llm.decontaminate import uncontaminated
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.registered import THRESHOLD, WEIGHTS, learned_lexicon, levels
from tidemark.llm.toxicity import toxicity


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage: Callable) -> Callable:
    """A stage for documents with further columns, whatever their names: it sees them under names that no operator uses."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: f"extra__{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        if not names:
            return stage(spark, docs, sf_dir)
        out = stage(spark, docs.withColumnsRenamed(names), sf_dir)
        return out.withColumnsRenamed({safe: name for name, safe in names.items() if safe in out.columns})

    return run_stage


@keeps_columns
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring below the threshold; the lexicon is learned from the labelled documents of the source tables."""
    return toxicity(docs, learned_lexicon(spark, sf_dir)).where(F.col("toxicity") < THRESHOLD).select(*docs.columns)


def row_key() -> Column:
    """Tells rows of one id, or of none, apart by their text."""
    return F.xxhash64("text", F.length("text"))


def same_row(docs: DataFrame, marked: DataFrame) -> Column:
    """Rows of ``docs`` meet those of ``marked`` by ``_id``, nulls included, and ``_key``."""
    return docs["doc_id"].eqNullSafe(marked["_id"]) & (row_key() == marked["_key"])


@keeps_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more, the one with the smallest id.

    A null id is larger than any other; of rows with one id the smallest key is taken. Rows
    repeating both id and text count as one. Others that share an id, or have none, are
    documents of their own, and those without words are linked with nothing.
    """
    found = near_duplicates(docs, percent=80, key=row_key())
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    found = store(found.where("component is not null").select("component", row.alias("row")), "near-rows")
    # Stored, so that it is broadcast or Spark can split a hot component in the join.
    first = store(found.groupBy("component").agg(F.min("row").alias("first")), "near-first")
    gone = found.join(first, "component").where("not (row <=> first)").select(F.col("row.doc_id").alias("_id"), F.col("row.key").alias("_key")).distinct()
    rows = docs.join(gone, same_row(docs, gone), "left_anti")
    repeated = docs.groupBy("doc_id", row_key()).count().where("count > 1")
    return rows if repeated.isEmpty() else rows.withColumn("_key", row_key()).dropDuplicates(["doc_id", "_key"]).select(*docs.columns)


@keeps_columns
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without enough benchmark passages to be contaminated."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


@keeps_columns
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, from not at all to twice; rows repeating both id and text as often as the one taken most."""
    mixed = mixing.mix(docs, levels(), WEIGHTS, key=row_key()).where("copies > 0")
    mixed = mixed.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.max("copies").cast("int").alias("_copies"))
    rows = docs.join(mixed, same_row(docs, mixed))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


@keeps_columns
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document that is left."""
    return sharding.balanced_shards(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Learned weights, signatures and iterated moves have no SQL form; tests/llm/test_pipeline.py runs each stage on awkward and empty tables and names the rows it must keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
