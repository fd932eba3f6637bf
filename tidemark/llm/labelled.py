"""A bounded, even sample of labelled texts to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``, the fold of a document; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)), F.lit(0)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int) -> DataFrame:
    """``text`` and ``label`` of at most ``most`` labelled documents of each class among those ``learn`` admits.

    The choice follows a hash of the id, so it is the same in every run. Equal texts count
    once; ids labelled twice or without a label are left out where labels differ or are null.
    """
    known = labels.select("doc_id", F.col(label).alias("label")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & learn)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("high")).where("label = high").drop("high")
    classes = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    # At most 2 * most rows, so the broadcast is bounded whatever the tables hold.
    picked = F.broadcast(classes[0].union(classes[1]))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(picked, "doc_id").select("text", "label")
    return texts.groupBy("text").agg(F.min("label").alias("label"), F.max("label").alias("high")).where("label = high").select("text", "label")
