"""License scans by diagonal voting, in built-in functions only.

Every run of ``K`` words of every text is hashed and joined to the runs of the license
templates. A match votes for the difference of the two places, the diagonal: words that
stand in a template's order share one. Neighbouring diagonals, parted by a word left out or
put in, are merged, and a span counts when its matches, confirmed by a second hash, cover
enough of the template. The span is then verified on the document's words: those that tell
a license from its neighbours must be the template's, in its order, with none put in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 4
#: Diagonals this close are one.
NEIGHBOURS = 3
#: Share of a template's words that a span must cover.
COVERED = 0.75

#: Wordings of licenses and notices with the label of each. Fixed values.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

#: Words that decide which license a wording names, besides numbers.
DECIDING = [
    "affero", "alike", "cc0", "commercial", "derivatives", "derivs", "lesser", "lgpl", "library", "nc", "nd", "never", "no", "nocommercial",
    "noderivatives", "noderivs", "non", "noncommercial", "not", "sa", "share", "sharealike",
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def _runs(words: str) -> Column:
    """Two hashes of each run of ``K`` words; the last ``K - 1`` places hold shorter runs, which match no template's."""

    def at(w: Column, i: Column) -> Column:
        run = [w, *(F.get(F.col(words), i + j) for j in range(1, K))]
        return F.struct(F.xxhash64(*run).alias("h"), F.xxhash64(F.lit(K), *reversed(run)).alias("check"))

    return F.transform(words, at)


def _decides(word: Column) -> Column:
    return word.isin(DECIDING) | word.rlike("^v?[0-9]+$")


def _matching(words: str, hashes: list[int], reach: int) -> Column:
    """Runs whose hash is one of ``hashes``: place, hashes, and the deciding words from ``reach`` words before to twice as many after."""

    def kept(run: Column) -> Column:
        start = F.greatest(run["at"] - reach, F.lit(0))
        around = F.transform(F.slice(F.col(words), start + 1, 3 * reach), lambda w, j: F.struct((start + j).alias("spot"), w.alias("word")))
        return F.struct(run["at"].alias("at"), run["run"]["h"].alias("h"), run["run"]["check"].alias("check"), F.filter(around, lambda x: _decides(x["word"])).alias("near"))

    runs = F.transform(_runs(words), lambda run, i: F.struct(i.alias("at"), run.alias("run")))
    return F.transform(F.filter(runs, lambda x: x["run"]["h"].isin(hashes)), kept)


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = spark.createDataFrame(sorted(templates.items()), "label string, text string").withColumn("words", words_of(F.col("text")))
    rows = rows.withColumn("runs", F.slice(_runs("words"), 1, F.greatest(F.size("words") - K + 1, F.lit(0))))
    rows = rows.select("label", F.size("words").alias("length"), F.filter("words", _decides).alias("must"), F.posexplode("runs").alias("place", "run"))
    return rows.select("label", "length", "must", "place", "run.h", F.col("run.check").alias("confirm"))


def spans(docs: DataFrame, templates: dict[str, str] | None = None, covered: float = COVERED) -> DataFrame:
    """Verified spans: ``doc_id``, ``text_hash``, ``label``, ``first_word``, ``end_word``, ``votes``, ``coverage``.

    Rows that repeat an id and a text share their spans. The templates are a fixed list
    shorter than a page, so their runs are broadcast.
    """
    known = _templates(docs.sparkSession, TEMPLATES if templates is None else templates)
    held = known.select("h", "length").distinct().collect()
    hashes, longest = sorted({r["h"] for r in held}), max((r["length"] for r in held), default=0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    runs = rows.select("doc_id", "text_hash", F.explode(_matching("words", hashes, longest)).alias("run")).select("doc_id", "text_hash", "run.*")
    key = ["doc_id", "text_hash", "label", "length"]
    votes = runs.join(F.broadcast(known), "h").where("check = confirm").dropDuplicates([*key, "at", "place"]).select(*key, "at", "place", "near", "must")
    votes = votes.withColumn("diagonal", F.col("at") - F.col("place"))
    by_diagonal = Window.partitionBy(*key).orderBy("diagonal", "at")
    opens = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > NEIGHBOURS).cast("int"), F.lit(1))
    votes = votes.withColumn("opens", opens).withColumn("merged", F.sum("opens").over(by_diagonal))
    # Words of the template that a vote covers and those before it in the span do not.
    by_place = Window.partitionBy(*key, "merged").orderBy("place", "at")
    votes = votes.withColumn("fresh", F.coalesce(F.least(F.lit(K), F.col("place") - F.lag("place").over(by_place)), F.lit(K)))
    found = votes.groupBy(*key, "merged").agg(
        F.min("at").alias("first_word"),
        (F.max("at") + K).alias("end_word"),
        F.count("*").alias("votes"),
        (F.sum("fresh") / F.first("length")).alias("coverage"),
        F.first("must").alias("must"),
        F.min_by("near", "at").alias("near"),
        # Where the whole template would begin and end in the document.
        F.min_by("diagonal", "at").alias("start"),
        (F.max_by("diagonal", "at") + F.first("length")).alias("stop"),
        (F.max("diagonal") - F.min("diagonal")).alias("shifted"),
    )
    inside = F.filter("near", lambda x: (x["spot"] >= F.col("start")) & (x["spot"] < F.col("stop")))
    same = (F.transform(inside, lambda x: x["word"]) == F.col("must")) & (F.col("shifted") <= F.greatest(F.lit(NEIGHBOURS), F.col("length") * (1 - covered)))
    return found.where((F.col("coverage") >= covered) & same).select("doc_id", "text_hash", "label", "first_word", "end_word", "votes", "coverage")


def _base(words: str) -> Column:
    """Places of the phrases: the index of the first word, and the label."""

    def at(w: Column, i: Column) -> Column:
        one, two = F.get(F.col(words), i - 1), F.get(F.col(words), i - 2)
        place = lambda back, label: F.struct((i - back).cast("long").alias("at"), F.lit(label).alias("label"))
        return F.when(
            w == "license",
            F.when(one == "mit", place(1, "mit")).when(one == "apache", place(1, "apache")).when((one == "public") & (two == "general"), place(2, "gpl")),
        )

    return F.when(F.array_contains(words, "license"), F.array_compact(F.transform(words, at)))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score`` for every row.

    ``n_base`` counts the places of the phrases; ``labels`` adds the templates found. The
    score is the best coverage of a template, and one half at least where a phrase stands.
    Null and empty texts have no words and score 0. Rows that repeat an id are rows of
    their own, null ids included. Other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), F.coalesce(_base("words"), F.expr("cast(array() as array<struct<at:bigint,label:string>>)")).alias("base"))
    found = spans(docs, templates).groupBy("doc_id", "text_hash").agg(F.collect_set("label").alias("found"), F.max("coverage").alias("coverage"))
    found = found.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "found", "coverage")
    rows = rows.join(found, rows["doc_id"].eqNullSafe(found["id"]) & (rows["text_hash"] == found["hash"]), "left")
    places, labels = F.col("base.at"), F.array_distinct(F.col("base.label"))
    none = F.expr("cast(array() as array<string>)")
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(labels, F.coalesce("found", none)))), ",").alias("labels"),
        F.greatest(F.coalesce("coverage", F.lit(0.0)), F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
