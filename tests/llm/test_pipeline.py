"""The pipeline's stages, each on what the one before kept."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from compare import differences, duck
from pyspark.sql import functions as F
from test_llm_operators import AWKWARD, BASE

from tidemark.llm import mixing, registered

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, SF), f"test-{name}")
        counts.append(docs.count())
        if name != "sharding":
            assert docs.columns == columns
    toxic, near, clean, mixed, sharded = counts[1:]
    assert counts[0] > toxic > near > clean > 0 and mixed == sharded
    sizes = [r["count"] for r in docs.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def kept_near(spark, rows):
    docs = spark.createDataFrame([(i, t, "src1", "en") for i, t in rows], "doc_id long, text string, source string, lang string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    return Counter((r["doc_id"], r["text"]) for r in kept.collect())


def test_near_duplicates_are_dropped_by_row(spark):
    kept = {1, 2, 3, 4, 5, 6, 10, 11, 12, -5}
    assert kept_near(spark, AWKWARD) == Counter((i, t) for i, t in AWKWARD if i in kept or t == "nobody's text")
    # No null-id row is a near copy of one with an id; an id repeats, with other texts, and one of its texts is a copy.
    rows = [(None, "alpha beta"), (None, "gamma delta"), (7, "one text"), (7, "another text"), (8, "another text"), (9, "x y"), (9, "x y"), (None, BASE), (None, BASE), (None, BASE + " more")]
    got = kept_near(spark, rows)
    assert sum(n for (i, t), n in got.items() if t.startswith(BASE)) == 1
    assert Counter({k: n for k, n in got.items() if not k[1].startswith(BASE)}) == Counter([(None, "alpha beta"), (None, "gamma delta"), (7, "one text"), (7, "another text"), (9, "x y")])
    assert kept_near(spark, [(7, "one text"), (8, "second text")]) == Counter([(7, "one text"), (8, "second text")])
    assert kept_near(spark, []) == Counter()


def test_mix_takes_rows_of_one_id_by_their_own_copies(spark):
    # Rows without an id in several leaves: each is taken as often as the mix says for it.
    rows = [(None if i % 2 else 5, f"text {i} " + "w " * (i % 7), f"src{i % 5}", "en" if i % 3 else "fr") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    want = Counter()
    for r in mixing.mix(docs, registered.levels(), registered.WEIGHTS, key=F.xxhash64("text")).collect():
        want[r["doc_id"], r["key"]] += r["copies"]
    got = corpus_pipeline.mix_sources(spark, docs, SF).select("doc_id", F.xxhash64("text").alias("key")).collect()
    assert Counter(map(tuple, got)) == +want and len(set(want.values())) > 1


@pytest.fixture
def small(spark, tmp_path):
    """Awkward documents, and tables beside them to learn and to search from."""
    held = {
        "documents": spark.createDataFrame([(i, f"kind words number {i}" if i % 2 else f"wretchedly vile fool {i}") for i in range(100, 200)], "doc_id long, text string"),
        "labels": spark.createDataFrame([(i, 1, int(i % 2 == 0)) for i in range(100, 200)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, "One two"), (2, "nobody's text"), (3, None)], "item_id long, text string"),
    }
    for name, rows in held.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.createDataFrame([(i, t, "src1", "en") for i, t in [*AWKWARD, (20, "a vile fool")]], "doc_id long, text string, source string, lang string")
    return docs, str(tmp_path)


def rows_of(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_each_stage_on_awkward_rows(spark, small):
    docs, sf = small
    rows = [*AWKWARD, (20, "a vile fool")]
    lexicon = registered.learned_lexicon(spark, sf)
    toxic = {t for _, t in rows if lexicon.score(lexicon.raw(t)[0]) >= registered.THRESHOLD}
    assert toxic == {"a vile fool"}
    assert rows_of(corpus_pipeline.drop_toxic(spark, docs, sf)) == Counter(r for r in rows if r[1] not in toxic)
    assert rows_of(corpus_pipeline.drop_contaminated(spark, docs, sf)) == Counter(r for r in rows if r[1] not in ("One two", "nobody's text"))
    # The budget is all tokens and this is one leaf, so that each document is taken once.
    assert rows_of(corpus_pipeline.mix_sources(spark, docs, sf)) == Counter(rows)
    sharded = corpus_pipeline.shard(spark, docs, sf).collect()
    assert Counter(r["doc_id"] for r in sharded) == Counter(i for i, _ in rows)


def test_each_stage_on_an_empty_table(spark, small):
    docs, sf = small
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf).collect() == []


@pytest.mark.parametrize("key", sorted(registered.ORACLES))
def test_matches_sql(spark, key):
    sf = "/root/testdata/sf0.001"
    with duck(sf) as connection:
        assert differences(registered.QUERIES[key](spark, sf), connection, registered.ORACLES[key]) == []


CLASHING = ["toxicity", "toxic_hits", "_hits", "_items", "_n_words", "_id", "_key", "_copies", "_copy", "key", "component", "kept", "Domain", "copies", "n_tokens", "_row", "_hash", "size"]


def test_columns_with_the_operators_own_names_are_kept(spark, small):
    _, sf_dir = small
    docs = spark.createDataFrame([(i, t, "en", "src1", 0, *[f"{c} {i}" for c in CLASHING]) for i, t in AWKWARD], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING))
    plain = docs.select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        got, want = stage(spark, docs, sf_dir), stage(spark, plain, sf_dir)
        if name == "sharding":
            assert got.columns == want.columns and got.count() == want.count()
            continue
        assert got.columns == docs.columns
        rows = got.collect()
        assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in want.collect())
        assert all(r[c] == f"{c} {r['doc_id']}" for r in rows for c in CLASHING), name
