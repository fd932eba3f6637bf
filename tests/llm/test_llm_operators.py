"""The operators against brute force and on awkward tables."""

from __future__ import annotations

import html
import random
import re
import struct
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import components, licenses, main_text, mixing, near_dedup, quality, registered, sharding, token_output, toxicity
from tidemark.llm.common import store
from tidemark.llm.components import connected
from tidemark.llm.decontaminate import contaminated_words, contamination, uncontaminated
from tidemark.llm.elias_fano import EliasFano, encode
from tidemark.llm.exact_dedup import directory, exact_duplicates
from tidemark.llm.token_output import token_dataset

SF = "/root/testdata/sf0.001"
#: Columns whose names the operators might use themselves.
CLASHES = "score double, key string, cls string, shard int, hits int, n_words int, copies int, node long"

BASE = " ".join(f"word{i}" for i in range(60))
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One two"), (6, BASE), (7, BASE.upper()), (8, BASE + " more"), (8, BASE + " more"), (9, BASE.replace(" ", "\n\t")),
    (None, "nobody's text"), (None, BASE), (10, "é ü ñ \U0001f600 <|endoftext|>  two   spaces \n \n end"), (11, "x" * 70_000), (12, "ab " * 40_000), (-5, "below nought"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, *[None] * 8) for i, t in AWKWARD]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHES}").withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("src1")})


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.where("false")


def spaced_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def linked(docs, percent):
    sets = []
    for _, text in docs:
        words = spaced_words(text)
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    places = defaultdict(list)
    for i, found in enumerate(sets):
        for shingle in found:
            places[shingle].append(i)
    for i, found in enumerate(sets):
        common = Counter(j for shingle in found for j in places[shingle] if j < i)
        for j, n in common.items():
            if 100 * n >= percent * (len(found) + len(sets[j]) - n):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (name, _) in enumerate(docs):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return Counter((name, len(sets[i]), least.get(find(i)) if sets[i] else name) for i, (name, _) in enumerate(docs))


def found_links(df, percent, **options):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(df, percent, **options).collect())


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_match_brute_force(spark, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert found_links(docs, percent) == linked([tuple(r) for r in docs.collect()], percent)


def test_near_duplicates_of_awkward_rows(awkward, nothing):
    assert found_links(awkward, 85) == linked(AWKWARD, 85)
    assert near_dedup.near_duplicates(nothing).collect() == []


def test_a_cluster_too_large_for_a_task_loses_no_link(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(120):
        own = list(words[: 300 + 2 * (i // 12)])
        for j in rng.integers(0, len(own), rng.integers(0, 5)):
            own[j] = f"x{i}"
        docs.append((i, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found_links(df, 85, cluster_shingles=2_000) == linked(docs, 85)


def test_buckets_too_large_for_a_task_lose_no_link(spark):
    # All share a passage, so that buckets are large and most of their sets are not linked; some are near copies of others.
    rng = np.random.default_rng(7)
    passage = [f"p{i}" for i in range(120)]
    docs = [(i, " ".join([*passage, *(f"own{i // 2 if i % 9 < 2 else i + 1000}x{j}" for j in range(50)), *["z"] * int(rng.integers(1, 4))])) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(16)
    want = linked(docs, 85)
    assert 1 < len({r[2] for r in want}) < 400
    assert found_links(df, 85, region_rows=8) == want == found_links(df, 85)


def test_sets_beside_heads_meet_across_blocks():
    # y and z are one group, whose first set does not agree with x; z does.
    marks = np.zeros((3, near_dedup.PERMUTATIONS), np.uint8)
    marks[1, :30], marks[2, :60] = 1, 1
    names, met = [b"y", b"z", b"x"], np.array([False, False, True])
    assert list(near_dedup._meet(names, marks, [b"y", b"y", b"x"], met, 90)) == [(b"z", b"x")]
    assert list(near_dedup._meet(names, marks, [b"y", b"y", b"y"], met, 90)) == []


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(7, 7)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {}
    for a, b in pairs:
        for x in (a, b):
            root.setdefault(x, x)
    for _ in range(400):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    in_edges = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: root[x] for x in in_edges}


def test_components_in_small_chunks_and_few_tables(spark, monkeypatch):
    up = [*range(0, 60, 2), *range(59, 0, -2)]  # rises, then falls: one node has two smaller neighbours
    pairs = list(zip(up, up[1:], strict=False)) + [(100 + i, 100 + (7 * i + 3) % 50) for i in range(50)] + [(200, 200 + i) for i in range(30)] + [(None, 4), (5, None)]
    root = {x: x for pair in pairs for x in pair}
    for _ in range(200):
        for a, b in pairs:
            if a is not None and b is not None:
                root[a] = root[b] = min(root[a], root[b])
    want = {x: root[x] for a, b in pairs if a != b and None not in (a, b) for x in (a, b)}
    written = []
    monkeypatch.setattr(components, "store", lambda df, name: written.append(name) or store(df, name))
    edges = store(spark.createDataFrame(pairs, "a long, b long").repartition(4), "pairs")
    for chunk in (3, 1 << 18):
        rows = connected(edges, chunk=chunk).collect()
        assert {r["node"]: r["root"] for r in rows} == want and len(rows) == len(want)
    # Tables cost a task for every partition of a shuffle, however few the edges are.
    written.clear()
    text = edges.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b")).coalesce(1)
    assert len(connected(text).collect()) == len(want) and len(written) == 2
    assert connected(edges.limit(0)).collect() == []


def test_exact_duplicates_of_awkward_rows(awkward, nothing):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in AWKWARD]
    least = {}
    for (name, _), text in zip(AWKWARD, texts, strict=True):
        if name is not None:
            least[text] = min(name, least.get(text, name))
    want = Counter((name, least.get(text), texts.count(text), name == least.get(text)) for (name, _), text in zip(AWKWARD, texts, strict=True))
    got = exact_duplicates(awkward, capacity=2, depth=4).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == want
    assert exact_duplicates(nothing).collect() == []


def test_directory_doubles_until_buckets_fit():
    counts = [5, 0, 0, 1, 9, 1, 1, 1]
    slots = directory(counts, 9)
    held = Counter()
    for slot, bucket in enumerate(slots):
        held[bucket] += counts[slot]
    assert max(held.values()) <= 9 and len(held) < len(counts)
    assert directory([0] * 4, 3) == [0] * 4


@pytest.mark.parametrize("values", [[], [0], [9], [0, 0, 0], [1, 5, 5, 900, 2**40], [2**63] * 3])
def test_elias_fano_round_trip(values):
    held = EliasFano(encode(np.array(values, np.uint64)))
    assert held.values().tolist() == values and [held[i] for i in range(len(held))] == values


def test_elias_fano_space_and_order():
    values = np.sort(np.random.default_rng(0).integers(0, 10**7, 50_000)).astype(np.uint64)
    data = encode(values)
    assert len(data) * 8 < len(values) * (2 + np.log2(10**7 / 50_000) + 1)
    assert [EliasFano(data)[i] for i in range(0, 50_000, 997)] == values[::997].tolist()
    with pytest.raises(ValueError, match="decrease"):
        encode(values[::-1])


def tokens_by_hand(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(registered.tokenizer_path())
    start, out = 0, []
    for name, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((name, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_tokens_round_trip(spark, awkward, nothing):
    rows = [r for r in AWKWARD if r[0] is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, token_dataset(df, registered.tokenizer_path()).collect())) == sorted(tokens_by_hand(sorted(rows, key=lambda r: r[0])))
    assert token_dataset(awkward, registered.tokenizer_path()).count() == len(AWKWARD)
    assert token_dataset(nothing, registered.tokenizer_path()).collect() == []


def test_segments_are_read_where_they_are(spark):
    df = spark.createDataFrame([(n, f"word {n}") for n in range(50)], "doc_id long, text string")
    found = token_dataset(df, registered.tokenizer_path())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(" not in plan
    assert sorted(map(tuple, found.collect())) == tokens_by_hand(map(tuple, df.collect()))


def test_special_strings_are_encoded_as_by_a_plain_call(spark):
    df = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "<|endoftext|>" * 3), (3, "a <|endoftext b")], "doc_id long, text string")
    assert sorted(map(tuple, token_dataset(df, registered.tokenizer_path()).collect())) == tokens_by_hand(map(tuple, df.collect()))


def test_contamination_matches_words(spark, awkward, nothing):
    items = [(1, BASE[:200]), (2, "one two"), (3, None), (4, "..."), (2, "absent words"), (None, "below nought")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (8 << 20, 50):  # one automaton, and several passes
        found = contaminated_words(awkward, bench, automaton_bytes=size).collect()
        got = Counter((r["doc_id"], r["n_words"], tuple(r["items"]), len(r["hits"])) for r in found)
        assert got[(5, 2, ("2",), 2)] == 1 and got[(-5, 2, ("",), 2)] == 1 and got[(1, 0, (), 0)] == 1
        assert got[(8, 61, ("1",), 30)] == 2
    assert contamination(awkward, bench.where("false")).where("contaminated").count() == 0
    clashing = awkward.withColumns({"_hits": F.lit("mine"), "_ITEMS": F.lit(1), "_row": F.lit(2)})
    assert {(r["_hits"], r["_ITEMS"], r["_row"]) for r in uncontaminated(clashing, bench).collect()} == {("mine", 1, 2)}
    assert contamination(nothing, bench).collect() == []
    kept = uncontaminated(awkward, bench)
    assert kept.columns == awkward.columns and {5, -5, 6} & {r["doc_id"] for r in kept.collect()} == set()


def test_a_large_benchmark_is_searched_for_in_passes(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words, 40))) for i in range(60)]
    docs = [(i, " ".join([*rng.choice(words, 30), *items[int(rng.integers(60))][1].split()[: int(rng.integers(0, 40))], *items[int(rng.integers(60))][1].split()[5:25]])) for i in range(80)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = {r["doc_id"]: r.asDict() for r in contaminated_words(df, bench).collect()}
    many = {r["doc_id"]: r.asDict() for r in contaminated_words(df, bench, automaton_bytes=1500).collect()}
    assert one == many and sum(len(r["items"]) > 1 for r in one.values()) > 20


def test_spans_are_of_the_original(spark):
    df = spark.createDataFrame([(1, "Say: ÉTÉ --One,  Two! three")], "doc_id long, text string")
    row = contaminated_words(df, spark.createDataFrame([(1, "one two")], "item_id long, text string")).first()
    assert [df.first()["text"][s["start"] : s["stop"]] for s in row["spans"]] == ["One,  Two"]


def test_shards_differ_by_a_row_and_keep_groups(spark, awkward, nothing):
    groups = [(i, f"text {i // 5}") for i in range(100)] + [(i, f"alone {i}") for i in range(100, 203)]
    df = spark.createDataFrame(groups, "doc_id long, text string")
    rows = sharding.balanced_shards(df, shards=8).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == 203 and max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 8
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    texts = dict(groups)
    spread = defaultdict(set)
    for r in rows:
        spread[texts[r["doc_id"]]].add(r["shard"])
        assert r["size"] == len(texts[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    assert sum(len(s) == 1 for t, s in spread.items() if t.startswith("text")) >= 18
    assert sharding.balanced_shards(awkward, shards=3).count() == len(AWKWARD)
    assert sharding.balanced_shards(nothing).collect() == []


def test_links_move_documents_together(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "doc_id long, text string")
    edges = spark.createDataFrame([(i - i % 4, i) for i in range(80) if i % 4], "a long, b long")
    at = {r["doc_id"]: r["shard"] for r in sharding.balanced_shards(df, edges, shards=10).collect()}
    assert sum(at[r["a"]] == at[r["b"]] for r in edges.collect()) >= 55


def test_shortages_go_to_siblings_first(spark):
    rows = [(i, "w " * 10, "d0", "a") for i in range(2)] + [(10 + i, "w " * 10, "d0", "b") for i in range(50)] + [(100 + i, "w " * 10, "d1", "a") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string")
    mixed = mixing.mix(df, {"domain": F.col("domain"), "lang": F.col("lang")}, {}, share=(400, 1020), epochs=1).collect()
    taken = Counter()
    for r in mixed:
        taken[r["domain"], r["lang"]] += r["copies"] * r["n_tokens"]
    assert taken == {("d0", "a"): 20, ("d0", "b"): 180, ("d1", "a"): 200}


def test_mix_of_awkward_rows(awkward, nothing):
    levels = registered.levels()
    assert mixing.mix(awkward, levels, registered.WEIGHTS).count() == len(AWKWARD)
    assert mixing.mix(nothing, levels, registered.WEIGHTS).collect() == []


def test_licenses_of_awkward_rows(spark, awkward, nothing):
    rows = licenses.license_scan(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(r["score"] == 0 and r["labels"] == "" for r in rows)
    assert licenses.license_scan(nothing).collect() == []
    texts = ["x MIT License; the general public license", "a b Licensed under (the) Apache License, Version 2.0 c", "Redistribution and use in source or binary forms, with or without modification, are permitted provided the following conditions are met"]
    got = [tuple(r) for r in licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got[0][2:7] == (2, 1, 4, "gpl,mit", "gpl,mit") and got[1][2:7] == (1, 5, 5, "apache", "apache,apache-2.0")
    assert got[2][6] in ("", "bsd-3-clause")


def test_texts_of_neighbouring_licenses_are_not_the_template(spark):
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License"
    gpl = "This work is licensed under the GNU {}General Public License, version {}"
    others = [cc.format("-NonCommercial-NoDerivatives"), cc.format("-ShareAlike"), cc.format("-Share-Alike"), gpl.format("", 2), gpl.format("Lesser ", 3), gpl.format("", ""), "Licensed under the Apache License, Version 1.1"]
    same = [(cc.format(""), "cc-by-4.0"), (gpl.format("", 3), "gpl,gpl-3.0"), (gpl.format("", 3).replace("is licensed", "is hereby licensed"), "gpl,gpl-3.0"), ("2 of 3. " + cc.format("") + " and 4 more", "cc-by-4.0")]
    texts = [*others, *(t for t, _ in same)]
    df = spark.createDataFrame([(i, f"Not 1 word of it. {t} no 5") for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.license_scan(df).collect()}
    assert [rows[i] for i in range(len(others))] == [("", 0.0), ("", 0.0), ("", 0.0), ("gpl", 0.5), ("gpl", 0.5), ("gpl", 0.5), ("apache", 0.5)]
    assert [rows[len(others) + i][0] for i in range(len(same))] == [labels for _, labels in same]


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot": 5.0, "trash": 4.0}, cut=3.0)
    for text in ("you idiot", "1D10T", "іdіоt", "ｉｄｉｏｔ", "i​diot"):
        assert lexicon.raw(text)[1] == 1, text
    assert lexicon.raw("the trash can")[1] == 0 and lexicon.raw("trash it")[1] == 1 and lexicon.raw("patriotidiot")[1] == 0
    assert lexicon.score(3.0) == pytest.approx(0.3) and lexicon.score(0) == 0 and lexicon.raw(None) == (0.0, 0)
    assert lexicon.raw("idiot " + "word " * 20_000)[0] < lexicon.raw("idiot")[0]
    assert toxicity.Lexicon({}, ()).raw("anything") == (0.0, 0)


@pytest.mark.parametrize("percent", [79, 101])
def test_thresholds_that_would_miss_links_are_refused(awkward, percent):
    with pytest.raises(ValueError, match=str(percent)):
        near_dedup.near_duplicates(awkward, percent)


def test_evasions_are_folded():
    lexicon = toxicity.Lexicon({"idiot": 5.0, "ass ": 3.0, "pigfish": 2.0}, ())
    for text in ("𝐢𝐝𝐢𝐨𝐭", "𝕚𝕕𝕚𝕠𝕥", "ídíot", "ïdiot", "id!ot", "!diot!", "1d!0t", "i\u0301diot", "Ⓘⓓiot", "you ass", "a55!", "p!9ﬁ$h", "PIGFISHES"):
        assert lexicon.raw(text)[1] == 1, text
    for text in ("assume", "class", "idio t", "id! ot", "bass ", "\ud800"):
        assert lexicon.raw(text)[1] == 0, text
    assert toxicity.fold("trash \n\t can, 한국어 が") == " trash can  한국어 か "


def test_raw_scores_against_trying_all_words():
    weights = {"idio": 2.0, "idiot": 5.0, "trash": 4.0, "as ": 3.0}
    lexicon = toxicity.Lexicon(weights, ("trash can", "can idiot"))

    def brute(text):
        line = toxicity.fold(text)
        phrases = [toxicity.fold(phrase) for phrase in lexicon.exceptions]
        # The space that ends a phrase begins the next word.
        harmless = {at + i for phrase in phrases for at in range(len(line)) if line.startswith(phrase, at) for i in range(len(phrase) - 1)}
        found = [[w for term, w in weights.items() if line.startswith(f" {term}", at)] for at in range(len(line)) if at not in harmless]
        hits = [max(words) for words in found if words]
        return sum(hits) / (1 + np.log2(1 + len(line.split()) / toxicity.HALF_WORDS)) if hits else 0.0, len(hits)

    draw = random.Random(9)
    for _ in range(300):
        text = "".join(draw.choice(["idiot", "idiom", "trash", "can", "as", "ask", "fish", "!"]) + draw.choice([" ", " ", "  ", ", ", "\n"]) for _ in range(draw.randint(0, 14)))
        raw, hits = lexicon.raw(text)
        assert (pytest.approx(raw), hits) == brute(text), text


def test_long_texts_take_time_by_their_length():
    lexicon = toxicity.Lexicon({"idiot": 5.0, "trash": 4.0})
    began = time.process_time()
    assert lexicon.raw("trash can idiot " * 200_000)[1] == 200_000
    assert time.process_time() - began < 10


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = registered.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.01 * len(rows)


def test_quality_on_held_out_rows(spark, awkward, nothing):
    sf = "/root/testdata/sf0.01"
    rows = registered.op1_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    untrained = quality.train([])
    scored = quality.quality(awkward, untrained)
    assert {r["quality_score"] for r in scored.collect()} == {0.5} and scored.columns == [*awkward.columns, "quality_score"]
    assert quality.quality(nothing, untrained).collect() == []
    assert toxicity.toxicity(nothing, toxicity.Lexicon({"ab": 1.0})).collect() == []


def test_scores_do_not_depend_on_neighbours():
    texts = ["A b c", "", "Ünlü dd", "x " * 5000, "e"]
    model = quality.Classifier(np.random.default_rng(0).normal(size=2**quality.BITS).astype(np.float32), 0.1)
    together = model.scores(pa.array([*texts, None]))
    assert together[:-1] == pytest.approx([model.scores(pa.array([t]))[0] for t in texts]) and together[-1] == together[1]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="/x">Menu entry</a></ul></nav>
<div class="cookie-notice">We use cookies to make this page better for all of its readers, always.</div>
<article><h1>A &amp; B</h1><p>First   paragraph of the article, long enough to be prose, with <b>bold</b><br>words.<p>Second one.
<div class="ad">Buy this now, it is a very good thing to have in every house.</div><p>Third &lt;tag&gt; paragraph, after the advert.</article>
<form><label>Your name, please, in full</label></form><section id="comments"><p>Great read, thank you very much for all of this work!</p></section>
<aside>Related stories you may like to read as well today.</aside><footer>&copy; 2020 A site.</footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text.extract(PAGE) == "A & B\nFirst paragraph of the article, long enough to be prose, with bold words.\nSecond one.\nThird <tag> paragraph, after the advert."
    assert [main_text.extract(p) for p in (None, "", "<nav><a>x</a></nav>", "<!-- open", "<script>if (a<b)")] == [""] * 5


def test_main_text_without_marks():
    prose = "This is a paragraph of running prose, which goes on for some time and ends with a stop."
    page = f"<body><div><a href=1>One</a> <a href=2>Two</a></div><div><p>{prose}</p><p>Short.</p><p>{prose}</p></div>"
    assert main_text.extract(page) == f"{prose}\nShort.\n{prose}"


@pytest.mark.parametrize("opening", [
    '<body class="post single no-sidebar"><div>', '<body class="home sidebar"><div>', '<body><article class="long-form story">', '<body><article class="ad-free comments-open">',
    '<body><div id="content" class="with-comments">', '<body><div class="has-sidebar">', '<body><div class="main-content share">', '<body><div class="nonsense formal">',
])
def test_a_part_of_a_class_does_not_lose_an_article(opening):
    prose = "This is a paragraph of running prose, which goes on for some time and ends with a stop."
    page = f"<html>{opening}<p>{prose}</p><p>{prose}</p><div class='post-comments'><p>{prose} Reader.</p></div><div class=ad>{prose} Buy.</div></div></article></body></html>"
    assert main_text.extract(page) == f"{prose}\n{prose}"


@pytest.mark.parametrize("unit", ["<div>a word or two", "</b></i>text ", "<b>word ", "<p><div>x", "<a href='x'>y", "<ul><li>z", "</div><span>q"])
def test_broken_markup_costs_no_more_than_its_size(unit):
    def cost(size):
        page = "<article>" + unit * (size // len(unit))
        started = time.process_time()
        main_text.ties(main_text.blocks_of(page))
        return time.process_time() - started

    assert cost(1 << 20) < 10 * max(0.1, cost(1 << 18))
    tracemalloc.start()
    main_text.blocks_of("<article>" + unit * ((1 << 18) // len(unit)))
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()


def read_by_hand(page):
    """The article of the test tables' pages, whose markup is plain: h1 and p of ``article``, without the advert."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    body = re.sub(r"<!--.*?-->|<(div class=\"ad\"|script|style|form|aside|section)[^>]*>.*?</(div|script|style|form|aside|section)>", "\x01", body, flags=re.S)
    parts = re.split(r"\x01|</?(?:h[1-6]|p|ul|ol|li|blockquote|div|table|tr|td|th|pre|figure|figcaption)\b[^>]*>", body)
    texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"<br[^>]*>", " ", p)))).strip() for p in parts]
    return "\n".join(t for t in texts if t)


def test_main_text_of_the_tables_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = main_text.main_text(pages).select("html", "main_text").collect()
    plain = [r for r in rows if r["html"] and r["html"].count("<article>") == 1]
    assert len(plain) > 100
    assert [r["main_text"] for r in plain] == [read_by_hand(r["html"]) for r in plain]


def test_main_text_frame(spark):
    pages = spark.createDataFrame([(1, None, "u"), (None, PAGE, None)], "page_id long, html string, main_text string")
    assert sorted(len(r["main_text"]) for r in main_text.main_text(pages).collect())[0] == 0
    assert main_text.main_text(pages.where("false")).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_cut_is_minimum(seed):
    rng = np.random.default_rng(seed)
    n = 8
    terminals = [tuple(map(int, rng.integers(0, 30, 2))) for _ in range(n)]
    edges = [(int(a), int(b), int(w)) for a, b, w in zip(rng.integers(0, n, 12), rng.integers(0, n, 12), rng.integers(1, 20, 12), strict=True) if a != b]

    def cost(side):
        return sum(t if s else f for (f, t), s in zip(terminals, side, strict=True)) + sum(w for a, b, w in edges if side[a] != side[b])

    best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(2**n))
    assert cost(main_text.source_side(n, terminals, edges)) == best



def test_toxic_terms_are_chosen_as_by_trying_all():
    def brute(held, odds):
        having = {t: {i for i, terms in enumerate(held) if t in terms} for t in odds if any(t in terms for terms in held)}
        left, need, chosen = {t: len(rows) for t, rows in having.items()}, [toxicity.COVER] * len(held), {}
        while left:
            best = max(left, key=lambda t: (left[t] * odds[t], t))
            if left[best] < 1 and len(having[best]) < toxicity.COMMON * len(held):
                left.pop(best)
                continue
            chosen[best] = odds[best]
            left = {t: n for t, n in left.items() if t != best and not ((t.startswith(best) or best.startswith(t)) and odds[t] < odds[best] + 1)}
            for i in having[best]:
                need[i] -= 1
                if need[i] == 0:
                    left = {t: n - (t in held[i]) for t, n in left.items()}
        return chosen

    draw = random.Random(5)
    for _ in range(60):
        words = ["".join(draw.choices("abc", k=draw.randint(2, 5))) for _ in range(60)]
        odds = {w: draw.choice([2.0, 2.5, 3.5, 4.0]) for w in words}
        held = [sorted(draw.sample(sorted(odds), draw.randint(0, 6))) for _ in range(40)]
        assert list(toxicity._cover(held, odds).items()) == list(brute(held, odds).items())


def test_words_are_looked_up_once_and_encoded_as_the_tokenizer_does():
    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            Counted.asked += 1
            return super().__getitem__(word)

        def get(self, word, default=None):
            Counted.asked += 1
            return super().get(word, default)

    encoder = token_output._Encoder(registered.tokenizer_path(), "<u2")
    rng = random.Random(3)
    foreign = ["<|endoftext|>", "\u4e2d", "\u00a0", "\x0b", "\U0001f600", "\u00ad", "\u0250", "\u2028"]
    parts = ["'", "s", "re", "ll", "ve", "t", " ", "  ", "\n", "\t", "\r\n", "a", "Zx", "\u00e9", "\u00df", "5", "\u00b2", "\u2026", "!", "''", "\u024f", "x" * 70, " " + "\u00e9" * 40]
    texts = ["".join(rng.choice(parts if i % 3 else parts + foreign) for _ in range(rng.randrange(12))) for i in range(5000)]
    want = [np.array(e.ids, "<u2").tobytes() for e in encoder._tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(encoder.encode(pa.array(texts))) == want
    assert list(encoder.encode(pa.array(texts).slice(100, 50))) == want[100:150] and list(encoder.encode(pa.array([], pa.string()))) == []
    encoder._known = Counted(encoder._known)
    (got,) = encoder.encode(pa.array(["one cat and one dog " * 20_000]))
    assert got == encoder._ids(["one cat and one dog " * 20_000])[0].tobytes() and Counted.asked < 100
