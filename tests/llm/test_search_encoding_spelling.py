"""Ranked search, prefix-table encoding and spelling variants against brute force and on awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import byte_pairs, ranked_search, registered, spelling
from tidemark.llm.byte_pairs import EncodedText, Encoder, PrefixTable, Vocabulary, decode_ids, encode_texts, read_ranks

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
CLASHES = "score long, rank int, item_id long, word string, n long, part int, ids binary, query int, cell int"
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n ,;"), (4, "one"), (5, "One TWO two"), (6, "alpha beta gamma"), (7, "alpha beta gamma"), (7, "alpha beta gamma"),
    (None, "alpha two"), (None, None), (8, "é ü ñ \U0001f600 日本 ÀÉ <|endoftext|> don't  stop \r\n end  "), (9, "x" * 70_000), (10, "ab two " * 30_000), (-5, "beta"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, *[None] * 9) for i, t in AWKWARD], f"doc_id long, text string, {CLASHES}")


# -- ranked search ----------------------------------------------------------------


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k):
    held = [(name, Counter(terms(text))) for name, text in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for name, text in items:
        asked[name].update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for (name, counts), n in zip(held, sizes, strict=True):
            score = 0
            for t in wanted & counts.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * (50 + (50 * n * n_docs) // n_terms)))
            if score > 0:
                scores.append((-score, name is None, name or 0))
        out += [(item, rank, None if nameless else name, -score) for rank, (score, nameless, name) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def searched(*args, **options):
    return Counter(map(tuple, ranked_search.best_documents(*args, **options).collect()))


ITEMS = [(1, "two alpha"), (2, None), (3, "nowhere"), (None, "BETA beta 日本"), (4, "ab"), (4, "one, two"), (5, "x x x")]


def test_search_of_awkward_rows(spark, awkward):
    items = spark.createDataFrame([(*i, "clash", 1) for i in ITEMS], "item_id long, text string, doc_id string, rank int")
    want = ranked(AWKWARD, ITEMS, 3)
    assert searched(awkward, items, 3) == want
    assert searched(awkward.repartition(5), items, 3, query_bytes=1, block_docs=2) == want
    assert searched(awkward.where("false"), items) == searched(awkward, items.where("false")) == Counter()


def test_search_is_exact_where_accumulators_are_limited(spark):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(20_000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(1200)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(30)]
    frames = [spark.createDataFrame(rows, "doc_id long, text string") for rows in (docs, items)]
    items_df = frames[1].withColumnRenamed("doc_id", "item_id")
    assert searched(frames[0].repartition(6), items_df, 10, block_docs=50) == ranked(docs, items, 10)


def test_no_accumulators_are_made_once_the_rest_cannot_matter():
    rng = np.random.default_rng(2)
    corpus = ranked_search.Corpus(1000, 20_000, {0: 3, 1: 400})
    row = {
        "docs": np.arange(1000).tobytes(), "nameless": np.packbits(np.zeros(1000, bool)).tobytes(), "sizes": np.full(1000, 20).tobytes(), "terms": [0, 1], "dfs": [3, 400],
        "places": np.array([5, 6, 7, *sorted(rng.choice(1000, 400, replace=False))], np.uint32).tobytes(), "counts": np.ones(403, np.int64).tobytes(),
    }
    best = ranked_search.Best(2, 0)
    assert ranked_search.Block(row, corpus).search([0, 1], best, np.zeros(1000, np.int64)) == 3
    assert len(best.scores) == 2 and set(best.docs) <= {5, 6, 7}


# -- encoding ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_pairs._encoder(RANKS, PATTERN)


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_encoding_equals_the_library_and_decodes_back(spark, awkward, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(awkward.select("doc_id", "text"))
    found = decode_ids(encode_texts(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    want = Counter((i, packed(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t in docs.collect())
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in found) == want
    assert encode_texts(awkward.where("false"), RANKS, PATTERN).collect() == []


def test_digests_of_the_query(spark, reference):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for name, text in texts:
        ids = reference.encode_ordinary(text or "")
        want.add((name, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert {tuple(r) for r in registered.op12_byte_pairs(spark, SF).collect()} == want


PIECES = ["a", "b", "ab", "the", " ", "  ", "\n", "é", "ñ", "'s", "'", "r", "e", "1", "23", "!", "…", "中文", "ß", "\U0001f600", "x" * 40, "in", "ing", "tion", " der", " que"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES) | st.text(max_size=5), max_size=30))
def test_any_text_is_encoded_as_the_library_does(reference, encoder, parts):
    text = "".join(parts).encode("utf-8", "replace").decode()
    assert encoder.encode(text) == packed(reference.encode_ordinary(text))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 4), st.lists(st.sampled_from(PIECES), max_size=3)), max_size=8))
def test_appends_and_edits_give_the_ids_of_the_text(reference, encoder, edits):
    held = EncodedText(encoder, "the texts' beginning is in 23 words'r more")
    for at, length, parts in edits:
        start = min(at, len(held.text))
        held.replace(start, min(len(held.text), start + length), "".join(parts))
        held.append("'")
        held.append(" re")
        assert held.ids() == reference.encode_ordinary(held.text)


def test_an_edit_of_a_long_text_is_local(reference, encoder):
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 12))) for _ in range(20_000))
    held = EncodedText(encoder, text)
    assert held.replace(60_000, 60_002, "xyz") < 100
    one = "".join(rng.choices("abcdefgh", k=100_000))
    table = PrefixTable(encoder.vocabulary, one.encode())
    assert table.replace(50_000, 50_001, b"zz") < 500
    assert table.ids() == reference.encode_ordinary(one[:50_000] + "zz" + one[50_001:])
    assert held.ids() == reference.encode_ordinary(held.text)


def test_a_small_vocabulary_and_a_missing_byte():
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"ab": 3, b"bc": 4, b"cab": 5, b"abbc": 6, b"ca": 7}
    small = Encoder(Vocabulary(ranks), r"[a-z]+")
    for n in range(1, 8):
        for letters in itertools.product("abc", repeat=n):
            piece = "".join(letters).encode()
            assert small.piece(piece) == ([ranks[piece]] if piece in ranks else small.vocabulary.merged(piece))
    # No token is there for z.
    with pytest.raises(ValueError, match="no token for byte 122"):
        small.encode("abz")


# -- spelling ---------------------------------------------------------------------


def variants(docs, ratio=5):
    counts = Counter()
    for name, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    words = {w: n for w, n in counts.items() if n >= 5}
    holes, near = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            holes[k, w[:k] + w[k + 1 :]].add(w)
    for (_, rest), same in holes.items():
        for a, b in itertools.permutations(same, 2):
            near[a].add(b)
        for a in same if rest in words else ():
            near[a].add(rest)
            near[rest].add(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def found_variants(df, **options):
    rows = list(map(tuple, spelling.spelling_variants(df, **options).collect()))
    assert len(rows) == len(set(rows))
    return set(rows)


def test_variants_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = variants(docs.collect())
    assert any(r[2] != (r[1] or r[0]) for r in want)
    assert found_variants(docs) == want
    # Many small cells, from trees made of a part of the words.
    assert found_variants(docs, cell=40, sample=500) == want


def test_variants_of_awkward_rows(spark, awkward):
    long = "abcdefghij" * 8
    rows = [
        *AWKWARD, (20, "Straße STRASSE Straßen straße, straße; Straße×straße " * 3), (None, "Éclairs éclairs Éclairs " * 5), (21, "éclair " * 30), (21, "éclair " * 30),
        (22, f"{long} " * 30 + f"{long[:-1]}x " * 5 + f"{long}y " * 6 + f"{long[1:]} " * 5), (23, "colour " * 26 + "color5s colours " * 5 + "colors " * 130),
    ]
    df = spark.createDataFrame([(i, t, *[None] * 9) for i, t in rows], f"doc_id long, text string, {CLASHES}")
    want = variants(rows)
    assert len(want) > 8 and any(len(r[0]) > 64 and r[1] for r in want)
    assert found_variants(df) == found_variants(df, cell=1) == want
    assert found_variants(awkward.where("false")) == found_variants(awkward.where("doc_id < 4")) == set()


def test_large_groups_of_equal_counts(spark):
    # Thousands of words of the same letters, and some with one letter replaced or put in.
    letters = ["".join(p) for p in itertools.permutations("abcdefg")]
    others = [w.replace("g", "h") for w in letters[::3]] + [w[:3] + "i" + w[3:] for w in letters[::5]]
    rows = [(i, " ".join([*letters, *others])) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_variants(df) == variants(rows)


def test_boxes_are_never_pruned_wrongly():
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abcdeé", k=rng.randint(5, 8))).encode("latin-1") for _ in range(1500)})
    group = spelling.Group(words, [1] * len(words))
    tree = spelling.Tree(group.points)
    for less, holds in ((1, lambda a, b: len(a) == len(b)), (0, lambda a, b: len(b) == len(a) + 1)):
        got = {(group.words[i], group.words[j]) for q, d in spelling.pairs(group, tree, group, less) for i, j in zip(q, d, strict=True)}
        want = {(a, b) for a in words for b in words if holds(a, b) and spelling.near(a, b)}
        assert {p for p in got if holds(*p)} == want
