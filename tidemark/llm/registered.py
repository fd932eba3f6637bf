"""The package's queries, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import licenses, mixing, quality, sharding, spelling, toxicity
from tidemark.llm.byte_pairs import decode_ids, encode_texts
from tidemark.llm.common import table
from tidemark.llm.decontaminate import contamination
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.labelled import remainder
from tidemark.llm.main_text import main_text
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.ranked_search import best_documents
from tidemark.llm.token_output import token_dataset

THRESHOLD = 0.3

#: Target weights of the mix by level: domains, then languages; sources weigh the same.
WEIGHTS = {
    (0, "domain0"): 4, (0, "domain1"): 3, (0, "domain2"): 2, (0, "domain3"): 1,
    (1, "en"): 4, (1, "de"): 2, (1, "fr"): 2, (1, "es"): 1,
}
DOMAINS = 4


def levels() -> dict:
    """The tree of the mix: a source's number gives its domain."""
    number = F.coalesce(F.expr("try_cast(regexp_extract(source, '[0-9]+', 0) as bigint)"), F.lit(0))
    return {"domain": F.concat(F.lit("domain"), F.pmod(number, F.lit(DOMAINS)).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = remainder(5)
    classifier = quality.learn(docs, table(spark, sf_dir, "labels"), fold != 0)
    scored = quality.quality(docs, classifier)
    return scored.select("doc_id", (fold == 0).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_dataset(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def learned_lexicon(spark: SparkSession, sf_dir: str) -> toxicity.Lexicon:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.learn(docs, table(spark, sf_dir, "labels"), remainder(4) != 2)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), learned_lexicon(spark, sf_dir))
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"), "toxic_hits")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), levels(), WEIGHTS)


def op6_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.balanced_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern)
    return decode_ids(encoded, ranks, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_tokens": op2_tokens,
    "op3_toxicity": op3_toxicity,
    "op4_main_text": op4_main_text,
    "op5_mixing": op5_mixing,
    "op6_exact_duplicates": op6_exact_duplicates,
    "op7_sharding": op7_sharding,
    "op8_licenses": op8_licenses,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_decontamination": op10_decontamination,
    "op11_ranked_search": op11_ranked_search,
    "op12_byte_pairs": op12_byte_pairs,
    "op13_spelling": op13_spelling,
}

_SPACED = r"[\x20\x09-\x0D]+"

OP6_SQL = f"""
with texts as (select doc_id, regexp_replace(coalesce(text, ''), '{_SPACED}', ' ', 'g') as norm from documents),
groups as (select norm, min(doc_id) as keep_id, count(*) as group_size from texts group by norm)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from texts join groups using (norm)
"""

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = licenses.UPPER, licenses.LOWER


def _words_sql(text: str) -> str:
    """Words of a text as a list."""
    return f"list_filter(string_split_regex(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_BETWEEN}'), lambda w: w <> '')"


OP10_SQL = f"""
with items as (select cast(item_id as varchar) as item, {_words_sql("text")} as words from benchmark),
windows as (
    select item, array_to_string(words[s:s + size - 1], ' ') as phrase, size
    from (select item, words, least(13, len(words)) as size, unnest(generate_series(1, greatest(1, len(words) - 12))) as s from items where len(words) > 0)
),
docs as (select doc_id, {_words_sql("text")} as words from documents),
sizes as (select distinct size from windows),
places as (
    select doc_id, s, size, array_to_string(words[s:s + size - 1], ' ') as phrase
    from (select doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) as s from docs join sizes on len(words) >= size)
),
found as (select distinct doc_id, s, places.size, item from places join windows using (phrase) where places.size = windows.size),
hit as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(generate_series(s, s + size - 1)) as word from (select distinct doc_id, s, size from found)) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from found) group by doc_id)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(words), false) as contaminated
from docs left join hit using (doc_id) left join named using (doc_id)
"""


def _deal_sql(level: int, path: list[str], above: str) -> str:
    """Budgets of one level of the tree, as ``mixing.deal`` describes them."""
    name, parent = path[-1], path[:-1]
    own = " ".join(f"when '{value}' then {weight}" for (at, value), weight in WEIGHTS.items() if at == level)
    weight = f"case {name} {own} else 1 end" if own else "1"
    by = f"partition by {', '.join(parent)}" if parent else ""
    join = "cross join total" if not parent else f"join {above} using ({', '.join(parent)})"
    return f"""
    level{level} as (
        with nodes as (select {", ".join(path)}, cast(sum(tokens) * 2 as hugeint) as room, cast({weight} as hugeint) as weight from leaves group by {", ".join(path)}),
        filled as (
            select *, budget - coalesce(sum(room) over (w rows between unbounded preceding and 1 preceding), 0) as remains,
                   sum(weight) over (w rows between current row and unbounded following) as rest
            from nodes {join} window w as ({by} order by cast(room as double) / cast(weight as double), {name})
        ),
        marked as (select *, room * rest <= weight * remains as filled_up from filled),
        summed as (
            select *, coalesce(sum(room) filter (filled_up) over ({by}), 0) as used, sum(weight) filter (not filled_up) over ({by}) as sharing from marked
        )
        select {", ".join(path)}, cast(case when filled_up then room else weight * (budget - used) // sharing end as hugeint) as budget from summed
    )"""


OP5_SQL = f"""
with rows_ as (
    select doc_id, 'domain' || coalesce(try_cast(regexp_extract(source, '[0-9]+') as bigint), 0) % {DOMAINS} as domain, coalesce(lang, '') as lang, coalesce(source, '') as source,
           cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as n_tokens
    from documents
),
leaves as (select domain, lang, source, sum(n_tokens) as tokens from rows_ group by all),
total as (select cast(sum(tokens) as hugeint) as budget from leaves),
{_deal_sql(0, ["domain"], "")},
{_deal_sql(1, ["domain", "lang"], "level0")},
{_deal_sql(2, ["domain", "lang", "source"], "level1")},
plan as (
    select domain, lang, source, cast(budget as bigint) as leaf_budget, case when tokens = 0 then 0 else budget // tokens end as whole,
           case when tokens = 0 then 0 else budget % tokens end as over_
    from leaves join level2 using (domain, lang, source)
),
drawn as (select *, left(md5('mix/' || whole || '/' || coalesce(cast(doc_id as varchar), '')), 15) as place from rows_ join plan using (domain, lang, source)),
summed as (select *, sum(n_tokens) over (partition by domain, lang, source order by place, doc_id rows unbounded preceding) as reached from drawn)
select doc_id, domain, lang, source, n_tokens, leaf_budget, cast(whole + (case when whole < 2 and reached <= over_ then 1 else 0 end) as bigint) as copies
from summed
"""

_TEMPLATE_ROWS = ", ".join(f"('{label}', '{text}')" for label, text in sorted(licenses.TEMPLATES.items()))

OP8_SQL = f"""
with docs as (select doc_id, text, {_words_sql("text")} as words from documents),
templates as (select label, {_words_sql("text")} as words from (values {_TEMPLATE_ROWS}) t(label, text)),
known as (
    select label, len(words) as length, place, array_to_string(words[place + 1:place + {licenses.K}], ' ') as run
    from (select label, words, unnest(generate_series(0, len(words) - {licenses.K})) as place from templates)
),
runs as (
    select doc_id, spot, array_to_string(words[spot + 1:spot + {licenses.K}], ' ') as run
    from (select doc_id, words, unnest(generate_series(0, len(words) - {licenses.K})) as spot from docs where len(words) >= {licenses.K})
),
votes as (select doc_id, label, length, spot, place, spot - place as diagonal from runs join known using (run)),
opened as (
    select *, case when diagonal - lag(diagonal) over w <= {licenses.NEIGHBOURS} then 0 else 1 end as opens
    from votes window w as (partition by doc_id, label order by diagonal, spot)
),
merged as (select *, sum(opens) over (partition by doc_id, label order by diagonal, spot rows unbounded preceding) as part from opened),
fresh as (
    select *, coalesce(least({licenses.K}, place - lag(place) over (partition by doc_id, label, part order by place, spot)), {licenses.K}) as fresh from merged
),
spans as (
    select doc_id, label, cast(sum(fresh) as double) / cast(any_value(length) as double) as coverage from fresh group by doc_id, label, part having coverage >= {licenses.COVERED}
),
found as (select doc_id, list(distinct label) as found, max(coverage) as coverage from spans group by doc_id),
base as (
    select doc_id, words, list_filter(list_transform(generate_series(1, len(words)), lambda i: case when words[i] <> 'license' or i = 1 then null
        when words[i - 1] = 'mit' then {{'spot': i - 2, 'label': 'mit'}} when words[i - 1] = 'apache' then {{'spot': i - 2, 'label': 'apache'}}
        when i > 2 and words[i - 1] = 'public' and words[i - 2] = 'general' then {{'spot': i - 3, 'label': 'gpl'}} end), lambda p: p is not null) as places
    from docs
)
select doc_id, cast(len(words) as bigint) as n_words, cast(len(places) as bigint) as n_base,
       cast(list_min(list_transform(places, lambda p: p.spot)) as bigint) as first_word, cast(list_max(list_transform(places, lambda p: p.spot)) as bigint) as last_word,
       array_to_string(list_sort(list_distinct(list_transform(places, lambda p: p.label))), ',') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(list_transform(places, lambda p: p.label), coalesce(found, [])))), ',') as labels,
       greatest(coalesce(coverage, 0.0), case when len(places) > 0 then 0.5 else 0.0 end) as score
from base left join found using (doc_id)
"""

_TERMS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms_sql(text: str) -> str:
    return f"list_filter(string_split_regex(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_TERMS}'), lambda w: w <> '')"


OP11_SQL = f"""
with docs as (select row_number() over () as row_, doc_id, {_terms_sql("text")} as words from documents),
items as (select distinct item_id, unnest({_terms_sql("text")}) as term from benchmark),
corpus as (select count(*) filter (len(words) > 0) as n_docs, cast(sum(len(words)) as bigint) as n_terms from docs),
postings as (
    select row_, doc_id, any_value(n) as n, term, count(*) as tf from (select row_, doc_id, len(words) as n, unnest(words) as term from docs)
    where term in (select term from items) group by row_, doc_id, term
),
weights as (
    select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w from postings, corpus group by term, n_docs
),
scores as (
    select item_id, row_, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) as bigint) as score
    from items join postings using (term) join weights using (term), corpus group by item_id, row_, doc_id
),
ranked as (
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as integer) as rank, doc_id, score from scores where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""

_RUN = "[A-Za-zÀ-ÿ]+"
# The CRC's table is worked out bit by bit; 3988292384 is its fixed polynomial.
OP13_SQL = f"""
with recursive bits as (
    select list_transform(generate_series(0, 255), lambda i: list_reduce(
        [cast(i as bigint), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as table_
),
runs as (
    select doc_id, translate(run, '{_UPPER}', '{_LOWER}') as run, count(*) as n
    from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{_RUN}')) as run from documents) where length(run) >= {spelling.SHORTEST} group by all
),
coded as (
    select run, n, list_transform(string_split(coalesce(cast(doc_id as varchar), '') || ':' || run, ''), lambda c: cast(unicode(c) as bigint)) as points from runs
),
bytes_ as (select run, n, flatten(list_transform(points, lambda c: case when c < 128 then [c] else [195, c - 64] end)) as bytes from coded),
hashed as (
    select run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, table_[(xor(c, b) & 255) + 1])), 4294967295) as h from bytes_, bits
),
results as (
    select case when h % {spelling.DROPPED} = 0 then substr(run, 1, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) as bigint) + 2) else run end as word, n from hashed
),
words as (select word, cast(sum(n) as bigint) as n from results where length(word) >= {spelling.SHORTEST} group by word having sum(n) >= {spelling.LEAST}),
holes as (
    select word, k, substr(word, 1, k) || substr(word, k + 2) as rest from (select word, unnest(generate_series(0, length(word) - 1)) as k from words)
),
put_in as (select distinct h.word as longer, w.word as shorter from holes h join words w on h.rest = w.word),
pairs as (
    select a.word, b.word as near from holes a join holes b using (k, rest) where a.word <> b.word
    union select longer, shorter from put_in union select shorter, longer from put_in
),
found as (
    select word, count(*) as n_near, max(w.n) as most, min_by(near, (-w.n, near)) as best
    from pairs join (select word as near, n from words) w using (near) group by word
),
forms as (
    select word, n, coalesce(n_near, 0) as n_near, case when most >= {spelling.RATIO} * n then best end as form, case when most >= {spelling.RATIO} * n then most end as form_n
    from words left join found using (word)
),
paths as (
    select word, word as root, form as onward from forms
    union all select p.word, f.word, f.form from paths p join forms f on p.onward = f.word
)
select forms.word, forms.form, paths.root, n, n_near, form_n from forms join paths on paths.word = forms.word and paths.onward is null
"""

ORACLES: dict[str, str] = {"op5_mixing": OP5_SQL, "op6_exact_duplicates": OP6_SQL, "op8_licenses": OP8_SQL, "op10_decontamination": OP10_SQL, "op11_ranked_search": OP11_SQL, "op13_spelling": OP13_SQL}
