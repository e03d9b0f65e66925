"""License scan: exact set-similarity join between license notices and the text blocks of documents.

A text block is a run of words, wherever lines end: for a notice of n words every run of up to ``SPREAD`` * n of a text's
words is one. Notices that differ in a word or two have words that a block needs or must not have; a block ends where
such a word would come in. Tokens of notices are ordered by their frequency in the whole corpus, rarest first. A block
can only hold ``need = ceil(threshold * size)`` of a notice's tokens if it holds one of its first
``size - need + 1``, so these prefix tokens are the join key: around each place where one stands, the words that a block
could reach are looked at. A length and a positional bound drop places that cannot reach ``need``, and of what is left
each block that begins with one of the notice's tokens is verified exactly.

Only the notices' own tokens can match, so all others share the front of the order and need no count: the frequency
table has a row for each token of the notices, however large the corpus. (Arrays are exploded by the outer form: for
the other Spark infers a filter that computes them once more.)

Nulls and empty texts have no words and no labels. Each row gets its own text's result. Other columns
of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm.common import ascii_lower, table

#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, one by one: single characters are looked up in a table, ranges compared one after another.
WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum() or chr(c).isupper()) + "]+"

WORD_SQL = WORD.replace("\\", "\\\\")

#: Phrase, label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Label, notice.
NOTICES = {
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "lgpl-3.0": "licensed under the gnu lesser general public license version 3",
    "agpl-3.0": "licensed under the gnu affero general public license version 3",
    "apache-2.0": "licensed under the apache license version 2 0",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-4.0": "licensed under cc by 4 0",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "all-rights-reserved": "copyright all rights reserved",
}
#: Label, words of which each is needed; label, words of which none may stand in the block.
NEEDED = {"lgpl-3.0": ["lesser"], "agpl-3.0": ["affero"], "cc-by-4.0": ["by"], "cc-by-nc-4.0": ["nc"], "cc-by-sa-4.0": ["sa"]}
BARRED = {"gpl-3.0": ["affero", "lesser"], "lgpl-3.0": ["affero"], "agpl-3.0": ["lesser"], "cc-by-4.0": ["nc", "nd", "sa"], "cc-by-nc-4.0": ["nd", "sa"], "cc-by-sa-4.0": ["nc", "nd"]}
THRESHOLD = 0.9
#: A block has so many times a notice's words at most.
SPREAD = 2


def words_of(text: str) -> Column:
    """Words of a column. ``lower`` changes letters of other alphabets too, but never where a word begins or ends, and no
    word of a phrase holds a letter that another alphabet's lower-cases to; it is several times faster than translate."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def notice_tokens(notices: dict[str, str]) -> dict[str, list[str]]:
    return {label: list(dict.fromkeys(notice.split())) for label, notice in notices.items()}


def _quoted(words) -> str:
    return "array(" + ", ".join("'" + w.replace("'", "\\'") + "'" for w in words) + ")"


def token_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each token of the vocabulary stands in the corpus: one row for each of its tokens reaches the driver."""
    rows = docs.select(F.explode_outer(F.filter(words_of("text"), lambda w: w.isin(vocabulary))).alias("token")).where("token is not null").groupBy("token").count().collect()
    return dict.fromkeys(vocabulary, 0) | {r["token"]: r["count"] for r in rows}


def find_notices(docs: DataFrame, notices: dict[str, str] = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, text, label, word, containment): where (words from 0) the first block begins that holds at least
    ``threshold`` of a notice's tokens, and the most that a block holds. text is a hash of the row's text, which tells rows
    of one doc_id apart.

    docs: doc_id, text.
    """
    spark = docs.sparkSession
    sets = notice_tokens(notices)
    vocabulary = sorted({w for s in sets.values() for w in s} | {w for x in BARRED.values() for w in x})
    counts = token_frequencies(docs, vocabulary)
    order = sorted(vocabulary, key=lambda w: (counts[w], w))
    rank = {w: i for i, w in enumerate(order)}
    index, longest = [], max(SPREAD * len(n.split()) for n in notices.values())
    for label, words in sets.items():
        words = sorted(words, key=rank.get)
        need = math.ceil(threshold * len(words) - 1e-9)
        more = ([rank[x] for x in NEEDED.get(label, []) if x in words], [rank[x] for x in BARRED.get(label, []) if x not in words])
        index += [(rank[w], label, i, len(words), need, SPREAD * len(notices[label].split()), [rank[x] for x in words], *more) for i, w in enumerate(words[: len(words) - need + 1])]
    prefix = spark.createDataFrame(index, "token int, label string, at int, size int, need int, reach int, ranks array<int>, needed array<int>, barred array<int>")
    keys = _quoted(sorted({order[r[0]] for r in index}))
    ranks = "map_from_arrays(" + _quoted(order) + ", sequence(0, " + str(len(order) - 1) + "))"
    low = f"greatest(i - {longest - 1}, 0)"
    near = f"filter(transform(slice(words, {low} + 1, i - {low} + {longest}), (w, k) -> named_struct('pos', {low} + k, 'rank', {ranks}[w])), x -> x.rank is not null)"
    places = f"transform(filter(transform(words, (w, i) -> if(array_contains({keys}, w), i, null)), i -> i is not null), i -> named_struct('hit', i, 'token', {ranks}[words[i]], 'near', {near}))"
    rows = (
        docs.select("doc_id", F.xxhash64("text").alias("text"), words_of("text").alias("words"))
        .where(F.expr(f"arrays_overlap(words, {keys})"))
        .select("doc_id", "text", F.explode_outer(F.expr(places)).alias("p"))
        .select("doc_id", "text", "p.hit", "p.token", "p.near")
        .join(F.broadcast(prefix), "token")  # a few rows for each notice
        .withColumn("near", F.expr("filter(near, x -> x.pos > hit - reach and x.pos < hit + reach and (array_contains(ranks, x.rank) or array_contains(barred, x.rank)))"))
    )
    own = "array_distinct(transform(filter(near, x -> array_contains(ranks, x.rank)), x -> x.rank))"
    rows = rows.where(F.expr(f"size({own}) >= need and size(filter({own}, r -> r >= token)) >= need - at"))
    # a block that begins at b ends at its reach, or before the first word that it must not have
    end = "least(b.pos + reach, coalesce(array_min(transform(filter(near, x -> x.pos > b.pos and array_contains(barred, x.rank)), x -> x.pos)), b.pos + reach))"
    begins = "filter(near, b -> b.pos <= hit and b.pos > hit - reach and array_contains(ranks, b.rank))"
    held = f"transform({begins}, b -> named_struct('pos', b.pos, 'end', {end}))"
    blocks = f"transform({held}, b -> named_struct('pos', b.pos, 'end', b.end, 'held', array_distinct(transform(filter(near, x -> x.pos >= b.pos and x.pos < b.end), x -> x.rank))))"
    good = F.expr(f"filter({blocks}, b -> b.end > hit and size(b.held) >= need and size(array_except(needed, b.held)) = 0)")
    found = rows.select("doc_id", "text", "label", "size", F.explode_outer(good).alias("b")).where("b is not null")
    return found.groupBy("doc_id", "text", "label").agg(F.min("b.pos").alias("word"), F.max(F.size("b.held") / F.col("size")).alias("containment"))


def find_phrases(docs: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Per row of docs (doc_id, text) doc_id, text (a hash), n_words, and hits: the sorted (start, label) of each place where a phrase's words stand consecutively."""
    starts = sorted({p.split()[0] for p in phrases})
    cases = []
    for phrase, label in phrases.items():
        same = " and ".join(f"get(words, i + {k}) <=> '{w}'" for k, w in enumerate(phrase.split()))
        cases.append(f"when {same} then '{label}'")
    first = "filter(transform(words, (w, i) -> if(w in (" + ", ".join(f"'{w}'" for w in starts) + "), i, null)), i -> i is not null)"
    hits = F.expr(f"filter(transform({first}, i -> named_struct('start', i, 'label', case {' '.join(cases)} end)), x -> x.label is not null)")
    words = docs.select("doc_id", F.xxhash64("text").alias("text"), words_of("text").alias("words"))
    return words.select("doc_id", "text", F.coalesce(F.size("words"), F.lit(0)).cast("long").alias("n_words"), F.coalesce(hits, F.expr("cast(array() as array<struct<start: int, label: string>>)")).alias("hits"))


def scan(docs: DataFrame, notices: dict[str, str] = NOTICES, threshold: float = THRESHOLD, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Per row of docs: doc_id, n_words, hits (see find_phrases), notices: array of (word, label, containment)."""
    found = find_notices(docs, notices, threshold).groupBy(F.col("doc_id").alias("of"), F.col("text").alias("of_text")).agg(F.array_sort(F.collect_list(F.struct("word", "label", "containment"))).alias("notices"))
    base = find_phrases(docs, phrases)
    return base.join(found, base["doc_id"].eqNullSafe(found["of"]) & (base["text"] == found["of_text"]), "left").drop("of", "of_text", "text")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.array_sort(F.array_distinct(F.col("hits.label")))
    method = F.coalesce(F.col("notices.label"), F.expr("cast(array() as array<string>)"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_base"),
        F.expr("get(hits, 0).start").cast("long").alias("first_word"),
        F.expr("get(hits, size(hits) - 1).start").cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, method)), ",").alias("labels"),
        F.when(F.size("hits") > 0, 1.0).otherwise(F.coalesce(F.array_max("notices.containment"), F.lit(0.0))).alias("score"),
        F.coalesce(F.size(F.array_distinct("notices.label")), F.lit(0)).cast("long").alias("n_notices"),
    )


def _oracle() -> str:
    word = f"'{WORD}'"
    lists = ", ".join(f"('{label}', {words!r}, {[w for w in NEEDED.get(label, []) if w in words]!r}::varchar[], {[w for w in BARRED.get(label, []) if w not in words]!r}::varchar[], {SPREAD * len(NOTICES[label].split())})" for label, words in notice_tokens(NOTICES).items())
    phrases = " union all ".join(
        f"select doc_id, i - 1 as start, '{label}' as label from w, unnest(range(1, len(words) + 1)) as t(i) where words[i:i + {len(p.split()) - 1}] = {p.split()!r}"
        for p, label in PHRASES.items()
    )
    return f"""
with d as (select doc_id, translate(coalesce(text, ''), '{UPPER_}', '{LOWER_}') as text from documents),
w as (select doc_id, regexp_extract_all(text, {word}) as words from d),
p as ({phrases}),
hits as (select doc_id, count(*) as n_base, min(start) as first_word, max(start) as last_word, list_sort(list(distinct label)) as base from p group by doc_id),
notices as (select * from (values {lists}) as t(label, words, needed, barred, reach)),
maybe as (select doc_id, w.words as text, n.* from w, notices n where len(list_intersect(w.words, n.words)) >= ceil({THRESHOLD} * len(n.words) - 1e-9)),
runs as (select doc_id, label, words, needed, barred, text[i:i + reach - 1] as run from maybe, unnest(range(1, len(text) + 1)) as t(i) where list_contains(words, text[i])),
cut as (select doc_id, label, words, needed, run[1:coalesce(list_min(list_filter(list_transform(barred, lambda x: list_position(run, x)), lambda p: p > 0)), len(run) + 1) - 1] as run from runs),
found as (select doc_id, label, len(list_intersect(run, words)) / len(words) as share from cut where len(list_intersect(run, words)) >= ceil({THRESHOLD} * len(words) - 1e-9) and list_has_all(run, needed)),
method as (select doc_id, list(distinct label) as labels, max(share) as share, count(distinct label) as n from found group by doc_id)
select w.doc_id, len(w.words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  array_to_string(coalesce(base, []::varchar[]), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []::varchar[]), coalesce(labels, []::varchar[])))), ',') as labels,
  case when n_base > 0 then 1.0::double else coalesce(share, 0.0)::double end as score, coalesce(n, 0)::bigint as n_notices
from w left join hits using (doc_id) left join method using (doc_id)"""


UPPER_, LOWER_ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
QUERIES = {"op1_license_scan": op1_license_scan}
ORACLES = {"op1_license_scan": _oracle()}
