"""Licence scan by a positional index of rare words. DataFrame functions only.

The texts are read once: of every file the places of licence words (those of the templates and phrases below) are kept as
its postings. From them the words' document frequencies over the whole corpus are counted (one number a licence word
comes to the driver). For every template, the template's words that are in the file are looked up in order of their
IDF; the rarest few say where the template would have to begin, each by its own place, and only beginnings on
which all of them agree are left. There every mandatory key phrase of the template must stand word by word.

Everything after the postings happens inside a file's row: no joins and no shuffles but the one small count.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.llm.common import staged

# The base phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Label, template (the words of the licence's usual notice), mandatory key phrases.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    ("mit", "released under the mit license", ("the mit license",)),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    ("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3", ("gnu lesser general public license", "version 3")),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license", "version 3")),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute this software",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

KELVIN = "K"  # the one character beyond ASCII that lower() would turn into an ASCII letter


def words_of(text: Column) -> Column:
    """Runs of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit("�")))
    return F.regexp_extract_all(lowered, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))


def vocabulary(phrases: Sequence[tuple[str, str]], templates: Sequence[tuple]) -> list[str]:
    return sorted({w for p, _ in phrases for w in p.split()} | {w for _, t, _ in templates for w in t.split()})


def index_files(docs: DataFrame, vocab: Sequence[str]) -> DataFrame:
    """doc_id, n_words, postings (i, w) of the licence words, and the distinct ones (found)."""
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    placed = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda x: x["w"].isin(*vocab))
    out = words.select("doc_id", F.size("words").cast("long").alias("n_words"), placed.alias("postings"))
    return out.withColumn("found", F.array_distinct(F.transform("postings", lambda x: x["w"])))


NONE = "cast(array() as array<int>)"


def _texts(words: Sequence[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _word_at(start: str, offset: int, word: str) -> str:
    return f"exists(postings, x -> x.i = {start} + {offset} and x.w = '{word}')"


def _starts(word: str, offset: int) -> str:
    """SQL: where a text would begin that has the word at ``offset``, for all places of the word, in order."""
    return f"transform(filter(postings, x -> x.w = '{word}'), x -> x.i - {offset})"


def _all_agree(starts: Sequence[str]) -> str:
    """SQL: beginnings in all of the arrays, in the order of the first; each array is read once, whatever their lengths."""
    return reduce(lambda a, b: f"array_intersect({a}, {b})", starts)


def _there(words: Sequence[str]) -> str:
    return " and ".join(f"array_contains(found, '{w}')" for w in dict.fromkeys(words))


def phrase_places(phrase: str, by_rarity: Sequence[str]) -> str:
    """SQL: starts of all places where the phrase's words stand consecutively; the rarest words are looked up first."""
    words = phrase.split()
    at = sorted(range(len(words)), key=lambda j: by_rarity.index(words[j]))
    return f"case when {_there([words[j] for j in at])} then {_all_agree([_starts(words[j], j) for j in at])} else {NONE} end"


def template_places(template: str, phrases: Sequence[str], by_rarity: Sequence[str], rarest: int) -> str:
    """SQL: beginnings of the template on which the file's ``rarest`` highest-IDF words of it agree and where all key
    phrases stand.

    Words that the template repeats don't fix a beginning and aren't looked up. The words of the key phrases are looked up in
    the same way, by the beginnings that their places ask for, so the work is in proportion to the file's postings.
    """
    words = template.split()
    once = [w for w in by_rarity if words.count(w) == 1]
    need = min(rarest, len(once))
    rare = f"slice(array_intersect({_texts(once)}, found), 1, {need})"      # in the order of by_rarity
    place = f"cast(array_position({_texts(words)}, w) as int) - 1"
    starts = f"transform({rare}, w -> transform(filter(postings, x -> x.w = w), x -> x.i - ({place})))"
    agreed = f"aggregate({starts}, cast(null as array<int>), (a, b) -> case when a is null then b else array_intersect(a, b) end)"
    keys = []
    for p in phrases:
        part = p.split()
        offset = next(i for i in range(len(words)) if words[i:i + len(part)] == part)
        keys += [(w, offset + i) for i, w in enumerate(part)]
    guard = f"size({rare}) = {need} and {_there([w for w, _ in keys])}"
    return f"case when {guard} then {_all_agree([agreed, *(_starts(w, at) for w, at in dict.fromkeys(keys))])} else {NONE} end"


def scan_licenses(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple] = TEMPLATES,
                  rarest: int = 3) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; one row for each row of ``docs``.

    n_base counts all places of all base phrases; first_word and last_word are the smallest and largest of their starts (words
    from 0), null without any. Labels are distinct, sorted and comma-joined, empty if there are none; ``labels`` are the
    base ones and the templates' ones. score: 1 with a base phrase, else the IDF-weighted share of the best verified
    template's words that stand at their places, else 0. Null and empty texts have no words. Repeated rows and null ids
    come out as they came in; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    vocab = vocabulary(phrases, templates)
    if not all(re.fullmatch("[a-z0-9]+", w) for w in vocab):
        raise ValueError("phrases and templates must consist of the words a-z, 0-9")
    files = staged(spark, index_files(docs, vocab), "license-postings")
    total = files.count()
    seen = {w: n for w, n in files.select(F.explode("found").alias("w")).groupBy("w").count().collect()}   # one row a licence word
    by_rarity = sorted(vocab, key=lambda w: (seen.get(w, 0), w))
    idf = {w: math.log((total + 1) / (seen.get(w, 0) + 1)) + 1e-9 for w in vocab}

    base = {f"p{k}": (label, phrase_places(phrase, by_rarity)) for k, (phrase, label) in enumerate(phrases)}
    found = {f"t{k}": (label, template_places(t, keys, by_rarity, rarest)) for k, (label, t, keys) in enumerate(templates)}
    out = files.select("doc_id", "n_words", "postings", *[F.expr(sql).alias(c) for c, (_, sql) in {**base, **found}.items()])
    scores = []
    for c, (_, t, _) in zip(found, templates):
        words = t.split()
        stand = " + ".join(f"if({_word_at(f'{c}[0]', i, w)}, {idf[w]!r}D, 0D)" for i, w in enumerate(words))
        scores.append(F.expr(f"case when size({c}) > 0 then ({stand}) / {sum(idf[w] for w in words)!r}D else 0D end"))

    def joined(of: dict[str, tuple[str, str]]) -> Column:
        labels = F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, (label, _) in of.items()])
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(labels))))

    starts = F.concat(*base)
    out = out.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), joined(base).alias("base_labels"), joined({**base, **found}).alias("labels"),
        F.greatest(F.lit(0.0), *scores).alias("best"))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.round(F.least("best", F.lit(1.0)), 6))
    return out.withColumn("score", score).drop("best")
