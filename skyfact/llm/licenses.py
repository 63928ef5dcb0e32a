"""License scans by a positional index of rare words.  DataFrame expressions only.

The templates are short notices.  Document frequencies of their words are counted over all files; each
template is indexed by its words of highest IDF and their positions.  All indexed words of a file are looked up,
and each look-up votes for a template at a relative position, the file's word number less the
template's.  What the votes at one position have of the template's index, by IDF, is the score there.
Templates with a score of at least LEAST_SCORE are verified last: their mandatory phrases must stand in the file,
word by word.  Files that lack some word of every template's phrases are left out of the look-up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfact.llm.shared import stored

SEPARATOR = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
WORD = f"[^{SEPARATOR}]+"
#: Words of a template that are indexed, at most, and the least share of them, by IDF, for a label.
INDEXED = 8
LEAST_SCORE = 0.8
# stands for words of a file that no template has
_OTHER = "-"

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Notices, in lower case, and the phrases that must be there.
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license version 2 0"]),
    "bsd-3-clause": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    "cc-by-4.0": ("this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee is hereby granted"]),
    "mit-notice": ("released under the mit license", ["mit license"]),
    "mit-text": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge"]),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    "unlicense": ("this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
}


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrase_pattern(phrases) -> str:
    """Matches the words of any of the phrases where they stand consecutively as whole words."""
    each = "|".join(f"[{SEPARATOR}]+".join(p.split()) for p in phrases)
    return f"(?<![^{SEPARATOR}])(?:{each})(?![^{SEPARATOR}])"


def may_hold(text: Column, phrases) -> Column:
    """Whether all words of any phrase are somewhere in the text: what the pattern needs, at the price of a search for bytes."""
    out = F.lit(False)
    for p in phrases:
        every = F.lit(True)
        for w in sorted(p.split(), key=len, reverse=True):
            every = every & F.contains(text, F.lit(w))
        out = out | every
    return out


def document_frequencies(here: DataFrame, words: list[str]) -> tuple[dict[str, int], int]:
    """Of rows with ``here``, the words of the list that a text has: how many texts have each, and the number of texts."""
    counts = here.select(F.explode(F.concat("here", F.array(F.lit("")))).alias("word")).groupBy("word").count().collect()
    found = {r["word"]: r["count"] for r in counts}
    n = found.pop("", 0)
    return {w: found.get(w, 0) for w in words}, n


def positional_index(df: dict[str, int], n: int, indexed: int = INDEXED) -> list[tuple[str, str, int, float]]:
    """(template, word, position, idf) of the rarest words of each template."""
    idf = {w: math.log((n + 1) / (c + 0.5)) for w, c in df.items()}
    rows = []
    for name, (text, _) in TEMPLATES.items():
        where = {w: i for i, w in reversed(list(enumerate(text.split())))}
        rows += [(name, w, where[w], idf[w]) for w in sorted(where, key=lambda w: (-idf[w], w))[:indexed]]
    return rows


def scan(docs: DataFrame) -> DataFrame:
    """(id, text) -> id, n_words, n_base, first_word, last_word, base_labels, labels (arrays), score; one row for each row.

    Words are runs of letters and digits with A-Z in lower case, numbered from 0.  n_base counts the
    places of PHRASES; labels has their labels and those of the templates; score is the best of the
    labelled templates, 0 without.  Null and empty texts have no words and no labels; null ids and
    repeated rows stay; other columns are ignored.
    """
    vocabulary = sorted({w for text, _ in TEMPLATES.values() for w in text.split()})
    base = phrase_pattern(PHRASES)
    text, words = F.col("_text"), F.col("_words")
    count = lambda x: F.regexp_count(x, F.lit(WORD))
    at_base = may_hold(text, PHRASES) & F.regexp_like(text, F.lit(base))
    matches = F.when(F.col("_at_base"), F.regexp_extract_all(text, F.lit(base), F.lit(0)))
    gaps = F.when(F.col("_at_base"), F.split(text, base, -1))
    here = F.array_intersect(words, F.array(*[F.lit(w) for w in vocabulary]))
    candidate = F.lit(False)
    for _, need in TEMPLATES.values():
        every = sorted({w for p in need for w in p.split()})
        candidate = candidate | (F.size(F.array_intersect("here", F.array(*[F.lit(w) for w in every]))) == len(every))
    marked = F.array_join(F.transform("_words", lambda w: F.when(w.isin(vocabulary), w).otherwise(F.lit(_OTHER))), " ")
    rows = (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("long").alias("id"), lowered(F.col("text")).alias("_text"))
        .select("*", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"), at_base.alias("_at_base"))
        .select("*", here.alias("here"), matches.alias("m"), gaps.alias("_gaps"))
        .select(
            "row", "id", F.size(words).cast("long").alias("n_words"), "here", "m",
            F.when(F.col("_at_base"), count(F.element_at("_gaps", 1))).alias("first"),
            F.when(F.col("_at_base"), count(F.element_at("_gaps", -1)) + count(F.element_at("m", -1))).alias("behind"),
            F.when(candidate, marked).alias("marked"),
        )
    )
    # the texts are read once; frequencies, index and votes come from what is stored
    rows = stored(rows, "license-words")
    index = positional_index(*document_frequencies(rows, vocabulary))
    labels = F.create_map(*[F.lit(x) for p, label in PHRASES.items() for x in (p.split()[0], label)])
    base_labels = F.array_sort(F.array_distinct(F.transform(F.col("m"), lambda m: F.element_at(labels, F.regexp_extract(m, WORD, 0)))))
    none = F.array().cast("array<string>")
    # the phrases of what the index has found
    own = F.filter(F.coalesce("found", F.array().cast("array<struct<template:string,score:double>>")), lambda x: _all_there(F.col("marked"), x["template"]))
    found = rows.join(_found(rows, index), "row", "left").withColumn("own", own)
    return found.select(
        "id", "n_words", F.when(F.col("m").isNull(), 0).otherwise(F.size("m")).cast("long").alias("n_base"),
        F.col("first").cast("long").alias("first_word"), (F.col("n_words") - F.col("behind")).cast("long").alias("last_word"),
        F.coalesce(base_labels, none).alias("base_labels"), F.array_sort(F.array_distinct(F.concat(F.coalesce(base_labels, none), F.transform("own", lambda x: x["template"])))).alias("labels"),
        F.coalesce(F.array_max(F.transform("own", lambda x: x["score"])), F.lit(0.0)).alias("score"),
    )


def _all_there(marked: Column, template: Column) -> Column:
    """Whether the template's phrases stand in the marked words."""
    out = F.lit(False)
    for name, (_, need) in TEMPLATES.items():
        every = F.lit(True)
        for p in need:
            every = every & F.contains(F.concat(F.lit(" "), marked, F.lit(" ")), F.lit(f" {p} "))
        out = out | ((template == name) & every)
    return out


def _found(rows: DataFrame, index: list[tuple[str, str, int, float]]) -> DataFrame:
    """row, found (template and score of each that scores enough at some place), for rows with any."""
    entries = F.array(*[F.struct(F.lit(t).alias("template"), F.lit(w).alias("word"), F.lit(at).alias("at"), F.lit(float(x)).alias("idf")) for t, w, at, x in index])
    postings = F.broadcast(rows.sparkSession.range(1).select(F.inline(entries)))  # a row for each indexed word
    whole = {}
    for name, _, _, x in index:
        whole[name] = whole.get(name, 0.0) + x
    looked = rows.filter("marked IS NOT NULL").select("row", F.posexplode(F.split("marked", " ")).alias("pos", "word"))
    votes = looked.filter(F.col("word").isin(sorted({w for _, w, _, _ in index}))).join(postings, "word")
    at = votes.groupBy("row", "template", (F.col("pos") - F.col("at")).alias("offset")).agg(F.sum("idf").alias("sum"))
    share = F.col("sum") / F.element_at(F.create_map(*[F.lit(x) for k, v in whole.items() for x in (k, v)]), F.col("template"))
    best = at.groupBy("row", "template").agg(F.max(F.least(share, F.lit(1.0))).alias("score")).filter(F.col("score") >= LEAST_SCORE)
    return best.groupBy("row").agg(F.collect_list(F.struct("template", "score")).alias("found"))
