"""License scan by a positional index of rare words (DataFrame functions only).

A template is a license's text with mandatory key phrases at fixed offsets. The words of its key
phrases that are rarest in the corpus (highest inverse document frequency) are its postings: (word,
template, offset). The template's other words need not be in a text, so none of them is a posting.

The postings form one table, word -> (template, offset) pairs, however many templates there are. A
file's places of indexed words are looked up in it; a posting at place p lets its template start at
p - offset. The (template, start) pairs are sorted, those that all of the template's postings agree
on are neighbours and stay, and the template's key phrases are verified there word by word.
Everything happens in the file's own row: no shuffle, no exploded words. Only the document
frequencies of the key phrases' words (a bounded list) reach the driver.

Defined edge cases: null text counts as empty (no words, no labels, score 0); repeated rows are
judged one by one; texts of any length are scanned whole; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: What stands between words: every ASCII character but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrase and label.
BASE_PHRASES: list[tuple[str, str]] = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

#: Label, public license text (its notice or first paragraph), mandatory key phrases.
TEMPLATES: list[tuple[str, str, list[str]]] = [
    ("mit",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions",
     ["permission is hereby granted", "free of charge", "any person obtaining a copy"]),
    ("apache-2.0",
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
     "license you may obtain a copy of the license at http www apache org licenses license 2 0",
     ["licensed under the apache license", "version 2 0"]),
    ("bsd",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer",
     ["redistribution and use in source and binary forms", "are permitted"]),
    ("isc",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies",
     ["permission to use copy modify", "distribute this software"]),
    ("gpl-notice",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version",
     ["this program is free software", "you can redistribute it", "gnu general public license"]),
    ("lgpl", "gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "gnu affero general public license", ["gnu affero general public license"]),
    ("mpl-2.0",
     "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at http mozilla org mpl 2 0",
     ["mozilla public license"]),
    ("epl",
     "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0",
     ["eclipse public license"]),
    ("cc0", "cc0 1 0 universal", ["cc0 1 0 universal"]),
    ("cc-by-sa", "cc by sa", ["cc by sa"]),
    ("cc-by-nc", "cc by nc", ["cc by nc"]),
    ("cc-attribution", "creative commons attribution", ["creative commons attribution"]),
    ("boost",
     "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license the software",
     ["any person or organization obtaining a copy", "covered by this license"]),
    ("zlib",
     "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
     "for any damages arising from the use of this software",
     ["this software is provided as is without any express or implied", "in no event will the authors be held liable"]),
    ("unlicense",
     "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
     "compile sell or distribute this software",
     ["free and unencumbered software", "public domain"]),
]

#: Postings per template: the so many rarest words of its key phrases.
POSTINGS = 2


def _templates() -> list[dict]:
    """label, base, keys (offset of each key phrase in the part of the text that they span) and span."""
    out = []
    for label, text, phrases, base in [*((label, phrase, [phrase], True) for phrase, label in BASE_PHRASES),
                                       *((*t, False) for t in TEMPLATES)]:
        words, keys = text.split(), []
        for key in (p.split() for p in phrases):
            keys.append((next(i for i in range(len(words)) if words[i:i + len(key)] == key), key))
            # lower() also maps the Kelvin sign to k; no key word may depend on that
            assert not any("k" in w for w in key)
        first = min(at for at, _ in keys)
        keys = sorted((at - first, key) for at, key in keys)
        out.append({"label": label, "base": base, "keys": keys, "span": max(at + len(key) for at, key in keys)})
    return out


def words_of(text: Column) -> Column:
    """The text's words, lower-cased (for words without k this is the lower-casing of A-Z alone).

    Cutting at what is no word costs a fraction of searching for words; only the first and the last
    piece can be empty.
    """
    return F.array_remove(F.split(F.lower(text), BETWEEN), "")


def _literal(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word of the (bounded) vocabulary occurs, over the whole table."""
    found = docs.select(F.explode(F.array_intersect(words_of(text_or_empty()), _literal(vocabulary))).alias("w"))
    return {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}


def postings_of(templates: list[dict], frequencies: dict[str, int], most: int = POSTINGS) -> list[list[tuple[str, int]]]:
    """Per template the rarest words of its key phrases with their offsets; ties to the longer word,
    then the earlier."""
    out = []
    for t in templates:
        offsets: dict[str, int] = {}
        for at, key in t["keys"]:
            for k, w in enumerate(key):
                offsets.setdefault(w, at + k)
        idf = {w: -math.log(1 + frequencies.get(w, 0)) for w in offsets}
        rare = sorted(offsets, key=lambda w: (-idf[w], -len(w), offsets[w]))[:most]
        out.append([(w, offsets[w]) for w in rare])
    return out


def _index(postings: list[list[tuple[str, int]]]) -> tuple[list[str], Column]:
    """The indexed words, and for each (in this order) its (template, offset) pairs."""
    table: dict[str, list[tuple[int, int]]] = {}
    for t, posting in enumerate(postings):
        for word, offset in posting:
            table.setdefault(word, []).append((t, offset))
    words = sorted(table)
    return words, F.array(*[F.array(*[F.struct(F.lit(t).alias("t"), F.lit(o).alias("o")) for t, o in table[w]]) for w in words])


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    templates = _templates()
    vocabulary = sorted({w for t in templates for _, key in t["keys"] for w in key})
    postings = postings_of(templates, document_frequencies(docs, vocabulary))
    indexed, pairs = _index(postings)
    # what is known of every template, by its number
    needed = F.array(*[F.lit(len(p)) for p in postings])
    span = F.array(*[F.lit(t["span"]) for t in templates])
    keys = F.array(*[F.array(*[F.struct(F.lit(at).alias("at"), _literal(key).alias("words")) for at, key in t["keys"]])
                     for t in templates])
    label, is_base = _literal(t["label"] for t in templates), F.array(*[F.lit(t["base"]) for t in templates])

    words = F.col("words")
    rows = docs.select("doc_id", words_of(text_or_empty()).alias("words"))
    # places of indexed words, from 0; files without any are done after one look
    places = F.when(F.arrays_overlap(words, _literal(indexed)), F.filter(
        F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.element_at(words, i + 1).isin(indexed)))
    rows = rows.select("doc_id", "words", F.coalesce(places, F.array().cast("array<int>")).alias("at"))

    def looked_up(i: Column) -> Column:
        posting = F.element_at(pairs, F.array_position(_literal(indexed), F.element_at(words, i + 1)).cast("int"))
        return F.transform(posting, lambda p: F.struct(p["t"].alias("t"), (i - p["o"]).alias("s")))

    rows = rows.withColumn("starts", F.array_sort(F.flatten(F.transform("at", looked_up))))

    def agreed(c: Column, i: Column) -> Column:
        # equal pairs are neighbours; a pair comes once per posting, so its run cannot be longer
        return F.get(F.col("starts"), i + F.element_at(needed, c["t"] + 1) - 1) == c

    def verified(c: Column) -> Column:
        start = F.greatest(c["s"], F.lit(0))
        return (c["s"] >= 0) & (c["s"] + F.element_at(span, c["t"] + 1) <= F.size(words)) & F.forall(
            F.element_at(keys, c["t"] + 1), lambda k: F.slice(words, start + k["at"] + 1, F.size(k["words"])) == k["words"])

    found = rows.select("doc_id", F.size("words").cast("bigint").alias("n_words"),
                        F.filter(F.filter("starts", agreed), verified).alias("found"))
    found = found.withColumn("base", F.filter("found", lambda c: F.element_at(is_base, c["t"] + 1)))

    def joined(which: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(
            F.transform(which, lambda c: F.element_at(label, c["t"] + 1)))), ",")

    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.col("base")["s"]).cast("bigint").alias("first_word"),
        F.array_max(F.col("base")["s"]).cast("bigint").alias("last_word"),
        joined("base").alias("base_labels"), joined("found").alias("labels"),
        # each verified place halves the doubt
        (F.lit(1.0) - F.pow(F.lit(0.5), F.size("found"))).alias("score"))
