"""Licence scans: an index of the rarest licence words with their positions, verified by key phrases.

Templates are short public notices. Of each template, the words with the highest inverse document frequency
in the scanned documents are indexed, each with its positions. A document's own indexed words vote for
(template, place the template would start at); enough equal votes are an occurrence, if the template's key
phrases stand at their places in the document, word by word.

Besides, three fixed base phrases are found wherever their words stand in sequence. Only DataFrame functions
are used; everything about a document is computed inside its row, and the index, which has no more entries
than the templates have words, is a constant of the plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import field, lower_ascii, set_aside, set_back, settled, table

# Fixed phrases and labels of the base.
BASE = {"the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: name: (label, template, key phrases that must stand at their places). Passages of public licences and their
#: usual notices, as words.
TEMPLATES = {
    "mit grant": (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    "mit warranty": (
        "mit",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors "
        "or copyright holders be liable for any claim damages or other liability",
        ("without warranty of any kind express or implied", "and noninfringement"),
    ),
    "mit notice": ("mit", "released under the mit license", ("mit license",)),
    "mit identifier": ("mit", "spdx license identifier mit", ("spdx license identifier mit",)),
    "apache header": (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
        "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied",
        ("apache license version 2", "except in compliance with the license"),
    ),
    "apache notice": ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    "apache conditions": (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
        ("except in compliance with the license",),
    ),
    "apache identifier": ("apache-2", "spdx license identifier apache 2 0", ("spdx license identifier apache 2",)),
    "gpl notice": ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    "gpl terms": (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        ("gnu general public license", "free software foundation"),
    ),
    "gpl preamble": (
        "gpl",
        "the gnu general public license is a free copyleft license for software and other kinds of works the licenses for "
        "most software and other practical works are designed to take away your freedom to share and change the works",
        ("gnu general public license", "designed to take away your freedom"),
    ),
    "gpl 2 identifier": ("gpl-2", "spdx license identifier gpl 2 0", ("identifier gpl 2 0",)),
    "gpl 3 identifier": ("gpl-3", "spdx license identifier gpl 3 0", ("identifier gpl 3 0",)),
    "lgpl terms": ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    "lgpl identifier": ("lgpl", "spdx license identifier lgpl", ("identifier lgpl",)),
    "agpl terms": (
        "agpl",
        "under the terms of the gnu affero general public license as published by the free software foundation",
        ("gnu affero general public license",),
    ),
    "agpl identifier": ("agpl", "spdx license identifier agpl", ("identifier agpl",)),
    "cc by nc notice": ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    "cc by nc title": ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ("attribution noncommercial",)),
    "cc by title": ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    "cc by sa title": ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ("attribution sharealike",)),
    "cc0 dedication": (
        "cc0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
        ("waived all copyright and related or neighboring rights",),
    ),
    "cc0 identifier": ("cc0", "spdx license identifier cc0 1 0", ("identifier cc0",)),
    "bsd conditions": (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "must retain the above copyright notice"),
    ),
    "bsd opening": (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    "bsd endorsement": (
        "bsd-3",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
        ("endorse or promote products derived from this software",),
    ),
    "bsd 2 identifier": ("bsd-2", "spdx license identifier bsd 2 clause", ("identifier bsd 2 clause",)),
    "bsd 3 identifier": ("bsd-3", "spdx license identifier bsd 3 clause", ("identifier bsd 3 clause",)),
    "isc grant": ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    "isc identifier": ("isc", "spdx license identifier isc", ("identifier isc",)),
    "mpl notice": (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    "mpl copy": (
        "mpl-2",
        "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
        ("mozilla org mpl 2 0",),
    ),
    "mpl identifier": ("mpl-2", "spdx license identifier mpl 2 0", ("identifier mpl 2 0",)),
    "epl terms": (
        "epl-2",
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
        ("eclipse public license 2 0",),
    ),
    "epl identifier": ("epl-2", "spdx license identifier epl 2 0", ("identifier epl 2 0",)),
    "zlib grant": (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for "
        "any damages arising from the use of this software permission is granted to anyone to use this software for any "
        "purpose including commercial applications and to alter it and redistribute it freely",
        ("including commercial applications and to alter it and redistribute it freely",),
    ),
    "artistic terms": (
        "artistic-2",
        "you may distribute verbatim copies of the source form of the standard version of this package in any medium without restriction",
        ("standard version of this package",),
    ),
    "artistic notice": ("artistic-2", "under the terms of the artistic license 2 0", ("artistic license 2 0",)),
    "boost grant": (
        "bsl-1",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license",
        ("any person or organization obtaining a copy of the software",),
    ),
    "boost notice": ("bsl-1", "distributed under the boost software license version 1 0", ("boost software license",)),
    "unlicense": ("unlicense", "this is free and unencumbered software released into the public domain", ("released into the public domain",)),
    "reserved": ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
}
#: Rare words indexed per template, and the share of them that must agree on a place.
INDEXED = 6
AGREE = 0.75
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DERIVED = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "licenses"]


def with_words(docs: DataFrame, text: str, out: str) -> DataFrame:
    """`docs` with the words of a text: letters, digits and non-ASCII characters, A-Z lower-cased."""
    plain = F.trim(F.regexp_replace(lower_ascii(F.coalesce(field(docs, text).cast("string"), F.lit(""))), NOT_WORD, " "))
    words = F.when(F.col("_plain") == "", F.array().cast("array<string>")).otherwise(F.split("_plain", " "))
    return settled(settled(docs, "_plain", plain), out, words)


def licence_words(templates: dict = TEMPLATES) -> list[str]:
    return sorted({w for _, body, _ in templates.values() for w in body.split()})


def document_frequencies(worded: DataFrame, words: list[str]) -> tuple[int, dict[str, int]]:
    """How many documents there are, and in how many each of `words` occurs."""
    own = F.array_intersect("words", F.array(*map(F.lit, words)))
    counts = worded.select(F.explode(F.concat(own, F.array(F.lit("")))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    found = {r["w"]: r["n"] for r in counts}
    return found.pop("", 0), found


def rare_index(total: int, frequencies: dict[str, int], templates: dict = TEMPLATES, indexed: int = INDEXED) -> list[tuple[str, int, int]]:
    """(word, template number, position) of the rarest words of each template, at all their positions."""
    postings = []
    for number, (_, body, _) in enumerate(templates.values()):
        words = body.split()
        idf = {w: math.log((total + 1) / (frequencies.get(w, 0) + 1)) for w in words}
        for w in sorted(idf, key=lambda w: (-idf[w], w))[:indexed]:
            postings += [(w, number, at) for at, own in enumerate(words) if own == w]
    return sorted(postings)


def needed_votes(postings: list[tuple[str, int, int]], templates: dict = TEMPLATES) -> list[int]:
    own = [sum(n == number for _, n, _ in postings) for number in range(len(templates))]
    return [max(2, math.ceil(AGREE * n)) for n in own]


def with_base(worded: DataFrame) -> DataFrame:
    """`base`: start and label of every place of a base phrase."""
    parts = []
    for phrase, label in BASE.items():
        words = phrase.split()
        begins = F.filter(
            F.sequence(F.lit(0), F.size("words") - 1), lambda i: _stands("words", i, words)
        )
        some = F.concat(F.lit(" "), F.col("_plain"), F.lit(" ")).contains(f" {phrase} ")
        found = F.transform(begins, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))
        parts.append(F.when(some, found).otherwise(F.array().cast("array<struct<start:bigint,label:string>>")))
    return settled(worded, "base", F.concat(*parts))


def _stands(words: str, at: Column, phrase: list[str]) -> Column:
    """Whether a phrase stands at a place; the first word is tried first."""
    out = F.lit(True)
    for k, w in enumerate(phrase):
        out = out & F.coalesce(F.get(words, at + k) == w, F.lit(False))
    return out


def with_matches(worded: DataFrame, postings: list[tuple[str, int, int]], templates: dict = TEMPLATES) -> DataFrame:
    """`licenses`: label, start, end and share of agreeing rare words of every verified template occurrence.

    `near` is the largest share of any template, verified or not.
    """
    by_word: dict[str, list[tuple[int, int]]] = {}
    for w, number, position in postings:
        by_word.setdefault(w, []).append((number, position))
    names = list(by_word)
    entry = "array<struct<template:int,position:int>>"
    lists = F.array(*(F.array(*(F.struct(F.lit(n).alias("template"), F.lit(p).alias("position")) for n, p in by_word[w])).cast(entry) for w in names))
    need = needed_votes(postings, templates)
    votes_of = [sum(n == number for _, n, _ in postings) for number in range(len(templates))]
    index = F.array(*map(F.lit, names))
    array_of = lambda values: F.array(*map(F.lit, values))

    # A document has few of the indexed words, so each of its words is compared with those alone.
    df = settled(worded, "_known", F.array_intersect("words", index))
    numbered = F.transform("words", lambda w, i: F.struct(w.alias("word"), i.cast("int").alias("at")))
    hits = F.filter(numbered, lambda h: F.array_contains("_known", h["word"]))
    nothing = F.array().cast("array<struct<word:string,at:int>>")
    df = settled(df, "_hits", F.when(F.size("_known") >= 2, hits).otherwise(nothing))
    votes = F.flatten(
        F.transform(
            "_hits",
            lambda h: F.transform(
                F.get(lists, F.array_position(index, h["word"]).cast("int") - 1),
                lambda p: F.struct(p["template"].alias("template"), (h["at"] - p["position"]).alias("start")),
            ),
        )
    )
    df = settled(df, "_votes", F.sort_array(votes)).withColumn("_need", array_of(need)).withColumn("_of", array_of(votes_of))
    # Equal votes stand together in sorted order: a run of them is a place, its length the number that agree.
    vote = lambda i: F.get("_votes", i)
    places = F.when(F.size("_votes") > 0, F.sequence(F.lit(0), F.size("_votes") - 1)).otherwise(F.array().cast("array<int>"))
    df = settled(df, "_firsts", F.filter(places, lambda i: (i == 0) | (vote(i - 1) != vote(i))))
    length = lambda i, k: F.coalesce(F.get("_firsts", k + 1), F.size("_votes")) - i
    runs = F.transform("_firsts", lambda i, k: F.struct(vote(i).alias("vote"), length(i, k).alias("n")))
    agreed = F.filter(runs, lambda r: r["n"] >= F.get("_need", r["vote"]["template"]))
    counted = F.transform(
        agreed,
        lambda r: F.struct(
            r["vote"]["template"].alias("template"),
            r["vote"]["start"].alias("start"),
            F.least(F.lit(1.0), r["n"] / F.get("_of", r["vote"]["template"])).alias("share"),
        ),
    )
    labels = array_of([label for label, _, _ in templates.values()])
    lengths = array_of([len(body.split()) for _, body, _ in templates.values()])
    df = settled(df, "_counted", counted)
    keep = F.filter("_counted", lambda m: _verified(m, templates))
    shaped = F.transform(
        keep,
        lambda m: F.struct(
            F.get(labels, m["template"]).alias("label"),
            m["start"].cast("long").alias("start"),
            (m["start"] + F.get(lengths, m["template"])).cast("long").alias("end"),
            m["share"].alias("share"),
        ),
    )
    near = F.coalesce(F.array_max(F.transform("_counted", lambda m: m["share"])), F.lit(0.0))
    return settled(settled(df, "licenses", shaped), "near", near).drop("_known", "_hits", "_votes", "_need", "_of", "_firsts", "_counted")


def _verified(m: Column, templates: dict) -> Column:
    """Whether all key phrases of the template stand at their places."""
    out = F.lit(False)
    for number, (_, body, phrases) in enumerate(templates.values()):
        words = body.split()
        own = m["template"] == number
        for phrase in phrases:
            parts = phrase.split()
            at = next(i for i in range(len(words)) if words[i : i + len(parts)] == parts)
            own = own & _stands("words", m["start"] + at, parts)
        out = out | own
    return out


def scan_licenses(docs: DataFrame, text: str = "text", templates: dict = TEMPLATES, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all) with word count, base places, labels, score and `licenses`.

    Places are word numbers from 0; `licenses` has label, start, end and share of every verified template
    occurrence (its start may be negative where a notice lacks its first words). `labels` are those of the
    base and of the templates. The score is 1 with a base phrase, else the best share of agreeing rare words,
    halved if no key phrase confirms it. Null and empty texts have no words and no labels. Repeated rows are
    answered one by one; ties between templates are all listed. Derived columns replace input columns.
    """
    keep = docs.columns if keep is None else keep
    packed = docs.select(*set_aside(docs, keep), field(docs, text).cast("string").alias("body"))
    worded = with_words(packed, "body", "words")
    total, frequencies = document_frequencies(worded, licence_words(templates))
    postings = rare_index(total, frequencies, templates)
    found = with_matches(with_base(worded), postings, templates)
    starts = F.transform("base", lambda b: b["start"])
    named = lambda spans: F.array_join(F.array_sort(F.array_distinct(spans)), ",")
    base_labels = F.transform("base", lambda b: b["label"])
    own_labels = F.transform("licenses", lambda m: m["label"])
    best = F.coalesce(F.array_max(F.transform("licenses", lambda m: m["share"])), F.lit(0.0))
    return found.select(
        *set_back(keep, DERIVED),
        F.size("words").cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        named(base_labels).alias("base_labels"),
        named(F.concat(base_labels, own_labels)).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.greatest(best, F.col("near") / 2)).alias("score"),
        "licenses",
    )


def op10_rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs, keep=["doc_id"]).drop("licenses")
