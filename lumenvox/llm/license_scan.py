"""License scans by a positional index of rare words, with DataFrame functions only.

The words of the phrases and templates are the licence words. Their document frequencies are counted over all documents; then
each document looks up its rarest licence words first, in an index that says where a phrase or template has them.
A word at place i that a template has at place q stands for a beginning at i - q, and words that agree in the beginning belong together:
of a phrase all words have to, of a template enough of the document's rarest ones, within a few words of each
other, and its mandatory key phrases with them.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import cut, text_of

# The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: What lies between words, once A-Z are in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """A notice of a licence, and the phrases of it that a text must have."""

    label: str
    text: str
    keys: tuple[str, ...]


TEMPLATES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("mit", "SPDX-License-Identifier: MIT", ("spdx license identifier mit",)),
    Template("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at", ("apache license version 2 0",)),
    Template("apache", "SPDX-License-Identifier: Apache-2.0", ("spdx license identifier apache 2 0",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", ("gnu general public license",)),
    Template("gpl", "SPDX-License-Identifier: GPL-3.0-or-later", ("spdx license identifier gpl",)),
    Template("lgpl", "is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ("gnu affero general public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice", ("redistribution and use in source and binary forms",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", ("for any purpose with or without fee",)),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", ("mozilla public license",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution",)),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by 4",)),
    Template("cc-by", "Licensed under CC BY 3.0", ("cc by 3",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("released into the public domain",)),
)
#: Rarest words of a document that are looked up for a template; words by which beginnings may differ; share of the template's weight from which on it counts.
RARE_WORDS, SLACK, LEAST = 8, 16, 0.6


def words_of(text: str) -> list[str]:
    """The words of a phrase or template."""
    return [w for w in re.split(BETWEEN, "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]


def words(text: Column) -> Column:
    """The words of a text with A-Z in lower case."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), BETWEEN, -1), "")


def _list(items: list[Column], kind: str) -> Column:
    return F.array(*items) if items else F.array().cast(f"array<{kind}>")


def word_weights(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, float]:
    """Inverse document frequencies of ``vocabulary`` over all of ``docs``: a number for each of its words, however many documents there are."""
    held = F.array_intersect(words(text_of(text_col)), F.lit(vocabulary))
    counts = docs.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    found = {r["word"]: r["n"] for r in counts.collect()}
    every = found.get("", 0)
    return {w: 1 + math.log((1 + every) / (1 + found.get(w, 0))) for w in vocabulary}


def _phrase_index(phrases: list[str], weights: dict[str, float]) -> Column:
    """Of each phrase its words and places, the rarest first: array of (id, words, cells of (word, place))."""
    items = []
    for k, phrase in enumerate(phrases):
        cells = sorted(enumerate(words_of(phrase)), key=lambda c: (-weights[c[1]], c[1], c[0]))
        items.append(F.struct(F.lit(k).alias("id"), F.lit([w for _, w in cells]).alias("words"), F.array(*[F.struct(F.lit(w).alias("word"), F.lit(i).alias("place")) for i, w in cells]).alias("cells")))
    return F.array(*items)


def _template_index(templates: tuple[Template, ...], phrases: list[str], weights: dict[str, float], rare: int) -> Column:
    """Of each template its words, the rarest first, with weight and places, and its keys: array of (label, full, cells, keys)."""
    items = []
    for t in templates:
        own = words_of(t.text)
        order = sorted(set(own), key=lambda w: (-weights[w], w))
        cells = [F.struct(F.lit(w).alias("word"), F.lit(weights[w]).alias("weight"), F.lit([i for i, x in enumerate(own) if x == w]).alias("places")) for w in order]
        keys = []
        for key in t.keys:
            parts = words_of(key)
            places = [i for i in range(len(own)) if own[i : i + len(parts)] == parts]
            if not places:
                raise ValueError(f"{key!r} is not in the template {t.text!r}")
            keys.append(F.struct(F.lit(phrases.index(key)).alias("id"), F.lit(places).alias("places")))
        full = sum(weights[w] for w in order[:rare])
        items.append(F.struct(F.lit(t.label).alias("label"), F.lit(full).alias("full"), _list(cells, "int").alias("cells"), F.array(*keys).alias("keys")))
    return F.array(*items)


def _found_at(df: DataFrame, name: str, wanted: Column) -> DataFrame:
    """Adds ``name``: (word, i) of each word that is wanted.

    What is wanted is a column that is used twice, so that it is computed once for a document and not for each of its words.
    """
    df = df.withColumn("_wanted", wanted)
    every = F.transform("_words", lambda w, i: F.struct(w.alias("word"), i.cast("long").alias("i")))
    some = F.filter(every, lambda x: F.array_contains(F.col("_wanted"), x["word"]))
    return df.withColumn(name, F.when(F.size("_wanted") > 0, some).otherwise(F.array().cast("array<struct<word:string,i:bigint>>")))


def _places(at: Column, word: Column) -> Column:
    return F.transform(F.filter(at, lambda x: x["word"] == word), lambda x: x["i"])


def _votes(template: Column, at: Column, rare: int) -> Column:
    """(begin, what, weight) of the document's rarest words of a template, and of its key phrases (without weight)."""
    chosen = F.slice(F.filter(template["cells"], lambda c: F.array_contains(F.col("_held"), c["word"])), 1, rare)
    begins = lambda i, places, what, weight: F.transform(places, lambda q: F.struct((i - q).alias("begin"), what.alias("what"), weight.alias("weight")))
    of_words = F.flatten(F.transform(chosen, lambda c: F.flatten(F.transform(_places(at, c["word"]), lambda i: begins(i, c["places"], c["word"], c["weight"])))))
    none = F.lit(None).cast("double")
    key = lambda k: F.flatten(F.transform(F.filter("_phrases", lambda p: p["id"] == k["id"]), lambda p: F.flatten(F.transform(p["places"], lambda i: begins(i, k["places"], F.concat(F.lit("#"), k["id"].cast("string")), none)))))
    return F.concat(of_words, F.flatten(F.transform(template["keys"], key)))


def license_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[tuple[str, str], ...] = BASE, templates: tuple[Template, ...] = TEMPLATES, rare: int = RARE_WORDS, slack: int = SLACK, least: float = LEAST) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, base (places of the base phrases: array of (start, label)), found (array of (label, score)).

    A base phrase is in place where all its words stand consecutively; all its places count, overlapping ones, too. A template is found
    where its key phrases and those of the document's ``rare`` rarest licence words that it has agree in where the template begins,
    within ``slack`` words (twice as many at most), with ``least`` of the weight of the template's rarest words or more. Places count words from 0. Score is
    that share of the weight, the best one of a label.

    Null and empty texts and texts without words have n_words 0 and nothing found; repeated rows and null ids are rows like any other; very long
    texts are searched whole; an empty table gives no rows; other columns are not read.
    """
    phrases = list(dict.fromkeys([*[p for p, _ in base], *[k for t in templates for k in t.keys]]))
    vocabulary = sorted({w for text in (*phrases, *[t.text for t in templates]) for w in words_of(text)})
    weights = word_weights(docs, vocabulary, text_col)
    phrase_index, template_index = _phrase_index(phrases, weights), _template_index(templates, phrases, weights, rare)
    df = docs.select(F.col(id_col).alias("doc_id"), words(text_of(text_col)).alias("_words"))
    df = df.withColumn("_held", F.array_intersect("_words", F.lit(vocabulary)))
    # phrases of which the document has the rarest word, and then all the others
    possible = F.filter(phrase_index, lambda p: F.array_contains(F.col("_held"), p["words"][0]) & (F.size(F.array_except(p["words"], F.col("_held"))) == 0))
    df = df.withColumn("_possible", possible)
    none = lambda kind: F.array().cast(f"array<{kind}>")
    some = F.size("_possible") > 0
    df = _found_at(df, "_at", F.array_distinct(F.flatten(F.transform("_possible", lambda p: p["words"]))))

    def begins(p: Column) -> Column:
        of = lambda c: F.transform(_places(F.col("_at"), c["word"]), lambda i: i - c["place"])
        return F.aggregate(F.slice(p["cells"], 2, 1 << 30), of(p["cells"][0]), lambda both, c: F.array_intersect(both, of(c)))

    located = F.filter(F.transform("_possible", lambda p: F.struct(p["id"].alias("id"), begins(p).alias("places"))), lambda p: F.size(p["places"]) > 0)
    df = df.withColumn("_phrases", F.when(some, located).otherwise(none("struct<id:int,places:array<bigint>>")))
    labels = F.lit([label for _, label in base])
    ours = F.filter("_phrases", lambda p: p["id"] < len(base))
    df = df.withColumn("base", F.flatten(F.transform(ours, lambda p: F.transform(p["places"], lambda i: F.struct(i.alias("start"), F.get(labels, p["id"]).alias("label"))))))
    n_words = F.size("_words").cast("long").alias("n_words")
    if not templates:
        return df.select("doc_id", n_words, "base", none("struct<label:string,score:double>").alias("found"))
    ids = F.transform("_phrases", lambda p: p["id"])
    open_ = F.filter(template_index, lambda t: F.forall(t["keys"], lambda k: F.array_contains(ids, k["id"])))
    df = df.withColumn("_open", F.when(F.size("_phrases") > 0, open_).otherwise(F.filter(template_index, lambda t: F.lit(False))))
    wanted = F.array_intersect("_held", F.flatten(F.transform("_open", lambda t: F.transform(F.slice(F.filter(t["cells"], lambda c: F.array_contains(F.col("_held"), c["word"])), 1, rare), lambda c: c["word"]))))
    df = _found_at(df, "_near", F.when(F.size("_open") > 0, wanted).otherwise(none("string")))
    votes = F.transform("_open", lambda t: F.struct(t["label"].alias("label"), t["full"].alias("full"), F.size(t["keys"]).alias("n_keys"), _votes(t, F.col("_near"), rare).alias("votes")))
    rows = cut(df.select(F.monotonically_increasing_id().alias("_row"), "doc_id", n_words, "base", votes.alias("_templates")))
    # beginnings within ``slack`` words share a window of twice as many, which begins at a multiple of it
    voted = rows.filter(F.size("_templates") > 0).select("_row", F.posexplode("_templates").alias("t", "template"))
    voted = voted.select("_row", "t", "template.label", "template.full", "template.n_keys", F.explode("template.votes").alias("vote"))
    first = F.floor(F.col("vote.begin") / slack)
    voted = voted.select("_row", "t", "label", "full", "n_keys", "vote.what", "vote.weight", F.explode(F.array(first, first - 1)).alias("window"))
    agreed = voted.groupBy("_row", "t", "label", "full", "n_keys", "window").agg(F.array_sort(F.collect_set(F.struct("what", "weight"))).alias("what"))  # ``rare`` words and the keys at most
    whole = F.size(F.filter("what", lambda x: x["weight"].isNull())) == F.col("n_keys")
    total = F.aggregate(F.filter("what", lambda x: x["weight"].isNotNull()), F.lit(0.0), lambda s, x: s + x["weight"])
    scored = agreed.filter(whole).select("_row", "label", F.least(total / F.col("full"), F.lit(1.0)).alias("score")).filter(F.col("score") >= least)
    best = scored.groupBy("_row", "label").agg(F.max("score").alias("score"))
    found = best.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("label", "score"))).alias("found"))  # a row for each label at most
    joined = rows.drop("_templates").join(found, "_row", "left")
    return joined.select("doc_id", "n_words", "base", F.coalesce("found", none("struct<label:string,score:double>")).alias("found"))


def license_digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score; see ``license_places``.

    A base phrase has all its words in place, so its score is 1; without labels the score is 0.
    """
    found = license_places(docs, **options)
    starts = F.transform("base", lambda b: b["start"])
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    labels = F.array_sort(F.array_union(base_labels, F.transform("found", lambda t: t["label"])))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("found", lambda t: t["score"])), F.lit(0.0)))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        score.alias("score"),
    )
