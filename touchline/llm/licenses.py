"""Licence scans over a positional index of rare template words, with DataFrame functions only.

Templates are licence notices. Their words that at most one document in ``COMMON`` holds are indexed with their positions.
Of a document's words that a template has, those with the highest inverse document frequency over the scanned documents, at
most ``RARE_WORDS``, are looked up there; every hit votes for the place where the template would begin. A template is found
where enough of the words looked up stand in their relative positions (up to ``SLACK`` words apart) and the document holds its
mandatory key phrase, which is verified last. As only words that the document has are looked up, a notice that breaks off is
found like a whole one. Besides, plain mentions of licences are counted.

Words are runs of a-z, 0-9 and characters beyond ASCII, of the text with A-Z in lower case.

Defined cases: null and empty texts have no words, no labels and score 0; rows that agree in id and text get equal results;
of templates that fit at several places the best counts; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import ascii_lower, row_key, text_or_empty
from touchline.session import materialize

RARE_WORDS = 16
LEAST_WORDS = 6  # in their place
COMMON = 4
SLACK = 4
COVERAGE = 0.5
MENTION_SCORE = 0.5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Mentions and the label each stands for.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, mandatory key phrase and text of public licence notices.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge", """Permission is hereby granted, free of charge, to any person
obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or
sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software."""),
    ("apache", "licensed under the apache license", """Licensed under the Apache License, Version 2.0 (the "License"); you
may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed
under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied."""),
    ("gpl", "terms of the gnu general public license", """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but
WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("bsd", "redistribution and use in source and binary forms", """Redistribution and use in source and binary forms, with or
without modification, are permitted provided that the following conditions are met: Redistributions of source code must
retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form
must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution."""),
    ("isc", "permission to use copy modify and or distribute this software", """Permission to use, copy, modify, and/or
distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice
and this permission notice appear in all copies."""),
    ("mpl", "mozilla public license", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("cc-by", "creative commons attribution", """This work is licensed under the Creative Commons Attribution 4.0 International
License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative
Commons, PO Box 1866, Mountain View, CA 94042, USA."""),
    ("unlicense", "free and unencumbered software released into the public domain", """This is free and unencumbered software
released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,
either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
)


def words_of(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, re.sub("[A-Z]+", lambda m: m[0].lower(), text)) if w]


def spaced(text: Column | str) -> Column:
    """The words of a text, each between two spaces of its own: " a  b " for two words, empty for none."""
    wide = F.regexp_replace(F.concat(F.lit(" "), ascii_lower(text_or_empty(text)), F.lit(" ")), SEPARATORS, "  ")
    return F.substring(wide, F.lit(2), F.length(wide) - 2)


def _spaced(phrase: str) -> str:
    return f" {phrase.replace(' ', '  ')} "


def _count(words: Column) -> Column:
    return ((F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))) / 2).cast("long")


def _split(words: Column) -> Column:
    return F.split(F.substring(words, F.lit(2), F.length(words) - 2), "  ")


def _with_words(docs: DataFrame, *others: Column | str) -> DataFrame:
    """The words of every row as ``_words``, beside ``others``. They come out of a generator, through which Spark pushes no
    filter and into which it folds no expression, so that the text is split once however often its words are asked for."""
    return docs.select(*others, F.explode(F.array(spaced("text"))).alias("_words"))


def mentions(docs: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Per row: doc_id, key, n_words, n_base, first_word, last_word, base (labels of the phrases found, sorted)."""
    words, found = F.col("_words"), []
    for phrase, label in phrases.items():
        wanted = F.lit(_spaced(phrase))
        times = ((F.length(words) - F.length(F.replace(words, wanted, F.lit("")))) / len(_spaced(phrase))).cast("long")
        first = _count(F.substring_index(words, _spaced(phrase), 1))
        last = _count(words) - _count(F.substring_index(words, _spaced(phrase), -1)) - len(phrase.split())
        place = F.struct(times.alias("n"), first.alias("first"), last.alias("last"), F.lit(label).alias("label"))
        found.append(F.when(F.contains(words, wanted), place))
    rows = _with_words(docs, "doc_id", row_key().alias("key"))
    rows = rows.select("doc_id", "key", _count(words).alias("n_words"), F.array_compact(F.array(*found)).alias("_found"))
    total = F.aggregate(F.transform("_found", lambda f: f["n"]), F.lit(0).cast("long"), lambda a, n: a + n)
    return rows.select(
        "doc_id", "key", "n_words", total.alias("n_base"),
        F.array_min(F.transform("_found", lambda f: f["first"])).alias("first_word"),
        F.array_max(F.transform("_found", lambda f: f["last"])).alias("last_word"),
        F.array_sort(F.array_distinct(F.transform("_found", lambda f: f["label"]))).alias("base"),
    )


def rare_words(docs: DataFrame, templates=TEMPLATES) -> list[str]:
    """The words of the templates that some but few of the documents hold, the rarest first."""
    vocabulary = sorted({w for _, _, text in templates for w in words_of(text)})
    held = F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), _split(F.col("_words")))
    rows = _with_words(docs).select(F.explode(F.array_append(held, F.lit(""))).alias("word"))  # "" counts the documents
    documents = {r.word: r["count"] for r in rows.groupBy("word").count().collect()}  # no more rows than template words
    total = documents.pop("", 0)
    return sorted((w for w, n in documents.items() if n * COMMON <= total), key=lambda w: (documents[w], w))


def template_matches(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Templates found: key, template (its number), begin (about the word where it starts), coverage (share of the words
    looked up that are in place)."""
    rare = rare_words(docs, templates)
    own = [words_of(text) for _, _, text in templates]
    postings = [(i, word, at) for i, words in enumerate(own) for at, word in enumerate(words) if word in rare]
    spark = docs.sparkSession
    index = spark.createDataFrame(postings, "template int, word string, at int")  # a row per template word: a fixed table
    order = [[w for w in rare if w in words] for words in own]
    held = F.array_intersect(_split(F.col("_words")), F.array(*[F.lit(w) for w in rare]).cast("array<string>"))
    rows = _with_words(docs, row_key().alias("key")).withColumn("held", held).filter(F.size("held") >= LEAST_WORDS)

    def chosen(i: int) -> Column:
        """The rarest words of template ``i`` that the document has."""
        of_both = F.array_intersect(F.array(*[F.lit(w) for w in order[i]]).cast("array<string>"), F.col("held"))
        return F.struct(F.lit(i).alias("template"), F.slice(of_both, 1, RARE_WORDS).alias("words"))

    wanted = F.filter(F.array(*[chosen(i) for i in range(len(templates))]), lambda c: F.size(c["words"]) >= LEAST_WORDS)
    rows = rows.withColumn("wanted", wanted).filter(F.size("wanted") > 0)
    rows = materialize(rows.select("key", "_words", "wanted").dropDuplicates(["key"]), "licence-words")
    placed = rows.select("key", "wanted", F.posexplode(_split(F.col("_words"))).alias("place", "word"))
    hits = placed.filter(F.col("word").isin(rare)).join(F.broadcast(index), "word")
    looked_up = F.filter("wanted", lambda c: (c["template"] == F.col("template")) & F.array_contains(c["words"], F.col("word")))
    begin, width = F.col("place") - F.col("at"), 2 * SLACK
    windows = F.array_distinct(F.array(F.floor(begin / width) * width, F.floor((begin + SLACK) / width) * width - SLACK))
    hits = hits.withColumn("_n", F.size(F.get(looked_up, F.lit(0))["words"])).filter("_n > 0")
    votes = hits.select("key", "template", "word", "_n", F.explode(windows).alias("begin")).distinct()
    aligned = votes.groupBy("key", "template", "begin").agg(F.count(F.lit(1)).alias("_in_place"), F.min("_n").alias("_n"))
    aligned = aligned.filter((F.col("_in_place") >= LEAST_WORDS) & (F.col("_in_place") >= COVERAGE * F.col("_n")))
    best = aligned.groupBy("key", "template").agg(F.max(F.col("_in_place") / F.col("_n")).alias("coverage"), F.min("begin").alias("begin"))
    phrases = F.array(*[F.lit(_spaced(k)) for _, k, _ in templates])
    verified = best.join(rows.select("key", "_words"), "key").filter(F.contains("_words", F.get(phrases, F.col("template"))))
    return verified.select("key", "template", "begin", "coverage")


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    names = F.array(*[F.lit(label) for label, _, _ in templates])
    matched = template_matches(docs, templates).groupBy("key").agg(
        F.collect_set(names[F.col("template")]).alias("_labels"), F.max(F.least("coverage", F.lit(1.0))).alias("_score")
    )
    matched = materialize(matched, "licence-templates").withColumnRenamed("key", "_key")
    rows = mentions(docs, phrases).join(matched, F.col("key") == F.col("_key"), "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base", F.coalesce("_labels", none)))
    mention = F.when(F.col("n_base") > 0, F.lit(MENTION_SCORE)).otherwise(F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(mention, F.coalesce("_score", F.lit(0.0))).alias("score"),
    )
