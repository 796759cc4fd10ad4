"""License scans: exact phrases, and an exact set-similarity join with license templates.

A template is a license's text or notice, and the words that tell it from its rivals (name,
version, terms). A text block is a window of as many consecutive words as the template has.
It meets the template when it holds at least a given part of the template's distinct words,
the telling ones among them. Of blocks of different labels that overlap, only the one that
holds the greatest part stays (of equal parts, the one of more words), so that a license is
not labelled as its rival, too.

Texts are cut in stretches of STRIDE or more words, and every window begins in one of them.
The templates' words are ordered by how many documents hold them, rarest first. Of t words
at least a must be shared, so one of the t - a + 1 rarest must be (prefix filter); a
stretch must hold a words of the template at all (length filter); and from the first shared
word on, enough words must remain (positional filter). Windows are counted exactly in what
passes. Documents that do not hold a words of any template are settled where they are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.llm.tables import stored
from userflow.llm.url_filter import ASCII_UPPER

SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
CONTAINED = 0.8  # part of a template's words that a block must hold
STRIDE = 64  # words of a stretch at least


class Template(NamedTuple):
    label: str
    telling: str  # words, each also of the text
    text: str


# Phrases and their labels, in words.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# What licenses and notices say.
TEMPLATES = (
    Template("mit", "mit license", "Released under the MIT License."),
    Template(
        "mit", "associated files sublicense",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright"
        " notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    Template(
        "mit", "associated files",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files",
    ),
    Template(
        "bsl-1", "organization accompanying",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and"
        " accompanying documentation covered by this license",
    ),
    Template(
        "isc", "fee appear",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template("apache-2", "apache 2", "Licensed under the Apache License, Version 2.0"),
    Template(
        "apache-2", "apache 2",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required"
        " by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\""
        " BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific"
        " language governing permissions and limitations under the License.",
    ),
    Template("cc-by", "cc by", "Licensed under CC BY 4.0"),
    Template("cc-by-sa", "cc by sa", "Licensed under CC BY-SA 4.0"),
    Template("cc-by-nd", "cc by nd", "Licensed under CC BY-ND 4.0"),
    Template("cc-by-nc", "cc by nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-nc-sa", "cc by nc sa", "Licensed under CC BY-NC-SA 4.0"),
    Template("cc-by-nc-nd", "cc by nc nd", "Licensed under CC BY-NC-ND 4.0"),
    Template("cc-by", "creative attribution", "Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "creative sharealike", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc-by-nd", "creative noderivatives", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    Template("cc-by-nc", "creative noncommercial", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-nc-sa", "creative noncommercial sharealike", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    Template("cc-by-nc-nd", "creative noncommercial noderivatives", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    Template("gpl-2", "general public 2", "This work is licensed under the GNU General Public License, version 2."),
    Template("gpl-3", "general public 3", "This work is licensed under the GNU General Public License, version 3."),
    Template("lgpl-3", "lesser general public 3", "This work is licensed under the GNU Lesser General Public License, version 3."),
    Template("agpl-3", "affero general public 3", "This work is licensed under the GNU Affero General Public License, version 3."),
    Template(
        "gpl-2", "general public 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    Template(
        "gpl-3", "general public 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    Template(
        "lgpl-3", "lesser general public 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    Template(
        "agpl-3", "affero general public 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    Template(
        "bsd-2", "redistributions reproduce",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    Template(
        "bsd-3", "redistributions reproduce endorse",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
        " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
        " derived from this software without specific prior written permission.",
    ),
    Template(
        "mpl-2", "mozilla 2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at",
    ),
    Template("unlicense", "unencumbered", "This is free and unencumbered software released into the public domain."),
)


class Known(NamedTuple):
    """A template in words."""

    number: int
    label: str
    words: list[str]  # distinct
    telling: list[str]
    span: int  # words of a block
    least: int  # distinct words that a block must hold


def cut(text: str) -> list[str]:
    """The words of a text, as ``words_of``."""
    lowered = text.translate(str.maketrans(ASCII_UPPER, ASCII_UPPER.lower()))
    return re.findall(f"[^{SEPARATORS}]+", lowered)


def words_of(text: Column) -> Column:
    """The words of a whole text: runs of a-z (A-Z as such), 0-9 and all beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(f"[^{SEPARATORS}]+"), F.lit(0))


def known(templates: Sequence[Template], contained: float = CONTAINED) -> list[Known]:
    out = []
    for number, template in enumerate(templates):
        words = cut(template.text)
        distinct, telling = list(dict.fromkeys(words)), list(dict.fromkeys(cut(template.telling)))
        if not distinct or set(telling) - set(distinct):
            raise ValueError(f"template {number}: needs words, and its telling words among them")
        out.append(Known(number, template.label, distinct, telling, len(words), max(1, math.ceil(contained * len(distinct) - 1e-9))))
    return out


def stride_of(all_known: Sequence[Known]) -> int:
    """Words of a stretch: no window that begins in one goes beyond the next."""
    return max([STRIDE, *(k.span for k in all_known)])


def _strings(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _places(words: str, phrase: str) -> Column:
    """Starts of the places where the phrase's words stand consecutively."""
    n = len(phrase.split())
    starts = F.sequence(F.lit(0), F.size(words) - n)
    found = F.filter(starts, lambda i: F.array_join(F.slice(words, i + 1, n), " ") == phrase)
    # Only the few texts that hold the phrase are gone through word by word.
    held = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")).contains(f" {phrase} ")
    return F.when(held, found).otherwise(F.array().cast("array<int>"))


def _worded(docs: DataFrame, phrases: Mapping[str, str], all_known: Sequence[Known]) -> DataFrame:
    """Per row, written: doc_id, mark (of its text), what its phrases give, tokens (words of
    templates), and words, where it holds enough of some template."""
    phrases = {" ".join(cut(phrase)): label for phrase, label in phrases.items()}
    if "" in phrases:
        raise ValueError("a phrase has words")
    vocabulary = _strings(sorted({w for k in all_known for w in k.words}))
    telling = _strings(sorted({w for k in all_known for w in (k.telling or k.words)}))
    table = F.array(*[F.struct(_strings(k.words).alias("words"), _strings(k.telling).alias("telling"), F.lit(k.least).alias("least")) for k in all_known])

    def enough(t: Column) -> Column:
        return (F.size(F.array_intersect(t.words, "tokens")) >= t.least) & (F.size(F.array_intersect(t.telling, "tokens")) == F.size(t.telling))

    some = F.lit(False)
    if all_known:
        some = F.when((F.size("tokens") >= min(k.least for k in all_known)) & F.arrays_overlap("tokens", telling), F.exists(table, enough)).otherwise(False)
    worded = docs.select("doc_id", F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("words"))
    base = worded.select(
        "doc_id",
        "mark",
        "words",
        *[_places("words", phrase).alias(f"at{i}") for i, phrase in enumerate(phrases)],
        F.array_intersect("words", vocabulary).alias("tokens"),
    )
    named = [F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values())]
    spots = F.concat(*[f"at{i}" for i in range(len(phrases))], F.array().cast("array<int>"))
    return stored(
        base.select(
            "doc_id",
            "mark",
            F.size("words").cast("long").alias("n_words"),
            F.size(spots).cast("long").alias("n_base"),
            F.array_min(spots).cast("long").alias("first_word"),
            F.array_max(spots).cast("long").alias("last_word"),
            F.array_compact(F.array(*named, F.lit(None).cast("string"))).alias("named"),
            "tokens",
            F.when(some, F.col("words")).alias("words"),
        ),
        "license-words",
    )


def _index(base: DataFrame, all_known: Sequence[Known]) -> DataFrame:
    """A row for each prefix word of each template: token, place (from 0), template, label,
    ordered (its words, rarest first), telling, span, least."""
    spark = base.sparkSession
    rows = [(k.number, k.label, k.telling, k.span, k.least, word) for k in all_known for word in k.words]
    words = spark.createDataFrame(rows, "template int, label string, telling array<string>, span int, least int, token string")
    held = base.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    ranked = words.join(held, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_rarity = F.transform(F.array_sort(F.collect_list(F.struct("n", "token"))), lambda x: x.token)
    whole = ranked.groupBy("template", "label", "telling", "span", "least").agg(by_rarity.alias("ordered"))
    prefix = F.slice("ordered", F.lit(1), F.size("ordered") - F.col("least") + 1)
    return whole.select("template", "label", "ordered", "telling", "span", "least", F.posexplode(prefix).alias("place", "token"))


def _best_windows(base: DataFrame, all_known: Sequence[Known]) -> DataFrame:
    """Per (doc_id, mark), template and stretch with a window that meets it: the best one, the
    first of equals: label, first_word, n_words (its span), shared, total."""
    index = stored(_index(base, all_known), "license-index")
    stride = stride_of(all_known)
    prefix = _strings([r[0] for r in index.select("token").distinct().collect()])  # some words of the templates
    vocabulary = _strings(sorted({w for k in all_known for w in k.words}))
    stretch = F.transform(F.sequence(F.lit(1), F.size("words"), F.lit(stride)), lambda i: F.slice("words", i, 2 * stride))
    blocks = (
        base.where("words is not null")
        .select("doc_id", "mark", F.posexplode(stretch).alias("stretch", "block"))
        .withColumn("held", F.array_intersect("block", vocabulary))
    )
    probes = blocks.where(F.size("held") >= min(k.least for k in all_known)).select("*", F.explode(F.array_intersect("held", prefix)).alias("token"))
    shared = F.array_intersect("ordered", "held")
    candidates = probes.join(index, "token").where(
        (F.size("ordered") - F.col("place") >= F.col("least"))  # position of the first shared word
        & (F.size(shared) >= F.col("least"))  # length
        & (F.element_at(shared, 1) == F.col("token"))  # the first one, so each pair once
        & (F.size(F.array_intersect("telling", "held")) == F.size("telling"))
    )
    starts = F.filter(
        F.sequence(F.lit(0), F.least(F.lit(stride), F.size("block")) - 1), lambda i: F.array_contains("ordered", F.get("block", i))
    )

    def window(i: Column) -> Column:
        own = F.slice("block", i + 1, F.col("span"))
        told = F.size(F.array_intersect("telling", own)) == F.size("telling")
        return F.struct(F.when(told, F.size(F.array_intersect("ordered", own))).otherwise(0).alias("shared"), (-i).alias("back"))

    scored = candidates.withColumn("best", F.array_max(F.transform(starts, window))).where("best.shared >= least")
    return scored.select(
        "doc_id",
        "mark",
        "template",
        "label",
        (F.col("stretch") * stride - F.col("best.back")).cast("long").alias("first_word"),
        F.col("span").cast("long").alias("n_words"),
        F.col("best.shared").cast("long").alias("shared"),
        F.size("ordered").cast("long").alias("total"),
    )


def _unbeaten(found: DataFrame, stride: int) -> DataFrame:
    """Without blocks that overlap one of another label that holds a greater part of its
    template, or the same part of more words. A block touches two stretches at most, and a
    stretch has few blocks."""
    last = F.floor((F.col("first_word") + F.col("n_words") - 1) / stride)
    stretches = F.array_distinct(F.array(F.floor(F.col("first_word") / stride), last))
    match = F.struct("template", "label", "first_word", "n_words", "shared", "total")
    near = found.select("doc_id", "mark", match.alias("own"), F.explode(stretches).alias("stretch"))
    near = near.groupBy("doc_id", "mark", "stretch").agg(F.collect_set("own").alias("all"))

    def beats(other: Column, own: Column) -> Column:
        ahead = other.shared * own.total - own.shared * other.total
        overlap = (other.first_word < own.first_word + own.n_words) & (own.first_word < other.first_word + other.n_words)
        return (other.label != own.label) & overlap & ((ahead > 0) | ((ahead == 0) & (other.total > own.total)))

    judged = F.transform("all", lambda own: F.struct(own.alias("own"), F.exists("all", lambda other: beats(other, own)).alias("beaten")))
    each = near.select("doc_id", "mark", F.explode(judged).alias("match"))
    each = each.groupBy("doc_id", "mark", F.col("match.own").alias("own")).agg(F.bool_or("match.beaten").alias("beaten"))
    return each.where("not beaten").select("doc_id", "mark", "own.*")


MATCHES = "doc_id long, mark long, template int, label string, first_word long, n_words long, shared long, total long"


def _matches(base: DataFrame, all_known: Sequence[Known]) -> DataFrame:
    if not all_known:
        return base.sparkSession.createDataFrame([], MATCHES)
    return _unbeaten(stored(_best_windows(base, all_known), "license-windows"), stride_of(all_known))


def matches(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, contained: float = CONTAINED, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The blocks of ``docs`` that meet a template and no overlapping one meets better: doc_id,
    mark (of the text), template (its number), label, first_word (from 0), n_words (the block's
    length), shared and total (distinct words of the template, held and all).

    Of the windows of one template that begin in one stretch of ``stride_of`` words, the best is
    returned, the first of equals; rows of one id and text give their blocks once. Null and empty
    texts meet nothing. Rows without an id are judged alike. Other columns are not looked at.
    """
    all_known = known(templates, contained)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _matches(_worded(docs, {}, all_known), all_known)


def scan(
    docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Sequence[Template] = TEMPLATES,
    contained: float = CONTAINED, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base (places of phrases), first_word and
    last_word (their smallest and largest start, from 0; null without any), base_labels,
    labels (of phrases, and of ``matches``, too; both distinct, sorted, joined by commas) and
    score: 1 with a phrase, else the greatest part of a template that a block holds, if one
    meets it, else 0.

    Null and empty texts have no words, no labels and a score of 0. Repeated rows and rows
    without an id are each returned. Other columns are not looked at.
    """
    all_known = known(templates, contained)
    base = _worded(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), phrases, all_known)
    found = (
        _matches(base, all_known)
        .groupBy("doc_id", "mark")
        .agg(F.collect_set("label").alias("more"), F.max(F.col("shared") / F.col("total")).alias("part"))
        .withColumnsRenamed({"doc_id": "own_id", "mark": "own_mark"})
    )
    joined = base.join(found, F.col("doc_id").eqNullSafe(F.col("own_id")) & F.col("mark").eqNullSafe(F.col("own_mark")), "left")

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    more = F.coalesce("more", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        listed(F.col("named")).alias("base_labels"),
        listed(F.concat("named", more)).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("part", F.lit(0.0))).alias("score"),
    )
