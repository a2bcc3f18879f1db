"""Licence scans: sparse TF-IDF cosine of lines to templates, then inheritance from the nearest directory.

A file's licence is that of its line nearest to a template. Lines and templates are sets of words, and a word weighs the
rounded logarithm of its rarity over all files. A line can reach the threshold only if it holds one
of the template's anchors, the rarest terms without which the rest of the template is too short a vector; so only lines
with an anchor are compared. Besides, the words of whole files, joined over lines, are compared with the templates and
with headers and parts of licence texts, in windows as long as these. A file counts as a licence file of its directory if its first line with words is a licence, if
one licence line has at least half of its words, or if it has a licence and the name of a licence file. Files without a licence of their own take that of the nearest directory above them which has one.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.columns import without
from quern.llm.storage import stored

# The notices that are looked for.
TEMPLATES = {
    "All-Rights-Reserved": "All rights reserved",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
}
#: Other wordings, headers and parts of the licences' own texts.
FULL_TEXTS = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at",
        "Apache License Version 2.0, January 2004",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Licensed under the BSD 3-Clause License",
    ),
    "CC-BY-4.0": (
        "Licensed under the Creative Commons Attribution 4.0 International License",
        "is licensed under CC BY 4.0",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License",
        "is licensed under CC BY-NC 4.0",
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version",
        "GNU General Public License Version 3, 29 June 2007",
    ),
    "MIT": (
        "The MIT License (MIT)",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
}
#: A class that counts only if a file, or a directory's files, have no licence. Like one, it is not passed over for another above.
RESERVED = "All-Rights-Reserved"
THRESHOLD = 0.8
#: Weight of a rarity of e times, so that weights can be whole numbers.
SCALE = 100
NOT_WORD = "[^a-z0-9]+"
#: Names of licence files, at the end of a path.
FILE_NAME = r"(?i)(?:^|/)(?:(?:un)?licen[cs]es?|copying|copyright|notice)(?:[._-][^/]*)?\z"


def words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def once(value: Column) -> Column:
    """A value as the only element of a generator, whose column a later filter or column cannot be replaced by the
    expression itself: it is computed once per row."""
    return F.explode(F.array(value))


def noticed(docs: DataFrame, id_col: str, text_col: str, vocabulary: Sequence[str], rare: Iterable[str]) -> DataFrame:
    """(id, text, known): the files that hold one of the rare words, with the words that they share with the vocabulary."""
    whole = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    known = F.array_intersect(words(F.col("text")), listed(vocabulary))
    return whole.select("id", "text", once(known).alias("known")).where(F.arrays_overlap("known", listed(rare)))


def listed(terms: Iterable[str]) -> Column:
    return F.split(F.lit(" ".join(sorted(terms))), " ")


def words_of(text: str) -> list[str]:
    return [w for w in re.split(NOT_WORD, text.lower()) if w]


def weight(total: int, holders: int) -> int:
    return round(SCALE * (1 + math.log((total + 1) / (holders + 1))))


def document_counts(docs: DataFrame, text_col: str, terms: list[str]) -> tuple[int, dict[str, int]]:
    """(files, files that hold each of the templates' words): one row per word reaches the driver."""
    found = F.array_intersect(words(F.col(text_col)), F.array(*map(F.lit, terms)))
    marked = F.explode(F.concat(F.array(F.lit("")), F.coalesce(found, F.array().cast("array<string>"))))
    counts = docs.select(marked.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    by_word = {r.word: r.n for r in counts}
    return by_word.pop("", 0), by_word


def anchors(weights: Mapping[str, int], threshold: float) -> list[str]:
    """The heaviest words of a template, until the rest of it is shorter than the threshold of the whole."""
    whole = sum(w * w for w in weights.values())
    rest, out = whole, []
    for word, w in sorted(weights.items(), key=lambda item: (-item[1], item[0])):
        if rest < threshold * threshold * whole:
            break
        out.append(word)
        rest -= w * w
    return out


def squared(bag: Column, weights: Mapping[str, int], unknown: int) -> Column:
    """Squared length of a set of words."""
    # One literal, where a map or an array of literals would be a node per word in every expression that has it.
    table = F.from_json(F.lit(json.dumps(weights)), "map<string,bigint>")
    return F.aggregate(
        F.transform(bag, lambda w: F.coalesce(table[w], F.lit(unknown).cast("bigint"))),
        F.lit(0).cast("bigint"),
        lambda total, w: total + w * w,
    )


def match_windows(
    rows: DataFrame, texts: Sequence[tuple[str, str]], threshold: float, weights: Mapping[str, int], unknown: int
) -> DataFrame:
    """(id, line, header, main, licence, score): per row of `noticed` and text, given as (licence, text), the nearest window of the
    file's joined words, if it reaches the threshold.

    A window has as many words as the text, or all words of a file that has at least four fifths as many. Windows start an
    eighth of that apart, and at the end. `line` is the one in which the window ends; header says that it starts in the first
    line with words and no more than its own length from the top, main that the window has at least half of the file's words. A file that lacks so many of a text's words
    that no window can reach the threshold is not cut into windows, and a window without an anchor of the text cannot reach
    it either.
    """
    forms = []
    for name, text in texts:
        listed_words, bag = words_of(text), sorted(set(words_of(text)))
        own = sum(weights[w] ** 2 for w in bag)
        rare = anchors({w: weights[w] for w in bag}, threshold)
        # The cosine is at most the length of what both have over the text's own; rounding must not leave out a tie.
        least = threshold**2 * own * (1 - 1e-9)
        forms.append((len(forms), name, bag, rare, own, least, len(listed_words), max(1, len(listed_words) // 8)))
    schema = "form int, licence string, bag array<string>, rare array<string>, own bigint, least double, size int, step int"
    # As many rows as there are texts.
    forms = F.broadcast(rows.sparkSession.createDataFrame(forms, schema))

    def among(bag: Column | str) -> Column:
        return squared(F.array_intersect(bag, "bag"), weights, unknown)

    numbered = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(texts) - 1))).alias("form"))
    near = numbered.join(forms, "form").where(F.arrays_overlap("known", "rare")).where(among("known") >= F.col("least"))
    cut = near.select(
        *["id", "licence", "bag", "rare", "own", "size", "step"],
        once(words(F.col("text"))).alias("all"),
        once(
            F.flatten(F.transform(F.split("text", "\n", -1), lambda line, n: F.transform(words(line), lambda w: n)))
        ).alias("line_of"),
    )
    last = F.greatest(F.size("all") - F.col("size"), F.lit(0))
    at = F.array_compact(F.transform("all", lambda w, k: F.when(F.array_contains("rare", w), k)))
    placed = cut.where(F.size("all") * 5 >= F.col("size") * 4).withColumns({"last": last, "at": once(at)})

    def around(k: Column) -> Column:
        """The starts of the windows that hold the k-th word."""
        first = (F.ceil(F.greatest(k - F.col("size") + 1, F.lit(0)) / F.col("step")) * F.col("step")).cast("int")
        end = F.least(k, F.col("last"))
        none = F.array().cast("array<int>")
        return F.when(first <= end, F.sequence(first, F.greatest(first, end), F.col("step"))).otherwise(none)

    ending = F.when(F.array_max("at") >= F.col("last"), F.array("last")).otherwise(F.array().cast("array<int>"))
    starts = F.array_distinct(F.concat(F.flatten(F.transform("at", around)), ending))

    def score(start: Column) -> Column:
        bag = F.array_distinct(F.slice("all", start + 1, F.col("size")))
        cosine = among(bag) / F.sqrt(squared(bag, weights, unknown) * F.col("own"))
        return F.struct((-cosine).alias("minus"), start.alias("start"))

    hits = placed.select("*", once(F.array_min(F.transform(starts, score))).alias("w")).select(
        "id", "all", "line_of", "licence", "size", F.col("w.start").alias("start"), (-F.col("w.minus")).alias("score")
    )
    # A window may start so many words before the text that it is near to.
    early = F.greatest(F.lit(1), F.floor(F.col("size") / 8)) - 1

    def line(at: Column) -> Column:
        return F.col("line_of")[F.least(at, F.size("all") - 1).cast("int")]

    first = line(F.col("start") + early) == F.col("line_of")[0]
    return hits.where(F.col("score") >= threshold).select(
        "id",
        line(F.col("start") + F.col("size") - 1).cast("bigint").alias("line"),
        (first & (F.col("start") <= F.col("size"))).alias("header"),
        (F.col("size") * 2 >= F.size("all")).alias("main"),
        "licence",
        "score",
    )


def match_lines(
    rows: DataFrame, templates: Mapping[str, str], threshold: float, weights: Mapping[str, int], unknown: int
) -> DataFrame:
    """(id, line, header, main, licence, score): each line of the rows of `noticed` that reaches the threshold, with its nearest template.

    `line` is the number of the line from 0; header says that no line before it has words, main that the
    line has at least half of the text's words. The score is the cosine of the
    sets of words, weighted; ties go to the licence that comes first in the alphabet. Words of a line that no template and no
    full text has weigh as much as a word that no file has.
    """
    bags = {name: sorted(set(words_of(text))) for name, text in templates.items()}
    wanted = sorted({a for bag in bags.values() for a in anchors({w: weights[w] for w in bag}, threshold)})
    spotted = r"(?i)(?<![a-z0-9])(?:" + "|".join(wanted) + r")(?![a-z0-9])"
    lines = rows.select("id", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"), F.col("text").alias("whole"))
    before = F.array_join(F.slice(F.split("whole", "\n", -1), F.lit(1), F.col("line")), "")
    hits = lines.where(F.rlike("text", F.lit(spotted))).select(
        "id",
        F.col("line").cast("bigint").alias("line"),
        F.array_distinct(words(F.col("text"))).alias("bag"),
        (~F.rlike(before, F.lit("(?i)[a-z0-9]"))).alias("header"),
        (F.size(words(F.col("text"))) * 2 >= F.size(words(F.col("whole")))).alias("main"),
    )

    def squares(bag: Column) -> Column:
        return squared(bag, weights, unknown)

    def score(name: str) -> Column:
        own = sum(weights[w] ** 2 for w in bags[name])
        both = squares(F.array_intersect("bag", F.array(*map(F.lit, bags[name]))))
        cosine = both / F.sqrt(F.col("length") * F.lit(own).cast("bigint"))
        return F.struct((-cosine).alias("minus"), F.lit(name).alias("licence"))

    best = F.array_min(F.array(*map(score, sorted(bags))))
    scored = hits.withColumn("length", squares(F.col("bag"))).withColumn("best", best)
    return scored.select(
        "id", "line", "header", "main", F.col("best.licence").alias("licence"), (-F.col("best.minus")).alias("score")
    ).where(F.col("score") >= threshold)


def scan_licences(
    docs: DataFrame, path_col: str, id_col: str = "doc_id", text_col: str = "text",
    templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD,
    full_texts: Mapping[str, Sequence[str]] = FULL_TEXTS, reserved: str = RESERVED,
) -> DataFrame:
    """Add licence, licence_score, licence_from (own, inherited or none) and licence_dir to every row.

    Paths are divided by `/`. A file's own licence is the one of the highest score of its lines and windows, then the
    first line. A directory's licence comes from the licence files in it: the highest score, then the smallest id. Reserved
    rights come after every licence in both. Texts that are null
    have no licence of their own; a null path is in no directory. Rows that repeat an id share what any of them holds;
    rows without an id can inherit only. An empty table gives no rows; other columns stay, but for those with the name of
    an added one. The directories' ancestors are joined, not the files': a directory of any size is one row there.
    """
    added = ["licence", "licence_score", "licence_from", "licence_dir"]
    files = docs.where(F.col(id_col).isNotNull())
    texts = [*templates.items(), *[(name, text) for name, several in full_texts.items() for text in several]]
    vocabulary = sorted({w for _, text in texts for w in words_of(text)})
    total, holders = document_counts(files, text_col, vocabulary)
    weighed = {w: weight(total, holders.get(w, 0)) for w in vocabulary}, weight(total, 0)
    bags = [set(words_of(text)) for _, text in texts]
    rare = {a for bag in bags for a in anchors({w: weighed[0][w] for w in bag}, threshold)}
    rows = stored(noticed(files, id_col, text_col, vocabulary, rare), "noticed")
    lines = match_lines(rows, templates, threshold, *weighed)
    lines = lines.unionByName(match_windows(rows, texts, threshold, *weighed))
    rank = F.struct((F.col("licence") == reserved).alias("reserved"), (-F.col("score")).alias("minus"), "line", "licence", "score")
    own = stored(
        lines.groupBy("id").agg(F.min(rank).alias("best"), F.max(F.col("header") | F.col("main")).alias("is_file")).select(
            "id", F.col("best.licence").alias("own_licence"), F.col("best.score").alias("own_score"), "is_file"
        ),
        "own-licences",
    )
    dir_of = F.when(F.col(path_col).contains("/"), F.regexp_extract(path_col, r"(?s)^(.*)/", 1))
    named = F.coalesce(F.rlike(path_col, F.lit(FILE_NAME)), F.lit(False))
    slim = docs.select(F.col(id_col).alias("id"), dir_of.alias("dir"), named.alias("named"))
    held = (
        slim.join(own, "id")
        .where("dir is not null and (is_file or named)")
        .groupBy("dir")
        .agg(F.min(F.struct((F.col("own_licence") == reserved).alias("reserved"), (-F.col("own_score")).alias("minus"), "id", "own_licence", "own_score")).alias("best"))
        .select(F.col("dir").alias("above"), "best.own_licence", "best.own_score")
    )
    dirs = slim.where("dir is not null").select("dir").distinct()
    steps = F.split("dir", "/", -1)
    depths = F.sequence(F.lit(1), F.size(steps))
    ancestors = dirs.select("dir", F.explode(F.transform(depths, lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, F.lit(1), n), "/").alias("above")))).alias("a"))
    nearest = stored(
        ancestors.select("dir", "a.*")
        .join(held, "above")
        .groupBy("dir")
        .agg(F.max(F.struct("depth", "above", "own_licence", "own_score")).alias("n"))
        .select(
            F.col("dir").alias("__dir"), F.col("n.above").alias("__above"),
            F.col("n.own_licence").alias("__dir_licence"), F.col("n.own_score").alias("__dir_score"),
        ),
        "directories",
    )
    own = own.select(F.col("id").alias("__id"), "own_licence", "own_score")
    rows = without(docs, added).withColumn("__d", dir_of)
    rows = rows.join(own, rows[id_col] == own["__id"], "left").join(nearest, F.col("__d") == F.col("__dir"), "left")
    return (
        rows.withColumn("licence", F.coalesce("own_licence", "__dir_licence"))
        .withColumn("licence_score", F.coalesce("own_score", "__dir_score"))
        .withColumn(
            "licence_from",
            F.when(F.col("own_licence").isNotNull(), "own").when(F.col("__above").isNotNull(), "inherited").otherwise("none"),
        )
        .withColumn("licence_dir", F.when(F.col("own_licence").isNull(), F.col("__above")))
        .drop("__id", "own_licence", "own_score", "__d", "__dir", "__above", "__dir_licence", "__dir_score")
    )
