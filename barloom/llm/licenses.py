"""License scan with Spark's own functions only: fixed phrases, and an exact set-similarity join of text blocks with templates.

A block is a sentence of a paragraph: line ends and comment marks are plain breaks, so a notice that is wrapped over lines or stands in a comment is
one block; a paragraph ends at a line of marks or white space alone. A block meets a template if it holds at least THRESHOLD of the template's
distinct words, the words that tell it from others among them. Words are ordered by the number of texts that hold them in the whole
corpus, rarest first. A pair that meets the threshold must share a word of the template's prefix, its |T| - a + 1 rarest words with
a = ceil(threshold |T|) (prefix filter); a block with fewer than a template words can't meet it (length filter); and of a pair that shares the
words at places i and j of their orders, no more than 1 + min(|B| - i, |T| - j) words can be shared (positional filter). What is left is verified
exactly. None of the filters loses a pair. A template that a block meets gives it its label unless the words they share are part of what the block
shares with another that it meets: a notice that names the lesser license meets the general one as well, but an identifier of either of two licenses
gives both.

Texts are read twice: for the words' counts, and to be scanned; the second pass writes a row a text with its counts and the ranks of template words in
its blocks. Only words of some template's prefix are ever exploded; the templates are a parameter of some hundred words, so their side of the join
is as small at any corpus size.

Defined results: null and empty texts have no words, null places, empty lists and score 0. Rows are told apart by a number given when they are
written, so a null doc_id is an id like any other and repeated rows keep one output row each. Further columns are ignored. Texts are scanned whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.storage import staged

#: Fixed phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Fixed texts: sentences of common licenses and notices, each with its label and the words without which it is another license's.
TEMPLATES = (
    ("apache-2.0", "apache", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("mit", "mit", "Released under the MIT License"),
    ("mit", "mit", "Licensed under the MIT License"),
    ("mit", "sublicense", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("isc", "fee", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "bsd", "Use of this source code is governed by a BSD-style license"),
    ("bsd", "bsd", "Licensed under the BSD License"),
    ("bsd", "redistribution binary", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "mozilla", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("gpl", "general", "This work is licensed under the GNU General Public License"),
    ("gpl", "general", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "gpl", "Released under the GPL license"),
    ("lgpl", "lesser", "Licensed under the GNU Lesser General Public License"),
    ("lgpl", "lesser", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "affero", "Licensed under the GNU Affero General Public License"),
    ("agpl", "affero", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("cc-by", "attribution", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "noncommercial", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "by nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "sharealike", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "by sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nd", "by nd", "Licensed under CC BY-ND 4.0"),
    ("cc0", "cc0", "Dedicated to the public domain under CC0 1.0"),
    ("unlicense", "unencumbered", "This is free and unencumbered software released into the public domain"),
    ("boost", "boost", "Distributed under the Boost Software License, Version 1.0"),
    ("reserved", "reserved", "All rights reserved"),
    ("proprietary", "proprietary", "Confidential and proprietary: unauthorized copying is prohibited"),
    ("proprietary", "proprietary", "Use of this source code is governed by a proprietary license"),
    ("proprietary", "proprietary", "governed by a proprietary license"),
    ("mpl-2.0", "mpl", "Licensed under MPL 2.0"),
    ("apache-2.0", "apache", "Apache License, Version 2.0"),
    ("mpl-2.0", "mozilla", "Mozilla Public License Version 2.0"),
    ("gpl", "general", "GNU General Public License"),
    ("lgpl", "lesser", "GNU Lesser General Public License"),
    ("agpl", "affero", "GNU Affero General Public License"),
    ("bsd", "bsd clause", "BSD 3-Clause License"),
    ("bsd", "bsd clause", "BSD 2-Clause License"),
    ("boost", "boost", "Boost Software License, Version 1.0"),
    ("epl", "eclipse", "Eclipse Public License, Version 2.0"),
    ("cc-by-nc-sa", "by nc sa", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "by nc nd", "Licensed under CC BY-NC-ND 4.0"),
    ("cc-by-nc-sa", "noncommercial sharealike", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nc-nd", "noncommercial noderivatives", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("cc-by-nd", "noderivatives", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("gpl", "gplv2", "GPLv2"),
    ("gpl", "gplv3", "GPLv3"),
    ("lgpl", "lgplv3", "LGPLv3"),
    ("agpl", "agplv3", "AGPLv3"),
)
#: Names of licenses as identifiers of source files give them, without versions where any is meant, and their labels.
IDENTIFIERS = {
    "Apache-2.0": "apache-2.0", "MIT": "mit", "ISC": "isc", "BSD": "bsd", "MPL-2.0": "mpl-2.0", "GPL": "gpl", "LGPL": "lgpl", "AGPL": "agpl", "EPL": "epl", "BSL-1.0": "boost", "Unlicense": "unlicense", "CC0-1.0": "cc0",
    "CC-BY": "cc-by", "CC-BY-SA": "cc-by-sa", "CC-BY-NC": "cc-by-nc", "CC-BY-ND": "cc-by-nd", "CC-BY-NC-SA": "cc-by-nc-sa", "CC-BY-NC-ND": "cc-by-nc-nd",
}
TEMPLATES += tuple((label, "spdx " + name.lower().replace("-", " "), f"SPDX-License-Identifier: {name}") for name, label in IDENTIFIERS.items())
THRESHOLD = 0.8
#: Words are runs of ASCII letters and digits and of anything beyond ASCII; letters in either case are the same.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Ends of blocks: a line of white space and comment marks alone, and the end of a sentence.
BLOCK_END = r"\n[ \t#*/;>-]*(?=\n)|[.!?](?=\s)"
Template = tuple[str, str, str]


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text in lower case; only short texts should be taken apart like this."""
    return F.filter(F.split(lowered(text), BREAK + "+", -1), lambda w: w != "")


def any_of(text: str, parts: list[str]) -> Column:
    """Does the lowered text hold any of the parts? Plain searches, cheaper than a pattern, to leave out most texts."""
    out = F.lit(False)
    for part in parts:
        out = out | F.contains(F.col(text), F.lit(part))
    return out


def place_of_phrases(text: str, phrases: dict[str, str]) -> Column:
    """A struct of n_words, n_base, first and last place, and the found phrases' labels of a text."""
    one = lambda p: (BREAK + "+").join(p.split())
    edge = r"(?<![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])", r"(?![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])"
    pattern = f"(?i){edge[0]}(?:{'|'.join(map(one, phrases))}){edge[1]}"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    count = lambda c: F.regexp_count(c, F.lit(WORD)).cast("long")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + count(x["gap"])
        return F.struct((start + count(x["value"])).alias("at"), F.coalesce(acc["first"], start).alias("first"), start.alias("last"))

    empty = F.struct(F.lit(0).cast("long").alias("at"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
    label = F.create_map(*(F.lit(x) for p in phrases.items() for x in p))

    def listed(values: Column) -> Column:
        walked = F.aggregate(F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(values)).alias("gap"), values.alias("value")), empty, step)
        named = F.array_distinct(F.transform(values, lambda v: label[F.array_join(words(v), " ")]))
        return F.struct(F.size(values).cast("long").alias("n_base"), walked["first"].alias("first"), walked["last"].alias("last"), named.alias("base"))

    none = F.struct(F.lit(0).cast("long").alias("n_base"), empty["first"].alias("first"), empty["last"].alias("last"), F.expr("cast(array() as array<string>)").alias("base"))
    # a hint of each phrase is looked for plainly first; the list of matches is named once
    hints = sorted({max(p.split(), key=len) for p in phrases})
    return F.when(any_of(f"{text}_low", hints), F.element_at(F.transform(F.array(found), listed), 1)).otherwise(none)


def template_index(documents: DataFrame, templates: tuple[Template, ...], threshold: float) -> tuple[list[str], list[tuple]]:
    """The templates' words, those rarest in the corpus first, and for each template (number, label, ranks of its words, how many of them are
    needed, ranks of its telling words). What reaches the driver is one count a word."""
    given = [(label, list(dict.fromkeys(_plain_words(notice))), _plain_words(telling)) for label, telling, notice in templates]
    vocabulary = sorted({w for _, ws, _ in given for w in ws})
    known = F.array(*map(F.lit, vocabulary))
    counts = documents.select(F.explode(F.array_intersect(F.split(F.lower("text"), BREAK + "+", -1), known)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    held = {r["word"]: r["n"] for r in counts.collect()}
    order = sorted(vocabulary, key=lambda w: (held.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    return order, [(k, label, sorted(place[w] for w in ws), _needed(len(ws), threshold), sorted(place[w] for w in telling)) for k, (label, ws, telling) in enumerate(given)]


def scanned(documents: DataFrame, phrases: dict[str, str], order: list[str], index: list[tuple]) -> DataFrame:
    """A row for each text: doc_id, row, n_words, its phrases, and blocks, the ranks of template words of each block that could meet a template."""
    prefix = sorted({t[j] for _, _, t, need, _ in index for j in range(len(t) - need + 1)})
    least = min(need for *_, need, _ in index)
    known, rank = F.array(*map(F.lit, order)), F.create_map(*(F.lit(x) for i, w in enumerate(order) for x in (w, i)))
    broken = lambda c: F.split(c, BREAK + "+", -1)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("t_low", F.lower("t")).withColumn("all", broken("t_low"))
    n_words = F.size("all") - (F.get("all", F.lit(0)) == "").cast("int") - ((F.size("all") > 1) & (F.element_at("all", -1) == "")).cast("int")
    ranks = lambda block: F.array_sort(F.transform(F.array_intersect(broken(block), known), lambda w: F.element_at(rank, w)))
    # a block without any word of a prefix can't meet a template
    blocks = F.filter(F.transform(F.split("t_low", BLOCK_END, -1), ranks), lambda b: (F.size(b) >= least) & F.arrays_overlap(b, F.array(*map(F.lit, prefix))))
    hopeful = F.arrays_overlap("all", F.array(*(F.lit(order[i]) for i in prefix)))
    none = F.expr("cast(array() as array<array<int>>)")
    return texts.select("doc_id", F.monotonically_increasing_id().alias("row"), n_words.cast("long").alias("n_words"), place_of_phrases("t", phrases).alias("p"), F.when(hopeful, blocks).otherwise(none).alias("blocks"))


def matching_blocks(texts: DataFrame, index: list[tuple]) -> DataFrame:
    """(row, block, label, containment): the templates that every block meets, less those that another covers."""
    rows = [(k, label, t, need, telling, j, t[j]) for k, label, t, need, telling in index for j in range(len(t) - need + 1)]
    literal = lambda x: F.array(*map(F.lit, x)) if isinstance(x, list) else F.lit(x)
    names = ("template", "label", "t", "need", "telling", "j", "word")
    entries = F.array(*(F.struct(*(literal(v).alias(n) for n, v in zip(names, r, strict=True))) for r in rows))
    prefixes = texts.sparkSession.range(1).select(F.explode(entries).alias("x")).select("x.*")
    blocks = texts.select("row", F.posexplode("blocks").alias("block", "b"))
    least = min(need for *_, need, _ in index)
    candidates = blocks.select("row", "block", "b", F.posexplode(F.slice("b", F.lit(1), F.size("b") - least + 1)).alias("i", "word"))
    pairs = candidates.join(prefixes, "word").filter((F.size("b") >= F.col("need")) & (1 + F.least(F.size("b") - F.col("i") - 1, F.size("t") - F.col("j") - 1) >= F.col("need")))
    # A pair met on several words is verified at its first shared word only.
    first = F.col("word") == F.array_min(F.array_intersect("b", "t"))
    met = pairs.withColumn("shared", F.array_intersect("b", "t")).filter(first & (F.size("shared") >= F.col("need")) & (F.size(F.array_intersect("b", "telling")) == F.size("telling")))
    # a block's list is no longer than the templates
    each = met.groupBy("row", "block").agg(F.collect_list(F.struct("label", "shared", (F.size("shared") / F.size("t")).alias("containment"))).alias("met"))
    wider = lambda x, y: (F.size(y["shared"]) > F.size(x["shared"])) & (F.size(F.array_except(x["shared"], y["shared"])) == 0)
    own = F.filter("met", lambda x: ~F.exists("met", lambda y: wider(x, y)))
    return each.select("row", "block", F.inline(own)).select("row", "block", "label", "containment")


def _plain_words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def _needed(size: int, threshold: float) -> int:
    return -int(-(threshold * size - 1e-9) // 1)


def scan(documents: DataFrame, phrases: dict[str, str] = PHRASES, templates: tuple[Template, ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """documents(doc_id, text): one row each with n_words, n_base, first_word, last_word, base_labels, labels and score: 1 for a
    fixed phrase, else the best containment. Only row numbers and labels are shuffled, never texts."""
    order, index = template_index(documents, templates, threshold)
    texts = staged(scanned(documents, phrases, order, index), "license-texts")
    found = matching_blocks(texts, index).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    both = texts.drop("blocks").join(found, "row", "left")
    named = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.when(F.col("p.n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    more = F.concat("p.base", F.coalesce("more", F.expr("cast(array() as array<string>)")))
    return both.select("doc_id", "n_words", "p.n_base", F.col("p.first").alias("first_word"), F.col("p.last").alias("last_word"), named(F.col("p.base")).alias("base_labels"), named(more).alias("labels"), score.alias("score"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql(phrases: dict[str, str] = PHRASES, templates: tuple[Template, ...] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """scan() in SQL, by comparing every block with every template, and words by place."""
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    listed = f"list_filter(string_split_regex({{}}, '{BREAK}+'), lambda w: w <> '')".format
    phrase_rows = ", ".join(f"({_quoted(p)}, {_quoted(k)})" for p, k in phrases.items())
    template_rows = ", ".join(f"({_quoted(k)}, {_quoted(must)}, {_quoted(t)})" for k, must, t in templates)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, {listed(low('text'))} AS ws FROM d),
p AS (SELECT phrase, label, string_split(phrase, ' ') AS ps FROM (VALUES {phrase_rows}) v(phrase, label)),
h AS (SELECT r, label, unnest(list_filter(range(1, len(ws) - len(ps) + 2), lambda i: ws[i:i + len(ps) - 1] = ps)) - 1 AS place FROM w, p WHERE list_has_all(ws, ps)),
b AS (SELECT r, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS ls FROM h GROUP BY r),
t AS (SELECT label, list_distinct({listed(low('notice'))}) AS ts, string_split(must, ' ') AS ms FROM (VALUES {template_rows}) v(label, must, notice)),
l AS (SELECT r, unnest(string_split_regex(regexp_replace(regexp_replace(lower(text), '([.!?])(\\s)', chr(1) || '\\2', 'g'), '\\n([ \\t#*/;>-]*\\n)+', chr(1), 'g'), chr(1))) AS line FROM d),
k AS (SELECT r, row_number() OVER () AS i, list_distinct({listed('line')}) AS bs FROM l),
s AS (SELECT r, i, label, list_intersect(bs, ts) AS sh, len(list_intersect(bs, ts)) AS c, len(ts) AS n FROM k, t WHERE list_has_all(bs, ms) AND len(list_intersect(bs, ts)) >= ceil({threshold} * len(ts) - 1e-9)),
m AS (SELECT r, label, c / n AS c FROM s WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.i = s.i AND o.c > s.c AND list_has_all(o.sh, s.sh))),
g AS (SELECT r, list(DISTINCT label) AS ls, max(c) AS c FROM m GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(b.ls), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.ls, []), coalesce(g.ls, [])))), ','), '') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN b USING (r) LEFT JOIN g USING (r)
"""
