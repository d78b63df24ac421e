"""Licence scan: exact set-similarity join of text blocks with licence templates. DataFrame functions only.

Templates are statements and whole licence texts. The blocks of a template of n words are all windows of n + max(1, n / 4) words of a
document, each a quarter of n further than the one before; so n consecutive words always lie within some block, wherever
lines end. A block matches when it holds at least `THRESHOLD` of the template's distinct words.

Template words are ordered by their frequency over all documents, rarest first. A matching block shares a word
with the template's prefix (its |T| - need + 1 rarest words), has at least `need` template words (length filter), and at the first
shared word enough words left on both sides (positional filter); what passes is verified by intersection. Only blocks around a
prefix word are made, and documents without any never leave their scan.

The templates are fixed, so the tables joined with the blocks have a fixed size and are broadcast; the
driver reads one count per template word. Words: see `SEPARATORS`; only A-Z are lower-cased.

Defined cases: null text counts as empty and has no words; `first_word` and `last_word` are null without a
place. Overlapping places count each. Repeated rows are scanned alike. Extra columns are ignored by
the query. `score` is 1 with a phrase, else the best containment found (0 for none).
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame, functions as F

from devsignals.llm.common import row_key

THRESHOLD = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"            # of words in lower-cased text
RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"    # the same before lower-casing

# Phrases of the contract and statements by which texts name their licence.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
            "this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
            "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
               "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
               "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
               "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
               "governing permissions and limitations under the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
            "version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
            "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
            "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
            "distribution."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
            "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
            "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
            "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
            "THE POSSIBILITY OF SUCH DAMAGE."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
            "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("all-rights-reserved", "All rights reserved"),
)


def words_of(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))) if w]


def block_size(n_words: int) -> tuple[int, int]:
    """Words in a block of a template of so many words, and from one block's start to the next."""
    step = max(1, n_words // 4)
    return n_words + step, step


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lowered, SEPARATORS, -1), lambda w: w != "")


def count_words(text: Column) -> Column:
    blank = lambda x: F.when(x == "", 1).otherwise(0)
    parts = F.split(text, RAW_SEPARATORS, -1)
    return let(parts, lambda a: F.when(F.size(a) == 1, 1 - blank(F.get(a, F.lit(0)))).otherwise(
        F.size(a) - blank(F.get(a, F.lit(0))) - blank(F.element_at(a, -1)))).cast("long")


def places(own: Column, phrase: str) -> Column:
    """Starts of a phrase in an array of words."""
    parts = phrase.split()

    def here(i):
        found = F.get(own, i) == parts[0]
        for k, w in enumerate(parts[1:], 1):
            found &= F.coalesce(F.get(own, i + k) == w, F.lit(False))
        return found

    return F.filter(F.sequence(F.lit(0), F.size(own) - 1), here)


def base_scan(docs: DataFrame) -> DataFrame:
    """Adds n_words and `places`, an array of (label, starts) of the phrases found."""
    text = F.coalesce("text", F.lit(""))
    found = let(words(text), lambda own: F.filter(
        F.array(*[F.struct(F.lit(label).alias("label"), places(own, phrase).alias("starts")) for label, phrase in PHRASES]),
        lambda x: F.size(x["starts"]) > 0))
    # every phrase ends with this word
    return (docs.withColumn("n_words", count_words(text))
            .withColumn("places", F.when(text.rlike("(?i)license"), found)))


def word_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each template word stands in all documents."""
    own = F.filter(F.split("text", RAW_SEPARATORS, -1), lambda w: F.lower(w).isin(vocabulary))
    rows = docs.select(F.explode(own).alias("w")).groupBy(F.lower("w").alias("w")).agg(F.count("*").alias("n")).collect()
    return {r["w"]: r["n"] for r in rows}


def inline(spark, rows: list[dict]) -> DataFrame:
    """A small table of fixed values."""
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(*[(F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(k) for k, v in row.items()])
        for row in rows])))


def any_of(members: list[str]) -> str:
    """A pattern for the words, branching by first letter."""
    letters: dict[str, list[str]] = {}
    for w in members:
        letters.setdefault(w[0], []).append(re.escape(w[1:]))
    return "(?:" + "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in sorted(letters.items())) + ")"


def blocks_of(own: Column, prefixes: list[list[str]], sizes: list[tuple[int, int]]) -> Column:
    """template, start, words of the blocks that hold a prefix word of their template."""
    every = sorted({w for p in prefixes for w in p})

    def of_template(hits: Column, k: int, members: list[str], size: int, step: int) -> Column:
        at = F.filter(hits, lambda i: F.get(own, i).isin(members))
        first = lambda i: F.greatest(F.lit(0).cast("long"), F.ceil((i - (size - 1)) / step))
        numbers = F.array_distinct(F.flatten(F.transform(at, lambda i: F.sequence(first(i), F.floor(i / step)))))
        return F.transform(numbers, lambda b: F.struct(
            F.lit(k).alias("template"), (b * step).cast("int").alias("start"), F.slice(own, (b * step + 1).cast("int"), size).alias("words")))

    def around(hits: Column) -> Column:
        return F.flatten(F.array(*[of_template(hits, k, members, *sizes[k]) for k, members in enumerate(prefixes)]))

    return let(F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda i: F.get(own, i).isin(every)), around)


def matching_blocks(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """k1, k2 (row), start (first word), label, containment of every block that reaches the threshold."""
    spark = docs.sparkSession
    sets = [(label, sorted(set(words_of(t)))) for label, t in templates]
    sizes = [block_size(len(words_of(t))) for _, t in templates]
    vocabulary = sorted({w for _, s in sets for w in s})
    counts = word_counts(docs, vocabulary)
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    by_rank = sorted(order, key=order.get)
    prefixes, first = [], []
    for k, (label, members) in enumerate(sets):
        ranks = sorted(order[w] for w in members)
        need = math.ceil(threshold * len(ranks) - 1e-9)
        first.append([by_rank[r] for r in ranks[:len(ranks) - need + 1]])
        for at, rank in enumerate(ranks[:len(ranks) - need + 1]):
            prefixes.append({"rank": rank, "template": k, "label": label, "t_pos": at, "need": need, "t_ranks": ranks})
    has_prefix_word = "(?i)(?<![0-9a-z])" + any_of(sorted({w for p in first for w in p})) + "(?![0-9a-z])"
    rank_of = F.create_map(*[F.lit(x) for w, r in order.items() for x in (w, r)])
    blocks = (docs.where(F.col("text").rlike(has_prefix_word))
              .select("k1", "k2", let(words(F.col("text")), lambda own: blocks_of(own, first, sizes)).alias("blocks"))
              .select("k1", "k2", F.inline("blocks"))
              .select("k1", "k2", "template", "start", F.array_sort(F.transform(
                  F.filter(F.array_distinct("words"), lambda w: w.isin(vocabulary)), lambda w: F.element_at(rank_of, w))).alias("ranks")))
    pairs = (blocks.select("k1", "k2", "template", "start", "ranks", F.posexplode("ranks").alias("b_pos", "rank"))
             .join(F.broadcast(inline(spark, prefixes)), ["template", "rank"])        # a fixed number of rows
             .where((F.size("ranks") >= F.col("need")) &
                    (1 + F.least(F.size("t_ranks") - 1 - F.col("t_pos"), F.size("ranks") - 1 - F.col("b_pos")) >= F.col("need"))))
    overlap = F.size(F.array_intersect("ranks", "t_ranks"))
    return (pairs.where(overlap >= F.col("need"))
            .select("k1", "k2", "start", "template", "label", (overlap / F.size("t_ranks")).alias("containment"))
            .distinct())


def scan(docs: DataFrame) -> DataFrame:
    """Per document: words, phrase places and labels, and `matches` (start, label, containment)."""
    keyed = docs.select("doc_id", "text", *row_key("doc_id", "text"))
    matches = matching_blocks(keyed).groupBy("k1", "k2").agg(
        F.array_sort(F.collect_set(F.struct("start", "label", "containment"))).alias("matches"))
    starts = F.flatten(F.transform("places", lambda x: x["starts"]))
    return (base_scan(keyed).drop("text").join(matches, ["k1", "k2"], "left")
            .withColumn("matches", F.coalesce("matches", F.array().cast(matches.schema["matches"].dataType)))
            .withColumn("starts", F.coalesce(starts, F.array().cast("array<int>")))
            .withColumn("base", F.coalesce(F.transform("places", lambda x: x["label"]), F.array().cast("array<string>"))))


def query(docs: DataFrame) -> DataFrame:
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("matches", lambda x: x["label"]))))
    best = F.array_max(F.transform("matches", lambda x: x["containment"]))
    return scan(docs).select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))


def sql() -> str:
    """The same result by comparing every block with its template."""
    lower = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    word_list = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    values = ", ".join("({}, '{}', [{}], {}, {})".format(k, label, ", ".join(f"'{w}'" for w in sorted(set(words_of(t)))), *block_size(len(words_of(t))))
                       for k, (label, t) in enumerate(TEMPLATES))
    phrase = lambda p: " AND ".join(f"w[i + {k}] = '{x}'" if k else f"w[i] = '{x}'" for k, x in enumerate(p.split()))
    own = ", ".join(f"list_filter(range(1, len(w) + 1), lambda i: {phrase(p)}) AS p_{label}" for label, p in PHRASES)
    return f"""
WITH t(k, label, ws, size, step) AS (VALUES {values}),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, {word_list.format(lower.format('text'))} AS w FROM d),
p AS (SELECT doc_id, len(w) AS n_words, {own} FROM w),
b AS (SELECT doc_id, n_words, list_concat(list_concat(p_mit, p_apache), p_gpl) AS s,
        list_filter([CASE WHEN len(p_apache) > 0 THEN 'apache' END, CASE WHEN len(p_gpl) > 0 THEN 'gpl' END,
                     CASE WHEN len(p_mit) > 0 THEN 'mit' END], lambda x: x IS NOT NULL) AS base FROM p),
blocks AS (SELECT doc_id, label, ws, list_distinct(w[start + 1 : start + size]) AS own FROM (
    SELECT doc_id, label, ws, size, w, unnest(range(0, len(w), step)) AS start FROM w, t
    WHERE len(list_intersect(list_distinct(w), ws)) >= ceil({THRESHOLD} * len(ws) - 1e-9))),
m AS (SELECT doc_id, label, len(list_intersect(own, ws))::DOUBLE / len(ws) AS c FROM blocks
    WHERE len(list_intersect(own, ws)) >= ceil({THRESHOLD} * len(ws) - 1e-9)),
g AS (SELECT doc_id, list(DISTINCT label) AS found, max(c) AS best FROM m GROUP BY doc_id)
SELECT b.doc_id, b.n_words, len(s) AS n_base, list_min(s) - 1 AS first_word, list_max(s) - 1 AS last_word,
    array_to_string(base, ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels,
    CASE WHEN len(s) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0) END AS score
FROM b LEFT JOIN g ON b.doc_id = g.doc_id
"""
