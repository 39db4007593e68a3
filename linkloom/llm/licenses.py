"""License scan: Dice coefficient over word bigrams against license templates, in DataFrame functions.

A text is lower-cased, every run of characters other than a-z and 0-9 becomes one blank (line and
sentence ends stay), and four kinds of unit are compared: each sentence, each line of several
sentences, each paragraph of several lines (between blank lines) and the whole text. A unit's bigrams are the distinct pairs of neighbouring words, each pair known by its 64-bit hash.

    dice(unit, template) = 2 |U and T| / (|U| + |T|)

A unit of |U| bigrams can reach a Dice of t only with templates whose size lies between
|U| t / (2 - t) and |U| (2 - t) / t, so only those are compared, and a unit with too few words for
any template isn't cut into bigrams at all. Everything happens in the document's own row: there is
no join and no shuffle, the templates are a literal.

A license of several sentences or paragraphs amid other text is found as a window, that is any run of
neighbouring sentences (line ends also end them) with at most |T| (2 - t) / t neighbouring pairs, |T|
counting repeated pairs too. A window never overlaps a unit that matches on its own; of overlapping
windows the one of the larger Dice counts, then the first name, then the earliest and shortest. Only
templates with enough bigrams anywhere in the text can have one.

A text without a third of a template's bigrams can't match it, in no unit and no window. So of each template
just over a third are chosen, and a text with none of those chosen is done after one pattern search. This
bound and those above are exact.

Rows: null, empty or one-word text matches nothing (license null, dice 0). Of equal coefficients
the template first by name wins. Repeated rows give repeated results.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from linkloom.llm.license_texts import TEXTS
from linkloom.llm.simhash import signed

LEAST_DICE = 0.8
#: Words of lower-cased text, and what lies between two of them.
WORDS, GAP = re.compile("[a-z0-9]+"), "[^a-z0-9]++"

#: Public license notices and texts, notices in order of their SPDX names, then TEXTS.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *TEXTS,
]


def template_bigrams(text: str) -> list[tuple[str, str]]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted(set(zip(words, words[1:], strict=False)))


def normalized(text: Column) -> Column:
    """Lower case; a tab for the end of a sentence, line ends as they are, one blank for the rest of what is neither letter nor digit."""
    ended = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[.!?]+(?=\\s|$)", "\t")
    return F.regexp_replace(ended, "[^a-z0-9\\n\\t]+", " ")


def bigrams(words: Column) -> Column:
    """The hashes of the distinct neighbouring pairs of an array of words."""
    first, second = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words))
    return F.array_distinct(F.zip_with(first, second, lambda a, b: F.xxhash64(a, b)))


def needed_pairs(templates: list[list[tuple[str, str]]], low: float) -> list[tuple[str, str]]:
    """Bigrams of which a text must have one, if it is to hold `low` of any template's bigrams.

    A text without the chosen ones of a template lacks more of it than it may. Long bigrams are
    chosen, which other texts seldom have, and first those chosen for another template.
    """
    chosen: set[tuple[str, str]] = set()
    for pairs in sorted(templates, key=len):
        spare = len(pairs) - math.ceil(low * len(pairs) - 1e-9)
        chosen |= {*sorted(pairs, key=lambda p: (p not in chosen, -len(p[0]) - len(p[1]), p))[: spare + 1]}
    return sorted(chosen)


def pairs_pattern(pairs: list[tuple[str, str]]) -> str:
    """A pattern for lower-cased text that holds one of the pairs of words, laid out as a tree of letters."""

    def tree(tails: list[str]) -> str:
        by_head: dict[str, list[str]] = {}
        for tail in tails:
            by_head.setdefault(tail[:1], []).append(tail[1:])
        branches = [(GAP if head == " " else head) + (tree(rest) if head else "") for head, rest in sorted(by_head.items(), reverse=True)]
        return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"

    return f"(?<![a-z0-9])(?:{tree([' '.join(p) for p in pairs])})(?![a-z0-9])" if pairs else "(?!)"


def pair_hash(first: str, second: str) -> int:
    """What F.xxhash64 makes of two words."""
    return signed(xxh64_intdigest(second.encode(), xxh64_intdigest(first.encode(), 42)))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST_DICE) -> DataFrame:
    """One row per row of docs (doc_id, text): license, dice, unit, template_size, n_matches, licenses.

    license, dice and unit (sentence, line, paragraph, text or window) tell the best match, template_size its
    number of bigrams; n_matches counts the units and windows that match a template, licenses lists all names matched.
    """
    ready = [(name, template_bigrams(text), len(WORDS.findall(text.lower()))) for name, text in templates]
    low, high = least / (2 - least), (2 - least) / least
    smallest = min(len(b) for _, b, _ in ready)
    # One constant a template, hashed here: thousands of literal calls would cost the driver seconds.
    hashes = lambda b: F.split(F.lit(" ".join(str(pair_hash(*p)) for p in b)), " ").cast("array<bigint>") if b else F.array().cast("array<bigint>")
    literal = F.array(*[F.struct(F.lit(name).alias("name"), hashes(b).alias("bigrams"), F.lit(len(b)).alias("size"), F.lit(max(0, n - 1)).alias("pairs")) for name, b, n in ready])
    body = F.col("body")
    sentences, lines = F.split(body, "[\t\n]+"), F.split(body, "\n")
    none = F.array().cast("array<struct<kind:string,part:int,words:array<string>>>")
    unit = lambda kind, words: lambda u, i: F.struct(F.lit(kind).alias("kind"), i.alias("part"), words(u).alias("words"))
    one, several = lambda u: F.split(F.trim(u), " "), lambda u: F.split(F.trim(F.translate(u, "\t\n", "  ")), " +")
    blank = r"\n\s*\n"
    # Parts keep their place; what is no unit of its own is an empty one.
    units_of = lambda parts, kind, where: F.transform(parts, unit(kind, lambda u: F.when(where(u), several(u)).otherwise(F.array().cast("array<string>"))))
    paragraphs = F.when(F.regexp_like(body, F.lit(blank)), units_of(F.split(body, blank), "paragraph", lambda p: F.contains(p, F.lit("\n")))).otherwise(none)
    whole = F.when(F.contains(body, F.lit("\n")), F.transform(F.array(body), unit("text", several))).otherwise(none)
    units = F.concat(F.transform(sentences, unit("sentence", one)), units_of(lines, "line", lambda x: F.regexp_like(x, F.lit("\t *[a-z0-9]"))), paragraphs, whole)
    # n words have n - 1 distinct bigrams at most, so shorter units can't match.
    long_enough = F.filter(units, lambda u: F.size(u["words"]) - 1 >= F.lit(smallest * low))
    cut = F.transform(long_enough, lambda u: F.struct(u["kind"].alias("kind"), u["part"].alias("part"), bigrams(u["words"]).alias("b")))

    def best(u: Column) -> Column:
        n = F.size(u["b"])
        near = F.filter(literal, lambda t: (t["size"] >= n * low) & (t["size"] <= n * high))
        rated = F.transform(
            near,
            lambda t: F.struct((2.0 * F.size(F.array_intersect(u["b"], t["bigrams"])) / (n + t["size"])).alias("dice"), t["name"].alias("name"), t["size"].alias("size")),
        )
        top = F.aggregate(
            F.filter(rated, lambda r: r["dice"] >= least),
            F.struct(F.lit(-1.0).alias("dice"), F.lit("").alias("name"), F.lit(0).alias("size")),
            lambda a, r: F.when((r["dice"] > a["dice"]) | ((r["dice"] == a["dice"]) & (r["name"] < a["name"])), r).otherwise(a),
        )
        return F.struct(top["dice"].alias("dice"), top["name"].alias("name"), top["size"].alias("size"), u["kind"].alias("kind"), u["part"].alias("part"))

    matched = F.filter(F.transform(cut, best), lambda m: m["dice"] >= 0)
    first = F.aggregate(
        F.col("matched"),
        F.struct(F.lit(0.0).alias("dice"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("size"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("int").alias("part")),
        lambda a, m: F.when((m["dice"] > a["dice"]) | ((m["dice"] == a["dice"]) & (m["name"] < a["name"])), m).otherwise(a),
    )

    words = lambda x: F.filter(F.split(F.translate(x, "\t\n", "  "), " "), lambda w: w != "")
    length = lambda parts: F.aggregate(parts, F.lit(0), lambda a, x: a + F.size(words(x)))
    parts = lambda kind: F.when(kind == "sentence", sentences).when(kind == "line", lines).when(kind == "paragraph", F.split(body, blank)).otherwise(F.array(body))
    taken = F.transform("matched", lambda m: F.struct(length(F.slice(parts(m["kind"]), 1, m["part"])).alias("a"), length(F.slice(parts(m["kind"]), 1, m["part"] + 1)).alias("b")))
    # `ends` holds the words before each sentence, `pairs` the hash of each word and the next one.
    sizes = F.filter(F.transform(sentences, lambda u: F.size(words(u))), lambda n: n > 0)
    ends = F.aggregate(sizes, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    pairs = F.zip_with(F.slice(words(body), 1, F.greatest(F.size(words(body)) - 1, F.lit(0))), F.slice(words(body), 2, F.size(words(body))), lambda a, b: F.xxhash64(a, b))
    laid = F.struct(taken.alias("taken"), ends.alias("ends"), pairs.alias("pairs"))
    possible = F.filter(literal, lambda t: F.size(F.array_intersect(F.col("laid.pairs"), t["bigrams"])) >= t["size"] * low)
    at, last = lambda i: F.get(F.col("laid.ends"), i), F.size("laid.ends") - 2
    known = F.transform(
        possible,
        lambda t: F.struct(
            t.alias("t"),
            F.aggregate(  # the pairs of the template before each sentence
                F.sequence(F.lit(0), last),
                F.array(F.lit(0)),
                lambda a, i: F.concat(a, F.array(F.element_at(a, -1) + F.size(F.filter(F.slice(F.col("laid.pairs"), at(i) + 1, at(i + 1) - at(i)), lambda h: F.array_contains(t["bigrams"], h))))),
            ).alias("hits"),
        ),
    )

    def windows(k: Column) -> Column:
        t, hits = k["t"], k["hits"]
        starts = F.filter(F.sequence(F.lit(0), last), lambda i: F.get(hits, i + 1) > F.get(hits, i))

        def from_start(i: Column) -> Column:
            fits = lambda j: (
                (at(j + 1) - at(i) - 1 <= t["pairs"] * high)
                & (F.get(hits, j + 1) - F.get(hits, i) >= t["size"] * low)
                & ~F.exists(F.col("laid.taken"), lambda r: (r["a"] < at(j + 1)) & (r["b"] > at(i)))
            )
            ends_at = F.filter(F.sequence(i, F.least(last, i + F.ceil(t["pairs"] * high).cast("int"))), fits)

            def rate(j: Column) -> Column:
                own = F.transform(F.array(F.array_distinct(F.slice(F.col("laid.pairs"), at(i) + 1, at(j + 1) - at(i) - 1))), lambda b: 2.0 * F.size(F.array_intersect(b, t["bigrams"])) / (F.size(b) + t["size"]))
                return F.struct((-F.get(own, F.lit(0))).alias("minus"), t["name"].alias("name"), at(i).alias("a"), at(j + 1).alias("b"), t["size"].alias("size"))

            return F.filter(F.transform(ends_at, rate), lambda w: w["minus"] <= -least)

        return F.flatten(F.transform(starts, from_start))

    rated = F.array_sort(F.flatten(F.transform("known", windows)))
    apart = F.aggregate(
        rated,
        F.array().cast("array<struct<minus:double,name:string,a:int,b:int,size:int>>"),
        lambda held, w: F.when(F.exists(held, lambda h: (h["a"] < w["b"]) & (h["b"] > w["a"])), held).otherwise(F.concat(held, F.array(w))),
    )
    found = F.transform(apart, lambda w: F.struct((-w["minus"]).alias("dice"), w["name"].alias("name"), w["size"].alias("size"), F.lit("window").alias("kind"), F.lit(0).alias("part")))
    likely = F.regexp_like(F.lower("text"), F.lit(pairs_pattern(needed_pairs([b for _, b, _ in ready], low))))
    # Each step sits behind a generator of one row, which keeps the optimizer from repeating it.
    # Null where nothing can match, so nothing below is evaluated for such a text.
    stage1 = docs.select("doc_id", F.explode(F.array(F.when(likely, normalized(F.col("text"))))).alias("body"))
    nothing = F.array().cast("array<struct<dice:double,name:string,size:int,kind:string,part:int>>")
    stage2 = stage1.select("doc_id", "body", F.explode(F.array(F.when(body.isNotNull(), matched).otherwise(nothing))).alias("matched"))
    laid_out = stage2.select("doc_id", "matched", F.explode(F.array(F.when(body.isNotNull(), laid))).alias("laid"))
    counted = laid_out.select("doc_id", "matched", "laid", F.explode(F.array(F.when(F.col("laid").isNotNull(), known))).alias("known"))
    with_windows = F.when(F.size(F.coalesce("known", F.array())) > 0, F.concat("matched", found)).otherwise(F.col("matched"))
    stage2 = counted.select("doc_id", F.explode(F.array(with_windows)).alias("matched"))
    stage3 = stage2.select("doc_id", "matched", F.explode(F.array(first)).alias("first"))
    return stage3.select(
        "doc_id",
        F.col("first.name").alias("license"),
        F.col("first.dice").alias("dice"),
        F.col("first.kind").alias("unit"),
        F.col("first.size").alias("template_size"),
        F.size("matched").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matched", lambda m: m["name"]))), ",").alias("licenses"),
    )
