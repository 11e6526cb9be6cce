"""Licence scans: TF-IDF cosine to templates, then inheritance by directory.

``scan`` finds the licence that a file's own text states; ``inherit`` gives
files without one the licence of the nearest directory above them that holds a
licence file.

Method: a text is cut into statements: lines, sentences and paragraphs (also
over line ends and comment signs), the opening comment, and the whole text.
Templates are notices, titles, standard headers and short texts.  Words weigh by
their inverse document frequency, counted over all documents.  A statement
matches the template with the largest cosine, if that is at least
``THRESHOLD``.  The words of all documents are counted once, by their hashes; a
text is only cut if it holds an anchor, a word without which no statement
reaches the threshold (see ``anchors``), and only statements that can still
match when their other words weigh the least (1) are kept.  For
inheritance, every distinct directory is paired with its ancestors and joined
to the directories that hold a licence file; the deepest one counts.

All steps are built-in functions.  Only words, statements and the directories
are ever grouped; a directory with very many files is one row.

Defined results: null or empty text states nothing; equal cosines go to the
template first in name; a text with several statements takes the best one, of
equals the first, and a reservation of rights only if it states no licence; rows are known
by key and text, so rows that share a key, or have none, each have the licence of
their own text, and rows that repeat both have the same; a null path belongs to no directory and inherits nothing;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import saved

THRESHOLD = 0.6
# Notices, titles, standard headers and short texts of common licences, as their owners word them.
_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
          "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
          "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
          "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:")
_MIT_KEEP = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.")
_ISC_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
              "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
              "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
              "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.")
_BSD_NAME = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
             "software without specific prior written permission.")
_BSD_AS_IS = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
              "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
              "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
              "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
              "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
              "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_APACHE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
           "obtain a copy of the License at")
_APACHE_AS_IS = ('http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the '
                 'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
                 "the specific language governing permissions and limitations under the License.")
_UNLICENSE = ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
              "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.")
_ZLIB = ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it "
         "freely, subject to the following restrictions:")


def _gnu(kind: str, version: str, program: str = "program") -> str:
    """The standard header of a GNU licence."""
    return (f"This {program} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as "
            f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")


TEMPLATES = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", _gnu("Affero ", "3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", f"{_APACHE} {_APACHE_AS_IS}"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_AS_IS}"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", f"3. {_BSD_NAME}"),
    ("BSD-3-Clause", f"{_BSD} 3. {_BSD_NAME} {_BSD_AS_IS}"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", _gnu("", "2")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", _gnu("", "3")),
    ("ISC", "ISC License"),
    ("ISC", _ISC),
    ("ISC", f"{_ISC} {_ISC_AS_IS}"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", _gnu("Lesser ", "2.1", "library")),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", _gnu("Lesser ", "3", "library")),
    ("MIT", "Released under the MIT License."),
    ("MIT", _MIT),
    ("MIT", f"{_MIT} {_MIT_KEEP} {_AS_IS}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", _UNLICENSE),
    ("Zlib", _ZLIB),
]
RESERVED = "Proprietary"  # counts only where no other licence is stated
WORD = r"[^a-z0-9.]+"
STATEMENT = r"\n|(?<=[.!?])\s+"
SENTENCE = r"(?<=[.!?])\s+"
PARAGRAPH = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"  # a line without a letter or digit is a border, also inside a comment
MARGIN = r"\s*\n[^\p{L}\p{N}\n]*"  # the end of a line and the next one's comment sign
HEADER = r"\A\s*+((?s:/\*.*?\*/)|(?:[ \t]*+(?:#|//|--|;|%)[^\n]*+(?:\n|\z))++)"  # the comment that opens a file


def words(text: Column) -> Column:
    """Distinct lower-case words of a text; a dot counts inside a word only."""
    split = F.split(F.lower(text), WORD)
    return F.array_distinct(F.filter(F.transform(split, lambda w: F.trim(w, F.lit("."))), lambda w: w != ""))


def units(text: Column) -> Column:
    """What is compared with the templates: lines and their sentences, sentences and paragraphs over line ends, the opening comment, the text."""
    paragraphs = F.transform(F.split(text, PARAGRAPH), lambda p: F.regexp_replace(p, MARGIN, " "))
    sentences = F.flatten(F.transform(paragraphs, lambda p: F.split(p, SENTENCE)))
    return F.array_distinct(F.concat(F.split(text, STATEMENT), sentences, paragraphs, F.array(F.regexp_extract(text, HEADER, 1), text)))


def template_words(templates=TEMPLATES) -> list[tuple[str, list[str]]]:
    return [(name, sorted({w.strip(".") for w in re.split(WORD, text.lower())} - {""})) for name, text in templates]


def anchors(of: list[tuple[str, list[str]]], idf: dict[str, float], threshold: float) -> list[str]:
    """Words of which a matching statement holds at least one.

    A cosine of ``threshold`` needs words with threshold squared of the template's squared
    length; the lightest words that together weigh less are no anchors.
    """
    out = set()
    for _, ws in of:
        left = (threshold - 1e-6) ** 2 * sum(idf[w] ** 2 for w in ws)
        for w in sorted(ws, key=lambda w: (idf[w], w)):
            left -= idf[w] ** 2
            if left <= 0:
                out.add(w)
    return sorted(out)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, licence, score, statement, row) of every row whose text states a licence; row is ``row_hash``, and rows alike are one."""
    of = template_words(templates)
    vocabulary = sorted({w for _, ws in of for w in ws})
    known = F.array(*[F.lit(w) for w in vocabulary])
    whole = F.coalesce(F.col(text), F.lit(""))

    # pass 1: in how many documents each word is, counted before the exchange; words are known by their hashes from here on
    total = df.count()
    counts = saved(df.select(F.explode(F.transform(words(whole), lambda w: F.xxhash64(w))).alias("w")).groupBy("w").agg(F.count("*").alias("n")), "words")
    own = vocabulary_hashes(counts, vocabulary)
    freq = {r["word"]: r["n"] for r in own.collect()}  # at most the words of templates
    idf = {w: math.log((1.0 + total) / (1.0 + freq.get(w, 0))) + 1 for w in vocabulary}
    square = F.create_map(*[x for w, v in idf.items() for x in (F.lit(w), F.lit(v * v))])

    # pass 2: statements that may reach the threshold: their squared length is at least that of
    # their template words and 1 for each other word
    def inside(ws: Column) -> Column:
        return F.aggregate(ws, F.lit(0.0), lambda a, w: a + square[w])

    table = F.array(*[F.struct(F.lit(t).alias("licence"), F.lit(math.sqrt(sum(idf[w] ** 2 for w in ws))).alias("norm"), F.array(*map(F.lit, ws)).alias("ws"))
                      for t, ws in of])
    anchor = F.array(*map(F.lit, anchors(of, idf, threshold)))

    def let(value: Column, of_value) -> Column:
        return F.transform(F.array(value), of_value)[0]

    def best_template(ws: Column) -> Column:
        """The template with the largest cosine times the statement's length, of equals the first in name."""
        found = F.transform(table, lambda t: F.struct(F.round(-inside(F.array_sort(F.array_intersect(ws, t["ws"]))) / t["norm"], 9).alias("dot"), t["licence"].alias("licence")))
        return F.array_min(found)

    def reach(p: Column) -> Column:
        return F.sqrt(p["inside"] + F.size(p["other"])) * (threshold - 1e-6)

    parts = F.transform(units(whole), lambda s, i: let(words(s), lambda w: F.struct(i.alias("at"), s.alias("statement"), w.alias("ws"))))
    parts = F.filter(parts, lambda p: F.arrays_overlap(p["ws"], anchor))
    parts = F.transform(parts, lambda p: let(F.array_intersect(p["ws"], known), lambda k: F.struct(
        p["at"].alias("at"), p["statement"].alias("statement"), k.alias("known"), F.array_except(p["ws"], k).alias("other"), inside(F.array_sort(k)).alias("inside"))))
    parts = F.filter(parts, lambda p: F.sqrt(p["inside"]) >= reach(p))
    parts = F.transform(parts, lambda p: F.struct(p["at"].alias("at"), p["statement"].alias("statement"), p["other"].alias("other"), p["inside"].alias("inside"),
                                                  best_template(p["known"]).alias("best")))
    near = F.filter(parts, lambda p: -p["best"]["dot"] >= reach(p))
    rows = (df.where(F.arrays_overlap(words(whole), anchor))
            .select(F.struct(F.col(key)).alias("id"), row_hash(key, text).alias("row"), F.explode(near).alias("p")))
    rows = saved(rows.select("id", "row", "p.*").withColumn("other", F.array_sort(F.transform("other", lambda w: F.xxhash64(w)))), "statements")

    # the weights of the other words of these statements; equal statements are one row from here on
    weight = F.log((1.0 + total) / (1.0 + F.col("n"))) + 1
    heavy = counts.select("w", (weight * weight).alias("w2"))
    of_words = F.xxhash64("other")
    distinct = rows.where(F.size("other") > 0).select(of_words.alias("ws"), "other").groupBy("ws").agg(F.first("other").alias("other"))
    lengths = distinct.select("ws", F.explode("other").alias("w")).join(heavy, "w").groupBy("ws").agg(F.sum("w2").alias("outside"))
    found = rows.withColumn("ws", of_words).join(lengths, "ws", "left").withColumn("outside", F.coalesce("outside", F.lit(0.0)))
    scored = found.withColumn("score", F.round(-F.col("best.dot") / F.sqrt(F.col("inside") + F.col("outside")), 6)).where(F.col("score") >= threshold)
    scored = scored.select("id", "row", "at", F.col("best.licence").alias("licence"), "score", "statement")
    best = F.min_by(F.struct("licence", "score", "statement"), F.struct(F.col("licence") == RESERVED, -F.col("score"), F.col("at"), F.col("licence")))
    return scored.groupBy("id", "row").agg(best.alias("b")).select(f"id.{key}", "b.licence", "b.score", "b.statement", "row")


def row_hash(key: str, text: str) -> Column:
    """With the key what a row is known by."""
    return F.xxhash64(F.col(key), F.col(text))


def vocabulary_hashes(counts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(word, n) of the words of the vocabulary."""
    each = F.array(*[F.struct(F.lit(w).alias("word"), F.xxhash64(F.lit(w)).alias("w")) for w in vocabulary])
    names = counts.sparkSession.range(1).select(F.explode(each).alias("x")).select("x.*")
    return counts.join(F.broadcast(names), "w").select("word", "n")


def directory(path: Column) -> Column:
    """The part before the last slash (none: the root, an empty name)."""
    return F.regexp_replace(F.when(F.instr(path, "/") > 0, path).otherwise(F.concat(F.lit("/"), path)), "/[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """The directory and all above it, deepest first, the root (an empty name) last."""
    parts = F.split(directory, "/")
    up = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return F.when(directory == "", F.array(F.lit(""))).otherwise(F.concat(up, F.array(F.lit(""))))


def inherit(files: DataFrame, path: str = "path", licence: str = "licence", is_licence_file: Column | None = None) -> DataFrame:
    """files with ``effective`` and ``from_dir``: the own licence, else that of the nearest directory with a licence file.

    A directory with several licence files takes the first licence in name.
    """
    is_file = F.lower(F.element_at(F.split(F.col(path), "/"), -1)).rlike(r"^(licen[sc]e|copying)(\..*)?$") if is_licence_file is None else is_licence_file
    here = files.withColumn("_dir", directory(F.col(path)))
    holding = here.where(is_file & F.col(licence).isNotNull()).groupBy(F.col("_dir").alias("_up")).agg(F.min(licence).alias("_found"))
    up = here.where("_dir is not null").select("_dir").distinct().select("_dir", F.posexplode(ancestors(F.col("_dir"))).alias("_far", "_up"))
    nearest = up.join(holding, "_up").groupBy("_dir").agg(F.min_by(F.struct("_found", "_up"), "_far").alias("_near"))
    got = here.join(nearest, "_dir", "left")
    own = F.col(licence).isNotNull()
    return got.withColumn("effective", F.coalesce(F.col(licence), F.col("_near._found"))).withColumn(
        "from_dir", F.when(~own, F.col("_near._up"))).drop("_dir", "_near")


def scan_files(df: DataFrame, path: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, path, licence, score, effective, from_dir) of every row."""
    own = scan(df, key, text)
    files = df.select(key, path.alias("path"), row_hash(key, text).alias("_row"))
    found = own.select(F.col(key).alias("_k"), F.col("row").alias("_r"), "licence", "score")  # one per key and text
    files = files.join(found, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_row") == F.col("_r")), "left").drop("_k", "_r", "_row")
    return inherit(files).select(key, "path", "licence", "score", "effective", "from_dir")


def derived_path(key: str = "doc_id", source: str = "source") -> Column:
    """A path for tables without one: documents of a source in folders of 16, these in folders of 256.

    The first document of a folder is its licence file.
    """
    seq = F.floor(F.col(key) / 20).cast("long")
    a, b = F.floor(seq / 256).cast("string"), F.floor(seq / 16).cast("string")
    root = F.coalesce(F.col(source), F.lit("unknown"))
    return F.when(seq % 256 == 0, F.concat_ws("/", root, a, F.lit("LICENSE"))).when(
        seq % 16 == 0, F.concat_ws("/", root, a, b, F.lit("LICENSE"))).otherwise(
        F.concat_ws("/", root, a, b, F.concat(F.lit("doc"), F.col(key).cast("string"), F.lit(".txt"))))
