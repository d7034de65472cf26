"""License scan by diagonal voting.

Rolling hashes of all word k-grams of a document are joined with the positions of the same k-grams in license templates. A
hit votes for a diagonal (position in the document minus position in the template): text that follows a template puts all its
votes on one diagonal, and an inserted or missing word moves the rest to a neighbouring one. Votes are counted per (document,
template, diagonal), neighbouring diagonals are merged, and what remains is verified on the whole text by the share of
template words found in order. Short phrases are looked up exactly at every place. Every text is read, cut into words and
hashed once: what comes out is its row of numbers and its k-grams, of which the join keeps those of templates.

Votes of k-grams miss text that changes a word every few words or inserts many. Therefore every stretch of twice a template's
words that holds MATCHED of them, counted one by one and in any order, is verified as well: no stretch that verifies has fewer. There
a template below OWN_BELOW words must keep the words that no other label's template has, as "under the ... license" alone is 60 %
of one of them and names no license.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelattice.llm.hashing import WordHashes, windows
from carelattice.runtime import cut_lineage

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: The same on UTF-8: ASCII that is no word becomes a blank, A-Z are lower-cased.
PLAIN = bytes(b if b > 0x7F or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
K = 3
#: Diagonals up to this far apart belong to one alignment.
NEAR = 4
#: Share of template k-grams that must vote before a span is verified.
VOTES = 0.4
#: Share of template words that must stand in order in a verified span.
MATCHED = 0.6
#: Templates with fewer words are met without votes only where their own words stand.
OWN_BELOW = 10
#: Texts with spans up to which the list of their digests is broadcast (32 MB).
BROADCAST_ROWS = 400_000

#: Phrase and label, found wherever the words stand consecutively.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Label and wording of whole short licenses (SPDX: MIT, BSD-3-Clause, ISC, Zlib, BSL-1.0, Unlicense) and of usual
#: license notices (Apache-2.0, GPL-3.0, LGPL, MPL-2.0, CC 4.0, CC0).
TEMPLATES = (
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
        CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
        IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
        OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment
        in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
        software. 3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "bsl-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software")
        to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished
        to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer,
        must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of
        machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR
        ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
        code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software
        dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    ),
    (
        "gpl",
        """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
        See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program.""",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("mit", "Released under the MIT License"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def words_of(text: str) -> list[str]:
    """Words of a whole text, A-Z lower-cased: runs of digits, ASCII letters and non-ASCII characters."""
    return WORD.findall(text.translate(UPPER))


def tokens(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, in UTF-8."""
    return text.translate(PLAIN).split()


def _hashes(words: list[str], cache: WordHashes) -> np.ndarray:
    return cache.of([w.encode("utf-8", "surrogatepass") for w in words])


def template_grams(templates=TEMPLATES, k: int = K) -> list[tuple[int, int, int]]:
    """(hash, template, position) of every k-gram of the templates."""
    cache = WordHashes()
    return [(int(h), t, p) for t, (_, text) in enumerate(templates) for p, h in enumerate(windows(_hashes(words_of(text), cache), k).astype(np.int64))]


def phrase_places(hashes: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts of the places where the words of a phrase stand consecutively."""
    n = len(hashes) - len(phrase) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    hit = hashes[:n] == phrase[0]
    for k in range(1, len(phrase)):
        hit &= hashes[k : k + n] == phrase[k]
    return np.flatnonzero(hit)


NUMBERS = ("n_words", "n_base", "first_word", "last_word")
PLACES = "array<struct<label: string, start: long, end: long, share: double>>"


def read_once(rows: DataFrame, phrases=PHRASES, k: int = K) -> DataFrame:
    """Two rows per row of (row, doc_id, text binary): its numbers (n_words, n_base, first_word, last_word, found, loose), and its grams.

    grams: rolling hashes of all word k-grams. loose: the places (label, start, end, share) that follow a template whatever
    their votes.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    place = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())])
    lists = [pa.list_(pa.string()), pa.list_(place)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        known = [(label, _hashes(words_of(phrase), cache)) for phrase, label in phrases]
        follow = Loose(cache)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                out: dict[str, list] = {c: [] for c in (*NUMBERS, "found", "loose")}
                each = []
                for text in batch.column("text"):
                    words = tokens(text.as_py())
                    hashes = cache.of(words)
                    each.append(windows(hashes, k).astype(np.int64))
                    out["loose"].append(follow.places(words, hashes))
                    places = [(label, phrase_places(hashes, p)) for label, p in known]
                    starts = np.concatenate([p for _, p in places])
                    out["n_words"].append(len(hashes))
                    out["n_base"].append(len(starts))
                    out["first_word"].append(int(starts.min()) if len(starts) else None)
                    out["last_word"].append(int(starts.max()) if len(starts) else None)
                    out["found"].append(sorted({label for label, p in places if len(p)}))
                n, names = batch.num_rows, ["row", "doc_id", *out, "grams"]
                numbers = [pa.array(out[c], pa.int64()) for c in NUMBERS] + [pa.array(out[c], t) for c, t in zip(("found", "loose"), lists, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *numbers, pa.nulls(n, pa.list_(pa.int64()))], names=names)
                ends = np.cumsum([0, *map(len, each)]).astype(np.int32)
                grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(each)))
                none = [pa.nulls(n, batch.column("doc_id").type), *[pa.nulls(n, pa.int64())] * len(NUMBERS), *[pa.nulls(n, t) for t in lists]]
                yield pa.RecordBatch.from_arrays([batch.column("row"), *none, grams], names=names)

    schema = f"row string, doc_id {kind}, " + ", ".join(f"{c} long" for c in NUMBERS) + f", found array<string>, loose {PLACES}, grams array<long>"
    return rows.select("row", "doc_id", "text").mapInArrow(run, schema)


def hits(read: DataFrame, templates=TEMPLATES, k: int = K) -> DataFrame:
    """The rows of numbers of ``read``, and a row (row, pos, template, at) for every gram that a template has."""
    places = read.sparkSession.createDataFrame(template_grams(templates, k), "h long, template int, at int")
    numbers = [c for c in read.columns if c != "grams"]
    joined = read.select(*numbers, F.posexplode_outer("grams").alias("pos", "h")).join(F.broadcast(places), "h", "left")
    return joined.where("at IS NOT NULL OR n_words IS NOT NULL").drop("h")


def spans(found: DataFrame, templates=TEMPLATES, k: int = K) -> DataFrame:
    """(row, template, start, end, votes): merged diagonals of hits (row, pos, template, at) with enough votes, in words of the document."""
    spark = found.sparkSession
    sizes = spark.createDataFrame([(t, max(1, len(words_of(text)) - k + 1)) for t, (_, text) in enumerate(templates)], "template int, n_grams int")
    once = found.select("row", "template", (F.col("pos") - F.col("at")).alias("diagonal"), "pos").distinct()  # equal texts vote once
    votes = once.groupBy("row", "template", "diagonal").agg(F.count(F.lit(1)).alias("votes"), F.min("pos").alias("start"), F.max("pos").alias("end"))
    # a template's diagonals in one document: gaps over NEAR begin a new alignment
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    opens = (F.col("diagonal") - F.lag("diagonal").over(order) > NEAR).cast("int")
    merged = (
        votes.withColumn("_opens", F.coalesce(opens, F.lit(1)))
        .withColumn("_alignment", F.sum("_opens").over(order))
        .groupBy("row", "template", "_alignment")
        .agg(F.sum("votes").alias("votes"), F.min("start").alias("start"), (F.max("end") + k).alias("end"))
    )
    return merged.join(F.broadcast(sizes), "template").where(F.col("votes") >= F.lit(VOTES) * F.col("n_grams")).drop("_alignment", "n_grams")


def own_words(templates=TEMPLATES) -> list[set[str]]:
    """Per template the words that no template of another label has; empty from OWN_BELOW words on."""
    each = [(label, words_of(text)) for label, text in templates]
    return [set(words).difference(*(w for other, w in each if other != label)) if len(words) < OWN_BELOW else set() for label, words in each]


def least_matched(size: int) -> int:
    """Fewest words of a template of ``size`` words that make a share of MATCHED."""
    return next(m for m in range(1, size + 1) if m / size >= MATCHED)


def stretches(hashes: np.ndarray, want: np.ndarray) -> Iterator[tuple[int, int]]:
    """Maximal runs (start, end) of windows of twice the template's words that hold enough of them, in any order.

    Windows begin at a template word, so every window in which the words stand in order lies in one of them.
    """
    kinds, most = np.unique(want, return_counts=True)
    at = np.minimum(np.searchsorted(kinds, hashes), len(kinds) - 1)
    places = np.flatnonzero(kinds[at] == hashes)
    return _runs(places, at[places], most, least_matched(len(want)), 2 * len(want))


def _runs(places: np.ndarray, kind: np.ndarray, most: np.ndarray, need: int, width: int) -> Iterator[tuple[int, int]]:
    """Runs of windows that begin at a place and hold ``need`` words; of a kind no more than ``most`` count.

    A word counts in a window unless ``most`` of its kind stand before it there, so the windows it counts in begin at
    neighbouring places: two marks per word and one running sum give all windows.
    """
    n = len(places)
    if n < need:
        return
    order = np.argsort(kind, kind="stable")
    sorted_kind, sorted_places, at = kind[order], places[order], np.arange(n)
    nth = at - np.searchsorted(sorted_kind, sorted_kind)
    limit = most[sorted_kind]
    before = np.empty(n, np.int64)  # the place of the word that shuts this one out
    before[order] = np.where(nth >= limit, sorted_places[np.maximum(at - limit, 0)], -1)
    low = np.searchsorted(places, np.maximum(before, places - width), side="right")
    held = np.cumsum(np.bincount(low, minlength=n + 1) - np.bincount(at + 1, minlength=n + 1))[:n]
    ends = np.searchsorted(places, places + width)
    start = end = -1
    for i in np.flatnonzero(held >= need):
        if start >= 0 and places[i] >= end:
            yield start, end
            start = -1
        start, end = int(places[i]) if start < 0 else start, int(places[ends[i] - 1]) + 1
    if start >= 0:
        yield start, end


def followed(want: list[str], own: set[str], words: list[str], start: int, end: int) -> list[tuple[int, int, float]]:
    """(start, end, share) of the places in words[start:end] that follow the template, the best ones first, none overlapping.

    Every window of twice the template's words that begins at one of them is tried.
    """
    found, kinds = [], set(want)
    matcher = SequenceMatcher(None, want, autojunk=False)
    for i in range(start, end):
        if words[i] not in kinds:
            continue
        got = words[i : min(end, i + 2 * len(want))]
        if not own <= set(got):
            continue
        matcher.set_seqs(want, got)
        if matcher.quick_ratio() * (len(want) + len(got)) / 2 < MATCHED * len(want) - 1e-9:
            continue
        blocks = [m for m in matcher.get_matching_blocks() if m.size]
        share = sum(m.size for m in blocks) / len(want)
        if share >= MATCHED and own <= {w for m in blocks for w in want[m.a : m.a + m.size]}:
            found.append((i + blocks[0].b, i + blocks[-1].b + blocks[-1].size, share))
    out: list[tuple[int, int, float]] = []
    for first, last, share in sorted(set(found), key=lambda x: (-x[2], x[1] - x[0], x[0])):
        if all(last <= f or e <= first for f, e, _ in out):
            out.append((first, last, share))
    return out


class Loose:
    """Places that follow a template whatever their votes."""

    def __init__(self, cache: WordHashes, templates=TEMPLATES) -> None:
        self.labels, self.wanted, self.own = [label for label, _ in templates], [words_of(text) for _, text in templates], own_words(templates)
        codes = [_hashes(want, cache) for want in self.wanted]
        self.known = np.unique(np.concatenate(codes))
        self.most = np.stack([np.bincount(np.searchsorted(self.known, code), minlength=len(self.known)) for code in codes])
        self.must = np.stack([np.isin(self.known, _hashes(sorted(own), cache)) for own in self.own])
        self.need = np.array([least_matched(len(want)) for want in self.wanted])

    def places(self, words: list[bytes], hashes: np.ndarray) -> list[dict]:
        """``words`` in UTF-8 and their hashes; a template whose words the whole text does not hold often enough is not looked for."""
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        where = np.flatnonzero(self.known[at] == hashes)
        if len(where) < self.need.min():
            return []
        kind = at[where]
        counts = np.bincount(kind, minlength=len(self.known))
        may = (np.minimum(counts, self.most).sum(axis=1) >= self.need) & ~(self.must & (counts == 0)).any(axis=1)
        out, texts = set(), None
        for t in np.flatnonzero(may):
            own = self.most[t][kind] > 0
            for run in _runs(where[own], kind[own], self.most[t], self.need[t], 2 * len(self.wanted[t])):
                texts = texts or [w.decode("utf-8", "surrogatepass") for w in words]
                out |= {(self.labels[t], *place) for place in followed(self.wanted[t], self.own[t], texts, *run)}
        return [{"label": label, "start": start, "end": end, "share": share} for label, start, end, share in sorted(out)]


def verified(found: DataFrame, rows: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``found`` with the text of ``rows`` (row, text binary): spans whose words follow the template, with label and share."""
    wanted = [words_of(text) for _, text in templates]
    labels = [label for label, _ in templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = words_of(row["text"].decode("utf-8", "replace"))
                for s in row["spans"]:
                    want = wanted[s["template"]]
                    got = words[max(0, s["start"] - len(want)) : s["end"] + len(want)]
                    share = sum(m.size for m in SequenceMatcher(None, want, got, autojunk=False).get_matching_blocks()) / len(want)
                    if share >= MATCHED:
                        out.append({"row": row["row"], "label": labels[s["template"]], "start": s["start"], "end": s["end"], "share": share})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("row", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))

    each = found.groupBy("row").agg(F.collect_list(F.struct("template", "start", "end")).alias("spans"))
    return each.join(rows, "row").select("row", "spans", "text").mapInArrow(run, "row string, label string, start long, end long, share double")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    score is the best share of a verified template, 1 where a phrase was found, else 0; spans lists the verified places as
    (label, start, end, share), ends exclusive, in words. Labels are distinct, sorted and comma-joined. Null and empty texts
    have no words and no labels. Rows with equal texts share one vote, found by the MD5 of the text; rows that repeat a doc_id
    or have none are rows like any other. Other columns are ignored.
    """
    plain = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), plain.alias("text")).withColumn("row", F.md5("text"))
    read = cut_lineage(hits(read_once(rows)), "license-read")
    found = cut_lineage(spans(read.where("at IS NOT NULL")), "license-spans")
    wanted = cut_lineage(found.select("row").distinct(), "license-rows")
    texts = rows.select("row", "text").join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, "row", "left_semi").groupBy("row").agg(F.min("text").alias("text"))
    sure = cut_lineage(verified(found, texts), "license-verified")
    per_row = sure.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("label", "start", "end", "share"))).alias("voted"))
    joined = read.where("n_words IS NOT NULL").join(per_row, "row", "left").withColumn("voted", F.coalesce("voted", F.array().cast(per_row.schema["voted"].dataType)))
    # a place that votes have found is told once, with the bounds of the votes
    told = lambda x: F.exists("voted", lambda v: (v["label"] == x["label"]) & (x["start"] < v["end"]) & (v["start"] < x["end"]))
    spans_ = F.sort_array(F.concat("voted", F.filter("loose", lambda x: ~told(x))))
    joined = joined.withColumn("spans", spans_)
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("found", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("found", F.col("spans.label"))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("spans.share"), F.lit(0.0))).alias("score"),
        "spans",
    )
