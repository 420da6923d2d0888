"""License scan by diagonal voting of word k-grams against license templates.

Words are runs of digits, letters a-z (A-Z lowered) and non-ASCII characters. A *base*
place is one where the words of a phrase stand consecutively; its label always stays.

*Method.* The hashes of all rolling ``K``-word grams of every text are joined in Spark with the
positions of the templates' grams. A hit at text word x and template word y votes for the
offset diagonal x - y; votes are counted by text, template and diagonal, and neighbouring
diagonals (within an eighth of the template, as words are put in or left out) are merged
into the one with the most votes around it. A diagonal with ``VOTES`` of the template's grams is a
candidate; its words are fetched and verified: the longest common subsequence of
template and span, both taken as words, gives the similarity 2 L / (template + span). Spans of
a similarity of ``LONG`` (``SHORT`` for templates under ``SHORT_WORDS`` words, in which one word
tells licenses apart) are kept; of overlapping spans the most similar one counts.

Scale: the templates are a fixed list, so their broadcast is bounded by the code (``TEMPLATES``).
Only grams that hit leave their task. Texts are known by their MD5 digest, so
thousands of copies are verified once; a bitmap of bounded size (``bitmap.py``) of the
candidates' digests lets only those texts through to the shuffle of the verification,
and only rows of verified texts meet their labels in a (salted) join. Voting groups are bounded by one text.

Defined cases: null and empty texts have no words, empty labels and score 0; a null or repeated doc_id keeps its
rows, each judged by its own text; extra columns are ignored; texts of any length are read whole, their grams
in pieces; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bitmap import bits_for, collect_bitmap, contains
from .textscan import LOWER, NON_ALNUM, runs, span_hash, spans, window_hash

K = 3
VOTES = 0.3
LONG, SHORT, SHORT_WORDS = 0.75, 0.9, 16
PIECE = 1 << 16     # grams of one row between Python and Spark
SALTS = 16

# Phrases of the base labels.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

# Public license notices, by label.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in "
            "all copies or substantial portions of the Software."),
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
               "file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
               "agreed to in writing, software distributed under the License is distributed on an "
               "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
               "implied."),
    ("apache", "licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms "
            "of the GNU General Public License as published by the Free Software Foundation, either "
            "version 3 of the License, or (at your option) any later version. This program is "
            "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
            "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "licensed under the GNU General Public License, version 2"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms "
             "of the GNU Lesser General Public License as published by the Free Software Foundation; "
             "either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl", "licensed under the GNU Lesser General Public License, version 3"),
    ("agpl", "licensed under the GNU Affero General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met: Redistributions of source code "
            "must retain the above copyright notice, this list of conditions and the following "
            "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
            "this list of conditions and the following disclaimer in the documentation and/or other "
            "materials provided with the distribution."),
    ("bsd", "licensed under the BSD 3-Clause License"),
    ("bsd", "licensed under the BSD 2-Clause License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
            "copy of the MPL was not distributed with this file, You can obtain one at "
            "https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is "
                  "free to copy, modify, publish, use, compile, sell, or distribute this software, "
                  "either in source code form or as a compiled binary, for any purpose, commercial or "
                  "non-commercial, and by any means."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or "
            "neighboring rights to this work"),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa", "licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "licensed under CC BY-NC-ND 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)


def cut(buf: np.ndarray, off: np.ndarray):
    """Lowered bytes, word starts, word ends, words of each row as offsets."""
    buf = LOWER[buf]
    return (buf, *spans(buf, off, NON_ALNUM))


def split(text: str) -> list[bytes]:
    """The words of one text."""
    return [w for _, b, o in runs(pa.array([text])) for w in _bytes(*cut(b, o)[:3])]


def _bytes(buf, start, end) -> list[bytes]:
    raw = buf.tobytes()
    return [raw[s:e] for s, e in zip(start.tolist(), end.tolist())]


def _hashes(words: list[bytes]) -> np.ndarray:
    buf = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    return span_hash(buf, end - [len(w) for w in words], end)


def template_grams(spark: SparkSession, templates) -> DataFrame:
    """t (template number), y (word), h (hash) of every rolling gram; a fixed, short list."""
    rows = []
    for t, (_, text) in enumerate(templates):
        h = window_hash(_hashes(split(text)), K).view(np.int64)
        rows += [(t, y, int(v)) for y, v in enumerate(h)]
    return spark.createDataFrame(rows, "t int, y int, h long")


def _grams(batches):
    """key, x (first word of the piece), grams (hashes) of every text."""
    for b in batches:
        for first, buf, off in runs(b.column("text")):
            buf, s, e, count = cut(buf, off)
            h = window_hash(span_hash(buf, s, e), K).view(np.int64)
            row, at, lists = [], [], []
            for r, (x, y) in enumerate(zip(count[:-1], count[1:])):
                for low in range(int(x), int(y) - K + 1, PIECE):
                    row.append(first + r)
                    at.append(low - int(x))
                    lists.append(h[low:min(low + PIECE, int(y) - K + 1)])
            if row:
                ends = np.concatenate([[0], np.cumsum([len(v) for v in lists])])
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").take(pa.array(row)), pa.array(at, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists)))],
                    names=["key", "x", "grams"])


def candidates(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """key, t, diagonal, votes: the merged diagonals with enough votes."""
    spark = docs.sparkSession
    sizes = [len(split(text)) for _, text in templates]
    facts = spark.createDataFrame(
        [(t, max(1, m // 8), max(1, int(np.ceil(VOTES * (m - K + 1))))) for t, m in enumerate(sizes)],
        "t int, slack int, least int")
    grams = docs.select("key", "text").mapInArrow(_grams, "key binary, x long, grams array<bigint>") \
        .select("key", "x", F.posexplode("grams").alias("i", "h"))
    hits = grams.join(F.broadcast(template_grams(spark, templates)), "h").select(
        "key", "t", (F.col("x") + F.col("i")).alias("x"), "y")
    # texts that repeat cast each vote once
    votes = hits.distinct().groupBy("key", "t", (F.col("x") - F.col("y")).alias("diagonal")).agg(
        F.count("*").alias("votes")).join(F.broadcast(facts), "t")
    of_text = Window.partitionBy("key", "t")
    near = of_text.orderBy(F.col("diagonal") / F.col("slack")).rangeBetween(-1, 1)
    summed = votes.withColumn("near", F.sum("votes").over(near)).where(F.col("near") >= F.col("least"))
    best = F.max(F.struct("near", "votes", (-F.col("diagonal")).alias("early"))).over(near)
    return summed.withColumn("best", best).where(
        (F.col("best.near") == F.col("near")) & (F.col("best.votes") == F.col("votes"))
        & (F.col("best.early") == -F.col("diagonal"))).select("key", "t", "diagonal", "near") \
        .withColumnRenamed("near", "votes")


def common(span: list[bytes], template: dict[bytes, int], size: int) -> tuple[int, int]:
    """Length of the longest common subsequence and the first span length that reaches it.
    ``template`` has the places of each word as bits of one integer."""
    full = (1 << size) - 1
    v, best, end = full, 0, 0
    for i, w in enumerate(span):
        u = v & template.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
            n = size - v.bit_count()
            if n > best:
                best, end = n, i + 1
    return best, end


class Template:
    def __init__(self, label: str, text: str):
        words = split(text)
        self.label, self.size = label, len(words)
        self.slack = max(1, self.size // 8)
        self.least = SHORT if self.size < SHORT_WORDS else LONG
        self.forward, self.backward = {}, {}
        for i, w in enumerate(words):
            self.forward[w] = self.forward.get(w, 0) | 1 << i
            self.backward[w] = self.backward.get(w, 0) | 1 << self.size - 1 - i

    def verify(self, words, diagonal: int) -> tuple[int, int, float] | None:
        """(first word, end, similarity) of the template round a diagonal."""
        low = max(0, diagonal - self.slack)
        span = words(low, max(low, diagonal + self.size + self.slack))
        n, end = common(span, self.forward, self.size)
        back = common(span[:end][::-1], self.backward, self.size)[1]
        alike = 2 * n / (self.size + back) if n else 0.0
        return (low + end - back, low + end, alike) if alike >= self.least else None


def without_overlap(found: list[tuple]) -> list[tuple]:
    """(first, end, similarity, label) of the most similar spans that do not overlap;
    ties to the longer, the earlier, the smaller label."""
    out: list[tuple] = []
    taken: set[int] = set()
    for f in sorted(found, key=lambda f: (-f[2], f[0] - f[1], f[0], f[3])):
        places = range(f[0], f[1])
        if taken.isdisjoint(places):
            taken.update(places)
            out.append(f)
    return sorted(out)


SPAN = "array<struct<label: string, first_word: bigint, end_word: bigint, similarity: double>>"
SPAN_ARROW = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                                 ("end_word", pa.int64()), ("similarity", pa.float64())]))


def _verified(templates):
    def run(batches):
        known = [Template(*t) for t in templates]
        for b in batches:
            spans_of, wanted = [], b.column("wanted").to_pylist()
            for first, buf, off in runs(b.column("text")):
                buf, s, e, count = cut(buf, off)
                for r in range(len(off) - 1):
                    x, y = int(count[r]), int(count[r + 1])

                    def words(low, high, x=x, y=y, s=s, e=e, buf=buf):
                        at = slice(min(x + low, y), min(x + high, y))
                        return [buf[i:j].tobytes() for i, j in zip(s[at], e[at])]

                    found = []
                    for c in wanted[first + r]:
                        span = known[c["t"]].verify(words, c["diagonal"])
                        if span:
                            found.append((*span, known[c["t"]].label))
                    spans_of.append([dict(label=f[3], first_word=f[0], end_word=f[1], similarity=f[2])
                                     for f in without_overlap(found)])
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(spans_of, SPAN_ARROW)],
                                             names=["key", "spans"])
    return run


def _flagged(held):
    """The rows whose key may be in the bitmap."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(contains(held.value, b.column("mark").to_numpy().view(np.uint64))))
    return run


def _base(phrases, held):
    """Base places of every text, and whether its key may be in the bitmap."""
    def run(batches):
        wanted = [(label, words, _hashes(words)) for label, p in phrases for words in [split(p)]]
        for b in batches:
            out = {"n": [], "base": [], "first": [], "last": [], "labels": []}
            for _, buf, off in runs(b.column("text")):
                buf, s, e, count = cut(buf, off)
                h = span_hash(buf, s, e)
                places = [[] for _ in range(len(off) - 1)]
                for label, words, hashes in wanted:
                    n = len(h) - len(words) + 1
                    if n <= 0:
                        continue
                    hit = np.ones(n, bool)
                    for i, v in enumerate(hashes):
                        hit &= h[i:n + i] == v
                    at = np.flatnonzero(hit)
                    row = np.searchsorted(count, at, side="right") - 1
                    for p, r in zip(at.tolist(), row.tolist()):
                        # the words themselves, within one text
                        if p + len(words) <= count[r + 1] and _bytes(
                                buf, s[p:p + len(words)], e[p:p + len(words)]) == words:
                            places[r].append((p - int(count[r]), label))
                out["n"] += np.diff(count).tolist()
                for p in places:
                    out["base"].append(len(p))
                    out["first"].append(min(p)[0] if p else None)
                    out["last"].append(max(p)[0] if p else None)
                    out["labels"].append(sorted({label for _, label in p}))
            flag = contains(held.value, b.column("mark").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), pa.array(out["n"], pa.int64()),
                 pa.array(out["base"], pa.int64()), pa.array(out["first"], pa.int64()),
                 pa.array(out["last"], pa.int64()), pa.array(out["labels"], pa.list_(pa.string())),
                 pa.array(flag)],
                names=["doc_id", "key", "n_words", "n_base", "first_word", "last_word", "base", "flag"])
    return run


def joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the
    verified spans (label, first_word, end_word, similarity) of every document. The score is the
    best similarity, 0.5 for a base place without a span, else 0."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                        F.unhex(F.md5(text)).alias("key")).withColumn("mark", F.xxhash64("key"))
    wanted = cut_lineage(candidates(keyed, templates).groupBy("key").agg(
        F.collect_list(F.struct("t", "diagonal")).alias("wanted")))
    held = spark.sparkContext.broadcast(
        collect_bitmap(wanted, F.xxhash64("key"), bits_for(wanted.count())))
    texts = keyed.select("key", "text", "mark").mapInArrow(
        _flagged(held), "key binary, text string, mark long").drop("mark")
    # one copy of each text is verified
    once = texts.groupBy("key").agg(F.any_value("text").alias("text"))
    verified = cut_lineage(once.join(wanted, "key").mapInArrow(
        _verified(templates), f"key binary, spans {SPAN}").where(F.size("spans") > 0))
    found = spark.sparkContext.broadcast(
        collect_bitmap(verified, F.xxhash64("key"), bits_for(verified.count())))
    base = cut_lineage(keyed.mapInArrow(
        _base(phrases, found), "doc_id long, key binary, n_words long, n_base long, "
        "first_word long, last_word long, base array<string>, flag boolean"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    hits = base.where("flag").withColumn("salt", salt).join(
        verified.withColumn("salt", copies), ["key", "salt"], "left").drop("salt")
    rows = hits.unionByName(base.where("not flag").withColumn("spans", F.lit(None).cast(SPAN)))
    spans_ = F.coalesce("spans", F.array().cast(SPAN))
    best = F.array_max(F.transform(spans_, lambda s: s["similarity"]))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", F.transform(spans_, lambda s: s["label"]))).alias("labels"),
        F.coalesce(best, F.when(F.col("n_base") > 0, 0.5), F.lit(0.0)).alias("score"),
        spans_.alias("spans"))
