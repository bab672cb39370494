"""License scans (native DataFrame code only).

A document is cut into its lines and into its whole text; each such block is normalised
(lower case, runs of anything but letters, digits, ``.`` and ``+`` become one
space) and compared with every notice (``TEMPLATES``) by the Dice coefficient over
sets of word bigrams: ``2 |A & B| / (|A| + |B|)``.

Notices that are wrapped over lines or stand inside a paragraph, and whole
licence texts (``TEXTS``), are found in windows: runs of words of the whole
text, over line ends, of at most ``(2-t)/t`` times a template's bigrams (t is
the threshold).  Only windows that start and end with a run of the template's
own bigrams are scored, as any other window is bettered by one of them; of the
windows with one start, the four ends with the best score by counted positions
are scored exactly.  A window is no find of its own inside a matched block, or
where it meets a matched line of no lower score or a matched window, if their
template is or holds the window's (the Apache header names the Apache licence).

Pruning of blocks, all exact for scores of at least ``threshold`` t:
* bigrams that occur in no template cannot add to a score: they are dropped by one set
  lookup, and a block without any other is done;
* size bounds: a score of t needs ``|A| t/(2-t) <= |B| <= |A| (2-t)/t``, so a
  template is only compared with a block whose size is in its range.
A window needs ``|A| t/(2-t)`` distinct bigrams of the template: documents
without as many, or without as many within the longest window, are done.

Defined results: null and empty texts have no block; a block of one word has
no bigram and matches nothing; equal scores: the template first by name;
repeated rows give equal rows; an empty table an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.license_texts import TEXTS

THRESHOLD = 0.8

# Notices by which works name their licence, and short licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}



def _bigrams(text: str) -> list[str]:
    kept = "".join(c if c.isascii() and (c.isalnum() or c in ".+") else " " for c in text.lower())
    ws = kept.split()
    return [f"{a} {b}" for a, b in zip(ws, ws[1:])]


def template_bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a template, normalised as the blocks are."""
    return list(dict.fromkeys(_bigrams(text)))


def normalised_words(text: Column) -> Column:
    """Lower-case words over ``[a-z0-9.+]`` and letters beyond ASCII."""
    return F.filter(F.split(F.lower(text), r"[^a-z0-9.+\x{80}-\x{10FFFF}]+"), lambda w: w != "")


def word_pairs(ws: Column) -> Column:
    return F.zip_with(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), F.slice(ws, 2, F.greatest(F.size(ws), F.lit(1))),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def _among(values: list[str]):
    return lambda b: b.isin(values)


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)     # names and normalised words hold no quote


def _holds(big: list[str], small: list[str], threshold: float) -> bool:
    """Whether the bigrams ``big`` of a text have a window that matches ``small``."""
    known = set(small)
    need, span = len(known) * threshold / (2 - threshold) - 1e-9, len(small) * (2 - threshold) / threshold + 1e-9
    at = [i for i, b in enumerate(big) if b in known]
    if len(known & set(big)) < need:
        return False
    for k, i in enumerate(at):
        if k and at[k - 1] == i - 1 and k % len(small):
            continue
        seen, hits = set(), 0
        for j in range(i, min(len(big), i + int(span))):
            if big[j] not in seen:
                seen.add(big[j])
                hits += big[j] in known
                if 2 * hits >= threshold * (len(seen) + len(known)):
                    return True
    return False


def _windows(rows: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """``rows`` (``lines``: their words, ``found``: the matches of the blocks)
    with ``windows``, an array of (score, name, a, z): matched runs of bigrams
    ``a`` to ``z`` of the whole text.  SQL text, as its lists of constants are
    parsed at once."""
    runs = {k: _bigrams(v) for k, v in sorted(templates.items())}
    held = [(t, s) for t in runs for s in runs if t == s or _holds(runs[t], runs[s], threshold)]
    inside = [f"{t}|{s}" for t, s in held]
    smaller = [f"{t}|{s}" for t, s in held if (s, t) not in held]
    lo, hi = threshold / (2 - threshold) - 1e-9, (2 - threshold) / threshold + 1e-9
    rows = rows.withColumn("pairs", word_pairs(F.flatten("lines")))
    vocab = sorted({b for bs in runs.values() for b in bs})
    rows = rows.withColumn("hits", F.expr(
        f"filter(transform(pairs, (b, i) -> CASE WHEN b IN ({_quoted(vocab)}) THEN named_struct('p', i, 'b', b) END), x -> x IS NOT NULL)"))
    spots = ", ".join(
        f"named_struct('name', '{k}', 'm', {len(set(bs))}, 'len', {len(bs)}, 'need', {math.ceil(len(set(bs)) * lo)}, 'span', {int(len(bs) * hi)}, "
        f"'h', filter(hits, x -> x.b IN ({_quoted(dict.fromkeys(bs))})))" for k, bs in runs.items())
    rows = rows.withColumn("spots", F.expr(f"""
        filter(array({spots}), t -> size(t.h) >= t.need AND size(array_distinct(transform(t.h, x -> x.b))) >= t.need
          AND exists(sequence(0, size(t.h) - t.need), i -> t.h[i + t.need - 1].p - t.h[i].p < t.span))"""))
    # every end of a window is scored exactly, the best one of each start is
    # kept; one-element arrays bind a value, so that it is computed once
    ends = "filter(t.e, j -> j - i + 1 >= t.need AND t.h[j].p - t.h[i].p < t.span)"
    exact = """2D * size(array_distinct(transform(slice(t.h, i + 1, j - i + 1), y -> y.b)))
        / (size(array_distinct(slice(r.pairs, t.h[i].p + 1, t.h[j].p - t.h[i].p + 1))) + t.m)"""
    cut = """named_struct('name', t.name, 'm', t.m, 'len', t.len, 'need', t.need, 'span', t.span, 'h', t.h,
        's', filter(sequence(0, size(t.h) - 1), i -> i % t.len = 0 OR t.h[i].p <> t.h[i - 1].p + 1),
        'e', filter(sequence(0, size(t.h) - 1), i -> (i + 1) % t.len = 0 OR i = size(t.h) - 1 OR t.h[i + 1].p <> t.h[i].p + 1))"""
    rows = rows.withColumn("w", F.expr(f"""
        CASE WHEN size(spots) > 0 THEN transform(array(named_struct('pairs', pairs, 'spots', spots)), r ->
          flatten(transform(transform(r.spots, t -> {cut}), t ->
            flatten(transform(t.s, i -> slice(sort_array(transform({ends}, j ->
              named_struct('score', {exact}, 'name', t.name, 'a', t.h[i].p, 'z', t.h[j].p)), false), 1, 1))))))[0] END"""))
    rows = rows.withColumn("w", F.expr(f"filter(w, c -> c.score >= {threshold}D)"))
    rows = rows.withColumn("w", F.expr(f"""
        CASE WHEN size(w) > 0 THEN transform(array(named_struct('w', w, 'found', found, 'n', size(lines),
            'line', flatten(transform(lines, (l, k) -> array_repeat(k, size(l)))))), r ->
          filter(r.w, c -> NOT exists(concat(slice(r.found, r.line[c.a] + 1, r.line[c.z + 1] - r.line[c.a] + 1), slice(r.found, r.n + 1, 1)),
            m -> coalesce(exists(m, b -> concat(b.name, '|', c.name) IN ({_quoted(inside)})
              AND (b.score >= c.score OR r.line[c.a] = r.line[c.z + 1] OR size(r.found) > r.n AND m = r.found[r.n])), false))))[0] END"""))
    rows = rows.withColumn("windows", F.expr(f"""
        CASE WHEN size(w) > 0 THEN transform(array(w), w -> filter(w, c -> NOT exists(w, d ->
          d.a <= c.z AND c.a <= d.z AND concat(d.name, '|', c.name) IN ({_quoted(smaller) or "''"}))))[0]
        ELSE filter(coalesce(w, array()), c -> false) END"""))
    return rows.drop("pairs", "hits", "spots", "w")


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, n_blocks`` (lines with a word, and the
    whole text where it has several), ``n_matched`` blocks and places of
    windows (windows that overlap are one place), ``license`` and ``score`` of
    the best match (null without one), ``licenses``: all matched names, sorted
    and joined by a comma.  Without ``templates``, blocks are compared with
    ``TEMPLATES`` and windows with ``TEMPLATES`` and ``TEXTS``."""
    windowed = templates or TEMPLATES | TEXTS
    known = {k: template_bigrams(v) for k, v in (templates or TEMPLATES).items()}
    vocab = sorted({b for bs in known.values() for b in bs})
    # the bounds are a little wide, so that rounding cuts no exact tie off
    lo, hi = threshold / (2 - threshold) - 1e-9, (2 - threshold) / threshold + 1e-9
    longest, shortest = max(map(len, known.values())) * hi, min(map(len, known.values())) * lo
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.split(text, "\n").alias("lines"))
    lines = F.filter(F.transform("lines", normalised_words), lambda ws: F.size(ws) > 0)
    rows = rows.select("doc_id", lines.alias("lines"))
    whole = F.when(F.size("lines") > 1, F.array(F.flatten("lines"))).otherwise(F.filter(F.col("lines"), lambda x: F.lit(False)))
    rows = rows.select("doc_id", "lines", F.concat("lines", whole).alias("blocks"))

    def best(ws: Column) -> Column:
        """The matches of one block: array of (score, name)."""
        def compare(x: Column) -> Column:
            mine, n = x["hits"], x["n"]
            found = []
            for name in sorted(known):
                bs = known[name]
                fits = (n >= lo * len(bs)) & (n <= hi * len(bs)) & (2 * F.size(mine) >= F.lit(threshold - 1e-9) * (n + len(bs)))
                dice = 2 * F.size(F.filter(mine, _among(bs))) / (n + len(bs))
                found.append(F.when(fits, F.struct(dice.alias("score"), F.lit(name).alias("name"))))
            return F.filter(F.array(*found), lambda m: m["score"] >= threshold)
        # one-element arrays bind a value, so that it is computed once
        pairs = F.transform(F.array(word_pairs(ws)), lambda p: F.struct(
            F.array_distinct(F.filter(p, _among(vocab))).alias("hits"), p.alias("pairs")))
        # a score of t needs at least the share t / (2 - t) of the smallest template's bigrams
        pairs = F.filter(pairs, lambda x: F.size(x["hits"]) >= shortest)
        sized = F.transform(pairs, lambda x: F.struct(x["hits"].alias("hits"), F.size(F.array_distinct(x["pairs"])).alias("n")))
        return F.when(F.size(ws) > shortest, F.flatten(F.transform(F.filter(sized, lambda x: x["n"] <= longest), compare)))

    rows = rows.select("doc_id", "lines", F.size("blocks").cast("long").alias("n_blocks"), F.transform("blocks", best).alias("found"))
    rows = _windows(rows, windowed, threshold)
    places = """aggregate(array_sort(transform(windows, c -> named_struct('a', c.a, 'z', c.z))), named_struct('n', 0, 'z', -1),
        (s, c) -> CASE WHEN c.a > s.z THEN named_struct('n', s.n + 1, 'z', c.z) ELSE named_struct('n', s.n, 'z', greatest(s.z, c.z)) END, s -> s.n)"""
    rows = rows.select("doc_id", "n_blocks", F.filter("found", lambda m: F.coalesce(F.size(m), F.lit(0)) > 0).alias("m"), F.col("windows"),
                       F.expr(places).alias("places"))
    rows = rows.select("doc_id", "n_blocks", (F.size("m") + F.col("places")).cast("long").alias("n_matched"),
                       F.concat(F.flatten("m"), F.transform("windows", lambda c: F.struct(c["score"].alias("score"), c["name"].alias("name")))).alias("m"))
    top = F.element_at(F.array_sort(F.transform("m", lambda m: F.struct((-m["score"]).alias("s"), m["name"].alias("name")))), 1)
    rows = rows.select("doc_id", "n_blocks", "n_matched", "m",
                       F.when(F.size("m") > 0, top).alias("top"))
    return rows.select("doc_id", "n_blocks", "n_matched", F.col("top")["name"].alias("license"),
                       (-F.col("top")["s"]).alias("score"),
                       F.array_join(F.array_sort(F.array_distinct(F.transform("m", lambda m: m["name"]))), ",").alias("licenses"))
