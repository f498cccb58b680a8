"""Licence scan: lines of documents against licence templates by the Dice coefficient over word bigrams.

Text is normalised (lower case, letters, digits and inner dots kept, everything else a blank). A unit is one line, the whole text where it has several, or a
notice: words in a row, across lines or within one, that no line or whole text above them covers. Notices are searched from bigram to bigram shared with a
template, up to the size at which the template can still reach the coefficient; of overlapping ones the best stays. Dice of
two bigram sets cannot exceed 2 min / (min + max) of their sizes, so of the templates that share a bigram with a unit
(a list per bigram, in order of size) only the stretch of a fitting size is looked at. Templates travel with the task; they are a short list, not data.
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .text import expand, id_text, in_steps, mix, string_hashes, words

DICE = 0.8
#: The notices and short texts that licences ask for or are known by.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
            "to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
)
FOUND = "doc_id long, line int, license string, template int, dice double"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def normal(texts):
    return pc.replace_substring_regex(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN.]+", " "), r"\.(?:\s|$)|^\.", " ")


def bigrams(texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word bigrams of each text, and where each text's begin and end. A text of one word has none."""
    codes, offsets, distinct = words(texts)
    h = string_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    count = np.maximum(np.diff(offsets) - 1, 0)
    at = expand(offsets[:-1], count)
    pair = mix(h[at] * _STEP + h[at + 1]) if len(at) else np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((pair, text))
    pair, text = pair[order], text[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])
    return pair[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=len(count)))])


class Library(NamedTuple):
    names: list
    sizes: np.ndarray
    grams: np.ndarray  # distinct bigrams of all templates, sorted
    first: np.ndarray
    template: np.ndarray  # by bigram, and within one by the template's size
    by_size: np.ndarray  # sizes of all templates, sorted
    key: np.ndarray  # number of the bigram times the number of templates, plus the template's place by size


def library(templates=TEMPLATES) -> Library:
    grams, bounds = bigrams(normal(pa.array([t for _, t in templates], pa.string())))
    owner = np.repeat(np.arange(len(templates)), np.diff(bounds))
    sizes = np.diff(bounds)
    ranked = np.argsort(sizes, kind="stable")
    rank = np.argsort(ranked)
    order = np.lexsort((rank[owner], grams))
    distinct, first, number = np.unique(grams[order], return_index=True, return_inverse=True)
    return Library([n for n, _ in templates], sizes, distinct, np.append(first, len(grams)), owner[order], sizes[ranked], number * len(sizes) + rank[owner[order]])


def best_templates(lib: Library, texts, dice: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, template and coefficient of the best template of every text that reaches ``dice``; of equals the first in the list."""
    grams, bounds = bigrams(texts)
    size = np.diff(bounds)
    if not len(lib.grams) or not len(grams):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    low = np.searchsorted(lib.by_size, size * dice / (2 - dice) - 1e-9)
    high = np.searchsorted(lib.by_size, size * (2 - dice) / dice + 1e-9, side="right")
    text = np.repeat(np.arange(len(size)), size)
    near = (low < high)[text]
    grams, text = grams[near], text[near]
    place = np.minimum(np.searchsorted(lib.grams, grams), len(lib.grams) - 1)
    hit = lib.grams[place] == grams
    place, text = place[hit], text[hit]
    begin = np.searchsorted(lib.key, place * len(lib.names) + low[text])
    times = np.searchsorted(lib.key, place * len(lib.names) + high[text]) - begin
    template = lib.template[expand(begin, times)]
    pair, shared = np.unique(np.repeat(text, times) * len(lib.names) + template, return_counts=True)
    text, template = np.divmod(pair, len(lib.names))
    value = 2 * shared / (size[text] + lib.sizes[template])
    good = value >= dice
    text, template, value = text[good], template[good], value[good]
    order = np.lexsort((template, -value, text))
    text, template, value = text[order], template[order], value[order]
    top = np.ones(len(text), bool)
    top[1:] = text[1:] != text[:-1]
    return text[top], template[top], value[top]


def notices(lib: Library, lengths: np.ndarray, w, docs: np.ndarray, units: list, dice: float) -> list[tuple[int, int, float]]:
    """First word, template and coefficient of every notice in texts whose words are ``w``, text d from word docs[d] to docs[d + 1].

    ``units`` are (first word, end, template) of the units found. What they share with their template, from its first to its last bigram, takes no part.
    A window begins and ends with a bigram of its template and has at most (2 - dice) / dice times the template's words. The best coefficient goes
    first, then the longer window, the earlier template and the earlier place; windows that share a word with one taken go.
    """
    if not len(lib.grams) or len(w.codes) < 2:
        return []
    h = string_hashes(w.distinct)[w.codes]
    pairs = mix(h[:-1] * _STEP + h[1:])
    place = np.minimum(np.searchsorted(lib.grams, pairs), len(lib.grams) - 1)
    hit = lib.grams[place] == pairs
    starts = docs[(docs > 0) & (docs < len(h))]
    hit[starts - 1] = False
    at = np.flatnonzero(hit)
    times = lib.first[place[at] + 1] - lib.first[place[at]]
    template, at = lib.template[expand(lib.first[place[at]], times)], np.repeat(at, times)
    order = np.lexsort((at, template))
    template, at = template[order], at[order]
    group = np.searchsorted(template, np.arange(len(lib.names) + 1))
    taken = np.zeros(len(h), bool)
    for a, b, t in units:
        own = at[group[t]:group[t + 1]]
        own = own[np.searchsorted(own, a):np.searchsorted(own, b - 1)]
        if len(own):
            taken[own[0]:own[-1] + 2] = True
    blocked = np.concatenate([[0], np.cumsum(taken)])
    found = []
    for t, m in enumerate(lib.sizes):
        own = at[group[t]:group[t + 1]]
        need, most = max(1, int(np.ceil(m * dice / (2 - dice) - 1e-9))), int(lengths[t] * (2 - dice) / dice + 1e-9)
        if len(own) < need:
            continue
        doc = np.searchsorted(docs, own, side="right")
        far = np.arange(need - 1, len(own))
        seeds = np.flatnonzero((own[far] - own[:len(far)] < most) & (doc[far] == doc[:len(far)]) & (blocked[own[far] + 2] == blocked[own[:len(far)]]))
        for k in seeds.tolist():
            a, grams, shared, end = int(own[k]), set(), set(), int(own[k])
            for j in range(k, len(own)):
                b = int(own[j])
                if b - a >= most or doc[j] != doc[k] or blocked[b + 2] != blocked[a]:
                    break
                grams.update(pairs[end:b + 1].tolist())
                end = b + 1
                shared.add(int(pairs[b]))
                value = 2 * len(shared) / (len(grams) + int(m))
                if value >= dice:
                    found.append((-value, a - b, t, a, b + 2))
    out = []
    for value, _, t, a, b in sorted(found):
        if not taken[a:b].any():
            taken[a:b] = True
            out.append((a, t, -value))
    return sorted(out)


def scan(docs: DataFrame, *, dice: float = DICE, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per unit that carries a licence: doc_id, line (from 0, of a notice the one it begins on; -1 for the whole text), license, template (its place in the list), dice.

    Null and empty texts carry none; repeated rows are scanned one by one.
    """
    lib = library(templates)
    lengths = np.maximum(np.diff(words(normal(pa.array([t for _, t in templates], pa.string()))).offsets) - 1, 0)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column("text"), "")
        parts = pc.split_pattern(texts, "\n")
        offsets = np.asarray(parts.offsets).astype(np.int64)
        offsets = offsets - offsets[0]
        lines = normal(parts.flatten())
        line, template, value = best_templates(lib, lines, dice)
        doc = np.searchsorted(offsets, line, side="right") - 1
        number = line - offsets[doc]
        many = np.flatnonzero(np.diff(offsets) > 1)
        whole, template2, value2 = best_templates(lib, normal(texts.take(pa.array(many))), dice)
        w = words(lines)
        starts = w.offsets[offsets]
        units = [*zip(w.offsets[line].tolist(), w.offsets[line + 1].tolist(), template.tolist(), strict=True),
                 *zip(starts[many[whole]].tolist(), starts[many[whole] + 1].tolist(), template2.tolist(), strict=True)]
        more = notices(lib, lengths, w, starts, units, dice)
        first = np.array([a for a, _, _ in more], np.int64)
        within = np.searchsorted(w.offsets, first, side="right") - 1
        inside = np.searchsorted(offsets, within, side="right") - 1
        doc, number = np.concatenate([doc, many[whole], inside]), np.concatenate([number, np.full(len(whole), -1), within - offsets[inside]])
        template = np.concatenate([template, template2, np.array([t for _, t, _ in more], np.int64)])
        value2 = np.concatenate([value2, [v for _, _, v in more]])
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").take(pa.array(doc, pa.int64())), "line": pa.array(number.astype(np.int32)), "license": pa.array([lib.names[t] for t in template], pa.string()),
                                           "template": pa.array(template.astype(np.int32)), "dice": pa.array(np.concatenate([value, value2]))})

    return id_text(docs, id_col, text_col).mapInArrow(in_steps(work), FOUND)
