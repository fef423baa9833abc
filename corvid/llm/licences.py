"""Licence scans: a trained paragraph classifier with template comparison.

A paragraph (lines up to one without a word) is described by its words and
word pairs: as a whole, line by line, and, where it is longer, in overlapping
windows of ``WINDOWS`` words, so that a wrapped notice is read as one and a
notice in a long text isn't outvoted by what surrounds it.
A sparse multinomial logistic regression over them tells licence families
apart, and from ``unknown``: ordinary text. It is trained here, on notices
made from the templates below (words dropped, ordinary text around them) and
on a bounded sample of the corpus' own lines as the unknown class. A
temperature fitted on samples kept aside calibrates the probabilities. A
notice is reported, at the line it begins in, if a family has at least
``MIN_PROBABILITY`` in one of these stretches and one of the family's templates
stands there: at least ``MIN_SIMILARITY`` of the template's words in order,
within twice its length. The words found are scored once more on their own,
which tells families of like wording apart. Of notices that overlap, the one most alike stays (of
equals, that of the longer template), and a line gives a family one row.

Features are the words and pairs of the training notices and of the sample's
most common ones, at most ``MAX_FEATURES``, so the model's size is bounded
and it is broadcast; every paragraph of every text is scored.

A text is read in pieces of ``PIECE_WORDS`` words or somewhat more. They end
with a paragraph; one of more than twice that many words is cut into pieces
that overlap, and these count as paragraphs.

Defined results: words are runs of letters and digits, lower-cased; null and
empty texts have no paragraphs. Lines are counted from 0 and empty lines
count. Rows that repeat an id each give their rows. Extra columns are not
read.
"""

from __future__ import annotations

import random
import re
from bisect import bisect
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import release_memory, shared_value
from corvid.llm.decontaminate import overlap
from corvid.llm.decontaminate import runs_of as words_of
from corvid.llm.pagediff import common_lines

UNKNOWN = "unknown"
MIN_PROBABILITY = 0.5
MIN_SIMILARITY = 0.8
# Bounds of the training sample and the model.
SAMPLE_DOCUMENTS = 400
SAMPLE_LINES = 3000
SAMPLE_WORDS = 60
MAX_FEATURES = 6000
NOTICES = 60
SEED = 17
ITERATIONS = 250
PENALTY = 1e-3
CHUNK_CHARS = 1 << 20
# Words of a text that are scored at a time; those that two pieces of one
# paragraph share.
PIECE_WORDS = 8192
OVERLAP_WORDS = 256
# Words of the windows in longer paragraphs, up to the length of the training
# samples, and how far apart they begin.
WINDOWS = ((16, 4), (32, 8), (SAMPLE_WORDS, 10))

# The wording of public licence notices.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL version 2.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation",
    ],
    "AGPL": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC0": [
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "Zlib": [
        "Licensed under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.",
    ],
    "Artistic-2.0": [
        "Licensed under the Artistic License 2.0.",
        "you can redistribute it and/or modify it under the terms of the Artistic License (2.0).",
    ],
    "OFL-1.1": [
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    ],
    "EUPL-1.2": [
        "Licensed under the European Union Public Licence, version 1.2.",
        "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - "
        "subsequent versions of the EUPL",
    ],
    "SSPL-1.0": [
        "Licensed under the Server Side Public License, version 1.",
        "you can redistribute it and/or modify it under the terms of the Server Side Public License, version 1, as "
        "published by MongoDB, Inc.",
    ],
}
_WORDS = {family: [words_of(t) for t in texts] for family, texts in TEMPLATES.items()}
_LINE = re.compile(r"\r\n|\r|\n")


def similarity(template: list[str], words: list[str]) -> float:
    """The template's best overlap with a stretch of twice its length."""
    n = len(template)
    return max(overlap(template, words[i:i + 2 * n]) for i in range(0, max(1, len(words) - n), max(1, n // 2)))


def best_template(family: str, words: list[str]) -> tuple[float, int]:
    """Similarity and number of the family's template that stands there best."""
    return max((similarity(t, words), -k) for k, t in enumerate(_WORDS[family]))


def notice_in(family: str, words: list[str]) -> tuple[float, int, int, int] | None:
    """Similarity, number, first and last position of the family's template
    that stands there best, if any does."""
    held, found = set(words), None
    for k, template in enumerate(_WORDS[family]):
        n = len(template)
        if sum(w in held for w in template) < MIN_SIMILARITY * n:
            continue
        for i in range(0, max(1, len(words) - n), max(1, n // 2)):
            at = common_lines(words[i:i + 2 * n], template)
            alike = len(at) / n
            if alike >= MIN_SIMILARITY and (found is None or (alike, n) > (found[0], len(_WORDS[family][found[1]]))):
                found = alike, k, i + at[0], i + at[-1]
    return found


def features_of(words: list[str]) -> list[str]:
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


@dataclass
class Model:
    """Weights by feature and class; class 0 is unknown."""

    families: list[str]
    words: dict[str, int]
    pairs: dict[tuple[int, int], int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def __post_init__(self):
        # weights with a last row for unknown features, and pairs by one number
        self._padded = np.vstack([self.weights, np.zeros(self.weights.shape[1])])
        keys = np.array([a * len(self.weights) + b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self._pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self._pair_features = np.append(np.array(list(self.pairs.values()), np.int64)[order], -1)

    def of_stretches(self, words: list[str], first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Calibrated class probabilities of ``words[first[i]:end[i]]`` for
        each i, from running sums over all words."""
        get = self.words.get
        codes = np.array([get(w, -1) for w in words], np.int64)
        keys = np.where((codes[:-1] >= 0) & (codes[1:] >= 0), codes[:-1] * len(self.weights) + codes[1:], -1)
        at = np.searchsorted(self._pair_keys, keys)
        pairs = np.where(self._pair_keys[at] == keys, self._pair_features[at], -1)
        zero = np.zeros((1, self._padded.shape[1]))
        single = np.vstack([zero, np.cumsum(self._padded[codes], axis=0)])
        double = np.vstack([zero, np.cumsum(self._padded[pairs], axis=0)])
        logits = single[end] - single[first] + double[end - 1] - double[first]
        return _softmax((logits + self.bias) / self.temperature)

    def probabilities(self, lines: list[list[str]]) -> np.ndarray:
        """Calibrated class probabilities of lines given as words."""
        get, pairs = self.words.get, self.pairs
        row, feature = [], []
        for i, words in enumerate(lines):
            codes = [get(w, -1) for w in words]
            hits = [c for c in codes if c >= 0]
            if len(hits) > 1:
                hits += [pairs[p] for p in zip(codes, codes[1:], strict=False) if p in pairs]
            row += [i] * len(hits)
            feature += hits
        rows, columns = np.array(row, np.int64), np.array(feature, np.int64)
        logits = np.stack([np.bincount(rows, self.weights[columns, k], len(lines)) for k in range(len(self.families))], axis=1)
        return _softmax((logits + self.bias) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def notices(background: list[list[str]], count: int = NOTICES, seed: int = SEED) -> list[tuple[str, list[str]]]:
    """Training notices: (family, words), ``count`` of each template."""
    rng, out = random.Random(seed), []
    for family, templates in _WORDS.items():
        for template in templates:
            for _ in range(count):
                words = [w for w in template if rng.random() > 0.04]
                for side in (0, 1):
                    if background and rng.random() < 0.4:
                        more = rng.choice(background)[:rng.randint(1, 30)]
                        words = more + words if side else words + more
                out.append((family, words))
    return out


def fit(background: list[list[str]]) -> Model:
    """Train on made notices and on ``background`` lines (words) that hold
    no template."""
    plain = [b[:SAMPLE_WORDS] for b in background if b]
    signs = {w for ts in _WORDS.values() for t in ts for w in t}
    plain = [b for b in plain if len(signs.intersection(b)) < 3
             or max(best_template(f, b)[0] for f in _WORDS) < 0.5]
    samples = notices(plain) + [(UNKNOWN, b) for b in plain] + [(UNKNOWN, [])] * 20
    # single words of the notices alone don't make a licence
    rng = random.Random(SEED + 1)
    vocabulary = sorted(signs)
    samples += [(UNKNOWN, rng.sample(vocabulary, rng.randint(1, 4))) for _ in range(300)]
    counts = Counter(f for _, words in samples for f in set(features_of(words)))
    made = Counter(f for family, words in samples if family != UNKNOWN for f in set(features_of(words)))
    names = sorted(counts, key=lambda f: (-made[f], -counts[f], f))[:MAX_FEATURES]
    index = {f: i for i, f in enumerate(names)}
    families = [UNKNOWN, *TEMPLATES]
    # occurrences of known features, as sample and feature numbers
    held = [(i, index[f]) for i, (_, words) in enumerate(samples) for f in features_of(words) if f in index]
    y = np.array([families.index(f) for f, _ in samples])
    sample, feature = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
    aside = np.array([rng.random() < 0.2 for _ in samples])
    number = np.cumsum(~aside) - 1
    fitted = ~aside[sample]
    weights, bias = _train(number[sample[fitted]], feature[fitted], y[~aside], len(names), len(families))
    logits = _row_sums(weights, sample[~fitted], feature[~fitted], len(samples))[aside] + bias
    truth = y[aside]
    loss = {t: -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
            for t in np.geomspace(0.25, 4, 33)}
    words = {f: i for f, i in index.items() if " " not in f}
    pairs = {tuple(words[w] for w in f.split()): i for f, i in index.items()
             if " " in f and all(w in words for w in f.split())}
    return Model(families, words, pairs, weights.astype(float), bias.astype(float), float(min(loss, key=loss.get)))


def _row_sums(values: np.ndarray, row: np.ndarray, entry: np.ndarray, rows: int) -> np.ndarray:
    """For each row, the sum of the rows of ``values`` that its entries name
    (``row`` ascending)."""
    out = np.zeros((rows, values.shape[1]), values.dtype)
    if len(row):
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        out[row[starts]] = np.add.reduceat(values[entry], starts, axis=0)
    return out


def _train(sample: np.ndarray, feature: np.ndarray, y: np.ndarray, features: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression with an L2 penalty, by full gradients
    with adaptive steps. The samples are sparse: ``sample`` and ``feature``
    number their features' occurrences."""
    target = np.eye(classes, dtype=np.float32)[y]
    # every class weighs the same
    weight = (1 / np.maximum(target.sum(axis=0), 1))[y][:, None] * len(y) / classes
    by_feature = np.argsort(feature, kind="stable")
    sorted_feature, sorted_sample = feature[by_feature], sample[by_feature]
    parameters = np.zeros((features + 1, classes), np.float32)
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, ITERATIONS + 1):
        logits = _row_sums(parameters, sample, feature, len(y)) + parameters[-1]
        error = ((_softmax(logits) - target) * weight / len(y)).astype(np.float32)
        slope = _row_sums(error, sorted_feature, sorted_sample, features)
        slope = np.vstack([slope + PENALTY * parameters[:-1] / 10, error.sum(axis=0, keepdims=True)])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        parameters -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return parameters[:-1], parameters[-1]


def train(docs: DataFrame) -> Model:
    """Fit on a bounded sample of the lines of ``docs`` (``doc_id``,
    ``text``): lines of about ``SAMPLE_DOCUMENTS`` documents drawn by a hash,
    at most ``SAMPLE_LINES`` of them, cut to ``SAMPLE_WORDS`` words."""
    usable = docs.where("text is not null").select("text")
    rows = usable.count()
    if rows > SAMPLE_DOCUMENTS:
        usable = usable.where(F.pmod(F.xxhash64("text"), F.lit(2**32)) < int(SAMPLE_DOCUMENTS / rows * 2**32))

    def lines(batches):
        for batch in batches:
            out = [" ".join(words_of(line)[:SAMPLE_WORDS]) for text in batch.column(0).to_pylist() for line in _LINE.split(text)]
            yield pa.RecordBatch.from_arrays([pa.array([o for o in out if o], pa.string())], names=["line"])

    found = usable.mapInArrow(lines, "line string").distinct().orderBy(F.xxhash64("line"), "line").limit(SAMPLE_LINES)
    return fit([r.line.split() for r in found.collect()])


def scan_texts(model: Model, texts: list[str | None]) -> list[tuple]:
    """(text position, line, family, probability, template, similarity) of
    every confirmed notice."""
    return [(i, *row) for i, text in enumerate(texts) if text for row in _scan_text(model, text)]


@dataclass
class _Piece:
    """Consecutive words of a text with their lines: whole paragraphs, or a
    part of one that is longer than ``PIECE_WORDS``."""

    words: list[str]
    line_of: list[int]                  # of each word
    lines: list[tuple[int, int]]        # word ranges of lines and paragraphs
    paragraphs: list[tuple[int, int]]


_UNIT = re.compile(r"[^\W_]+|\r\n|\r|\n")


def _pieces(text: str):
    """The text's words, ``PIECE_WORDS`` or somewhat more at a time, each
    piece with the number of its first word. Where a paragraph is cut,
    ``OVERLAP_WORDS`` stand in both pieces, more than a window has."""
    words: list[str] = []
    line_of: list[int] = []
    line = at = 0

    def piece() -> _Piece:
        edges = [i for i in range(1, len(words)) if line_of[i] != line_of[i - 1]]
        lines = list(zip([0, *edges], [*edges, len(words)], strict=True))
        breaks = [i for i in edges if line_of[i] - line_of[i - 1] > 1]
        return _Piece(words, line_of, lines, list(zip([0, *breaks], [*breaks, len(words)], strict=True)))

    for unit in _UNIT.finditer(text.lower()):
        found = unit[0]
        if found[0] in "\r\n":
            line += 1
            continue
        if len(words) >= PIECE_WORDS:
            if line - line_of[-1] > 1:
                yield at, piece()
                at += len(words)
                words, line_of = [], []
            elif len(words) >= 2 * PIECE_WORDS:
                yield at, piece()
                at += len(words) - OVERLAP_WORDS
                words, line_of = words[-OVERLAP_WORDS:], line_of[-OVERLAP_WORDS:]
        words.append(found)
        line_of.append(line)
    if words:
        yield at, piece()


def _scan_text(model: Model, text: str) -> list[tuple]:
    found: list[tuple] = []
    for at, piece in _pieces(text):
        found += [(*f[:3], f[3] + at, f[4] + at, *f[5:], piece.line_of[f[3]]) for f in _notices_of(model, piece)]
    kept: dict[tuple[int, str], tuple] = {}
    taken: list[tuple[int, int]] = []              # apart from each other, in order
    for alike, _, chance, start, stop, family, template, line in sorted(found, key=lambda f: (-f[0], -f[1], -f[2], f[3:])):
        at = bisect(taken, (start, stop))
        if (not at or taken[at - 1][1] < start) and (at == len(taken) or stop < taken[at][0]):
            taken.insert(at, (start, stop))
            kept.setdefault((line, family), (chance, template, alike))
    return [(*where, *what) for where, what in sorted(kept.items())]


def _notices_of(model: Model, piece: _Piece) -> list[tuple]:
    """Confirmed notices of a piece (see ``_confirmed``)."""
    ranges = [*piece.lines, *piece.paragraphs]
    firsts, ends = [np.array([r[0] for r in ranges])], [np.array([r[1] for r in ranges])]
    for first, end in piece.paragraphs:
        for size, step in WINDOWS:
            if end - first > size:
                # the last window ends with the paragraph
                starts = np.append(np.arange(first, end - size, step), end - size)
                firsts.append(starts)
                ends.append(starts + size)
    stretches = np.unique(np.stack([np.concatenate(firsts), np.concatenate(ends)], axis=1), axis=0)
    found = _confirmed(model, piece.words, stretches)
    if found:
        # the notices' own words tell families of like wording apart
        found += _confirmed(model, piece.words, np.unique([(f[3], f[4] + 1) for f in found], axis=0))
    return found


def _confirmed(model: Model, words: list[str], stretches: np.ndarray) -> list[tuple]:
    """(similarity, template's length, probability, first and last word,
    family, template) of the stretches that hold a notice."""
    p, found = model.of_stretches(words, stretches[:, 0], stretches[:, 1]), []
    p[:, 0] = 0
    best = p.argmax(axis=1)
    for at in np.flatnonzero(p[np.arange(len(p)), best] >= MIN_PROBABILITY).tolist():
        family, (first, end) = model.families[best[at]], stretches[at].tolist()
        notice = notice_in(family, words[first:end])
        if notice:
            alike, template, start, stop = notice
            found.append((alike, len(_WORDS[family][template]), float(p[at, best[at]]), first + start, first + stop,
                          family, template))
    return found


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, paragraph, family, probability, template, similarity`` of
    the licence notices of ``docs`` (``doc_id``, ``text``)."""
    load = shared_value(docs.sparkSession, model)
    spec = "doc_id long, paragraph long, family string, probability double, template int, similarity double"
    types = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.float64())
    names = [part.split()[0] for part in spec.split(", ")]

    def each(batches):
        model = load()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            start, out = 0, []
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (size < CHUNK_CHARS or end == start):
                    size += len(texts[end] or "")
                    end += 1
                out += [(ids[start + r[0]], *r[1:]) for r in scan_texts(model, texts[start:end])]
                start = end
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(each, spec)


def find_licences(docs: DataFrame) -> DataFrame:
    """Train on a sample of ``docs`` and scan all of them."""
    return scan(docs, train(docs))
