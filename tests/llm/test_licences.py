"""Licence scans: accuracy on notices not trained on, planted lines of the
tables, and scores against plain sums."""

import random
import re

import numpy as np
import pytest
from helpers import AWKWARD, frame

from corvid.llm import licences
from corvid.session import table


@pytest.fixture(scope="module")
def background():
    rng = random.Random(1)
    stems = ["the", "of", "ing", "tion", "work", "is", "under", "a", "free", "software", "sch", "eau"]
    return [["".join(rng.choices(stems, k=rng.randint(1, 2))) for _ in range(rng.randint(1, 40))] for _ in range(600)]


@pytest.fixture(scope="module")
def model(background):
    return licences.fit(background)


def test_held_out_notices_are_told_apart(model, background):
    rows = licences.notices(background, count=10, seed=99)
    found = model.probabilities([w for _, w in rows]).argmax(axis=1)
    right = [model.families[k] == f for k, (f, _) in zip(found, rows, strict=True)]
    assert np.mean(right) > 0.95


def test_ordinary_lines_are_unknown(model, background):
    assert licences.scan_texts(model, [" ".join(b) for b in background]) == []
    tricky = ["The license of a public general work.", "free software", "MIT", "Apache helicopters of version 2.0",
              "permission is a word", "Creative people commons international"]
    assert licences.scan_texts(model, tricky) == []


@pytest.mark.parametrize("family", list(licences.TEMPLATES))
def test_every_template_is_found_in_its_family(model, family):
    for k, text in enumerate(licences.TEMPLATES[family]):
        noisy = text.replace(" ", "%%% ")
        for line in (text, text.upper(), f"thtion and of ea {noisy} onerth the in", f"// {text} (2020)"):
            found = licences.scan_texts(model, ["before\n\n" + line + "\nafter"])
            assert [(f[1], f[2]) for f in found] == [(2, family)], (k, line, found)
            assert 0.5 <= found[0][3] <= 1 and found[0][5] >= 0.8


WRAPPED = {
    "MIT": """Copyright (c) 2019 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
""",
    "GPL": """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * You should have received a copy of the GNU General Public License
 * along with this program.  If not, see <https://www.gnu.org/licenses/>.
 */""",
    "BSD": """Copyright (c) 2019, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
""",
}
STARTS = {"MIT": [2, 9], "GPL": [1, 6], "BSD": [3]}


@pytest.mark.parametrize("family", list(WRAPPED))
def test_wrapped_notices_are_read_as_one(model, family):
    for ends in ("\n", "\r\n"):
        found = licences.scan_texts(model, ["", WRAPPED[family].replace("\n", ends)])
        assert [(f[0], f[1], f[2]) for f in found] == [(1, k, family) for k in STARTS[family]]


def test_notices_in_a_long_line_are_found(model, background):
    rng = random.Random(5)
    for family, templates in licences.TEMPLATES.items():
        for template in templates:
            prose = [w for b in rng.choices(background, k=400) for w in b][:5000]
            at = rng.randrange(len(prose))
            prose[at:at] = template.split()
            found = licences.scan_texts(model, ["first line\n\n" + " ".join(prose)])
            assert [(f[1], f[2]) for f in found] == [(2, family)], (template, found)
    assert licences.scan_texts(model, [" ".join(prose[:at])]) == []


def test_two_notices_of_a_line_are_both_found(model):
    found = licences.scan_texts(model, ["Released under the MIT License. " + "Some other words stand here. " * 12
                                        + "Licensed under the Apache License, Version 2.0."])
    assert [(f[1], f[2]) for f in found] == [(0, "Apache-2.0"), (0, "MIT")]


def test_stretches_score_as_lines_do(model, background):
    rng, words = random.Random(6), "a line licensed under the mit license or under the gnu gpl version 2 and zzz".split()
    first = np.array([rng.randrange(10) for _ in range(30)])
    end = np.array([rng.randint(a + 1, len(words)) for a in first])
    want = model.probabilities([words[a:b] for a, b in zip(first, end, strict=True)])
    assert model.of_stretches(words, first, end) == pytest.approx(want)


def test_probabilities_equal_plain_sums(model, background):
    line = ["licensed", "under", "the", "mit", "license", "zzz", "the"]
    logits = model.bias.copy()
    for w in line:
        if w in model.words:
            logits += model.weights[model.words[w]]
    for a, b in zip(line, line[1:], strict=False):
        if a in model.words and b in model.words and (model.words[a], model.words[b]) in model.pairs:
            logits += model.weights[model.pairs[model.words[a], model.words[b]]]
    e = np.exp(logits / model.temperature)
    assert model.probabilities([["x"], line])[1] == pytest.approx(e / e.sum())


def test_planted_lines_of_the_tables(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = {(r.doc_id, r.family) for r in licences.find_licences(docs).collect()}
    signs = {"MIT": "mit license", "Apache-2.0": "apache license version 2 0", "GPL": "gnu general public license",
             "CC-BY-NC": "cc by nc 4 0"}
    want = set()
    for r in docs.collect():
        squeezed = " ".join(re.findall(r"[^\W_]+", (r.text or "").lower()))
        want |= {(r.doc_id, f) for f, s in signs.items() if s in squeezed}
    assert found == want and want


def test_awkward_rows_and_empty_table(spark, model):
    rows = AWKWARD + [(50, "x\r\nReleased under the MIT License.\r\n"), (None, "Licensed under the ISC License.")]
    got = {(r.doc_id, r.paragraph, r.family) for r in licences.scan(frame(spark, rows), model).collect()}
    assert got == {(50, 1, "MIT"), (None, 0, "ISC")}
    assert licences.find_licences(frame(spark, [])).count() == 0


def brute_scan(model, text):
    """Every stretch against its best family's templates, for a whole text at
    once: no pieces, no running sums."""
    words, line_of = [], []
    for k, line in enumerate(re.split("\r\n|\r|\n", text)):
        found = licences.words_of(line)
        words += found
        line_of += [k] * len(found)
    if not words:
        return []
    lines, paragraphs = {}, {}
    paragraph = 0
    for i, k in enumerate(line_of):
        if i and k - line_of[i - 1] > 1:
            paragraph += 1
        lines.setdefault(k, []).append(i)
        paragraphs.setdefault(paragraph, []).append(i)
    stretches = {(r[0], r[-1] + 1) for r in [*lines.values(), *paragraphs.values()]}
    for r in paragraphs.values():
        first, end = r[0], r[-1] + 1
        for size, step in licences.WINDOWS:
            stretches |= {(at, at + size) for at in [*range(first, end - size, step), end - size] if end - first > size}
    found = []
    for round_ in range(2):
        for first, end in sorted(stretches):
            p = model.probabilities([words[first:end]])[0]
            p[0] = 0
            best = int(p.argmax())
            if p[best] >= licences.MIN_PROBABILITY:
                notice = licences.notice_in(model.families[best], words[first:end])
                if notice:
                    size = len(licences._WORDS[model.families[best]][notice[1]])
                    found.append((notice[0], size, float(p[best]), first + notice[2], first + notice[3], model.families[best], notice[1]))
        stretches = {(f[3], f[4] + 1) for f in found}
    taken, kept = [], {}
    for alike, _, chance, start, stop, family, template in sorted(found, key=lambda f: (-f[0], -f[1], -f[2], f[3:])):
        if all(stop < a or b < start for a, b in taken):
            taken.append((start, stop))
            kept.setdefault((line_of[start], family), (chance, template, alike))
    return [(*k, *v) for k, v in sorted(kept.items())]


def same(got, want):
    assert [g[:2] + g[3:4] for g in got] == [w[:2] + w[3:4] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-6)


@pytest.mark.parametrize("seed", range(3))
def test_scan_equals_brute_force(model, background, seed):
    rng = random.Random(seed)
    notices = [n for f in licences.TEMPLATES.values() for n in f]
    parts = []
    for _ in range(40):
        parts.append(" ".join(rng.choice(background)))
        if rng.random() < 0.4:
            parts.append(rng.choice(notices))
        parts.append(rng.choice(["\n", "\n\n", " ", "\r\n"]))
    text = "".join(parts)
    want = brute_scan(model, text)
    assert want
    same(licences._scan_text(model, text), want)


def test_pieces_of_a_text_give_what_the_whole_gives(model, background, monkeypatch):
    rng = random.Random(5)
    notice = licences.TEMPLATES[list(licences.TEMPLATES)[0]][0]
    body = "\n\n".join(" ".join(rng.choice(background)) + "\n" + (notice if k % 5 == 0 else "") for k in range(60))
    whole = licences._scan_text(model, body)
    monkeypatch.setattr(licences, "PIECE_WORDS", 300)
    assert whole and licences._scan_text(model, body) == whole


def test_a_very_long_line_is_read_in_bounded_memory(model):
    import tracemalloc

    notice = licences.TEMPLATES[list(licences.TEMPLATES)[0]][0]
    text = " ".join(["some words without a licence in this line"] * 250_000 + [notice] + ["and more of it"] * 5000)   # 10 MB
    tracemalloc.start()
    found = licences._scan_text(model, text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f[1] for f in found] == [list(licences.TEMPLATES)[0]] and peak < 4 * len(text)
