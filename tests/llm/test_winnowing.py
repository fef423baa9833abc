"""Winnowing against a plain version, with Spark's hash of words and grams."""

import hashlib
import random
import struct

import pytest
from helpers import AWKWARD, frame, words
from xxhash import xxh64_intdigest

from corvid.llm import winnowing
from corvid.llm.winnowing import GRAM, WINDOW


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_marks(text, gram=GRAM, window=WINDOW):
    hashes = [xxh64_intdigest(w.encode(), 42) for w in words(text)]
    grams = []
    for i in range(max(1, len(hashes) - gram + 1) if hashes else 0):
        h = 42
        for x in hashes[i:i + gram]:
            h = xxh64_intdigest(struct.pack("<q", signed(x)), h)
        grams.append(h >> 29)
    marks = []
    for i in range(max(1, len(grams) - window + 1) if grams else 0):
        part = grams[i:i + window]
        at = max(j for j, g in enumerate(part) if g == min(part))
        if (min(part), i + at) not in marks:
            marks.append((min(part), i + at))
    return marks


def shown(marks):
    return " ".join(f"{h:x}@{p}" for h, p in marks)


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    out = []
    for (d, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        t, n = t or "", n or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        m, e = brute_marks(t), brute_marks(edited)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), shown(m), shown(e),
                    alike(m, e), alike(m, brute_marks(n))))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["a", "b", "ü", "日本", "word", "x𝒳y"]
    rows = [(rng.randrange(10**6), " ".join(rng.choices(vocab, k=rng.randint(0, 90)))) for _ in range(60)]
    return rows + [(r[0], r[1]) for r in rows[:5]] + AWKWARD + [(10**15, "far away id " * 9), (-5, "negative")]


@pytest.mark.parametrize("seed,block_bytes", [(1, 1 << 30), (2, 900), (3, 60)])
def test_equals_brute_force(spark, seed, block_bytes):
    rows = corpus(seed)
    got = winnowing.edited_pairs(frame(spark, rows), block_bytes=block_bytes).collect()
    want = brute(rows)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_shared_words_are_found(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(500)]
    shared = rng.choices(vocab, k=WINDOW + GRAM - 1)
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 80)) + shared + rng.choices(vocab, k=50))) for i in range(20)]
    found = {}
    for r in winnowing.matches(frame(spark, rows)).collect():
        found.setdefault(r.doc_id, set()).add(r.hash)
    assert set.intersection(*found.values())


def test_single_row_is_its_own_next_and_empty_table(spark):
    got = winnowing.edited_pairs(frame(spark, [(1, "only one")])).first()
    assert got.near_next == 1.0
    assert winnowing.edited_pairs(frame(spark, [])).count() == 0


def test_no_python_on_the_path(spark):
    plan = winnowing.edited_pairs(frame(spark, [(1, "a"), (2, "b")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
