"""Substring de-duplication against windows compared one by one."""

import hashlib
import random

import pytest
from helpers import AWKWARD, frame, words

from corvid.llm import substring

NULL = substring.NULL_ID


def brute(rows, window):
    order = sorted(range(len(rows)), key=lambda i: (NULL if rows[i][0] is None else rows[i][0], rows[i][1] is not None, rows[i][1] or ""))
    seen, out = set(), [None] * len(rows)
    for i in order:
        ws = words(rows[i][1])
        gone = [False] * len(ws)
        for s in range(len(ws) - window + 1):
            part = tuple(ws[s:s + window])
            if part in seen:
                gone[s:s + window] = [True] * window
            seen.add(part)
        kept = [w for w, g in zip(ws, gone, strict=True) if not g]
        out[i] = (rows[i][0], len(ws), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return sorted(out, key=str)


def corpus(seed, docs=60, vocabulary=40):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)] + ["é", "ÀB", "x" * 40]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(10, 70))] for _ in range(8)]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                cut = rng.randint(0, len(p) // 2)
                parts += p[cut:] if rng.random() < 0.5 else p
            else:
                parts += [rng.choice(vocab) for _ in range(rng.randint(1, 40))]
        rows.append((i * 3 % docs, rng.choice([" ", "\n", "\t "]).join(parts)))
    for _ in range(10):
        rows.append((1000 + rng.randrange(5), rng.choice(rows)[1]))
    return rows + AWKWARD + [(None, " ".join(passages[0])), (None, " ".join(passages[0] + passages[1]))]


@pytest.mark.parametrize("seed,block_bytes", [(1, 1 << 30), (2, 2000), (3, 700), (4, 300)])
def test_equals_brute_force(spark, seed, block_bytes):
    rows = corpus(seed)
    got = substring.kept_digest(substring.remove_repeats(frame(spark, rows), block_bytes=block_bytes)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 20)


def test_small_window_and_periodic_texts(spark, monkeypatch):
    rows = [(i, "a b " * (i % 7) + "a a a a a a a a a b b " * (i % 3)) for i in range(40)]
    got = substring.kept_digest(substring.remove_repeats(frame(spark, rows), window=5, gram=2)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 5)


def test_empty_table(spark):
    assert substring.remove_repeats(frame(spark, [])).count() == 0


def test_cut_documents_keeps_columns_and_untouched_texts(spark):
    rows = corpus(5)
    docs = frame(spark, rows).withColumn("n_chars", substring.F.char_length("text").cast("long"))
    got = substring.cut_documents(docs)
    assert got.columns == docs.columns
    cut = {(d, n, removed) for d, n, removed, _ in brute(rows, 20)}
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(t)
    seen = got.collect()
    for r in seen:
        assert r.source == "src" and r.value == "x" and r.n_chars == (None if r.text is None else len(r.text))
        assert r.text in texts[r.doc_id] or any(d == r.doc_id and k for d, _, k in cut)
    emptied = sum(n == removed > 0 for _, n, removed, _ in brute(rows, 20))
    assert len(seen) == len(rows) - emptied
