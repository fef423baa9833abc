"""PPM: scores against a trie held in memory; the word model by counting."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, frame, lower_ascii, words

from corvid.llm import ppm


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows, order):
    trie, counts = ppm.Trie(order), Counter()
    for d, t in rows:
        if not held(d):
            for context, byte in trie.steps(t or ""):
                trie.learn(context, byte)
            counts.update(words(lower_ascii(t or "")))
            counts[None] += 1
    n, v, out = sum(counts.values()), len(counts), []
    for d, t in rows:
        tokens = [*words(lower_ascii(t or "")), None]
        out.append((d, held(d), len(tokens), sum(counts[w] > 0 for w in tokens), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens),
                    sum(trie.log10p(c, b) for c, b in trie.steps(t or ""))))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "Tion", "ing", "é", "ß", "x", "y1", "Zz"]
    rows = [(i, " ".join("".join(rng.choices(vocab, k=rng.randint(1, 3))) for _ in range(rng.randint(0, 60))))
            for i in range(60)]
    return rows + [(100 + i, chr(300 + i) * 5 + "~|{}"[i % 4]) for i in range(12)] + AWKWARD


@pytest.mark.parametrize("seed,block_bytes,order", [(1, 1 << 30, 4), (2, 1500, 4), (3, 400, 2)])
def test_equals_brute_force(spark, seed, block_bytes, order):
    rows = corpus(seed)
    got = ppm.score_documents(frame(spark, rows), ppm.held_out_fold(), order, block_bytes).collect()
    want = brute(rows, order)
    key = lambda r: (str(r[0]), r[2], round(r[6], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    assert any(r[1] for r in got)


def test_probabilities_of_a_context_add_up():
    trie = ppm.Trie(3)
    for context, byte in trie.steps("abracadabra abracadabra"):
        trie.learn(context, byte)
    for context in (b"abr", b"zzz", b"\0\0a", b"a a"):
        assert sum(10 ** trie.log10p(context, b) for b in range(256)) == pytest.approx(1)


def test_adaptive_codes_repeats_in_fewer_bits(spark):
    rows = [(0, "abcdefgh" * 40), (1, "".join(chr(33 + (i * 7919 + i * i) % 90) for i in range(320))), (2, None)]
    got = {r.doc_id: r for r in ppm.adaptive_code_length(frame(spark, rows)).collect()}
    assert got[0].code_bits < got[1].code_bits / 3
    assert got[2].n_bytes == 0 and got[2].code_bits == pytest.approx(8)


def test_lookup_finds_every_key():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**40, 5000, dtype=np.uint64))
    asked = rng.choice(keys, 20000)
    assert (keys[ppm.Lookup(keys).find(asked)] == asked).all()


def test_empty_table(spark):
    assert ppm.score_documents(frame(spark, []), ppm.held_out_fold()).count() == 0
