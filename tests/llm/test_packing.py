"""Packing: token ids against the library, the plan against best-fit
decreasing done item by item, and whole results on small tables."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import AWKWARD, frame
from tokenizers import Tokenizer

from corvid.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def library():
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    return tok


def test_ids_equal_the_library_on_whole_texts(spark):
    rng, tok, own = random.Random(1), library(), packing.WordTokenizer(PATH)
    texts = [t for _, t in AWKWARD if t] + ["".join(chr(rng.randrange(1, 256)) for _ in range(200)) for _ in range(200)]
    texts += ["".join(rng.choice("ab'sSté12 .ΣÀ\n!") for _ in range(60)) for _ in range(300)]
    for text in texts:
        got = np.frombuffer(own.encode(text), dtype="<u4").tolist()
        assert got == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_added_tokens_are_read_as_the_library_does_by_default(spark):
    tok, own = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    texts = ["a <|endoftext|> b", "<|startoftext|>", "x<|endoftext|>y <|endoftext|><|startoftext|>", "a <|ENDOFTEXT|> b",
             "<|endoftext |> <| endoftext|>", "é <|endoftext|> Σ", "<|endoftext", "plain", "a\n<|endoftext|>\n b"]
    for text in texts + [t for _, t in AWKWARD if t]:
        got = np.frombuffer(own.encode(text), dtype="<u4").tolist()
        assert got == tok.encode(text, add_special_tokens=False).ids, repr(text)
    got = packing.pack_documents(frame(spark, list(enumerate(texts))), PATH).collect()
    assert {r.doc_id: r.length for r in got} == {
        i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def brute_best_fit(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= length]
        if fits:
            min(fits, key=lambda b: capacity - sum(b)).append(length)
        else:
            bins.append([length])
    return bins


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 50])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 200))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan, bins = packing.best_fit_plan(histogram, capacity), {}
    for length, count in histogram.items():
        for rank in range(count):
            sequence, offset = plan[length].place(length, rank)
            bins.setdefault(sequence, []).append((offset, length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    # sequences of equal remaining capacity are interchangeable, so the fill
    # of the sequences is what best-fit decreasing determines
    want = sorted(sum(b) for b in brute_best_fit(lengths, capacity))
    assert sorted(sum(n for _, n in b) for b in bins.values()) == want


def test_tree_finds_the_tightest():
    rng, tree, marked = random.Random(3), packing.CapacityTree(100), set()
    for _ in range(500):
        c = rng.randint(0, 100)
        present = rng.random() < 0.5
        tree.set(c, present)
        (marked.add if present else marked.discard)(c)
        length = rng.randint(0, 100)
        assert tree.tightest(length) == min((m for m in marked if m >= length), default=None)


def test_documents_are_cut_and_placed_whole(spark):
    rows, tok = AWKWARD + [(20 + i, "hello world " * i) for i in range(40)], library()
    packed = packing.pack_documents(frame(spark, rows), PATH, capacity=64, keep_ids=True)
    got = packed.collect()
    want = []
    for doc_id, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = ids[at:at + 64]
            want.append((doc_id, piece, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) == len(brute_best_fit([w[3] for w in want], 64))
    whole = {r.sequence_id: r.token_ids for r in packing.sequences(packed).collect()}
    for r in got:
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == r.token_ids


def test_empty_table(spark):
    assert packing.pack_documents(frame(spark, []), PATH).count() == 0
