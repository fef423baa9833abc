"""Decontamination: the index against exhaustive BM25, and whole results
against a plain version that scores every passage and item."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, frame

from corvid.llm import decontaminate as dc
from corvid.session import table


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "item_id long, text string, doc_id long, score string")


def brute_short_leaks(docs, items, least_words=1):
    """Every short item against every place of every text."""
    short = [(i, dc.words_of(t)) for i, t in items if 0 < len(dc.words_of(t)) < dc.MIN_ITEM_WORDS]
    out = set()
    for d, text in docs:
        words = dc.words_of(text)
        for i, w in short:
            if len(w) >= least_words and any(words[k:k + len(w)] == w for k in range(len(words))):
                out.add((d, i))
    return out


def brute_leaks(docs, items, least_words=1):
    """Every passage against every segment, without index or bounds, and
    every short item (of ``least_words`` at least)."""
    kept = [(i, t) for i, t in items if t and len(dc.words_of(t)) >= dc.MIN_ITEM_WORDS]
    segments = [(n, s) for n, (_, t) in enumerate(kept) for s in dc._segments(dc.words_of(t))]
    df = Counter(w for _, s in segments for w in set(s))
    mean = sum(len(s) for _, s in segments) / max(1, len(segments))
    weights = []
    for _, s in segments:
        norm = dc.K1 * (1 - dc.B + dc.B * len(s) / mean)
        weights.append({w: math.log(1 + (len(segments) - df[w] + 0.5) / (df[w] + 0.5)) * n * (dc.K1 + 1) / (n + norm)
                        for w, n in Counter(s).items()})
    out = brute_short_leaks(docs, items, least_words)
    for d, text in docs:
        words = dc.words_of(text)
        for first in range(0, len(words), dc.SPAN):
            passage = set(words[first:first + 2 * dc.SPAN])
            for (n, _), w in zip(segments, weights, strict=True):
                if sum(x for t, x in w.items() if t in passage) / sum(w.values()) >= dc.MIN_SCORE - 1e-9:
                    q, a = dc.question_and_answer(kept[n][1])
                    around = words[max(0, first - len(q) - len(a)):first + 2 * dc.SPAN + len(q) + len(a)]
                    if dc.overlap(q, around) >= dc.MIN_OVERLAP and dc.overlap(a, around) >= dc.MIN_OVERLAP:
                        out.add((d, kept[n][0]))
    return out


def corpus(seed, many=30):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(400)]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(n)]

    def sentences(n):
        words = prose(n)
        for i in range(7, n, 9):
            words[i] += rng.choice([".", "?", "\n", ". "])
        return " ".join(words)

    items = [(i, sentences(rng.randint(6, 60))) for i in range(many)]
    items += [(100, sentences(200)), (101, None), (102, ""), (103, "c1 c2"), (104, items[0][1]), (None, items[1][1])]
    docs = []
    for d in range(60):
        parts = prose(rng.randint(0, 200))
        for _ in range(rng.randint(0, 2)):
            words = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 5, 12])):
                if words:
                    words[rng.randrange(len(words))] = "changed"
            at = rng.randint(0, len(parts))
            parts[at:at] = [w.upper() + rng.choice(["", "%%%", "!!"]) for w in words]
        docs.append((d, " ".join(parts)))
    return docs + AWKWARD, items


@pytest.mark.parametrize("seed,shard", [(1, 20_000), (2, 20_000), (3, 9)])
def test_equals_brute_force(spark, seed, shard, monkeypatch):
    monkeypatch.setattr(dc, "SHARD_ITEMS", shard)
    docs, items = corpus(seed)
    got = dc.find_all_leaks(frame(spark, docs), items_frame(spark, items)).collect()
    want = brute_leaks(docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == want and want
    assert all(dc.MIN_OVERLAP <= min(r.question_overlap, r.answer_overlap) and r.score >= dc.MIN_SCORE - 1e-9 for r in got)


@pytest.mark.parametrize("seed", range(5))
def test_wand_and_bounds_lose_nothing(seed):
    rng = random.Random(seed)
    vocab = [f"w{min(int(rng.expovariate(0.05)), 150)}" for _ in range(300)]
    segments = [(i, [rng.choice(vocab) for _ in range(rng.randint(3, 30))]) for i in range(90)]
    df = Counter(w for _, s in segments for w in set(s))
    idf = {w: math.log(1 + (90 - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    index = dc.Index([dc.Item(i, s, []) for i, s in segments], segments, idf, 16)
    spans = []
    for _ in range(200):
        spans.append(sorted({index.terms[w] for w in rng.choices(list(index.terms), k=rng.randint(0, 25))}
                            | {index.terms[w] for w in rng.choice(segments)[1] if rng.random() < 0.4}))
    joined = np.array([rng.random() < 0.7 for _ in spans[:-1]] + [False])
    pairs = sorted((i, t) for i, s in enumerate(spans) for t in s)
    span, term = (np.array(x) for x in zip(*pairs, strict=True))
    for least in (0.35, 0.45, 0.6, 0.9):
        hopeful = set(index.hopeful(span, term, joined, least).tolist())
        for i, s in enumerate(spans):
            terms = sorted({*s, *(spans[i + 1] if joined[i] else [])})
            scores = np.zeros(len(segments))
            for t in terms:
                scores[index.lists[t]] += index.impacts[t]
            want = {j: s for j, s in enumerate(scores.tolist()) if s >= least - 1e-9}
            got = index.above(terms, least)
            assert got.keys() == want.keys()
            assert all(got[j] == pytest.approx(want[j]) for j in got)
            assert not want or i in hopeful


def test_planted_items_of_the_tables_are_found(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows, tests = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    squeezed = {d: " ".join(dc.words_of(t)) for d, t in rows}
    planted = {(d, i) for d, t in squeezed.items() for i, x in tests if " ".join(dc.words_of(x)) in t}
    got = {(r.doc_id, r.item_id) for r in dc.find_all_leaks(docs, items).collect()}
    assert planted <= got and got == brute_leaks(rows, tests)
    kept = {r.doc_id for r in dc.drop_leaked(docs, items).select("doc_id").collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in got}


def test_empty_tables(spark):
    docs, items = corpus(1)
    assert dc.find_all_leaks(frame(spark, []), items_frame(spark, items)).count() == 0
    assert dc.find_all_leaks(frame(spark, docs), items_frame(spark, [])).count() == 0
    assert dc.drop_leaked(frame(spark, docs), items_frame(spark, [])).count() == len(docs)


def test_short_and_unspaced_items_are_found(spark):
    items = [(1, "Capital of Peru? Lima"), (2, "red fox"), (3, "日本の首都はどこですか。東京です。"), (4, "水の化学式"),
             (5, "red fox"), (6, None), (7, "?!"), (8, "เมืองหลวงของประเทศไทยคือกรุงเทพมหานคร")]
    docs = [(1, "He asked: capital of Peru, Lima!"), (2, "a RED-fox ran, the red fox"), (3, "red foxes and a fox, red"),
            (4, "これは問題です日本の首都はどこですか東京ですという文"), (5, "質問は水の化学式です"), (6, "水と化学の式"),
            (7, None), (None, "red fox"), (8, "ถามว่าเมืองหลวงของประเทศไทยคือกรุงเทพมหานครใช่ไหม"), (9, "日本の東京は大きい")]
    got = dc.find_all_leaks(frame(spark, docs), items_frame(spark, items)).collect()
    assert sorted(((r.doc_id or 0, r.item_id) for r in got)) == [
        (0, 2), (0, 5), (1, 1), (2, 2), (2, 5), (4, 3), (5, 4), (8, 8)]
    kept = {r.doc_id for r in dc.drop_leaked(frame(spark, docs), items_frame(spark, items)).collect()}
    assert kept == {3, 6, 7, 9}


def test_dropping_keeps_clean_rows_of_any_id_and_column(spark):
    """Null and repeated ids go by their own text; names with dots and names
    that the operator might use come back as they were; one-word items drop nothing."""
    items = [(1, "Capital of Peru? Lima"), (2, "yes"), (3, "red fox")]
    rows = [(8, "a copy of a text", 1, 2, 3), (8, "the capital of Peru is Lima", 1, 2, 3), (None, "yes it is", 1, 2, 3),
            (None, "capital of Peru Lima", 1, 2, 3), (9, None, 1, 2, 3), (8, "a red fox", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, _leak_key int, holds_item int")
    kept = dc.drop_leaked(docs, items_frame(spark, items))
    assert kept.columns == docs.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, [rows[0], rows[1], rows[2], rows[4]]))
