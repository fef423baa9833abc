"""SimHash: fingerprints from Spark's own XXH64, groups against all pairs."""

import random

import numpy as np
import pytest
from helpers import AWKWARD, frame, lower_ascii, words
from pyspark.sql import functions as F

from corvid.llm import simhash


def brute_groups(fps):
    """component ids by comparing all pairs; fps: (doc_id, fp)."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 3:
                parent[find(i)] = find(j)
    smallest = {}
    for i, (doc, _) in enumerate(fps):
        if doc is not None:
            smallest[find(i)] = min(doc, smallest.get(find(i), doc))
    return [(doc, smallest.get(find(i))) for i, (doc, _) in enumerate(fps)]


def spark_fingerprint(spark, text):
    ws = words(lower_ascii(text or ""))
    shingles = [" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    if not shingles:
        return 0
    rows = spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s").alias("h")).collect()
    hs = [r.h % (1 << 64) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints_and_groups(spark):
    rng = random.Random(5)
    base = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(300)]
    rows = list(AWKWARD)
    for i in range(30):
        edited = list(base)
        for _ in range(i % 4):
            edited[rng.randrange(300)] = "changed"
        rows.append((100 + i, " ".join(edited)))
    got = simhash.near_duplicate_groups(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = [(d, spark_fingerprint(spark, t)) for d, t in rows]
    text_of = sorted((str(d), f"{fp:016x}") for d, fp in want)
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == text_of
    comps = sorted((str(d), c) for d, c in brute_groups(want))
    assert sorted((str(r.doc_id), r.component_id) for r in got) == comps


@pytest.mark.parametrize("seed", range(4))
def test_links_meet_all_pairs(spark, seed, monkeypatch):
    """Clusters around random words, with a part size that forces splitting."""
    monkeypatch.setattr(simhash, "PART", 40)
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 200)
    rng = random.Random(seed)
    fps = set()
    for _ in range(8):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 20, 150])):
            word = centre
            for _ in range(rng.randint(0, 6)):
                word ^= 1 << rng.randrange(64)
            fps.add(word)
    fps = [(i, f) for i, f in enumerate(sorted(fps))]
    signed = [(int(np.uint64(f).view(np.int64)),) for _, f in fps]
    words_table = spark.createDataFrame(signed, "fp long")
    from corvid.llm.components import star_components

    stars = {r.node: r.root for r in star_components(simhash.links(words_table)).collect()}
    label = [stars.get(s[0], s[0]) for s in signed]
    comps = dict(brute_groups(fps))
    groups = {}
    for (i, _), name in zip(fps, label, strict=True):
        groups.setdefault(name, set()).add(i)
    want = {}
    for i, c in comps.items():
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_index_search_equals_brute_force():
    rng = np.random.default_rng(0)
    centre = rng.integers(0, 2**63, 5, dtype=np.uint64)
    members = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64))
                                        ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)) for c in centre]))
    q, m = simhash.GrayIndex(members).within(members, 3)
    apart = np.bitwise_count(members[:, None] ^ members[None, :]) <= 3
    assert sorted(zip(q.tolist(), m.tolist(), strict=True)) == sorted(map(tuple, np.argwhere(apart).tolist()))


def test_index_of_a_bucket_prunes_and_loses_nothing():
    rng = np.random.default_rng(1)
    members = np.unique(rng.integers(0, 2**64, 6000, dtype=np.uint64))
    near = members[:300] ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
    members = np.unique(np.concatenate([members, near]))
    for mask in simhash.block_masks(len(members)):
        sought = simhash.key_first(members, mask)
        assert len(np.unique(sought)) == len(members)
        top = np.uint64(bin(mask).count("1"))
        assert ((sought >> (np.uint64(64) - top)) == (simhash.key_first(members & np.uint64(mask), mask) >> (np.uint64(64) - top))).all()
        index = simhash.GrayIndex(sought)
        found = set()
        for at in range(0, len(members), 256):
            q, m = index.within(sought[at:at + 256], 3)
            found |= {(i + at, j) for i, j in zip(q.tolist(), m.tolist(), strict=True) if i + at != j}
        assert index.pruned > index.visited / 2
        want = {(i, j) for i in range(len(members)) for j in np.flatnonzero(np.bitwise_count(members ^ members[i]) <= 3).tolist() if i != j}
        assert found == want and len(want) >= 600


def test_masks_cover_every_pair_within_reach():
    rng = random.Random(2)
    for count in (10, 10**7, 10**10):
        masks = simhash.block_masks(count)
        for _ in range(300):
            flips = 0
            for _ in range(3):
                flips |= 1 << rng.randrange(64)
            assert any(flips & m == 0 for m in masks)


def test_one_document_of_each_group_stays(spark):
    rows = list(AWKWARD)
    kept = simhash.drop_near_duplicates(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    groups = simhash.near_duplicate_groups(frame(spark, rows)).collect()
    want = sorted(str(c) for c in {g.component_id for g in groups})
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    """Null and repeated ids: a group keeps one row, and no clean row goes
    because a dropped copy has the same id."""
    text = "one two three four five six seven eight nine ten"
    rows = [(None, text + " a"), (None, text + " a"), (1, "x y z"), (1, "x y z"), (1, "another text of some words here"),
            (7, "copied text that stands twice in the table"), (8, "copied text that stands twice in the table"),
            (8, "a clean text under the id of a copy")]
    docs = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], "doc_id long, text string, `a.b` int, row_number int, fp int")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = [rows[0], rows[2], rows[4], rows[5], rows[7]]
    assert sorted(repr((r.doc_id, r.text)) for r in kept.collect()) == sorted(map(repr, want))


def test_empty_table(spark):
    assert simhash.near_duplicate_groups(frame(spark, [])).count() == 0
    assert simhash.drop_near_duplicates(frame(spark, [])).count() == 0
