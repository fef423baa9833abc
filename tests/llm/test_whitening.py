import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.llm import queries, whitening


def scatter(x):
    y = x - x.mean(axis=0)
    return y.T @ y


def test_rank_one_updates_meet_a_full_decomposition():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 40):
        for kind in range(4):
            a = rng.normal(size=(size, size))
            a = a @ a.T
            if kind == 1:
                a = np.eye(size) * 2.0                                   # all eigenvalues equal
            if kind == 2:
                a = np.zeros((size, size))
            values, vectors = np.linalg.eigh(a)
            update = rng.normal(size=size)
            if kind == 3:
                update = vectors[:, 0] * 3                                # all but one entry is zero
            new_values, new_vectors = whitening.rank_one(values, vectors, update, 0.7)
            whole = a + 0.7 * np.outer(update, update)
            scale = max(1.0, np.abs(whole).max())
            assert np.abs(new_vectors @ np.diag(new_values) @ new_vectors.T - whole).max() < 1e-12 * scale * size
            assert np.abs(new_vectors.T @ new_vectors - np.eye(size)).max() < 1e-12
            assert np.all(np.diff(new_values) >= 0)


def test_close_poles():
    values = np.array([1.0, 1.0 + 1e-15, 1.0 + 1e-9, 2.0, 2.0])
    update = np.array([1.0, 1e-20, 1.0, 1e-9, 1.0])
    new_values, new_vectors = whitening.rank_one(values, np.eye(5), update, 1.0)
    whole = np.diag(values) + np.outer(update, update)
    assert np.abs(new_vectors @ np.diag(new_values) @ new_vectors.T - whole).max() < 1e-13
    assert np.abs(new_vectors.T @ new_vectors - np.eye(5)).max() < 1e-13


def test_spectra_of_parts_combine():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(300, 12)) * 100 * np.arange(1, 13))
    x[50:90] = x[0]
    parts = []
    for rows in (x[:7], x[7:8], x[8:200], x[200:]):
        s = whitening.Spectrum(12)
        for row, n in zip(*np.unique(rows, axis=0, return_counts=True), strict=True):
            s.add(row, int(n))
        parts.append(s)
    for other in parts[1:]:
        parts[0].combine(other)
    s = parts[0]
    assert s.n == 300 and np.allclose(s.mean, x.mean(axis=0), rtol=1e-12)
    whole = scatter(x)
    assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - whole).max() < 1e-10 * np.abs(whole).max()
    assert np.abs(s.vectors.T @ s.vectors - np.eye(12)).max() < 1e-9


def _key(vec_id):
    return -1 if vec_id is None else vec_id


def plain(rows, most=8):
    kept = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v in rows
            if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    n, size = len(kept), len(kept[0][1])
    sums = [sum(v[k] for _, v in kept) for k in range(size)]
    scaled = np.array([[n * a - s for a, s in zip(v, sums, strict=True)] for _, v in kept], dtype=object)
    y = scaled.astype(float) / n
    covariance = y.T @ y / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:most]
    white = y @ vectors[:, order] / np.sqrt(values[order])
    out = {}
    for (i, _), d, w in zip(kept, scaled, white, strict=True):
        for k, value in enumerate(w):
            deviation = int(sum(a * a for a in d))
            out.setdefault((_key(i), k + 1), []).append(
                (n, deviation if deviation < 2 ** 63 else 0, abs(value), values[order][k] / np.trace(covariance)))
    return out


def compare(found, rows, most=8):
    expected = plain(rows, most)
    got = {}
    for r in found:
        got.setdefault((_key(r.vec_id), r.component), []).append((r.n, r.deviation or 0, abs(r.whitened), r.explained))
        assert r.identity_error < 1e-9
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        for a, b in zip(sorted(got[key]), sorted(values), strict=True):
            assert a[:2] == b[:2]
            assert a[2:] == pytest.approx(b[2:], rel=1e-7, abs=1e-7)
    return got


def test_whole_table_meets_a_plain_version(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = queries.op12_embedding_whitening(spark, sf_dir).collect()
    compare(found, rows)
    signs = {}
    for r in found:                                     # whitened components have unit variance and no correlation
        signs.setdefault(r.component, []).append((r.vec_id, r.whitened))
    w = np.array([[v for _, v in sorted(signs[k])] for k in sorted(signs)])
    assert np.abs(w @ w.T / w.shape[1] - np.eye(len(w))).max() < 1e-9


def test_same_result_for_any_partitions(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(rng.normal(size=(120, 5)) * [3, 1, .5, .2, .1])]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]                     # a common vector
    results = []
    for parts in (1, 3, 9):
        docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)
        found = whitening.whiten(docs).collect()
        compare(found, rows)
        results.append({(r.vec_id, r.component): r.whitened for r in found})
    for other in results[1:]:
        assert all(abs(results[0][k] - other[k]) < 1e-8 for k in results[0])


def test_awkward_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(a) for a in v]) for i, v in enumerate(rng.normal(size=(30, 3)))]
    good += [good[0], (None, good[1][1]), (5, [50.0, -50.0, 3.0])]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]), (54, [float("inf"), 0.0, 0.0]),
           (55, [1.0, 2.0]), (56, [1e300, 0.0, 0.0])]
    schema = "vec_id long, embedding array<double>, n int, c string, part int"
    docs = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in good + bad], schema)
    compare(whitening.whiten(docs).collect(), good)
    assert whitening.whiten(docs.where("false")).collect() == []
    far = whitening.whiten(docs.unionByName(docs.limit(1).select(
        F.lit(99).alias("vec_id"), F.lit([1e6, -1e6, 3.0]).alias("embedding"), "n", "c", "part"))).collect()
    assert {r.deviation is None for r in far if r.vec_id == 99} == {True} and far[0].identity_error < 1e-4
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(same).columns == whitening.whiten(docs).columns
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<double>")
    one = whitening.whiten(line).collect()
    assert {r.component for r in one} == {1} and len(one) == 9 and abs(one[0].explained - 1) < 1e-9


def test_deviation_stays_exact_beyond_64_bit_products():
    x = np.array([[2 ** 40, 0], [0, 3]], dtype=np.int64)
    assert whitening._scaled(x, 2 ** 30, [5, 7]).tolist() == [[2 ** 70 - 5, -7], [-5, 3 * 2 ** 30 - 7]]
    assert whitening._deviation(x[1:], 10, [4, 6]).to_pylist() == [16 + 24 * 24]
    assert whitening._deviation(x, 2 ** 29, [5, 7]).to_pylist() == [None, 25 + (3 * 2 ** 29 - 7) ** 2]
