"""Embedding whitening by incremental eigendecomposition.

Every partition keeps the eigendecomposition of the scatter of the vectors it
has seen about their running mean. A vector (with its number of copies in the
batch) is a centred rank-one update: in the basis of the eigenvectors the new
scatter is a diagonal plus one outer product, whose eigenvalues are the roots
of a secular equation. Entries of the update that are negligible, and all but
one entry of equal eigenvalues, are deflated first; the roots are found from
their nearest poles, and the eigenvectors come from an update recomputed to
fit the roots, so they stay orthogonal. Partitions' spectra are combined in
rounds, one spectrum added to another as rank-one updates, its eigenvectors
and the difference of the means. At last the covariance is projected on the
basis in one distributed pass over all vectors (Rayleigh-Ritz): the small
matrix's eigenvectors turn the basis into components that are right to double
precision, whatever the order and number of the partitions was.

Driver and tasks hold matrices of dimension x dimension, whatever the number
of rows; no vector reaches the driver.

Vectors are used as integers, ``floor(scale * c) + shift``, so counts, sums
and deviations are exact.

Defined results: rows whose vector is null, empty, or has a null or
non-finite entry, or one beyond 2 ** 40 in size, are left out; so are
vectors whose length isn't the commonest (ties: the longest). Repeated rows
count as often as they occur. Null ids are kept. Fewer dimensions than
``most`` give as many components; an eigenvalue that is zero to rounding has
no component, so equal vectors alone give no row, as does an empty table. A
deviation that doesn't fit 64 bits is null. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import written

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
LARGEST = float(2 ** 40)
# States that one task combines.
FAN_IN = 8
EPS = np.finfo(float).eps


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(weights / (poles - x)) = 0`` for ascending distinct
    poles and positive weights: one root right of each pole.

    Returns the pole each root is measured from and its distance to it, which
    keeps full precision next to a pole."""
    size = len(poles)
    width = weights.sum()
    rows = np.arange(size)
    right = np.append(poles[1:], poles[-1] + width)
    gap = right - poles
    # the sign in the middle tells which pole is nearer
    apart = poles[None, :] - poles[:, None]
    middle = 1 + (weights / (apart - gap[:, None] / 2)).sum(axis=1)
    from_right = middle < 0
    from_right[-1] = False
    origin = np.where(from_right, np.minimum(rows + 1, size - 1), rows)
    low = np.where(from_right, -gap / 2, 0.0)
    high = np.where(from_right, 0.0, np.where(rows == size - 1, gap, gap / 2))
    x = (low + high) / 2
    todo, lower = rows, (rows[None, :] <= rows[:, None]).astype(float)
    apart = poles[None, :] - poles[origin][:, None]
    left_pole = apart[rows, rows]
    right_pole = apart[rows, np.minimum(rows + 1, size - 1)]
    for _ in range(80):
        at = x[todo]
        inverse = 1 / (apart - at[:, None])
        left = inverse * lower
        total, below_value = inverse @ weights, left @ weights
        value = 1 + total
        # terms left of the root are negative, the others positive
        error = EPS * (1 + total - 2 * below_value) * 4
        low[todo] = np.where(value < 0, at, low[todo])
        high[todo] = np.where(value > 0, at, high[todo])
        going = (np.abs(value) > error) & (high[todo] - low[todo] > 2 * EPS * np.abs(at))
        if not going.any():
            break
        slope, below = (inverse * inverse) @ weights, (left * left) @ weights
        if not going.all():
            todo, at, value, slope, below, apart, lower = (v[going] for v in (todo, at, value, slope, below, apart, lower))
        above = slope - below
        # two poles, with weights that fit value and slope on either side
        d0, d1 = left_pole[todo] - at, right_pole[todo] - at
        last = todo == size - 1
        with np.errstate(all="ignore"):
            c = value - d0 * below - d1 * above
            a = (d0 + d1) * value - d0 * d1 * (below + above)
            b = d0 * d1 * value
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            flat = value - d0 * below
            step = np.where(last, d0 + d0 * d0 * below / flat, step)
            new = at + step
        inside = np.isfinite(new) & (new > low[todo]) & (new < high[todo])
        x[todo] = np.where(inside, new, (low[todo] + high[todo]) / 2)
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, update: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of
    ``vectors diag(values) vectors' + weight * update update'``, weight >= 0."""
    z = vectors.T @ update
    length = float(np.sqrt(z @ z))
    if not weight or not length:
        return values, vectors
    most = max(float(np.abs(values).max()), weight * length * length)
    small = 8 * EPS * most
    # deflation: entries too small to matter ...
    live = np.flatnonzero(weight * length * np.abs(z) > small)
    # ... and all but one of equal eigenvalues, by a rotation of the two
    gaps = np.diff(values[live])
    if len(live) > 1 and (gaps * np.abs(z[live][1:] * z[live][:-1]) <= small * (z[live][1:] ** 2 + z[live][:-1] ** 2)).any():
        vectors = vectors.copy()
        keep = []
        for i in live:
            if keep:
                j = keep[-1]
                norm = np.hypot(z[i], z[j])
                if (values[i] - values[j]) * abs(z[i] * z[j]) <= small * norm * norm:
                    c, s = z[i] / norm, z[j] / norm
                    first, second = vectors[:, j].copy(), vectors[:, i].copy()
                    vectors[:, j], vectors[:, i] = c * first - s * second, s * first + c * second
                    z[i], z[j] = norm, 0.0
                    keep[-1] = i
                    continue
            keep.append(i)
        live = np.array(keep)
    if not len(live):
        return values, vectors
    poles, entries = values[live], z[live]
    origin, distance = secular_roots(poles, weight * entries * entries)
    # root j minus pole i, exact next to the poles
    apart = (poles[origin][None, :] - poles[:, None]) + distance[None, :]
    # the update that has exactly these roots
    between = poles[None, :] - poles[:, None]
    np.fill_diagonal(between, 1.0)
    fitted = np.copysign(np.sqrt(np.abs(np.prod(apart / between, axis=1))), entries)
    turned = fitted[:, None] / apart
    turned /= np.sqrt(np.einsum("ij,ij->j", turned, turned))
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[live] = poles[origin] + distance
    new_vectors[:, live] = vectors[:, live] @ turned
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


class Spectrum:
    """Count, mean and eigendecomposition of the scatter of some vectors."""

    def __init__(self, size: int):
        self.n = 0
        self.mean = np.zeros(size)
        self.values = np.zeros(size)
        self.vectors = np.eye(size)

    def add(self, vector: np.ndarray, copies: int = 1) -> None:
        away = vector - self.mean
        total = self.n + copies
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n * copies / total)
        self.mean = self.mean + away * (copies / total)
        self.n = total

    def combine(self, other: "Spectrum") -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        for value, vector in zip(other.values[::-1], other.vectors.T[::-1], strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        away, total = other.mean - self.mean, self.n + other.n
        self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n * other.n / total)
        self.mean = self.mean + away * (other.n / total)
        self.n = total


_STATE = "n long, mean array<double>, vals array<double>, vecs array<double>"


def _state_batch(s: Spectrum) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([s.n], pa.int64())] + [pa.array([x.ravel().tolist()], pa.list_(pa.float64())) for x in (s.mean, s.values, s.vectors)],
        names=["n", "mean", "vals", "vecs"])


def _states(table: pa.Table, size: int):
    for n, mean, values, vectors in zip(*(table[c].to_pylist() for c in ("n", "mean", "vals", "vecs")), strict=True):
        s = Spectrum(size)
        s.n, s.mean, s.values = n, np.array(mean), np.array(values)
        s.vectors = np.array(vectors).reshape(size, size)
        yield s


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, int]:
    """``vec_id, c`` of the rows that count, and their dimension (0: none)."""
    c = F.col(column).cast("array<double>")
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > F.lit(LARGEST)))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), c.alias("c")).where(c.isNotNull() & (F.size(c) > 0) & ~bad)
    sizes = rows.groupBy(F.size("c").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes[0] if sizes else 0
    return rows.where(F.size("c") == size), size


def _integers(column: pa.Array, size: int, scale: int, shift: int) -> np.ndarray:
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.floor(c * scale).astype(np.int64) + shift


def _summed(partial: DataFrame, columns: list[str]) -> list:
    """Element sums over partial rows of equally long arrays, in rounds of
    ``FAN_IN`` rows a task; returns the one row's arrays (null: no rows)."""
    names = [c for c in columns]

    def add(table: pa.Table) -> pa.Table:
        out = [np.sum([np.array(v) for v in table[c].to_pylist()], axis=0).tolist() for c in names]
        return pa.table([pa.array([v], pa.list_(pa.float64())) for v in out], names=names)

    schema = ", ".join(f"{c} array<double>" for c in names)
    return _in_rounds(partial, add, schema, "whitening-sums")


def _in_rounds(partial: DataFrame, combine, schema: str, label: str):
    """One row from the rows of ``partial``: numbered, then combined in
    groups of ``FAN_IN`` until one is left. A round is written, so a lost
    executor costs that round."""
    numbered = written(partial.withColumn("part", F.spark_partition_id()), label)
    top = numbered.agg(F.max("part")).first()[0]
    while top:
        top //= FAN_IN
        grouped = numbered.withColumn("part", (F.col("part") / FAN_IN).cast("long"))

        def step(key, table):
            out = combine(table.drop_columns(["part"]))
            return out.append_column("part", pa.array([key[0].as_py()], pa.int64()))

        numbered = written(grouped.groupBy("part").applyInArrow(step, f"{schema}, part long"), label)
    rows = numbered.collect()                     # one row: matrices of the dimension
    return rows[0] if rows else None


def spectrum_of(rows: DataFrame, size: int, scale: int = SCALE, shift: int = SHIFT) -> Spectrum:
    """The incremental eigendecomposition over all partitions of ``rows``."""
    def update(batches):
        state = Spectrum(size)
        for batch in batches:
            if batch.num_rows:
                distinct, copies = np.unique(_integers(batch.column(0), size, scale, shift), axis=0, return_counts=True)
                for x, n in zip(distinct.astype(float), copies.tolist(), strict=True):
                    state.add(x, n)
        if state.n:
            yield _state_batch(state)

    def merge(table: pa.Table) -> pa.Table:
        first, *others = _states(table, size)
        for other in others:
            first.combine(other)
        return pa.Table.from_batches([_state_batch(first)])

    # one state a partition: several scan tasks' worth of rows each
    row = _in_rounds(rows.select("c").mapInArrow(update, _STATE), merge, _STATE, "spectra")
    if row is None:
        return Spectrum(size)
    return next(_states(pa.table({c: [row[c]] for c in ("n", "mean", "vals", "vecs")}), size))


def refined(rows: DataFrame, size: int, n: int, sums: list[int], basis: np.ndarray, most: int = COMPONENTS,
            scale: int = SCALE, shift: int = SHIFT) -> tuple[np.ndarray, np.ndarray, float]:
    """Rayleigh-Ritz: eigenvalues (falling) and unit eigenvectors (columns) of
    the covariance projected on ``basis`` in one pass over the vectors, and
    the covariance's trace."""
    basis, _ = np.linalg.qr(basis)

    def project(batches):
        total = np.zeros((size, size))
        seen = False
        for batch in batches:
            if batch.num_rows:
                seen = True
                y = _centred(_integers(batch.column(0), size, scale, shift), n, sums) @ basis
                total += y.T @ y
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["t"])

    row = _summed(rows.select("c").mapInArrow(project, "t array<double>"), ["t"])
    small = np.array(row["t"]).reshape(size, size) / n
    values, turned = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:most]
    vectors = basis @ turned[:, order]
    # either sign is right; the largest entry is made positive, for all rows
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[order], vectors * signs, float(np.trace(small))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, from exact integers rounded once."""
    return _scaled(x, n, sums).astype(float) / n


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: in 64 bits where they suffice."""
    if int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0) < 2 ** 62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """sum over dimensions of (n * x - S) ** 2, exact; null beyond 64 bits."""
    d = _scaled(x, n, sums)
    if d.dtype == object or float(np.abs(d).max(initial=0)) ** 2 * d.shape[1] >= 2 ** 62:
        d = d.astype(object)
        return pa.array([int(v) if v < 2 ** 63 else None for v in (d * d).sum(axis=1)], pa.int64())
    return pa.array((d * d).sum(axis=1), pa.int64())


def count_and_sums(rows: DataFrame, size: int, scale: int = SCALE, shift: int = SHIFT) -> tuple[int, list[int]]:
    """n and the exact sums of each dimension of the integer vectors."""
    def add(batches):
        for batch in batches:
            if batch.num_rows:
                x = _integers(batch.column(0), size, scale, shift)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)], pa.int64()), pa.array([x.sum(axis=0).tolist()], pa.list_(pa.int64()))], names=["m", "s"])

    partial = rows.select("c").mapInArrow(add, "m long, s array<long>").select("m", F.posexplode("s").alias("at", "v"))
    total = {r.at: (r.n, int(r.s)) for r in partial.groupBy("at").agg(
        F.sum("m").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()}        # one row a dimension
    return (total[0][0], [total[i][1] for i in range(size)]) if total else (0, [])


def _whiten(x: np.ndarray, n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (_centred(x, n, sums) @ vectors) / np.sqrt(values)


def whiten(vectors: DataFrame, most: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
           id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained,
    identity_error``: a row for each vector that counts and each component."""
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows, size = usable(vectors, id_column, column)
    n, sums = count_and_sums(rows, size, scale, shift) if size else (0, [])
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    basis = spectrum_of(rows, size, scale, shift).vectors
    values, components, trace = refined(rows, size, n, sums, basis, most, scale, shift)
    found = values > size * EPS * max(values[0], 0) * 4
    values, components = values[found], components[:, found]
    if not len(values) or trace <= 0:
        return vectors.sparkSession.createDataFrame([], schema)
    explained = (values / trace).tolist()
    count = len(values)

    def moments(batches):
        for batch in batches:
            if batch.num_rows:
                w = _whiten(_integers(batch.column(0), size, scale, shift), n, sums, components, values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v.ravel().tolist()], pa.list_(pa.float64())) for v in (w.T @ w, w.sum(axis=0))], names=["ww", "w"])

    sums_w = _summed(rows.select("c").mapInArrow(moments, "ww array<double>, w array<double>"), ["ww", "w"])
    mean = np.array(sums_w["w"]) / n
    error = float(np.abs(np.array(sums_w["ww"]).reshape(count, count) / n - np.outer(mean, mean) - np.eye(count)).max())

    def each(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _integers(batch.column(1), size, scale, shift)
            row = pa.array(np.repeat(np.arange(len(x)), count))
            w = _whiten(x, n, sums, components, values)
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column(0), row), pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                 pa.array(np.full(len(row), n)), pc.take(_deviation(x, n, sums), row), pa.array(w.ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(row), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(each, schema)
