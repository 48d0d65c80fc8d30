"""Whitening of embeddings by the leading components of their covariance.

1. Every entry becomes the whole number floor(scale * c), so that means and deviations are exact. The fit list holds each distinct vector
   once; it is a table in the shared folder.
2. A first pass sums counts and entries exactly, a second one multiplies centred vectors: each task adds up one matrix, and the matrices
   are added row by row, one group for each row of the covariance.
3. One task per vector length takes the d x d covariance apart: Householder reflections make it tridiagonal, bisection on Sturm counts finds
   the leading eigenvalues, inverse iteration their vectors, made orthogonal anew within clusters; the reflections lead back.
4. The means and components (d * (k + 1) numbers for each vector length) are broadcast, and every row is projected on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.frames import share
from tidemark.scratch import materialize

#: Whole steps per unit of an entry.
SCALE = 256
COMPONENTS = 4
#: Vectors that a task multiplies at once.
BLOCK = 4096
#: Eigenvalues nearer to each other than this share of the largest form a cluster.
CLUSTER = 1e-3


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, side diagonal and the unit vectors of the Householder reflections that lead there from a symmetric matrix."""
    a = np.array(matrix, np.float64)
    d = len(a)
    mirrors = []
    for k in range(d - 2):
        column = a[k + 1 :, k]
        v = column.copy()
        v[0] += np.copysign(np.linalg.norm(column), column[0])
        length = np.linalg.norm(v)
        v = v / length if length else v
        mirrors.append(v)
        if length:
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            side = column - 2 * v * (v @ column)
            a[k + 1 :, k] = a[k, k + 1 :] = side
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def lift(mirrors: list[np.ndarray], vector: np.ndarray) -> np.ndarray:
    """A vector of the tridiagonal matrix as one of the matrix it came from."""
    out = vector.copy()
    for v in reversed(mirrors):
        tail = out[len(out) - len(v) :]
        tail -= 2 * v * (v @ tail)
    return out


def below(diagonal: np.ndarray, side: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each number."""
    tiny = np.finfo(np.float64).tiny
    squares = np.concatenate([[0.0], side * side])
    q, count = np.ones(len(at)), np.zeros(len(at), np.int64)
    for alpha, beta in zip(diagonal.tolist(), squares.tolist(), strict=True):
        q = alpha - at - beta / q
        q[np.abs(q) < tiny] = -tiny
        count += q < 0
    return count


def leading(diagonal: np.ndarray, side: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each halved in until its ends are neighbours in double precision."""
    d = len(diagonal)
    if not k:
        return np.zeros(0)
    edge = np.abs(np.concatenate([[0.0], side])) + np.abs(np.concatenate([side, [0.0]]))
    spread = np.abs(diagonal).max() + edge.max()
    low = np.full(k, (diagonal - edge).min() - 1e-15 * spread)
    high = np.full(k, (diagonal + edge).max() + 1e-15 * spread)
    rank = d - 1 - np.arange(k)  # so many lie below the wanted one
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        many = below(diagonal, side, middle) > rank
        high, low = np.where(many, middle, high), np.where(many, low, middle)


def _solve(diagonal: np.ndarray, side: np.ndarray, value: float, right: np.ndarray, least: float) -> np.ndarray:
    """x with (T - value) x = right, by elimination with row exchanges; pivots of nothing become `least`."""
    d = len(diagonal)
    main, upper, second = (diagonal - value).tolist(), [*side.tolist(), 0.0], [0.0] * d
    b = right.tolist()
    for i in range(d - 1):
        lower, nxt = side[i], main[i + 1]
        after = upper[i + 1] if i + 1 < d - 1 else 0.0
        if abs(main[i]) >= abs(lower):
            pivot = main[i] if abs(main[i]) > least else least
            main[i] = pivot
            f = lower / pivot
            main[i + 1] = nxt - f * upper[i]
            b[i + 1] -= f * b[i]
        else:
            f = main[i] / lower
            main[i], upper[i], second[i], main[i + 1] = lower, nxt, after, upper[i] - f * nxt
            if i + 1 < d - 1:
                upper[i + 1] = -f * after
            b[i], b[i + 1] = b[i + 1], b[i] - f * b[i + 1]
    if abs(main[-1]) <= least:
        main[-1] = least
    x = [0.0] * (d + 2)
    for i in range(d - 1, -1, -1):
        x[i] = (b[i] - upper[i] * x[i + 1] - second[i] * x[i + 2]) / main[i]
    return np.array(x[:d])


def vectors_of(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit vector for each of the falling eigenvalues (rows), orthogonal to each other within clusters."""
    d = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0) + 2 * np.abs(side).max(initial=0), np.finfo(np.float64).tiny)
    least, rng = norm * np.finfo(np.float64).eps, np.random.default_rng(d)
    out, begin = np.zeros((len(values), d)), 0
    for i, value in enumerate(values.tolist()):
        if i and values[i - 1] - value > CLUSTER * norm:
            begin = i
        # equal eigenvalues are told apart by a hair, so that their systems differ
        shift = value - (i - begin) * least
        x = rng.standard_normal(d)
        for _ in range(6):
            x = _solve(diagonal, side, shift, x / np.linalg.norm(x), least)
            x = x / np.abs(x).max()
            for _ in range(2):  # once more takes what rounding left
                x -= out[begin:i].T @ (out[begin:i] @ x)
        out[i] = x / np.linalg.norm(x)
    return out


def eigen(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as rows, the largest entry of each positive."""
    k = min(k, len(matrix))
    size = np.abs(matrix).max(initial=0)
    if not k or not size:
        return np.zeros(k), np.eye(len(matrix))[:k]
    diagonal, side, mirrors = tridiagonal(matrix / size)
    values = leading(diagonal, side, k)
    found = np.array([lift(mirrors, v) for v in vectors_of(diagonal, side, values)])
    found *= np.sign(found[np.arange(k), np.abs(found).argmax(1)])[:, None]
    return values * size, found


def _wide(values: np.ndarray) -> bool:
    """Whether 64 bits may not hold sums of a block."""
    return len(values) > 0 and max(abs(int(values.min())), abs(int(values.max()))) >= 1 << 40


def _rows(table: pa.Table | pa.RecordBatch, column: int) -> np.ndarray:
    lists = table.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


class Model:
    """What is known of the vectors of one length: their number, sums, mean, eigenvalues (largest first) and components (as rows)."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, components: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.components, self.trace = n, sums, values, components, trace
        d = len(sums)
        # a direction in which nothing differs has no scale
        self.varied = values > d * np.finfo(np.float64).eps * max(trace, 0.0)
        self.small = all(abs(s) < 1 << 62 for s in sums)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in 64 bits where they hold it, else as Python's whole numbers."""
        most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
        if self.small and self.n * most + max(map(abs, self.sums), default=0) < 1 << 62:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def squares(self, off: np.ndarray) -> list[int | None]:
        """Exact sums of squares; null where 64 bits don't hold one."""
        if off.dtype != object and len(off):
            most = max(abs(int(off.min())), abs(int(off.max())))
            if most * most * off.shape[1] < 1 << 62:
                return (off * off).sum(1).tolist()
        exact = [sum(int(v) * int(v) for v in row) for row in off.tolist()]
        return [s if s < 1 << 63 else None for s in exact]

    def project(self, off: np.ndarray) -> np.ndarray:
        """Whitened rows from n * x - S; NaN for components without variance."""
        scale = np.where(self.varied, np.sqrt(np.maximum(self.values, 0)), np.nan)
        return (off / self.n).astype(np.float64) @ self.components.T / scale


def whole_vectors(embeddings: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """vec_id and x, the vector in whole numbers, of the rows whose vector is sound."""
    rows = embeddings.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    sound = "e IS NOT NULL AND forall(e, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))"
    return rows.where(sound).select("vec_id", F.transform("e", lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("x")).where("size(x) > 0")


def _sums(fit: DataFrame) -> DataFrame:
    """n and the exact sum of each entry, by length and place."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            x = batch.column(0)
            sizes = np.diff(x.offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                own = _rows(pa.record_batch([x.filter(pa.array(sizes == d))], names=["x"]), 0)
                n, total = held.get(d, (0, np.zeros(d, object)))
                part = own.astype(object).sum(0) if _wide(own) else own.sum(0).astype(object)
                held[d] = (n + len(own), total + part)
        for d, (n, total) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([Decimal(int(s)) for s in total], pa.decimal128(38, 0))],
                names=["dim", "place", "n", "sum"],
            )

    parts = fit.mapInArrow(add, "dim int, place int, n long, sum decimal(38,0)")
    return parts.groupBy("dim", "place").agg(F.sum("n").alias("n"), F.sum("sum").cast("decimal(38,0)").alias("sum"))


def _products(fit: DataFrame, vectors) -> DataFrame:
    """Sums of products of the rows that `vectors(x, dim)` makes of a block, one row per line of the matrix: dim, line, entries."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        made = vectors()
        for batch in batches:
            x = batch.column(0)
            sizes = np.diff(x.offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                own = _rows(pa.record_batch([x.filter(pa.array(sizes == d))], names=["x"]), 0)
                for begin in range(0, len(own), BLOCK):
                    y = made(own[begin : begin + BLOCK], d)
                    held[d] = held.get(d, 0) + y.T @ y
        for d, m in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()), pa.array(list(m), pa.list_(pa.float64()))], names=["dim", "line", "entries"]
            )

    def total(table: pa.Table) -> pa.Table:
        lines = _rows(table.combine_chunks().to_batches()[0], 2)
        return pa.table({"dim": table["dim"].slice(0, 1), "line": table["line"].slice(0, 1), "entries": pa.array([lines.sum(0)], pa.list_(pa.float64()))})

    kind = "dim int, line int, entries array<double>"
    return fit.mapInArrow(add, kind).groupBy("dim", "line").applyInArrow(total, kind)


def fit(whole: DataFrame, components: int = COMPONENTS) -> tuple[dict[int, Model], dict[int, float | None]]:
    """For each vector length its model, and the largest entry by which the whitened covariance misses the identity (over components that
    have variance; null where none has). `whole` has a column x of longs."""
    spark = whole.sparkSession
    distinct = materialize(whole.select("x").distinct(), "whitening-fit")
    sums: dict[int, tuple[int, list[int]]] = {}
    for row in _sums(distinct).orderBy("dim", "place").collect():  # one row per entry of a vector length
        sums.setdefault(row["dim"], (row["n"], []))[1].append(int(row["sum"]))
    blank = share(spark, {d: Model(n, s, np.zeros(0), np.zeros((0, d)), 0.0) for d, (n, s) in sums.items()})

    def centred():
        models = blank()
        return lambda x, d: (models[d].deviations(x) / models[d].n).astype(np.float64)

    def take_apart(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        order = np.argsort(batch.column(1).to_numpy())
        d = len(order)
        matrix = _rows(batch, 2)[order] / blank()[d].n
        values, found = eigen((matrix + matrix.T) / 2, components)
        return pa.table({"dim": table["dim"].slice(0, 1), "trace": [float(np.trace(matrix))], "values": [values.tolist()], "found": [found.ravel().tolist()]},
                        schema=pa.schema([("dim", pa.int32()), ("trace", pa.float64()), ("values", pa.list_(pa.float64())), ("found", pa.list_(pa.float64()))]))

    apart = _products(distinct, centred).groupBy("dim").applyInArrow(take_apart, "dim int, trace double, values array<double>, found array<double>")
    models = {}
    for row in apart.collect():  # one row per vector length, with its few components
        n, s = sums[row["dim"]]
        models[row["dim"]] = Model(n, s, np.array(row["values"]), np.array(row["found"]).reshape(len(row["values"]), -1), row["trace"])
    shared = share(spark, models)

    def whitened():
        own = shared()

        def rows(x: np.ndarray, d: int) -> np.ndarray:
            y = own[d].project(own[d].deviations(x))
            return np.concatenate([np.ones((len(y), 1)), np.where(own[d].varied, y, 0)], 1)  # the ones give the sums too

        return rows

    lines: dict[int, dict[int, list[float]]] = {}
    for row in _products(distinct, whitened).collect():  # k + 1 lines of k + 1 numbers for each vector length
        lines.setdefault(row["dim"], {})[row["line"]] = row["entries"]
    errors: dict[int, float | None] = {}
    for d, model in models.items():
        m = np.array([lines[d][i] for i in range(len(lines[d]))]) / model.n
        covariance = m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:])
        off = np.abs(covariance - np.eye(len(covariance)))[np.ix_(model.varied, model.varied)]
        errors[d] = float(off.max()) if off.size else None
    return models, errors


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """One row per sound row and component: vec_id, component (from 1, by falling variance), n (vectors of the fit list), deviation (sum of
    squares of n * x - S, exact), whitened, explained (share of the variance), identity_error.

    Rows whose vector is null or empty or holds null or non-finite entries are left out; rows without an id and repeated rows are kept, and equal
    vectors count once in the fit. Vectors of each length have a fit of their own, with as many components as they have entries at most.
    Whitened is null for a component without variance (one distinct vector, or fewer directions than components), its
    share is 0; deviation is null where 64 bits don't hold it. Of equal eigenvalues any orthogonal pair of vectors may be taken; all rows use the
    same ones. An empty table gives no rows. Other columns are not read.
    """
    whole = whole_vectors(embeddings, vec_id, embedding, scale)
    models, errors = fit(whole, components)
    shared = share(embeddings.sparkSession, (models, errors))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, misses = shared()
        for batch in batches:
            x = batch.column(1)
            sizes = np.diff(x.offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                mask = pa.array(sizes == d)
                ids, model = batch.column(0).filter(mask), own[d]
                off = model.deviations(_rows(pa.record_batch([x.filter(mask)], names=["x"]), 0))
                y, k = model.project(off), len(model.values)
                shares = [v / model.trace if ok else 0.0 for v, ok in zip(model.values.tolist(), model.varied.tolist(), strict=True)]
                take = pa.array(np.repeat(np.arange(len(ids)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))), pa.array([model.n] * (k * len(ids)), pa.int64()),
                        pa.array(model.squares(off), pa.int64()).take(take), pa.array(y.ravel(), pa.float64(), from_pandas=True),
                        pa.array(shares * len(ids), pa.float64()), pa.array([misses[d]] * (k * len(ids)), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = whole.schema["vec_id"].dataType.simpleString()
    return whole.mapInArrow(project, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
