"""Embedding whitening by spectrum slicing (operator 11).

Entries c become integers x = floor(scale * c) + offset. Their sums are exact; the covariance is summed over the rows,
centred first, one matrix per task. The leading eigenpairs of that matrix come from spectrum slicing:

1. An LDLᵀ factorisation of the covariance less a shift (Bunch-Kaufman pivots) has as many negative pivots as there are
   eigenvalues below the shift. Intervals are halved until each leading eigenvalue has one to itself.
2. Rayleigh quotient iteration, started by inverse iteration at the interval's middle, converges cubically; a result
   outside the interval is thrown away and the interval halved again.
3. Counts just below and just above each result certify its number.

Eigenvalues that agree to rounding are taken as one eigenspace: block inverse iteration gives an orthonormal basis of it.
Signs are chosen so that the largest entry of a component is positive.

Vectors that are null, empty, or hold a null or non-finite entry take no part, nor do those whose length isn't the most
frequent one (of equally frequent ones the longest); entries beyond 2**34 count as that. There are as many components
as the vectors have entries, `count` at most. A component without variance (beyond rounding) has whitened null and is
left out of the identity error. deviation is null where it doesn't fit into 64 bits; deviation_text always holds it.
Rows without an id take part; repeated rows give repeated results; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.tables import arrow_schema
from paperloom.session import durable

SCALE, OFFSET, COUNT = 1024, 100_000, 8
BOUND = float(1 << 34)  # entries beyond it count as it
EPS = float(np.finfo(np.float64).eps)
NO_VARIANCE = 1e-12  # share of the trace
PIVOT = (1 + math.sqrt(17)) / 8  # fixed value: the threshold of Bunch and Kaufman
RESULT = (
    "vec_id long,component int,n long,deviation long,whitened double,explained double,deviation_text string"
)


def below(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of a symmetric matrix that are below the shift, from the pivots of LDLᵀ."""
    m = matrix - shift * np.eye(len(matrix))
    negative, k, n = 0, 0, len(m)
    while k < n:
        a = m[k:, k:]
        size, two = len(a), False
        if size > 1:
            r = 1 + int(np.argmax(np.abs(a[1:, 0])))
            own, most = abs(a[0, 0]), abs(a[r, 0])
            if own < PIVOT * most:
                column = np.abs(a[:, r])
                column[r] = 0
                beside = column.max()
                if own * beside < PIVOT * most * most:
                    two = abs(a[r, r]) < PIVOT * beside
                    to = 1 if two else 0
                    a[[to, r]] = a[[r, to]]
                    a[:, [to, r]] = a[:, [r, to]]
        if two:
            block, rest = a[:2, :2], a[2:, :2]
            determinant = block[0, 0] * block[1, 1] - block[0, 1] ** 2
            negative += 1 if determinant < 0 else 2 * int(block[0, 0] < 0)
            if size > 2:
                a[2:, 2:] -= rest @ np.linalg.solve(block, rest.T)
            k += 2
        else:
            pivot = a[0, 0]
            if pivot != 0:
                negative += int(pivot < 0)
                column = a[1:, 0].copy()
                a[1:, 1:] -= np.multiply.outer(column / pivot, column)
            k += 1
    return negative


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, nudge: float) -> np.ndarray:
    while True:
        try:
            return np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            shift, nudge = shift + nudge, 2 * nudge


def _rayleigh(matrix: np.ndarray, low: float, high: float, start: np.ndarray, nudge: float):
    """(value, vector) of the eigenvalue within the interval, or None if the iteration leaves it."""
    middle = (low + high) / 2
    x = _solve(matrix, middle, start, nudge)
    x = _solve(matrix, middle, x / np.linalg.norm(x), nudge)
    x /= np.linalg.norm(x)
    best = math.inf
    while True:
        value = float(x @ matrix @ x)
        residual = float(np.linalg.norm(matrix @ x - value * x))
        if not residual < best / 2:  # no longer getting better
            return (value, x) if low - nudge <= value <= high + nudge and residual <= high - low + nudge else None
        best, held = residual, (value, x)
        if residual <= nudge / 8:
            return held if low - nudge <= value <= high + nudge else None
        x = _solve(matrix, value, x, nudge)
        x /= np.linalg.norm(x)


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues in falling order and their unit eigenvectors as columns."""
    n = len(matrix)
    count = min(count, n)
    reach = float(np.abs(matrix).sum(1).max(initial=0.0))  # no eigenvalue is beyond it
    if not count or reach == 0:
        return np.zeros(count), np.eye(n)[:, :count]
    tiny = 32 * EPS * reach
    low, high = -reach - tiny, reach + tiny
    start = np.random.default_rng(0).standard_normal((n, n))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    # Intervals from the right, with the number of eigenvalues above their left and right end.
    todo = [(low, high, n, 0)]
    while todo and len(values) < count:
        low, high, above_low, above_high = todo.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if inside == 1:
            found = _rayleigh(matrix, low, high, start[:, 0], tiny)
            if found is not None and _certified(matrix, found[0], above_high, 1, tiny):
                values.append(found[0])
                vectors.append(found[1])
                continue
        if high - low <= 4 * tiny:
            basis = start[:, :inside]
            for _ in range(4):
                basis = np.linalg.qr(_solve(matrix, (low + high) / 2, basis, tiny))[0]
            for x in basis.T:
                values.append(float(x @ matrix @ x))
                vectors.append(x)
            continue
        middle = (low + high) / 2
        above = n - below(matrix, middle)
        above = min(max(above, above_high), above_low)
        todo.append((low, middle, above_low, above))
        todo.append((middle, high, above, above_high))
    basis = np.linalg.qr(np.stack(vectors, axis=1))[0]
    basis *= np.where(np.take_along_axis(basis, np.abs(basis).argmax(0)[None], 0) < 0, -1.0, 1.0)
    return np.array(values[:count]), basis[:, :count]


def _certified(matrix: np.ndarray, value: float, above: int, own: int, tiny: float) -> bool:
    """Whether `above` eigenvalues lie above the value and `own` at it, by counts on both sides."""
    n = len(matrix)
    return n - below(matrix, value + tiny) == above and n - below(matrix, value - tiny) == above + own


@dataclass(frozen=True)
class Whitening:
    """What a fit list gives: count and exact sums of x, trace of the covariance, leading eigenvalues and eigenvectors."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    scale: int = SCALE
    offset: int = OFFSET

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def varies(self) -> np.ndarray:
        return self.values > NO_VARIANCE * self.trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([s / self.n for s in self.sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """One column per component; nan for one without variance."""
        spread = np.sqrt(np.where(self.varies, self.values, np.nan))
        return self.centred(x) @ self.vectors / spread

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the entries of (n x - S) ** 2, exact."""
        sums = self.sums
        most = max((max(abs(self.n * int(x[:, i].max()) - s), abs(self.n * int(x[:, i].min()) - s)) for i, s in enumerate(sums)), default=0) if len(x) else 0
        if most * most * max(1, len(sums)) < 1 << 63 and self.n * (int(np.abs(x).max(initial=0)) + 1) < 1 << 62:
            apart = self.n * x - np.array(sums, np.int64)
            return (apart * apart).sum(1).tolist()
        return [sum((self.n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and the vector, for the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf)))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(finite, v).alias("v")).where("size(v) > 0")


def _integers(column, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """All x of a batch in one row after the other, and the lengths of its vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    x = np.floor(scale * np.clip(flat, -BOUND, BOUND)).astype(np.int64) + offset
    return x, column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _rows_of_width(column, width: int, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """The x of those vectors of a batch that have the width, as a matrix, and their places."""
    x, lengths = _integers(column, scale, offset)
    at = np.flatnonzero(lengths == width)
    return x[np.repeat(lengths == width, lengths)].reshape(len(at), width), at


def _sums(vectors: DataFrame, scale: int, offset: int) -> DataFrame:
    """(width, pos, n, s): rows and exact sum of x by length of the vector and place in it."""
    schema = "width int,pos int,n long,s long"

    def partial(batches):
        kinds = arrow_schema(schema)
        for batch in batches:
            x, lengths = _integers(batch.column(0), scale, offset)
            for width in np.unique(lengths).tolist():
                own = x[np.repeat(lengths == width, lengths)].reshape(-1, width)
                columns = [np.full(width, width), np.arange(width), np.full(width, len(own)), own.sum(0)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

    sums = vectors.select("v").mapInArrow(partial, schema).groupBy("width", "pos")
    return sums.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))


def _total_of_rows(parts: DataFrame, width: int) -> np.ndarray:
    """Sum of matrices that stand in `parts` row by row (i, row), as one matrix."""

    def total(batches):
        held, sums = None, None
        for batch in batches:
            numbers = batch.column(0).to_numpy(zero_copy_only=False).tolist()
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for i, row in zip(numbers, rows, strict=True):
                if i != held:
                    if held is not None:
                        yield pa.RecordBatch.from_pydict({"i": [held], "row": [sums]})
                    held, sums = i, np.zeros(width)
                sums = sums + row
        if held is not None:
            yield pa.RecordBatch.from_pydict({"i": [held], "row": [sums]})

    out = np.zeros((width, width))
    for row in parts.repartition("i").sortWithinPartitions("i").mapInArrow(total, "i long,row array<double>").collect():
        out[row.i] = row.row
    return out


def covariance(vectors: DataFrame, sums: list[int], n: int, scale: int = SCALE, offset: int = OFFSET) -> np.ndarray:
    """Covariance of x over all vectors of the width, divisor n, centred before multiplying."""
    width = len(sums)
    mean = np.array([s / n for s in sums])

    def partial(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = _rows_of_width(batch.column(0), width, scale, offset)[0] - mean
            total += x.T @ x
        if total.any():
            rows = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), rows], names=["i", "row"])

    total = _total_of_rows(vectors.select("v").mapInArrow(partial, "i long,row array<double>"), width)
    return (total + total.T) / (2 * n)


def fit(vectors: DataFrame, count: int = COUNT, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """The whitening of the usable vectors (as `usable` gives them); None if there are none."""
    sums = durable(_sums(vectors, scale, offset))
    width = sums.where("pos = 0").orderBy(F.desc("n"), F.desc("width")).select("width", "n").first()
    if width is None:
        return None
    exact = [int(row.s) for row in sums.where(F.col("width") == width.width).orderBy("pos").select("s").collect()]
    matrix = covariance(vectors, exact, width.n, scale, offset)
    values, components = leading(matrix, count)
    return Whitening(width.n, tuple(exact), float(np.trace(matrix)), values, components, scale, offset)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over components with variance."""
    k = int(model.varies.sum())
    if not k:
        return 0.0

    def partial(batches):
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            x, _ = _rows_of_width(batch.column(0), model.width, model.scale, model.offset)
            w = np.hstack([model.whiten(x)[:, :k], np.ones((len(x), 1))])
            total += w.T @ w
        yield pa.RecordBatch.from_pydict({"pos": np.arange(total.size), "s": total.ravel()})

    rows = vectors.select("v").mapInArrow(partial, "pos long,s double").groupBy("pos").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((k + 1) ** 2)
    for row in rows:
        total[row.pos] = row.s
    total = total.reshape(k + 1, k + 1) / model.n
    mean = total[-1, :-1]
    return float(np.abs(total[:-1, :-1] - np.outer(mean, mean) - np.eye(k)).max())


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id and the whitened vector (nan for a component without variance) of each usable vector of the fit's width."""

    def run(batches):
        for batch in batches:
            x, at = _rows_of_width(batch.column(1), model.width, model.scale, model.offset)
            w = np.ascontiguousarray(model.whiten(x))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), rows], names=["vec_id", "whitened"])

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long,whitened array<double>")


def scan_vectors(vectors: DataFrame, count: int = COUNT, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: deviation, whitened value, explained share and the fit's identity error."""
    rows = usable(vectors, id_col, vector_col)
    model = fit(rows, count)
    if model is None:
        empty = rows.sparkSession.createDataFrame([], RESULT.replace(",", ", "))
        return empty.withColumn("identity_error", F.lit(0.0))
    error = identity_error(rows, model)
    k = len(model.values)
    explained = model.values / model.trace if model.trace > 0 else np.zeros(k)
    explained = np.where(model.varies, explained, 0.0)

    def run(batches):
        kinds = arrow_schema(RESULT)
        for batch in batches:
            x, at = _rows_of_width(batch.column(1), model.width, model.scale, model.offset)
            if not len(at):
                continue
            m, each = len(at), np.repeat(np.arange(len(at)), k)
            exact = model.deviations(x)
            white = model.whiten(x).ravel()
            deviation = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
            columns = [
                batch.column(0).take(pa.array(at[each])),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)),
                deviation.take(pa.array(each)),
                pa.array(white, mask=np.isnan(white)),
                pa.array(np.tile(explained, m)),
                pa.array(list(map(str, exact))).take(pa.array(each)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    out = rows.mapInArrow(run, RESULT)
    return out.select(*out.columns[:6], F.lit(error).alias("identity_error"), "deviation_text")
