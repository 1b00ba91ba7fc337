"""Whitened vectors: every covariance from exact variances of coordinates and of sums of two coordinates.

For two coordinates 2 cov(a, b) = var(a + b) - var(a) - var(b) (polarisation). The squares are added up in whole numbers,
so the covariances carry no rounding but that of their last division.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A coordinate c is counted in steps of 1 / SCALE, moved by SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Steps from here on have no exact place in 64 bits beside their differences.
LARGEST = float(1 << 61)
#: Sums are added up in digits of so many bits, so that 2**32 partial sums still fit into 64 bits.
DIGIT = 31
#: Rows that one step works on at most.
ROWS = 4096


@dataclass
class Whitening:
    """What `fit` learns from the vectors of one length: all that a task needs to whiten a vector."""

    dims: int
    n: int
    #: The whole number under the mean of each coordinate, and n times what the mean exceeds it by.
    floor: np.ndarray
    rest: list[int]
    #: Unit eigenvectors in columns by falling eigenvalue, and the eigenvalues (0: no variance beyond rounding).
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    covariance: np.ndarray | None
    identity_error: float = float("nan")


def steps(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, coordinates as whole steps) of the usable vectors of a list column, for each length above 0."""
    column = column.cast(pa.large_list(pa.float64()))
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    flat = column.flatten()  # entries of rows that are not null
    values = np.floor(SCALE * np.asarray(flat.fill_null(float("nan")), np.float64))
    bad = ~(np.abs(values) < LARGEST)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    wrong = np.concatenate([[0], np.cumsum(bad)])
    good = (sizes > 0) & (wrong[starts[1:]] == wrong[starts[:-1]])
    for dims in np.unique(sizes[good]):
        rows = np.flatnonzero(good & (sizes == dims))
        for i in range(0, len(rows), ROWS):
            some = rows[i : i + ROWS]
            places = starts[some][:, None] + np.arange(dims)
            yield int(dims), some, values[places].astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vector) to (dims, j, n, high, low): rows, and the sum of coordinate j as high * 2**DIGIT + low."""
    held: dict[int, list] = {}
    for batch in batches:
        for dims, rows, x in steps(batch.column(0)):
            sums = held.setdefault(dims, [0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)])
            sums[0] += len(rows)
            sums[1] += (x >> DIGIT).sum(0)
            sums[2] += (x & ((1 << DIGIT) - 1)).sum(0)
    for dims, (n, high, low) in held.items():
        columns = [np.full(dims, dims), np.arange(dims), np.full(dims, n), high, low]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["dims", "j", "n", "high", "low"])


def _digits(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on as rows of digits, the lowest first."""
    rows = []
    while True:
        rows.append((values & ((1 << DIGIT) - 1)).astype(np.int64))
        values = values >> DIGIT
        if not values.any():
            return np.stack(rows)


def _add(total: np.ndarray, more: np.ndarray) -> np.ndarray:
    if len(more) > len(total):
        total, more = more.copy(), total
    total[: len(more)] += more
    return total


def squares_of(y: np.ndarray, j: int) -> np.ndarray:
    """Exact sums over the rows of y[:, j]**2 and of (y[:, j] + y[:, k])**2 for each k after j, as digits.

    Doubles hold whole numbers below 2**53 exactly, so as many rows are added at once as surely stay below.
    """
    most = max(1, 2 * int(np.abs(y).max()))
    at_once = (1 << 53) // (most * most)
    total = np.zeros((1, y.shape[1] - j), np.int64)
    if at_once:
        for i in range(0, len(y), at_once):
            part = y[i : i + at_once].astype(np.float64)
            both = part[:, j:] + part[:, j, None]
            both[:, 0] = part[:, j]
            total = _add(total, _digits(np.einsum("ij,ij->j", both, both).astype(np.int64)))
        return total
    whole = y.astype(object)
    both = whole[:, j:] + whole[:, j, None]
    both[:, 0] = whole[:, j]
    return _add(total, _digits((both * both).sum(0)))


def _squares(floors: dict[int, np.ndarray]):
    """(vector) to (dims, j, sums): the sums of `squares_of` over all vectors of a task, as bytes of digits."""

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for dims, _, x in steps(batch.column(0)):
                y = x - floors[dims]
                for j in range(dims):
                    own = squares_of(y, j)
                    held[dims, j] = _add(held[dims, j], own) if (dims, j) in held else own
        for (dims, j), total in held.items():
            yield _sum_row(dims, j, total)

    return squares


def _sum_row(dims: int, j: int, total: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([dims], pa.int64()), pa.array([j], pa.int64()), pa.array([total.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["dims", "j", "sums"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal (dims, j), which follow each other, added up one after the other."""
    key, total = None, None
    for batch in batches:
        for dims, j, sums in zip(*[batch.column(k).to_pylist() for k in range(3)]):
            more = np.frombuffer(sums, np.int64).reshape(-1, dims - j)
            if key != (dims, j):
                if key is not None:
                    yield _sum_row(*key, total)
                key, total = (dims, j), more.copy()
            else:
                total = _add(total, more)
    if key is not None:
        yield _sum_row(*key, total)


def _whole(digits: np.ndarray) -> np.ndarray:
    """Python's whole numbers from rows of digits."""
    total = np.zeros(digits.shape[1], object)
    for row in digits[::-1]:
        total = total * (1 << DIGIT) + row.astype(object)
    return total


def _covariance(dims: int, n: int, rest: list[int], rows: dict[int, bytes]) -> np.ndarray:
    """Covariances from sums of squares about the floors: exact in whole numbers, then one division.

    With y the distance from the floor and r its sum, n y - r is n times the distance from the mean, and the sum of
    (n y - r)**2 is n times n * sum(y**2) - r**2. Here `spread` is n * sum(y**2) - r**2.
    """
    r = np.array(rest, object)
    pairs = {j: _whole(np.frombuffer(rows[j], np.int64).reshape(-1, dims - j)) for j in range(dims)}
    spread = np.array([n * pairs[j][0] - r[j] * r[j] for j in range(dims)], object)
    table = np.zeros((dims, dims))
    for j in range(dims):
        table[j, j] = spread[j] / (n * n)
        if j + 1 < dims:
            both = n * pairs[j][1:] - (r[j] + r[j + 1 :]) ** 2
            crossed = both - spread[j] - spread[j + 1 :]
            table[j, j + 1 :] = table[j + 1 :, j] = [c / (2 * n * n) for c in crossed]
    return table


def _whitened(model: Whitening, x: np.ndarray) -> np.ndarray:
    """Rows projected on the axes in units of their deviation, and nan on axes without variance."""
    centred = (x - model.floor).astype(np.float64) - np.array([float(r) for r in model.rest]) / model.n
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(model.values > 0, 1 / np.sqrt(model.values), np.nan)
        return (centred @ model.axes) * scale


def _products(models: dict[int, Whitening]):
    """(vector) to (dims, i, k, value): sums of whitened values (k = -1) and of their products."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            for dims, _, x in steps(batch.column(0)):
                own = np.nan_to_num(_whitened(models[dims], x))
                both = np.concatenate([own.sum(0)[:, None], own.T @ own], axis=1)
                held[dims] = held[dims] + both if dims in held else both
        for dims, both in held.items():
            i, k = np.indices(both.shape).reshape(2, -1)
            columns = [np.full(i.shape, dims), i, k - 1]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c.astype(np.int64)) for c in columns], pa.array(both.ravel())], ["dims", "i", "k", "value"]
            )

    return products


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = 32) -> dict[int, Whitening]:
    """A whitening for each length of the usable vectors of `vectors`, learnt from all of them.

    A vector is usable if it is not null or empty and holds no null or non-finite entry, nor one beyond 2**55, whose
    step has no exact place in 64 bits. Three passes: sums; squares of every coordinate and every sum of two; products of
    the whitened values, which only measure how far these are from the identity.

    A task and the driver hold one number for each pair of coordinates, however many vectors there are: the table of
    pairs (dims * dims / 2 sums, with dims * dims doubles for the eigenvectors) is all that grows, and only with the
    length of a vector. Repeated rows count as often as they come. Without a usable vector the result is empty.
    """
    plain = vectors.select(F.col(vec_col).alias("vector"))
    found = plain.mapInArrow(_sums, "dims long, j long, n long, high long, low long").groupBy("dims", "j")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    sums: dict[int, dict[int, int]] = {}
    counts: dict[int, int] = {}
    for dims, j, n, high, low in found.agg(F.sum("n").alias("n"), *wide).collect():
        counts[dims] = n
        sums.setdefault(dims, {})[j] = int(high) * (1 << DIGIT) + int(low)
    if not counts:
        return {}
    floors = {d: np.array([s[j] // counts[d] for j in range(d)], np.int64) for d, s in sums.items()}
    rests = {d: [s[j] % counts[d] for j in range(d)] for d, s in sums.items()}

    kind = "dims long, j long, sums binary"
    squared = plain.mapInArrow(_squares(floors), kind).repartition("dims", "j").sortWithinPartitions("dims", "j")
    tables: dict[int, dict[int, bytes]] = {}
    for dims, j, total in squared.mapInArrow(_merge, kind).collect():
        tables.setdefault(dims, {})[j] = bytes(total)
    models = {}
    for dims, n in counts.items():
        table = _covariance(dims, n, rests[dims], tables.pop(dims))
        values, axes = np.linalg.eigh(table)
        values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
        least = max(values[0], 0.0) * dims * np.finfo(float).eps * 8
        values = np.where(values > least, values, 0.0)
        trace = np.trace(table)
        explained = values / trace if trace > 0 else np.zeros(len(values))
        models[dims] = Whitening(dims, n, floors[dims], rests[dims], np.ascontiguousarray(axes), values, explained, table)
    _measure(plain, models)
    return models


def _measure(plain: DataFrame, models: dict[int, Whitening]) -> None:
    """Set identity_error: the largest entry by which the whitened values' covariance differs from the identity."""
    sent = {d: _light(m) for d, m in models.items()}
    made = plain.mapInArrow(_products(sent), "dims long, i long, k long, value double")
    tables = {d: np.zeros((len(m.values), len(m.values) + 1)) for d, m in models.items()}
    for dims, i, k, value in made.groupBy("dims", "i", "k").agg(F.sum("value")).collect():
        tables[dims][i, k + 1] = value / models[dims].n
    for dims, model in models.items():
        mean = tables[dims][:, 0]
        away = np.abs(tables[dims][:, 1:] - np.outer(mean, mean) - np.eye(len(mean)))
        held = model.values > 0
        model.identity_error = float(away[held][:, held].max()) if held.any() else float("nan")


def _light(model: Whitening) -> Whitening:
    """`model` without its table, as tasks need it."""
    return Whitening(**{**vars(model), "covariance": None})


def _deviation(model: Whitening, x: np.ndarray) -> pa.Array:
    """Exact sums over the coordinates of (n x - S)**2; null beyond 38 digits."""
    y = x - model.floor
    n, most = model.n, int(np.abs(y).max()) + 1
    if (n * most) ** 2 * model.dims < 1 << 62:
        away = n * y - np.array(model.rest, np.int64)
        return pa.array((away * away).sum(1)).cast(pa.decimal128(38, 0))
    away = n * y.astype(object) - np.array(model.rest, object)
    exact = (away * away).sum(1)
    return pa.array([str(d) if d < 10**38 else None for d in exact], pa.string()).cast(pa.decimal128(38, 0))


def _transform(models: dict[int, Whitening]):
    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, rows, x in steps(batch.column(1)):
                model = models[dims]
                own = _whitened(model, x)
                flat = pa.array(own.ravel(), mask=np.isnan(own).ravel())
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * own.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)),
                        pa.array(np.full(len(x), dims, np.int32)),
                        _deviation(model, x),
                        pa.ListArray.from_arrays(ends, flat),
                    ],
                    ["vec_id", "dims", "deviation", "whitened"],
                )

    return transform


def transform(
    vectors: DataFrame, models: dict[int, Whitening], id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(vec_id, dims, deviation, whitened) for every usable vector of `vectors` whose length has a model.

    whitened: the vector less the mean on each axis, over the axis's standard deviation (null on an axis without
    variance). deviation: sum of (n x - S)**2 over the coordinates, exact (null beyond 38 digits).
    """
    sent = {d: _light(m) for d, m in models.items()}
    plain = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vector"))
    known = plain.where(F.size("vector").isin([int(d) for d in sent])) if sent else plain.limit(0)
    return known.mapInArrow(_transform(sent), "vec_id long, dims int, deviation decimal(38,0), whitened array<double>")


def digest(
    vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, dims): a row for each vector and component.

    Vectors that are null, empty or hold a null, non-finite or too large entry give no rows. Vectors of each length
    are a list of their own. A component without variance (fewer distinct vectors than components, a single vector,
    equal vectors) has whitened null and explained 0, and identity_error leaves it out (nan if there is no other).
    A deviation that does not fit into a long is null. A null or repeated vec_id is kept as it is; extra columns are
    ignored; an empty table gives no rows.
    """
    models = fit(vectors, vec_col, components)
    facts = [
        (int(d), int(c), m.n, float(e), m.identity_error)
        for d, m in models.items()
        for c, e in enumerate(m.explained, 1)
    ]
    kind = "dims int, component int, n long, explained double, identity_error double"
    table = F.broadcast(vectors.sparkSession.createDataFrame(facts, kind))  # components rows for each length
    rows = transform(vectors, models, id_col, vec_col).select(
        "vec_id", "dims", F.expr("try_cast(deviation as long)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened")
    )
    return rows.withColumn("component", (F.col("at") + 1).cast("int")).join(table, ["dims", "component"]).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "dims"
    )
