"""Whitening of embeddings by the covariance of their distinct grid vectors.

Every entry becomes a whole number (a grid step of ``1 / scale``), so equal vectors meet in
one group; its number of rows (or one, as the caller chooses) is its weight in the fit.  The
sums and the weighted centred products are whole numbers as well and are added exactly, so
the covariance is the same however Spark deals the rows; only its eigenvectors are computed
on the driver, from a square matrix of the vector's dimensions.  Every distinct vector is
whitened once and joined back to its rows.

Skew: copies are counted before the shuffle, and the whitened vectors of the few groups that hold
more than ``1 / HOT`` of all rows (fewer than ``HOT``) reach their rows by broadcast.

Defined cases: rows take no part whose vector is null, empty, or holds null or non-finite
entries, or has another length than most vectors have (of equally frequent lengths the longer
counts); a null or repeated id is an id like any other; grid values beyond 64 bits stay at
their bound; components whose eigenvalue is rounding only (all rows alike, or fewer rows than
dimensions) are left out, so a table of equal vectors or without rows gives no result;
``deviation`` is null where it exceeds 64 bits; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tessera.session import checkpoint_dir, scratch_path

#: A group of more than one in so many rows is joined by broadcast.
HOT = 4096
#: Products up to this bound are added in double precision without rounding.
_EXACT = 1 << 53
_LOW = 40


# ------------------------------------------------------------------ keys
def _key(x: np.ndarray) -> list[bytes]:
    """The smallest of three widths that holds a row, and the row in it."""
    top = np.maximum(x.max(1), -(x.min(1) + 1)) if x.size else np.zeros(len(x), np.int64)
    out: list = [None] * len(x)
    for bits, mark in ((16, b"h"), (32, b"i"), (64, b"q")):
        rows = np.flatnonzero((top < 1 << (bits - 1)) if bits == 16 else
                              (top < 1 << (bits - 1)) & (top >= 1 << (bits // 2 - 1)))
        if len(rows):
            raw, size = x[rows].astype(f"<i{bits // 8}").tobytes(), x.shape[1] * bits // 8
            for i, r in enumerate(rows.tolist()):
                out[r] = mark + raw[i * size:(i + 1) * size]
    return out


def _vectors(keys) -> np.ndarray:
    """Rows of :func:`_key` as 64-bit integers."""
    return np.stack([np.frombuffer(k, f"<{k[:1].decode()}", offset=1).astype(np.int64) for k in keys])


def grid_keys(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """``id``, ``key``: the grid vector of every row that takes part."""
    vec = F.col("vec")
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(
        (F.size(vec) > 0) & F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    top = rows.groupBy(F.size(vec).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dims = top["d"] if top else 0
    bound = float(1 << 63)

    def run(batches):
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False)
            steps = np.floor(flat * scale)
            x = np.where(steps >= bound, np.iinfo(np.int64).max, np.where(steps < -bound, np.iinfo(np.int64).min, 0))
            inside = (steps >= -bound) & (steps < bound)
            x[inside] = steps[inside].astype(np.int64)
            yield pa.record_batch([b.column(0), pa.array(_key(x.reshape(b.num_rows, dims)), pa.binary())], names=["id", "key"])

    kind = df.schema[id_col].dataType.simpleString()
    return rows.where(F.size(vec) == dims).mapInArrow(run, f"id {kind}, key binary")


# ------------------------------------------------------------------ exact sums over tasks
_PARTS = "i int, parts array<long>"


def _split(row) -> list[int]:
    """Whole numbers as three parts of 40 bits each, the last one signed and longer: all lowest parts first."""
    low = [int(v) & (1 << _LOW) - 1 for v in row]
    middle = [int(v) >> _LOW & (1 << _LOW) - 1 for v in row]
    return low + middle + [int(v) >> 2 * _LOW for v in row]


def _part_batch(rows: dict[int, list]):
    return pa.record_batch([pa.array(list(rows), pa.int32()), pa.array([_split(r) for r in rows.values()], pa.list_(pa.int64()))],
                           names=["i", "parts"])


def _exact_sums(parts: DataFrame, size: int) -> dict[int, list[int]]:
    """Sums by ``i`` of rows of whole numbers, one row per task and ``i``; each ``i`` is added up as rows pass by."""
    def add(batches):
        sums: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for i, row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                new = np.asarray(row, np.int64).reshape(3, -1)
                if i in sums:
                    new = new + sums[i]
                for k in (0, 1):  # what exceeds a part goes to the next one
                    new[k + 1] += new[k] >> _LOW
                    new[k] &= (1 << _LOW) - 1
                sums[i] = new
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([v.ravel().tolist() for v in sums.values()], pa.list_(pa.int64()))],
                                  names=["i", "parts"])

    rows = parts.repartition("i").mapInArrow(add, _PARTS).collect()  # at most ``size`` rows
    out: dict[int, list[int]] = {}
    for r in rows:
        d = len(r.parts) // 3
        out[r.i] = [(r.parts[2 * d + j] << 2 * _LOW) + (r.parts[d + j] << _LOW) + r.parts[j] for j in range(d)]
    return {i: out[i] for i in range(size)} if rows else {}


def _weights(batch, weights: str) -> np.ndarray:
    n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
    return n if weights == "count" else np.ones_like(n)


def _sums(distinct: DataFrame, dims: int, shift: int, weights: str) -> tuple[int, list[int]]:
    """Weight of all groups, and the weighted sum of each dimension."""
    def run(batches):
        total, n = np.zeros(dims, object), 0
        for b in batches:
            x, w = _vectors(b.column("key").to_pylist()).astype(object) + shift, _weights(b, weights).astype(object)
            total, n = total + (x * w[:, None]).sum(0), n + int(w.sum())
        yield _part_batch({0: [*total, n]})

    *sums, n = _exact_sums(distinct.mapInArrow(run, _PARTS), 1)[0]
    return n, sums


def weighted_gram(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sum of ``w`` times the outer product of each row of whole numbers, exactly, as Python integers."""
    d = x.shape[1]
    out = np.zeros((d, d), object)
    top = np.abs(x).max(1, initial=0).astype(object)
    load = [int(t) * int(t) * int(k) for t, k in zip(top, w)]
    lo, held = 0, 0
    fine = np.asarray([v < _EXACT for v in load], bool)
    for i in np.flatnonzero(~fine).tolist():
        r = x[i].astype(object)
        out += np.outer(r, r) * int(w[i])
    x, w, load = x[fine].astype(float), w[fine].astype(float), [v for v in load if v < _EXACT]
    for i in range(len(load) + 1):
        if i == len(load) or held + load[i] >= _EXACT:
            if i > lo:
                part = x[lo:i]
                out += ((part * w[lo:i, None]).T @ part).astype(np.int64).astype(object)
            lo, held = i, 0
        if i < len(load):
            held += load[i]
    return out


def _gram(distinct: DataFrame, centre: list[int], shift: int, weights: str) -> dict[int, list[int]]:
    d = len(centre)
    offset = np.asarray([c - shift for c in centre], object)
    near = all(abs(int(v)) < 1 << 62 for v in offset)

    def run(batches):
        total = np.zeros((d, d), object)
        for b in batches:
            x = _vectors(b.column("key").to_pylist())
            small = near and (np.abs(x) < 1 << 62).all()
            total = total + weighted_gram(x - offset.astype(np.int64) if small else x.astype(object) - offset, _weights(b, weights))
        yield _part_batch({i: list(r) for i, r in enumerate(total)})

    return _exact_sums(distinct.mapInArrow(run, _PARTS), d)


# ------------------------------------------------------------------ model
@dataclass
class Model:
    """``n`` rows with per-dimension ``sums``; unit ``vectors`` (columns) by falling eigenvalue, and ``trace``."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def covariance(n: int, sums: list[int], centre: list[int], gram: dict[int, list[int]]) -> np.ndarray:
    """Covariance (divisor ``n``) from products about a whole-number centre; exact up to the last rounding."""
    rest = [s - n * c for s, c in zip(sums, centre)]
    return np.asarray([[(n * v - a * b) / (n * n) for v, b in zip(gram[i], rest)] for i, a in enumerate(rest)], float)


def fit(distinct: DataFrame, shift: int, components: int, weights: str = "count") -> Model | None:
    """Eigenvectors of the covariance of ``distinct`` (``key``, ``n``), each group weighing its rows or one."""
    if weights not in ("count", "one"):
        raise ValueError(f"unknown weights {weights!r}")
    first = distinct.select("key").first()
    if first is None:
        return None
    dims = _vectors([bytes(first.key)]).shape[1]
    n, sums = _sums(distinct, dims, shift, weights)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    v = covariance(n, sums, centre, _gram(distinct, centre, shift, weights))
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > values[0] * dims * 8 * np.finfo(float).eps if values[0] > 0 else np.zeros(dims, bool)
    keep = np.flatnonzero(real)[:components]
    vectors = vectors[:, keep]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(keep))]) if len(keep) else 1.0
    return Model(n, sums, values[keep], vectors * sign, float(np.trace(v)))


def whiten_distinct(distinct: DataFrame, model: Model, shift: int) -> DataFrame:
    """``key``, ``n``, ``deviation`` and ``whitened array<double>`` of every group."""
    n, sums = model.n, np.asarray(model.sums, object)
    apply = model.vectors / np.sqrt(model.values)

    def run(batches):
        for b in batches:
            x = _vectors(b.column("key").to_pylist())
            top = max(int(np.abs(x[x > np.iinfo(np.int64).min]).max(initial=0)), int(x.min() == np.iinfo(np.int64).min) << 63)
            wide = (top + abs(shift)) * n + int(max(map(abs, sums)))
            if wide < 1 << 62:
                far = (x + shift) * n - sums.astype(np.int64)
            else:
                far = (x.astype(object) + shift) * n - sums
            if wide < 1 << 62 and int(np.abs(far).max(initial=0)) ** 2 * far.shape[1] < 1 << 63:
                deviation = (far * far).sum(1).tolist()
            else:
                deviation = [sum(int(v) ** 2 for v in row) for row in far]
            mean_free = (far / n).astype(float)
            yield pa.record_batch([
                b.column("key"), b.column("n"), pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()),
                pa.array((mean_free @ apply).tolist(), pa.list_(pa.float64()))], names=["key", "n", "deviation", "whitened"])

    return distinct.select("key", "n").mapInArrow(run, "key binary, n long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, components: int, weights: str = "count") -> float:
    """Largest absolute entry of the covariance of ``whitened`` rows, minus the identity."""
    k = components

    def run(batches):
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            y = b.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, k)
            y = np.concatenate([y, np.ones((len(y), 1))], 1)
            total += (y * _weights(b, weights)[:, None].astype(float)).T @ y
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()] * (k + 1), pa.int32()), pa.array(range(k + 1), pa.int32()),
                               pa.array(total.tolist(), pa.list_(pa.float64()))], names=["task", "i", "row"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, row in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                sums[i] = sums.get(i, 0) + np.asarray(row)
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                                  names=["i", "row"])

    parts = whitened.select("n", "whitened").mapInArrow(run, "task int, i int, row array<double>")
    rows = parts.repartition("i").sortWithinPartitions("i", "task").mapInArrow(add, "i int, row array<double>").collect()
    sums = np.zeros((k + 1, k + 1))
    for r in rows:
        sums[r.i] = r.row
    n = sums[k, k]
    mean = sums[k, :k] / n
    return float(np.abs(sums[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 32,
           scale: float = 64.0, shift: int = 1_000_000, weights: str = "count") -> DataFrame:
    """One row per row of ``df`` that takes part and component.

    Columns: the id, ``component`` (from 1, by falling eigenvalue), ``n`` (weight of the fit list),
    ``deviation`` (squared distance of ``n`` times the vector from the sums), ``whitened``,
    ``explained`` (share of the whole variance) and ``identity_error`` (one value).
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = grid_keys(df, id_col, vec_col, scale)
    checkpoint_dir(spark)
    at = scratch_path(spark, "grid")
    rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).write.parquet(at)
    distinct = spark.read.parquet(at)
    model = fit(distinct, shift, components, weights)
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    at = scratch_path(spark, "whitened")
    whiten_distinct(distinct, model, shift).write.parquet(at)
    done = spark.read.parquet(at)
    error = identity_error(done, len(model.values), weights)
    copies = done.agg(F.sum("n")).first()[0]
    hot = F.broadcast(done.where(F.col("n") * HOT > copies).drop("n"))
    cold = done.where(F.col("n") * HOT <= copies).drop("n")
    joined = rows.join(hot, "key").unionByName(rows.join(hot.select("key"), "key", "left_anti").join(cold, "key"))
    share = F.array(*[F.lit(float(v)) for v in model.values / model.trace])
    return (joined.select("id", "deviation", F.posexplode("whitened").alias("c", "whitened"))
            .select(F.col("id").alias(id_col), (F.col("c") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", "whitened", F.get(share, F.col("c")).alias("explained"), F.lit(error).alias("identity_error")))
