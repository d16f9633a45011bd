"""Whitening of embeddings over their distinct vectors.

Vectors are put on an integer grid, so that equal ones can be grouped.  Each distinct grid vector is fitted once, with one
or with its number of rows as its weight: a pass for the weighted sums, a pass for the covariance of what is centred on
them, a pass that projects.  The rows get the result of their vector by a join.  Tasks hand on sums (one vector or one matrix
each); the driver holds one matrix of the dimension squared and its eigenvectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import join_unique
from loomspark.plans.scratch import written

#: Steps of the grid in a unit, and the whole number that is added to a step.
GRID = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Grid values stay within what a long holds.
FAR = 9.0e18
#: Rows of a batch that is multiplied at once.
BATCH = 4096
EPS = np.finfo(np.float64).eps

EXACT = (1 << 62) - 1


def usable(vec: Column) -> Column:
    """A vector that is not null and has only finite entries."""
    return vec.isNotNull() & F.forall(vec, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))


def grid(vec: Column) -> Column:
    """Each entry as a long on the grid."""
    step = lambda c: F.floor(F.greatest(F.least(c.cast("double") * GRID, F.lit(FAR)), F.lit(-FAR)))
    return F.transform(vec, lambda c: step(c).cast("long") + OFFSET)


def _matrices(batches, vec: int, weight: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch, np.ndarray]]:
    """(vectors of one length, their weights, the batch, places in it), for every length in every batch."""
    for batch in batches:
        column = batch.column(vec)
        sizes = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        weights = np.ones(len(sizes), np.int64) if weight is None else batch.column(weight).to_numpy(zero_copy_only=False)
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            yield flat[(starts[at][:, None] + np.arange(dim)[None, :])], weights[at], batch, at


def _tree(partials: DataFrame, add: Callable[[list, list], list], schema: str) -> list:
    """One row for each dim: rows of tasks are added up in about a square root of them before the driver adds the rest."""

    def run(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                sums[row[0]] = add(sums[row[0]], list(row[1:])) if row[0] in sums else list(row[1:])
        for dim, rest in sums.items():
            yield pa.RecordBatch.from_pylist([dict(zip(names, (dim, *rest)))], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    names = arrow.names
    few = max(1, math.isqrt(partials.rdd.getNumPartitions()))
    sums: dict[int, list] = {}
    for row in partials.repartition(few).mapInArrow(run, schema).collect():
        rest = list(row)[1:]
        sums[row[0]] = add(sums[row[0]], rest) if row[0] in sums else rest
    return sorted((dim, *rest) for dim, rest in sums.items())


def sums(vectors: DataFrame, vec: str, weight: str | None = None) -> dict[int, tuple[int, list]]:
    """For each length: the total weight and the weighted sum of each dimension; whole numbers are added exactly."""
    whole = vectors.schema[vec].dataType.elementType.typeName() == "long"

    def run(batches):
        totals: dict[int, list] = {}
        for x, w, _, _ in _matrices(batches, 0, None if weight is None else 1):
            dim = x.shape[1]
            top = int(np.abs(x).max(initial=0)) * int(w.sum()) if whole else 0
            s = [int(v) for v in (w[:, None] * x).sum(axis=0)] if whole and top <= EXACT else list((x.astype(object) * w.astype(object)[:, None]).sum(axis=0)) if whole else [float(v) for v in w @ x]
            old = totals.get(dim, [0, [0] * dim])
            totals[dim] = [old[0] + int(w.sum()), [a + b for a, b in zip(old[1], s)]]
        for dim, (n, s) in totals.items():
            yield pa.RecordBatch.from_pylist([{"dim": dim, "n": n, "s": [str(v) if whole else repr(v) for v in s]}], schema=pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.string()))]))

    number = int if whole else float
    text = str if whole else repr

    def add(a, b):
        return [a[0] + b[0], [text(number(x) + number(y)) for x, y in zip(a[1], b[1])]]

    schema = "dim int, n long, s array<string>"
    narrow = vectors.select(vec, *([weight] if weight else []))
    return {dim: (n, [number(v) for v in s]) for dim, n, s in _tree(narrow.mapInArrow(run, schema), add, schema)}


def _centred(x: np.ndarray, n: int, s: list) -> np.ndarray:
    """x - s / n in doubles; the difference of whole numbers is taken before the division."""
    if x.dtype.kind == "i":
        if n * int(np.abs(x).max(initial=0)) + max(map(abs, s), default=0) <= EXACT:
            return (n * x - np.array(s, np.int64)[None, :]) / n
        return ((n * x.astype(object) - np.array(s, object)[None, :]) / n).astype(np.float64)
    return x - np.array(s, np.float64)[None, :] / n


def covariance(vectors: DataFrame, vec: str, fit: dict[int, tuple[int, list]], weight: str | None = None) -> dict[int, np.ndarray]:
    """For each length: the weighted covariance of the vectors around their mean, divided by the total weight."""

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for x, w, _, _ in _matrices(batches, 0, None if weight is None else 1):
            dim = x.shape[1]
            total = totals.setdefault(dim, np.zeros((dim, dim)))
            for k in range(0, len(x), BATCH):
                c = _centred(x[k : k + BATCH], *fit[dim])
                total += (c * w[k : k + BATCH, None]).T @ c
        for dim, total in totals.items():
            yield pa.RecordBatch.from_pylist([{"dim": dim, "v": total.astype("<f8").tobytes()}], schema=pa.schema([("dim", pa.int32()), ("v", pa.binary())]))

    def add(a, b):
        return [(np.frombuffer(a[0], "<f8") + np.frombuffer(b[0], "<f8")).tobytes()]

    schema = "dim int, v binary"
    narrow = vectors.select(vec, *([weight] if weight else []))
    return {dim: np.frombuffer(v, "<f8").reshape(dim, dim) / fit[dim][0] for dim, v in _tree(narrow.mapInArrow(run, schema), add, schema)}


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvectors as columns, eigenvalues falling, trace) of a covariance; the largest entry of each vector is positive."""
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    values, vectors = values[order], vectors[:, order]
    if vectors.size:
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)[None, :]
    return vectors, np.maximum(values, 0.0), float(np.trace(v))


def _deviations(x: np.ndarray, n: int, s: list) -> list[int]:
    """The exact sum over dimensions of (n * x - s) squared."""
    top = n * int(np.abs(x).max(initial=0)) + max(map(abs, s), default=0)
    if top <= EXACT:
        d = n * x - np.array(s, np.int64)[None, :]
        if max(1, x.shape[1]) * int(np.abs(d).max(initial=0)) ** 2 <= EXACT:
            return [int(v) for v in (d * d).sum(axis=1)]
    d = n * x.astype(object) - np.array(s, object)[None, :]
    return [int(v) for v in (d * d).sum(axis=1)]


def whiten(vectors: DataFrame, vec: str = "embedding", vec_id: str = "vec_id", most: int = COMPONENTS, weighted: bool = False) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for each usable row and component.

    ``weighted`` fits each distinct vector with its number of rows instead of one; n is the total weight of the fit.
    deviation is null where a long does not hold it.  A component without variance (fewer distinct vectors than
    dimensions, or one vector) has a null whitened and counts as no part of the identity.  Vectors that are null
    or hold null, NaN or infinite entries are dropped; empty vectors have no component and so no row; vectors of another length are
    a space of their own, fitted apart; rows that repeat and null ids stay; an empty table gives an empty table;
    other columns are not read.  Grid entries beyond 9e18 are held there.  Vectors meet by two 64-bit hashes of the grid vector.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).alias("vec")).filter(usable(F.col("vec"))).select("vec_id", grid(F.col("vec")).alias("x"))
    key = [F.xxhash64("x").alias("k1"), F.xxhash64(F.lit(1), "x").alias("k2")]
    distinct = written(rows.groupBy("x").agg(F.count(F.lit(1)).alias("weight")).select(*key, "x", "weight"), "distinct-vectors")
    weight = "weight" if weighted else None
    fit = {dim: f for dim, f in sums(distinct, "x", weight).items() if dim}
    spectra = {dim: components(v, most) for dim, v in covariance(distinct.filter(F.size("x") > 0), "x", fit, weight).items()}

    def project(batches):
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("weight", pa.int64()), ("dim", pa.int32()), ("deviation", pa.int64()), ("white", pa.list_(pa.float64()))])
        for x, _, batch, at in _matrices(batches, 2, None):
            dim = x.shape[1]
            if not dim:
                continue
            basis, values, trace = spectra[dim]
            alive = values > trace * dim * EPS
            white = (_centred(x, *fit[dim]) @ basis[:, alive]) / np.sqrt(values[alive])[None, :]
            off = [d if d < 1 << 63 else None for d in _deviations(x, *fit[dim])]
            picked = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1), picked.column(3), pa.array([dim] * len(at), pa.int32()), pa.array(off, pa.int64()), pa.array(list(white), pa.list_(pa.float64()))], schema=schema)

    white = written(distinct.mapInArrow(project, "k1 long, k2 long, weight long, dim int, deviation long, white array<double>"), "whitened")
    facts = _facts(white, spectra, fit, weight)
    narrow = written(rows.filter(F.size("x") > 0).select("vec_id", *key), "vector-keys")
    met = join_unique(narrow, white.drop("weight"), ["k1", "k2"], "hot-vectors")
    spark = vectors.sparkSession
    table = spark.createDataFrame(facts, "dim int, n long, parts array<struct<component:int,explained:double>>, identity_error double")
    each = met.join(F.broadcast(table), "dim").select("vec_id", "n", "deviation", "white", "identity_error", F.explode("parts").alias("p"))  # a row for each length
    return each.select("vec_id", "p.component", "n", "deviation", F.get("white", F.col("p.component") - 1).alias("whitened"), "p.explained", "identity_error")


def _facts(white: DataFrame, spectra: dict, fit: dict, weight: str | None) -> list[tuple]:
    """(dim, n, component and explained share of each, identity_error); the error is that of the projected vectors themselves."""
    out = []
    for dim, (_, values, trace) in spectra.items():
        own = white.filter(F.col("dim") == dim)
        alive = int((values > trace * dim * EPS).sum())
        error = None
        if alive:
            v = covariance(own, "white", sums(own, "white", weight), weight)[alive]
            error = float(np.abs(v - np.eye(alive)).max())
        parts = [(k + 1, float(e) / trace if trace > 0 else None) for k, e in enumerate(values)]
        out.append((int(dim), int(fit[dim][0]), parts, error))
    return out
