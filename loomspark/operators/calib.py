"""Calibration statistics of activations, and direction vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.operators.vectors import dense_sums, normalize, pool_mean
from loomspark.plans.bounds import checked, require
from loomspark.plans.scratch import written

MIN_ROWS = 16
NEAR_ZERO = 1e-6


def tensor_name(col) -> Column:
    """What stands between the first two ``#``, or behind the only one; a name without any is kept."""
    c = F.col(col) if isinstance(col, str) else col
    parts = F.split(c, "#", -1)
    rest = F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), "#")
    return F.when(F.size(parts) == 1, c).when(F.size(parts) == 2, rest).otherwise(F.get(parts, F.lit(1)))


def select_activations(df: DataFrame, *, process_output: bool = False) -> DataFrame:
    """Products worth counting: ``(tensor, op, n_rows, dtype)``; expert products always, plain ones by size, type and name."""
    wanted = F.startswith("tensor", F.lit("blk."))
    if process_output:
        wanted = wanted | (F.col("tensor") == "output.weight")
    plain = (F.col("op") == "MUL_MAT") & (F.col("n_rows") >= MIN_ROWS) & (F.col("dtype") == "F32") & wanted
    return df.filter((F.col("op") == "MUL_MAT_ID") | plain)


def importance_sums(df: DataFrame) -> DataFrame:
    """``(tensor, expert, col, sum_sq, cnt)`` of rows ``(tensor, expert, row, col, x)``."""
    return df.groupBy("tensor", "expert", "col").agg(F.sum(F.col("x") * F.col("x")).alias("sum_sq"), F.count("*").alias("cnt"))


def importance_sums_dense(df: DataFrame, *, vec: str = "vec") -> DataFrame:
    """The same for one vector per row; each task adds its vectors up before anything is shuffled."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict = {}
        for pdf in batches:
            for key, part in pdf.groupby(["tensor", "expert"]):
                x = np.stack(part[vec].to_numpy()).astype(np.float64)
                s, n = acc.get(key, (0.0, 0))
                acc[key] = (s + (x * x).sum(axis=0), n + len(x))
        for (tensor, expert), (s, n) in acc.items():
            yield pd.DataFrame({"tensor": tensor, "expert": expert, "col": np.arange(len(s)), "s": s, "n": n})

    sums = df.select("tensor", "expert", vec).mapInPandas(partial, "tensor string, expert int, col int, s double, n long")
    return sums.groupBy("tensor", "expert", "col").agg(F.sum("s").alias("sum_sq"), F.sum("n").alias("cnt"))


def assert_finite(sums: DataFrame) -> DataFrame:
    bad = F.isnan("sum_sq") | (F.abs("sum_sq") == float("inf"))
    return checked(sums, bad, "a sum is not finite")


def assert_dims(df: DataFrame, *, tensor: str = "tensor", dim: str = "dim") -> DataFrame:
    """Fail when calls on one tensor disagree about its width."""
    spread = df.groupBy(tensor).agg(F.min(dim).alias("lo"), F.max(dim).alias("hi"))
    require(spread, F.col("lo") != F.col("hi"), "a tensor was seen with two sizes")
    return df


def importance(sums: DataFrame, ncall: DataFrame) -> DataFrame:
    """``(tensor, expert, col, value)`` with value = sum / count * calls; tensors with an empty column are left out."""
    whole = sums.groupBy("tensor").agg(F.min("cnt").alias("least")).filter(F.col("least") > 0).select("tensor")
    rows = sums.join(whole, "tensor", "left_semi").join(ncall, "tensor")
    return rows.select("tensor", "expert", "col", (F.col("sum_sq") / F.col("cnt") * F.col("ncall")).alias("value"))


def importance_coverage(sums: DataFrame) -> DataFrame:
    """Per tensor: columns, empty columns, percent with data."""
    s = sums.groupBy("tensor").agg(F.count("*").alias("n"), F.count_if(F.col("cnt") == 0).alias("empty"))
    return s.withColumn("pct", 100.0 * (F.col("n") - F.col("empty")) / F.col("n"))


def importance_merge(*files: DataFrame) -> DataFrame:
    """Add values, counts and calls of ``(tensor, expert, col, value, cnt, ncall)`` files.

    A file's values count as many times as it was called.
    """
    out = files[0]
    for f in files[1:]:
        out = out.unionByName(f)
    return out.groupBy("tensor", "expert", "col").agg(F.sum("value").alias("value"), F.sum("ncall").alias("cnt"), F.sum("ncall").alias("ncall"))


# ------------------------------------------------------------------ directions


def diff_rows(pos: DataFrame, neg: DataFrame, *, strict: bool = True) -> DataFrame:
    """``(layer, pos, vec)``: positive minus negative activations, the last layer and zero rows left out.

    Without ``strict`` only values above the threshold count, so an all-negative row is a zero row.
    """
    last = pos.agg(F.max("layer")).first()[0]
    rows = pos.join(neg.withColumnRenamed("vec", "other"), ["layer", "pos"]).filter(F.col("layer") < last)
    diff = rows.select("layer", "pos", F.zip_with("vec", "other", lambda a, b: a - b).alias("vec"))
    big = (lambda x: F.abs(x) > NEAR_ZERO) if strict else (lambda x: x > NEAR_ZERO)
    return diff.filter(F.exists("vec", big))


def direction_mean(rows: DataFrame) -> DataFrame:
    """Unit mean direction of each layer."""
    return pool_mean(rows, seq="layer", vec="vec").select("layer", normalize("vec", 2).alias("vec"))


def _products(rows: DataFrame, directions: dict) -> dict:
    """``X'(Xv)`` of each layer's rows and its direction ``v``: a task hands on one vector for each of its layers."""
    kind = rows.schema["layer"].dataType.simpleString()

    def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for pdf in batches:
            for layer, part in pdf.groupby("layer"):
                if layer in directions:
                    x = np.stack(part["vec"].to_numpy()).astype(np.float64)
                    sums[layer] = sums.get(layer, 0.0) + x.T @ (x @ directions[layer])
        if sums:
            yield pd.DataFrame({"layer": list(sums), "vec": list(sums.values())})

    parts = rows.mapInPandas(product, f"layer {kind}, vec array<double>")
    return {r["layer"]: np.array(r["s"]) for r in dense_sums(parts, "layer", "vec").collect()}  # a vector for each layer


class _Krylov:
    """The space that a layer's products span, and the direction in it that its matrix stretches most."""

    def __init__(self, width: int):
        v = np.ones(width) / np.sqrt(width) + np.arange(width) * 1e-3
        self.basis, self.images = [v / np.linalg.norm(v)], []

    def take(self, image: np.ndarray, tol: float) -> np.ndarray | None:
        """The direction if it is exact enough, else nothing, and the basis has one vector more."""
        self.images.append(image)
        q, w = np.array(self.basis), np.array(self.images)
        small = q @ w.T
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        y = vectors[:, -1]
        best, left = y @ q, y @ w - values[-1] * (y @ q)
        rest = image.copy()
        for _ in range(2):  # once is not enough where the rest is small
            rest -= q.T @ (q @ rest)
        size = np.linalg.norm(rest)
        if np.linalg.norm(left) <= tol * max(values[-1], 0.0) or size <= 1e-13 * max(np.linalg.norm(image), 1e-300):
            return best / np.linalg.norm(best)
        if len(self.basis) == BASIS:  # begin again from the best direction so far
            self.basis, self.images = [best / np.linalg.norm(best)], []
        else:
            self.basis.append(rest / size)
        return None


#: Products of a layer that are kept before its search begins again from the best direction.
BASIS = 40


def direction_pca(rows: DataFrame, *, iters: int = 1000, tol: float = 1e-7) -> DataFrame:
    """``(layer, vec)``: first principal direction of each layer, not centred; its largest component is positive.

    No matrix is built: a round is ``X'(Xv)``, added up by the tasks, so a layer's width only sets the length of a vector.
    The driver keeps up to ``BASIS`` vectors of each layer and picks the next ``v`` of all of them; a layer is done when
    its direction's image is the direction again, up to ``tol``.  A layer of zero rows keeps the direction it began with.
    """
    spark = rows.sparkSession
    kind = rows.schema["layer"].dataType.simpleString()
    table = written(rows.select("layer", "vec"), "directions")
    widths = table.groupBy("layer").agg(F.max(F.size("vec")).alias("width")).collect()  # a row for each layer
    open_layers = {r["layer"]: _Krylov(r["width"]) for r in widths if r["width"] > 0}
    found = {}
    for _ in range(iters):
        if not open_layers:
            break
        images = _products(table, {layer: k.basis[-1] for layer, k in open_layers.items()})
        for layer, image in images.items():
            v = open_layers[layer].take(image, tol)
            if v is not None:
                found[layer] = v
                del open_layers[layer]
    found |= {layer: k.basis[0] for layer, k in open_layers.items()}
    signed = [(layer, [float(x) for x in v * (np.sign(v[np.abs(v).argmax()]) or 1.0)]) for layer, v in sorted(found.items())]
    return spark.createDataFrame(signed, f"layer {kind}, vec array<double>")


def combine_directions(df: DataFrame) -> DataFrame:
    """``(layer, vec)``: sum of strength * vector over ``(file, name, vec, strength)``; names are ``direction.<layer>``."""
    layer = F.try_to_number(F.regexp_extract("name", r"^direction\.(\d+)$", 1), F.lit("999999999")).cast("int")
    rows = df.withColumn("layer", F.when(F.col("name").rlike(r"^direction\.\d+$"), layer))
    rows = checked(rows, F.col("layer").isNull() | (F.col("layer") < 1), "a direction must be named direction.<layer>, layer at least 1")
    width = rows.agg(F.min(F.size("vec")).alias("lo"), F.max(F.size("vec")).alias("hi")).first()
    if width.lo != width.hi:
        raise ValueError("directions have different lengths")
    dims = rows.select("layer", "strength", F.posexplode("vec").alias("dim", "x"))
    summed = dims.groupBy("layer", "dim").agg(F.sum(F.col("strength") * F.col("x")).alias("x"))
    grouped = summed.groupBy("layer").agg(F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("s"))
    return grouped.select("layer", F.transform("s", lambda e: e["x"]).alias("vec"))


def tensor_sums(df: DataFrame, *, x: str = "x") -> DataFrame:
    return df.groupBy("tensor").agg(F.sum(x).alias("total"), F.count(x).alias("n"))
