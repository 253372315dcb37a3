"""L2-regularised logistic regression by Newton's method.

The objective is that of the blueprint: half the squared norm of the coefficients (not of the intercept) plus the
weighted log loss.  A step needs the gradient and the weighted Gram matrix of the features, and both are sums over
rows: every task multiplies its rows in blocks, the tasks' matrices are added up row by row in a shuffle, and the
driver solves one system of as many unknowns as there are features.  Few passes over the data are enough, and the
norm of the last gradient certifies the fit.  What a task holds, and what is shuffled, depends on the number of
features, not of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rows multiplied at once
BLOCK = 4096
DENSE = 1


@dataclass
class Logistic:
    """A fit: ``gradient_norm`` is that of the objective divided by the sum of weights."""

    coefficients: np.ndarray
    intercept: float
    gradient_norm: float
    passes: int

    def margin(self, features: str) -> Column:
        """Intercept and coefficients applied to a vector column."""
        coef = F.array(*[F.lit(float(c)) for c in self.coefficients])
        u = F.unwrap_udt(features)
        sparse = F.zip_with(u["indices"], u["values"], lambda i, v: v * F.element_at(coef, i + 1))
        dense = F.zip_with(u["values"], coef, lambda v, c: v * c)
        terms = F.when(u["type"] == DENSE, dense).otherwise(sparse)
        return F.lit(float(self.intercept)) + F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)

    def score(self, features: str) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(features)))


def _flat(train: DataFrame, label: str, weight: str) -> DataFrame:
    u = F.unwrap_udt("features")
    return train.select(u["type"].alias("kind"), u["indices"].alias("at"), u["values"].alias("v"),
                        F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The rows' features and a 1 for the intercept."""
    x = np.zeros((batch.num_rows, width + 1))
    x[:, width] = 1
    dense = batch.column(0).to_numpy(zero_copy_only=False) == DENSE
    for rows, sparse in ((np.flatnonzero(~dense), True), (np.flatnonzero(dense), False)):
        if len(rows):
            values = batch.column(2).take(pa.array(rows))
            size = np.diff(values.offsets.to_numpy())
            flat = values.flatten().to_numpy(zero_copy_only=False)
            at = (batch.column(1).take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False) if sparse
                  else np.tile(np.arange(width), len(rows)))
            x[np.repeat(rows, size), at] = flat
    return x


def _sums(flat: DataFrame, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(Gram matrix, gradient, loss, sum of weights) of all rows at ``beta``, without the penalty."""
    width, across = len(beta) - 1, max(len(beta), 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 3, across))  # the matrix, the gradient, and (loss, weights, ...)
        for batch in batches:
            for s in range(0, batch.num_rows, BLOCK):
                b = batch.slice(s, BLOCK)
                x = _matrix(b, width)
                y, w = (b.column(k).to_numpy(zero_copy_only=False) for k in (3, 4))
                z = x @ beta
                p = np.exp(-np.logaddexp(0, -z))
                total[:width + 1, :width + 1] += (x * (w * p * (1 - p))[:, None]).T @ x
                total[width + 1, :width + 1] += x.T @ (w * (p - y))
                total[width + 2, :2] += (w * (np.logaddexp(0, z) - y * z)).sum(), w.sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width + 3), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(part)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(
                [x.tobytes() for x in sums.values()], pa.binary())], ["i", "part"])

    schema = "i int, part binary"
    found = flat.mapInArrow(run, schema).repartition("i").mapInArrow(add, schema).collect()  # a row for each feature
    total = np.zeros((width + 3, across))
    for r in found:
        total[r["i"]] = np.frombuffer(r["part"])
    return total[:width + 1, :width + 1], total[width + 1, :width + 1], float(total[width + 2, 0]), float(total[width + 2, 1])


def fit(train: DataFrame, label: str, weight: str, max_steps: int = 100, tolerance: float = 1e-10) -> Logistic:
    """The minimum for ``train`` (features, label, weight), which is read once a step: stage it first.

    Steps end when the gradient's norm, divided by the sum of weights, is below ``tolerance``, or when rounding
    keeps the objective from falling.  A table without rows gives zeros.
    """
    flat = _flat(train, label, weight)
    size = F.unwrap_udt("features")
    first = train.select(F.coalesce(size["size"], F.size(size["values"])).alias("n")).first()
    if first is None:
        return Logistic(np.zeros(0), 0.0, 0.0, 0)
    width = first["n"]
    ridge = np.append(np.ones(width), 0.0)
    beta, passes = np.zeros(width + 1), 1

    def at(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
        gram, gradient, loss, weights = _sums(flat, b)
        return gram + np.diag(ridge), gradient + ridge * b, loss + 0.5 * float(ridge @ (b * b)), weights

    gram, gradient, value, weights = at(beta)
    while passes <= max_steps and np.linalg.norm(gradient) > tolerance * weights:
        step, length = np.linalg.solve(gram, gradient), 1.0
        while True:
            tried = at(beta - length * step)
            passes += 1
            if tried[2] <= value or length < 1e-6 or passes > max_steps:
                break
            length /= 2
        if tried[2] > value or np.linalg.norm(tried[1]) >= np.linalg.norm(gradient) and tried[2] >= value:
            break
        beta = beta - length * step
        gram, gradient, value, weights = tried
    return Logistic(beta[:-1], float(beta[-1]), float(np.linalg.norm(gradient)) / weights, passes)


def gradient(train: DataFrame, model: Logistic, label: str, weight: str) -> DataFrame:
    """(i, gradient) of the objective at the fit, divided by the sum of weights: computed by joins and sums of its
    own, as a check on the fit.  The intercept's place is the number of features."""
    u = F.unwrap_udt("features")
    off = (F.col(weight) * (model.score("features") - F.col(label))).alias("off")
    rows = train.select(u.alias("u"), off, F.col(weight).alias("w"))
    dense = F.col("u.type") == DENSE
    at = F.when(dense, F.sequence(F.lit(0), F.size("u.values") - 1)).otherwise(F.col("u.indices"))
    entries = rows.select(F.explode(F.arrays_zip(at.alias("at"), F.col("u.values").alias("v"))).alias("e"), "off")
    sums = entries.groupBy(F.col("e.at").alias("i")).agg(F.sum(F.col("off") * F.col("e.v")).alias("s"))
    total = rows.agg(F.sum("w").alias("total"), F.sum("off").alias("s"))
    coef = train.sparkSession.createDataFrame([(i, float(c)) for i, c in enumerate(model.coefficients)], "i int, c double")
    own = coef.join(sums, "i", "left").crossJoin(total.select("total")).select(
        "i", ((F.coalesce("s", F.lit(0.0)) + F.col("c")) / F.col("total")).alias("gradient"))
    return own.unionByName(total.select(F.lit(len(model.coefficients)).alias("i"), (F.col("s") / F.col("total")).alias("gradient")))
