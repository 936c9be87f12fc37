"""Logistic regression by Newton steps, one aggregation over the rows each.

With d features a step needs (d + 1)(d + 2) + 1 sums, whatever the number of rows; they are added
up where the rows are, as matrix products of Arrow batches, and only the sums reach the driver, which
solves a system of d + 1 equations.
The objective is convex and has one optimum, which a few steps reach to machine precision, so a fit
does not depend on partitions, scaling or a seed. A model is its coefficients: scoring is an expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.session import ship_code

LOGISTIC = "logistic_regression"
PARAMS = "model_type string, features array<string>, intercept double, coefficients array<double>, max_iter int, penalty double"


def is_missing(feature: str) -> Column:
    value = F.col(feature).cast("double")
    return value.isNull() | F.isnan(value)


def any_missing(features: list[str]) -> Column:
    found = F.lit(False)
    for feature in features:
        found = found | is_missing(feature)
    return found


@dataclass
class LogisticModel:
    features: list[str]
    intercept: float
    coefficients: list[float]
    max_iter: int = 1000
    penalty: float = 1.0

    def decision(self) -> Column:
        total = F.lit(float(self.intercept))
        for feature, weight in zip(self.features, self.coefficients):
            total = total + F.lit(float(weight)) * F.col(feature).cast("double")
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``predicted_label`` and ``spike_probability``; a missing feature is an error."""
        checked = F.when(any_missing(self.features), F.raise_error(F.lit("a feature is missing"))).otherwise(self.decision())
        return df.withColumns(
            {"predicted_label": (checked > 0).cast("int"), "spike_probability": 1.0 / (1.0 + F.exp(-checked))}
        )

    def importance(self) -> list[tuple[str, float]]:
        return list(zip(self.features, self.coefficients))

    def logged(self) -> dict[str, str]:
        return {"max_iter": str(self.max_iter), "reg_param": repr(self.penalty), "elastic_net": "0.0"}

    def save(self, path: str, spark: SparkSession) -> None:
        row = (LOGISTIC, self.features, float(self.intercept), [float(c) for c in self.coefficients], self.max_iter, float(self.penalty))
        spark.createDataFrame([row], PARAMS).coalesce(1).write.mode("overwrite").parquet(f"{path}/params")

    @classmethod
    def load(cls, params) -> "LogisticModel":
        return cls(list(params["features"]), params["intercept"], list(params["coefficients"]), params["max_iter"], params["penalty"])


def _partial_sums(beta: np.ndarray, names: list[str]):
    """A task's loss, gradient and second derivatives at ``beta``, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(beta)
        total = np.zeros(len(names))
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            x = np.stack([np.ones(batch.num_rows), *columns[: size - 1]])
            y, weight = columns[-2:]
            margin = beta @ x
            wrong = (1 - 2 * y) * margin
            p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            total[0] += weight @ (np.maximum(wrong, 0) + np.log1p(np.exp(-np.abs(wrong))))
            total[1 : 1 + size] += x @ (weight * (p - y))
            total[1 + size :] += ((x * (weight * p * (1 - p))) @ x.T).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([value]) for value in total], names=names)

    return run


def newton_fit(
    rows: DataFrame, features: list[str], label: str, weight: Column, penalty: float = 1.0, max_iter: int = 1000
) -> LogisticModel:
    """Least sum of ``weight`` times the log-loss plus ``penalty`` / 2 times the squared coefficients;
    the intercept is free. A step that does not lower the objective is halved."""
    ship_code(rows.sparkSession)
    size = len(features) + 1
    shrink = np.diag([0.0] + [penalty] * len(features))
    names = [f"s{i}" for i in range(1 + size + size * size)]
    schema = ", ".join(f"{name} double" for name in names)
    wanted = rows.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("y"), weight.alias("w"))

    def sums(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        found = np.array(wanted.mapInArrow(_partial_sums(beta, names), schema).agg(*[F.sum(name) for name in names]).first())
        gradient, hessian = found[1 : 1 + size], found[1 + size :].reshape(size, size)
        return found[0] + 0.5 * beta @ shrink @ beta, gradient + shrink @ beta, hessian + shrink

    beta = np.zeros(size)
    loss, gradient, hessian = sums(beta)
    for _ in range(max_iter):
        step = np.linalg.solve(hessian, gradient)
        if gradient @ step <= 1e-14 * max(1.0, loss):
            beta = beta - step  # convergence is quadratic, so this one is exact
            break
        for _ in range(40):
            after = sums(beta - step)
            if after[0] <= loss * (1 + 1e-14):
                break
            step = step / 2
        else:
            break
        beta = beta - step
        loss, gradient, hessian = after
    return LogisticModel(list(features), float(beta[0]), [float(b) for b in beta[1:]], max_iter, penalty)
