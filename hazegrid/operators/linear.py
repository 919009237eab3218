"""Least squares, ridge and lasso of all labels from one pass over the rows, for each key on its own if wanted.

What these learners need of the rows is the table of sums z'z of z = (1, features, labels). Tasks add it up batch by batch, so the sums
and not the rows are moved: one small table a task and key. The rest happens on tables as large as the schema, whatever the number of rows:
least squares and ridge by Cholesky factors (the smallest solution where columns depend on each other), lasso by
coordinate descent on the sums, for all labels side by side.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, functions as F

NAMES = ("Ridge", "Lasso", "LinearRegression")
RIDGE_ALPHA = 0.1
LASSO_ALPHA = 0.01
#: Tables of sums that a task holds at once; with more keys in turn, the oldest is handed on.
HELD = 32
#: Rounds over the features, and the largest change of a coefficient at which lasso rests.
LASSO_ROUNDS, LASSO_REST = 3000, 1e-10


@dataclass
class Plane:
    """Intercept and coefficients of one label over scaled features."""

    intercept: float
    coefficients: list[float]


def sums(rows: DataFrame, features: Sequence[str], labels: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(key, at, v): entries of z'z by place in its rows of 1 and the features; `key` is the keys as JSON.

    Rows with a missing feature or label are left out.
    """
    p, width = len(features) + 1, len(features) + len(labels) + 1
    schema = pa.schema([("key", pa.string()), ("at", pa.int32()), ("v", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def handed(key: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key] * (p * width)), pa.array(np.arange(p * width, dtype=np.int32)), pa.array(held.pop(key).ravel())], schema=schema)

        for batch in batches:
            z = np.ones((batch.num_rows, width))
            for k in range(width - 1):
                z[:, k + 1] = batch.column(k + 1).to_numpy(zero_copy_only=False)
            whole = ~np.isnan(z).any(axis=1)
            codes = batch.column(0).dictionary_encode()
            names, codes = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
            for code, key in enumerate(names):
                part = z[whole & (codes == code)]
                held[key] = held.pop(key, 0.0) + part[:, :p].T @ part
                if len(held) > HELD:
                    yield handed(next(iter(held)))
        for key in list(held):
            yield handed(key)

    key = F.to_json(F.struct(*keys)) if keys else F.lit("{}")
    bare = rows.select(key.alias("key"), *(F.col(c).cast("double").alias(f"z{i}") for i, c in enumerate([*features, *labels])))
    return bare.mapInArrow(run, "key string, at int, v double").groupBy("key", "at").agg(F.sum("v").alias("v"))


def _inverse_times(s: np.ndarray, b: np.ndarray) -> np.ndarray:
    try:
        low = np.linalg.cholesky(s)
        # A pivot lost to rounding means that columns depend on each other.
        if np.diag(low).min() > 1e-7 * np.sqrt(np.diag(s).max()):
            return np.linalg.solve(low.T, np.linalg.solve(low, b))
    except np.linalg.LinAlgError:
        pass
    return np.linalg.pinv(s, rcond=1e-12, hermitian=True) @ b


def solved(table: np.ndarray, learner: str) -> tuple[np.ndarray, np.ndarray]:
    """(intercepts, coefficients by feature and label) from the table of sums."""
    p = len(table)
    n, mean = table[0, 0], table[0] / table[0, 0]
    inner = table[1:, 1:] - n * np.outer(mean[1:p], mean[1:])
    s, b = inner[:, :p - 1], inner[:, p - 1:]
    if learner == "Lasso":
        w = np.zeros_like(b)
        for _ in range(LASSO_ROUNDS):
            most = 0.0
            for j in range(p - 1):
                if s[j, j] <= 0:
                    continue
                r = b[j] - s[j] @ w + s[j, j] * w[j]
                new = np.sign(r) * np.maximum(np.abs(r) - n * LASSO_ALPHA, 0.0) / s[j, j]
                most = max(most, float(np.abs(new - w[j]).max(initial=0.0)))
                w[j] = new
            if most <= LASSO_REST:
                break
    else:
        w = _inverse_times(s + (RIDGE_ALPHA if learner == "Ridge" else 0.0) * np.eye(p - 1), b)
    return mean[p:] - mean[1:p] @ w, w


def planes(rows: DataFrame, features: Sequence[str], labels: Sequence[str], names: Sequence[str] = NAMES, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., learner, label, n, intercept, coefficients): every learner for every label and key, from one pass over the rows."""
    p, width = len(features) + 1, len(features) + len(labels) + 1
    names, labels = list(names), list(labels)
    fields = "key string, learner string, label string, n long, intercept double, coefficients array<double>"
    schema = pa.schema([("key", pa.string()), ("learner", pa.string()), ("label", pa.string()), ("n", pa.int64()),
                        ("intercept", pa.float64()), ("coefficients", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, entries in zip(batch.column(0).to_pylist(), batch.column(1)):
                table = np.zeros(p * width)
                table[entries.values.field("at").to_numpy()] = entries.values.field("v").to_numpy()
                table = table.reshape(p, width)
                if not table[0, 0]:
                    continue  # no complete row
                out = []
                for name in names:
                    a, w = solved(table, name)
                    out += [(key, name, label, int(table[0, 0]), float(a[k]), w[:, k].tolist()) for k, label in enumerate(labels)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    # A table has as many entries as the schema decides.
    tables = sums(rows, features, labels, keys).groupBy("key").agg(F.collect_list(F.struct("at", "v")).alias("entries"))
    found = tables.mapInArrow(run, fields)
    if not keys:
        return found.drop("key")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    return found.withColumn("key", F.from_json("key", types)).select(*(F.col("key")[k].alias(k) for k in keys), "learner", "label", "n", "intercept", "coefficients")


def fit(rows: DataFrame, features: Sequence[str], labels: Sequence[str], names: Sequence[str] = NAMES) -> dict[tuple[str, str], Plane]:
    """Planes by (learner, label) over all rows: as many numbers as features times labels come to the driver."""
    return {(r["learner"], r["label"]): Plane(r["intercept"], list(r["coefficients"]))
            for r in planes(rows, features, labels, names).collect()}


def to_json(found: dict[str, Plane]) -> str:
    return json.dumps({t: [m.intercept, m.coefficients] for t, m in found.items()})


def from_json(text: str) -> dict[str, Plane]:
    return {t: Plane(*m) for t, m in json.loads(text).items()}


register_pickle_by_value(sys.modules[__name__])  # tasks get the functions themselves and needn't import them
