"""Bounded samples of labelled documents and a small logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_out(doc_id, mod: int, rest: int):
    """crc32 of the id as text has this remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(False))


def training_labels(labels: DataFrame, label: str, mod: int, rest: int) -> DataFrame:
    """(doc_id, y): one row per id outside the held-out fold; ids with null or
    contradicting labels are left out."""
    y = F.col(label).cast("int")
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), y.alias("y")).where(
        "doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id"), mod, rest)).groupBy(
        "doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z")


def sample_ids(train: DataFrame, bounds: dict[int, int], seed: int) -> list[tuple[int, int, int]]:
    """At most ``bounds[y]`` ids of each label by a seeded hash order, with the
    rank of each: a bounded list, whatever the size of the table."""
    out = []
    for y, n in bounds.items():
        rows = train.where(F.col("y") == y).orderBy(
            F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(n).select("doc_id").collect()
        out += [(r.doc_id, y, k) for k, r in enumerate(rows)]
    return out


def sample_docs(docs: DataFrame, ids: list[tuple[int, int, int]], *keep: str) -> DataFrame:
    """The sampled documents (id list bounded, hence broadcast) with label and rank."""
    spark = docs.sparkSession
    s = spark.createDataFrame(ids or [], "doc_id long, y int, k int")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep).join(
        F.broadcast(s), "doc_id")


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3,
                 steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton fit of a weighted logistic model on standardised columns: (mean, std, beta)."""
    mean, std = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / std])
    b = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        g = z.T @ (weight * (p - y)) + ridge * b
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b -= step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return mean, std, b


def logistic(model, x: np.ndarray) -> np.ndarray:
    mean, std, b = model
    return 1 / (1 + np.exp(-np.clip(b[0] + ((x - mean) / std) @ b[1:], -30, 30)))
