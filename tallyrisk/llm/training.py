"""Bounded samples of labelled rows and small numpy helpers for the trained operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 30


def labelled_sample(rows: DataFrame, known: DataFrame, per_label: int, seed: int = 1) -> pd.DataFrame:
    """At most ``per_label`` rows (doc_id, text, label) of each label, chosen by a hash of doc_id.

    ``known``: labelled ids (doc_id, label), one row an id.  Label counts first,
    then the ids whose hash lies under their label's share; these (bounded by
    the parameter, so broadcast) fetch their texts in one scan of ``rows``.
    """
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(SLOTS))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.lit(-1)
    for label, n in sorted(counts.items()):
        cut = min(SLOTS, int(SLOTS * (per_label + 4 * per_label ** 0.5) / n) + 1)
        share = F.when(F.col("label") == F.lit(label), F.lit(cut)).otherwise(share)
    most = 2 * per_label * max(1, len(counts))
    ids = known.withColumn("place", place).filter(F.col("place") < share).limit(most).toPandas()
    ids = ids.sort_values(["label", "place", "doc_id"], kind="stable").groupby("label", sort=True).head(per_label)
    chosen = rows.sparkSession.createDataFrame(
        ids[["doc_id", "label"]].rename(columns={"doc_id": "id_r"}),
        f"id_r {known.schema['doc_id'].dataType.simpleString()}, label {known.schema['label'].dataType.simpleString()}")
    found = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("id_r")).select("doc_id", "text", "label")
    found = found.limit(most).toPandas()  # repeated ids can't make it longer
    return found.sort_values(["label", "doc_id", "text"], kind="stable", ignore_index=True)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """a, b of the calibrated probability sigmoid(a z + b): Newton steps on smoothed targets, a >= 0."""
    w = np.ones(len(z)) if weight is None else weight
    pos, neg = w[y == 1].sum(), w[y == 0].sum()
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    spread = max(float(z.std()), 1e-9)
    z = z / spread
    a, b = 1.0, float(np.log(pos / neg))
    for _ in range(60):
        p = sigmoid(a * z + b)
        g = np.array([(w * (p - target) * z).sum() + 1e-3 * a, (w * (p - target)).sum()])
        h = w * p * (1 - p) + 1e-9
        hessian = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-6]])
        da, db = np.clip(np.linalg.solve(hessian, g), -2, 2)
        a, b = max(a - da, 1e-3), b - db
    return a / spread, b


class Adam:
    def __init__(self, *params: np.ndarray, rate: float = 0.02):
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, *grads: np.ndarray) -> None:
        self.t += 1
        rate = self.rate * (1 - 0.999 ** self.t) ** 0.5 / (1 - 0.9 ** self.t)
        for p, g, m, v in zip(self.params, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * m / (np.sqrt(v) + 1e-8)


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over [bounds[i], bounds[i + 1]), 0 for empty ones."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]
