"""C11: a margin classifier with a Gaussian kernel by landmarks (Nystroem).

``n_landmarks`` rows, a documented bound, are drawn by the hash of their id;
features are the kernel values to them times the inverse root of the
landmarks' own kernel matrix, so inner products of features approximate the
kernel.  What is lost is measured on all rows: the residual of the kernel
matrix is positive semidefinite, and its mean diagonal is 1 - mean |z|^2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.evaluate import hash_unit


def gaussian(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(d2, 0))


class KernelFeatures:
    """Landmarks, their scaling and the map from kernel values to features."""

    def __init__(self, landmarks: np.ndarray, gamma: float, mean: np.ndarray, scale: np.ndarray):
        self.mean, self.scale, self.gamma = mean, scale, gamma
        self.landmarks = (landmarks - mean) / scale
        value, vector = np.linalg.eigh(gaussian(self.landmarks, self.landmarks, gamma))
        keep = value > 1e-10 * value.max()  # equal landmarks add nothing
        self.map = vector[:, keep] / np.sqrt(value[keep])

    def of(self, x: np.ndarray) -> np.ndarray:
        return gaussian((x - self.mean) / self.scale, self.landmarks, self.gamma) @ self.map

    def transform(self, df: DataFrame, vec: str, out: str = "kernel") -> DataFrame:
        """Adds the features as a vector; rows with a null or non-finite ``vec`` are left out."""
        v = F.col(vec).cast("array<double>")
        rows = df.where(_finite(vec)).withColumn("_x", v)
        fitted, dim = self, len(self.mean)

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)
                z = fitted.of(x)
                ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * z.shape[1])
                z = pa.ListArray.from_arrays(ends, pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], z], names=[*b.schema.names[:-1], "_z"])
        schema = T.StructType([*rows.schema.fields[:-1], T.StructField("_z", T.ArrayType(T.DoubleType()))])
        done = rows.mapInArrow(step, schema)
        return done.select(*df.columns, array_to_vector("_z").alias(out), "_z")

    def kernel_error(self, df: DataFrame, vec: str) -> float:
        """Mean over all rows of 1 - |z|^2: 0 if the features give the kernel exactly, 1 at worst."""
        square = F.aggregate("_z", F.lit(0.0), lambda a, z: a + z * z)
        return self.transform(df, vec).agg(F.avg(1 - square)).first()[0]


def _finite(vec: str):
    v = F.col(vec).cast("array<double>")
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def fit_kernel_features(df: DataFrame, id_col: str, vec: str, n_landmarks: int = 64, gamma: float = 0.7,
                        seed: int = 7) -> KernelFeatures:
    """Scale by all rows, draw the landmarks by hashed id (ties by id); all rows are landmarks if they are fewer."""
    rows = df.where(_finite(vec)).select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("x"))
    drawn = rows.orderBy(hash_unit("id", seed=seed), "id").limit(n_landmarks).collect()
    if not drawn:
        raise ValueError("no rows to draw landmarks from")
    slot = [F.get("x", F.lit(i)) for i in range(len(drawn[0]["x"]))]
    stat = rows.agg(*[F.avg(s) for s in slot], *[F.stddev_pop(s) for s in slot]).first()
    mean, scale = np.array(stat[:len(slot)]), np.array(stat[len(slot):])
    scale[scale == 0] = 1.0
    return KernelFeatures(np.array([r["x"] for r in drawn]), gamma, mean, scale)
