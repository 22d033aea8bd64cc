"""Tensor sketch of the polynomial kernel (M3): (scale <x, y> + 1)^degree as an inner product.

A feature vector, with a constant 1 appended, is hashed into ``width`` signed sums
(a count sketch) once per degree; the circular convolution of these sketches, a
product under the Fourier transform, is a sketch of the vector's tensor power
(Pham and Pagh 2013). Its inner products have the kernel as expectation and a mean
squared error of at most (2 + 3^degree) / width * k(x, x) k(y, y), so the width does not
grow with the features, where the full expansion has their number to the power
of the degree. Hashes come from (seed, feature number): nothing is stored, and a
sparse vector is read through its non-zero slots.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .base import Fitted, Step, register
from .sparse import cells_of, lists, nonzero

WIDTH = 1024
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _hashes(ids: np.ndarray, seed: int) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(1)) * _ODD + np.uint64((seed * 2654435761 + 97) % (1 << 63))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def tensor_sketch(row: np.ndarray, ids: np.ndarray, x: np.ndarray, n: int, width: int, degree: int, scale: float, seed: int) -> np.ndarray:
    """Sketches of ``n`` rows given by their cells (row, feature number, value)."""
    out = np.ones((n, width // 2 + 1), dtype=complex)
    value = x * math.sqrt(scale)
    for d in range(degree):
        h = _hashes(np.append(ids, -1).astype(np.int64), seed * 31 + d)        # the constant's number is -1
        place = (h % np.uint64(width)).astype(np.int64)
        sign = np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
        sums = np.bincount(row * width + place[:-1], value * sign[:-1], n * width).astype(float).reshape(n, width)
        sums[:, place[-1]] += sign[-1]
        out *= np.fft.rfft(sums, axis=1)
    return np.fft.irfft(out, width, axis=1)


@register
class FittedTensorSketch(Fitted):
    """Adds ``poly``, the sketch of the ``features`` vector; a row with an absent value is all NaN."""

    def transform(self, df):
        from pyspark.ml.functions import array_to_vector
        p = self.params
        width, degree, scale, seed = p["width"], p["degree"], p["scale"], p["seed"]

        @F.arrow_udf("array<double>")
        def sketch(cells: pa.Array) -> pa.Array:
            row, ids, x = cells_of(cells)
            found = tensor_sketch(row, ids, x, len(cells), width, degree, scale, seed)
            found[row[np.isnan(x)]] = np.nan
            return lists(found)
        return df.withColumn("poly", array_to_vector(sketch(nonzero([p["input"]], [0]))))


class TensorSketch(Step):
    """M3 features; ``width`` sums a row."""

    def __init__(self, input_col: str = "features", degree: int = 2, scale: float = 1.0, width: int = WIDTH, seed: int = 11):
        if degree < 1 or scale <= 0 or width < 2:
            raise ValueError("degree, scale and width of a tensor sketch are positive, width at least 2")
        self.params = {"input": input_col, "degree": int(degree), "scale": float(scale), "width": int(width), "seed": int(seed)}

    def fit(self, df):
        return FittedTensorSketch(dict(self.params))
