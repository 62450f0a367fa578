"""Drift of pictures: windows of new ones against a reference by the maximum mean discrepancy (Gretton et al. 2012).

The threshold comes from permutations of the reference itself: a window drawn from it passes with the chance 1 / ``ert``,
so undrifted windows raise a false alarm about every ``ert`` windows. That is no online detector's calibration.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import numbered

#: Size of the reference, of a window, and the expected run between false alarms.
REFERENCE, WINDOW, ERT = 500, 20, 300


def kernel(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.exp(-np.maximum(d, 0.0) / (2.0 * width * width))


def _off_diagonal(k: np.ndarray) -> float:
    n = len(k)
    return float((k.sum() - np.trace(k)) / (n * (n - 1))) if n > 1 else 0.0


def discrepancy(window: np.ndarray, reference: np.ndarray, width: float, of_reference: float | None = None) -> float:
    """The unbiased squared discrepancy of two samples."""
    same = _off_diagonal(kernel(reference, reference, width)) if of_reference is None else of_reference
    return _off_diagonal(kernel(window, window, width)) + same - 2.0 * float(kernel(window, reference, width).mean())


def calibrated(reference: np.ndarray, window: int = WINDOW, ert: int = ERT, rounds: int = 3000, seed: int = 17) -> tuple[float, float]:
    """Kernel width (the median distance) and threshold for windows of a size. Fewer than two windows of reference rows give none."""
    n = len(reference)
    if n < 2 * window:
        raise ValueError("the reference holds less than two windows")
    d = np.sqrt(np.maximum((reference * reference).sum(1)[:, None] + (reference * reference).sum(1)[None, :] - 2.0 * reference @ reference.T, 0.0))
    width = float(np.median(d[np.triu_indices(n, 1)])) or 1.0
    k, r, stats = kernel(reference, reference, width), np.random.default_rng(seed), np.empty(rounds)
    for i in range(rounds):
        p = r.permutation(n)
        w, rest = p[:window], p[window:]
        stats[i] = _off_diagonal(k[np.ix_(w, w)]) + _off_diagonal(k[np.ix_(rest, rest)]) - 2.0 * float(k[np.ix_(w, rest)].mean())
    return width, float(np.quantile(stats, 1.0 - 1.0 / ert))


def drift_windows(reference: DataFrame, new: DataFrame, window: int = WINDOW, ert: int = ERT) -> DataFrame:
    """``window_no, n, statistic, threshold, is_drift`` of ``new`` in windows of ``window`` in the order of image_id.

    Both: image_id, feature. Of ``reference`` the first ``REFERENCE`` by hash are taken, as its parameter says; a last
    window of one picture is left out. Pictures with the same id fall in any order.
    """
    some = reference.orderBy(F.xxhash64("image_id"), "image_id").limit(REFERENCE).collect()  # a bounded sample
    ref = np.array([r["feature"] for r in some], np.float64).reshape(len(some), -1)
    width, threshold = calibrated(ref, window, ert)
    model = new.sparkSession.sparkContext.broadcast((ref, _off_diagonal(kernel(ref, ref, width))))

    def score(key, t):
        ref, own = model.value
        x = np.array(t.column("feature").to_pylist(), np.float64)
        s = discrepancy(x, ref, width, own)
        return pa.table({"window_no": [key[0].as_py()], "n": pa.array([len(x)], pa.int64()), "statistic": [s], "threshold": [threshold], "is_drift": [s > threshold]})

    ordered = numbered(new.select("image_id", "feature"), [], ["image_id"], "k").withColumn("window_no", F.floor((F.col("k") - 1) / window))
    out = ordered.groupBy("window_no").applyInArrow(score, "window_no bigint, n bigint, statistic double, threshold double, is_drift boolean")
    return out.where("n > 1")
