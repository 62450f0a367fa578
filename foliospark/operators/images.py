"""Pictures in a binary column: decoding, statistics, regions, features, augmentation; one Arrow pass each."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.png import BrokenPng, decode, encode, gray


def _gray(data: bytes | None) -> np.ndarray | None:
    try:
        return gray(decode(data))
    except BrokenPng:
        return None


def picture_stats(images: DataFrame, id_col: str, png_col: str) -> DataFrame:
    """``image_id, decodes, height, width, mean, std, white, is_blank, average_hash, round_trip`` of each row.

    Missing and broken pictures do not decode and have nulls. Blank: std below 5 or more than 95 % above 240.
    """

    def run(batches):
        for b in batches:
            rows = []
            for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                g = _gray(data)
                if g is None:
                    rows.append((i, False, None, None, None, None, None, None, None, None))
                    continue
                mean, std, white = float(g.mean()), float(g.std()), float((g > 240).mean())
                same = bool(np.array_equal(decode(encode(g)), g))
                rows.append((i, True, g.shape[0], g.shape[1], round(mean, 2), round(std, 2), round(white, 4), std < 5.0 or white > 0.95, kernels.average_hash(g), same))
            types = [pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.string(), pa.bool_()]
            cols = list(zip(*rows)) if rows else [[]] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["image_id", "decodes", "height", "width", "mean", "std", "white", "is_blank", "average_hash", "round_trip"])

    return images.select(F.col(id_col).cast("string").alias("i"), F.col(png_col).alias("p")).mapInArrow(run, "image_id string, decodes boolean, height int, width int, mean double, std double, white double, is_blank boolean, average_hash string, round_trip boolean")


def region_features(images: DataFrame, id_col: str, png_col: str, min_height: int = kernels.MIN_HEIGHT, min_width: int = kernels.MIN_WIDTH) -> DataFrame:
    """Regions of each picture with box, size at height 128 and mean and deviation of pixels scaled to [-1, 1].

    Regions lower or narrower than the least sizes are left out. Broken pictures give none.
    """

    def run(batches):
        for b in batches:
            rows = []
            for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                g = _gray(data)
                if g is None:
                    continue
                for k, (x0, y0, x1, y1) in enumerate(kernels.regions(g, min_height=min_height, min_width=min_width)):
                    t = kernels.to_height(g[y0:y1, x0:x1]) / 127.5 - 1.0
                    rows.append((i, k, [x0, y0, x1, y1], [1, *t.shape], round(float(t.mean()), 4), round(float(t.std()), 4)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            types = [pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["image_id", "region_index", "bbox", "shape", "mean", "std"])

    return images.select(F.col(id_col).cast("string").alias("i"), F.col(png_col).alias("p")).mapInArrow(run, "image_id string, region_index int, bbox array<int>, shape array<int>, mean double, std double")


def augmented(images: DataFrame, copies: int = 3) -> DataFrame:
    """``copies`` changed pictures of each row with ids ``{id}_aug{k}`` and splits ``{split}_augmented``; text unchanged.

    The change depends on the id and k alone, so a lost task gives the same rows again. Broken pictures give none.
    """

    def run(batches):
        for b in batches:
            rows = []
            for i, data, t, s in zip(*(c.to_pylist() for c in b.columns)):
                try:
                    picture = decode(data)
                except BrokenPng:
                    continue
                for k in range(copies):
                    rows.append((f"{i}_aug{k}", encode(kernels.augment(picture, zlib.crc32(f"{i}:{k}".encode()))), t, f"{s}_augmented"))
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.binary(), pa.string(), pa.string()))], ["image_id", "image_png", "transcription", "split"])

    return images.select("image_id", "image_png", "transcription", "split").mapInArrow(run, "image_id string, image_png binary, transcription string, split string")


def drift_features(images: DataFrame, id_col: str, png_col: str) -> DataFrame:
    """``image_id, feature``: 64 mean brightnesses in a 4 x 16 grid; broken pictures give none."""

    def run(batches):
        for b in batches:
            pairs = [(i, g) for i, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if (g := _gray(d)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], pa.string()), pa.array([kernels.grid_feature(g) for _, g in pairs], pa.list_(pa.float64()))], ["image_id", "feature"])

    return images.select(F.col(id_col).cast("string").alias("i"), F.col(png_col).alias("p")).mapInArrow(run, "image_id string, feature array<double>")


def tensors(images: DataFrame, id_col: str, png_col: str, height: int = 64, width: int = 512) -> DataFrame:
    """``image_id, height, width, pixels``: pictures resized to one size, aspect not kept, as rows of floats in [0, 1]; broken pictures give none."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                p = b.slice(at, 64)
                ok = [(i, kernels.resize(g, height, width).reshape(-1).astype(np.float32) / np.float32(255)) for i, d in zip(p.column(0).to_pylist(), p.column(1).to_pylist()) if (g := _gray(d)) is not None]
                n = height * width
                flat = np.concatenate([x for _, x in ok]) if ok else np.empty(0, np.float32)
                size = [pa.array([v] * len(ok), pa.int32()) for v in (height, width)]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in ok], pa.string()), *size, pa.ListArray.from_arrays(pa.array(np.arange(len(ok) + 1) * n, pa.int32()), pa.array(flat))], ["image_id", "height", "width", "pixels"])

    return images.select(F.col(id_col).cast("string").alias("i"), F.col(png_col).alias("p")).mapInArrow(run, "image_id string, height int, width int, pixels array<float>")


def sample_pictures(images: DataFrame, n: int, seed: int = 17) -> DataFrame:
    """``n`` pictures (image_id, image_png) that decode, the first by a seeded hash of their ids; ValueError where there are fewer.

    Only as many pictures as needed are decoded, unless most are broken.
    """
    order = [F.xxhash64(F.lit(seed), "image_id"), F.col("image_id")]
    one = images.groupBy("image_id").agg(F.min("image_png").alias("image_png"))
    for many in (2 * n, 16 * n, None):
        some = one.orderBy(*order).limit(many) if many else one
        good = picture_stats(some, "image_id", "image_png").where("decodes").select("image_id")
        found = some.join(good, "image_id", "left_semi").orderBy(*order).limit(n)  # the sample's own size
        if found.count() == n:
            return found
    raise ValueError(f"fewer than {n} pictures decode")
