"""Decoded images to the normalised tensors classifiers take."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Preprocessing of the image classifiers.
RESIZE_SIDE = 256
CROP_SIDE = 224
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Raw gray, BGR or BGRA rows as RGB ``[height, width, 3]``; gray stays one plane."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return pixels if channels == 1 else pixels[:, :, 2::-1]


@lru_cache(maxsize=256)
def _resample(size: int, target: int, start: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Bilinear resampling of ``size`` to ``target`` pixels, for ``count`` of them from ``start``.

    When it shrinks, the triangle widens so that all source pixels count. Returns
    the source pixels and their weights, both ``[taps, count]``.
    """
    scale = size / target
    reach = max(scale, 1.0)
    centres = (np.arange(start, start + count) + 0.5) * scale
    taps = np.floor(centres - reach).astype(int) + np.arange(int(np.ceil(2 * reach)) + 2)[:, None]
    weights = np.maximum(0.0, 1.0 - np.abs(taps + 0.5 - centres) / reach)
    weights[(taps < 0) | (taps >= size)] = 0.0
    used = weights.any(axis=1)
    taps, weights = taps[used].clip(0, size - 1), weights[used]
    return taps, (weights / weights.sum(axis=0)).astype(np.float32)


def resize_window(
    pixels: np.ndarray, size: tuple[int, int], top: int, left: int, height: int, width: int
) -> np.ndarray:
    """A window of the image ``[h, w, c]`` resized to ``size``, as ``[c, height, width]``; the rest is not computed.

    The width comes first, and values are rounded to 8 bits after each direction.
    """
    rows, down = _resample(pixels.shape[0], size[0], top, height)
    columns, across = _resample(pixels.shape[1], size[1], left, width)
    first = int(rows.min())
    planes = np.ascontiguousarray(pixels[first : int(rows.max()) + 1].transpose(2, 0, 1))
    planes = _weighted(planes, 2, columns, across)
    return _weighted(planes, 1, rows - first, down[:, :, None])


def _weighted(planes: np.ndarray, axis: int, taps: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum over taps of the pixels along ``axis`` times their weights, in 8 bits."""
    total = np.take(planes, taps[0], axis=axis) * weights[0]
    part = np.empty_like(total)
    for at, weight in zip(taps[1:], weights[1:]):
        total += np.multiply(np.take(planes, at, axis=axis), weight, out=part)
    total += np.float32(0.5)
    return np.clip(total, 0, 255, out=total).astype(np.uint8)


def preprocess(pixels: np.ndarray, resize_side: int = RESIZE_SIDE, crop: int = CROP_SIDE) -> np.ndarray:
    """Shorter side to ``resize_side``, centre crop, unit range, normalised; ``[3, crop, crop]``."""
    height, width = pixels.shape[:2]
    if height <= width:
        size = (resize_side, int(resize_side * width / height))
    else:
        size = (int(resize_side * height / width), resize_side)
    top, left = round((size[0] - crop) / 2), round((size[1] - crop) / 2)
    window = resize_window(pixels, size, top, left, crop, crop).astype(np.float32) / np.float32(255)
    mean, std = np.float32(CHANNEL_MEAN)[:, None, None], np.float32(CHANNEL_STD)[:, None, None]
    return (window - mean) / std


def flatten_images(images: DataFrame) -> DataFrame:
    """``path, height, width, channels, data`` of decoded images, as the featuriser reads them."""
    return images.select(
        "path",
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
    )


def image_features(
    resize_side: int = RESIZE_SIDE, crop: int = CROP_SIDE
) -> Callable[[pa.RecordBatch], tuple[np.ndarray, list[str | None]]]:
    """Featuriser for :func:`flatten_images` rows; undecoded images stay zero and get a message."""

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str | None]]:
        inputs = np.zeros((batch.num_rows, 3, crop, crop), dtype=np.float32)
        errors: list[str | None] = [None] * batch.num_rows
        columns = [batch.column(name).to_pylist() for name in ("data", "height", "width", "channels")]
        for i, (data, height, width, channels) in enumerate(zip(*columns)):
            try:
                if data is None or height is None or height <= 0:
                    raise ValueError("not a readable image")
                inputs[i] = preprocess(to_rgb(data, height, width, channels), resize_side, crop)
            except Exception as e:  # the row is kept and reported, as for any unusable input
                errors[i] = f"{type(e).__name__}: {e}"
        return inputs, errors

    return read
