"""Per-image statistics and thumbnails over the image source's BGR bytes."""

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Rec.601 luma weights in thousandths, in blue, green, red order.
LUMA_BGR = np.array([114, 587, 299])


def _pixels(height, width, channels, raw) -> np.ndarray | None:
    """An image's rows, None when it could not be decoded."""
    if raw is None or not height or height < 0 or not width or width < 0:
        return None
    return np.frombuffer(raw, dtype=np.uint8).reshape(int(height), int(width), int(channels))


@F.pandas_udf(T.DoubleType())
def brightness(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
    """Mean gray value 0..255 of an image, NULL when it could not be decoded."""

    def mean_gray(*image):
        pixels = _pixels(*image)
        if pixels is None:
            return None
        if pixels.shape[2] == 1:
            return float(pixels.mean())
        return float(((pixels[:, :, :3] @ LUMA_BGR + 500) // 1000).mean())  # gray images are 8-bit

    return pd.Series([mean_gray(*v) for v in zip(height, width, channels, data)], dtype=object)


def shrunk(pixels: np.ndarray, side: int) -> np.ndarray:
    """An image whose longer side is at most ``side``: means of the pixels that fall together."""
    sums, parts = pixels.astype(np.int64), []
    longest = max(pixels.shape[:2])
    if longest <= side:
        return pixels
    for axis, size in enumerate(pixels.shape[:2]):
        edges = np.arange(n := max(1, round(size * side / longest))) * size // n
        sums = np.add.reduceat(sums, edges, axis=axis)
        parts.append(np.diff(edges, append=size))
    held = np.multiply.outer(*parts)[:, :, None]
    return ((2 * sums + held) // (2 * held)).astype(np.uint8)


def png(pixels: np.ndarray) -> bytes:
    """A PNG file of gray, BGR or BGRA pixels."""
    height, width, channels = pixels.shape
    if channels > 1:
        pixels = np.concatenate([pixels[:, :, 2::-1], pixels[:, :, 3:]], axis=2)

    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    lines = np.zeros((height, 1 + width * channels), np.uint8)
    lines[:, 1:] = pixels.reshape(height, -1)
    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def thumbnail(height: Column | str, width: Column | str, channels: Column | str, data: Column | str, side: int) -> Column:
    """A small PNG of an image, its longer side at most ``side``; NULL when it could not be decoded."""

    @F.pandas_udf(T.BinaryType())
    def encode(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
        images = (_pixels(*v) for v in zip(height, width, channels, data))
        return pd.Series([None if image is None else png(shrunk(image, side)) for image in images], dtype=object)

    return encode(height, width, channels, data)
