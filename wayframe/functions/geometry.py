"""Box arithmetic, label lines and 3D-to-2D projection."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Every camera image of the dataset has this size.
IMAGE_WIDTH = 1600
IMAGE_HEIGHT = 900


def visibility_at_least(token: Column, minimum: int) -> Column:
    """Numeric visibility floor; a token that is not a number never passes."""
    return F.coalesce(token.try_cast("int") >= F.lit(int(minimum)), F.lit(False))


def area(x_min: Column, y_min: Column, x_max: Column, y_max: Column) -> Column:
    return (x_max - x_min) * (y_max - y_min)


def iou(a: str, b: str) -> Column:
    """Intersection over union of two boxes held as structs ``x_min..y_max``."""

    def side(lo: str, hi: str) -> Column:
        reach = F.least(F.col(f"{a}.{hi}"), F.col(f"{b}.{hi}"))
        start = F.greatest(F.col(f"{a}.{lo}"), F.col(f"{b}.{lo}"))
        return F.greatest(reach - start, F.lit(0.0))

    def extent(box: str) -> Column:
        return area(*[F.col(f"{box}.{c}") for c in ("x_min", "y_min", "x_max", "y_max")])

    inter = side("x_min", "x_max") * side("y_min", "y_max")
    union = extent(a) + extent(b) - inter
    return F.when(union > 0, inter / F.greatest(union, F.lit(1e-9))).otherwise(F.lit(0.0))


def unit_clip(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def normalised_box(width: int = IMAGE_WIDTH, height: int = IMAGE_HEIGHT) -> dict[str, Column]:
    """Centre and size as fractions of the image, clipped to [0, 1]."""
    x0, y0, x1, y1 = (F.col(c) for c in ("x_min", "y_min", "x_max", "y_max"))
    return {
        "cx": unit_clip((x0 + x1) / 2 / width),
        "cy": unit_clip((y0 + y1) / 2 / height),
        "bw": unit_clip((x1 - x0) / width),
        "bh": unit_clip((y1 - y0) / height),
    }


def _fraction_text(value: Column) -> Column:
    """Shortest text of a fraction rounded to six decimals, half to even.

    Values below 1e-4 are written in scientific notation (``5e-05``), as the label
    format's usual writers do.
    """
    micros = F.rint(value * 1e6).cast("int")
    fixed = F.format_string("%.6f", F.rint(value * 1e6) / 1e6)
    plain = F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")
    tens = F.regexp_replace(
        F.format_string("%d.%de-05", (micros / 10).cast("int"), micros % 10), r"\.0e", "e"
    )
    return (
        F.when((micros > 0) & (micros < 10), F.format_string("%de-06", micros))
        .when((micros >= 10) & (micros < 100), tens)
        .otherwise(plain)
    )


def label_line(cls: Column) -> Column:
    """Training-label line ``class cx cy w h``."""
    return F.concat_ws(
        " ", cls.cast("string"), *[_fraction_text(v) for v in normalised_box().values()]
    )


# --- projection -----------------------------------------------------------------------

_SIGNS = np.array(list(product((1.0, -1.0), repeat=3)))
_CHORDS = np.array(list(combinations(range(8), 2)))
PROJECTED_BOX = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in ("x_min", "y_min", "x_max", "y_max")]
)
CAMERA_BOX = T.StructType(
    [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("center", "rotation")]
)


def _rotation(q: np.ndarray) -> np.ndarray:
    """(N,4) quaternions in w,x,y,z order -> (N,3,3) rotation matrices."""
    w, x, y, z = (q / np.linalg.norm(q, axis=1, keepdims=True)).T
    return np.stack(
        [
            1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
            2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
            2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
        ],
        axis=1,
    ).reshape(-1, 3, 3)


def _extent(points: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest coordinates of each row's valid points; infinite without any."""
    valid = valid[..., None]
    return np.where(valid, points, np.inf).min(axis=1), np.where(valid, points, -np.inf).max(axis=1)


def _chord_crossings(points: np.ndarray, seen: np.ndarray, w: np.ndarray, h: np.ndarray):
    """Where the segments between visible corners cross the four canvas edges.

    Every such segment lies inside the convex hull, so its crossings belong to
    hull-and-canvas, and the hull's own edges are among the segments.
    """
    low, high = _extent(points, seen)
    for axis, limit in ((0, np.zeros_like(w)), (0, w), (1, np.zeros_like(h)), (1, h)):
        rows = np.flatnonzero((low[:, axis] <= limit) & (limit <= high[:, axis]))  # others don't reach the edge
        own, limit = points[rows], limit[rows]
        a, b = own[:, _CHORDS[:, 0]], own[:, _CHORDS[:, 1]]
        both = seen[rows][:, _CHORDS[:, 0]] & seen[rows][:, _CHORDS[:, 1]]
        other, bound = 1 - axis, (h if axis == 0 else w)[rows]
        delta = b[..., axis] - a[..., axis]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (limit[:, None] - a[..., axis]) / delta
            at = a[..., other] + t * (b[..., other] - a[..., other])
        hit = both & (delta != 0) & (t >= 0) & (t <= 1) & (at >= 0) & (at <= bound[:, None])
        found = np.empty(at.shape + (2,))
        found[..., axis] = limit[:, None]
        found[..., other] = at
        yield rows, found, hit


def _covered_canvas_corners(points: np.ndarray, seen: np.ndarray, w: np.ndarray, h: np.ndarray):
    """Canvas corners inside the hull: no half-plane through them holds every point."""
    low, high = _extent(points, seen)
    for fx, fy in product((0.0, 1.0), repeat=2):
        corner = np.stack([fx * w, fy * h], axis=1)
        rows = np.flatnonzero(((low <= corner) & (corner <= high)).all(axis=1))
        if not len(rows):
            continue
        corner = corner[rows]
        away = points[rows] - corner[:, None, :]
        angle = np.where(seen[rows], np.arctan2(away[..., 1], away[..., 0]), np.nan)
        angle = np.sort(angle, axis=1)  # NaN sorts last
        gaps = np.diff(angle, axis=1)
        first, last = angle[:, 0], np.nanmax(angle, axis=1)
        widest = np.fmax(np.nanmax(gaps, axis=1), first + 2 * np.pi - last)
        yield rows, corner[:, None, :], (widest <= np.pi)[:, None]


def _project(center, size, rotation, intrinsic, width, height, clip, min_z):
    """Vectorised projection of N boxes; NaN rows are invisible boxes."""
    length_first = size[:, [1, 0, 2]]  # stored as width, length, height
    corners = _SIGNS[None] * length_first[:, None, :] / 2
    corners = np.einsum("nij,nkj->nki", _rotation(rotation), corners) + center[:, None, :]
    seen = corners[..., 2] > min_z
    enough = seen.sum(axis=1) >= 3
    out = np.full((len(center), 4), np.nan)
    if not enough.any():
        return out
    corners, seen, k = corners[enough], seen[enough], intrinsic[enough]
    w, h = width[enough], height[enough]
    image = np.einsum("nij,nkj->nki", k, corners)
    depth = np.where(seen, image[..., 2], 1.0)
    points = image[..., :2] / depth[..., None]
    if clip:
        inside = (
            seen & (points >= 0).all(axis=2)
            & (points[..., 0] <= w[:, None]) & (points[..., 1] <= h[:, None])
        )
        low, high = _extent(points, inside)
        for source in (_chord_crossings, _covered_canvas_corners):
            for rows, where, valid in source(points, seen, w, h):
                least, most = _extent(where, valid)
                low[rows], high[rows] = np.minimum(low[rows], least), np.maximum(high[rows], most)
    else:
        low, high = _extent(points, seen)
    solid = (high > low).all(axis=1)
    out[enough] = np.where(solid[:, None], np.concatenate([low, high], axis=1), np.nan)
    return out


def _columns(part: tuple[pd.Series, ...], *widths: int) -> list[np.ndarray]:
    """Flat scalar series regrouped into (N, width) matrices."""
    flat = np.column_stack([s.to_numpy(dtype=float) for s in part])
    return np.split(flat, np.cumsum(widths)[:-1], axis=1)


def _scalars(name: str, n: int) -> list[Column]:
    """Entries of a fixed-length array column.

    UDFs are handed scalars: nested arrays cross into Python one object per row.
    """
    return [F.col(name)[i] for i in range(n)]


def _multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamilton product of (N,4) quaternions."""
    aw, av, bw, bv = a[:, :1], a[:, 1:], b[:, :1], b[:, 1:]
    real = aw * bw - (av * bv).sum(axis=1, keepdims=True)
    return np.concatenate([real, aw * bv + bw * av + np.cross(av, bv)], axis=1)


def _enter_frame(center, rotation, origin, orientation):
    """Re-express boxes in a frame given by its pose in the current one."""
    inverse = orientation * np.array([1.0, -1.0, -1.0, -1.0])
    turned = np.einsum("nij,nj->ni", _rotation(inverse), center - origin)
    return turned, _multiply(inverse, rotation)


@F.pandas_udf(CAMERA_BOX)
def _moved(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    for part in parts:
        center, rotation, ego_t, ego_q, sensor_t, sensor_q = _columns(part, 3, 4, 3, 4, 3, 4)
        center, rotation = _enter_frame(center, rotation, ego_t, ego_q)
        center, rotation = _enter_frame(center, rotation, sensor_t, sensor_q)
        yield pd.DataFrame({"center": list(center), "rotation": list(rotation)})


def to_camera_frame(center, rotation, ego_t, ego_q, sensor_t, sensor_q) -> Column:
    """Box ``center`` and ``rotation`` moved global -> ego -> sensor; arguments are names."""
    threes_and_fours = zip(
        (center, rotation, ego_t, ego_q, sensor_t, sensor_q), (3, 4, 3, 4, 3, 4)
    )
    return _moved(*[c for name, n in threes_and_fours for c in _scalars(name, n)])


def project_box(*, clip: bool = True, min_z: float = 0.1):
    """Column function ``(center, size, rotation, intrinsic, width, height) -> struct``.

    Arguments are column names; boxes are in the camera frame. Corners more than ``min_z``
    in front of the camera are projected and the bounding box of (their hull within the
    image) is returned; its fields are NULL when fewer than three corners are in front or
    nothing of the box is on the image.
    """

    @F.pandas_udf(PROJECTED_BOX)
    def projected(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for part in parts:
            center, size, rotation, k, image = _columns(part, 3, 3, 4, 9, 2)
            boxes = _project(
                center, size, rotation, k.reshape(-1, 3, 3), image[:, 0], image[:, 1], clip, min_z
            )
            yield pd.DataFrame(boxes, columns=["x_min", "y_min", "x_max", "y_max"])

    def call(center, size, rotation, intrinsic, width, height) -> Column:
        return projected(
            *_scalars(center, 3), *_scalars(size, 3), *_scalars(rotation, 4),
            *[F.col(intrinsic)[i][j] for i in range(3) for j in range(3)],
            F.col(width), F.col(height),
        )

    return call
