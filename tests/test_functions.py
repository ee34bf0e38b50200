"""Column functions against hand values and brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayframe.functions import conditions, geometry, paths, pixels, taxonomy
from wayframe.operators.flatten import image_boxes


def test_flags_match_substrings_of_any_case(spark):
    texts = ["Night drive in heavy rain", "Tonight by TRAIN", "Sunny day", "NIGHTtime, clear"]
    df = spark.createDataFrame([(t,) for t in texts], "scene_description string")
    got = [(r.is_night, r.is_rain) for r in conditions.with_flags(df).collect()]
    assert got == [(True, True), (True, True), (False, False), (True, False)]


def test_slices_take_the_first_match_per_dimension(spark):
    texts = ["Night drive in heavy rain", "Sunny day, light traffic", "Nighttime, clear skies"]
    df = spark.createDataFrame([(t,) for t in texts], "scene_description string")
    got = [(r.time_of_day, r.weather) for r in conditions.with_slices(df).collect()]
    assert got == [("night", "rain"), ("day", "clear"), ("night", "clear")]
    config = {"kind": {"a": {"include": ["sunny"]}, "b": {"include": ["day"]}}, "any": {"all": {}}}
    got = [(r.kind, r.any) for r in conditions.with_slices(df, config).collect()]
    assert got == [(None, "all"), ("a", "all"), (None, "all")]


def test_slice_members_lists_every_matching_slice(spark):
    df = spark.createDataFrame([("rainy night",), ("plain",)], "scene_description string")
    config = {"d": {"x": {"include": ["rain"]}, "y": {"include": ["night"]}}}
    got = conditions.slice_members(df, config).collect()
    assert [(r.scene_description, r.slice) for r in got] == [
        ("rainy night", "d/x"), ("rainy night", "d/y"),
    ]


def test_stratum_label(spark):
    df = spark.createDataFrame([("x", True, False)], "l string, n boolean, r boolean")
    label = conditions.stratum_label(F.col("l"), F.col("n"), F.col("r"))
    assert df.select(label).first()[0] == "x|night|dry"


def test_category_groups_and_fields(spark):
    names = list(taxonomy.CATEGORIES) + ["vehicle.bus.other", "nothing"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    group = taxonomy.category_group(F.col("n"))
    got = {
        r[0]: (r[1], r[2], r[3])
        for r in df.select("n", group, taxonomy.class_index(group), taxonomy.count_field(F.col("n")))
        .collect()
    }
    assert got["vehicle.car"] == ("car", 0, "cars")
    assert got["vehicle.emergency.police"] == (None, None, "cars")
    assert got["vehicle.bus.bendy"] == ("bus", 2, "buses")
    assert got["vehicle.bus.other"] == ("bus", 2, None)
    assert got["human.pedestrian.stroller"] == ("pedestrian", 3, "pedestrians")
    assert got["static_object.bicycle_rack"] == (None, None, None)
    assert got["animal"] == got["nothing"] == (None, None, None)
    assert sum(v[2] is not None for v in got.values()) == 19


def test_paths(spark):
    df = spark.createDataFrame([("samples/CAM_FRONT/a.b.jpg",), ("bare",)], "p string")
    p = F.col("p")
    got = df.select(
        paths.parent(p), paths.basename(p), paths.stem(p), paths.channel(p),
        paths.modality(paths.channel(p)),
    ).collect()
    assert tuple(got[0]) == ("samples/CAM_FRONT", "a.b.jpg", "a.b", "CAM_FRONT", "cam")
    assert tuple(got[1]) == ("", "bare", "bare", "", "")


def test_visibility_drops_what_is_not_a_number(spark):
    df = spark.createDataFrame([("1",), ("2",), ("x",), (None,)], "v string")
    got = [r[0] for r in df.select(geometry.visibility_at_least(F.col("v"), 2)).collect()]
    assert got == [False, True, False, False]


def test_label_line_example(spark):
    df = spark.createDataFrame([(100.0, 200.0, 300.0, 400.0)], "x_min double, y_min double, "
                               "x_max double, y_max double")
    line = df.select(geometry.label_line(F.lit(0))).first()[0].split(" ")
    assert line[0] == "0"
    assert [float(x) for x in line[1:]] == pytest.approx([0.125, 0.3333, 0.125, 0.2222], abs=1e-3)


def test_fraction_text_equals_python_repr_of_the_rounded_value(spark):
    rng = random.Random(5)
    values = [0.0, 1.0, 0.5, 1e-6, 9e-6, 1e-5, 1.5e-5, 9.9e-5, 1e-4, 0.1234565, 5e-7, 4e-7]
    values += [rng.random() for _ in range(300)] + [rng.random() * 1e-4 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(geometry._fraction_text(F.col("v"))).collect()]
    assert got == [repr(float(np.round(v, 6))) for v in values]


def test_iou(spark):
    box = "struct<x_min:double,y_min:double,x_max:double,y_max:double>"
    base = (0.0, 0.0, 10.0, 10.0)
    others = [base, (5.0, 0.0, 15.0, 10.0), (20.0, 20.0, 30.0, 30.0), (0.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame([(base, o) for o in others], f"a {box}, b {box}")
    got = [r[0] for r in df.select(geometry.iou("a", "b")).collect()]
    assert got == pytest.approx([1, 1 / 3, 0, 0])
    flat = spark.createDataFrame([((1.0, 1.0, 1.0, 1.0),) * 2], f"a {box}, b {box}")
    assert flat.select(geometry.iou("a", "b")).first()[0] == 0


# --- projection -----------------------------------------------------------------------

K = [[1000.0, 0.0, 800.0], [0.0, 1000.0, 450.0], [0.0, 0.0, 1.0]]
CUBOID = (
    "center array<double>, size array<double>, rotation array<double>,"
    " camera_intrinsic array<array<double>>, width long, height long"
)


def _projected(spark, boxes, clip=True):
    df = spark.createDataFrame([(c, s, q, K, 1600, 900) for c, s, q in boxes], CUBOID)
    return [tuple(r) for r in image_boxes(df, clip=clip).collect()]


def _cube(x, y, z):
    return ([x, y, z], [2.0, 2.0, 2.0], [1.0, 0.0, 0.0, 0.0])


def test_projection_examples(spark):
    boxes = [_cube(0.0, 0.0, 10.0), _cube(0.0, 0.0, -10.0), _cube(7.0, 0.0, 10.0),
             _cube(20.0, 0.0, 10.0)]
    inside, behind, edge, outside = _projected(spark, boxes)
    assert inside == pytest.approx((688.889, 338.889, 911.111, 561.111), abs=1e-3)
    assert behind == outside == (None,) * 4
    assert edge[2] == 1600 and edge[0] == pytest.approx(1345.4545, abs=1e-3)
    assert _projected(spark, [_cube(7.0, 0.0, 10.0)], clip=False)[0][2] > 1600


def _hull(points):
    points = sorted(set(points))
    def half(ps):
        out = []
        for p in ps:
            while len(out) > 1 and (
                (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1])
                - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0])
            ) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]
    return half(points) + half(points[::-1])


def _clip(polygon, axis, limit, keep_low):
    out = []
    for a, b in zip(polygon, polygon[1:] + polygon[:1]):
        ina, inb = ((p[axis] <= limit) == keep_low or p[axis] == limit for p in (a, b))
        if ina:
            out.append(a)
        if ina != inb:
            t = (limit - a[axis]) / (b[axis] - a[axis])
            out.append(tuple(a[i] + t * (b[i] - a[i]) for i in (0, 1)))
    return out


def test_projection_against_polygon_clipping(spark):
    rng = np.random.default_rng(3)
    boxes = []
    for _ in range(400):
        q = rng.normal(size=4)
        boxes.append((
            [float(x) for x in rng.uniform([-8, -5, -2], [8, 5, 12])],
            [float(x) for x in rng.uniform(0.3, 6, 3)], [float(x) for x in q / np.linalg.norm(q)],
        ))
    for (center, size, q), got in zip(boxes, _projected(spark, boxes)):
        w, x, y, z = q
        turn = np.array([
            [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
            [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
            [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
        ])
        points = []
        for sx in (1, -1):
            for sy in (1, -1):
                for sz in (1, -1):
                    corner = turn @ np.array(
                        [sx * size[1], sy * size[0], sz * size[2]]) / 2 + center
                    if corner[2] > 0.1:
                        u = np.array(K) @ corner
                        points.append((u[0] / u[2], u[1] / u[2]))
        shape = _hull(points) if len(points) >= 3 else []
        for axis, limit, low in ((0, 0, False), (0, 1600, True), (1, 0, False), (1, 900, True)):
            shape = _clip(shape, axis, limit, low)
        if not shape:
            assert got == (None,) * 4
            continue
        us, vs = zip(*shape)
        assert got == pytest.approx((min(us), min(vs), max(us), max(vs)), abs=1e-4)


def test_camera_frame_undoes_the_poses(spark):
    half = math.pi / 4
    turned = [math.cos(half), 0.0, 0.0, math.sin(half)]  # 90 degrees about z
    df = spark.createDataFrame(
        [([3.0, 5.0, 1.0], turned, [1.0, 2.0, 0.0], turned, [0.0, 0.0, 1.0], [1.0, 0.0, 0.0, 0.0])],
        "c array<double>, q array<double>, et array<double>, eq array<double>,"
        " st array<double>, sq array<double>",
    )
    got = df.select(geometry.to_camera_frame("c", "q", "et", "eq", "st", "sq").alias("m")).first().m
    assert got.center == pytest.approx([3.0, -2.0, 0.0])
    assert got.rotation == pytest.approx([1.0, 0.0, 0.0, 0.0])


def test_brightness_of_constant_and_missing_images(spark):
    data = [
        (2, 3, 3, bytes([200] * 18)), (2, 3, 3, bytes([20] * 18)), (1, 1, 3, bytes([255, 0, 0])),
        (1, 2, 1, bytes([10, 30])), (None, None, None, None),
    ]
    df = spark.createDataFrame(data, "h int, w int, c int, d binary")
    got = [r[0] for r in df.select(pixels.brightness("h", "w", "c", "d")).collect()]
    assert got == [200.0, 20.0, 29.0, 20.0, None]
