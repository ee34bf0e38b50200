"""Category names, detector classes and the label-count taxonomy."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- Fixed values -------------------------------------------------------------------
# The dataset's category names, the detector's classes and the count fields are part of
# the data format: results are only comparable when they are exactly these.

CATEGORIES = (
    "human.pedestrian.adult",
    "human.pedestrian.child",
    "human.pedestrian.wheelchair",
    "human.pedestrian.stroller",
    "human.pedestrian.personal_mobility",
    "human.pedestrian.police_officer",
    "human.pedestrian.construction_worker",
    "animal",
    "vehicle.car",
    "vehicle.motorcycle",
    "vehicle.bicycle",
    "vehicle.bus.bendy",
    "vehicle.bus.rigid",
    "vehicle.truck",
    "vehicle.construction",
    "vehicle.emergency.ambulance",
    "vehicle.emergency.police",
    "vehicle.trailer",
    "movable_object.barrier",
    "movable_object.trafficcone",
    "movable_object.pushable_pullable",
    "movable_object.debris",
    "static_object.bicycle_rack",
)

DETECTION_CLASSES = ("car", "truck", "bus", "pedestrian", "bicycle")

GROUP_BY_NAME = {
    "vehicle.car": "car",
    "vehicle.truck": "truck",
    "vehicle.bicycle": "bicycle",
}
GROUP_BY_PREFIX = {
    "vehicle.bus": "bus",
    "human.pedestrian": "pedestrian",
}

COUNT_FIELDS = (
    "cars",
    "trucks",
    "buses",
    "trailers",
    "construction_vehicles",
    "motorcycles",
    "bicycles",
    "pedestrians",
    "traffic_cones",
    "barriers",
)

COUNT_FIELD_MEMBERS = {
    "cars": ("vehicle.car", "vehicle.emergency.police"),
    "trucks": ("vehicle.truck", "vehicle.emergency.ambulance"),
    "buses": ("vehicle.bus.rigid", "vehicle.bus.bendy"),
    "trailers": ("vehicle.trailer",),
    "construction_vehicles": ("vehicle.construction",),
    "motorcycles": ("vehicle.motorcycle",),
    "bicycles": ("vehicle.bicycle",),
    "pedestrians": (
        "human.pedestrian.adult",
        "human.pedestrian.child",
        "human.pedestrian.construction_worker",
        "human.pedestrian.police_officer",
        "human.pedestrian.personal_mobility",
        "human.pedestrian.stroller",
        "human.pedestrian.wheelchair",
    ),
    "traffic_cones": ("movable_object.trafficcone",),
    "barriers": ("movable_object.barrier",),
}

CAMERAS = (
    "CAM_FRONT",
    "CAM_FRONT_LEFT",
    "CAM_FRONT_RIGHT",
    "CAM_BACK",
    "CAM_BACK_LEFT",
    "CAM_BACK_RIGHT",
)
# --- End of fixed values ------------------------------------------------------------


def category_group(name: Column) -> Column:
    """Detector class of a category name: exact names, then prefixes, else NULL."""
    names = [(name == full, group) for full, group in GROUP_BY_NAME.items()]
    prefixes = [(name.startswith(p), group) for p, group in GROUP_BY_PREFIX.items()]
    chain = F
    for condition, group in names + prefixes:
        chain = chain.when(condition, F.lit(group))
    return chain


def class_index(group: Column) -> Column:
    """Zero-based position in the detector's class order; NULL for anything else."""
    classes = F.array(*[F.lit(c) for c in DETECTION_CLASSES])
    return (F.nullif(F.array_position(classes, group), F.lit(0)) - 1).cast("int")


def count_field(name: Column) -> Column:
    """Count field a category name is evaluated under; NULL when it is not evaluated."""
    chain = F
    for field in COUNT_FIELDS:
        chain = chain.when(name.isin(*COUNT_FIELD_MEMBERS[field]), F.lit(field))
    return chain
