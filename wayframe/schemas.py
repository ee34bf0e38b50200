"""Explicit schemas of every table the library reads or writes."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

# Raw metadata, one JSON array of objects per table.
SCENE = _struct(token=_S, name=_S, description=_S, log_token=_S)
LOG = _struct(token=_S, location=_S)
SAMPLE = _struct(token=_S, scene_token=_S, timestamp=_L)
SAMPLE_DATA = _struct(
    token=_S, sample_token=_S, ego_pose_token=_S, calibrated_sensor_token=_S, filename=_S,
    width=_L, height=_L, timestamp=_L, is_key_frame=_B,
)
SAMPLE_ANNOTATION = _struct(
    token=_S, sample_token=_S, instance_token=_S, visibility_token=_S,
    translation=T.ArrayType(_D), size=T.ArrayType(_D), rotation=T.ArrayType(_D),
    num_lidar_pts=_L, num_radar_pts=_L,
)
INSTANCE = _struct(token=_S, category_token=_S)
CATEGORY = _struct(token=_S, name=_S)
EGO_POSE = _struct(token=_S, translation=T.ArrayType(_D), rotation=T.ArrayType(_D))
CALIBRATED_SENSOR = _struct(
    token=_S, sensor_token=_S, translation=T.ArrayType(_D), rotation=T.ArrayType(_D),
    camera_intrinsic=T.ArrayType(T.ArrayType(_D)),
)
SENSOR = _struct(token=_S, channel=_S, modality=_S)

METADATA = {
    "scene": SCENE,
    "log": LOG,
    "sample": SAMPLE,
    "sample_data": SAMPLE_DATA,
    "sample_annotation": SAMPLE_ANNOTATION,
    "instance": INSTANCE,
    "category": CATEGORY,
    "ego_pose": EGO_POSE,
    "calibrated_sensor": CALIBRATED_SENSOR,
    "sensor": SENSOR,
}

_CONTEXT = dict(
    scene_token=_S, scene_name=_S, scene_description=_S, log_token=_S, location=_S,
    is_night=_B, is_rain=_B,
)

SAMPLES = _struct(
    sample_data_token=_S, sample_token=_S, channel=_S, filename=_S, width=_L, height=_L,
    timestamp=_L, n_boxes=_L, **_CONTEXT,
)

ANNOTATIONS = _struct(
    annotation_token=_S, sample_data_token=_S, sample_token=_S, channel=_S, category_name=_S,
    category_group=_S, visibility_token=_S, num_lidar_pts=_L, num_radar_pts=_L,
    x_min=_D, y_min=_D, x_max=_D, y_max=_D, bbox_area=_D, **_CONTEXT,
)

AVAILABILITY = _struct(
    sample_data_token=_S, filename=_S, channel=_S, modality=_S, is_key_frame=_B,
    scene_token=_S, scene_name=_S, present=_B,
)

FRAME_VECTORS = _struct(
    vector=T.ArrayType(T.FloatType()), sample_data_token=_S, sample_token=_S, scene_token=_S,
    scene_name=_S, scene_description=_S, channel=_S, filename=_S, timestamp=_L, location=_S,
    is_night=_B, is_rain=_B, n_boxes=_I, thumbnail=T.BinaryType(),
)

PREDICTIONS = _struct(
    frame=_S, box_id=_S, cls=_I, conf=_D, x_min=_D, y_min=_D, x_max=_D, y_max=_D,
)

LABEL_RESULT = _struct(
    custom_id=_S, result_type=_S, stop_reason=_S, text=_S, error_type=_S,
)

DRIFT_FEATURES = _struct(
    sample_data_token=_S, channel=_S, is_night=_B, width=_L, height=_L, n_boxes=_L,
    brightness=_D,
)

CAPTURE = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("image_width", _L),
        T.StructField("image_height", _L),
        T.StructField("n_detections", _L),
        T.StructField("brightness", _D),
        T.StructField("latency_ms", _D),
        T.StructField("model_version", _S),
    ]
)
