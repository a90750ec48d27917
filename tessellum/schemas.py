"""Fixed schemas of the tables that sources give and sinks take."""

CAMERAS = "camera_id bigint, model string, width bigint, height bigint, params array<double>"
IMAGES = (
    "image_id bigint, qvec array<double>, tvec array<double>, camera_id bigint, name string, "
    "points2d array<struct<x: double, y: double, point3d_id: bigint>>"
)
POINTS = (
    "point_id bigint, x double, y double, z double, r smallint, g smallint, b smallint, error double, "
    "track array<struct<image_id: bigint, point2d_idx: bigint>>"
)
TELEMETRY = "seq bigint, time_sec double, lat double, lon double, alt double"
PAIRS = "a string, b string"
CLOUD = "x double, y double, z double"
DEPTH = "name string, v int, u int, depth float"

#: Camera models by number, with how many parameters each has.
CAMERA_MODELS = {
    0: ("SIMPLE_PINHOLE", 3),
    1: ("PINHOLE", 4),
    2: ("SIMPLE_RADIAL", 4),
    3: ("RADIAL", 5),
    4: ("OPENCV", 8),
    5: ("OPENCV_FISHEYE", 8),
    6: ("FULL_OPENCV", 12),
    7: ("FOV", 5),
    8: ("SIMPLE_RADIAL_FISHEYE", 4),
    9: ("RADIAL_FISHEYE", 5),
    10: ("THIN_PRISM_FISHEYE", 12),
}
