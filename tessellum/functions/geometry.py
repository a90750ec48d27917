"""Camera geometry as pure column expressions.

World to camera is ``X_cam = R X + t``; a camera's centre is ``-R^T t`` and it
looks along the third row of R.  Pixels are integer coordinates without a half
pixel offset.  Unknown values are null, never NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]
Matrix = tuple[Vector, Vector, Vector]

#: Models whose first parameter is one focal length for both axes.
SINGLE_FOCAL = ("SIMPLE_PINHOLE", "SIMPLE_RADIAL", "RADIAL")


def rotation(w: Column, x: Column, y: Column, z: Column) -> Matrix:
    """The rotation of a quaternion, which is taken as it is, without normalising."""
    return (
        (1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)),
        (2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)),
        (2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)),
    )


def rotation_of(qvec: str) -> Matrix:
    return rotation(*(F.col(qvec)[i] for i in range(4)))


def vector_of(column: str) -> Vector:
    return tuple(F.col(column)[i] for i in range(3))


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def norm(v: Vector) -> Column:
    return F.sqrt(dot(v, v))


def minus(a: Vector, b: Vector) -> Vector:
    return tuple(x - y for x, y in zip(a, b, strict=True))


def transposed(m: Matrix) -> Matrix:
    return tuple(tuple(m[j][i] for j in range(3)) for i in range(3))


def apply(m: Matrix, v: Vector) -> Vector:
    return tuple(dot(row, v) for row in m)


def centre(r: Matrix, t: Vector) -> Vector:
    return tuple(-x for x in apply(transposed(r), t))


def view_direction(r: Matrix) -> Vector:
    return r[2]


def to_camera(r: Matrix, t: Vector, point: Vector) -> Vector:
    return tuple(x + y for x, y in zip(apply(r, point), t, strict=True))


def to_world(r: Matrix, t: Vector, point: Vector) -> Vector:
    return apply(transposed(r), minus(point, t))


def intrinsics(model: Column, params: Column) -> tuple[Column, Column, Column, Column]:
    """(fx, fy, cx, cy) of a camera model's parameters."""
    single = model.isin(*SINGLE_FOCAL)
    return (
        params[0],
        F.when(single, params[0]).otherwise(params[1]),
        F.when(single, params[1]).otherwise(params[2]),
        F.when(single, params[2]).otherwise(params[3]),
    )


def project(point: Vector, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column]:
    """Pixel coordinates of a point in camera space; null at depth 0."""
    return fx * F.try_divide(point[0], point[2]) + cx, fy * F.try_divide(point[1], point[2]) + cy


def unproject(u: Column, v: Column, depth: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> Vector:
    """The point in camera space of a pixel at a depth along the axis."""
    return (u - cx) / fx * depth, (v - cy) / fy * depth, depth


def rotation_angle(a: Matrix, b: Matrix) -> Column:
    """Degrees of the rotation that takes a to b."""
    trace = sum((a[i][j] * b[i][j] for i in range(3) for j in range(3)), F.lit(0.0))
    cosine = (trace - 1) / 2
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))


def inverse_depth(z: Column) -> Column:
    return 1 / F.greatest(z, F.lit(1e-6))


def metric_depth(raw: Column, scale: Column, shift: Column, near: Column, far: Column) -> Column:
    """Depth of a disparity under a scale and shift; 0 where it isn't strictly between near and far."""
    inverse = scale * raw + shift
    depth = F.when(inverse > 1e-6, 1 / F.greatest(inverse, F.lit(1e-9))).otherwise(F.lit(0.0))
    return F.when((depth > near) & (depth < far), depth).otherwise(F.lit(0.0)).cast("float")


def above_bottom(depth: Column, v: Column, height: Column, fraction: float) -> Column:
    """Depth, 0 in the bottom strip of a fraction of the rows."""
    return F.when(v >= height - F.floor(height * fraction), F.lit(0.0)).otherwise(depth)


def inside(u: Column, v: Column, width: Column, height: Column) -> Column:
    """Whether fractional pixel coordinates are in the frame."""
    return (u >= 0) & (u < width) & (v >= 0) & (v < height)


def inside_truncated(u: Column, v: Column, width: Column, height: Column) -> Column:
    """Whether truncated pixel coordinates are in the frame: (-1, 0) counts as pixel 0."""
    return inside(u.cast("int"), v.cast("int"), width, height)


def unit_colour(byte: Column) -> Column:
    return byte / 255.0


def byte_colour(unit: Column) -> Column:
    """A colour in 0 to 1 as a byte, truncated."""
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), unit)) * 255).cast("smallint")


def frame_time(name: Column, fps: Column | float) -> Column:
    """Seconds of a frame named by its 1-based number; null for other names."""
    number = F.nullif(F.regexp_extract(name, r"^(.*)\.[^.]+$", 1), F.lit("")).try_cast("int")
    return (number - 1) / fps


def east_north_up(lat: Column, lon: Column, alt: Column, lat0: Column, lon0: Column, alt0: Column) -> Vector:
    """Metres east, north and up of a reference, over the WGS84 ellipsoid."""
    a, e2 = 6378137.0, 6.69437999014e-3

    def earth(lat: Column, lon: Column, alt: Column) -> Vector:
        phi, lam = F.radians(lat), F.radians(lon)
        n = a / F.sqrt(1 - e2 * F.sin(phi) * F.sin(phi))
        return (n + alt) * F.cos(phi) * F.cos(lam), (n + alt) * F.cos(phi) * F.sin(lam), (n * (1 - e2) + alt) * F.sin(phi)

    d = minus(earth(lat, lon, alt), earth(lat0, lon0, alt0))
    phi, lam = F.radians(lat0), F.radians(lon0)
    east = (-F.sin(lam), F.cos(lam), F.lit(0.0))
    north = (-F.sin(phi) * F.cos(lam), -F.sin(phi) * F.sin(lam), F.cos(phi))
    up = (F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi))
    return dot(east, d), dot(north, d), dot(up, d)
