"""Dense clouds from depth rasters and a sparse model, and georegistration."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellum.functions import geometry as g
from tessellum.kernels import fits
from tessellum.operators import clouds, joins, sequences
from tessellum.storage import materialise


def stem(name: str) -> Column:
    return F.regexp_replace(F.col(name), r"\.[^.]+$", "")


def with_camera(images: DataFrame, cameras: DataFrame) -> DataFrame:
    """Images with fx, fy, cx, cy and size of their camera; a camera that is missing is an error.

    Cameras are few, but a side is broadcast only by the optimiser's own size check.
    """
    fx, fy, cx, cy = g.intrinsics(F.col("model"), F.col("params"))
    seen = cameras.select("camera_id", fx.alias("fx"), fy.alias("fy"), cx.alias("ppx"), cy.alias("ppy"), "width", "height")
    joined = images.join(seen, "camera_id", "left")
    checked = F.when(F.col("fx").isNull(), F.raise_error(F.concat(F.lit("no camera "), F.col("camera_id").cast("string")))).otherwise(F.col("fx"))
    return joined.withColumn("fx", checked.cast("double"))


_K = ("fx", "fy", "ppx", "ppy")


def anchors(images: DataFrame, cameras: DataFrame, points: DataFrame, least: int = 20, truncate: bool = False) -> DataFrame:
    """(image_id, name, idx, u, v, z): the points that an image sees, projected, in the frame; images with fewer than `least` fall out."""
    owners = with_camera(images, cameras).select("image_id", "name", "qvec", "tvec", *_K, "width", "height", F.posexplode("points2d").alias("idx", "p"))
    seen = owners.filter("p.point3d_id >= 0").join(points.select(F.col("point_id"), "x", "y", "z"), F.col("p.point3d_id") == F.col("point_id"))
    camera = g.to_camera(g.rotation_of("qvec"), g.vector_of("tvec"), (F.col("x"), F.col("y"), F.col("z")))
    placed = seen.select("image_id", "name", "idx", *_K, "width", "height", *[c.alias(n) for c, n in zip(camera, ["xc", "yc", "zc"], strict=True)]).filter("zc > 0")
    u, v = g.project((F.col("xc"), F.col("yc"), F.col("zc")), *(F.col(k) for k in _K))
    at = placed.select("image_id", "name", "idx", "width", "height", u.alias("fu"), v.alias("fv"), F.col("zc").alias("z"))
    inside = g.inside_truncated if truncate else g.inside
    framed = at.filter(inside(F.col("fu"), F.col("fv"), F.col("width"), F.col("height"))).select("image_id", "name", "idx", F.col("fu").cast("int").alias("u"), F.col("fv").cast("int").alias("v"), "z")
    enough = framed.groupBy("image_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return joins.present(framed, enough, "image_id")


def scale_fits(at: DataFrame, raw: DataFrame, tolerance: float = 0.05, least: int = 20) -> DataFrame:
    """(name, scale, shift, n_inliers, far): the fit of inverse depths of anchors to raw disparities (name, v, u, depth), by image."""
    looked = at.withColumn("stem", stem("name")).join(raw.select(F.col("name").alias("stem"), "v", "u", F.col("depth").cast("double").alias("raw")), ["stem", "v", "u"])
    pairs = looked.select("stem", "idx", g.inverse_depth(F.col("z")).alias("metric"), "raw")
    far = at.groupBy(stem("name").alias("stem")).agg((20 * F.max("z")).alias("far"))
    return fits.fit_groups(pairs, "stem", "idx", "metric", "raw", tolerance, least).join(far, "stem").withColumnRenamed("stem", "name")


def metric_rasters(raw: DataFrame, fitted: DataFrame, min_depth: float = 0.0, bottom: float = 0.0, height: int | None = None, sky: DataFrame | None = None) -> DataFrame:
    """(name, v, u, depth) in metres of raw disparities under their image's fit; what isn't valid is left out.

    sky: (name, v, u) of pixels to leave out.
    """
    near = F.lit(max(min_depth, 0.05))
    depth = g.metric_depth(F.col("depth").cast("double"), F.col("scale"), F.col("shift"), near, F.col("far"))
    made = raw.join(fitted.filter("scale IS NOT NULL"), "name").select("name", "v", "u", depth.alias("depth"))
    return masked(made, bottom, height, sky)


def masked(depth: DataFrame, bottom: float = 0.0, height: int | None = None, sky: DataFrame | None = None) -> DataFrame:
    """The valid depths above a bottom strip and outside the pixels (name, v, u) of the sky."""
    if bottom > 0 and height:
        depth = depth.withColumn("depth", g.above_bottom(F.col("depth"), F.col("v"), F.lit(height), bottom).cast("float"))
    if sky is not None:
        depth = depth.join(sky.select("name", "v", "u"), ["name", "v", "u"], "left_anti")
    return depth.filter("depth > 0")


def unprojected(depth: DataFrame, images: DataFrame, cameras: DataFrame, colours: DataFrame | None = None, per_image: int = 50_000, seed: int = 0) -> DataFrame:
    """(x, y, z, r, g, b) in the world of valid depths, at most per_image of an image, chosen by a hash."""
    valid = depth.filter((F.col("depth") > 0.1) & (F.col("depth") < 300))
    few = clouds.capped_sample(valid, ["name"], ["v", "u"], per_image, F.xxhash64(F.lit(seed), "v", "u"))
    posed = with_camera(images, cameras).withColumn("__stem", stem("name")).select("__stem", "qvec", "tvec", *_K)
    joined = few.join(posed, few["name"] == posed["__stem"])
    k = tuple(F.col(c) for c in _K)
    camera = g.unproject(F.col("u").cast("double"), F.col("v").cast("double"), F.col("depth").cast("double"), *k)
    world = g.to_world(g.rotation_of("qvec"), g.vector_of("tvec"), camera)
    made = joined.select("name", "v", "u", *[c.alias(n) for c, n in zip(world, "xyz", strict=True)])
    if colours is None:
        return made.select("x", "y", "z", *[F.lit(0).cast("smallint").alias(c) for c in "rgb"])
    return made.join(colours, ["name", "v", "u"]).select("x", "y", "z", "r", "g", "b")


def finalised(points: DataFrame, voxel: float, max_points: int = 5_000_000, neighbours: int = 20, ratio: float = 3.0) -> DataFrame:
    """(point_id, x, y, z, r, g, b, error, track): voxel means, coarsened until they are few enough, without outliers, with dense ids."""
    axes, colour = ["x", "y", "z"], ["r", "g", "b"]
    cloud, _, _ = clouds.voxel_escalate(points, axes, [voxel] * 3, max_points, carried=colour)
    keyed = sequences.numbered(cloud, ["x", "y", "z"], "point_id", 1).drop("n", *[c for c in cloud.columns if c.startswith("cell_")])
    keyed = materialise(keyed, "keyed")
    kept = clouds.without_outliers(keyed, "point_id", axes, neighbours, ratio, voxel * 4) if neighbours else keyed
    dense = sequences.numbered(kept.select(*axes, *colour), axes, "point_id", 1)
    track = F.array().cast("array<struct<image_id:bigint,point2d_idx:bigint>>")
    return dense.select("point_id", *axes, *[g.byte_colour(g.unit_colour(F.col(c))).alias(c) for c in colour], F.lit(0.0).alias("error"), track.alias("track"))


def from_cached_depth(depth: DataFrame, images: DataFrame, cameras: DataFrame, voxel: float, colours: DataFrame | None = None, **final) -> DataFrame:
    """The cloud of metric rasters that were kept, without inference."""
    return finalised(unprojected(depth, images, cameras, colours), voxel, **final)


def from_images(raw: DataFrame, images: DataFrame, cameras: DataFrame, points: DataFrame, voxel: float, colours: DataFrame | None = None, **mask) -> tuple[DataFrame, DataFrame]:
    """(cloud, metric rasters) of raw disparities aligned to the sparse points."""
    depth = metric_rasters(raw, scale_fits(anchors(images, cameras, points), raw), **mask)
    return from_cached_depth(depth, images, cameras, voxel, colours), depth


def scan_in_camera(cloud: DataFrame, extrinsic: list[list[float]]) -> DataFrame:
    """The points (x, y, z) of a scan in camera space; extrinsic is the 4x4 transform from the camera to the scanner."""
    inverse = np.linalg.inv(np.asarray(extrinsic, float))
    point = (F.col("x"), F.col("y"), F.col("z"))
    moved = [sum((F.lit(float(row[j])) * point[j] for j in range(3)), F.lit(float(row[3]))) for row in inverse[:3]]
    return cloud.select(*[c.alias(n) for c, n in zip(moved, "xyz", strict=True)])


def lidar_raster(cloud: DataFrame, extrinsic: list[list[float]], k: tuple[float, float, float, float], width: int, height: int) -> DataFrame:
    """(v, u, depth): least depth by pixel of a scan in camera space, of the points before the camera that it can see.

    It doesn't depend on an image's pose, so it is made once for all images.
    """
    camera = clouds.visible_from_origin(scan_in_camera(cloud, extrinsic).filter("z > 0"), ["x", "y", "z"])
    u, v = g.project((F.col("x"), F.col("y"), F.col("z")), *(F.lit(float(x)) for x in k))
    return clouds.zbuffer(camera, u, v, F.col("z"), width, height)


def lidar_fits(lidar: DataFrame, raw: DataFrame, tolerance: float = 0.05, least: int = 10) -> DataFrame:
    """(name, scale, shift, n_inliers): the fit of raw disparities to a scan's raster, by image."""
    at = raw.select("name", "v", "u", F.col("depth").cast("double").alias("raw")).join(lidar.select("v", "u", F.col("depth").alias("z")), ["v", "u"])
    pairs = at.select("name", (F.col("v") * 100_000 + F.col("u")).alias("idx"), g.inverse_depth(F.col("z")).alias("metric"), "raw")
    return fits.fit_groups(pairs, "name", "idx", "metric", "raw", tolerance, least)


def lidar_rasters(raw: DataFrame, lidar: DataFrame, images: DataFrame, cameras: DataFrame, points: DataFrame, min_depth: float = 0.0, **mask) -> DataFrame:
    """Metric rasters of images aligned to the scan, else to the sparse points; where the scan aligned an image its own depths win.

    The strip and the sky are left out of both.
    """
    sparse = scale_fits(anchors(images, cameras, points), raw).select("name", F.col("scale").alias("s2"), F.col("shift").alias("b2"), F.col("far").alias("f2"))
    scan = lidar_fits(lidar, raw).filter("scale IS NOT NULL").select("name", F.col("scale").alias("s1"), F.col("shift").alias("b1"))
    top = lidar.agg((20 * F.max("depth")).alias("top"))
    both = raw.select("name").distinct().join(scan, "name", "left").join(sparse, "name", "left").crossJoin(F.broadcast(top))
    chosen = both.select(
        "name",
        F.coalesce("s1", "s2").alias("scale"),
        F.when(F.col("s1").isNotNull(), F.col("b1")).otherwise(F.col("b2")).alias("shift"),
        F.coalesce(F.greatest("f2", "top"), F.lit(10.0)).alias("far"),
        F.col("s1").isNotNull().alias("scanned"),
    )
    made = metric_rasters(raw, chosen, min_depth)
    fill = lidar.crossJoin(F.broadcast(chosen.filter("scanned").select("name"))).select("name", "v", "u", F.col("depth").cast("float").alias("scan"))
    return masked(made.join(fill, ["name", "v", "u"], "full").select("name", "v", "u", F.coalesce("scan", "depth").alias("depth")), **mask)


def from_lidar(raw: DataFrame, lidar: DataFrame, images: DataFrame, cameras: DataFrame, points: DataFrame, voxel: float, colours: DataFrame | None = None, **mask) -> tuple[DataFrame, DataFrame]:
    """(cloud, metric rasters) of raw disparities aligned to a scan and the sparse points."""
    merged = lidar_rasters(raw, lidar, images, cameras, points, **mask)
    return from_cached_depth(merged, images, cameras, voxel, colours), merged


def position_matches(images: DataFrame, samples: DataFrame, fps: float) -> DataFrame:
    """(name, lat, lon, alt, gap): each frame's sample nearest in time, within max(2/fps, twice the median interval, 1 s)."""
    one = samples.withColumn("one", F.lit(1))
    interval = sequences.median_interval(one, ["one"], "time_sec").first()
    limit = max(2.0 / fps, 2.0 * (interval["interval"] if interval else 1.0), 1.0)
    frames = images.select("name", g.frame_time(F.col("name"), F.lit(float(fps))).alias("t"), F.lit(1).alias("one")).filter("t IS NOT NULL")
    return joins.nearest_match(frames, one, ["one"], "t", "time_sec", "seq", limit, "name", ["lat", "lon", "alt"]).drop("one")


def georegistered(images: DataFrame, points: DataFrame, samples: DataFrame, fps: float, max_error: float = 10.0, least: int = 10) -> tuple[DataFrame, DataFrame, float] | None:
    """(images, points, scale) in metres east, north and up of the first sample; None where too few positions agree.

    Matched positions are a row per image of one capture; only they come to the driver.
    """
    matched = position_matches(images, samples, fps)
    first = samples.orderBy("seq").first()
    if first is None:
        return None
    enu = g.east_north_up(F.col("lat"), F.col("lon"), F.col("alt"), *(F.lit(first[c]) for c in ("lat", "lon", "alt")))
    r, t = g.rotation_of("qvec"), g.vector_of("tvec")
    centres = images.select("name", *[c.alias(n) for c, n in zip(g.centre(r, t), ["cx", "cy", "cz"], strict=True)])
    rows: pd.DataFrame = matched.join(centres, "name").select("name", "cx", "cy", "cz", *[c.alias(n) for c, n in zip(enu, "enu", strict=True)]).orderBy("name").toPandas()
    found = fits.robust_similarity(rows[["cx", "cy", "cz"]].to_numpy(), rows[["e", "n", "u"]].to_numpy(), max_error, least)
    if found is None:
        return None
    scale, turn, move, _ = found
    return moved_images(images, scale, turn, move), moved_points(points, scale, turn, move), scale


def _constant(m: np.ndarray) -> g.Matrix:
    return tuple(tuple(F.lit(float(x)) for x in row) for row in m)


def moved_points(points: DataFrame, scale: float, turn: np.ndarray, move: np.ndarray) -> DataFrame:
    new = g.apply(_constant(scale * turn), (F.col("x"), F.col("y"), F.col("z")))
    return points.withColumns({n: c + F.lit(float(m)) for n, c, m in zip("xyz", new, move, strict=True)})


def moved_images(images: DataFrame, scale: float, turn: np.ndarray, move: np.ndarray) -> DataFrame:
    """Poses under X -> scale * turn * X + move: the rotation turns, the translation keeps the moved centre."""
    w, x, y, z = _quaternion(turn.T)
    q = [F.col("qvec")[i] for i in range(4)]
    a = [F.lit(float(v)) for v in (w, x, y, z)]
    product = (
        q[0] * a[0] - q[1] * a[1] - q[2] * a[2] - q[3] * a[3],
        q[0] * a[1] + q[1] * a[0] + q[2] * a[3] - q[3] * a[2],
        q[0] * a[2] - q[1] * a[3] + q[2] * a[0] + q[3] * a[1],
        q[0] * a[3] + q[1] * a[2] - q[2] * a[1] + q[3] * a[0],
    )
    centre = g.centre(g.rotation_of("qvec"), g.vector_of("tvec"))
    new = tuple(c + F.lit(float(m)) for c, m in zip(g.apply(_constant(scale * turn), centre), move, strict=True))
    t = g.apply(g.rotation(*product), new)
    return images.withColumns({"qvec": F.array(*product), "tvec": F.array(*[-c for c in t])})


def _quaternion(r: np.ndarray) -> tuple[float, float, float, float]:
    """w, x, y, z of a rotation: the eigenvector of the largest eigenvalue of its symmetric 4x4 form."""
    k = np.array([
        [r[0, 0] - r[1, 1] - r[2, 2], 0, 0, 0],
        [r[0, 1] + r[1, 0], r[1, 1] - r[0, 0] - r[2, 2], 0, 0],
        [r[0, 2] + r[2, 0], r[1, 2] + r[2, 1], r[2, 2] - r[0, 0] - r[1, 1], 0],
        [r[2, 1] - r[1, 2], r[0, 2] - r[2, 0], r[1, 0] - r[0, 1], r[0, 0] + r[1, 1] + r[2, 2]],
    ]) / 3
    _, vectors = np.linalg.eigh(k)
    x, y, z, w = vectors[:, -1]
    return (w, x, y, z) if w >= 0 else (-w, -x, -y, -z)


def oriented(images: DataFrame, points: DataFrame, rotation: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """A model under a rotation that the caller found for its up axis."""
    still = np.zeros(3)
    return moved_images(images, 1.0, rotation, still), moved_points(points, 1.0, rotation, still)


def united(*parts: DataFrame) -> DataFrame:
    """The clouds (x, y, z, r, g, b) of several sources or batches as one."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every
