"""Operators over points: voxels, z-buffers, boxes, outliers, rays."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellum.kernels import neighbours
from tessellum.storage import materialise


def cells(axes: list[str], sizes: list[float]) -> list[Column]:
    return [F.floor(F.col(a) / F.lit(float(s))).alias(f"cell_{a}") for a, s in zip(axes, sizes, strict=True)]


def voxel_sums(points: DataFrame, axes: list[str], sizes: list[float], carried: list[str] | None = None) -> DataFrame:
    """Count and sums of each grid cell: what can be merged again at any coarser multiple or with other batches."""
    carried = carried or []
    return points.groupBy(*cells(axes, sizes)).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in [*axes, *carried]])


def voxel_means(sums: DataFrame, columns: list[str]) -> DataFrame:
    kept = [c for c in sums.columns if c.startswith("cell_")]
    return sums.select(*kept, "n", *[(F.col(f"sum_{c}") / F.col("n")).alias(c) for c in columns])


def voxel_downsample(points: DataFrame, axes: list[str], sizes: list[float], carried: list[str] | None = None) -> DataFrame:
    """One row per occupied cell of a grid from the origin: cell, n, and means of the axes and carried columns."""
    return voxel_means(voxel_sums(points, axes, sizes, carried), [*axes, *(carried or [])])


def voxel_escalate(points: DataFrame, axes: list[str], sizes: list[float], max_points: int, factor: float = 1.4, tries: int = 12, carried: list[str] | None = None) -> tuple[DataFrame, int, bool]:
    """(cloud, escalations, whether it fits): means on grids that grow by `factor` until at most max_points cells are left.

    Each level is made from the points that the level before left, weighted by their counts.
    """
    columns = [*axes, *(carried or [])]
    cloud = materialise(voxel_downsample(points, axes, sizes, carried), "voxels")
    grown, scale = 0, 1.0
    while (count := cloud.count()) > max_points and grown < tries:
        scale *= factor
        grown += 1
        grouped = cloud.groupBy(*cells(axes, [s * scale for s in sizes])).agg(
            F.sum("n").alias("__n"), *[F.sum(F.col(c) * F.col("n")).alias(f"sum_{c}") for c in columns]
        )
        cloud = materialise(voxel_means(grouped.withColumnRenamed("__n", "n"), columns), "voxels")
    return cloud, grown, count <= max_points


def zbuffer(points: DataFrame, u: Column, v: Column, depth: Column, width: int, height: int, by: list[str] | None = None) -> DataFrame:
    """(by, u, v, depth): the least depth of each truncated pixel in the frame."""
    at = points.filter(depth > 0).select(*(by or []), u.cast("int").alias("u"), v.cast("int").alias("v"), depth.alias("depth"))
    framed = at.filter(F.col("u").between(0, width - 1) & F.col("v").between(0, height - 1))
    return framed.groupBy(*(by or []), "u", "v").agg(F.min("depth").alias("depth"))


def box_diagonal(df: DataFrame, axes: list[str], low: float = 0.0, high: float = 1.0, accuracy: int | None = None) -> DataFrame:
    """One row: low and high percentiles of each axis and the diagonal between them.

    Exact percentiles between the ends gather the distinct values of an axis; an
    accuracy (the error is a share of 1 / accuracy of the rows) makes them
    sketches of bounded size instead.  The ends themselves, 0 and 1, are minima
    and maxima.
    """

    def at(c: str) -> Column:
        if (low, high) == (0.0, 1.0):
            return F.array(F.min(c), F.max(c)).cast("array<double>")
        share = F.array(F.lit(low), F.lit(high))
        return F.percentile(c, share) if accuracy is None else F.percentile_approx(c, share, accuracy).cast("array<double>")

    ends = [at(c).alias(c) for c in axes]
    got = df.agg(*ends)
    span = reduce(lambda a, b: a + b, [(F.col(c)[1] - F.col(c)[0]) * (F.col(c)[1] - F.col(c)[0]) for c in axes])
    return got.select(*[F.col(c)[0].alias(f"low_{c}") for c in axes], *[F.col(c)[1].alias(f"high_{c}") for c in axes], F.sqrt(span).alias("diagonal"))


def neighbour_distances(points: DataFrame, key: str, axes: list[str], k: int, cell: float, densest: int = 4096) -> DataFrame:
    """(key, mean_distance): exact mean distance of each point to its k nearest of other keys.

    Points are dealt to blocks of at most `densest`, near ones together, by their
    place on a curve through a grid that follows their quantiles; `cell`, once a
    grid's width, changes nothing any more.  A point meets its own block first and
    then, in rounds, the nearest of the blocks whose boxes begin within the
    distance of its kth so far, until there is none.  Pairs are never shuffled,
    only points, the blocks they ask and k distances at most.  Rows without a key
    or a finite place are left out, and the rows of a key count as one, with the k
    least distances of them all.
    """
    spark = points.sparkSession
    places = [f"x{i}" for i in range(len(axes))]
    finite = reduce(lambda a, b: a & b, [F.abs(x) < float("inf") for x in places])
    cloud = points.select(F.col(key).alias("key"), *[F.col(a).cast("double").alias(x) for a, x in zip(axes, places, strict=True)])
    cloud = materialise(cloud.filter(F.col("key").isNotNull() & finite), "cloud")
    total = cloud.count()
    wanted, k = k, min(k, total - 1)
    if k < 1:
        return cloud.filter(F.lit(False)).select(F.col("key").alias(key), F.lit(0.0).alias("mean_distance"))
    copies = materialise(cloud.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "copies")
    repeated = not copies.isEmpty()
    cloud = cloud.join(copies, "key", "left").withColumn("again", F.col("copies").isNotNull()).drop("copies") if repeated else cloud.withColumn("again", F.lit(False))

    kind = dict(cloud.dtypes)["key"]
    point = ", ".join([f"key {kind}", *[f"{x} double" for x in places], "again boolean"])
    steps = F.array(*[F.lit(i / 256) for i in range(257)])
    marks = list(cloud.agg(*[F.percentile_approx(x, steps, 2000).alias(x) for x in places]).first())
    coded = cloud.select("key", *places, "again").mapInArrow(lambda rows: neighbours.curve_codes(rows, places, marks), f"{point}, code bigint")
    dealt = coded.repartitionByRange(-(-total // (8 * densest)), "code", F.xxhash64("key", *places))
    blocks = materialise(dealt.mapInArrow(lambda rows: neighbours.cut(rows, places, densest), f"{point}, block bigint, row bigint"), "blocks")
    ends = blocks.groupBy("block").agg(F.array(*[F.min(x) for x in places]).alias("low"), F.array(*[F.max(x) for x in places]).alias("high")).collect()
    boxes = neighbours.Boxes([r["block"] for r in ends], [r["low"] for r in ends], [r["high"] for r in ends])
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    parts = min(most, 2 * len(ends))

    state = ", ".join(
        [f"key {kind}, again boolean, block bigint, row bigint", *[f"{x} double" for x in places], "mean_distance double, nearest array<double>, asks array<bigint>, after double, last bigint, sure boolean"]
    )
    fan, done = 8, []
    met = blocks.repartition(parts, "block").groupBy("block").applyInArrow(lambda t: neighbours.at_home(t, places, k, boxes, 8), state)
    while True:
        met = materialise(met, "neighbours")
        done.append(met.filter("sure"))
        pending = met.filter("not sure")
        if pending.isEmpty():
            break
        fan *= 4
        asked = pending.select("row", "key", *places, F.element_at("nearest", -1).alias("reach"), F.explode("asks").alias("block"))
        crowds = F.broadcast(asked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / (16 * densest)).alias("crowds")))
        one = asked.join(crowds, "block").select("block", F.pmod("row", "crowds").alias("crowd"), "row", "key", *places, "reach")
        two = blocks.join(crowds, "block").select("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("crowds") - 1)).alias("crowd"), "key", *places)
        groups = [x.repartition(parts, "block", "crowd").groupBy("block", "crowd") for x in (one, two)]
        found = groups[0].cogroup(groups[1]).applyInArrow(lambda x, y: neighbours.answers(x, y, places, k), "row bigint, found array<double>")
        found = found.groupBy("row").agg(F.flatten(F.collect_list("found")).alias("found"))
        met = pending.join(found, "row", "left").mapInArrow(lambda rows, fan=fan: neighbours.told(rows, places, k, boxes, fan), state)
    rows = reduce(DataFrame.unionByName, done)
    means = rows.filter("not again").select("key", "mean_distance")
    if repeated:
        spread = rows.filter("again").select("key", F.explode("nearest").alias("square")).join(copies, "key")
        ranked = spread.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("square")))
        real = F.least(F.lit(wanted), F.col("copies") * (total - F.col("copies")))
        means = means.unionByName(ranked.filter(F.col("rank") <= real).groupBy("key").agg(F.avg(F.sqrt("square")).alias("mean_distance")))
    return means.withColumnRenamed("key", key)


def usual_distances(distances: DataFrame, ratio: float) -> DataFrame:
    """The rows whose mean distance is at most mean + ratio standard deviations of all."""
    limit = distances.agg((F.avg("mean_distance") + ratio * F.coalesce(F.stddev_samp("mean_distance"), F.lit(0.0))).alias("limit"))
    return distances.crossJoin(F.broadcast(limit)).filter("mean_distance <= limit").drop("limit")


def without_outliers(points: DataFrame, key: str, axes: list[str], k: int = 20, ratio: float = 3.0, cell: float = 1.0) -> DataFrame:
    """The points whose mean distance to their k nearest is at most mean + ratio standard deviations of all."""
    return points.join(usual_distances(neighbour_distances(points, key, axes, k, cell), ratio), key)


def ray_sums(rays: DataFrame, origin: list[str], direction: list[str]) -> DataFrame:
    """One row with the sums of I - dd' (xx, xy, xz, yy, yz, zz) and of (I - dd')o (x, y, z) over unit directions d."""
    size = F.sqrt(reduce(lambda a, b: a + b, [F.col(d) * F.col(d) for d in direction]))
    unit = rays.select(*[F.col(o).cast("double").alias(f"o{i}") for i, o in enumerate(origin)], *[F.try_divide(F.col(d).cast("double"), size).alias(f"d{i}") for i, d in enumerate(direction)])
    part = {(i, j): (F.lit(1.0 if i == j else 0.0) - F.col(f"d{i}") * F.col(f"d{j}")) for i in range(3) for j in range(3)}
    names = "xyz"
    matrix = [F.sum(part[i, j]).alias(f"a{names[i]}{names[j]}") for i in range(3) for j in range(i, 3)]
    right = [F.sum(part[i, 0] * F.col("o0") + part[i, 1] * F.col("o1") + part[i, 2] * F.col("o2")).alias(f"b{names[i]}") for i in range(3)]
    return unit.agg(*matrix, *right)


def ray_focus(rays: DataFrame, origin: list[str], direction: list[str]) -> tuple[list[float], float] | None:
    """(point nearest to all rays, root mean square distance to them), from two aggregations; None without rays."""
    s = ray_sums(rays, origin, direction).first()
    if s["axx"] is None:
        return None
    a = np.array([[s["axx"], s["axy"], s["axz"]], [s["axy"], s["ayy"], s["ayz"]], [s["axz"], s["ayz"], s["azz"]]])
    focus = np.linalg.lstsq(a, np.array([s["bx"], s["by"], s["bz"]]), rcond=None)[0]
    size = reduce(lambda x, y: x + y, [F.col(d) * F.col(d) for d in direction])
    off = [F.lit(float(f)) - F.col(o) for f, o in zip(focus, origin, strict=True)]
    along = reduce(lambda x, y: x + y, [o * F.col(d) for o, d in zip(off, direction, strict=True)])
    square = reduce(lambda x, y: x + y, [o * o for o in off]) - F.try_divide(along * along, size)
    rms = rays.agg(F.sqrt(F.avg(F.greatest(square, F.lit(0.0)))).alias("rms")).first()["rms"]
    return [float(x) for x in focus], float(rms)


def capped_sample(df: DataFrame, by: list[str], order: list[str], n: int, by_hash: Column | None = None) -> DataFrame:
    """At most n rows of each group, chosen by a hash of the order columns (xxhash64 by default), the same on every run."""
    first = F.xxhash64(*order) if by_hash is None else by_hash
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(first, *order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def visible_from_origin(points: DataFrame, axes: list[str], cells: int = 64, radius: float = 1000.0) -> DataFrame:
    """The points that can be seen from the origin, an approximation of hidden-point removal by a convex hull.

    Directions are dealt to a cube map of cells x cells a face, and in each cell
    only what is about as near as its nearest point is kept; nothing beyond
    `radius` times the least distance is.  The map has 6 * cells * cells rows at
    most, so it is broadcast.
    """
    x, y, z = (F.col(a) for a in axes)
    distance = F.sqrt(x * x + y * y + z * z)
    largest = F.greatest(F.abs(x), F.abs(y), F.abs(z))
    face = F.when(F.abs(x) == largest, 0).when(F.abs(y) == largest, 1).otherwise(2)
    major, first, second = (F.when(face == 0, a).when(face == 1, b).otherwise(c) for a, b, c in ((x, y, z), (y, z, x), (z, x, y)))
    cell = [F.greatest(F.lit(0), F.least(F.lit(cells - 1), F.floor((F.try_divide(c, F.abs(major)) + 1) / 2 * cells))) for c in (first, second)]
    names = ["__face", "__cu", "__cv"]
    dealt = points.filter(largest > 0).select("*", distance.alias("__distance"), (face * 2 + (major < 0).cast("int")).alias(names[0]), cell[0].alias(names[1]), cell[1].alias(names[2]))
    nearest = dealt.groupBy(*names).agg(F.min("__distance").alias("__nearest"))
    least = dealt.agg((radius * F.min("__distance")).alias("__most"))
    seen = dealt.join(F.broadcast(nearest.crossJoin(F.broadcast(least))), names)
    return seen.filter((F.col("__distance") <= F.col("__nearest") * (1 + 2.0 / cells)) & (F.col("__distance") <= F.col("__most"))).select(*points.columns)
