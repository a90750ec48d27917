"""Diagnostics of a finished model: coverage, scene type, validation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.functions import geometry as g
from tessellum.operators import clouds, joins, measures, sequences

MIN_IMAGES, MIN_POINTS = 20, 500
RATIO_FLAG, ROTATION_FLAG = 0.4, 25.0


def poses(images: DataFrame) -> DataFrame:
    """(image_id, name, cx, cy, cz, dx, dy, dz, qvec) of each image; name is the order of time."""
    r, t = g.rotation_of("qvec"), g.vector_of("tvec")
    named = zip([*g.centre(r, t), *g.view_direction(r)], ["cx", "cy", "cz", "dx", "dy", "dz"], strict=True)
    return images.select("image_id", "name", *[c.alias(n) for c, n in named], "qvec")


def local_depths(images: DataFrame, points: DataFrame, least: int = 5) -> DataFrame:
    """(image_id, local_depth): median distance from a camera to the points it sees, null below `least`."""
    owners = images.select("image_id", F.transform("points2d", lambda p: p["point3d_id"]).alias("ids"))
    seen = joins.visible(owners, points.select("point_id", "x", "y", "z"), "image_id", "ids", "point_id")
    placed = seen.join(poses(images).select("image_id", "cx", "cy", "cz"), "image_id")
    distance = g.norm(g.minus((F.col("x"), F.col("y"), F.col("z")), (F.col("cx"), F.col("cy"), F.col("cz"))))
    median = placed.groupBy("image_id").agg(F.percentile(distance, F.lit(0.5)).alias("m"), F.count(F.lit(1)).alias("n"))
    return median.select("image_id", F.when(F.col("n") >= least, F.col("m")).alias("local_depth"))


def gaps(images: DataFrame, points: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(image_a, image_b, gap_m, ratio, rotation_deg) of consecutive images, ratio null where no depth is known.

    by: columns of images that part captures; without them all images are one
    capture, and its poses, a row per image, are put in order together.
    """
    keyed = images if by else images.withColumn("__capture", F.lit(0))
    by = by or ["__capture"]
    posed = poses(images).join(keyed.select("image_id", *by), "image_id").join(local_depths(images, points), "image_id", "left")
    paired = sequences.with_next(posed, by, ["name"], ["name", "cx", "cy", "cz", "qvec", "local_depth"]).filter("next_name IS NOT NULL")
    step = g.norm(g.minus(tuple(F.col(f"next_c{a}") for a in "xyz"), tuple(F.col(f"c{a}") for a in "xyz")))
    return paired.select(
        *[c for c in by if c != "__capture"],
        F.col("name").alias("image_a"),
        F.col("next_name").alias("image_b"),
        step.alias("gap_m"),
        sequences.gap_ratio(step, F.col("local_depth"), F.col("next_local_depth")).alias("ratio"),
        g.rotation_angle(g.rotation_of("qvec"), g.rotation_of("next_qvec")).alias("rotation_deg"),
    )


@dataclass
class Coverage:
    summary: DataFrame
    gaps: DataFrame
    worst_translation: DataFrame
    worst_rotation: DataFrame


def coverage(images: DataFrame, points: DataFrame, by: list[str] | None = None) -> Coverage:
    """The coverage diagnostic; its summary is empty below 20 images or 500 points."""
    between = gaps(images, points, by)
    n_t, frac_t = measures.flagged_share(F.col("ratio") > RATIO_FLAG, F.col("ratio").isNotNull())
    n_r, frac_r = measures.flagged_share(F.col("rotation_deg") > ROTATION_FLAG, F.lit(True))
    flags = between.agg(
        F.count(F.lit(1)).alias("n_gaps"), n_t.alias("n_translation_flagged"), frac_t.alias("frac_translation"), n_r.alias("n_rotation_flagged"), frac_r.alias("frac_rotation")
    )
    tracks = measures.track_stats(points.select(F.coalesce(F.size("track"), F.lit(0)).alias("length")), "length")
    counted = images.select(F.size(F.filter("points2d", lambda p: p["point3d_id"] >= 0)).alias("n"))
    seen = measures.observation_stats(counted, "n")
    sizes = images.agg(F.count(F.lit(1)).alias("n_images")).crossJoin(points.agg(F.count(F.lit(1)).alias("n_points")))
    one = sizes.crossJoin(flags).crossJoin(tracks).crossJoin(seen).filter((F.col("n_images") >= MIN_IMAGES) & (F.col("n_points") >= MIN_POINTS))
    verdict = measures.coverage_verdict(F.col("frac_translation"), F.col("frac_rotation"), F.col("mean_track_length"))
    reasons = F.concat_ws(
        "; ",
        F.when(F.col("frac_translation") > 0, F.format_string("%.0f%% of gaps are long for the depth seen (above 0.4)", F.col("frac_translation") * 100)),
        F.when(F.col("frac_rotation") > 0, F.format_string("%.0f%% of gaps turn by more than 25 degrees", F.col("frac_rotation") * 100)),
        F.when(F.col("mean_track_length").isNotNull(), F.format_string("mean track length %.1f images a point", "mean_track_length")),
    )
    summary = one.select("*", verdict.alias("verdict"), F.when(reasons == "", "no gaps found").otherwise(reasons).alias("reasoning"))
    order = ["image_a"]
    return Coverage(summary, between, sequences.top_rows(between, "ratio", order), sequences.top_rows(between, "rotation_deg", order))


def coverage_text(found: Coverage) -> str:
    """The coverage report as text; empty without a summary."""
    row = found.summary.first()
    if row is None:
        return ""
    share = lambda x: "N/A" if x is None else f"{x:.1%}"
    number = lambda x: "N/A" if x is None else f"{x:.2f}"
    lines = [
        f"Verdict: {row['verdict']}",
        f"Reasoning: {row['reasoning']}",
        f"Images: {row['n_images']}, gaps: {row['n_gaps']}",
        f"Gaps flagged by translation: {row['n_translation_flagged']} ({share(row['frac_translation'])})",
        f"Gaps flagged by rotation: {row['n_rotation_flagged']} ({share(row['frac_rotation'])})",
        f"Mean track length: {number(row['mean_track_length'])}",
        f"Weak points: {share(row['frac_weak'])}",
        f"Observations per image: mean {number(row['mean_obs'])}, least {row['min_obs']}",
        "Largest translation gaps:",
        *[f"  {r['image_a']} - {r['image_b']}: ratio {r['ratio']:.3f}, {r['gap_m']:.3f} m" for r in found.worst_translation.collect()],
        "Largest rotation gaps:",
        *[f"  {r['image_a']} - {r['image_b']}: {r['rotation_deg']:.1f} degrees" for r in found.worst_rotation.collect()],
    ]
    return "\n".join(lines) + "\n"


@dataclass(frozen=True)
class SceneType:
    scene_type: str
    depth_ratio: float
    lambda_dist: int
    convergence: float
    loop_ratio: float
    ray_rms: float
    scene_diagonal: float
    focus: tuple[float, float, float]


def scene_type(images: DataFrame, points: DataFrame) -> SceneType | None:
    """Orbit or path, from how rays meet and the trajectory closes; None below 20 images or 500 points or without extent."""
    if images.count() < MIN_IMAGES or points.count() < MIN_POINTS:
        return None
    posed = poses(images)
    focus = clouds.ray_focus(posed, ["cx", "cy", "cz"], ["dx", "dy", "dz"])
    loop = sequences.loop_closure(posed.withColumn("one", F.lit(1)), ["one"], "name", ["cx", "cy", "cz"]).first()["loop_ratio"]
    diagonal = clouds.box_diagonal(points, ["x", "y", "z"], 0.05, 0.95).first()["diagonal"]
    if focus is None or diagonal < 1e-6:
        return None
    convergence = focus[1] / diagonal
    orbit = convergence < 0.35 and loop < 0.5
    return SceneType("orbit" if orbit else "path", 1.0 if orbit else 0.0, 1000 if orbit else 0, convergence, loop, focus[1], diagonal, tuple(focus[0]))


def scene_text(found: SceneType | None) -> str:
    """The suggestion as text: flags for a training run and the numbers behind them."""
    if found is None:
        return ""
    return (
        f"Scene type: {found.scene_type}\n--depth_ratio {found.depth_ratio:g} --lambda_dist {found.lambda_dist}\n"
        f"Ray convergence: {found.convergence:.3f} (rms {found.ray_rms:.3f} m, diagonal {found.scene_diagonal:.3f} m)\nLoop closure: {found.loop_ratio:.3f}\n"
    )


def validation(images: DataFrame, points: DataFrame, files: DataFrame, min_images: int = 20, min_points: int = 1000) -> DataFrame:
    """One row: counts, images without a file, empty files, and whether all is well.  files: (name, size)."""
    lacking = joins.missing(images.select("name"), files, "name").agg(F.count(F.lit(1)).alias("n_missing"))
    counts = images.agg(F.count(F.lit(1)).alias("n_images")).crossJoin(points.agg(F.count(F.lit(1)).alias("n_points")))
    empty = files.agg(F.count_if(F.col("size") == 0).alias("n_empty"))
    one = counts.crossJoin(lacking).crossJoin(empty)
    good = (F.col("n_images") >= min_images) & (F.col("n_points") >= min_points) & (F.col("n_missing") == 0) & (F.col("n_empty") == 0)
    return one.withColumn("valid", good)


def freed(files: DataFrame, keep: list[str]) -> DataFrame:
    """One row: how many files are not among the names to keep, and their bytes; nothing is deleted."""
    rest = files.filter(~F.col("name").isin(*keep))
    return rest.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def largest_model(models: DataFrame, size: str = "n_images") -> DataFrame:
    """Of sub-models (name, size) the name of the largest, the first by name on a tie."""
    return models.agg(F.min_by("name", F.struct((-F.col(size)).alias("size"), "name")).alias("name"))
