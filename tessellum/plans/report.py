"""The quality report: series and summaries from Spark, put together as one HTML page."""

from __future__ import annotations

import base64
import html
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.kernels import images as kernels
from tessellum.operators import measures, sequences
from tessellum.plans import diagnostics


def _table(title: str, df: DataFrame, limit: int = 200) -> str:
    rows = df.limit(limit).collect()
    if not rows:
        return ""
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{html.escape(f'{v:.4g}' if isinstance(v, float) else str(v))}</td>" for v in r) + "</tr>" for r in rows)
    return f"<section><h2>{html.escape(title)}</h2><table><tr>{head}</tr>{body}</table></section>"


def _bars(title: str, df: DataFrame, width: int = 600, height: int = 160) -> str:
    """A histogram (bin, n) as inline SVG."""
    rows = {r["bin"]: r["n"] for r in df.collect()}
    if not rows:
        return ""
    step, top = width / (max(rows) + 1), max(rows.values())
    bars = "".join(f'<rect x="{b * step:.1f}" y="{height - height * n / top:.1f}" width="{step:.1f}" height="{height * n / top:.1f}"/>' for b, n in sorted(rows.items()))
    return f'<section><h2>{html.escape(title)}</h2><svg width="{width}" height="{height}">{bars}</svg></section>'


def trajectory(images: DataFrame) -> DataFrame:
    """(name, x, y, z) of the camera centres in order."""
    return diagnostics.poses(images).select("name", F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("cz").alias("z")).orderBy("name")


def observations(images: DataFrame) -> DataFrame:
    counted = images.select("name", F.size(F.filter("points2d", lambda p: p["point3d_id"] >= 0)).alias("n"))
    return counted.orderBy("n", "name")


def depth_limits(depth: DataFrame) -> DataFrame:
    """(name, p2, p98) of each raster's valid depths; 0 and 1 where there are none."""
    at = F.percentile(F.when(F.col("depth") > 0, F.col("depth").cast("double")), F.array(F.lit(0.02), F.lit(0.98)))
    got = depth.groupBy("name").agg(at.alias("p"))
    return got.select("name", F.coalesce(F.col("p")[0], F.lit(0.0)).alias("p2"), F.coalesce(F.col("p")[1], F.lit(1.0)).alias("p98"))


def _pictures(title: str, found: list[tuple[str, bytes]]) -> str:
    """PNG files (name, bytes) side by side, inside the page."""
    shown = "".join(f'<figure><img width="280" alt="{html.escape(n)}" src="data:image/png;base64,{base64.b64encode(x).decode()}"><figcaption>{html.escape(n)}</figcaption></figure>' for n, x in found)
    return f"<section><h2>{html.escape(title)}</h2>{shown}</section>" if found else ""


def sample_frames(images: DataFrame, folder: str, n: int = 9) -> list[tuple[str, bytes]]:
    """The PNG files of n evenly spaced images that are in a folder."""
    names = dict.fromkeys(r["name"] for r in sequences.even_sample(images.select("name"), ["name"], n).orderBy("slot").collect())
    paths = [Path(folder) / x for x in names]
    return [(p.name, p.read_bytes()) for p in paths if p.suffix.lower() == ".png" and p.exists()]


def depth_pictures(depth: DataFrame, n: int = 3) -> list[tuple[str, bytes]]:
    """n evenly spaced rasters in gray, near ones bright, between their percentiles of 2 and 98; empty pixels are black."""
    chosen = sequences.even_sample(depth.select("name").distinct(), ["name"], n).select("name").distinct()
    out = []
    for r in depth_limits(depth.join(chosen, "name", "left_semi")).orderBy("name").collect():
        pixels = depth.filter(F.col("name") == r["name"]).select("v", "u", "depth").toPandas()
        shade = 1 - (pixels["depth"].to_numpy(float) - r["p2"]) / max(r["p98"] - r["p2"], 1e-6)
        image = np.zeros((pixels["v"].max() + 1, pixels["u"].max() + 1), np.uint8)
        image[pixels["v"], pixels["u"]] = np.clip(shade, 0, 1) * 225 + 30
        out.append((r["name"], kernels.png(image)))
    return out


def page(stats: DataFrame, images: DataFrame, sfm_points: DataFrame, points: DataFrame, depth: DataFrame | None = None, frames: str | None = None) -> str:
    """The report; sections without data are left out.  frames: the folder of the images, for samples of them."""
    tracks = sfm_points.select(F.coalesce(F.size("track"), F.lit(0)).alias("length"))
    scene, found = diagnostics.scene_type(images, points), diagnostics.coverage(images, sfm_points)
    parts = [
        _table("Summary", stats),
        f"<section><h2>Scene</h2><pre>{html.escape(diagnostics.scene_text(scene))}</pre></section>" if scene else "",
        _table("Coverage", found.summary),
        _table("Largest translation gaps", found.worst_translation),
        _table("Trajectory", trajectory(images)),
        _table("Reprojection error", measures.positive_summary(sfm_points, "error").filter("n > 0")),
        _bars("Reprojection error", measures.error_histogram(sfm_points, "error")),
        _bars("Track length", measures.track_histogram(tracks, "length")),
        _table("Observations", observations(images)),
        _table("Sample frames", sequences.even_sample(images.select("name"), ["name"], 9).orderBy("slot")),
        _pictures("Frames", sample_frames(images, frames)) if frames else "",
        _table("Depth", depth_limits(depth)) if depth is not None else "",
        _pictures("Depth pictures", depth_pictures(depth)) if depth is not None else "",
    ]
    return f"<!doctype html><html><head><meta charset='utf-8'><title>Report</title></head><body>{''.join(parts)}</body></html>\n"
