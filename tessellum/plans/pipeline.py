"""A whole run: from frames and a reconstruction to a dense cloud, a report and a dataset folder.

What needs a video decoder, a feature matcher, a mapper or a neural model is a
callable of the caller; everything else is made here.  Each stage first looks
whether its result is there from an earlier run with the same options.
"""

from __future__ import annotations

import hashlib
import json
import logging
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellum.kernels import images as kernels
from tessellum.operators import joins, measures, sequences
from tessellum.plans import densify, diagnostics, export, report, run
from tessellum.sources import models, texts
from tessellum.storage import materialise


@dataclass(frozen=True)
class Options:
    """What a run is asked for; lengths in metres of the model."""

    fps: float = 5.0
    max_frames: int | None = None
    blur_threshold: float = 0.0
    dedup_threshold: float = 0.0
    pattern: str = "*.png"
    neighbours: int = 10
    mapper: str = "global"
    skip_sfm: bool = False
    calibration: str | None = None
    telemetry: str = "auto"
    video: str | None = None
    align_up: bool = True
    densify: bool = True
    lidar: str | None = None
    extrinsics: str | None = None
    min_depth: float = 0.0
    mask_bottom: float = 0.0
    voxel: float = 0.05
    max_points: int = 5_000_000
    outlier_neighbours: int = 20
    outlier_ratio: float = 3.0
    min_points: int = 1000
    cleanup: bool = False

    def key(self, *names: str) -> str:
        """A hash of some options, by which a stage tells whether an earlier result is its own."""
        return hashlib.sha256(json.dumps({n: asdict(self)[n] for n in names}, sort_keys=True).encode()).hexdigest()


@dataclass
class Tools:
    """Callables of the caller; None where there is none.

    extract(folder, options): writes the frames into folder/images.
    retrieve(frames): pairs (a, b) beside those of neighbours in time.
    reconstruct(folder, mapper): writes folder/sparse/0.
    embedded(video): telemetry of a video's own track.
    up_rotation(images, points): a 3x3 rotation that sets the model upright.
    disparities(images): raw disparities (name, v, u, depth) of the frames, by stem.
    sky(images): pixels (name, v, u) to leave out.
    colours(images): (name, v, u, r, g, b) of the frames, by stem.
    """

    extract: Callable[[Path, Options], None] | None = None
    retrieve: Callable[[DataFrame], DataFrame] | None = None
    reconstruct: Callable[[Path, str], None] | None = None
    embedded: Callable[[str], DataFrame | None] | None = None
    up_rotation: Callable[[DataFrame, DataFrame], np.ndarray | None] | None = None
    disparities: Callable[[DataFrame], DataFrame] | None = None
    sky: Callable[[DataFrame], DataFrame] | None = None
    colours: Callable[[DataFrame], DataFrame] | None = None


@dataclass
class Run:
    """A folder's run and what its stages have found."""

    spark: SparkSession
    folder: Path
    options: Options
    tools: Tools
    log: logging.Logger
    summary: export.Summary = field(default_factory=export.Summary)
    cameras: DataFrame | None = None
    images: DataFrame | None = None
    points: DataFrame | None = None

    @property
    def model(self) -> Path:
        return self.folder / "sparse" / "0"

    def done(self, stage: str, key: str) -> bool:
        """Whether a stage has left a marker with this key."""
        marker = self.folder / f".{stage}.done"
        return marker.exists() and marker.read_text() == key

    def mark(self, stage: str, key: str) -> None:
        (self.folder / f".{stage}.done").write_text(key)

    # stages, in their order

    def frames(self) -> None:
        """Frames, capped, without blurred and repeated ones; figures of an earlier run are read from its config."""
        folder, o, s = self.folder / "images", self.options, self.summary
        if folder.exists() and any(folder.glob(o.pattern)):
            prior = texts.read_config(self.spark, str(self.folder / "config.json"))
            n = sum(1 for _ in folder.glob(o.pattern))
            row = prior.first() if prior is not None else None
            if row is None:
                self.log.warning("frames are there but no config.json: their figures are those of the folder")
            s.n_extracted, s.n_after_blur, s.n_after_dedup = (row["n_extracted"], row["n_after_blur"], row["n_after_dedup"]) if row else (n, n, n)
        else:
            if self.tools.extract is None:
                raise RuntimeError(f"{folder} has no frames and nothing can extract them")
            self.tools.extract(self.folder, o)
            found = kernels.scored(kernels.frames(self.spark, str(folder), o.pattern))
            capped = materialise(sequences.first_rows(found, ["name"], o.max_frames), "frames")
            sharp = materialise(measures.minmax_filter(capped, [], "sharpness", o.blur_threshold), "sharp")
            kept = materialise(sequences.greedy_keep(sharp, [], ["name"], "descriptor", sequences.mean_difference, o.dedup_threshold, keep=["name"]), "kept")
            s.n_extracted, s.n_after_blur, s.n_after_dedup = capped.count(), sharp.count(), kept.count()
            for r in joins.missing(found.select("name"), kept, "name").toLocalIterator():
                (folder / r["name"]).unlink()
        row = {"args": json.dumps(asdict(o), sort_keys=True), "n_extracted": s.n_extracted, "n_after_blur": s.n_after_blur, "n_after_dedup": s.n_after_dedup}
        (self.folder / "config.json").write_text(json.dumps(row) + "\n")

    def calibrated(self) -> None:
        """Frames as the pinhole camera of a known calibration sees them, once for each calibration."""
        if self.options.calibration is None:
            return
        model, width, height, params = texts.read_calibration(self.spark, self.options.calibration)
        key = hashlib.sha256(json.dumps([model, width, height, params]).encode()).hexdigest()
        if self.done("undistort", key):
            return
        if (self.folder / ".undistort.done").exists():
            raise RuntimeError("the frames were undistorted with another calibration; extract them again")
        frames = kernels.frames(self.spark, str(self.folder / "images"), self.options.pattern)
        made, pinhole = kernels.undistorted_frames(frames, params, (width, height))
        kernels.write_frames(made, str(self.folder / "images"))
        (self.folder / "calibration_pinhole.json").write_text(json.dumps({"model": "PINHOLE", "params": pinhole}))
        self.mark("undistort", key)

    def pairs(self) -> None:
        """pairs.txt: neighbours in time and what retrieval adds."""
        path = self.folder / "pairs.txt"
        if path.exists():
            return
        names = self.spark.createDataFrame([(x.name,) for x in sorted((self.folder / "images").glob(self.options.pattern))], "name string")
        near = joins.window_pairs(sequences.numbered(names, ["name"], "i"), "i", "name", self.options.neighbours)
        every = joins.merged_pairs(near, self.tools.retrieve(names)) if self.tools.retrieve else near
        models.write_lines(every.select("a", F.concat_ws(" ", "a", "b").alias("line")), "line", str(path))

    def reconstructed(self) -> None:
        """The sparse model; a global mapper that registers too little is followed by an incremental one."""
        there = (self.model / "cameras.bin").exists()
        reused = self.options.skip_sfm and there
        if not reused and self.tools.reconstruct is not None:
            self.tools.reconstruct(self.folder, self.options.mapper)
        elif not there:
            raise RuntimeError(f"{self.model} has no model and nothing can make one")
        self.read_model()
        if self.tools.reconstruct is not None and run.needs_retry(self.options.mapper, self.registered(), reused):
            self.log.warning("%.1f%% registered: trying the incremental mapper", 100 * self.registered())
            self.tools.reconstruct(self.folder, "incremental")
            self.read_model()
        stats = models.points_stats(self.points).first()
        self.summary.n_registered, self.summary.n_sparse, self.summary.mean_error = self.images.count(), stats["n_points"], stats["mean_error"] or 0.0

    def read_model(self) -> None:
        cameras, images, points = models.read_model(self.spark, str(self.model))
        self.cameras, self.images, self.points = (materialise(x, n) for x, n in ((cameras, "cameras"), (images, "images"), (points, "points")))

    def registered(self) -> float:
        return self.images.count() / max(self.summary.n_after_dedup, 1)

    def placed(self) -> None:
        """Metres and north by telemetry, unless a scan gives the scale; else upright, if that can be told."""
        o = self.options
        source = None
        if "telemetry" in run.placement(o.lidar is not None, o.telemetry != "off", False, False):
            srt = texts.find_srt(o.video) if o.video else None
            own = self.tools.embedded(o.video) if self.tools.embedded and o.video else None
            samples, name = texts.telemetry(texts.read_srt(self.spark, srt) if srt else None, own, o.telemetry)
            if samples is not None:
                source = self.georegister(samples, name)
        self.summary.georegistration = source or "none"
        if "align_up" in run.placement(o.lidar is not None, o.telemetry != "off", o.align_up, source is not None) and self.tools.up_rotation:
            turn = self.tools.up_rotation(self.images, self.points)
            if turn is not None:
                self.images, self.points = densify.oriented(self.images, self.points, turn)
                self.summary.up_aligned = True

    def georegister(self, samples: DataFrame, name: str) -> str | None:
        matches = densify.position_matches(self.images, samples, self.options.fps)
        models.write_lines(texts.reference_lines(matches), "line", str(self.folder / "telemetry_ref_images.txt"))
        found = densify.georegistered(self.images, self.points, samples, self.options.fps)
        if found is None:
            return None
        self.images, self.points, scale = found
        (self.folder / "telemetry_transform.txt").write_text(f"scale {scale:.9g}\n")
        return name

    def densified(self) -> DataFrame | None:
        """The dense cloud, or None if there is none or it is there already."""
        o, depth = self.options, self.folder / "depth"
        ply = self.folder / "points3D.ply"
        state = run.DensifyState(ply.exists(), o.densify, self.summary.n_sparse, sum(1 for _ in depth.glob("*.npy")), self.summary.n_registered, o.lidar is not None)
        branch = run.densify_branch(state)
        if branch in ("lidar", "images") and self.tools.disparities is None:
            branch = "skip"
        self.summary.densification = branch
        if branch in ("reuse", "skip", "too_few"):
            return None
        final = {"max_points": o.max_points, "neighbours": o.outlier_neighbours, "ratio": o.outlier_ratio}
        colours = self.tools.colours(self.images) if self.tools.colours else None
        if branch == "cached":
            rasters = models.read_depth(self.spark, str(depth))
        else:
            size = self.cameras.select("width", "height").first()
            raw = materialise(self.tools.disparities(self.images), "disparities")
            mask = {"min_depth": o.min_depth, "bottom": o.mask_bottom, "height": size["height"], "sky": self.tools.sky(self.images) if self.tools.sky else None}
            sparse = models.read_sfm_points(self.spark, str(self.model), self.points)
            if branch == "lidar":
                rasters = self.scanned(raw, sparse, size, mask)
            else:
                rasters = densify.metric_rasters(raw, densify.scale_fits(densify.anchors(self.images, self.cameras, sparse), raw), **mask)
            rasters = materialise(rasters, "rasters")
            models.write_depths(rasters, size["height"], size["width"], str(depth))
        cloud = materialise(densify.from_cached_depth(rasters, self.images, self.cameras, o.voxel, colours, **final), "dense")
        return None if cloud.isEmpty() else cloud

    def scanned(self, raw: DataFrame, sparse: DataFrame, size, mask: dict) -> DataFrame:
        o = self.options
        if o.extrinsics is None:
            self.log.warning("a scan without extrinsics: the identity is taken")
        k = self.cameras.select(*[c.alias(n) for c, n in zip(densify.g.intrinsics(F.col("model"), F.col("params")), ["fx", "fy", "cx", "cy"], strict=True)]).first()
        scan = densify.lidar_raster(models.read_cloud(self.spark, o.lidar), texts.read_extrinsics(self.spark, o.extrinsics), tuple(k), size["width"], size["height"])
        return densify.lidar_rasters(raw, materialise(scan, "scan"), self.images, self.cameras, sparse, **mask)

    def exported(self, dense: DataFrame | None) -> DataFrame:
        """The model with its cloud as binary and text files, and the cloud as PLY; returns the cloud."""
        sfm = self.points
        if dense is not None:
            self.summary.n_dense = models.replace_points(dense, str(self.model))
            self.points = dense
        models.write_model_text(self.cameras, self.images, self.points, str(self.folder / "sparse_txt" / "0"))
        if self.summary.densification != "reuse":
            models.write_ply(self.points, str(self.folder / "points3D.ply"))
        return models.read_sfm_points(self.spark, str(self.model), sfm) if dense is None else sfm

    def reported(self, sfm: DataFrame, seconds: float) -> bool:
        """Suggestion, coverage, validation, summary and report; returns whether the result is valid."""
        o = self.options
        export.write_suggestion(diagnostics.scene_type(self.images, self.points), self.folder)
        verdict = export.write_coverage(diagnostics.coverage(self.images, sfm), self.folder)
        if verdict and verdict != "Good":
            self.log.warning("coverage: %s, see coverage_report.txt", verdict)
        files = self.spark.createDataFrame([(x.name, x.stat().st_size) for x in (self.folder / "images").iterdir()], "name string, size long")
        checked = diagnostics.validation(self.images, self.points, files, min_points=o.min_points).first()
        self.log.info("\n%s", self.summary.text(self.folder, seconds))
        rasters = models.read_depth(self.spark, str(self.folder / "depth")) if any((self.folder / "depth").glob("*.npy")) else None
        page = report.page(self.summary.table(self.spark), self.images, sfm, self.points, rasters, str(self.folder / "images"))
        (self.folder / "report.html").write_text(page)
        return bool(checked["valid"])


def execute(spark: SparkSession, folder: str, options: Options = Options(), tools: Tools = Tools()) -> tuple[int, export.Summary]:
    """(exit code, figures) of a run in a local folder that all executors share.

    An invalid result gives code 1 after its report is written, and no dataset folder.
    """
    start, path = time.monotonic(), Path(folder)
    path.mkdir(parents=True, exist_ok=True)
    log = export.opened_log(path)
    try:
        this = Run(spark, path, options, tools, log)
        for stage in (this.frames, this.calibrated, this.pairs, this.reconstructed, this.placed):
            log.debug("stage %s", stage.__name__)
            stage()
        sfm = this.exported(this.densified())
        valid = this.reported(sfm, time.monotonic() - start)
        if not valid:
            log.error("the result is not valid")
            return run.exit_code(valid), this.summary
        log.info("dataset: %s", export.dataset_folder(path))
        if options.cleanup:
            n, size = export.cleaned(spark, path, delete=True)
            log.info("cleanup: %d entries, %.1f MB", n, size / 1e6)
        return run.exit_code(valid), this.summary
    finally:
        export.closed_log(log)
