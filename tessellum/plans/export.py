"""What a finished run leaves: the dataset folder, text reports, the summary and the log."""

from __future__ import annotations

import logging
import os
import shutil
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tessellum.plans import diagnostics

#: Names that a cleanup keeps beside the dataset folder.
KEPT = (
    "config.json", "report.html", "points3D.ply", "pipeline.log", "telemetry_ref_images.txt", "telemetry_transform.txt",
    "2dgs_suggested_params.txt", "coverage_report.txt",
)
MODEL_FILES = ("cameras.txt", "images.txt", "points3D.txt")


@dataclass
class Summary:
    """The figures of a run."""

    n_extracted: int = 0
    n_after_blur: int = 0
    n_after_dedup: int = 0
    n_registered: int = 0
    n_sparse: int = 0
    mean_error: float = 0.0
    georegistration: str = "none"
    up_aligned: bool = False
    densification: str = "none"
    n_dense: int = 0

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(asdict(self).values())], "n_extracted long, n_after_blur long, n_after_dedup long, n_registered long, n_sparse long, mean_error double, georegistration string, up_aligned boolean, densification string, n_dense long")

    def text(self, folder: Path, seconds: float) -> str:
        share = 100 * self.n_registered / max(self.n_after_dedup, 1)
        rows = {
            "frames extracted": f"{self.n_extracted:,}",
            "frames after the blur filter": f"{self.n_after_blur:,}",
            "frames after dedup": f"{self.n_after_dedup:,}",
            "frames registered": f"{self.n_registered:,} ({share:.1f}%)",
            "sparse points": f"{self.n_sparse:,}",
            "georegistration": self.georegistration,
            "up axis aligned": "yes" if self.up_aligned else "no",
            "densification": self.densification,
            "dense points": f"{self.n_dense:,}",
            "mean reprojection error": f"{self.mean_error:.2f} px",
            "output": str(folder),
            "time": f"{int(seconds // 60)} min {int(seconds % 60)} s",
        }
        return "\n".join(f"{k:<30}{v}" for k, v in rows.items()) + "\n"


def opened_log(folder: Path) -> logging.Logger:
    """A logger of this folder's run: console from INFO, the file pipeline.log from DEBUG; handlers of an earlier run are closed."""
    log = logging.getLogger(f"tessellum.{folder}")
    closed_log(log)
    log.setLevel(logging.DEBUG)
    log.propagate = False
    for handler, level in ((logging.StreamHandler(), logging.INFO), (logging.FileHandler(folder / "pipeline.log"), logging.DEBUG)):
        handler.setLevel(level)
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(handler)
    return log


def closed_log(log: logging.Logger) -> None:
    for handler in list(log.handlers):
        log.removeHandler(handler)
        handler.close()


def write_coverage(found: diagnostics.Coverage, folder: Path) -> str | None:
    """coverage_report.txt, unless there is too little to judge; returns the verdict."""
    row = found.summary.first()
    if row is None:
        return None
    (folder / "coverage_report.txt").write_text(diagnostics.coverage_text(found))
    return row["verdict"]


def write_suggestion(found: diagnostics.SceneType | None, folder: Path) -> None:
    """2dgs_suggested_params.txt, where the scene could be told."""
    if found is not None:
        (folder / "2dgs_suggested_params.txt").write_text(diagnostics.scene_text(found))


def dataset_folder(folder: Path) -> Path:
    """<folder>/<name>_dataset with the images and the model's text files, complete in itself.

    The images move there and a relative link stays in their place; where it is
    there already only the text files are renewed.
    """
    made = folder / f"{folder.name}_dataset"
    model = made / "sparse" / "0"
    model.mkdir(parents=True, exist_ok=True)
    images = folder / "images"
    if images.is_dir() and not images.is_symlink():
        if (made / "images").exists():
            shutil.rmtree(made / "images")
        images.rename(made / "images")
        images.symlink_to(Path(made.name) / "images")
    for name in MODEL_FILES:
        if (folder / "sparse_txt" / "0" / name).exists():
            shutil.copy2(folder / "sparse_txt" / "0" / name, model / name)
    return made


def listed(spark: SparkSession, folder: Path) -> DataFrame:
    """(name, size) of what a folder holds, folders with the bytes of all files below them."""

    def size(entry: os.DirEntry) -> int:
        if entry.is_symlink():
            return 0
        return sum(f.stat().st_size for f in Path(entry.path).rglob("*") if f.is_file()) if entry.is_dir() else entry.stat().st_size

    return spark.createDataFrame([(e.name, size(e)) for e in os.scandir(folder)], "name string, size long")


def cleaned(spark: SparkSession, folder: Path, delete: bool = False) -> tuple[int, int]:
    """(entries, bytes) beside the dataset folder and the names that are kept; they are deleted only if asked for."""
    keep = {f"{folder.name}_dataset", *KEPT}
    row = diagnostics.freed(listed(spark, folder), sorted(keep)).first()
    if delete:
        for entry in list(os.scandir(folder)):
            if entry.name in keep:
                continue
            if entry.is_dir() and not entry.is_symlink():
                shutil.rmtree(entry.path)
            else:
                os.unlink(entry.path)
    return row["n_files"], row["bytes"]
