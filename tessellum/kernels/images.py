"""Image kernels over decoded frames, a batch of rows at a time."""

from __future__ import annotations

import os
import struct
import warnings
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of a blue-green-red image, rounded to bytes."""
    if image.ndim == 2:
        return image.astype(np.float64)
    return np.rint(image[..., 0] * 0.114 + image[..., 1] * 0.587 + image[..., 2] * 0.299)


def sharpness(image: np.ndarray) -> float:
    """Population variance of the 4-neighbour Laplacian, edges mirrored without repeating them."""
    g = np.pad(gray(image), 1, mode="reflect") if min(image.shape[:2]) > 1 else np.pad(gray(image), 1, mode="edge")
    return float((g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]).var())


def _area_weights(size: int, out: int) -> np.ndarray:
    edges = np.arange(out + 1) * size / out
    low = np.maximum(np.arange(size)[None, :], edges[:-1, None])
    high = np.minimum(np.arange(1, size + 1)[None, :], edges[1:, None])
    weights = np.maximum(high - low, 0)
    return weights / weights.sum(axis=1, keepdims=True)


def descriptor(image: np.ndarray, size: int = 64) -> np.ndarray:
    """The image as size x size means of areas, rounded, less its own mean, row by row."""
    g = gray(image)
    small = np.rint(_area_weights(g.shape[0], size) @ g @ _area_weights(g.shape[1], size).T)
    return (small - small.mean()).ravel()


def bilinear(raster: np.ndarray, height: int, width: int) -> np.ndarray:
    """A raster resampled linearly, pixel centres aligned."""
    def axis(n: int, out: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.clip((np.arange(out) + 0.5) * n / out - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, n - 1), at - low

    y0, y1, fy = axis(raster.shape[0], height)
    x0, x1, fx = axis(raster.shape[1], width)
    top = raster[y0][:, x0] * (1 - fx) + raster[y0][:, x1] * fx
    bottom = raster[y1][:, x0] * (1 - fx) + raster[y1][:, x1] * fx
    return top * (1 - fy)[:, None] + bottom * fy[:, None]


def nearest(raster: np.ndarray, height: int, width: int) -> np.ndarray:
    """A class map resampled to its nearest pixels."""
    return raster[np.arange(height) * raster.shape[0] // height][:, np.arange(width) * raster.shape[1] // width]


def distorted(x: np.ndarray, y: np.ndarray, params: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Normalised coordinates under the radial and tangential terms k1 k2 p1 p2 [k3 k4 k5 k6]."""
    k1, k2, p1, p2, k3, k4, k5, k6 = [*params, 0, 0, 0, 0, 0, 0, 0, 0][:8]
    r = x * x + y * y
    radial = (1 + r * (k1 + r * (k2 + r * k3))) / (1 + r * (k4 + r * (k5 + r * k6)))
    return x * radial + 2 * p1 * x * y + p2 * (r + 2 * x * x), y * radial + p1 * (r + 2 * y * y) + 2 * p2 * x * y


def undistorted(image: np.ndarray, params: list[float], pinhole: list[float] | None = None) -> np.ndarray:
    """An image of a camera fx fy cx cy k1 k2 p1 p2 ... as a pinhole camera (by default of the same four) sees it, sampled linearly; outside is 0."""
    h, w = image.shape[:2]
    fx, fy, cx, cy = params[:4]
    nx, ny, px, py = pinhole or params[:4]
    v, u = np.indices((h, w), dtype=float)
    x, y = distorted((u - px) / nx, (v - py) / ny, list(params[4:]))
    su, sv = x * fx + cx, y * fy + cy
    ok = (su >= -1e-3) & (su <= w - 1 + 1e-3) & (sv >= -1e-3) & (sv <= h - 1 + 1e-3)
    u0, v0 = np.clip(np.floor(su), 0, w - 2).astype(int), np.clip(np.floor(sv), 0, h - 2).astype(int)
    a, b = np.clip(su - u0, 0, 1), np.clip(sv - v0, 0, 1)
    if image.ndim == 3:
        a, b, ok = a[..., None], b[..., None], ok[..., None]
    made = (image[v0, u0] * (1 - a) + image[v0, u0 + 1] * a) * (1 - b) + (image[v0 + 1, u0] * (1 - a) + image[v0 + 1, u0 + 1] * a) * b
    return np.where(ok, np.rint(made), 0).astype(image.dtype)


def frames(spark: SparkSession, folder: str, pattern: str = "*.png") -> DataFrame:
    """(name, height, width, n_channels, data) of the images of a folder; the order of names is the order of time.

    An image that can't be read has a null height and no data.
    """
    loaded = spark.read.format("image").option("pathGlobFilter", pattern).option("dropInvalid", False).load(folder)
    name = F.regexp_extract(F.col("image.origin"), r"([^/]+)$", 1)
    read = F.col("image.height") > 0
    return loaded.select(name.alias("name"), *[F.when(read, F.col(f"image.{c}")).alias(n) for c, n in (("height", "height"), ("width", "width"), ("nChannels", "n_channels"), ("data", "data"))])


def _decoded(batch: pa.RecordBatch) -> Iterator[np.ndarray | None]:
    """The images of a batch, None for those that couldn't be read."""
    for height, width, channels, data in zip(*(batch.column(c).to_pylist() for c in ("height", "width", "n_channels", "data")), strict=True):
        if not height or not data:
            yield None
            continue
        yield np.frombuffer(data, np.uint8).reshape((height, width, channels) if channels > 1 else (height, width))


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores, described = [], []
        for image in _decoded(batch):
            scores.append(0.0 if image is None else sharpness(image))
            described.append(None if image is None else descriptor(image))
        yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(scores, pa.float64()), pa.array(described, pa.list_(pa.float64()))], names=["name", "sharpness", "descriptor"])


def scored(images: DataFrame) -> DataFrame:
    """(name, sharpness, descriptor) of decoded images; 0 and null of one that couldn't be read."""
    return images.mapInArrow(_score, "name string, sharpness double, descriptor array<double>")


def _infer(batches: Iterator[pa.RecordBatch], model: Callable[[], Callable[[np.ndarray], np.ndarray]]) -> Iterator[pa.RecordBatch]:
    infer = model()
    for batch in batches:
        for name, image in zip(batch.column("name").to_pylist(), _decoded(batch), strict=True):
            if image is None:
                continue
            made = np.asarray(infer(image))
            v, u = (x.ravel().astype(np.int32) for x in np.indices(made.shape))
            yield pa.RecordBatch.from_arrays([pa.array([name] * made.size, pa.string()), pa.array(v), pa.array(u), pa.array(made.ravel().astype(np.float64))], names=["name", "v", "u", "value"])


def inferred(images: DataFrame, model: Callable[[], Callable[[np.ndarray], np.ndarray]]) -> DataFrame:
    """(name, v, u, value) of a model over decoded images: any callable that a worker makes once, for depth or class maps.

    Images that couldn't be read are left out.
    """
    return images.mapInArrow(partial(_infer, model=model), "name string, v int, u int, value double")


def rescaled(params: list[float], size: tuple[int, int], new: tuple[int, int]) -> tuple[list[float], bool]:
    """(fx fy cx cy and distortion for another image size (width, height), whether both axes scale alike).

    The distortion terms belong to normalised coordinates and stay.
    """
    sx, sy = new[0] / size[0], new[1] / size[1]
    fx, fy, cx, cy = params[:4]
    return [fx * sx, fy * sy, cx * sx, cy * sy, *params[4:]], abs(sx - sy) <= 1e-3


def _undistorted_points(u: np.ndarray, v: np.ndarray, params: list[float], rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Normalised pinhole coordinates of distorted pixels, by fixed-point steps."""
    fx, fy, cx, cy = params[:4]
    x0, y0 = (u - cx) / fx, (v - cy) / fy
    x, y = x0, y0
    for _ in range(rounds):
        dx, dy = distorted(x, y, list(params[4:]))
        x, y = x + (x0 - dx), y + (y0 - dy)
    return x, y


def best_pinhole(params: list[float], width: int, height: int, points: int = 9) -> list[float]:
    """fx fy cx cy of the pinhole camera of the same size whose whole frame is seen by the distorted one.

    Points of the frame's border are undistorted; the largest box inside what
    they bound is what the new frame shows.
    """
    along = np.linspace(0, 1, points)
    sides = {}
    for name, u, v in (("left", 0 * along, along), ("right", 0 * along + 1, along), ("top", along, 0 * along), ("bottom", along, 0 * along + 1)):
        sides[name] = _undistorted_points(u * (width - 1), v * (height - 1), params)
    left, right = sides["left"][0].max(), sides["right"][0].min()
    top, bottom = sides["top"][1].max(), sides["bottom"][1].min()
    fx, fy = (width - 1) / (right - left), (height - 1) / (bottom - top)
    return [float(fx), float(fy), float(-fx * left), float(-fy * top)]


def _undistort(batches: Iterator[pa.RecordBatch], params: list[float], pinhole: list[float]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = [None if x is None else undistorted(x, params, pinhole).tobytes() for x in _decoded(batch)]
        yield batch.set_column(batch.schema.get_field_index("data"), "data", pa.array(data, pa.binary()))


def undistorted_frames(images: DataFrame, params: list[float], size: tuple[int, int]) -> tuple[DataFrame, list[float]]:
    """(frames as their pinhole camera sees them, its fx fy cx cy) of frames of one size and a known calibration.

    size is the calibration's (width, height); parameters are rescaled to the
    frames' size, with a warning if the aspect changes.
    """
    first = images.filter("height IS NOT NULL").select("width", "height").first()
    if first is None:
        return images, list(params[:4])
    own, even = rescaled(list(params), size, (first["width"], first["height"]))
    if not even:
        warnings.warn(f"calibrated at {size}, images of {first['width']} x {first['height']}: the aspects differ", stacklevel=2)
    pinhole = best_pinhole(own, first["width"], first["height"])
    other = F.col("height").isNotNull() & ((F.col("width") != first["width"]) | (F.col("height") != first["height"]))
    checked = images.withColumn("data", F.when(other, F.raise_error(F.concat(F.lit("another size: "), "name"))).otherwise(F.col("data")).cast("binary"))
    return checked.mapInArrow(partial(_undistort, params=own, pinhole=pinhole), images.schema), pinhole


def png(image: np.ndarray) -> bytes:
    """A PNG of an image in bytes: gray, or blue-green-red."""
    rows = image if image.ndim == 2 else image[..., ::-1]
    kind = 0 if image.ndim == 2 else 2
    lines = b"".join(b"\0" + np.ascontiguousarray(row, np.uint8).tobytes() for row in rows)

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = []
        for name, image in zip(batch.column("name").to_pylist(), _decoded(batch), strict=True):
            if image is not None:
                with open(f"{folder}/{name}.new", "wb") as f:
                    f.write(png(image))
                os.replace(f"{folder}/{name}.new", f"{folder}/{name}")
                done.append(name)
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["name"])


def write_frames(images: DataFrame, folder: str) -> int:
    """The images as PNG files of a folder that all executors share, over what is there; returns how many."""
    return images.mapInArrow(partial(_write, folder=folder), "name string").count()
