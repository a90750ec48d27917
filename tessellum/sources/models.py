"""Binary and text files of a sparse model, point clouds and rasters."""

from __future__ import annotations

import io
import os
import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellum import schemas


def _cameras(raw: bytes) -> list[tuple]:
    (count,), at, out = struct.unpack_from("<Q", raw), 8, []
    for _ in range(count):
        camera, model, width, height = struct.unpack_from("<IIQQ", raw, at)
        name, n = schemas.CAMERA_MODELS[model]
        out.append((camera, name, width, height, list(struct.unpack_from(f"<{n}d", raw, at + 24))))
        at += 24 + 8 * n
    return out


def _images(raw: bytes, layout: str) -> list[tuple]:
    (count,), at, out = struct.unpack_from("<Q", raw), 8, []
    for _ in range(count):
        head = struct.unpack_from("<I7dI", raw, at)
        stop = raw.index(b"\0", at + 64)
        name, at = raw[at + 64 : stop].decode(), stop + 1
        (n,) = struct.unpack_from("<Q", raw, at)
        at += 8
        if layout == "planar":
            xy = np.frombuffer(raw, "<f8", 2 * n, at).reshape(n, 2)
            ids = np.frombuffer(raw, "<i8", n, at + 16 * n)
        else:
            rows = np.frombuffer(raw, np.dtype([("x", "<f8"), ("y", "<f8"), ("id", "<i8")]), n, at)
            xy, ids = np.stack([rows["x"], rows["y"]], axis=1), rows["id"]
        at += 24 * n
        points = [{"x": float(x), "y": float(y), "point3d_id": int(i)} for (x, y), i in zip(xy, ids, strict=True)]
        out.append((head[0], list(head[1:5]), list(head[5:8]), head[8], name, points))
    return out


def _points(raw: bytes) -> list[tuple]:
    (count,), at, out = struct.unpack_from("<Q", raw), 8, []
    for _ in range(count):
        point, x, y, z, r, g, b, error, n = struct.unpack_from("<Q3d3BdQ", raw, at)
        at += 51
        flat = struct.unpack_from(f"<{2 * n}I", raw, at)
        at += 8 * n
        track = [{"image_id": i, "point2d_idx": k} for i, k in zip(flat[::2], flat[1::2], strict=True)]
        out.append((point, x, y, z, r, g, b, error, track))
    return out


def _decode(batches: Iterator[pd.DataFrame], decode, names: list[str]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for content in pdf["content"]:
            rows = decode(bytes(content))
            for first in range(0, max(len(rows), 1), 10_000):
                yield pd.DataFrame(rows[first : first + 10_000], columns=names)


def _binary(spark: SparkSession, path: str, decode, schema: str) -> DataFrame:
    names = [x.name for x in spark.createDataFrame([], schema).schema]
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(partial(_decode, decode=decode, names=names), schema)


def read_cameras(spark: SparkSession, path: str) -> DataFrame:
    """cameras.bin; an unknown model number is an error.  Records vary in size, so a file is one task: keep models as Parquet."""
    return _binary(spark, path, _cameras, schemas.CAMERAS)


def read_images(spark: SparkSession, path: str, layout: str = "interleaved") -> DataFrame:
    """images.bin; layout of the 2D points: `interleaved` x, y, id, or `planar`, all coordinates before all ids."""
    if layout not in ("interleaved", "planar"):
        raise ValueError(f"layout {layout!r}: interleaved or planar is needed")
    return _binary(spark, path, partial(_images, layout=layout), schemas.IMAGES)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return _binary(spark, path, _points, schemas.POINTS)


def read_model(spark: SparkSession, folder: str, layout: str = "interleaved") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cameras, images, points) of a folder."""
    return read_cameras(spark, f"{folder}/cameras.bin"), read_images(spark, f"{folder}/images.bin", layout), read_points(spark, f"{folder}/points3D.bin")


def points_stats(points: DataFrame) -> DataFrame:
    """One row: all points, and mean of the positive errors; reads one column of a Parquet table."""
    return points.agg(F.count(F.lit(1)).alias("n_points"), F.avg(F.when(F.col("error") > 0, F.col("error"))).alias("mean_error"))


def _streamed(rows: DataFrame, encode, path: str, head: bytes) -> None:
    """Rows, encoded in their tasks, written to one local file in their order: only finished bytes pass the driver, a partition at a time."""
    with open(path, "wb") as f:
        f.write(head)
        for part in rows.mapInArrow(encode, "chunk binary").toLocalIterator():
            f.write(part["chunk"])


def _point_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = io.BytesIO()
        for p in batch.to_pylist():
            track = [n for t in p["track"] or [] for n in (t["image_id"], t["point2d_idx"])]
            out.write(struct.pack(f"<Q3d3BdQ{len(track)}I", p["point_id"], p["x"], p["y"], p["z"], p["r"], p["g"], p["b"], p["error"], len(track) // 2, *track))
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["chunk"])


def write_points(points: DataFrame, path: str) -> int:
    """points3D.bin, by id; returns the number of points."""
    total = points.count()
    columns = ["point_id", "x", "y", "z", "r", "g", "b", "error", "track"]
    _streamed(points.select(*columns).orderBy("point_id"), _point_records, path, struct.pack("<Q", total))
    return total


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = "".join(f"{x}\n" for x in batch.column("line").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([text.encode()], pa.binary())], names=["chunk"])


def write_lines(lines: DataFrame, order: str, path: str, head: list[str] | None = None) -> None:
    """A local text file of a column `line`, in an order, under some lines of heading."""
    _streamed(lines.orderBy(order).select("line"), _lines, path, "".join(f"{x}\n" for x in head or []).encode())


def points_text(points: DataFrame) -> DataFrame:
    """(point_id, line) of the text form."""
    track = F.array_join(F.transform("track", lambda t: F.concat_ws(" ", t["image_id"].cast("string"), t["point2d_idx"].cast("string"))), " ")
    line = F.format_string("%d %.6f %.6f %.6f %d %d %d %.6f %s", "point_id", "x", "y", "z", "r", "g", "b", "error", F.coalesce(track, F.lit("")))
    return points.select("point_id", line.alias("line"))


def write_points_text(points: DataFrame, path: str) -> None:
    """points3D.txt with its three lines of comment."""
    found = points.agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce(F.size("track"), F.lit(0))).alias("length")).first()
    head = ["# 3D point list with one line of data per point:", "#   POINT3D_ID, X, Y, Z, R, G, B, ERROR, TRACK[] as (IMAGE_ID, POINT2D_IDX)"]
    write_lines(points_text(points), "point_id", path, [*head, f"# Number of points: {found['n']}, mean track length: {found['length'] or 0:g}"])


def write_model_text(cameras: DataFrame, images: DataFrame, points: DataFrame, folder: str) -> None:
    """cameras.txt, images.txt and points3D.txt of a folder, which is made if need be."""
    os.makedirs(folder, exist_ok=True)
    head = ["# Camera list with one line of data per camera:", "#   CAMERA_ID, MODEL, WIDTH, HEIGHT, PARAMS[]", f"# Number of cameras: {cameras.count()}"]
    write_lines(cameras_text(cameras), "camera_id", f"{folder}/cameras.txt", head)
    head = ["# Image list with two lines of data per image:", "#   IMAGE_ID, QW, QX, QY, QZ, TX, TY, TZ, CAMERA_ID, NAME", "#   POINTS2D[] as (X, Y, POINT3D_ID)", f"# Number of images: {images.count()}"]
    write_lines(images_text(images), "image_id", f"{folder}/images.txt", head)
    write_points_text(points, f"{folder}/points3D.txt")


def replace_points(points: DataFrame, folder: str) -> int:
    """Other points in a model's folder: points3D.bin, of which the first version is kept as points3D_sfm.bin.  Returns their number.

    They are written beside the old file and then take its place, so points that
    were read from it may be written over it.
    """
    path = f"{folder}/points3D.bin"
    total = write_points(points, f"{path}.new")
    if os.path.exists(path) and not os.path.exists(f"{folder}/points3D_sfm.bin"):
        os.replace(path, f"{folder}/points3D_sfm.bin")
    os.replace(f"{path}.new", path)
    return total


def read_sfm_points(spark: SparkSession, folder: str, fallback: DataFrame) -> DataFrame:
    """The points with tracks that a densified model keeps beside its own, else the fallback."""
    path = f"{folder}/points3D_sfm.bin"
    return read_points(spark, path) if os.path.exists(path) else fallback


def cameras_text(cameras: DataFrame) -> DataFrame:
    """(camera_id, line) of the text form."""
    params = F.array_join(F.transform("params", lambda x: x.cast("string")), " ")
    return cameras.select("camera_id", F.concat_ws(" ", F.col("camera_id").cast("string"), "model", F.col("width").cast("string"), F.col("height").cast("string"), params).alias("line"))


def images_text(images: DataFrame) -> DataFrame:
    """(image_id, line) of the text form: pose and name, then the 2D points on a second line."""
    numbers = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), " ")
    points = F.array_join(F.transform("points2d", lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"), p["point3d_id"].cast("string"))), " ")
    pose = F.concat_ws(" ", F.col("image_id").cast("string"), numbers("qvec"), numbers("tvec"), F.col("camera_id").cast("string"), "name")
    return images.select("image_id", F.concat(pose, F.lit("\n"), F.coalesce(points, F.lit(""))).alias("line"))


_PLY_KINDS = {"char": "i1", "uchar": "u1", "short": "<i2", "ushort": "<u2", "int": "<i4", "uint": "<u4", "float": "<f4", "double": "<f8"}
_PLY_KINDS |= {"int8": "i1", "uint8": "u1", "int16": "<i2", "uint16": "<u2", "int32": "<i4", "uint32": "<u4", "float32": "<f4", "float64": "<f8"}


def _ply(raw: bytes) -> np.ndarray:
    """The vertices of a PLY file, a row of x, y, z each."""
    stop = raw.index(b"end_header")
    stop = raw.index(b"\n", stop) + 1
    kind, count, fields, vertex = "", 0, [], False
    for line in raw[:stop].decode("ascii", "replace").splitlines():
        part = line.split()
        if part[:1] == ["format"]:
            kind = part[1]
        elif part[:1] == ["element"]:
            vertex = part[1] == "vertex"
            count = int(part[2]) if vertex else count
        elif part[:1] == ["property"] and vertex:
            fields.append((part[2], _PLY_KINDS[part[1]]))
    if kind == "ascii":
        rows = np.loadtxt(io.BytesIO(raw[stop:]), max_rows=count, ndmin=2) if count else np.zeros((0, len(fields)))
        return rows[:, [[n for n, _ in fields].index(c) for c in "xyz"]].astype(float)
    made = np.dtype(fields if kind == "binary_little_endian" else [(n, k.replace("<", ">")) for n, k in fields])
    rows = np.frombuffer(raw, made, count, stop)
    return np.stack([rows[c].astype(float) for c in "xyz"], axis=1)


def _clouds(batches: Iterator[pa.RecordBatch], max_range: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            xyz = _ply(content.as_buffer().to_pybytes())
            xyz = xyz[(xyz[:, 2] >= 0) & ((xyz**2).sum(axis=1) <= max_range**2)]
            for k in range(0, len(xyz), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in xyz[k : k + 100_000].T], names=["x", "y", "z"])


def read_cloud(spark: SparkSession, path: str, max_range: float = 200.0) -> DataFrame:
    """(x, y, z) of point clouds in PLY files, those with z >= 0 within max_range of the origin.  A file is one task."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(partial(_clouds, max_range=max_range), schemas.CLOUD)


_PLY_RECORD = np.dtype([(c, "<f4") for c in "xyz"] + [(c, "u1") for c in "rgb"])


def _ply_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.empty(batch.num_rows, _PLY_RECORD)
        for c in _PLY_RECORD.names:
            rows[c] = batch.column(c).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array([rows.tobytes()], pa.binary())], names=["chunk"])


def write_ply(points: DataFrame, path: str) -> int:
    """A binary little-endian PLY of x, y, z as 32-bit floats and red, green, blue; returns how many points."""
    total = points.count()
    lines = ["ply", "format binary_little_endian 1.0", f"element vertex {total}"]
    lines += [f"property float {c}" for c in "xyz"] + [f"property uchar {c}" for c in ("red", "green", "blue")] + ["end_header", ""]
    _streamed(points.select(*"xyzrgb"), _ply_records, path, "\n".join(lines).encode())
    return total


def _rasters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            raster = np.load(io.BytesIO(bytes(content)))
            v, u = np.mgrid[: raster.shape[0], : raster.shape[1]]
            name = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
            yield pd.DataFrame({"name": name, "v": v.ravel().astype(np.int32), "u": u.ravel().astype(np.int32), "depth": raster.ravel().astype(np.float32)})


def read_depth(spark: SparkSession, path: str) -> DataFrame:
    """(name, v, u, depth) of depth rasters in .npy files, without the empty pixels (0)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(path).select("path", "content")
    return files.mapInPandas(_rasters, schemas.DEPTH).filter("depth <> 0")


def write_depth(depth: np.ndarray, path: str) -> None:
    np.save(path, depth.astype(np.float32))


def _raster_files(batches: Iterator[pa.RecordBatch], height: int, width: int, folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, v, u, depth in zip(*(batch.column(c).to_pylist() for c in ("name", "v", "u", "depth")), strict=True):
            raster = np.zeros((height, width), np.float32)
            raster[np.array(v, int), np.array(u, int)] = depth
            write_depth(raster, f"{folder}/{name}.npy")
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.string())], names=["name"])


def write_depths(depth: DataFrame, height: int, width: int, folder: str) -> int:
    """A raster (name).npy of each image's depths (name, v, u, depth), 0 where there is none; returns how many.

    A raster is one task's array; the folder must be one that all executors share.
    """
    os.makedirs(folder, exist_ok=True)
    held = depth.groupBy("name").agg(*[F.collect_list(F.struct("v", "u", "depth")).alias("all")])
    rows = held.select("name", *[F.col(f"all.{c}").alias(c) for c in ("v", "u", "depth")])
    return rows.mapInArrow(partial(_raster_files, height=height, width=width, folder=folder), "name string").count()
