"""Operators against hand-made cases and independent restatements."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessellum import schemas
from tessellum.functions import geometry as g
from tessellum.kernels import fits, images as kernels
from tessellum.operators import clouds, joins, measures, sequences
from tessellum.plans import densify, diagnostics, export, pipeline, report, run
from tessellum.sources import models, texts
from tessellum.streaming import incremental


def look_at(position):
    """(quaternion, R, t) of a camera that looks at the origin, z up."""
    position = np.array(position, float)
    z = -position / np.linalg.norm(position)
    x = np.cross(z, [0, 0, 1])
    x /= np.linalg.norm(x)
    r = np.stack([x, np.cross(z, x), z])
    w = math.sqrt(max(0, 1 + np.trace(r))) / 2
    if w > 1e-6:
        q = [w, (r[2, 1] - r[1, 2]) / (4 * w), (r[0, 2] - r[2, 0]) / (4 * w), (r[1, 0] - r[0, 1]) / (4 * w)]
    else:
        q = list(densify._quaternion(r))
    return [float(x) for x in q], r, -r @ position


def orbit(spark, n=24, points=600, seed=0):
    """(cameras, images, points, positions, xyz) of an orbit around a box of points."""
    draw = np.random.default_rng(seed)
    xyz = draw.uniform(-1, 1, (points, 3))
    cameras = spark.createDataFrame([(1, "PINHOLE", 320, 240, [250.0, 250.0, 160.0, 120.0])], schemas.CAMERAS)
    rows, positions, tracks = [], [], [[] for _ in range(points)]
    for i in range(n):
        a = 2 * math.pi * i / n
        p = [5 * math.cos(a), 5 * math.sin(a), 3.0]
        q, r, t = look_at(p)
        cam = xyz @ r.T + t
        uv = cam[:, :2] / cam[:, 2:] * 250 + [160, 120]
        seen = [k for k in range(points) if 0 <= uv[k, 0] < 320 and 0 <= uv[k, 1] < 240]
        obs = [(float(uv[k, 0]), float(uv[k, 1]), k + 1) for k in seen] + [(1.0, 1.0, -1), (2.0, 2.0, 10**6)]
        for j, k in enumerate(seen):
            tracks[k].append((i + 1, j))
        rows.append((i + 1, [float(x) for x in q], [float(x) for x in t], 1, f"{i + 1:06d}.png", obs))
        positions.append(p)
    images = spark.createDataFrame(rows, schemas.IMAGES)
    cloud = spark.createDataFrame([(k + 1, *map(float, xyz[k]), 10, 20, 30, 0.5, tracks[k]) for k in range(points)], schemas.POINTS)
    return cameras, images, cloud, np.array(positions), xyz


@pytest.fixture(scope="module")
def model(spark):
    cameras, images, points, positions, xyz = orbit(spark)
    return cameras.cache(), images.cache(), points.cache(), positions, xyz


def test_camera_pose_projects_the_origin_to_the_centre(spark):
    q, r, t = look_at([0, -5, 3])
    row = spark.createDataFrame([(q, [float(x) for x in t])], "qvec array<double>, tvec array<double>")
    m, v = g.rotation_of("qvec"), g.vector_of("tvec")
    u, w = g.project(g.to_camera(m, v, (F.lit(0.0),) * 3), *(F.lit(x) for x in (300.0, 300.0, 160.0, 120.0)))
    got = row.select(*[x for line in m for x in line], *g.centre(m, v), u, w).first()
    assert np.allclose(got[:9], [1, 0, 0, 0, -0.514496, -0.857493, 0, 0.857493, -0.514496], atol=1e-6)
    assert np.allclose(got[9:12], [0, -5, 3], atol=1e-10) and np.allclose(got[12:], [160, 120], atol=1e-6)


def test_rotation_gap_of_thirty_degrees(spark):
    q = [math.cos(math.radians(15)), 0.0, 0.0, math.sin(math.radians(15))]
    row = spark.createDataFrame([([1.0, 0.0, 0.0, 0.0], q)], "a array<double>, b array<double>")
    assert row.select(g.rotation_angle(g.rotation_of("a"), g.rotation_of("b"))).first()[0] == pytest.approx(30.0)


@pytest.mark.parametrize(("n", "want"), [(5, [0, 0, 1, 1, 2, 2, 3, 3, 4]), (9, list(range(9))), (100, [0, 12, 24, 37, 49, 61, 74, 86, 99]), (0, [])])
def test_even_sample(spark, n, want):
    got = sequences.even_sample(spark.range(n), ["id"]).orderBy("slot").collect()
    assert [r["id"] for r in got] == want


def test_minmax_filter_edges(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "name string, s double")
    assert measures.minmax_filter(df, [], "s", 0.5).count() == 0
    assert measures.minmax_filter(df, [], "s", 0.0).count() == 2
    wide = spark.createDataFrame([("a", 0.0), ("b", 20000.0)], "name string, s double")
    assert [r["name"] for r in measures.minmax_filter(wide, [], "s", 1.0).collect()] == ["b"]


def test_greedy_keep_holds_and_drifts(spark):
    still = spark.createDataFrame([(1, i, 0.0) for i in range(40)], "c int, i int, v double")
    kept = sequences.greedy_keep(still, ["c"], ["i"], "v", sequences.absolute, 1.0)
    assert sorted(r["i"] for r in kept.collect()) == [0, 15, 30]
    drift = spark.createDataFrame([(1, i, i * 0.4) for i in range(10)], "c int, i int, v double")
    kept = sequences.greedy_keep(drift, ["c"], ["i"], "v", sequences.absolute, 1.0)
    assert sorted(r["i"] for r in kept.collect()) == [0, 3, 6, 9]
    assert sequences.greedy_keep(drift, ["c"], ["i"], "v", sequences.absolute, 0.0).count() == 10


def test_nearest_match_ties_and_tolerance(spark):
    frames = spark.createDataFrame([("a", 1, 0.0), ("b", 1, 5.0), ("c", 1, 9.0), ("d", 1, 20.0)], "name string, one int, t double")
    samples = spark.createDataFrame([(0, 1, 6.0), (1, 1, 4.0), (2, 1, 0.0), (3, 1, 11.0)], "seq long, one int, s double")
    got = {r["name"]: r["seq"] for r in joins.nearest_match(frames, samples, ["one"], "t", "s", "seq", 2.0, "name", ["seq"]).collect()}
    assert got == {"a": 2, "b": 0, "c": 3}


def test_pairs(spark):
    names = spark.createDataFrame([(i, f"{i:02d}") for i in range(15)], "i int, name string")
    near = joins.window_pairs(names, "i", "name", 10)
    assert near.count() == sum(min(10, 14 - i) for i in range(15))
    extra = spark.createDataFrame([("14", "00"), ("01", "00")], schemas.PAIRS)
    assert joins.merged_pairs(near, extra).count() == near.count() + 1


def test_voxels_merge_in_any_order(spark):
    draw = np.random.default_rng(1)
    rows = [tuple(map(float, x)) for x in draw.uniform(-2, 2, (500, 3))]
    cloud = spark.createDataFrame(rows, schemas.CLOUD)
    random.Random(2).shuffle(rows)
    again = spark.createDataFrame(rows, schemas.CLOUD).repartition(7)
    pick = lambda df: sorted(tuple(round(x, 9) for x in r) for r in clouds.voxel_downsample(df, list("xyz"), [0.5] * 3).collect())
    assert pick(cloud) == pick(again)
    cells = {tuple(math.floor(c / 0.5) for c in r) for r in rows}
    assert len(pick(cloud)) == len(cells)
    small, grown, fits_ = clouds.voxel_escalate(cloud, list("xyz"), [0.5] * 3, 50)
    assert fits_ and grown > 0 and small.count() <= 50 and small.agg(F.sum("n")).first()[0] == 500


def test_zbuffer_truncates(spark):
    rows = [(0.2, 0.4, 5.0), (0.9, 0.9, 3.0), (-0.5, 0.0, 4.0), (-1.0, 0.0, 1.0), (2.0, 0.0, -1.0)]
    df = spark.createDataFrame(rows, "u double, v double, z double")
    got = [tuple(r) for r in clouds.zbuffer(df, F.col("u"), F.col("v"), F.col("z"), 4, 4).collect()]
    assert got == [(0, 0, 3.0)]


def test_outliers_by_brute_force(spark):
    draw = np.random.default_rng(3)
    xyz = np.concatenate([draw.normal(0, 1, (200, 3)), [[30, 30, 30], [0, 0, 90]]])
    d = np.sort(np.linalg.norm(xyz[:, None] - xyz[None], axis=2), axis=1)[:, 1:11].mean(axis=1)
    want = set(np.flatnonzero(d <= d.mean() + 2 * d.std(ddof=1)).tolist())
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xyz)], "id int, x double, y double, z double")
    assert {r["id"] for r in clouds.without_outliers(df, "id", list("xyz"), 10, 2.0, 0.3).collect()} == want


def test_outliers_of_a_dense_cell(spark):
    draw = np.random.default_rng(4)
    xyz = np.concatenate([draw.uniform(0, 1, (150, 3)), draw.uniform(0, 0.01, (60, 3)), [[0.005] * 3] * 10])
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(xyz)], "id int, x double, y double, z double")
    got = {r["id"]: r["mean_distance"] for r in clouds.neighbour_distances(df, "id", ["x", "y", "z"], 5, 2.0, densest=20).collect()}
    d = np.linalg.norm(xyz[:, None] - xyz[None], axis=2)
    np.fill_diagonal(d, np.inf)
    assert len(got) == 220 and all(abs(got[i] - np.sort(d[i])[:5].mean()) < 1e-9 for i in got)


def _shuffled(spark):
    """Records that each stage has written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}


def test_neighbours_across_blocks_shuffle_no_pairs(spark):
    draw = np.random.default_rng(8)
    xyz = np.concatenate([draw.normal(0, 0.1, (3000, 3)), [[0.01, 0.02, 0.03]] * 400, draw.normal(0, 1e6, (40, 3)), [[1e9, 0, 0]]])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xyz)], "id int, x double, y double, z double").repartition(3)
    d = np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    want = np.sort(d, axis=1)[:, :20].mean(axis=1)
    before = _shuffled(spark)
    got = {r["id"]: r["mean_distance"] for r in clouds.neighbour_distances(df, "id", list("xyz"), 20, 0.1, densest=200).collect()}
    assert len(got) == len(xyz) and all(abs(got[i] - w) <= 1e-9 * max(1, w) for i, w in enumerate(want))
    assert sum(n for s, n in _shuffled(spark).items() if s not in before) < 25 * len(xyz)


def test_neighbours_of_odd_rows(spark):
    rows = [(1, 0.0), (2, 1.0), (2, 5.0), (3, 3.0), (4, None), (None, 2.0), (5, math.nan), (6, math.inf)]
    df = spark.createDataFrame(rows, "id int, x double")
    read = lambda df, k: {r["id"]: round(r["mean_distance"], 9) for r in clouds.neighbour_distances(df, "id", ["x"], k, 1.0).collect()}
    assert read(df, 2) == {1: 2.0, 2: 1.5, 3: 2.0}  # of key 2 the nearest are 1 and twice 2 away
    assert read(df, 20) == {1: 3.0, 2: 2.5, 3: round(7 / 3, 9)}
    assert read(df.filter("id = 2"), 3) == {} and read(df.filter("id > 3"), 3) == {} and read(df.filter("id < 0"), 3) == {}


def test_ray_focus(spark):
    draw = np.random.default_rng(4)
    o = draw.uniform(-5, 5, (30, 3))
    d = np.array([1.0, 2.0, 3.0]) - o
    df = spark.createDataFrame([(*map(float, a), *map(float, b)) for a, b in zip(o, d)], "a double, b double, c double, d double, e double, f double")
    focus, rms = clouds.ray_focus(df, ["a", "b", "c"], ["d", "e", "f"])
    assert np.allclose(focus, [1, 2, 3], atol=1e-6) and rms < 1e-5
    assert clouds.ray_focus(df.limit(0), ["a", "b", "c"], ["d", "e", "f"]) is None


def test_histogram_closes_its_last_bin(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 9.9, 10.0, 10.1, -0.1)], "v double")
    assert {r["bin"]: r["n"] for r in measures.histogram(df, "v", 0, 10, 10).collect()} == {0: 2, 9: 2}
    assert measures.error_histogram(df.filter("v < 0"), "v").count() == 0


@pytest.mark.parametrize(("t", "r", "track", "want"), [(0.05, 0.0, 3.5, "Good"), (0.051, 0.0, None, "Marginal"), (0.15, 0.15, 2.5, "Marginal"), (0.0, 0.0, 2.4, "Insufficient"), (0.16, 0.0, 9.0, "Insufficient")])
def test_verdict_boundaries(spark, t, r, track, want):
    row = spark.createDataFrame([(t, r, track)], "t double, r double, k double")
    assert row.select(measures.coverage_verdict(F.col("t"), F.col("r"), F.col("k"))).first()[0] == want


def test_scale_shift_recovers_lines():
    draw = np.random.default_rng(7)
    raw = draw.uniform(1, 10, 200)
    for a, b in ((0.8, 0.3), (2.0, -0.5), (0.5, 1.0)):
        metric = a * raw + b + draw.normal(0, 0.002, 200)
        metric[:80] += draw.uniform(1, 5, 80)
        s, k, n = fits.scale_shift(metric, raw, 0.05, 20)
        assert abs(s - a) < 0.01 and abs(k - b) < 0.05 and n >= 120
    assert fits.scale_shift(-raw, raw, 0.05, 20)[0] is None
    assert fits.scale_shift(np.ones(1), np.ones(1), 0.05, 1) == (None, None, 0)
    assert fits.scale_shift(raw, np.ones(200), 0.05, 2)[0] is None


def test_similarity_is_recovered_among_outliers():
    draw = np.random.default_rng(8)
    x = draw.uniform(-10, 10, (40, 3))
    _, r, _ = look_at([3, 1, 2])
    y = 2.5 * x @ r.T + [5, 6, 7]
    y[:8] += 200
    s, rot, t, n = fits.robust_similarity(x, y, 1.0, 10)
    assert s == pytest.approx(2.5) and np.allclose(rot, r) and np.allclose(t, [5, 6, 7]) and n == 32
    assert fits.robust_similarity(x[:5], y[:5]) is None


def test_image_kernels():
    flat = np.full((80, 100, 3), 7, np.uint8)
    assert kernels.sharpness(flat) == 0 and np.allclose(kernels.descriptor(flat), 0)
    draw = np.random.default_rng(9)
    noisy = draw.integers(0, 255, (80, 100, 3)).astype(np.uint8)
    assert kernels.sharpness(noisy) > 100 and abs(kernels.descriptor(noisy).mean()) < 1e-9
    assert np.allclose(kernels.bilinear(np.arange(12.0).reshape(3, 4), 3, 4), np.arange(12.0).reshape(3, 4))
    assert (kernels.undistorted(noisy, [90, 90, 50, 40, 0, 0, 0, 0])[1:-1, 1:-1] == noisy[1:-1, 1:-1]).all()


def test_hidden_points_are_removed(spark):
    rows = [(0.0, 0.0, 1.0), (0.0, 0.0, 5.0), (3.0, 0.0, 0.1), (-3.0, 0.0, 0.1), (0.0, 0.0, 0.0), (0.0, 5000.0, 0.0)]
    seen = clouds.visible_from_origin(spark.createDataFrame(rows, schemas.CLOUD), ["x", "y", "z"])
    assert sorted(map(tuple, seen.collect())) == sorted([rows[0], rows[2], rows[3]])
    moved = densify.scan_in_camera(spark.createDataFrame(rows[:1], schemas.CLOUD), [[0, -1, 0, 1], [1, 0, 0, 2], [0, 0, 1, 3], [0, 0, 0, 1]])
    assert np.allclose(moved.first(), (-2, 1, -2))


def write_images(path, layout):
    with open(path, "wb") as f:
        f.write(struct.pack("<Q", 1) + struct.pack("<I7dI", 5, 1, 0, 0, 0, 1, 2, 3, 1) + b"a-long-name.png\0" + struct.pack("<Q", 2))
        if layout == "planar":
            f.write(struct.pack("<4d2q", 1.5, 2.5, 3.5, 4.5, 7, -1))
        else:
            f.write(struct.pack("<2dq2dq", 1.5, 2.5, 7, 3.5, 4.5, -1))


@pytest.mark.parametrize("layout", ["interleaved", "planar"])
def test_image_layouts(spark, tmp_path, layout):
    write_images(tmp_path / "images.bin", layout)
    row = models.read_images(spark, str(tmp_path / "images.bin"), layout).first()
    assert (row["image_id"], row["camera_id"], row["name"]) == (5, 1, "a-long-name.png")
    assert [tuple(p) for p in row["points2d"]] == [(1.5, 2.5, 7), (3.5, 4.5, -1)]


def test_model_files_round_trip(spark, tmp_path):
    (tmp_path / "cameras.bin").write_bytes(struct.pack("<QIIQQ4d", 1, 3, 1, 320, 240, 250, 251, 160, 120))
    assert models.read_cameras(spark, str(tmp_path / "cameras.bin")).first()["params"] == [250, 251, 160, 120]
    points = spark.createDataFrame([(2, 1.0, 2.0, 3.0, 1, 2, 255, 0.5, [(1, 2), (3, 4)]), (1, 0.0, 0.0, 0.0, 0, 0, 0, 0.0, [])], schemas.POINTS)
    assert models.write_points(points, str(tmp_path / "p.bin")) == 2
    assert sorted(map(repr, models.read_points(spark, str(tmp_path / "p.bin")).collect())) == sorted(map(repr, points.collect()))
    models.write_points(points.limit(0), str(tmp_path / "none.bin"))
    assert models.read_points(spark, str(tmp_path / "none.bin")).count() == 0
    assert tuple(models.points_stats(points).first()) == (2, 0.5)
    models.write_points_text(points, str(tmp_path / "p.txt"))
    assert (tmp_path / "p.txt").read_text().splitlines()[3:] == ["1 0.000000 0.000000 0.000000 0 0 0 0.000000 ", "2 1.000000 2.000000 3.000000 1 2 255 0.500000 1 2 3 4"]
    models.write_ply(points, str(tmp_path / "p.ply"))
    assert sorted(tuple(r) for r in models.read_cloud(spark, str(tmp_path / "p.ply")).collect()) == [(0, 0, 0), (1, 2, 3)]
    models.write_depth(np.array([[0, 1.5], [2.5, 0]]), str(tmp_path / "000001.npy"))
    assert sorted(tuple(r) for r in models.read_depth(spark, str(tmp_path)).collect()) == [("000001", 0, 1, 1.5), ("000001", 1, 0, 2.5)]


def test_srt(spark, tmp_path):
    blocks = [
        "1\n00:00:00,000 --> 00:00:00,033\n[latitude: 22.5] [longitude : 114.0]\n[rel_alt: 1.2 abs_alt: 50.0]",
        "2\n00:00:01,500 --> 00:00:01,533\nGPS (114.1, 22.6, 30.5)",
        "3\nno time GPS (1, 2, 3)",
        "4\n00:00:02,000 --> 00:00:03,000\nnothing",
        "5\n01:00:00,000 --> 01:00:01,000\nlatitude: -1 longitude: 2 rel_alt: 4",
        "6\n01:00:02,000 --> 01:00:03,000\nLATITUDE: -1.5\nLONGITUDE: 2",
    ]
    (tmp_path / "v.srt").write_text("\n\n".join(blocks))
    got = [tuple(r)[1:] for r in texts.read_srt(spark, texts.find_srt(str(tmp_path / "v.mp4"))).orderBy("seq").collect()]
    assert got == [(0.0, 22.5, 114.0, 50.0), (1.5, 22.6, 114.1, 30.5), (3600.0, -1.0, 2.0, 4.0), (3602.0, -1.5, 2.0, 0.0)]
    assert texts.find_srt(str(tmp_path / "w.mp4")) is None


def test_gpx(spark):
    point = '<trkpt lat="%s" lon="2.0">%s<time>%s</time></trkpt>'
    body = '<trkpt lon="1.0"><time>2024-01-01T00:00:00Z</time></trkpt>' + '<trkpt lat="1" lon="2"></trkpt>' + point % ("1.0", "", "2024-01-01T00:00:10Z")
    body += point % ("3.0", "<ele>7.5</ele>", "2024-01-01T00:00:11.250Z") + point % ("4.0", "", "yesterday")
    text = f"<gpx><trk><number>1</number><trkseg>{body}</trkseg></trk></gpx>"
    got = [tuple(r)[1:] for r in texts.parse_gpx(spark.createDataFrame([(text,)], "value string")).orderBy("seq").collect()]
    assert got == [(0.0, 1.0, 2.0, 0.0), (1.25, 3.0, 2.0, 7.5)]


def test_gpx_files_each_start_at_their_own_first_point(spark):
    point = '<trkpt lat="{}" lon="2"><time>{}</time></trkpt>'
    rows = []
    for name, times in {"a": ["x", "2024-01-01T00:00:05Z", "2024-01-01T00:00:07Z"], "b": ["2024-01-02T00:00:00Z", "2024-01-02T00:01:00Z"], "c": []}.items():
        body = "".join(point.format(i, t) for i, t in enumerate(times))
        rows.append((name, f"<gpx><trk><trkseg>{body}</trkseg></trk></gpx>"))
    files = spark.createDataFrame(rows, "file string, value string")
    got = sorted(tuple(r) for r in texts.parse_gpx_keyed(files, "file").collect())
    assert got == [("a", 1, 0.0, 1.0, 2.0, 0.0), ("a", 2, 2.0, 2.0, 2.0, 0.0), ("b", 0, 0.0, 0.0, 2.0, 0.0), ("b", 1, 60.0, 1.0, 2.0, 0.0)]
    assert sorted(r["time_sec"] for r in texts.parse_gpx(files).collect()) == [0.0, 0.0, 2.0, 60.0]


def test_telemetry_choice(spark):
    none, some = spark.createDataFrame([], schemas.TELEMETRY), spark.createDataFrame([(0, 0.0, 1.0, 2.0, 3.0)], schemas.TELEMETRY)
    assert texts.telemetry(none, some)[1] == "embedded" and texts.telemetry(some, some)[1] == "srt"
    assert texts.telemetry(none, some, "dji") == (None, None)


def test_calibration_and_extrinsics(spark, tmp_path):
    path = tmp_path / "c.txt"
    path.write_text("opencv\n\n640 480\n1 2 3 4 5 6 7 8\n")
    assert texts.read_calibration(spark, str(path)) == ("OPENCV", 640, 480, [1, 2, 3, 4, 5, 6, 7, 8])
    for bad in ("OPENCV\n640 480", "FISHEYE\n1 2\n1", "OPENCV\n640 480\n1 2 3"):
        path.write_text(bad)
        with pytest.raises(ValueError):
            texts.read_calibration(spark, str(path))
    assert texts.read_extrinsics(spark, None)[2] == [0, 0, 1, 0]


def test_pairs_and_config_files(spark, tmp_path):
    (tmp_path / "pairs.txt").write_text("a b\nbroken\n c  d \nx y z\n")
    pairs = texts.read_pairs(spark, str(tmp_path / "pairs.txt"))
    assert sorted(tuple(r) for r in pairs.collect()) == [("a", "b"), ("c", "d")]
    texts.write_pairs(pairs, str(tmp_path / "out"))
    assert texts.read_pairs(spark, str(tmp_path / "out")).count() == 2
    texts.write_config(texts.config_row(spark, {"fps": 5}, 9, 8, 7), str(tmp_path / "config"))
    assert texts.read_config(spark, str(tmp_path / "config")).first()["n_after_dedup"] == 7
    assert texts.read_config(spark, str(tmp_path / "absent")) is None


def test_coverage(model):
    _, images, points, positions, xyz = model
    found = diagnostics.coverage(images, points)
    row = found.summary.first()
    chord = np.linalg.norm(positions[1] - positions[0])
    assert row["n_gaps"] == 23 and row["verdict"] == "Good"
    first = found.gaps.orderBy("image_a").first()
    depth = [np.median(np.linalg.norm(xyz - p, axis=1)) for p in positions[:2]]
    assert first["gap_m"] == pytest.approx(chord) and first["ratio"] == pytest.approx(chord / np.mean(depth))
    assert "Verdict: Good" in diagnostics.coverage_text(found)
    assert diagnostics.coverage(images.limit(19), points).summary.count() == 0
    assert diagnostics.coverage(images, points.limit(499)).summary.count() == 0


def test_scene_type(spark, model):
    _, images, points, *_ = model
    found = diagnostics.scene_type(images, points)
    assert found.scene_type == "orbit" and np.allclose(found.focus, 0, atol=1e-6)
    path = images.withColumns({"qvec": F.array(*[F.lit(float(i == 0)) for i in range(4)]), "tvec": F.array(-F.col("image_id").cast("double"), F.lit(0.0), F.lit(0.0))})
    assert diagnostics.scene_type(path, points).scene_type == "path"
    assert diagnostics.scene_type(images.limit(5), points) is None


def test_validation_and_files(spark, model):
    _, images, points, *_ = model
    files = images.select("name", F.lit(5).alias("size"))
    row = diagnostics.validation(images, points, files, 20, 500).first()
    assert row["valid"] and not diagnostics.validation(images, points, files.limit(3), 20, 500).first()["valid"]
    assert tuple(diagnostics.freed(files, ["000001.png"]).first()) == (23, 115)
    subs = spark.createDataFrame([("1", 5), ("0", 5), ("2", 3)], "name string, n_images int")
    assert diagnostics.largest_model(subs).first()["name"] == "0"


def test_densify_recovers_the_points(spark, model):
    cameras, images, points, _, xyz = model
    at = densify.anchors(images, cameras, points)
    raw = at.groupBy(F.regexp_replace("name", r"\.png$", "").alias("name"), "v", "u").agg(F.min("z").alias("z"))
    raw = raw.select("name", "v", "u", ((1 / F.col("z") - 0.05) / 0.5).cast("float").alias("depth")).cache()
    cloud, depth = densify.from_images(raw, images, cameras, points, 0.02)
    got = np.array([(r["x"], r["y"], r["z"]) for r in cloud.collect()])
    away = np.linalg.norm(got[:, None] - xyz[None], axis=2).min(axis=1)
    assert len(got) > 300 and np.mean(away < 0.1) > 0.95
    ids = sorted(r["point_id"] for r in cloud.select("point_id").collect())
    assert ids == list(range(1, len(ids) + 1))
    k = (250.0, 250.0, 160.0, 120.0)
    scan = spark.createDataFrame([tuple(map(float, p + [0, 0, 6])) for p in xyz], schemas.CLOUD)
    lidar = densify.lidar_raster(scan, texts.read_extrinsics(spark, None), k, 320, 240)
    cloud, _ = densify.from_lidar(raw, lidar, images, cameras, points, 0.05)
    assert cloud.count() > 0


def test_missing_camera_is_an_error(model):
    cameras, images, *_ = model
    with pytest.raises(Exception, match="no camera"):
        densify.with_camera(images, cameras.limit(0)).collect()


def test_georegistration(spark, model):
    _, images, points, positions, xyz = model
    lat0, lon0 = 47.0, 8.0
    m = positions - positions[0]
    samples = [(i, i / 5, lat0 + 2 * p[1] / 111177.0, lon0 + 2 * p[0] / 76050.0, 400 + 2 * p[2]) for i, p in enumerate(m)]
    track = spark.createDataFrame([(i, t, float(a), float(b), float(c)) for i, t, a, b, c in samples], schemas.TELEMETRY)
    new_images, new_points, scale = densify.georegistered(images, points, track, 5.0)
    assert scale == pytest.approx(2.0, rel=0.01)
    moved = np.array([(r["cx"], r["cy"], r["cz"]) for r in diagnostics.poses(new_images).orderBy("name").collect()])
    assert np.allclose(moved - moved[0], 2 * m, atol=0.3)
    a = diagnostics.coverage(images, points).gaps.orderBy("image_a").first()["ratio"]
    b = diagnostics.coverage(new_images, new_points).gaps.orderBy("image_a").first()["ratio"]
    assert a == pytest.approx(b, rel=1e-6)
    assert densify.georegistered(images, points, track.limit(3), 5.0) is None


def test_report(spark, model):
    _, images, points, *_ = model
    text = report.page(spark.createDataFrame([(1,)], "frames int"), images, points, points)
    assert all(x in text for x in ("Summary", "Scene", "Coverage", "Reprojection error", "Track length", "Observations"))


def test_run_control():
    assert run.first_success([("a", lambda: None), ("b", lambda: 1 / 0), ("c", lambda: 3)]) == ("c", 3)
    with pytest.raises(RuntimeError):
        run.first_success([("a", lambda: None)])
    assert run.needs_retry("global", 0.79, False) and not run.needs_retry("global", 0.79, True)
    state = run.DensifyState
    assert [run.densify_branch(x) for x in (state(True), state(wanted=False), state(n_points=999), state(n_points=1000, cached_depth=5, n_images=5), state(n_points=1000, cached_depth=1, n_images=5, has_lidar=True), state(n_points=1000))] == ["reuse", "skip", "too_few", "cached", "lidar", "images"]
    assert run.placement(True, True, True, False) == ["align_up"] and run.placement(False, True, True, True) == ["telemetry"]


def test_streams_agree_with_batch(spark, tmp_path):
    rows = [(i % 3, i, float((i * 37) % 100)) for i in range(300)]
    for k in range(3):
        spark.createDataFrame(rows[k * 100 : k * 100 + 100], "c long, i long, v double").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema("c long, i long, v double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = incremental.voxel_stream(stream, ["v"], [10.0]).writeStream.format("memory").queryName("vox").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = clouds.voxel_downsample(spark.createDataFrame(rows, "c long, i long, v double"), ["v"], [10.0])
    assert sorted(map(tuple, spark.table("vox").collect())) == sorted(map(tuple, batch.collect()))
    q = incremental.greedy_keep_stream(stream, "c", "i", "v", 30.0).writeStream.format("memory").queryName("kept").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    kept = sequences.greedy_keep(spark.createDataFrame(rows, "c long, i long, v double"), ["c"], ["i"], "v", sequences.absolute, 30.0)
    assert sorted(r["i"] for r in spark.table("kept").collect()) == sorted(r["i"] for r in kept.collect())


def test_frames_are_decoded(spark, tmp_path):
    import zlib

    draw = np.random.default_rng(1).integers(0, 255, (8, 10, 3)).astype(np.uint8)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = b"".join(b"\0" + row.tobytes() for row in draw)
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 10, 8, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
    (tmp_path / "000001.png").write_bytes(png)
    (tmp_path / "000002.png").write_bytes(b"not an image")
    rows = kernels.scored(kernels.frames(spark, str(tmp_path))).orderBy("name").collect()
    assert (rows[1]["name"], rows[1]["sharpness"], rows[1]["descriptor"]) == ("000002.png", 0.0, None)
    assert kernels.png(draw[..., ::-1])[8:] == png[8:]
    made = kernels.inferred(kernels.frames(spark, str(tmp_path)), lambda: lambda image: image[..., 0] // 2)
    assert {(r["v"], r["u"]): r["value"] for r in made.collect()} == {(v, u): draw[v, u, 2] // 2 for v in range(8) for u in range(10)}
    row = rows[0]
    assert row["name"] == "000001.png" and len(row["descriptor"]) == 4096
    assert row["sharpness"] == pytest.approx(kernels.sharpness(draw[..., ::-1]))


def write_model(folder, cameras, images, points):
    """cameras.bin, images.bin and points3D.bin by plain packing."""
    folder.mkdir(parents=True)
    with open(folder / "cameras.bin", "wb") as f:
        rows = cameras.collect()
        f.write(struct.pack("<Q", len(rows)) + b"".join(struct.pack("<IIQQ4d", c["camera_id"], 1, c["width"], c["height"], *c["params"]) for c in rows))
    with open(folder / "images.bin", "wb") as f:
        rows = images.collect()
        f.write(struct.pack("<Q", len(rows)))
        for r in rows:
            f.write(struct.pack("<I7dI", r["image_id"], *r["qvec"], *r["tvec"], r["camera_id"]) + r["name"].encode() + b"\0" + struct.pack("<Q", len(r["points2d"])))
            f.write(b"".join(struct.pack("<2dq", *p) for p in r["points2d"]))
    models.write_points(points, str(folder / "points3D.bin"))


@pytest.fixture
def tools(spark, model):
    """Frames, a mapper that fails globally, raw disparities and no video."""
    cameras, images, points, positions, _ = model
    names = [r["name"] for r in images.select("name").orderBy("name").collect()]
    draw, called = np.random.default_rng(3), []

    def extract(folder, options):
        (folder / "images").mkdir()
        for i, name in enumerate([*names, *(f"{len(names) + k + 1:06d}.png" for k in range(3))]):
            image = np.full((240, 320), 90, np.uint8) if i == len(names) else draw.integers(0, 255, (240, 320)).astype(np.uint8)
            if i == len(names) + 1:
                image = last
            last = last if i == len(names) else image
            (folder / "images" / name).write_bytes(kernels.png(image))

    def reconstruct(folder, mapper):
        called.append(mapper)
        if (folder / "sparse").exists():
            import shutil

            shutil.rmtree(folder / "sparse")
        write_model(folder / "sparse" / "0", cameras, images.limit(5) if mapper == "global" else images, points)

    def disparities(images):
        at = densify.anchors(images, cameras, points)
        raw = at.groupBy(F.regexp_replace("name", r"\.png$", "").alias("name"), "v", "u").agg(F.min("z").alias("z"))
        return raw.select("name", "v", "u", ((1 / F.col("z") - 0.05) / 0.5).cast("float").alias("depth"))

    return pipeline.Tools(extract=extract, reconstruct=reconstruct, disparities=disparities), called


def test_a_whole_run(spark, model, tools, tmp_path):
    given, called = tools
    folder = tmp_path / "capture"
    options = pipeline.Options(max_frames=26, blur_threshold=0.01, dedup_threshold=0.01, voxel=0.02, min_points=300, neighbours=2, align_up=False)
    code, found = pipeline.execute(spark, str(folder), options, given)
    assert called == ["global", "incremental"]
    assert (found.n_extracted, found.n_after_blur, found.n_after_dedup, found.n_registered, found.n_sparse) == (26, 25, 24, 24, 600)
    assert found.densification == "too_few" and code == 0


def test_a_run_densifies_reports_and_resumes(spark, model, tools, tmp_path, monkeypatch):
    given, called = tools
    folder = tmp_path / "capture"
    branch = run.densify_branch
    monkeypatch.setattr(run, "densify_branch", lambda s: branch(run.DensifyState(s.has_cloud, s.wanted, s.n_points * 10, s.cached_depth, s.n_images, s.has_lidar)))
    options = pipeline.Options(blur_threshold=0.01, dedup_threshold=0.01, voxel=0.02, min_points=300, skip_sfm=True)
    code, found = pipeline.execute(spark, str(folder), options, given)
    assert code == 0 and found.densification == "images" and 300 < found.n_dense
    made = folder / "capture_dataset"
    assert (folder / "images").is_symlink() and len(list((made / "images").iterdir())) == 25
    lines = (made / "sparse" / "0" / "points3D.txt").read_text().splitlines()
    assert len(lines) == 3 + found.n_dense
    again = models.read_points(spark, str(folder / "sparse" / "0" / "points3D.bin"))
    assert again.count() == found.n_dense and models.read_sfm_points(spark, str(folder / "sparse" / "0"), again).count() == 600
    assert models.read_cloud(spark, str(folder / "points3D.ply"), 1e9).count() <= found.n_dense
    images_txt = (made / "sparse" / "0" / "images.txt").read_text().splitlines()
    assert len(images_txt) == 4 + 2 * 24 and images_txt[4].split()[-1] == "000001.png"
    assert all((folder / x).exists() for x in ("report.html", "config.json", "coverage_report.txt", "2dgs_suggested_params.txt", "pipeline.log", "pairs.txt"))
    page = (folder / "report.html").read_text()
    assert page.count("data:image/png") == 9 + 3 and "n_dense" in page
    # resumed: nothing is extracted, mapped or densified again, and the figures are those of before
    code, second = pipeline.execute(spark, str(folder), options, given)
    assert code == 0 and second.densification == "reuse" and len(called) == 2
    assert (second.n_extracted, second.n_after_dedup) == (found.n_extracted, found.n_after_dedup)
    (folder / "points3D.ply").unlink()
    code, third = pipeline.execute(spark, str(folder), options, given)
    assert third.densification == "cached" and third.n_dense == found.n_dense
    n, size = export.cleaned(spark, folder)
    assert n >= 5 and size > 0 and (folder / "depth").exists()
    export.cleaned(spark, folder, delete=True)
    assert {x.name for x in folder.iterdir()} <= {"capture_dataset", *export.KEPT}


def test_an_invalid_run_reports_and_leaves_no_dataset(spark, tools, tmp_path):
    given, _ = tools
    folder = tmp_path / "capture"
    given.up_rotation = lambda images, points: np.diag([1.0, -1.0, -1.0])
    code, found = pipeline.execute(spark, str(folder), pipeline.Options(min_points=10**6, densify=False), given)
    assert found.up_aligned and code == 1 and (folder / "report.html").exists() and not (folder / "capture_dataset").exists()


def test_a_run_is_georegistered(spark, model, tools, tmp_path):
    *_, positions, _ = model
    given, _ = tools
    m = positions - positions[0]
    track = [(i, i / 5, float(47 + 2 * p[1] / 111177.0), float(8 + 2 * p[0] / 76050.0), float(400 + 2 * p[2])) for i, p in enumerate(m)]
    given.embedded = lambda video: spark.createDataFrame(track, schemas.TELEMETRY)
    given.up_rotation = lambda images, points: np.eye(3)
    folder = tmp_path / "capture"
    code, found = pipeline.execute(spark, str(folder), pipeline.Options(densify=False, video=str(tmp_path / "clip.mp4"), min_points=300), given)
    assert code == 0 and found.georegistration == "embedded" and not found.up_aligned and found.densification == "skip"
    lines = (folder / "telemetry_ref_images.txt").read_text().splitlines()
    assert len(lines) == 24 and lines[0] == "000001.png 47.00000000 8.00000000 400.000"
    assert float((folder / "telemetry_transform.txt").read_text().split()[1]) == pytest.approx(2.0, rel=0.01)


def test_a_scan_is_fused_in_a_run(spark, model, tools, tmp_path):
    import logging

    cameras, images, points, _, xyz = model
    scan = spark.createDataFrame([(*map(float, p + [0, 0, 6]), 0, 0, 0) for p in xyz], "x double, y double, z double, r int, g int, b int")
    models.write_ply(scan, str(tmp_path / "scan.ply"))
    options = pipeline.Options(lidar=str(tmp_path / "scan.ply"))
    this = pipeline.Run(spark, tmp_path, options, tools[0], logging.getLogger("test"), cameras=cameras, images=images, points=points)
    raw = tools[0].disparities(images)
    found = this.scanned(raw, points, {"width": 320, "height": 240}, {"bottom": 0.5, "height": 240, "sky": None})
    assert found.filter("depth > 0").count() == found.count() > 0 and found.agg(F.max("v")).first()[0] < 120


def test_frames_of_a_known_calibration(spark, tmp_path):
    params = [200.0, 200.0, 160.0, 120.0, -0.2, 0.05, 0.0, 0.0]
    pinhole = kernels.best_pinhole(params, 320, 240)
    flat = np.full((240, 320), 200, np.uint8)
    made = kernels.undistorted(flat, params, pinhole)
    assert (made == 200).all()  # the whole new frame is seen
    doubled, even = kernels.rescaled(params, (320, 240), (640, 480))
    assert doubled[:4] == [400, 400, 320, 240] and doubled[4:] == params[4:] and even and not kernels.rescaled(params, (320, 240), (640, 240))[1]
    (tmp_path / "images").mkdir()
    (tmp_path / "images" / "000001.png").write_bytes(kernels.png(flat))
    frames = kernels.frames(spark, str(tmp_path / "images"))
    new, k = kernels.undistorted_frames(frames, params, (320, 240))
    assert np.allclose(k, pinhole) and kernels.write_frames(new, str(tmp_path / "images")) == 1
    assert kernels.scored(kernels.frames(spark, str(tmp_path / "images"))).first()["sharpness"] == 0


def test_depth_files_round_trip(spark, tmp_path):
    rows = [("a", 0, 1, 1.5), ("a", 2, 0, 2.5), ("b", 1, 1, 3.0)]
    assert models.write_depths(spark.createDataFrame(rows, schemas.DEPTH), 3, 2, str(tmp_path)) == 2
    assert sorted(map(tuple, models.read_depth(spark, str(tmp_path)).collect())) == rows


def test_a_shared_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace

    from tessellum import storage

    conf = SimpleNamespace(get=lambda *_: None, set=lambda *_: None)

    def session(master):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="x", getConf=lambda: conf))

    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077", "k8s://https://host"):
        with pytest.raises(RuntimeError):
            storage.shared_folder(session(master))
    assert all(storage.shared_folder(session(m)).startswith("file://") for m in ("local", "local[4]", "local[*]"))


def test_nearest_neighbours_by_brute_force(spark):
    draw = np.random.default_rng(5)
    v = np.round(draw.normal(size=(130, 4)), 1)
    v[40:60] = v[3]  # ties
    rows = [(f"k{i:03d}", v[i].tolist()) for i in range(130)]
    df = spark.createDataFrame([*rows, ("none", None), (None, [1.0, 0.0, 0.0, 0.0])], "id string, v array<double>")
    score = np.round(v @ v.T, 6)
    want = set()
    for i in range(130):
        best = sorted((-score[i, j], f"k{j:03d}") for j in range(130) if j != i)[:7]
        want |= {(f"k{i:03d}", k, -s, r + 1) for r, (s, k) in enumerate(best)}
    for size in (2048, 20):
        got = {(r["a"], r["b"], r["similarity"], r["rank"]) for r in joins.nearest_neighbours(df, "id", "v", 7, rows=size).collect()}
        assert got == want
    assert joins.nearest_neighbours(df.limit(0), "id", "v").count() == 0 and joins.nearest_neighbours(df.filter("id = 'k001'"), "id", "v").count() == 0


def test_descriptors_are_kept_alike_in_batch_and_stream(spark, tmp_path):
    draw = np.random.default_rng(6)
    rows = [(i % 2, i, [float(x) for x in np.cumsum(draw.normal(0, 30, 4))]) for i in range(60)]
    df = spark.createDataFrame(rows, "c long, i long, d array<double>")
    kept = sequences.greedy_keep(df, ["c"], ["i"], "d", sequences.mean_difference, 0.1, 5, ["i"])
    want, state = [], {}
    for c, i, d in rows:
        last, since = state.get(c, (None, 0))
        if last is None or since + 1 >= 5 or np.abs(np.array(d) - last).mean() / 255 >= 0.1:
            want.append((c, i))
            state[c] = (np.array(d), 0)
        else:
            state[c] = (last, since + 1)
    assert sorted(map(tuple, kept.collect())) == sorted(want) and len(want) < 60
    for k in range(3):
        df.filter(f"i >= {k * 20} AND i < {k * 20 + 20}").coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = incremental.greedy_keep_stream(stream, "c", "i", "d", 0.1, 5).writeStream.format("memory").queryName("described").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["c"], r["i"]) for r in spark.table("described").collect()) == sorted(want)


def test_batches_and_caps(spark):
    df = spark.createDataFrame([(f"{i:03d}",) for i in range(120)], "name string")
    sizes = {r["batch"]: r["count"] for r in sequences.batches(df, ["name"], 50).groupBy("batch").count().collect()}
    assert sizes == {0: 50, 1: 50, 2: 20}
    assert [r["name"] for r in sequences.first_rows(df, ["name"], 2).collect()] == ["000", "001"] and sequences.first_rows(df, ["name"], None).count() == 120


def test_pairs_with_tabs(spark, tmp_path):
    (tmp_path / "pairs.txt").write_text("\ta\tb \nc d e\n  f   g\n")
    assert sorted(map(tuple, texts.read_pairs(spark, str(tmp_path / "pairs.txt")).collect())) == [("a", "b"), ("f", "g")]
