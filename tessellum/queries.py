"""Registered queries of the operators over the standard tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellum import schemas
from tessellum.functions import geometry as g
from tessellum.kernels import fits
from tessellum.operators import clouds, joins, measures, sequences
from tessellum.plans import densify, diagnostics, report
from tessellum.sources import models, texts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(ts: str = "ts") -> Column:
    """Seconds of a timestamp without time zone since 2024 began."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', {ts})") / 1e6


def settled(column: str, digits: int) -> Column:
    """A mean of few-digit numbers, rounded.  It may lie halfway between two roundings and a hair off by the order of
    its sum; a billionth more, in the SQL too, takes it above."""
    return F.round(F.col(column) + 1e-9, digits)


_SECONDS = "(date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 1e6)"


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    paired = sequences.with_next(events, ["user_id"], ["ts", "event_id"], ["value"])
    gap = F.abs(F.col("next_value") - F.col("value"))
    return paired.select("event_id", "user_id", F.round(sequences.gap_ratio(gap, F.col("value"), F.col("next_value")), 6).alias("ratio"))


_GAPS = """SELECT event_id, user_id, round(CASE WHEN coalesce((value + nv) / 2, value, nv) > 1e-6 THEN abs(nv - value) / coalesce((value + nv) / 2, value, nv) END, 6) AS ratio
FROM (SELECT *, lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nv FROM events)"""


@query(_GAPS)
def gap_metrics(spark, sf_dir):
    return _gaps(spark, sf_dir)


@query(f"SELECT event_id, user_id, ratio FROM ({_GAPS}) WHERE ratio IS NOT NULL ORDER BY ratio DESC, event_id LIMIT 5")
def top_gaps(spark, sf_dir):
    return sequences.top_rows(_gaps(spark, sf_dir), "ratio", ["event_id"], 5)


@query(f"""SELECT n_flagged, round(frac, 9) AS frac, round(track, 6) AS track,
CASE WHEN frac > 0.15 OR track < 2.5 THEN 'Insufficient' WHEN frac > 0.05 OR track < 3.5 THEN 'Marginal' ELSE 'Good' END AS verdict
FROM (SELECT count(*) FILTER (WHERE ratio > 0.4) AS n_flagged, coalesce(count(*) FILTER (WHERE ratio > 0.4) / nullif(count(ratio), 0)::DOUBLE, 0) AS frac FROM ({_GAPS})),
(SELECT avg(n) AS track FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey))""")
def coverage_verdict(spark, sf_dir):
    valid = F.col("ratio").isNotNull()
    n, share = measures.flagged_share(F.col("ratio") > 0.4, valid)
    flags = _gaps(spark, sf_dir).agg(n.alias("n_flagged"), share.alias("frac"))
    lengths = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    both = flags.crossJoin(F.broadcast(measures.track_stats(lengths, "n")))
    verdict = measures.coverage_verdict(F.col("frac"), F.lit(0.0), F.col("mean_track_length"))
    return both.select("n_flagged", F.round("frac", 9).alias("frac"), F.round("mean_track_length", 6).alias("track"), verdict.alias("verdict"))


@query("""SELECT event_id, event_type, value FROM events JOIN (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type) USING (event_type)
WHERE (value - lo) / (hi - lo + 1e-12) >= 0.5""")
def minmax_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return measures.minmax_filter(events, ["event_type"], "value", 0.5).select("event_id", "event_type", "value")


@query("""WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
w AS (SELECT user_id, event_id, value AS last, 0 AS since, rn, TRUE AS kept FROM e WHERE rn = 1
UNION ALL SELECT e.user_id, e.event_id, CASE WHEN abs(e.value - w.last) >= 50 OR w.since + 1 >= 15 THEN e.value ELSE w.last END,
CASE WHEN abs(e.value - w.last) >= 50 OR w.since + 1 >= 15 THEN 0 ELSE w.since + 1 END, e.rn, abs(e.value - w.last) >= 50 OR w.since + 1 >= 15
FROM w JOIN e ON e.user_id = w.user_id AND e.rn = w.rn + 1)
SELECT user_id, event_id FROM w WHERE kept""")
def greedy_dedup(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    return sequences.greedy_keep(events, ["user_id"], ["ts", "event_id"], "value", sequences.absolute, 50.0, 15, ["event_id"])


@query(f"""WITH v AS (SELECT event_id, user_id, {_SECONDS} AS t FROM events WHERE event_type = 'view'),
c AS (SELECT event_id AS click_id, user_id, {_SECONDS} AS ct FROM events WHERE event_type = 'click')
SELECT user_id, event_id, t, click_id, round(gap, 6) AS gap FROM (SELECT v.*, c.click_id, abs(ct - t) AS gap,
row_number() OVER (PARTITION BY v.event_id ORDER BY abs(ct - t), click_id) AS rn FROM v JOIN c USING (user_id) WHERE abs(ct - t) <= 21600) WHERE rn = 1""")
def nearest_asof(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", seconds().alias("t"))
    views = events.filter("event_type = 'view'").select("event_id", "user_id", "t")
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("t").alias("ct"))
    found = joins.nearest_match(views, clicks, ["user_id"], "t", "ct", "click_id", 21600.0, "event_id", ["click_id"])
    return found.withColumn("gap", F.round("gap", 6))


_WINDOW_PAIRS = "SELECT x.vec_id AS a, y.vec_id AS b FROM embeddings x JOIN embeddings y ON y.vec_id > x.vec_id AND y.vec_id <= x.vec_id + 10"
_KNN = """SELECT a, b, similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b)::INT AS rank FROM
(SELECT x.vec_id AS a, y.vec_id AS b, round(list_dot_product(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 6) AS similarity FROM embeddings x JOIN embeddings y ON x.vec_id <> y.vec_id)) WHERE rank <= 20"""


@query(_WINDOW_PAIRS)
def window_pairs(spark, sf_dir):
    return joins.window_pairs(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id", "vec_id", 10)


@query(_KNN)
def knn_top20(spark, sf_dir):
    return joins.nearest_neighbours(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 20)


@query(f"SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM ({_WINDOW_PAIRS} UNION ALL SELECT a, b FROM ({_KNN}))")
def merge_pairs(spark, sf_dir):
    return joins.merged_pairs(window_pairs(spark, sf_dir), knn_top20(spark, sf_dir))


@query("""SELECT o_orderkey, count(*) AS n, round(median(l_extendedprice), 4) AS median_price FROM (SELECT o_orderkey, unnest([o_orderkey, o_orderkey + 1, o_orderkey, -1, 1000000000000000]) AS ref FROM orders)
JOIN lineitem ON ref = l_orderkey GROUP BY o_orderkey HAVING count(*) >= 5""")
def visible_join(spark, sf_dir):
    """Owners with repeated, dangling and negative references."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    owners = table(spark, sf_dir, "orders").select("o_orderkey", F.array("o_orderkey", F.col("o_orderkey") + 1, "o_orderkey", F.lit(-1).cast("bigint"), F.lit(10**15).cast("bigint")).alias("refs"))
    seen = joins.visible(owners, items, "o_orderkey", "refs", "l_orderkey")
    grouped = seen.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.percentile("l_extendedprice", F.lit(0.5)), 4).alias("median_price"))
    return grouped.filter("n >= 5")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def left_semi_files(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.present(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), items, "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def left_anti_missing(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.missing(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), items, "o_orderkey")


@query("""SELECT floor(l_quantity / 5)::BIGINT AS cq, floor(l_extendedprice / 5000)::BIGINT AS ce, floor(l_discount / 0.02)::BIGINT AS cd, count(*) AS n,
round(avg(l_quantity) + 1e-9, 4) AS q, round(avg(l_extendedprice) + 1e-9, 3) AS e, round(avg(l_discount) + 1e-9, 5) AS d FROM lineitem GROUP BY ALL""")
def voxel_downsample(spark, sf_dir):
    axes = ["l_quantity", "l_extendedprice", "l_discount"]
    got = clouds.voxel_downsample(table(spark, sf_dir, "lineitem").select(*axes), axes, [5.0, 5000.0, 0.02])
    return got.select(
        F.col("cell_l_quantity").alias("cq"), F.col("cell_l_extendedprice").alias("ce"), F.col("cell_l_discount").alias("cd"), "n",
        settled("l_quantity", 4).alias("q"), settled("l_extendedprice", 3).alias("e"), settled("l_discount", 5).alias("d"),
    )


def _escalation(most: int, tries: int) -> str:
    levels = ["l0 AS MATERIALIZED (SELECT sum(1)::BIGINT AS n, avg(l_quantity) AS q, avg(l_extendedprice) AS e FROM lineitem GROUP BY floor(l_quantity / 5), floor(l_extendedprice / 2000))"]
    scale = 1.0
    for k in range(1, tries + 1):
        scale *= 1.4
        before = f"l{k - 1}"
        levels.append(
            f"l{k} AS MATERIALIZED (SELECT sum(n)::BIGINT AS n, sum(q * n) / sum(n) AS q, sum(e * n) / sum(n) AS e FROM {before} WHERE (SELECT count(*) FROM {before}) > {most} "
            f"GROUP BY floor(q / {5.0 * scale!r}::DOUBLE), floor(e / {2000.0 * scale!r}::DOUBLE) UNION ALL SELECT * FROM {before} WHERE (SELECT count(*) FROM {before}) <= {most})"
        )
    return f"WITH {', '.join(levels)} SELECT n, round(q + 1e-9, 4) AS q, round(e + 1e-9, 2) AS e FROM l{tries}"


@query(_escalation(120, 6))
def voxel_escalate(spark, sf_dir):
    axes = ["l_quantity", "l_extendedprice"]
    cloud, _, _ = clouds.voxel_escalate(table(spark, sf_dir, "lineitem").select(*axes), axes, [5.0, 2000.0], 120, tries=6)
    return cloud.select("n", settled("l_quantity", 4).alias("q"), settled("l_extendedprice", 2).alias("e"))


@query("""SELECT trunc(l_quantity / (l_discount + 0.5))::INT AS u, trunc(100 * l_tax / (l_discount + 0.5))::INT AS v, min(l_extendedprice) AS depth FROM lineitem
WHERE l_extendedprice > 0 AND trunc(l_quantity / (l_discount + 0.5)) BETWEEN 0 AND 99 AND trunc(100 * l_tax / (l_discount + 0.5)) BETWEEN 0 AND 19 GROUP BY ALL""")
def zbuffer_min(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_quantity", "l_tax", "l_discount", "l_extendedprice")
    away = F.col("l_discount") + 0.5
    return clouds.zbuffer(items, F.col("l_quantity") / away, 100 * F.col("l_tax") / away, F.col("l_extendedprice"), 100, 20)


@query("""WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
d AS (SELECT a.vec_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS dist FROM p a JOIN p b ON a.vec_id <> b.vec_id),
m AS (SELECT vec_id, avg(dist) AS md FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist) AS rn FROM d) WHERE rn <= 20 GROUP BY vec_id)
SELECT vec_id, round(md, 6) AS mean_distance FROM m WHERE md <= (SELECT avg(md) + 2 * stddev_samp(md) FROM m)""")
def knn_outliers(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings").select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate("xyz")])
    distances = clouds.neighbour_distances(points, "vec_id", ["x", "y", "z"], 20, 0.1)
    return clouds.usual_distances(distances, 2.0).select("vec_id", F.round("mean_distance", 6).alias("mean_distance"))


@query("SELECT round(sqrt(pow(max(l_quantity) - min(l_quantity), 2) + pow(max(l_extendedprice) - min(l_extendedprice), 2)), 4) AS diagonal FROM lineitem")
def bbox_diag(spark, sf_dir):
    return clouds.box_diagonal(table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"]).select(F.round("diagonal", 4).alias("diagonal"))


@query("""SELECT round(quantile_cont(l_quantity, 0.05), 4) AS low_q, round(quantile_cont(l_quantity, 0.95), 4) AS high_q,
round(quantile_cont(l_extendedprice, 0.05), 4) AS low_e, round(quantile_cont(l_extendedprice, 0.95), 4) AS high_e FROM lineitem""")
def percentile_box(spark, sf_dir):
    box = clouds.box_diagonal(table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"], 0.05, 0.95)
    names = {"low_l_quantity": "low_q", "high_l_quantity": "high_q", "low_l_extendedprice": "low_e", "high_l_extendedprice": "high_e"}
    return box.select(*[F.round(k, 4).alias(v) for k, v in names.items()])


@query("""SELECT user_id, round(diag, 6) AS diagonal, round(CASE WHEN diag < 1e-9 THEN 0 ELSE sqrt(pow(lv - fv, 2) + pow(le - fe, 2)) / diag END, 6) AS loop_ratio FROM
(SELECT user_id, sqrt(pow(max(value) - min(value), 2) + pow(max(event_id) - min(event_id), 2)) AS diag,
arg_min(value, ts) AS fv, arg_max(value, ts) AS lv, arg_min(event_id, ts) AS fe, arg_max(event_id, ts) AS le FROM events GROUP BY user_id)""")
def loop_closure(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "value", F.col("event_id").cast("double").alias("at"))
    got = sequences.loop_closure(events, ["user_id"], "ts", ["value", "at"])
    return got.select("user_id", F.round("diagonal", 6).alias("diagonal"), F.round("loop_ratio", 6).alias("loop_ratio"))


@query("""WITH r AS (SELECT embedding[1]::DOUBLE AS o0, embedding[2]::DOUBLE AS o1, embedding[3]::DOUBLE AS o2, embedding[4]::DOUBLE AS p0, embedding[5]::DOUBLE AS p1, embedding[6]::DOUBLE AS p2 FROM embeddings),
u AS (SELECT o0, o1, o2, p0 / sqrt(p0*p0 + p1*p1 + p2*p2) AS d0, p1 / sqrt(p0*p0 + p1*p1 + p2*p2) AS d1, p2 / sqrt(p0*p0 + p1*p1 + p2*p2) AS d2 FROM r)
SELECT round(sum(1 - d0*d0), 6) AS axx, round(sum(-d0*d1), 6) AS axy, round(sum(-d0*d2), 6) AS axz, round(sum(1 - d1*d1), 6) AS ayy, round(sum(-d1*d2), 6) AS ayz, round(sum(1 - d2*d2), 6) AS azz,
round(sum((1 - d0*d0) * o0 - d0*d1*o1 - d0*d2*o2), 6) AS bx, round(sum(-d1*d0*o0 + (1 - d1*d1) * o1 - d1*d2*o2), 6) AS by, round(sum(-d2*d0*o0 - d2*d1*o1 + (1 - d2*d2) * o2), 6) AS bz FROM u""")
def ray_normal_sums(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    rays = e.select(*[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(["o0", "o1", "o2", "p0", "p1", "p2"])])
    sums = clouds.ray_sums(rays, ["o0", "o1", "o2"], ["p0", "p1", "p2"])
    return sums.select(*[F.round(c, 6).alias(c) for c in sums.columns])


@query("""SELECT (SELECT count(*) FROM lineitem) AS n_points, round((SELECT avg(l_discount) FROM lineitem WHERE l_discount > 0), 6) AS mean_error,
(SELECT count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem)) AS n_registered,
round((SELECT count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem)) / (SELECT count(*) FROM orders)::DOUBLE, 6) AS reg_rate""")
def quality_stats(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    total = table(spark, sf_dir, "orders").count()
    got = measures.quality_stats(items.select("l_discount"), items.select("l_orderkey").distinct(), "l_discount", total)
    return got.select("n_points", F.round("mean_error", 6).alias("mean_error"), "n_registered", F.round("reg_rate", 6).alias("reg_rate"))


@query("""SELECT round(avg(n), 6) AS mean_track_length, round(avg((n < 3)::INT), 6) AS frac_weak, min(n) AS min_obs, max(n) AS max_obs
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""")
def track_stats(spark, sf_dir):
    lengths = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    both = measures.track_stats(lengths, "n").crossJoin(F.broadcast(measures.observation_stats(lengths, "n")))
    return both.select(F.round("mean_track_length", 6).alias("mean_track_length"), F.round("frac_weak", 6).alias("frac_weak"), "min_obs", "max_obs")


@query("""SELECT least(floor(l_extendedprice / 50000 * 100), 99)::INT AS bin, count(*) AS n FROM lineitem WHERE l_extendedprice > 0 AND l_extendedprice <= 50000 GROUP BY ALL""")
def error_histogram(spark, sf_dir):
    return measures.error_histogram(table(spark, sf_dir, "lineitem").select("l_extendedprice"), "l_extendedprice", 100, 50000.0)


@query("""WITH t AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey), m AS (SELECT max(n) AS top FROM t),
p AS (SELECT greatest(least(top + 1, 50), 2) AS high, greatest(1, least(60, top)) AS bins FROM m)
SELECT least(floor((n - 1)::DOUBLE / (high - 1) * bins), bins - 1)::INT AS bin, count(*) AS n FROM t, p WHERE n >= 1 AND n <= high GROUP BY 1""")
def track_histogram(spark, sf_dir):
    lengths = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return measures.track_histogram(lengths, "n")


@query(f"""SELECT user_id, round(coalesce(median(step), 1.0), 7) AS interval FROM (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS step
FROM (SELECT user_id, {_SECONDS} AS t FROM events)) GROUP BY user_id""")
def median_interval(spark, sf_dir):
    got = sequences.median_interval(table(spark, sf_dir, "events").select("user_id", seconds().alias("t")), ["user_id"], "t")
    return got.select("user_id", F.round("interval", 7).alias("interval"))


@query("""WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position, count(*) OVER () AS total FROM orders)
SELECT slot::INT AS slot, o_orderkey FROM range(9) s(slot), o WHERE position = slot * (total - 1) // 8""")
def even_sample(spark, sf_dir):
    return sequences.even_sample(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 9).select("slot", "o_orderkey")


def _poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(7)])
    size = F.sqrt(F.col("e0") * F.col("e0") + F.col("e1") * F.col("e1") + F.col("e2") * F.col("e2") + F.col("e3") * F.col("e3"))
    return e.select("vec_id", F.array(*[F.col(f"e{i}") / size for i in range(4)]).alias("q"), F.array("e4", "e5", "e6").alias("t"))


_R = """(WITH e AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE AS c, embedding[4]::DOUBLE AS d, embedding[5]::DOUBLE AS tx, embedding[6]::DOUBLE AS ty, embedding[7]::DOUBLE AS tz FROM embeddings),
n AS (SELECT vec_id, a / s AS w, b / s AS x, c / s AS y, d / s AS z, tx, ty, tz FROM (SELECT *, sqrt(a*a + b*b + c*c + d*d) AS s FROM e))
SELECT vec_id, 1 - 2*(y*y + z*z) AS r00, 2*(x*y - w*z) AS r01, 2*(x*z + w*y) AS r02, 2*(x*y + w*z) AS r10, 1 - 2*(x*x + z*z) AS r11, 2*(y*z - w*x) AS r12,
2*(x*z - w*y) AS r20, 2*(y*z + w*x) AS r21, 1 - 2*(x*x + y*y) AS r22, tx, ty, tz FROM n)"""


@query(f"""SELECT vec_id, round(-(r00*tx + r10*ty + r20*tz), 6) AS cx, round(-(r01*tx + r11*ty + r21*tz), 6) AS cy, round(-(r02*tx + r12*ty + r22*tz), 6) AS cz,
round(r20, 6) AS dx, round(r21, 6) AS dy, round(r22, 6) AS dz FROM {_R}""")
def pose_rotation(spark, sf_dir):
    r, t = g.rotation_of("q"), g.vector_of("t")
    c, d = g.centre(r, t), g.view_direction(r)
    return _poses(spark, sf_dir).select("vec_id", *[F.round(x, 6).alias(n) for x, n in zip([*c, *d], ["cx", "cy", "cz", "dx", "dy", "dz"], strict=True)])


@query(f"""SELECT vec_id, round(CASE WHEN lead(r00) OVER w IS NOT NULL THEN degrees(acos(greatest(-1, least(1, (r00*lead(r00) OVER w + r01*lead(r01) OVER w + r02*lead(r02) OVER w + r10*lead(r10) OVER w + r11*lead(r11) OVER w + r12*lead(r12) OVER w
+ r20*lead(r20) OVER w + r21*lead(r21) OVER w + r22*lead(r22) OVER w - 1) / 2)))) END, 4) AS degrees FROM {_R} WINDOW w AS (PARTITION BY vec_id // 100 ORDER BY vec_id)""")
def rotation_gap(spark, sf_dir):
    poses = _poses(spark, sf_dir).withColumn("capture", F.floor(F.col("vec_id") / 100))
    paired = sequences.with_next(poses, ["capture"], ["vec_id"], ["q"])
    angle = g.rotation_angle(g.rotation_of("q"), g.rotation_of("next_q"))
    return paired.select("vec_id", F.round(F.when(F.col("next_q").isNotNull(), angle), 4).alias("degrees"))


@query(f"""SELECT vec_id, round(300 * x / z + 160, 4) AS u, round(300 * y / z + 120, 4) AS v, round(z, 6) AS depth, 1.0::DOUBLE AS back_x, 2.0::DOUBLE AS back_y, 3.0::DOUBLE AS back_z
FROM (SELECT vec_id, r00 + 2*r01 + 3*r02 + tx AS x, r10 + 2*r11 + 3*r12 + ty AS y, r20 + 2*r21 + 3*r22 + tz AS z FROM {_R}) WHERE z > 0.1""")
def project_unproject(spark, sf_dir):
    r, t = g.rotation_of("q"), g.vector_of("t")
    k = tuple(F.lit(x) for x in (300.0, 300.0, 160.0, 120.0))
    camera = g.to_camera(r, t, (F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    seen = _poses(spark, sf_dir).select("vec_id", "q", "t", *[c.alias(n) for c, n in zip(camera, "xyz", strict=True)]).filter("z > 0.1")
    u, v = g.project((F.col("x"), F.col("y"), F.col("z")), *k)
    world = g.to_world(r, t, g.unproject(u, v, F.col("z"), *k))
    back = [F.round(c, 6).alias(n) for c, n in zip(world, ["back_x", "back_y", "back_z"], strict=True)]
    return seen.select("vec_id", F.round(u, 4).alias("u"), F.round(v, 4).alias("v"), F.round("z", 6).alias("depth"), *back)


@query("""SELECT l_linenumber, count(*) AS n, count(*) FILTER (WHERE d > 0) AS n_valid, round(sum(d), 2) AS total FROM
(SELECT l_linenumber, CASE WHEN l_quantity >= 50 - floor(50 * 0.1) THEN 0 WHEN i > 1e-6 AND 1 / greatest(i, 1e-9) > 0.1 AND 1 / greatest(i, 1e-9) < 20 THEN (1 / greatest(i, 1e-9))::FLOAT::DOUBLE ELSE 0 END AS d
FROM (SELECT *, 2.0::DOUBLE * l_discount - 0.02::DOUBLE AS i FROM lineitem)) GROUP BY l_linenumber""")
def disparity_depth(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_quantity", "l_discount")
    depth = g.metric_depth(F.col("l_discount"), F.lit(2.0), F.lit(-0.02), F.lit(0.1), F.lit(20.0)).cast("double")
    masked = items.select("l_linenumber", g.above_bottom(depth, F.col("l_quantity"), F.lit(50), 0.1).alias("d"))
    return masked.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("d") > 0).alias("n_valid"), F.round(F.sum("d"), 2).alias("total"))


@query("""SELECT event_id, (event_id % 3600) + (event_id % 1000) / 1000.0::DOUBLE AS time_sec, round(20 + value / 100, 6) AS lat, round(110 + value / 100, 6) AS lon, round(value, 2) AS alt FROM events""")
def time_parse_srt(spark, sf_dir):
    """Subtitle texts made of events, one per event, and parsed again."""
    e = table(spark, sf_dir, "events").select("event_id", "value")
    clock = F.format_string("00:%02d:%02d,%03d", F.floor(F.col("event_id") % 3600 / 60).cast("int"), (F.col("event_id") % 60).cast("int"), (F.col("event_id") % 1000).cast("int"))
    keyed = F.format_string("1\n%s --> 00:59:59,999\n[latitude: %.6f] [longitude : %.6f] [rel_alt: 1.0 abs_alt: %.2f]", clock, 20 + F.col("value") / 100, 110 + F.col("value") / 100, "value")
    triple = F.format_string("1\n%s --> 00:59:59,999\nGPS (%.6f, %.6f, %.2f)", clock, 110 + F.col("value") / 100, 20 + F.col("value") / 100, "value")
    made = e.select("event_id", F.when(F.col("event_id") % 2 == 0, keyed).otherwise(triple).alias("value"))
    return texts.parse_srt_keyed(made, "event_id").select("event_id", "time_sec", "lat", "lon", "alt")


@query(f"""SELECT user_id, seq, round(t - min(t) OVER (PARTITION BY user_id), 3) AS time_sec, round(20 + value / 100, 6) AS lat, round(110 + value / 100, 6) AS lon, 0.0::DOUBLE AS alt
FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq, value, floor({_SECONDS}) AS t FROM events)""")
def gpx_parse(spark, sf_dir):
    """A track made of each user's events and parsed again; elevations are missing."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    point = F.format_string('<trkpt lat="%.6f" lon="%.6f"><time>%s</time></trkpt>', 20 + F.col("value") / 100, 110 + F.col("value") / 100, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", point.alias("p")))), lambda x: x["p"]), "")
    made = events.groupBy("user_id").agg(F.concat(F.lit("<gpx><trk><trkseg>"), body, F.lit("</trkseg></trk></gpx>")).alias("value"))
    return texts.parse_gpx_keyed(made, "user_id").select("user_id", "seq", F.round("time_sec", 3).alias("time_sec"), "lat", "lon", "alt")


_SAMPLED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(f"""SELECT l_returnflag, {', '.join(_SAMPLED)} FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY md5(concat_ws('|', {', '.join(_SAMPLED)})), {', '.join(_SAMPLED)}) AS rn FROM lineitem) WHERE rn <= 10""")
def hash_sample(spark, sf_dir):
    """The rows of a deterministic sample of at most ten a group, in the order of a hash that SQL has too."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", *_SAMPLED)
    return clouds.capped_sample(items, ["l_returnflag"], _SAMPLED, 10, F.md5(F.concat_ws("|", *_SAMPLED)))


@query("""SELECT event_type, 2.0::DOUBLE AS scale, 3.0::DOUBLE AS shift, count(*) FILTER (WHERE event_id % 5 <> 0) AS n_inliers FROM events GROUP BY event_type""")
def ransac_fit(spark, sf_dir):
    """Lines through groups of which every fifth row lies far off."""
    off = F.when(F.col("event_id") % 5 == 0, 50 + F.col("event_id") % 89).otherwise(0)
    e = table(spark, sf_dir, "events").select("event_type", "event_id", "value", (2 * F.col("value") + 3 + off).alias("metric"))
    found = fits.fit_groups(e, "event_type", "event_id", "metric", "value", 0.05, 20)
    return found.select("event_type", F.round("scale", 6).alias("scale"), F.round("shift", 6).alias("shift"), "n_inliers")


@query("""SELECT label, count(*) AS n, round(1 + label / 10.0::DOUBLE, 6) AS scale, round(cos(radians(20 + 5 * label)), 6) AS r00, round(sin(radians(20 + 5 * label)), 6) AS r10,
label::DOUBLE AS tx, 2.0::DOUBLE AS ty, -1.0::DOUBLE AS tz FROM embeddings GROUP BY label""")
def umeyama(spark, sf_dir):
    """The similarity of each label's points with those points scaled, turned about an axis and moved."""
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")])
    turn, size = F.radians(20 + 5 * F.col("label")), 1 + F.col("label") / 10
    x = size * (F.cos(turn) * F.col("x") - F.sin(turn) * F.col("y")) + F.col("label")
    y = size * (F.sin(turn) * F.col("x") + F.cos(turn) * F.col("y")) + 2
    moved = e.select("*", x.alias("u"), y.alias("v"), (size * F.col("z") - 1).alias("w"))
    found = fits.similarity_groups(moved, "label", ["x", "y", "z"], ["u", "v", "w"])
    parts = {"r00": F.col("rotation")[0], "r10": F.col("rotation")[3], **{f"t{a}": F.col("translation")[i] for i, a in enumerate("xyz")}}
    return found.select("label", "n", F.round("scale", 6).alias("scale"), *[F.round(c, 6).alias(n) for n, c in parts.items()])


@query("""SELECT count(*) AS n, round(arg_min(s, seq), 6) AS first_time, round(arg_max(s, seq), 6) AS last_time, min(value) AS min_value, max(value) AS max_value
FROM (SELECT event_id AS seq, {s} AS s, value FROM events)""".replace("{s}", _SECONDS))
def describe_samples(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), seconds().alias("s"), "value")
    got = measures.describe_samples(e, "seq", "s", ["value"])
    return got.select("n", F.round("first_time", 6).alias("first_time"), F.round("last_time", 6).alias("last_time"), "min_value", "max_value")


@query("SELECT bool_and(p_brand IN ('Brand#11', 'Brand#12')) AS allowed, list_sort(list(DISTINCT p_brand))::VARCHAR[] AS models FROM part")
def only_models(spark, sf_dir):
    return measures.only_models(table(spark, sf_dir, "part"), "p_brand", ("Brand#11", "Brand#12"))


@query("""SELECT coalesce(min(r) FILTER (WHERE rate >= 0.2), 5.0) AS fps FROM (SELECT length(event_type)::DOUBLE AS r, avg((value > 60)::INT) AS rate FROM events GROUP BY event_type)""")
def first_reaching(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.avg((F.col("value") > 60).cast("int")).alias("rate"))
    return measures.first_reaching(e.select(F.length("event_type").cast("double").alias("fps"), "rate"), "fps", "rate", 0.2)


@query("SELECT vec_id, printf('%06d', vec_id) || '.png' AS name, round((vec_id - 1) / 5.0::DOUBLE, 6) AS time_sec FROM embeddings")
def frame_times(spark, sf_dir):
    names = table(spark, sf_dir, "embeddings").select("vec_id", F.format_string("%06d.png", "vec_id").alias("name"))
    return names.select("vec_id", "name", F.round(g.frame_time(F.col("name"), F.lit(5.0)), 6).alias("time_sec"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS point_id FROM orders")
def dense_ids(spark, sf_dir):
    return sequences.numbered(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], "point_id", 1)


@query("""SELECT user_id, event_id, round(s - first_value(s) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS t FROM (SELECT *, {s} AS s FROM events)""".replace("{s}", _SECONDS))
def rebased_times(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", seconds().alias("t"))
    return sequences.rebased(e, ["user_id"], "t", ["ts", "event_id"]).select("user_id", "event_id", F.round("t", 6).alias("t"))


@query("""SELECT event_type AS args, count(*) AS n_extracted, count(*) FILTER (WHERE value > 20) AS n_after_blur, count(*) FILTER (WHERE value > 60) AS n_after_dedup FROM events GROUP BY event_type""")
def config_roundtrip(spark, sf_dir):
    """Configurations, one of each event type, written as JSON and read again."""
    rows = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("args")).agg(
        F.count(F.lit(1)).alias("n_extracted"), F.count_if(F.col("value") > 20).alias("n_after_blur"), F.count_if(F.col("value") > 60).alias("n_after_dedup")
    )
    return texts.config_from_json(texts.config_json(rows)).select("args", "n_extracted", "n_after_blur", "n_after_dedup")


@query("""SELECT l_orderkey::VARCHAR AS name, round(quantile_cont(l_extendedprice, 0.02), 4) AS p2, round(quantile_cont(l_extendedprice, 0.98), 4) AS p98 FROM lineitem WHERE l_extendedprice > 0 GROUP BY l_orderkey""")
def raster_percentiles(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("name"), F.col("l_extendedprice").alias("depth"))
    return report.depth_limits(items).select("name", F.round("p2", 4).alias("p2"), F.round("p98", 4).alias("p98"))


# Cameras, images and points told by the tables: an order is an image that sees the parts of its lines.

_MODELS = "CASE p_partkey % 3 WHEN 0 THEN 'SIMPLE_RADIAL' WHEN 1 THEN 'PINHOLE' ELSE 'OPENCV' END"


def _cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("double")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("camera_id"), F.expr(_MODELS).alias("model"), F.lit(320).cast("bigint").alias("width"), F.lit(240).cast("bigint").alias("height"),
        F.array(100 + size, 200 + size, 160 + size, 120 + size, *[F.lit(0.0)] * 4).alias("params"),
    )


@query(f"""SELECT p_partkey AS camera_id, fx, fy, cx, cy FROM (SELECT p_partkey, 100.0::DOUBLE + p_size AS fx, CASE WHEN m THEN 100.0::DOUBLE + p_size ELSE 200.0::DOUBLE + p_size END AS fy,
CASE WHEN m THEN 200.0::DOUBLE + p_size ELSE 160.0::DOUBLE + p_size END AS cx, CASE WHEN m THEN 160.0::DOUBLE + p_size ELSE 120.0::DOUBLE + p_size END AS cy
FROM (SELECT *, {_MODELS} = 'SIMPLE_RADIAL' AS m FROM part))""")
def camera_intrinsics(spark, sf_dir):
    """Each image with the intrinsics of its camera, whatever the camera's model."""
    cameras = _cameras(spark, sf_dir)
    seen = densify.with_camera(cameras.select("camera_id"), cameras)
    return seen.select("camera_id", "fx", "fy", F.col("ppx").alias("cx"), F.col("ppy").alias("cy"))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("parts"))
    point = lambda k: F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), k.alias("point3d_id"))
    seen = F.concat(F.transform("parts", point), F.array(point(F.lit(-1).cast("bigint")), point(F.lit(10**15).cast("bigint"))))
    key = F.col("l_orderkey")
    return items.select(
        key.alias("image_id"), F.array(*[F.lit(x) for x in (1.0, 0.0, 0.0, 0.0)]).alias("qvec"),
        F.array((-(key % 11)).cast("double"), F.lit(-2.0), F.lit(5.0)).alias("tvec"), F.lit(1).cast("bigint").alias("camera_id"), F.format_string("%09d.png", "l_orderkey").alias("name"), seen.alias("points2d"),
    )


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("point_id"), (F.col("p_partkey") % 13).cast("double").alias("x"), (F.col("p_size") / 10.0).alias("y"), (F.col("p_retailprice") / 500).alias("z"),
        *[F.lit(7).cast("smallint").alias(c) for c in "rgb"], ((F.col("p_size") - 5) / 10.0).alias("error"), F.array().cast("array<struct<image_id: bigint, point2d_idx: bigint>>").alias("track"),
    )


_SEEN = """(SELECT l_orderkey, l_orderkey % 11 AS cx, 2 AS cy, -5 AS cz, p_partkey % 13 AS x, p_size / 10.0::DOUBLE AS y, p_retailprice / 500 AS z, p_partkey FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query(f"""SELECT l_orderkey AS image_id, round(CASE WHEN count(*) >= 5 THEN median(sqrt((x-cx)*(x-cx) + (y-cy)*(y-cy) + (z-cz)*(z-cz))) END, 6) AS local_depth FROM {_SEEN} GROUP BY l_orderkey""")
def local_depths(spark, sf_dir):
    """The median distance from an image to what it sees; negative and dangling ids fall out, repeated ones stay."""
    got = diagnostics.local_depths(_images(spark, sf_dir), _points(spark, sf_dir))
    return got.select("image_id", F.round("local_depth", 6).alias("local_depth"))


@query(f"""SELECT l_orderkey AS image_id, u::INT AS u, v::INT AS v, round(z + 5, 6) AS z FROM (SELECT *, trunc(fu) AS u, trunc(fv) AS v, count(*) OVER (PARTITION BY l_orderkey) AS n FROM
(SELECT *, 100.0::DOUBLE * (x - cx) / (z + 5) + 160 AS fu, 100.0::DOUBLE * (y - cy) / (z + 5) + 120 AS fv FROM {_SEEN}) WHERE z + 5 > 0 AND fu >= 0 AND fu < 320 AND fv >= 0 AND fv < 240) WHERE n >= 4""")
def anchors(spark, sf_dir):
    """The points that images see, projected into the frame, of images with four of them or more."""
    camera = spark.createDataFrame([(1, "PINHOLE", 320, 240, [100.0, 100.0, 160.0, 120.0])], schemas.CAMERAS)
    got = densify.anchors(_images(spark, sf_dir), camera, _points(spark, sf_dir), 4)
    return got.select("image_id", "u", "v", F.round("z", 6).alias("z"))


@query("""SELECT count(*) AS n, round(avg((p_size - 5) / 10.0::DOUBLE), 6) AS mean, round(quantile_cont((p_size - 5) / 10.0::DOUBLE, 0.5), 6) AS median, round(quantile_cont((p_size - 5) / 10.0::DOUBLE, 0.95), 6) AS p95 FROM part WHERE p_size > 5""")
def error_summary(spark, sf_dir):
    got = measures.positive_summary(_points(spark, sf_dir), "error")
    return got.select("n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "p95")])


@query("SELECT printf('%09d.png', l_orderkey) AS name, count(*) + 1 AS n FROM lineitem GROUP BY l_orderkey")
def observation_counts(spark, sf_dir):
    """How many points each image observes; a dangling id counts, a negative one doesn't."""
    return report.observations(_images(spark, sf_dir)).select("name", F.col("n").cast("bigint").alias("n"))


@query("""SELECT p_partkey AS point_id, printf('%d %.6f %.6f %.6f 7 7 7 %.6f ', p_partkey, (p_partkey % 13)::DOUBLE, p_size / 10.0::DOUBLE, p_retailprice / 500, (p_size - 5) / 10.0::DOUBLE) AS line FROM part""")
def points_text(spark, sf_dir):
    return models.points_text(_points(spark, sf_dir))


@query("SELECT event_type AS name, event_type || printf(' %.8f %.8f %.3f', round(min(value), 3), round(max(value), 3), count(*)::DOUBLE) AS line FROM events GROUP BY event_type")
def reference_list(spark, sf_dir):
    """Lines of a position reference list."""
    e = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("name"))
    return texts.reference_lines(e.agg(F.round(F.min("value"), 3).alias("lat"), F.round(F.max("value"), 3).alias("lon"), F.count(F.lit(1)).cast("double").alias("alt")))


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 50 AS batch FROM orders")
def frame_batches(spark, sf_dir):
    return sequences.batches(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 50)


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 100")
def first_frames(spark, sf_dir):
    """The cap of frames: the first ones in order of time."""
    return sequences.first_rows(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 100)


@query("""SELECT count(*) AS n_images, (SELECT count(*) FROM part) AS n_points, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l AND o_orderkey % 10 <> 3)) AS n_missing,
(SELECT count(*) FROM orders WHERE o_orderkey % 10 <> 3 AND o_orderkey % 7 = 0) AS n_empty, FALSE AS valid FROM (SELECT DISTINCT l_orderkey AS l FROM lineitem)""")
def validation(spark, sf_dir):
    """Images without a file and empty files, of a table of files."""
    files = table(spark, sf_dir, "orders").filter("o_orderkey % 10 <> 3").select(F.format_string("%09d.png", "o_orderkey").alias("name"), F.when(F.col("o_orderkey") % 7 == 0, 0).otherwise(5).alias("size"))
    return diagnostics.validation(_images(spark, sf_dir), _points(spark, sf_dir), files)


@query("""SELECT count(*) AS n_files, sum(p_size)::BIGINT AS bytes FROM part WHERE p_name NOT IN (SELECT min(p_name) FROM part)""")
def freed_bytes(spark, sf_dir):
    files = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return diagnostics.freed(files, [files.agg(F.min("name")).first()[0]])


@query("SELECT min(p_brand) AS name FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) WHERE n = (SELECT max(n) FROM (SELECT count(*) AS n FROM part GROUP BY p_brand))")
def largest_model(spark, sf_dir):
    return diagnostics.largest_model(table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("name")).agg(F.count(F.lit(1)).alias("n_images")))


_DEPTHS = "(SELECT p_partkey, 0.5::DOUBLE + p_size / 100.0::DOUBLE AS i, p_partkey % 320 AS u, p_partkey % 240 AS v FROM part)"


@query(f"""SELECT p_partkey, v::INT AS v, u::INT AS u, round(1 / i, 4) AS depth FROM {_DEPTHS} WHERE 1 / i > 1.2 AND v < 240 - 24 AND p_partkey % 4 <> 0""")
def metric_rasters(spark, sf_dir):
    """Metric depths of disparities under their image's fit, without the near, the bottom strip and the sky."""
    raw = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("name"), (F.col("p_partkey") % 240).cast("int").alias("v"), (F.col("p_partkey") % 320).cast("int").alias("u"), F.col("p_size").cast("double").alias("depth"))
    fitted = raw.select("name", F.lit(0.01).alias("scale"), F.lit(0.5).alias("shift"), F.lit(40.0).alias("far"))
    made = densify.metric_rasters(raw, fitted, 1.2, 0.1, 240, raw.filter(F.col("name").cast("bigint") % 4 == 0).select("name", "v", "u"))
    return made.select(F.col("name").cast("bigint").alias("p_partkey"), "v", "u", F.round(F.col("depth").cast("double"), 4).alias("depth"))


@query(f"""SELECT round(x, 4) AS x, round(y, 4) AS y, round(z, 4) AS z FROM (SELECT ((u - 160) / 100.0::DOUBLE * d + p_partkey % 11) AS x, ((v - 120) / 100.0::DOUBLE * d + 2) AS y, d - 5 AS z FROM (SELECT *, 1 / i AS d FROM {_DEPTHS}))""")
def unproject_world(spark, sf_dir):
    """Points in the world of depth pixels, a raster for each part."""
    part = table(spark, sf_dir, "part")
    depth = part.select(F.format_string("%09d", "p_partkey").alias("name"), (F.col("p_partkey") % 240).cast("int").alias("v"), (F.col("p_partkey") % 320).cast("int").alias("u"), (1 / (0.5 + F.col("p_size") / 100.0)).alias("depth"))
    camera = spark.createDataFrame([(1, "PINHOLE", 320, 240, [100.0, 100.0, 160.0, 120.0])], schemas.CAMERAS)
    images = part.select(F.format_string("%09d.png", "p_partkey").alias("name"), F.array(*[F.lit(x) for x in (1.0, 0.0, 0.0, 0.0)]).alias("qvec"), F.array((-(F.col("p_partkey") % 11)).cast("double"), F.lit(-2.0), F.lit(5.0)).alias("tvec"), F.lit(1).cast("bigint").alias("camera_id"))
    got = densify.unprojected(depth, images, camera)
    return got.select(*[F.round(c, 4).alias(c) for c in "xyz"])


@query("""SELECT event_id, round(-sin(radians(8)) * dx + cos(radians(8)) * dy, 3) AS e, round(-sin(radians(47)) * cos(radians(8)) * dx - sin(radians(47)) * sin(radians(8)) * dy + cos(radians(47)) * dz, 3) AS n,
round(cos(radians(47)) * cos(radians(8)) * dx + cos(radians(47)) * sin(radians(8)) * dy + sin(radians(47)) * dz, 3) AS u
FROM (SELECT event_id, (nn + alt) * cos(phi) * cos(lam) - n0 * cos(radians(47)) * cos(radians(8)) AS dx, (nn + alt) * cos(phi) * sin(lam) - n0 * cos(radians(47)) * sin(radians(8)) AS dy,
(nn * (1 - 6.69437999014e-3) + alt) * sin(phi) - n0 * (1 - 6.69437999014e-3) * sin(radians(47)) AS dz
FROM (SELECT *, 6378137.0 / sqrt(1 - 6.69437999014e-3 * pow(sin(phi), 2)) AS nn, 6378137.0 / sqrt(1 - 6.69437999014e-3 * pow(sin(radians(47)), 2)) AS n0
FROM (SELECT event_id, radians(47 + value / 1e5) AS phi, radians(8 + (event_id % 100) / 1e4::DOUBLE) AS lam, value AS alt FROM events)))""")
def east_north_up(spark, sf_dir):
    """Metres east, north and up of a reference."""
    e = table(spark, sf_dir, "events")
    axes = g.east_north_up(47 + F.col("value") / 1e5, 8 + (F.col("event_id") % 100) / 1e4, F.col("value"), F.lit(47.0), F.lit(8.0), F.lit(0.0))
    return e.select("event_id", *[F.round(c, 3).alias(n) for c, n in zip(axes, "enu", strict=True)])


@query("""SELECT p_partkey, floor(greatest(0, least(1, (p_size * 7) / 255.0::DOUBLE)) * 255)::SMALLINT AS byte, (u >= 0 AND u < 20) AS inside, (trunc(u) >= 0 AND trunc(u) < 20) AS truncated, round(1 / greatest(u, 1e-6), 6) AS inverse
FROM (SELECT *, p_size / 2.0::DOUBLE - 1.5 AS u FROM part)""")
def pixel_rules(spark, sf_dir):
    """Colours as bytes, both rules for pixels at the frame's edge, and inverse depths."""
    u = F.col("p_size") / 2.0 - 1.5
    frame = (F.lit(20), F.lit(20))
    return table(spark, sf_dir, "part").select(
        "p_partkey", g.byte_colour(g.unit_colour(F.col("p_size") * 7)).alias("byte"), g.inside(u, F.lit(1.0), *frame).alias("inside"), g.inside_truncated(u, F.lit(1.0), *frame).alias("truncated"),
        F.round(g.inverse_depth(u), 6).alias("inverse"),
    )


@query("SELECT user_id, event_id FROM events")
def united_clouds(spark, sf_dir):
    """The union of clouds that were made apart."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id")
    return densify.united(e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1"))


@query("SELECT DISTINCT printf('%09d.png', l_orderkey) AS name, (l_orderkey % 11)::DOUBLE AS x, 2.0::DOUBLE AS y, -5.0::DOUBLE AS z FROM lineitem")
def trajectory(spark, sf_dir):
    """The camera centres."""
    got = report.trajectory(_images(spark, sf_dir))
    return got.select("name", *[F.round(c, 6).alias(c) for c in "xyz"])


_LOCAL = f"(SELECT l_orderkey, CASE WHEN count(*) >= 5 THEN median(sqrt((x-cx)*(x-cx) + (y-cy)*(y-cy) + (z-cz)*(z-cz))) END AS depth FROM {_SEEN} GROUP BY l_orderkey)"


@query(f"""SELECT image_a, image_b, gap_m, round(CASE WHEN m > 1e-6 THEN gap_m / m END, 6) AS ratio FROM (SELECT printf('%09d.png', l_orderkey) AS image_a, printf('%09d.png', lead(l_orderkey) OVER w) AS image_b,
abs(lead(l_orderkey % 11) OVER w - l_orderkey % 11)::DOUBLE AS gap_m, coalesce((depth + lead(depth) OVER w) / 2, depth, lead(depth) OVER w) AS m, lead(l_orderkey) OVER w AS n FROM {_LOCAL} WINDOW w AS (ORDER BY l_orderkey)) WHERE n IS NOT NULL""")
def coverage_gaps(spark, sf_dir):
    """The gaps between consecutive images against the depth that they see."""
    got = diagnostics.gaps(_images(spark, sf_dir), _points(spark, sf_dir))
    return got.select("image_a", "image_b", F.round("gap_m", 6).alias("gap_m"), F.round("ratio", 6).alias("ratio"))
