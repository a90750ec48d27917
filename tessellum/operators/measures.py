"""Filters and summaries: thresholds, histograms, percentiles, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def minmax_filter(df: DataFrame, by: list[str], score: str, threshold: float) -> DataFrame:
    """Rows whose score, scaled to 0..1 within its group, is at least the threshold.

    0 or less keeps everything; with equal scores a positive threshold keeps
    nothing.  The ends are aggregated and joined back: a hot group isn't
    gathered.
    """
    if threshold <= 0:
        return df
    ends = df.groupBy(*by).agg(F.min(score).alias("__low"), F.max(score).alias("__high"))
    scaled = (F.col(score) - F.col("__low")) / (F.col("__high") - F.col("__low") + 1e-12)
    return (df.join(ends, by) if by else df.crossJoin(F.broadcast(ends))).filter(scaled >= threshold).drop("__low", "__high")


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n) of values in [low, high], the last bin closed; empty bins are left out."""
    kept = df.filter((F.col(value) >= low) & (F.col(value) <= high))
    at = F.least(F.floor((F.col(value) - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    return kept.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def error_histogram(df: DataFrame, error: str, bins: int = 100, cap: float = 5.0) -> DataFrame:
    """The histogram of positive errors over 0 .. min(largest, cap)."""
    positive = df.filter(F.col(error) > 0)
    top = positive.agg(F.max(error)).first()[0]
    return histogram(positive, error, 0.0, min(top, cap) if top else cap, bins)


def track_histogram(df: DataFrame, length: str, most_bins: int = 60, cap: int = 50) -> DataFrame:
    """The histogram of positive track lengths over 1 .. min(largest + 1, cap)."""
    tracked = df.filter(F.col(length) > 0)
    top = tracked.agg(F.max(length)).first()[0] or 1
    return histogram(tracked, length, 1, max(min(top + 1, cap), 2), max(1, min(most_bins, int(top))))


def positive_summary(df: DataFrame, error: str) -> DataFrame:
    """One row: count of positive values, their mean, median and 95th percentile."""
    at = F.percentile(error, F.array(F.lit(0.5), F.lit(0.95)))
    got = df.filter(F.col(error) > 0).agg(F.count(F.lit(1)).alias("n"), F.avg(error).alias("mean"), at.alias("p"))
    return got.select("n", "mean", F.col("p")[0].alias("median"), F.col("p")[1].alias("p95"))


def track_stats(tracks: DataFrame, length: str) -> DataFrame:
    """One row over rows with a track: mean length and share of lengths below 3; null without any."""
    some = tracks.filter(F.col(length) > 0)
    return some.agg(F.avg(length).alias("mean_track_length"), F.avg((F.col(length) < 3).cast("double")).alias("frac_weak"))


def observation_stats(images: DataFrame, count: str) -> DataFrame:
    return images.agg(F.avg(count).alias("mean_obs"), F.min(count).alias("min_obs"), F.max(count).alias("max_obs"))


def flagged_share(flag: Column, valid: Column) -> tuple[Column, Column]:
    """(count, share) of flagged rows among valid ones; the share is 0 without any."""
    n = F.count_if(flag & valid)
    return n, F.coalesce(F.try_divide(n.cast("double"), F.count_if(valid)), F.lit(0.0))


def quality_stats(points: DataFrame, images: DataFrame, error: str, total_frames: int) -> DataFrame:
    """One row: registered images, points, mean positive error (0 if none), registration rate and its warnings."""
    found = points.agg(F.count(F.lit(1)).alias("n_points"), F.coalesce(F.avg(F.when(F.col(error) > 0, F.col(error))), F.lit(0.0)).alias("mean_error"))
    counted = images.agg(F.count(F.lit(1)).alias("n_registered"))
    joined = found.crossJoin(F.broadcast(counted)).withColumn("reg_rate", F.col("n_registered") / F.lit(max(total_frames, 1)))
    return joined.select("*", (F.col("reg_rate") < 0.9).alias("low_rate"), (F.col("mean_error") > 1.5).alias("high_error"), (F.col("n_points") < 1000).alias("few_points"))


def coverage_verdict(frac_t: Column, frac_r: Column, track: Column) -> Column:
    """The verdict of flagged translation and rotation shares and of the mean track length, which may be null."""
    bad = (frac_t > 0.15) | (frac_r > 0.15) | F.coalesce(track < 2.5, F.lit(False))
    fair = (frac_t > 0.05) | (frac_r > 0.05) | F.coalesce(track < 3.5, F.lit(False))
    return F.when(bad, "Insufficient").when(fair, "Marginal").otherwise("Good")


def describe_samples(samples: DataFrame, order: str, time: str, columns: list[str]) -> DataFrame:
    """One row: count, first and last time by order, least and largest of each column."""
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return samples.agg(F.count(F.lit(1)).alias("n"), F.min_by(time, order).alias("first_time"), F.max_by(time, order).alias("last_time"), *ends)


def only_models(cameras: DataFrame, model: str, allowed: tuple[str, ...] = ("PINHOLE", "SIMPLE_PINHOLE")) -> DataFrame:
    """One row: whether all models are allowed, and the distinct models in order."""
    return cameras.agg(F.coalesce(F.bool_and(F.col(model).isin(*allowed)), F.lit(True)).alias("allowed"), F.array_sort(F.collect_set(model)).alias("models"))


def first_reaching(candidates: DataFrame, value: str, rate: str, least: float = 0.99, default: float = 5.0) -> DataFrame:
    """One row: the smallest value whose rate is enough, or the default."""
    return candidates.agg(F.coalesce(F.min(F.when(F.col(rate) >= least, F.col(value))), F.lit(default)).alias(value))
