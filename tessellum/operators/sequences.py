"""Operators over ordered rows: gaps, greedy keeping, even samples, intervals."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellum.storage import materialise

Distance = Callable[[object, object], float]


def either_mean(a: Column, b: Column) -> Column:
    """Mean of two values; of one where the other is null; null where both are."""
    return F.coalesce((a + b) / 2, a, b)


def with_next(df: DataFrame, by: list[str], order: list[str], columns: list[str], prefix: str = "next_") -> DataFrame:
    """Each row with the columns of the next row of its partition; null for the last."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.select("*", *[F.lead(c).over(window).alias(prefix + c) for c in columns])


def gap_ratio(gap: Column, here: Column, there: Column) -> Column:
    """Gap against the mean local depth; null unless that is above 1e-6."""
    local = either_mean(here, there)
    return F.when(local > 1e-6, gap / local)


def top_rows(df: DataFrame, measure: str, tie: list[str], n: int = 5) -> DataFrame:
    """The n rows with the largest known measure, ties in the given order."""
    return df.filter(F.col(measure).isNotNull()).orderBy(F.col(measure).desc(), *tie).limit(n)


def absolute(a: float, b: float) -> float:
    return abs(a - b)


def mean_difference(a: np.ndarray, b: np.ndarray) -> float:
    """Mean absolute difference of two descriptors, as a share of 255."""
    return float(np.abs(a - b).mean() / 255.0)


class Keeper:
    """The state of greedy keeping: the last value that was kept and how many rows have come since."""

    def __init__(self, distance: Distance, threshold: float, max_gap: int, last=None, since: int | None = None) -> None:
        self.distance, self.threshold, self.max_gap, self.last, self.since = distance, threshold, max_gap, last, since

    def takes(self, value) -> bool:
        """Whether the next row is kept: the first one, one that is `threshold` or more from the last kept one, and the
        max_gap-th after it.  Unknown values differ from nothing."""
        known = value is not None and self.last is not None
        take = self.since is None or self.since + 1 >= self.max_gap or (known and self.distance(value, self.last) >= self.threshold)
        self.last, self.since = (value, 0) if take else (self.last, self.since + 1)
        return take


def _values(column: pa.Array) -> list:
    """Python numbers, or numpy arrays of a column of arrays; None for null."""
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        return [None if x is None else np.asarray(x, float) for x in column.to_pylist()]
    return column.to_pylist()


def _walk(batches: Iterator[pa.RecordBatch], by: list[str], value: str, kept: list[str], keeper: Callable[[], Keeper]) -> Iterator[pa.RecordBatch]:
    group, state = None, keeper()
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in by), strict=True)) or [()] * batch.num_rows
        take = []
        for key, x in zip(keys, _values(batch.column(value)), strict=True):
            if key != group:
                group, state = key, keeper()
            take.append(state.takes(x))
        yield batch.filter(pa.array(take)).select([*by, *kept])


def greedy_keep(
    df: DataFrame, by: list[str], order: list[str], value: str, distance: Distance = absolute, threshold: float = 0.0, max_gap: int = 15, keep: list[str] | None = None
) -> DataFrame:
    """Rows of each partition that differ enough from the last row *kept*, or come max_gap rows after it.

    Sequential by nature: the rows of a partition are sorted and walked once, a
    batch at a time, with only the last kept value held; partitions run in
    parallel.  distance takes two values, numbers or numpy arrays.  A threshold of
    0 or less keeps every row.
    """
    keep = keep or [c for c in df.columns if c not in by]
    if threshold <= 0:
        return df.select(*by, *keep)
    rows = df.select(*dict.fromkeys([*by, *order, value, *keep]))
    dealt = (rows.repartition(*by) if by else rows.coalesce(1)).sortWithinPartitions(*by, *order)
    walk = partial(_walk, by=by, value=value, kept=keep, keeper=partial(Keeper, distance, threshold, max_gap))
    return dealt.mapInArrow(walk, rows.select(*by, *keep).schema)


def even_sample(df: DataFrame, order: list[str], n: int = 9) -> DataFrame:
    """n evenly spaced rows by order, first and last included, with their slot; rows repeat if there are fewer.

    Positions come from a distributed count of what stands before each row, not
    from one task that numbers all rows.
    """
    ranked = numbered(df, order, "position")
    total = df.agg(F.count(F.lit(1)).alias("total"))
    slots = total.filter("total > 0").select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("slot"), "total")
    slots = slots.select("slot", F.floor(F.col("slot") * (F.col("total") - 1) / F.lit(max(n - 1, 1))).cast("bigint").alias("position"))
    return ranked.join(F.broadcast(slots), "position").drop("position")


def numbered(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Rows with their dense position by a total order, by range partitions and their counts.

    The ranges are written out, so that counts and rows are sure to mean the same ones.
    """
    part = "__part"
    sorted_ = materialise(df.repartitionByRange(*[F.col(c) for c in order]).withColumn(part, F.spark_partition_id()), "ranges")
    own = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    sized = sorted_.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    first = sized.select(part, F.coalesce(before, F.lit(0)).alias("__first"))
    return sorted_.withColumn("__own", own).join(F.broadcast(first), part).withColumn(name, (F.col("__first") + F.col("__own") - 1 + start).cast("bigint")).drop("__own", "__first", part)


def median_interval(df: DataFrame, by: list[str], time: str, default: float = 1.0) -> DataFrame:
    """(by, interval): the median step between sorted times; the default below two rows."""
    step = df.select(*by, (F.col(time) - F.lag(time).over(Window.partitionBy(*by).orderBy(time))).alias("step"))
    return step.groupBy(*by).agg(F.coalesce(F.percentile("step", F.lit(0.5)), F.lit(default)).alias("interval"))


def rebased(df: DataFrame, by: list[str], time: str, order: list[str]) -> DataFrame:
    """Times relative to the first row of each partition."""
    first = F.first(time).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(time, F.col(time) - first)


def loop_closure(df: DataFrame, by: list[str], order: str, axes: list[str]) -> DataFrame:
    """(by, diagonal, loop_ratio): bounding-box diagonal, and the distance from first to last row against it; 0 without extent."""
    at = F.struct(*axes)
    found = df.groupBy(*by).agg(
        F.sqrt(sum(((F.max(c) - F.min(c)) * (F.max(c) - F.min(c)) for c in axes), F.lit(0.0))).alias("diagonal"),
        F.min_by(at, order).alias("first"),
        F.max_by(at, order).alias("last"),
    )
    ends = F.sqrt(sum(((F.col(f"last.{c}") - F.col(f"first.{c}")) * (F.col(f"last.{c}") - F.col(f"first.{c}")) for c in axes), F.lit(0.0)))
    return found.select(*by, "diagonal", F.when(F.col("diagonal") < 1e-9, F.lit(0.0)).otherwise(ends / F.nullif(F.col("diagonal"), F.lit(0.0))).alias("loop_ratio"))


def first_rows(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """The first n rows by an order, such as the cap of frames in order of time; all of them where n is None or 0."""
    return df.orderBy(*order).limit(n) if n else df


def batches(df: DataFrame, order: list[str], size: int = 50) -> DataFrame:
    """Rows with the number, from 0, of their batch of `size` rows by an order; the last may be smaller."""
    return numbered(df, order, "batch").withColumn("batch", F.floor(F.col("batch") / size).cast("bigint"))
