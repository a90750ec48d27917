"""Stateful streaming forms: voxel sums and greedy keeping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessellum.operators import clouds, sequences


def voxel_stream(points: DataFrame, axes: list[str], sizes: list[float], carried: list[str] | None = None) -> DataFrame:
    """A stream's voxel means so far: state is a count and sums for each occupied cell (output mode complete or update)."""
    return clouds.voxel_means(clouds.voxel_sums(points, axes, sizes, carried), [*axes, *(carried or [])])


def greedy_keep_stream(rows: DataFrame, by: str, order: str, value: str, threshold: float, max_gap: int = 15, distance: sequences.Distance | None = None) -> DataFrame:
    """A stream's rows that differ by the threshold from the last kept row of their group, or come max_gap rows after it.

    value is a number or an array, such as a descriptor; the distance defaults to
    the absolute or the mean difference.  State is the last kept value and the
    rows since; rows of a micro-batch are taken in order, and batches as they come
    (output mode append).
    """
    kinds = dict(rows.dtypes)
    listed = kinds[value].startswith("array")
    distance = distance or (sequences.mean_difference if listed else sequences.absolute)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, since = state.get if state.exists else (None, None)
        keeper = sequences.Keeper(distance, threshold, max_gap, np.asarray(last, float) if listed and last is not None else last, since)
        batch = pd.concat(list(frames)).sort_values(order, kind="stable")
        values = [None if x is None else np.asarray(x, float) for x in batch[value]] if listed else [None if pd.isna(x) else float(x) for x in batch[value]]
        kept = batch[[keeper.takes(x) for x in values]]
        state.update(([float(x) for x in keeper.last] if listed and keeper.last is not None else keeper.last, keeper.since))
        yield kept[[by, order, value]]

    schema = f"`{by}` {kinds[by]}, `{order}` {kinds[order]}, `{value}` {kinds[value]}"
    held = "array<double>" if listed else "double"
    return rows.groupBy(by).applyInPandasWithState(step, schema, f"last {held}, since int", "append", GroupStateTimeout.NoTimeout)
