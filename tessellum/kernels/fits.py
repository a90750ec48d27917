"""Numeric fits of one group's rows: scale and shift, similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def _pairs(n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of n rows, or `most` seeded draws of two different ones."""
    if n * (n - 1) // 2 <= most:
        return np.triu_indices(n, 1)
    draw = np.random.default_rng(n)
    first = draw.integers(0, n, most)
    return first, (first + draw.integers(1, n, most)) % n


def scale_shift(metric: np.ndarray, raw: np.ndarray, tolerance: float, least: int, most: int = 2000, refits: int = 8) -> tuple[float | None, float | None, int]:
    """(scale, shift, inliers) of metric = scale * raw + shift with scale > 0, by consensus.

    The lines through `most` pairs of rows, or all pairs if there are no more, are
    scored together by how many rows lie within the tolerance.  The `refits` best
    are fitted by least squares to their rows, again as long as that brings more,
    and the one with the most rows, of equal ones the first, is the result.  Rows
    and their order decide it alone.  Without `least` inliers, or without a line
    that rises, scale and shift are None.
    """
    n = len(metric)
    if n < 2:
        return None, None, 0
    i, j = _pairs(n, most)
    apart = np.abs(raw[j] - raw[i]) >= 1e-9
    i, j = i[apart], j[apart]
    slopes = (metric[j] - metric[i]) / (raw[j] - raw[i])
    lines = np.stack([slopes, metric[i] - slopes * raw[i]], axis=1)[slopes > 0]
    step = max(1, 2_000_000 // n)
    support = [(np.abs(metric - part[:, :1] * raw - part[:, 1:]) < tolerance).sum(axis=1) for part in np.split(lines, range(step, len(lines), step))]
    order = np.argsort(-np.concatenate(support), kind="stable")[:refits]
    best, found = 0, (0.0, 0.0)
    for line in lines[order]:
        near = np.abs(metric - line[0] * raw - line[1]) < tolerance
        count = 0
        while near.sum() > count:
            count = int(near.sum())
            x, y = raw[near] - raw[near].mean(), metric[near]
            spread = float((x * x).sum())
            slope = float((x * y).sum() / spread) if spread > 0 else 0.0
            if slope <= 0:
                break
            shift = float(y.mean() - slope * raw[near].mean())
            near = np.abs(metric - slope * raw - shift) < tolerance
            if near.sum() > best:
                best, found = int(near.sum()), (slope, shift)
    return (*found, best) if best >= max(least, 1) else (None, None, best)


def fit_groups(df: DataFrame, by: str, order: str, metric: str, raw: str, tolerance: float, least: int) -> DataFrame:
    """(by, scale, shift, n_inliers) of every group; rows are taken in `order`, since the draws depend on it."""
    kind = dict(df.dtypes)[by]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(order, kind="stable")
        found = scale_shift(rows[metric].to_numpy(float), rows[raw].to_numpy(float), tolerance, least)
        return pd.DataFrame({by: [pdf[by].iloc[0]], "scale": [found[0]], "shift": [found[1]], "n_inliers": [found[2]]})

    chosen = df.select(by, order, metric, raw).dropna(subset=[metric, raw])
    return chosen.groupBy(by).applyInPandas(one, f"`{by}` {kind}, scale double, shift double, n_inliers long")


def similarity(source: np.ndarray, target: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(scale, rotation, translation) with target = scale * rotation * source + translation in least squares (Umeyama, 1991)."""
    a, b = source.mean(axis=0), target.mean(axis=0)
    x, y = source - a, target - b
    u, d, vt = np.linalg.svd(y.T @ x / len(x))
    sign = np.ones(3)
    if np.linalg.det(u) * np.linalg.det(vt) < 0:
        sign[-1] = -1
    rotation = u @ np.diag(sign) @ vt
    spread = (x**2).sum() / len(x)
    scale = float((d * sign).sum() / spread) if spread > 0 else 1.0
    return scale, rotation, b - scale * rotation @ a


def similarity_groups(df: DataFrame, by: str, source: list[str], target: list[str]) -> DataFrame:
    """(by, n, scale, rotation, translation) of each group's points: rotation row by row."""
    kind = dict(df.dtypes)[by]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        scale, turn, move = similarity(pdf[source].to_numpy(float), pdf[target].to_numpy(float))
        return pd.DataFrame({by: [pdf[by].iloc[0]], "n": [len(pdf)], "scale": [scale], "rotation": [turn.ravel().tolist()], "translation": [move.tolist()]})

    return df.select(by, *source, *target).dropna().groupBy(by).applyInPandas(one, f"`{by}` {kind}, n long, scale double, rotation array<double>, translation array<double>")


def robust_similarity(source: np.ndarray, target: np.ndarray, max_error: float = 10.0, least: int = 10, tries: int = 500) -> tuple[float, np.ndarray, np.ndarray, int] | None:
    """The similarity with the most points within max_error, from seeded triples and refitted on them; None below `least`."""
    n = len(source)
    if n < max(least, 3):
        return None
    draw = np.random.default_rng(0)
    best: np.ndarray | None = None
    for _ in range(tries):
        pick = draw.choice(n, 3, replace=False)
        s, r, t = similarity(source[pick], target[pick])
        good = np.linalg.norm(s * source @ r.T + t - target, axis=1) <= max_error
        if best is None or good.sum() > best.sum():
            best = good
    if best is None or best.sum() < least:
        return None
    s, r, t = similarity(source[best], target[best])
    return s, r, t, int(best.sum())
