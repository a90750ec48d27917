"""Nearest distances of points, block by block, with boxes that say where nothing nearer can be.

All distances are squared and summed axis by axis, those to boxes too, so no
point of a box is nearer than the box, whatever the rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LEAF = 256


def halves(at: np.ndarray, rows: int) -> list[np.ndarray]:
    """Row numbers in parts of at most `rows` points, halved along the widest axis."""
    todo, parts = [np.arange(len(at))], []
    while todo:
        part = todo.pop()
        if len(part) <= rows:
            if len(part):
                parts.append(part)
            continue
        axis = int(np.argmax(at[part].max(axis=0) - at[part].min(axis=0)))
        order, half = np.argpartition(at[part, axis], len(part) // 2), len(part) // 2
        todo += [part[order[half:]], part[order[:half]]]
    return parts


def _gaps(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distances between boxes (a point is both ends of one), over all axes but the last."""
    apart = np.maximum(np.maximum(lows - high, low - highs), 0.0)
    total = apart[..., 0] * apart[..., 0]
    for i in range(1, apart.shape[-1]):
        total = total + apart[..., i] * apart[..., i]
    return total


def _squares(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    total = np.zeros((len(one), len(two)))
    for i in range(one.shape[1]):
        apart = one[:, i, None] - two[None, :, i]
        total += apart * apart
    return total


def lower(best: np.ndarray, at: np.ndarray, who: np.ndarray, other: np.ndarray, other_who: np.ndarray) -> None:
    """Puts into each row of `best`, least distances of a point, those to other points of another key that are less."""
    k = best.shape[1]
    leaves = halves(other, LEAF)
    lows, highs = (np.array([f(other[x], axis=0) for x in leaves]) for f in (np.min, np.max))
    for part in halves(at, LEAF):
        points, names, least = at[part], who[part], best[part]
        reach = least.max(axis=1)
        gaps = _gaps(points.min(axis=0), points.max(axis=0), lows, highs)
        for j in np.argsort(gaps, kind="stable").tolist():
            if not gaps[j] < reach.max():
                break
            rows = np.flatnonzero(_gaps(points, points, lows[j], highs[j]) < reach)
            if not len(rows):
                continue
            found = _squares(points[rows], other[leaves[j]])
            found[names[rows, None] == other_who[None, leaves[j]]] = np.inf
            least[rows] = np.partition(np.concatenate([least[rows], found], axis=1), k - 1, axis=1)[:, :k]
            reach[rows] = least[rows].max(axis=1)
        best[part] = least


class Boxes:
    """The blocks by number, with their least and greatest coordinates."""

    def __init__(self, numbers: list[int], lows: list[list[float]], highs: list[list[float]]):
        order = np.argsort(np.array(numbers, np.int64))
        self.numbers = np.array(numbers, np.int64)[order]
        self.lows, self.highs = (np.array(x, np.float64)[order] for x in (lows, highs))

    def next(self, at: np.ndarray, reach: np.ndarray, home: np.ndarray, after: np.ndarray, last: np.ndarray, fan: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(blocks to ask, distance and number of the last): of each point up to `fan` blocks nearer than its reach, by
        distance and number, from behind the last one asked; its own block, which is known, is left out."""
        asks: list[np.ndarray] = [self.numbers[:0]] * len(at)
        after, last = after.copy(), last.copy()
        for part in halves(at, LEAF):
            points, far = at[part], reach[part]
            some = np.flatnonzero(_gaps(points.min(axis=0), points.max(axis=0), self.lows, self.highs) < far.max())
            if not len(some):
                continue
            gaps = _gaps(points[:, None], points[:, None], self.lows[None, some], self.highs[None, some])
            names = self.numbers[None, some]
            asked = (gaps < after[part, None]) | ((gaps == after[part, None]) & (names <= last[part, None]))
            gaps[asked | (names == home[part, None]) | ~(gaps < far[:, None])] = np.inf
            order = np.argsort(gaps, axis=1, kind="stable")[:, :fan]
            sorted_gaps = np.take_along_axis(gaps, order, axis=1)
            counts = np.isfinite(sorted_gaps).sum(axis=1)
            for i in np.flatnonzero(counts).tolist():
                n = counts[i]
                asks[part[i]] = self.numbers[some[order[i, :n]]]
                after[part[i]], last[part[i]] = sorted_gaps[i, n - 1], asks[part[i]][-1]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in asks])]).astype(np.int32)
        flat = np.concatenate([*asks, self.numbers[:0]])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), after, last


def _matrix(table: pa.Table, axes: list[str]) -> np.ndarray:
    return np.stack([table[a].to_numpy() for a in axes], axis=1) if table.num_rows else np.zeros((0, len(axes)))


def _names(*keys: pa.ChunkedArray) -> list[np.ndarray]:
    """The keys as numbers, equal ones the same."""
    codes = pa.chunked_array([c for x in keys for c in x.chunks], keys[0].type).combine_chunks()
    codes = (pa.concat_arrays(codes.chunks) if isinstance(codes, pa.ChunkedArray) else codes).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return np.split(codes, np.cumsum([len(x) for x in keys])[:-1])


def curve_codes(batches: Iterator[pa.RecordBatch], axes: list[str], marks: list[list[float]]) -> Iterator[pa.RecordBatch]:
    """Adds `code`, the place on a Z-order curve of a grid that is as fine as the marks of each axis are dense."""
    bits = min(20, 62 // len(axes)) or 1
    for batch in batches:
        code = np.zeros(batch.num_rows, np.int64)
        cells = []
        for a, m in zip(axes[:62], marks, strict=False):
            known, first = np.unique(np.array(m, np.float64), return_index=True)
            place = np.interp(batch[a].to_numpy(zero_copy_only=False), known, first / len(m))
            cells.append((np.nan_to_num(place) * (2**bits - 1)).astype(np.int64))
        for bit in reversed(range(bits)):
            for c in cells:
                code = (code << 1) | ((c >> bit) & 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], [*batch.schema.names, "code"])


def cut(batches: Iterator[pa.RecordBatch], axes: list[str], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of one partition in blocks of at most `rows`: adds `block` and `row`, numbers of their own."""
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    have = list(batches)
    if not have:
        return
    table = pa.Table.from_batches(have).drop_columns("code")
    done = 0
    for i, part in enumerate(halves(_matrix(table, axes), rows)):
        block = table.take(pa.array(part))
        block = block.append_column("block", pa.array(np.full(len(part), first + i))).append_column("row", pa.array(first + done + np.arange(len(part))))
        done += len(part)
        yield from block.combine_chunks().to_batches()


def _settled(table: pa.Table, axes: list[str], best: np.ndarray, after: np.ndarray, last: np.ndarray, boxes: Boxes, fan: int) -> pa.Table:
    """The points with their k least distances: the mean where no other block can change them, else the blocks to ask."""
    best.sort(axis=1)
    asks, after, last = boxes.next(_matrix(table, axes), best[:, -1], table["block"].to_numpy(), after, last, fan)
    sure = np.diff(asks.offsets.to_numpy()) == 0
    listed = ~sure | table["again"].to_numpy()
    offsets = pa.array(np.concatenate([[0], np.cumsum(listed * best.shape[1])]).astype(np.int32))
    nearest = pa.ListArray.from_arrays(offsets, pa.array(best[listed].ravel()))
    kept = table.select(["key", "again", "block", "row", *axes])
    more = {"mean_distance": pa.array(np.sqrt(best).sum(axis=1) / best.shape[1]), "nearest": nearest, "asks": asks, "after": pa.array(after), "last": pa.array(last), "sure": pa.array(sure)}
    return pa.Table.from_arrays([*kept.columns, *more.values()], names=[*kept.schema.names, *more])


def at_home(table: pa.Table, axes: list[str], k: int, boxes: Boxes, fan: int) -> pa.Table:
    """Each point of a block with the k nearest of the block."""
    at, (who,) = _matrix(table, axes), _names(table["key"])
    best = np.full((len(at), k), np.inf)
    lower(best, at, who, at, who)
    return _settled(table, axes, best, np.full(len(at), -1.0), np.full(len(at), -1, np.int64), boxes, fan)


def answers(asked: pa.Table, block: pa.Table, axes: list[str], k: int) -> pa.Table:
    """(row, found): of each point that asks a block up to k distances below its reach."""
    schema = pa.schema([("row", pa.int64()), ("found", pa.list_(pa.float64()))])
    if not asked.num_rows or not block.num_rows:
        return schema.empty_table()
    who, other_who = _names(asked["key"], block["key"])
    reach = asked["reach"].to_numpy()
    best = np.repeat(reach[:, None], k, axis=1)
    lower(best, _matrix(asked, axes), who, _matrix(block, axes), other_who)
    below = best < reach[:, None]
    some = below.any(axis=1)
    offsets = np.concatenate([[0], np.cumsum(below.sum(axis=1)[some])]).astype(np.int32)
    return pa.Table.from_arrays([asked["row"].combine_chunks().filter(pa.array(some)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(best[below]))], schema=schema)


def told(batches: Iterator[pa.RecordBatch], axes: list[str], k: int, boxes: Boxes, fan: int) -> Iterator[pa.RecordBatch]:
    """The points that had asked, with what the blocks `found`."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        own, found = (table[c].combine_chunks() for c in ("nearest", "found"))
        sizes = [x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for x in (own, found)]
        rows = np.concatenate([np.repeat(np.arange(len(s)), s) for s in sizes])
        values = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in (own, found)])
        order = np.lexsort((values, rows))
        rows, values = rows[order], values[order]
        best = values[np.arange(len(rows)) - np.searchsorted(rows, rows) < k].reshape(-1, k)
        yield from _settled(table, axes, best, table["after"].to_numpy(), table["last"].to_numpy(), boxes, fan).combine_chunks().to_batches()
