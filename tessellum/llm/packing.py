"""Best-fit packing of tokenised documents into sequences by linear grouping.

Only the histogram of piece lengths decides the plan, and it has at most
`capacity` entries however many documents there are.  Large lengths are rounded
up within groups of equal cardinality and configurations of the few rounded sizes
are optimised by column generation.  Each configuration is used as often as the
optimum says, in whole numbers, with real pieces in its places: the longest of
each place's group, and in the last place the longest that the sequence still
has room for, so that what rounding up lost is taken back.  What the groups lack
then is grouped and configured again, in a few rounds.  The small pieces, and the
few large ones that no configuration took, go best-fit into the room that is left
and into further sequences.  Sequences that look the same are one run with a count.

Every piece then finds its place from its rank among the pieces of its length:
the plan says which ranks go to which run of sequences and at which offset.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessellum.llm import arrowtext as at
from tessellum.llm import tokencount, wordbpe
from tessellum.llm.storage import materialise


@dataclass(frozen=True)
class Packing:
    """Parameters.

    capacity: tokens of a sequence.
    separator: the id after each document's tokens.
    groups: most groups of large lengths.
    least: fewest pieces of a group; fewer pieces make fewer groups.
    slack: the room that a sequence may have beyond that of its configuration.
    rounds: how often what is left of the large pieces is grouped again.
    large: a length is large if it is above capacity / large.
    cell: about how many pieces of one length are ranked in one task.
    """

    capacity: int = 2048
    separator: int = 0
    groups: int = 32
    least: int = 4
    slack: int = 2
    rounds: int = 12
    large: int = 8
    cell: int = 4096
    tokenizer: str = wordbpe.DEFAULT


@dataclass
class Run:
    """`count` sequences alike: slots are (length, how many side by side)."""

    count: int
    room: int
    slots: list[tuple[int, int]] = field(default_factory=list)
    configured: bool = False


def _knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best multiset of sizes, as often as wanted, within capacity: (value, multiplicities).

    Layer k holds, for each room, the best value of k sizes at most and which
    size came last.
    """
    best, layers = np.zeros(capacity + 1), []
    useful = np.flatnonzero(values > 0).tolist()
    for _ in range(capacity // int(sizes.min())):
        better, last = best.copy(), np.full(capacity + 1, -1)
        for i in useful:
            size = int(sizes[i])
            worth = best[: capacity + 1 - size] + values[i]
            where = np.flatnonzero(worth > better[size:] + 1e-12)
            better[where + size], last[where + size] = worth[where], i
        if (last < 0).all():
            break
        layers.append(last)
        best = better
    chosen, room = np.zeros(len(sizes), np.int64), capacity
    for last in reversed(layers):
        if last[room] >= 0:
            chosen[last[room]] += 1
            room -= int(sizes[last[room]])
    return float(best[capacity]), chosen


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, max_steps: int = 400, gain: float = 1e-3) -> list[tuple[np.ndarray, float]]:
    """Patterns (multiplicity of each size) and how often each is used, from the
    linear programme of cutting-stock by column generation.

    It ends when no pattern would be worth more than 1 + gain, that is, within
    that share of the optimum.
    """
    k = len(sizes)
    patterns = [np.eye(k, dtype=np.int64)[i] * (capacity // int(sizes[i])) for i in range(k)]
    basis = np.stack(patterns, axis=1).astype(float)
    use = demand / np.diag(basis)
    for _ in range(max_steps):
        duals = np.linalg.solve(basis.T, np.ones(k))
        value, column = _knapsack(np.maximum(duals, 0), sizes, capacity)
        if value <= 1 + gain:
            break
        direction = np.linalg.solve(basis, column.astype(float))
        positive = direction > 1e-9
        if not positive.any():
            break
        ratio = np.where(positive, use / np.where(positive, direction, 1), np.inf)
        out = int(ratio.argmin())
        use = use - ratio[out] * direction
        use[out] = ratio[out]
        basis[:, out], patterns[out] = column, column
        use = np.maximum(use, 0)
    return list(zip(patterns, use.tolist(), strict=True))


def _best_fit(runs: list[Run], counts: dict[int, int], capacity: int) -> list[Run]:
    """Puts the pieces of counts, longest first, where the least room remains; opens runs as needed."""
    rooms: dict[int, list[Run]] = {}
    keys: list[int] = []

    def add(run: Run) -> None:
        if run.room not in rooms:
            rooms[run.room] = []
            insort(keys, run.room)
        rooms[run.room].append(run)

    for run in runs:
        add(run)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(keys, length)
            if i == len(keys):
                per = capacity // length
                full, rest = divmod(left, per)
                if full:
                    add(Run(full, capacity - per * length, [(length, per)]))
                if rest:
                    add(Run(1, capacity - rest * length, [(length, rest)]))
                break
            run = rooms[keys[i]].pop()
            if not rooms[keys[i]]:
                del rooms[keys[i]], keys[i]
            per = run.room // length
            full, rest = divmod(left, per)
            full = min(full, run.count)
            spare = run.count - full
            if full:
                add(Run(full, run.room - per * length, [*run.slots, (length, per)], run.configured))
                left -= full * per
            if spare and left:  # the last ones fill a part of one sequence
                rest = min(left, per)
                add(Run(1, run.room - rest * length, [*run.slots, (length, rest)], run.configured))
                left -= rest
                spare -= 1
            if spare:
                add(Run(spare, run.room, run.slots, run.configured))
    return [run for key in keys for run in rooms[key]]


def grouped(counts: dict[int, int], groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(rounded sizes, longest first, and how many pieces have each) of groups of equal cardinality.

    Groups with the same rounded size are one.
    """
    lengths = np.array(sorted(counts, reverse=True), np.int64)
    ends = np.cumsum([counts[n] for n in lengths.tolist()])
    total = int(ends[-1])
    first = [total * g // groups for g in range(groups)]
    sizes, begins = np.unique(-lengths[np.searchsorted(ends, first, "right")], return_index=True)
    edges = np.append(np.array(first, np.int64)[begins], total)
    return -sizes, np.diff(edges)


def substituted(pattern: np.ndarray, times: int, sizes: np.ndarray, left: dict[int, int], keys: list[int], p: Packing) -> list[Run]:
    """At most `times` sequences of a pattern with real pieces, taken from left (length -> count; keys are its lengths, sorted).

    It ends early if a group has no piece of its own left for a place, or if a
    sequence would have more room than its configuration and `slack`.
    """
    places = [g for g, m in enumerate(pattern.tolist()) for _ in range(m)]
    most = p.capacity - int(sizes[places].sum()) + p.slack
    runs: list[Run] = []
    while times:
        room, used = p.capacity, {}
        for k, g in enumerate(places):
            longest = room if k == len(places) - 1 else min(room, int(sizes[g]))
            shortest = int(sizes[g + 1]) if g + 1 < len(sizes) else 0
            i = bisect_right(keys, longest) - 1
            while i >= 0 and left[keys[i]] <= used.get(keys[i], 0):
                i -= 1
            if i < 0 or keys[i] < shortest:
                return runs
            used[keys[i]] = used.get(keys[i], 0) + 1
            room -= keys[i]
        if room > most:
            return runs
        step = min(times, *(left[n] // side for n, side in used.items()))
        for n, side in used.items():
            left[n] -= step * side
            if not left[n]:
                del left[n], keys[bisect_left(keys, n)]
        runs.append(Run(step, room, sorted(used.items(), reverse=True), True))
        times -= step
    return runs


def plan(counts: dict[int, int], p: Packing) -> list[Run]:
    """Runs of sequences that hold counts[length] pieces of each length."""
    runs = [Run(counts[p.capacity], 0, [(p.capacity, 1)])] if counts.get(p.capacity) else []
    rest = {n: c for n, c in counts.items() if 0 < n < p.capacity and c}
    left = {n: c for n, c in rest.items() if n > p.capacity // p.large}
    small = {n: c for n, c in rest.items() if n not in left}
    for _ in range(p.rounds):
        if not left:
            break
        sizes, demand = grouped(left, max(1, min(p.groups, sum(left.values()) // p.least)))
        keys, made = sorted(left), len(runs)
        for pattern, times in sorted(configurations(sizes, demand.astype(float), p.capacity), key=lambda x: (-x[1], x[0].tolist())):
            runs += substituted(pattern, int(times + 1e-6), sizes, left, keys, p)
        if len(runs) == made:
            break
    return _best_fit(runs, left | small, p.capacity)


def placements(runs: list[Run]) -> np.ndarray:
    """Rows (length, first rank, ranks, side by side, first sequence, offset), sorted by length and rank."""
    rows, rank, sequence = [], {}, 0
    for run in runs:
        at_ = 0
        for length, side in run.slots:
            first = rank.get(length, 0)
            rows.append((length, first, run.count * side, side, sequence, at_))
            rank[length] = first + run.count * side
            at_ += length * side
        sequence += run.count
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Encoder:
    """Token ids of texts, with a worker's memory of chunks."""

    def __init__(self, name: str) -> None:
        self.model, self.special, self.known = tokencount.merges(name), wordbpe.specials(name), {}

    def block(self, block: at.TextBlock) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts of a block."""
        starts, ends, offsets = wordbpe.chunks(block, self.special)
        codes, hashes, sample = wordbpe.distinct(block, starts, ends)
        if len(self.known) > wordbpe.CACHE or not self.known:
            self.known = {h: np.array([x], "<u4").tobytes() for h, x in wordbpe.hashed(self.special).items()}
        fresh = [i for i, h in enumerate(hashes) if h not in self.known]
        pick = sample[fresh]
        count, ids = self.model.tokens(block, starts[pick], ends[pick])
        raw, cut = ids.astype("<u4").tobytes(), (np.cumsum(count) * 4).tolist()
        self.known.update((hashes[i], raw[a:b]) for i, a, b in zip(fresh, [0, *cut], cut, strict=False))
        held = [self.known[h] for h in hashes]
        size = np.array([len(x) // 4 for x in held], np.int64)
        flat = np.frombuffer(b"".join(held), "<u4")
        each = size[codes] if len(codes) else size
        made = flat[at.ragged((np.cumsum(size) - size)[codes], each)] if len(codes) else flat
        return made, np.concatenate(([0], np.cumsum(each)))[offsets]


def _cut(batches: Iterator[pa.RecordBatch], p: Packing, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = _Encoder(p.tokenizer)
    end = np.array([p.separator], "<u4")
    for batch in at.released(batches):
        for block in at.blocks(batch.column("text")):
            ids, offsets = encoder.block(block)
            row, piece, start, length, crc, held = [], [], [], [], [], []
            for i in range(len(block)):
                own = np.concatenate((ids[offsets[i] : offsets[i + 1]], end))
                for k, a in enumerate(range(0, len(own), p.capacity)):
                    part = own[a : a + p.capacity].tobytes()
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        held.append(part)
            columns = [
                batch.column("doc_id").slice(block.first, len(block)).take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
            ]
            names = [x.split()[0] for x in PIECES.split(", ")]
            if with_ids:
                columns.append(pa.array(held, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def pieces(docs: DataFrame, p: Packing, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: ids of the whole text, the separator, cut at the capacity."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(partial(_cut, p=p, with_ids=with_ids), PIECES + ", ids binary" * with_ids)


def _place(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys = (table[:, 0] << 48) | table[:, 1]
    for batch in batches:
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        row = np.searchsorted(keys, (length << 48) | rank, "right") - 1
        step, beside = np.divmod(rank - table[row, 1], table[row, 3])
        out = batch.drop_columns(["rank"])
        yield out.append_column("sequence_id", pa.array(table[row, 4] + step)).append_column("offset", pa.array(table[row, 5] + beside * length))


def placed(cut: DataFrame, p: Packing) -> DataFrame:
    """The pieces of a written table with sequence_id and offset."""
    histogram = materialise(cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")), "histogram")  # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in histogram.collect()}
    table = placements(plan(counts, p))
    # ranks of a length: its pieces are dealt to cells by a hash, and each cell begins where the last ended
    cells = F.floor(F.col("n") / p.cell) + 1
    dealt = cut.join(F.broadcast(histogram), "length").withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), cells)).drop("n")
    each = dealt.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    first = each.select("length", "cell", F.coalesce(before, F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("own", own).join(first, ["length", "cell"]).withColumn("rank", F.col("first") + F.col("own"))
    kept = cut.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id bigint, offset bigint"
    return ranked.select(*kept, F.col("rank").cast("bigint")).mapInArrow(partial(_place, table=table), schema)


def pack(docs: DataFrame, p: Packing = Packing(), with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]), one row per piece of each row of docs.

    A null or empty text is one piece of one token, the separator.  Repeated
    rows, and rows with a null doc_id, are packed each.  Other columns are
    ignored; an empty table gives an empty one.  Offsets of a sequence are
    gapless from 0.
    """
    return placed(materialise(pieces(docs, p, with_ids), "pieces"), p)


def sequences(docs: DataFrame, p: Packing = Packing()) -> DataFrame:
    """(sequence_id, n_tokens, pieces array<struct<offset, doc_id, start, length>>, ids binary): the packed sequences,
    ids as little-endian unsigned 32-bit integers.  A sequence has `capacity` tokens at most, so its rows are few."""
    item = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    held = pack(docs, p, with_ids=True).groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), item.alias("held"))
    bare = F.transform("held", lambda x: F.struct(x["offset"].alias("offset"), x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["length"].alias("length")))
    joined = F.aggregate("held", F.lit(b""), lambda all_, x: F.concat(all_, x["ids"]))
    return held.select("sequence_id", "n_tokens", bare.alias("pieces"), joined.alias("ids"))
