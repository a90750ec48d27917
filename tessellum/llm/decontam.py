"""Benchmark decontamination with a distributed positional inverted index.

The index is sharded by documents: each row of the index table holds, for a few
megabytes of consecutive training texts, the sorted places of every test term.
A window of a benchmark item is looked up from its rarest term on: the list of
that term, shifted by the term's place in the window, is intersected with the
shifted lists of the next rarest ones.  Frequencies are those of the whole
corpus.  Nothing is shuffled but the term counts, so a source or a passage that
many documents share makes no task larger than its texts.

Test terms and windows travel to the shards.  They are bounded by `block_windows`:
a larger benchmark is taken in blocks, each against all documents.  What is dealt
to blocks are the distinct pairs of a window and an item, by a hash of both, so
neither a long item nor a window that many items share makes a block larger.  Of
the pairs of a window one owns it, and only its block counts it for proximity:
no result depends on the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.llm import arrowtext as at
from tessellum.llm.storage import materialise

U64 = np.uint64


@dataclass(frozen=True)
class Decontamination:
    """Parameters.

    window: words of a window; an item of fewer words is one window.
    percent: a document is contaminated if at least so many hundredths of its
        words are hit.
    slop: for proximity matches, how far each term may be from its place.
    block_windows: about how many pairs of a window and an item are sent to the
        shards at once.
    expand: about how many places are looked up at once in a row of the index.
    copies: most equal rows that a task writes in a row.
    """

    window: int = 13
    percent: int = 5
    slop: int = 2
    block_windows: int = 500_000
    expand: int = 2_000_000
    copies: int = 4096


@dataclass
class TestWindows:
    """Distinct windows of some benchmark items, with terms numbered by `vocabulary`."""

    vocabulary: np.ndarray  # sorted term hashes
    terms: np.ndarray  # windows x width, int32, -1 beyond a short window
    lengths: np.ndarray
    own: np.ndarray  # whether this block counts the window for proximity
    items: np.ndarray  # item numbers, window after window
    item_offsets: np.ndarray
    names: list[str]


_SLICE = 50_000  # windows of a batch


def _item_windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(item_id, held): the word hashes of each window of each item; an item of fewer words than a window is one."""
    for batch in batches:
        for block in at.blocks(batch.column("text")):
            w = at.words(block, at.ALPHANUMERIC)
            for i in np.flatnonzero(w.counts()).tolist():
                stream = w.hashes[w.offsets[i] : w.offsets[i + 1]]
                made = np.lib.stride_tricks.sliding_window_view(stream, min(width, len(stream)))
                for k in range(0, len(made), _SLICE):
                    rows = [x.tobytes() for x in made[k : k + _SLICE]]
                    ids = batch.column("item_id").slice(block.first + i, 1).take(pa.array(np.zeros(len(rows), np.int64)))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(rows, pa.binary())], names=["item_id", "held"])


def test_windows(table: pa.Table, width: int) -> TestWindows:
    """The windows of a table (item_id, held, own)."""
    held = table["held"].to_pylist()
    lengths = np.array([len(x) // 8 for x in held], np.int64)
    vocabulary, numbered = np.unique(np.frombuffer(b"".join(held), U64), return_inverse=True)
    terms = np.full((len(held), width), -1, np.int32)
    terms[np.arange(width) < lengths[:, None]] = numbered
    names, owners = np.unique(np.array(table["item_id"].to_pylist(), object).astype(str), return_inverse=True)
    terms, which = np.unique(terms, axis=0, return_inverse=True)
    own = np.zeros(len(terms), bool)
    own[which.ravel()[np.array(table["own"].to_pylist(), bool)]] = True
    pairs = np.unique(np.stack([which.ravel(), owners.ravel()], axis=1), axis=0)
    offsets = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
    return TestWindows(vocabulary, terms, (terms >= 0).sum(axis=1), own, pairs[:, 1].astype(np.int32), offsets, names.tolist())


INDEX = "ids binary, id_nulls binary, texts binary, n_words binary, terms binary, counts binary, places binary"


def _packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpacked(x: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _index(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of the index: the ids, text hashes and word counts of a block, and its postings."""
    present = np.zeros(1 << 20, bool)
    present[vocabulary >> U64(44)] = True
    for batch in at.released(batches):
        for block in at.blocks(batch.column("text")):
            w = at.words(block, at.ALPHANUMERIC)
            place = np.flatnonzero(present[w.hashes >> U64(44)])
            found = w.hashes[place]
            term = np.searchsorted(vocabulary, found)
            good = np.flatnonzero(vocabulary[np.minimum(term, len(vocabulary) - 1)] == found) if len(vocabulary) else np.zeros(0, np.int64)
            keys = np.sort((term[good].astype(np.int64) << 32) | place[good])
            term, place = keys >> 32, (keys & 0xFFFFFFFF).astype(np.int32)
            terms, first, counts = np.unique(term, return_index=True, return_counts=True)
            steps = np.diff(place, prepend=np.int32(0))  # within a term the steps are small and compress well
            steps[first] = place[first]
            ids = batch.column("doc_id").slice(block.first, len(block))
            texts = at.span_hashes(block.data, block.offsets[:-1], block.offsets[1:])
            row = [
                ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool),
                texts,
                w.counts().astype(np.int64),
                terms.astype(np.int32),
                counts.astype(np.int32),
                steps.astype(np.int32),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([_packed(x)], pa.binary()) for x in row], names=[x.split()[0] for x in INDEX.split(", ")])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each partition, the number of places of each test term."""
    total: np.ndarray = np.zeros(0, np.int64)
    for batch in batches:
        for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            t, c = _unpacked(terms, np.int32), _unpacked(counts, np.int32)
            if len(t) and t[-1] >= len(total):
                total = np.concatenate((total, np.zeros(int(t[-1]) + 1 - len(total), np.int64)))
            total[t] += c
    full = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full])], names=["term", "n"])


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint spans that cover the same places, in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.flatnonzero(np.concatenate(([True], starts[1:] > ends[:-1])))
    return starts[fresh], ends[np.concatenate((fresh[1:] - 1, [len(ends) - 1]))]


FOUND = "doc_id bigint, text_hash bigint, n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>, n_near bigint"


@dataclass
class _Shard:
    """A row of the index: keys are (term, place), sorted; edge has the place where each document begins."""

    terms: np.ndarray
    counts: np.ndarray
    first: np.ndarray
    places: np.ndarray
    keys: np.ndarray
    edge: np.ndarray

    def nearest(self, key: np.ndarray) -> np.ndarray:
        """The least key that is not below each of the given ones, or the last."""
        return self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)]


def _looked_up(shard: _Shard, some: np.ndarray, many: np.ndarray, tests: TestWindows, order: np.ndarray, slop: int) -> tuple[np.ndarray, ...]:
    """(documents and windows matched by proximity; windows, starts and documents of exact matches) of some windows.

    many: the number of places of the rarest term of each of them.
    """
    edge, rank = shard.edge, order.shape[1]
    window = np.repeat(some, many)
    slot = np.searchsorted(shard.terms, tests.terms[some, order[some, 0]])
    found = shard.places[at.ragged(shard.first[slot], many)]
    doc = np.searchsorted(edge, found, "right") - 1
    start = found - order[window, 0]
    for r in range(1, rank):
        if not len(window):
            break
        shift = order[window, r]
        term, place = tests.terms[window, shift].astype(np.int64), start + shift
        low = (term << 32) | np.maximum(place - slop, edge[doc])
        high = (term << 32) | np.minimum(place + slop, edge[doc + 1] - 1)
        near = shard.nearest(low)
        good = (term < 0) | ((near >= low) & (near <= high))
        window, start, doc = window[good], start[good], doc[good]
    owned = tests.own[window]
    near_pairs = np.unique(np.stack([doc[owned], window[owned]], axis=1), axis=0)
    exact = (start >= edge[doc]) & (start + tests.lengths[window] <= edge[doc + 1])
    window, start, doc = window[exact], start[exact], doc[exact]
    for r in range(rank):
        if not len(window):
            break
        shift = order[window, r]
        term = tests.terms[window, shift].astype(np.int64)
        key = (term << 32) | (start + shift)
        good = (term < 0) | (shard.nearest(key) == key)
        window, start, doc = window[good], start[good], doc[good]
    return near_pairs[:, 0], window, start, doc


def _search(batches: Iterator[pa.RecordBatch], tests: TestWindows, order: np.ndarray, p: Decontamination) -> Iterator[pa.RecordBatch]:
    """Of each document, the merged spans of exact matches, the items matched and the number of windows matched by proximity.

    Windows are looked up some at a time, so that no more than about `expand`
    places, or those of one term, are held.
    """
    rarest = np.take_along_axis(tests.terms, order[:, :1].astype(np.int64), axis=1)[:, 0]
    for batch in at.released(batches):
        for row in batch.to_pylist():
            ids, nulls, texts, n_words = (_unpacked(row[k], t) for k, t in (("ids", np.int64), ("id_nulls", bool), ("texts", np.int64), ("n_words", np.int64)))
            terms, counts, steps = (_unpacked(row[k], np.int32) for k in ("terms", "counts", "places"))
            first = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
            sums = np.cumsum(steps, dtype=np.int64)
            base = sums[first[:-1]] - steps[first[:-1]] if len(terms) else sums
            places = sums - np.repeat(base, counts)
            keys = (np.repeat(terms.astype(np.int64), counts) << 32) | places
            edge = np.concatenate(([0], np.cumsum(n_words)))
            shard = _Shard(terms, counts, first, places, keys, edge)

            n_near = np.zeros(len(ids), np.int64)
            hits = [np.zeros((3, 0), np.int64)]
            if len(terms) and len(rarest):
                slot = np.minimum(np.searchsorted(terms, rarest), len(terms) - 1)
                many = np.where(terms[slot] == rarest, counts[slot], 0).astype(np.int64)
                some = np.flatnonzero(many)
                cuts = np.flatnonzero(np.diff(np.cumsum(many[some]) // p.expand)) + 1
                for part in np.split(some, cuts):
                    near, *found = _looked_up(shard, part, many[part], tests, order, p.slop)
                    n_near += np.bincount(near, minlength=len(ids))
                    hits.append(np.stack(found))
            window, start, doc = np.concatenate(hits, axis=1)

            starts: list[list[int]] = [[] for _ in ids]
            ends: list[list[int]] = [[] for _ in ids]
            items: list[list[str]] = [[] for _ in ids]
            by_doc = np.argsort(doc, kind="stable")
            window, start, doc = window[by_doc], start[by_doc], doc[by_doc]
            cuts = np.searchsorted(doc, np.arange(len(ids) + 1))
            for i in np.unique(doc):
                own = slice(cuts[i], cuts[i + 1])
                s, e = _merged(start[own] - edge[i], start[own] + tests.lengths[window[own]] - edge[i])
                starts[i], ends[i] = s.tolist(), e.tolist()
                which = np.unique(window[own])
                hit = np.unique(tests.items[at.ragged(tests.item_offsets[which], tests.item_offsets[which + 1] - tests.item_offsets[which])])
                items[i] = [tests.names[k] for k in hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=nulls), pa.array(texts), pa.array(n_words), *(pa.array(x, pa.list_(pa.int64())) for x in (starts, ends)), pa.array(items, pa.list_(pa.string())), pa.array(n_near)],
                names=[x.split()[0] for x in FOUND.split(", ")],
            )


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the spans that the blocks of a benchmark gave."""
    for batch in batches:
        spans = [_merged(np.array(s, np.int64), np.array(e, np.int64)) for s, e in zip(batch.column("starts").to_pylist(), batch.column("ends").to_pylist(), strict=True)]
        for k, name in enumerate(("starts", "ends")):
            batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array([x[k].tolist() for x in spans], pa.list_(pa.int64())))
        yield batch


def _one_block(docs: DataFrame, rows: pa.Table, p: Decontamination) -> DataFrame:
    tests = test_windows(rows, p.window)
    index = materialise(docs.mapInArrow(partial(_index, vocabulary=tests.vocabulary), INDEX), "positions")
    counted = index.select("terms", "counts").mapInArrow(_frequencies, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(len(tests.vocabulary) + 1, np.int64)
    for term, n in counted:
        frequency[term] = n
    frequency[-1] = np.iinfo(np.int64).max  # the end of a short window stands last
    order = np.argsort(frequency[tests.terms], axis=1, kind="stable").astype(np.int16)
    return index.mapInArrow(partial(_search, tests=tests, order=order, p=p), FOUND)


def _window_pairs(benchmark: DataFrame, p: Decontamination) -> DataFrame:
    """(item_id, held, own): the distinct pairs of an item and a window; one of each window's pairs, that of its least item, owns it."""
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).filter("item_id IS NOT NULL")
    pairs = materialise(items.mapInArrow(partial(_item_windows, width=p.window), "item_id string, held binary").distinct(), "windows")
    owners = pairs.groupBy("held").agg(F.min("item_id").alias("item_id")).select("item_id", "held", F.lit(True).alias("own"))
    both = pairs.withColumn("own", F.lit(False)).unionByName(owners)
    return materialise(both.groupBy("item_id", "held").agg(F.max("own").alias("own")), "windows")


def _joined(blocks: list[DataFrame], p: Decontamination) -> DataFrame:
    """The matches of all blocks, row by row.  Rows that are alike have the same matches, so each block first makes them one."""
    key = ["doc_id", "text_hash", "n_words"]
    lists = ["starts", "ends", "items", "n_near"]
    every = None
    for x in blocks:
        one = x.groupBy(*key).agg(*[F.first(c).alias(c) for c in lists], F.count(F.lit(1)).alias("copies"))
        every = one if every is None else every.unionByName(one)
    grouped = every.groupBy(*key).agg(
        F.flatten(F.collect_list("starts")).alias("starts"),
        F.flatten(F.collect_list("ends")).alias("ends"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.sum("n_near").alias("n_near"),
        F.max("copies").alias("copies"),
    )
    names = [x.split()[0] for x in FOUND.split(", ")]
    united = grouped.mapInArrow(_united, FOUND + ", copies bigint")
    parts = united.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / p.copies))))
    dealt = parts.repartition(F.xxhash64("doc_id", "text_hash", "part"))
    return dealt.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(p.copies), F.col("copies") - F.col("part") * p.copies)))).select(*names)


def matches(docs: DataFrame, benchmark: DataFrame, p: Decontamination = Decontamination()) -> DataFrame:
    """(doc_id, text_hash, n_words, starts, ends, items, n_near) for each row of docs.

    starts and ends are the merged word spans, end exclusive, of all exact
    occurrences of benchmark windows; items the ids, as strings, of the items
    they belong to; n_near the number of distinct windows that occur by
    proximity: every term within `slop` words of its place beside the rarest.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    pairs = _window_pairs(benchmark, p)
    n = max(1, -(-pairs.count() // p.block_windows))
    blocks = [_one_block(docs, pairs.filter(F.pmod(F.xxhash64("item_id", "held"), F.lit(n)) == k).toArrow(), p) for k in range(n)]
    return blocks[0] if n == 1 else _joined(blocks, p)


def contamination(docs: DataFrame, benchmark: DataFrame, p: Decontamination = Decontamination()) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near) for each row of docs(doc_id, text, ...).

    Texts are lower-cased in A-Z; words are runs of ASCII letters and digits and
    characters beyond ASCII.  n_hit counts the words of a document inside any
    exact occurrence of a window, n_items the items with such windows, and
    items_sha256 is the digest of their ids, sorted as strings and joined by
    commas.  Null and empty texts, and texts without words, have no words and are
    clean.  Items without words or with a null id match nothing; rows that repeat
    an item count once.  Repeated documents are judged each.  Other columns are
    ignored; with empty tables nothing is contaminated.
    """
    spans = F.zip_with("ends", "starts", lambda e, s: e - s)
    n_hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda x, y: x + y)
    found = matches(docs, benchmark, p).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        "n_near",
    )
    bad = (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= p.percent * F.col("n_words"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", bad.alias("contaminated"), "n_near")
