"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a block of texts are held as one array of symbols
with offsets.  A chunk of ASCII letters is a pre-token as it is; others are
normalised and split one by one.  In every round each sequence finds its lowest-rank pair and all
sequences apply theirs at once; sequences without a pair leave.  What counts is
how many symbols survive.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.llm import arrowtext as at
from tessellum.llm import wordbpe

_NEVER = np.iinfo(np.int32).max


class Merges:
    """Symbols and merge ranks of a tokenizer file."""

    def __init__(self, name: str) -> None:
        tokenizer, parsed = wordbpe.load(name)
        vocabulary, suffix = parsed["model"]["vocab"], parsed["model"]["end_of_word_suffix"]
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in parsed["model"]["merges"]]
        left, right, made = (np.array([vocabulary[f(x)] for x in merges], np.int64) for f in (lambda x: x[0], lambda x: x[1], lambda x: x[0] + x[1]))
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]
        self.slots = np.full(1 << self._BITS, -1, np.int64)
        slot = self._hashed(self.keys)
        self.slots[slot] = np.arange(len(slot))
        taken, times = np.unique(slot, return_counts=True)
        self.slots[taken[times > 1]] = -2
        self.tokenizer = tokenizer
        # the alphabet of byte-level models: printable bytes stand for themselves, the others from U+0100 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.byte_of = {c: b for b, c in letter.items()}
        self.inner = np.array([vocabulary[letter[b]] for b in range(256)], np.int64)
        self.last = np.array([vocabulary[letter[b] + suffix] for b in range(256)], np.int64)

    _BITS = 21

    def _hashed(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._BITS)).view(np.int64)

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the table) of each pair; a pair that doesn't merge has the rank _NEVER."""
        keys = (left << 32) | right
        place = self.slots[self._hashed(keys)]
        shared = np.flatnonzero(place == -2)  # a slot of several pairs
        if len(shared):
            place[shared] = np.minimum(np.searchsorted(self.keys, keys[shared]), len(self.keys) - 1)
        rank = np.full(len(keys), _NEVER, np.int32)
        there = np.flatnonzero(place >= 0)
        there = there[self.keys[place[there]] == keys[there]]
        rank[there] = self.ranks[place[there]]
        return rank, place

    def surviving(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count of each pre-token, symbols end to end) after all merges, of pre-tokens given
        as bytes end to end and their lengths (1 at least)."""
        count = lengths.astype(np.int64).copy()
        alive = np.arange(len(lengths))
        symbols = self.inner[data]
        symbols[np.cumsum(lengths) - 1] = self.last[data[np.cumsum(lengths) - 1]]
        left, owners = [], []
        while len(alive):
            size = count[alive]
            first = np.cumsum(size) - size
            rank = np.full(len(symbols), _NEVER, np.int32)
            rank[:-1], place = self.ranked(symbols[:-1], symbols[1:])
            rank[first + size - 1] = _NEVER
            least = np.minimum.reduceat(rank, first)
            stays = least != _NEVER
            held = np.repeat(stays, size)
            left.append(symbols[~held])
            owners.append(alive[~stays])
            pick = (rank == np.repeat(least, size)) & held
            # of overlapping equal pairs every second one merges, from the left
            where = np.flatnonzero(pick)
            if len(where):
                fresh = np.concatenate(([True], np.diff(where) > 1))
                begin = np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))
                where = where[(np.arange(len(where)) - begin) % 2 == 0]
                symbols[where] = self.made[place[where]]
                held[where + 1] = False
                gone = np.zeros(len(symbols), np.int64)
                gone[where + 1] = 1
                count[alive] -= np.add.reduceat(gone, first)
            symbols, alive = symbols[held], alive[stays]
        flat, order = np.concatenate(left), np.concatenate(owners)
        begin = np.zeros(len(count), np.int64)
        begin[order] = np.cumsum(count[order]) - count[order]
        return count, flat[at.ragged(begin, count)]

    _PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")

    def pretokens(self, chunk: str) -> list[bytes]:
        """The pre-tokens of a chunk, as bytes."""
        if self._PLAIN.fullmatch(chunk) and unicodedata.is_normalized("NFC", chunk):
            return [chunk.lower().encode()]
        normal = self.tokenizer.normalizer.normalize_str(chunk)
        return [bytes(self.byte_of[c] for c in x) for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def tokens(self, block: at.TextBlock, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of each chunk of a block, token ids end to end)."""
        other = np.concatenate(([0], np.cumsum(~_LETTERS[block.data], dtype=np.int64)))
        bare = other[ends] == other[starts]  # ASCII letters alone are one pre-token, lower-cased
        plain, rest = np.flatnonzero(bare), np.flatnonzero(~bare)
        sizes = ends[plain] - starts[plain]
        made = [self.pretokens(x) for x in wordbpe.strings(block, starts[rest], ends[rest])]
        flat = [p for x in made for p in x]
        data = np.concatenate((at.ASCII_LOWER[block.data[at.ragged(starts[plain], sizes)]], np.frombuffer(b"".join(flat), np.uint8)))
        if not len(data):
            return np.zeros(len(starts), np.int64), np.zeros(0, np.int64)
        count, ids = self.surviving(data, np.concatenate((sizes, np.array([len(p) for p in flat], np.int64))))
        owner = np.concatenate((plain, np.repeat(rest, [len(x) for x in made])))
        total = np.bincount(owner, count, minlength=len(starts)).astype(np.int64)
        placed = np.zeros(len(starts), np.int64)  # where the ids of each chunk begin
        order = np.concatenate((plain, rest))
        placed[order] = np.cumsum(total[order]) - total[order]
        return total, ids[at.ragged(placed, total)]


_LETTERS = at.byte_class([(0x41, 0x5A), (0x61, 0x7A)])


@lru_cache(maxsize=2)
def merges(name: str) -> Merges:
    return Merges(name)


def _count(batches: Iterator[pa.RecordBatch], name: str, block_bytes: int) -> Iterator[pa.RecordBatch]:
    model, special, known = merges(name), wordbpe.specials(name), {}
    for batch in batches:
        for block in at.blocks(batch.column("text"), block_bytes):
            starts, ends, offsets = wordbpe.chunks(block, special)
            codes, hashes, sample = wordbpe.distinct(block, starts, ends)
            if len(known) > wordbpe.CACHE or not known:
                known = dict.fromkeys(wordbpe.hashed(special), 1)
            fresh = [i for i, h in enumerate(hashes) if h not in known]
            pick = sample[fresh]
            got, _ = model.tokens(block, starts[pick], ends[pick])
            known.update(zip([hashes[i] for i in fresh], got.tolist(), strict=True))
            each = np.array([known[h] for h in hashes], np.int64)[codes] if len(codes) else np.zeros(0, np.int64)
            sums = np.concatenate(([0], np.cumsum(each)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(block.first, len(block)), pa.array(np.diff(block.offsets)), pa.array(sums[offsets[1:]] - sums[offsets[:-1]])],
                names=["doc_id", "n_bytes", "n_tokens"],
            )


def token_counts(docs: DataFrame, limit: int = 2048, tokenizer: str = wordbpe.DEFAULT, block_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of docs(doc_id, text, ...).

    Whole texts, without truncation, padding or added special tokens; strings of
    special tokens inside a text count as the library takes them, one token each.
    A worker handles about `block_bytes` of texts at a time.
    Null and empty texts have no bytes and no tokens.  Rows that repeat, and null
    ids, are counted like any other row; other columns are ignored; an empty
    table gives an empty one.
    """
    counted = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        partial(_count, name=tokenizer, block_bytes=block_bytes), "doc_id bigint, n_bytes bigint, n_tokens bigint"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
