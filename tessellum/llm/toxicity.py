"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Per-coordinate learning rates and an L1 penalty leave few weights, which go to
the scoring tasks as two short arrays.  Training is sequential, so it takes a
bounded sample of labelled rows, chosen by a hash of their ids, in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellum.llm import arrowtext as at
from tessellum.llm.folds import remainder, training_labels

U64 = np.uint64


@dataclass(frozen=True)
class ToxicityModelSpec:
    """Parameters.

    bits: the hashed feature space has 2**bits coordinates, the bound of what is broadcast.
    alpha, beta, l1, l2: of FTRL-proximal.
    epochs: passes over the sample.
    train_rows: most labelled ids that are learned from, taken by a hash of the id; of an id with several texts, the least.
    threshold, folds, held_out: as in the quality classifier.
    """

    bits: int = 20
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 12.0
    l2: float = 0.0
    epochs: int = 6
    train_rows: int = 12_000
    threshold: float = 0.7
    folds: int = 3
    held_out: int = 1


def features(block: at.TextBlock, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(coordinate, text) of every word, pair of neighbours and pair with one word between."""
    w = at.words(block, at.ALPHANUMERIC)
    owner = np.repeat(np.arange(len(block)), w.counts())
    found, own = [at.mix(w.hashes + U64(1))], [owner]
    for gap, a, b in ((1, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB), (2, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)):
        if len(owner) > gap:
            same = np.flatnonzero(owner[gap:] == owner[:-gap])
            found.append(at.mix(w.hashes[same] * U64(a) + w.hashes[same + gap] * U64(b)))
            own.append(owner[same])
    return (np.concatenate(found) >> U64(64 - bits)).astype(np.int64), np.concatenate(own)


def train(examples: list[tuple[np.ndarray, int]], spec: ToxicityModelSpec) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) of the non-zero weights; the last coordinate is the bias.

    examples: distinct coordinates of a text and its label.
    """
    size = (1 << spec.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i: np.ndarray) -> np.ndarray:
        shrunk = z[i] - np.sign(z[i]) * spec.l1
        shrunk[np.abs(z[i]) <= spec.l1] = 0
        bias = i == size - 1  # not penalised
        shrunk[bias] = z[i][bias]
        return -shrunk / ((spec.beta + np.sqrt(n[i])) / spec.alpha + spec.l2)

    for _ in range(spec.epochs):
        for coordinates, label in examples:
            i = np.append(coordinates, size - 1)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / spec.alpha
            z[i] += g - sigma * w
            n[i] += g * g
    every = np.flatnonzero((np.abs(z) > spec.l1) | (np.arange(size) == size - 1))
    w = weights(every)
    keep = (w != 0) | (every == size - 1)
    return every[keep], w[keep]


def _learn(batches: Iterator[pa.RecordBatch], spec: ToxicityModelSpec) -> Iterator[pa.RecordBatch]:
    examples: list[tuple[int, np.ndarray, int]] = []
    for batch in batches:
        labels, ids = batch.column("label").to_pylist(), batch.column("doc_id").to_pylist()
        for block in at.blocks(batch.column("text")):
            found, owner = features(block, spec.bits)
            order = np.argsort(owner, kind="stable")
            found, cut = found[order], np.searchsorted(owner[order], np.arange(len(block) + 1))
            for i in range(len(block)):
                row = block.first + i
                examples.append((ids[row], np.unique(found[cut[i] : cut[i + 1]]).astype(np.int32), labels[row]))
    examples.sort(key=lambda x: (int(at.mix(np.array([x[0]], np.int64).view(U64))[0]), len(x[1])))
    at_, w = train([(x, y) for _, x, y in examples], spec) if len({y for *_, y in examples}) == 2 else (np.zeros(0, np.int64), np.zeros(0))
    yield pa.RecordBatch.from_arrays([pa.array(at_), pa.array(w)], names=["coordinate", "weight"])


def _score(batches: Iterator[pa.RecordBatch], spec: ToxicityModelSpec, coordinates: np.ndarray, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    size = 1 << spec.bits
    dense = np.zeros(size, np.float32)
    words = coordinates < size
    dense[coordinates[words]] = weights[words]
    bias = float(weights[~words].sum())
    for batch in batches:
        for block in at.blocks(batch.column("text")):
            found, owner = features(block, spec.bits)
            heavy = np.flatnonzero(dense[found])
            pairs = np.unique(owner[heavy].astype(np.int64) * size + found[heavy])
            total = bias + np.bincount(pairs // size, dense[pairs % size].astype(float), minlength=len(block))
            score = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.first, len(block)), pa.array(score)], names=["doc_id", "score"])


def toxicity_scores(docs: DataFrame, labels: DataFrame, spec: ToxicityModelSpec = ToxicityModelSpec()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs(doc_id, text, ...).

    labels(doc_id, toxic) teach outside the held-out fold; null labels are left
    out and an id that is labelled twice counts once.  Null and empty texts have
    the score of the bias.  Without labels of both classes every score is 0.5.
    Repeated rows are scored each; a null doc_id counts as an empty text for its
    fold; other columns are ignored; an empty table gives an empty one.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    chosen = training_labels(labels, "toxic", spec.folds, spec.held_out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(spec.train_rows)
    # one text of an id, however often it is there: no more than train_rows texts come to the task that learns
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).repartition(1)
    learned = sample.mapInArrow(partial(_learn, spec=spec), "coordinate bigint, weight double").collect()
    coordinates = np.array([r[0] for r in learned], np.int64)
    weights = np.array([r[1] for r in learned], float)
    scored = texts.mapInArrow(partial(_score, spec=spec, coordinates=coordinates, weights=weights), "doc_id bigint, score double")
    held = remainder("doc_id", spec.folds) == spec.held_out
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= spec.threshold).cast("int").alias("predicted"))
