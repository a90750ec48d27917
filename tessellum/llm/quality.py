"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a mean and a covariance, shrunk toward the pooled covariance and
then toward a multiple of the identity.  Both are fitted from sums over all
labelled rows.  A document's score is the logistic of the difference of the two
Mahalanobis log densities, with the Cholesky factors computed once.
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
from tessellum.llm.storage import materialise

U64 = np.uint64


@dataclass(frozen=True)
class QualityModelSpec:
    """Parameters.

    pooled, ridge: how far a class covariance is shrunk toward the pooled one
        and then toward the identity.
    threshold: least score of a document that is predicted good.
    folds, held_out: labels of ids with that remainder are never learned from.
    broadcast_ids: most ids that are broadcast to pick labelled texts; above it, a join.
    """

    pooled: float = 0.2
    ridge: float = 0.05
    threshold: float = 0.7
    folds: int = 4
    held_out: int = 2
    broadcast_ids: int = 1_000_000


STATISTICS = [
    "words", "word_length", "word_spread", "symbols", "digits", "capitals", "stops", "line_words",
    "repeated_lines", "distinct_words", "distinct_pairs", "bare_words", "sentence_words", "other_signs",
]

_SYMBOL = at.byte_class([(ord(c), ord(c)) for c in "#*$%&|<>"])
_DIGIT = at.byte_class([(0x30, 0x39)])
_CAPITAL = at.byte_class([(0x41, 0x5A)])
_STOP = at.byte_class([(ord(c), ord(c)) for c in ".!?"])
_SIGN = at.byte_class([(0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)])
_LEAD = at.byte_class([(0x00, 0x7F), (0xC0, 0xFF)])
_LETTER = at.byte_class([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
_LINE = ~at.byte_class([(0x0A, 0x0A)])


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def statistics(block: at.TextBlock) -> np.ndarray:
    """A row of transformed statistics for each text of a block; an empty text has a fixed row."""
    n, data = len(block), block.data
    starts, ends = at.word_spans(block, data, at.SPACE_SEPARATED)
    first = np.searchsorted(starts, block.offsets)
    words = np.diff(first)
    owner = np.repeat(np.arange(n), words)
    lead = np.concatenate(([0], np.cumsum(_LEAD[data], dtype=np.int64)))
    length = lead[ends] - lead[starts]
    some = np.maximum(words, 1)
    total = np.bincount(owner, length, minlength=n)
    mean = total / some
    spread = np.sqrt(np.maximum(np.bincount(owner, length.astype(float) ** 2, minlength=n) / some - mean**2, 0))
    lines, line_ends = at.word_spans(block, data, _LINE)
    line_owner = np.searchsorted(block.offsets, lines, "right") - 1
    n_lines = np.bincount(line_owner, minlength=n)
    hashes = at.span_hashes(at.ASCII_LOWER[data], starts, ends)
    line_hash = at.span_hashes(data, lines, line_ends)
    pairs = hashes[:-1] * U64(0xA0761D6478BD642F) + hashes[1:] if len(hashes) else hashes
    together = np.flatnonzero(owner[1:] == owner[:-1])

    def distinct(values: np.ndarray, own: np.ndarray) -> np.ndarray:
        salted = at.mix(values + own.astype(U64) * U64(0x9E3779B97F4A7C15))
        order = np.argsort(salted)
        salted, own = salted[order], own[order]
        fresh = np.concatenate(([True], salted[1:] != salted[:-1])) if len(salted) else np.zeros(0, bool)
        return np.bincount(own[fresh], minlength=n)

    letters = np.concatenate(([0], np.cumsum(_LETTER[data], dtype=np.int64)))
    bare = (letters[ends] - letters[starts]) == (ends - starts)
    chars = np.maximum(total, 1)
    stops = _per_text(_STOP[data], block.offsets)
    symbols = _per_text(_SYMBOL[data], block.offsets)
    pair_count = np.maximum(words - 1, 0)
    columns = [
        np.log1p(words),
        np.log1p(mean),
        np.log1p(spread),
        np.log(0.002 + symbols / chars),
        np.log(0.01 + _per_text(_DIGIT[data], block.offsets) / chars),
        np.log(0.005 + _per_text(_CAPITAL[data], block.offsets) / chars),
        np.log(0.01 + stops / some),
        np.log1p(words / np.maximum(n_lines, 1)),
        np.sqrt((n_lines - distinct(line_hash, line_owner)) / np.maximum(n_lines, 1)),
        np.log(0.02 + distinct(hashes, owner) / some),
        np.log(0.02 + (distinct(pairs[together], owner[:-1][together]) + 1) / (pair_count + 1)),
        np.log(0.05 + np.bincount(owner, bare, minlength=n) / some),
        np.log1p(words / (stops + 1)),
        np.log(0.005 + (_per_text(_SIGN[data], block.offsets) - symbols - stops) / chars),
    ]
    return np.stack(columns, axis=1)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in at.released(batches):
        for block in at.blocks(batch.column("text")):
            x = statistics(block)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(block.first, len(block)), *(pa.array(x[:, k]) for k in range(x.shape[1]))],
                names=["doc_id", *STATISTICS],
            )


MEASURED = "doc_id bigint, " + ", ".join(f"{x} double" for x in STATISTICS)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) of each row of docs."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(_measure, MEASURED)


@dataclass
class Discriminant:
    """Of each class (0, 1): mean, inverse Cholesky factor and log density's constant with the prior."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        density = [k - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, k in zip(self.means, self.factors, self.constants, strict=True)]
        return density[1] - density[0]


def fit(table: DataFrame, labels: DataFrame, spec: QualityModelSpec) -> Discriminant | None:
    """The discriminant of measured documents and labels(doc_id, label); None unless both classes have rows."""
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.sum(x).alias(f"s{i}") for i, x in enumerate(STATISTICS)]
    pairs = [(i, j) for i in range(len(STATISTICS)) for j in range(i + 1)]
    sums += [F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"q{i}_{j}") for i, j in pairs]
    few = labels.count() <= spec.broadcast_ids
    got = {r["label"]: r for r in table.join(F.broadcast(labels) if few else labels, "doc_id").groupBy("label").agg(*sums).collect()}
    if set(got) != {0, 1}:
        return None
    d, means, scatter, count = len(STATISTICS), [], [], []
    for c in (0, 1):
        n = got[c]["n"]
        mean = np.array([got[c][f"s{i}"] for i in range(d)]) / n
        second = np.zeros((d, d))
        for i, j in pairs:
            second[i, j] = second[j, i] = got[c][f"q{i}_{j}"] / n
        means.append(mean)
        scatter.append(second - np.outer(mean, mean))
        count.append(n)
    pooled = (count[0] * scatter[0] + count[1] * scatter[1]) / sum(count)
    factors, constants = [], []
    for c in (0, 1):
        cov = (1 - spec.pooled) * scatter[c] + spec.pooled * pooled
        cov = (1 - spec.ridge) * cov + spec.ridge * max(np.trace(cov) / d, 1e-6) * np.eye(d)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(count[c] / sum(count)) - np.log(np.diag(lower)).sum()))
    return Discriminant(means, factors, constants)


def _score(batches: Iterator[pa.RecordBatch], model: Discriminant | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS], axis=1)
        score = np.full(len(x), 0.5) if model is None else 1 / (1 + np.exp(-np.clip(model.log_ratio(x), -500, 500)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])


def quality_scores(docs: DataFrame, labels: DataFrame, spec: QualityModelSpec = QualityModelSpec()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs(doc_id, text, ...).

    labels(doc_id, quality) teach outside the held-out fold; null labels are left
    out and an id that is labelled twice counts once.  Null and empty texts get
    the score of a text without words.  Without labels of both classes every
    score is 0.5.  Repeated rows are scored each; a null doc_id counts as an
    empty text for its fold; other columns are ignored; an empty table gives an
    empty one.
    """
    table = materialise(measured(docs), "statistics")
    model = fit(table, materialise(training_labels(labels, "quality", spec.folds, spec.held_out), "taught"), spec)
    scored = table.mapInArrow(partial(_score, model=model), "doc_id bigint, score double")
    held = remainder("doc_id", spec.folds) == spec.held_out
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= spec.threshold).cast("int").alias("predicted"))


def _keep_good(batches: Iterator[pa.RecordBatch], model: Discriminant, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in at.released(batches):
        good = [model.log_ratio(statistics(block)) for block in at.blocks(batch.column("text"))]
        if good:
            score = 1 / (1 + np.exp(-np.clip(np.concatenate(good), -500, 500)))
            yield batch.filter(pa.array(score >= threshold))


def good_documents(docs: DataFrame, labels: DataFrame, spec: QualityModelSpec = QualityModelSpec()) -> DataFrame:
    """The rows of docs that are predicted good, with all columns; every row without labels of both classes."""
    taught = materialise(training_labels(labels, "quality", spec.folds, spec.held_out), "taught")
    labelled = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if taught.count() <= spec.broadcast_ids:
        labelled = labelled.join(F.broadcast(taught.select("doc_id")), "doc_id", "left_semi")
    else:
        labelled = labelled.join(taught.select("doc_id"), "doc_id", "left_semi")
    model = fit(materialise(measured(labelled), "statistics"), taught, spec)
    if model is None:
        return docs
    return docs.mapInArrow(partial(_keep_good, model=model, threshold=spec.threshold), docs.schema)
