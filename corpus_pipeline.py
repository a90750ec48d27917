"""A corpus run: quality, near-duplicates, benchmark passages, secrets, packing."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellum.llm import decontam, minhash, packing, quality, secrets
from tessellum.llm.skew import join_counted
from tessellum.llm.storage import materialise

#: Most ids that are broadcast to a filter; above it, the filter is a shuffled join.
BROADCAST_IDS = 1_000_000

#: Most bytes and rows of texts that go to a Python worker at once.
BATCH_BYTES, BATCH_ROWS = "8m", "2000"

#: Near copies for the corpus: a similarity of 0.8 or more, where op1's own contract says 0.85.  A pair at 0.8 agrees
#: in fewer than 34 of 64 coordinates with a probability of about 3e-7.
NEAR = minhash.NearDuplicates(similarity=80, threshold=34)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


ARROW_BOUNDS = {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES, "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS}


def _bounded(stage: Stage) -> Stage:
    """The stage with small Arrow batches: workers of one stage after the other share an executor's memory.

    The settings must hold when the stage's result is written, so they stay; `run`
    puts the session's own back.
    """

    @functools.wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in ARROW_BOUNDS.items():
            spark.conf.set(name, value)
        return stage(spark, docs, sf_dir)

    return bounded


def _free_name(docs: DataFrame, name: str = "row_key") -> str:
    """A column name that docs doesn't have, in any case of letters."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _filtered(docs: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """The rows of docs whose key is (left_semi) or is not (left_anti) among ids(key)."""
    ids = materialise(ids.distinct(), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)


@_bounded
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier predicts good; all of them if labels teach it nothing."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_bounded
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, linked at 0.8 or more: the one with the least doc_id.

    Rows are told apart by a hash of doc_id and text.  Of rows with the same
    doc_id and text one stays, the least as JSON; rows without a doc_id stay.
    """
    key = _free_name(docs)
    keyed = docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    found = materialise(minhash.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), NEAR), "near")
    rows = found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("component"), F.min("n_shingles").alias("n_shingles"))
    rows = materialise(rows, "rows")
    grouped = materialise(rows.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "grouped")
    linked = join_counted(rows.filter("n_shingles > 0").select(key, "component"), grouped.drop("n"), ["component"], rows.count(), [key], grouped)
    members = linked.join(keyed.select(key, "doc_id").distinct(), key)
    members = materialise(members, "members")
    least = members.groupBy("component").agg(F.min_by(key, F.struct("doc_id", key)).alias(key))
    left = _filtered(keyed, members.select(key).join(least.select(key), key, "left_anti"), key, "left_anti")
    repeated = materialise(rows.filter("n > 1").select(key), "repeated")
    if repeated.isEmpty():
        return left.select(*docs.columns)
    row = F.struct(*[F.col(c) for c in docs.columns])
    one = _filtered(left, repeated, key, "left_semi").groupBy(key).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*").select(*docs.columns)
    return _filtered(left, repeated, key, "left_anti").select(*docs.columns).unionByName(one)


@_bounded
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated by the benchmark.

    Each row is judged by a hash of its id and text, so rows without an id, or
    with the same one, are told apart.
    """
    key = _free_name(docs)
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    judged = decontam.contamination(keyed.select(F.col(key).alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _filtered(keyed, judged.filter("contaminated").select(F.col("doc_id").alias(key)), key, "left_anti").select(*docs.columns)


@_bounded
def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked and n_chars brought up to date."""
    return secrets.redacted(docs)


@_bounded
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("best-fit packing", packing_stage),
]

#: The classifier, the dedup and the packing can't be told in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each is written as Parquet and read again as the next one's documents.

    The session's Arrow settings are as before when it returns: what is left to
    do then handles short rows only.  Nulls in any column, empty and very long
    texts, repeated rows and empty tables are handled as the stages say.
    """
    before = {name: spark.conf.get(name, None) for name in ARROW_BOUNDS}
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES[:-1]:
            docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
