"""Which labelled rows a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, folds: int) -> Column:
    """crc32 of the id's decimal text modulo folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label) outside the held-out fold, once per id: the larger label if rows differ.  Nulls and other values are left out."""
    return (
        labels.select(F.col("doc_id").cast("bigint"), F.col(label).cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .filter(remainder("doc_id", folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
