"""Joins with tables of unique keys, where a key may hold a large share of the other side's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellum.llm.storage import materialise

#: A key is hot if it has more rows than HOT_ROWS and than a HOT_KEYS-th of all rows: there are HOT_KEYS hot keys at most.
HOT_ROWS, HOT_KEYS = 1024, 1000


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], total: int, spread: list[str | Column], counts: DataFrame | None = None) -> DataFrame:
    """left joined with right, which has a row for each key at most, by the keys.

    Rows of a hot key are dealt to parts by a hash of the columns `spread`, and
    right's row goes to each part, so no task reads more than about a HOT_KEYS-th
    of left for one key.  total is the number of rows of left; counts(keys, n) says
    how many rows of left have each key, and is made where it isn't given.  What
    is broadcast are the hot keys, HOT_KEYS at most; right's rows grow by twice as
    many at most.
    """
    most = max(HOT_ROWS, total // HOT_KEYS)
    parts, part = "__parts", "__part"
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    hot = materialise(counts.filter(F.col("n") > most).select(*keys, F.ceil(F.col("n") / F.lit(most)).cast("int").alias(parts)), "hot")
    if hot.isEmpty():
        return left.join(right, keys)
    hot = F.broadcast(hot)
    dealt = left.join(hot, keys, "left").withColumn(part, F.coalesce(F.pmod(F.xxhash64(*spread), F.col(parts)).cast("int"), F.lit(0)))
    copied = right.join(hot, keys, "left").withColumn(part, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(parts) - 1, F.lit(0)))))
    return dealt.drop(parts).join(copied.drop(parts), [*keys, part]).drop(part)
