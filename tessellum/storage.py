"""Tables written in the folder that all executors share, to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Our folder under spark.checkpoint.dir of the session.

    Only a session in one local process may do without that setting and gets a
    temporary folder.  Executors of their own would each write to their own
    disk, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that the driver and all executors of {master} share")
        folder = f"file://{tempfile.gettempdir()}/checkpoints/tessellum"
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/tessellum-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    The table outlives lost executors.  Tables stay until the folder of the
    application is removed, since lazily evaluated results may still read them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
