"""Written intermediate tables: they cut long plans and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset (tests, local mode), a new temporary folder."""
    said = spark.conf.get("spark.checkpoint.dir", None)
    return said or _OWN.setdefault("dir", tempfile.mkdtemp(prefix="kinlink-"))


def stage(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back. What was shuffled for it goes at once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/kinlink-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
