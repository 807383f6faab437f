"""S1 records as they arrive, linked against a static pool."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kinlink.operators.normalize import SOURCE_COLUMNS, normalize, with_source
from kinlink.plans import linkage


def read_sources(spark: SparkSession, folder: str) -> DataFrame:
    """New tab-separated source files of a folder."""
    schema = ", ".join(f"{c} string" for c in SOURCE_COLUMNS)
    return spark.readStream.schema(schema).option("sep", "\t").option("header", True).csv(folder).na.fill("")


def link(arriving: DataFrame, pool: DataFrame, sink: str, checkpoint: str, model=None, threshold: float = 0.69, once: bool = True) -> StreamingQuery:
    """Each micro-batch is linked as a whole and written to sink/batch=N; a batch that is repeated replaces itself.

    pool: normalized, with source.
    """

    def batch(s1: DataFrame, n: int) -> None:
        found, _ = linkage.infer(with_source(normalize(s1)), pool, model, threshold)
        found.write.mode("overwrite").parquet(f"{sink}/batch={n}")

    writer = arriving.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
