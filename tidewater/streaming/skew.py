"""training/serving skew — one pipeline, run as batch and as stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def serving_skew(spark: SparkSession, source_path: str, schema: T.StructType,
                 transform: Callable[[DataFrame], DataFrame], work: str,
                 serving: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows produced by only one of the two paths (``side`` says which);
    multiset difference both ways (``exceptAll``). ``serving`` is what the
    stream runs, by default the same ``transform``."""
    serving = serving or transform
    batch = transform(spark.read.schema(schema).parquet(source_path))
    out = f"{work}/stream"

    def handle(df: DataFrame, batch_id: int) -> None:
        serving(df).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (spark.readStream.schema(schema).parquet(source_path).writeStream.foreachBatch(handle)
         .option("checkpointLocation", f"{work}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = spark.read.parquet(out).select(*batch.columns)
    return (batch.exceptAll(streamed).withColumn("side", F.lit("batch_only"))
            .unionByName(streamed.exceptAll(batch).withColumn("side", F.lit("stream_only"))))
