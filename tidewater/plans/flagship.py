"""The flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lifecycle as L
from ..operators import manifest as M
from .common import vfiles


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = vfiles(spark, sf_dir)
    cur = M.current(L.replayed_log(files))
    return (cur.join(files.select("content_hash", "path", "format"), ["content_hash", "path"])
            .groupBy("source", "format", "status")
            .agg(F.count(F.lit(1)).cast("bigint").alias("files")))
