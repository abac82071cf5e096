"""Shared pieces of the query catalog: loaders and output formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from ..sources.tables import table
from ..sources.virtual import classified, virtual_files

TS_FMT = "yyyy-MM-dd HH:mm:ss"
TS_US_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUCK_TS = "%Y-%m-%d %H:%M:%S"
DUCK_TS_US = "%Y-%m-%d %H:%M:%S.%f"


def ts_text(c: Column | str, micros: bool = False) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, TS_US_FMT if micros else TS_FMT)


def prep(spark: SparkSession) -> SparkSession:
    return configure(spark)


def vfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified virtual files of the documents table (no bytes)."""
    prep(spark)
    return classified(virtual_files(table(spark, sf_dir, "documents")))


def vfiles_with_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prep(spark)
    return virtual_files(table(spark, sf_dir, "documents"))


def r6(c: Column | str) -> Column:
    """Round doubles to 6 places (both engines round the same way)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6)
