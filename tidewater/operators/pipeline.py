"""A feature pipeline with fit / transform and a JSON config.

Config: ``{"steps": [{"op": "minmax", "col": "value", "by": null, "out": "value_mm"}, ...]}``.
Supported ops: coerce, temporal, minmax, standard, bucketize, onehot,
target, frequency, tokenize. ``fit`` learns each step's state on the data
as transformed by the steps before it; the state of every step is a small
DataFrame (aggregates) or a short list (one-hot categories). Tables of state
are written when fitted and read back, so later changes of the data change no
encoding, and a step's plan names the source once, whatever came before.
``to_json`` renders the config plus list-shaped state.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import features as FT
from . import temporal as TM


@dataclass
class FittedPipeline:
    steps: list[dict]
    state: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        for step, st in zip(self.steps, self.state):
            df = _apply(step, st, df)
        return df

    def to_json(self) -> str:
        listed = [st if isinstance(st, list) else None for st in self.state]
        return json.dumps({"steps": self.steps, "state": listed}, sort_keys=True)

    def save(self, path: str) -> None:
        """Config + list state as ``pipeline.json``; every table-shaped state
        as a small Parquet table ``state_<i>[_<j>]`` next to it."""
        spark = None
        kinds = []
        for i, st in enumerate(self.state):
            if isinstance(st, DataFrame):
                st.write.mode("overwrite").parquet(f"{path}/state_{i}")
                spark = st.sparkSession
                kinds.append("table")
            elif isinstance(st, tuple):
                for j, part in enumerate(st):
                    part.write.mode("overwrite").parquet(f"{path}/state_{i}_{j}")
                    spark = part.sparkSession
                kinds.append(f"tables:{len(st)}")
            elif isinstance(st, list):
                kinds.append("list")
            else:
                kinds.append("none")
        doc = json.dumps({"steps": self.steps, "kinds": kinds,
                          "lists": [st if isinstance(st, list) else None for st in self.state]},
                         sort_keys=True)
        if spark is None:
            from pyspark.sql import SparkSession
            spark = SparkSession.getActiveSession()
        spark.createDataFrame([(doc,)], "doc string").coalesce(1).write.mode("overwrite").text(
            f"{path}/pipeline.json")


def load(spark, path: str) -> FittedPipeline:
    """Inverse of ``FittedPipeline.save``."""
    doc = json.loads(spark.read.text(f"{path}/pipeline.json").first()[0])
    state = []
    for i, (kind, lst) in enumerate(zip(doc["kinds"], doc["lists"])):
        if kind == "table":
            state.append(spark.read.parquet(f"{path}/state_{i}"))
        elif kind.startswith("tables:"):
            n = int(kind.split(":")[1])
            state.append(tuple(spark.read.parquet(f"{path}/state_{i}_{j}") for j in range(n)))
        elif kind == "list":
            state.append(lst)
        else:
            state.append(None)
    return FittedPipeline(doc["steps"], state)


def parse(config: str | dict) -> list[dict]:
    cfg = json.loads(config) if isinstance(config, str) else config
    return list(cfg["steps"])


def fit(config: str | dict, df: DataFrame) -> FittedPipeline:
    steps = parse(config)
    state = []
    cur = df
    for step in steps:
        st = _frozen(_fit(step, cur))
        state.append(st)
        cur = _apply(step, st, cur)
    return FittedPipeline(steps, state)


def _frozen(st):
    if isinstance(st, tuple):
        return tuple(_frozen(x) for x in st)
    if not isinstance(st, DataFrame):
        return st
    path = scratch_path(st.sparkSession, "pipeline-state")
    st.write.parquet(path)
    return st.sparkSession.read.schema(st.schema).parquet(path)


def _fit(step: dict, df: DataFrame):
    op = step["op"]
    if op == "minmax":
        return FT.fit_minmax(df, step["col"], step.get("by"))
    if op == "standard":
        return FT.fit_standard(df, step["col"], step.get("by"))
    if op == "onehot":
        return FT.fit_onehot(df, step["col"], step.get("max_categories"))
    if op == "target":
        return FT.fit_target(df, step["col"], step["target"], step.get("m", 10.0))
    if op == "frequency":
        return FT.fit_frequency(df, step["col"])
    if op in ("coerce", "temporal", "bucketize", "tokenize"):
        return None
    raise ValueError(f"unknown pipeline op {op!r}")


def _apply(step: dict, st, df: DataFrame) -> DataFrame:
    op = step["op"]
    col = step.get("col")
    out = step.get("out") or f"{col}_{op}"
    if op == "coerce":
        return FT.coerce(df, step["schema"], flag=step.get("flag"))
    if op == "temporal":
        return df.select("*", *TM.temporal_parts(col))
    if op == "minmax":
        return FT.apply_minmax(df, st, col, out, step.get("by"))
    if op == "standard":
        return FT.apply_standard(df, st, col, out, step.get("by"))
    if op == "bucketize":
        return df.withColumn(out, FT.bucketize(col, step["cuts"]))
    if op == "onehot":
        return FT.apply_onehot(df, col, st, step.get("prefix"))
    if op == "target":
        enc, glob = st
        return FT.apply_target(df, enc, glob, col, out)
    if op == "frequency":
        return FT.apply_frequency(df, st, col, out)
    if op == "tokenize":
        return df.withColumn(out, FT.tokenize(col))
    raise ValueError(f"unknown pipeline op {op!r}")
