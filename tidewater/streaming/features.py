"""Time features over streams with shuffled and late rows.

Rolling windows and as-of features share one keyed state: time is cut into buckets and ``SLAB``
buckets make a slab, keys are dealt to ``SHARDS`` by their hash, and a row is kept under (shard,
slab) of its own bucket and of the following slabs that its window or lifetime reaches. When the
watermark has passed the end of a bucket, a timer computes the bucket's own rows from what is
kept, and rows that no open bucket of the slab reaches are dropped. So every result is final,
order of arrival does not matter, state lasts one bucket's reach and the watermark's delay, and a
key that holds a third of all rows is spread over its slabs.

The watermark runs over the ends of the rows' buckets. A row is late, and dropped, if its
own bucket is closed when it arrives. Rows without a time take no part. Results come out
in append mode once their bucket closes.

Model quality keeps predictions and labels by shard of keys: see :func:`quality_stream`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "ignoreNullFields": "false"}
_COLUMNS = ["key", "us", "kind", "tiebreak", "real", "number", "payload", "end_ms"]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHARDS = 32               # groups of keys that share a slab's state
SLAB = 4                  # buckets of a slab
QUALITY_SHARDS = 128      # groups of keys that share the predictions and labels that wait


class BucketState(StatefulProcessor):
    """Keeps the rows of a (shard, slab). When buckets of it close, it gives ``close(rows)``, where
    ``real`` marks the closed buckets' own rows, and keeps what later buckets reach ``reach`` back for.

    What a micro-batch brings is one value of the state, an Arrow table: calls to the
    state store follow the shards and slabs, not the keys, rows or buckets."""

    def __init__(self, width_us: int, reach: int, close: Callable, carry: bool):
        self.width_us, self.reach, self.on_close, self.carry = width_us, reach, close, carry

    def init(self, handle) -> None:
        import pyarrow as pa

        self.handle = handle
        self.chunks = handle.getListState("chunks", "rows binary")
        self.schema = pa.schema([("key", pa.string()), ("us", pa.int64()), ("kind", pa.int32()), ("tiebreak", pa.int64()),
                                 ("real", pa.bool_()), ("number", pa.float64()), ("payload", pa.string()), ("end_ms", pa.int64())])

    def _keep(self, key, rows) -> None:
        """Add the table ``rows`` to the state. The timer is at the end of the earliest bucket with
        own rows, or of the slab."""
        import pyarrow as pa
        import pyarrow.compute as pc

        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.schema) as w:
            w.write_table(rows)
        self.chunks.appendValue((sink.getvalue().to_pybytes(),))
        first = pc.min(rows["end_ms"].filter(rows["real"])).as_py()
        self.handle.registerTimer(self._end_ms(key) if first is None else first)

    def _end_ms(self, key) -> int:
        return (int(key[-1]) + 1) * SLAB * self.width_us // 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pyarrow as pa

        watermark = timerValues.getCurrentWatermarkInMs()
        live = [x for x in (pdf[pdf["end_ms"] > watermark] for pdf in rows) if len(x)]
        if live:
            self._keep(key, pa.concat_tables([pa.Table.from_pandas(x[_COLUMNS], schema=self.schema, preserve_index=False) for x in live]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        watermark = timerValues.getCurrentWatermarkInMs()
        chunks = [pa.ipc.open_stream(bytes(c[0])).read_all() for c in self.chunks.get()]
        if not chunks:
            return      # another timer of the batch was here before
        kept = pa.concat_tables(chunks)
        at = kept.schema.get_field_index("real")
        done = pc.and_(kept["real"], pc.less_equal(kept["end_ms"], watermark))
        more = pc.and_not(kept["real"], done)
        if watermark >= self._end_ms(key):
            self.chunks.clear()
        elif pc.any(done).as_py():
            self.chunks.clear()
            since = (watermark * 1000 // self.width_us - self.reach) * self.width_us      # no open bucket reaches further back
            left = kept.set_column(at, "real", more)
            if not self.carry:
                left = left.set_column(left.schema.get_field_index("payload"), "payload", pc.if_else(more, left["payload"], None))
            left = left.filter(pc.or_(more, pc.greater_equal(left["us"], since)))
            if len(left):
                self._keep(key, left)
        if pc.any(done).as_py():
            yield self.on_close(kept.set_column(at, "real", done))

    def close(self) -> None:
        pass


def _ranks(kept):
    """Keys and times of the table ``kept`` as numbers: (the key's code, the time's rank, the different
    times, how code and rank make one number). Nulls are one key."""
    import numpy as np
    import pyarrow.compute as pc

    code = pc.dictionary_encode(kept["key"].combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    times, rank = np.unique(kept["us"].to_numpy(), return_inverse=True)
    return code, rank.astype(np.int64), times, lambda c, r: c * (len(times) + 1) + r


def _bucketed(stream: DataFrame, key: str, ts: str, width_us: int, reach: int, delay: str, kind: int,
              tiebreak: str | None, number: str | None, carry: bool) -> DataFrame:
    """The rows of ``stream`` under the slab of their own bucket and those of the ``reach`` following
    buckets, where they are not ``real`` and have their payload only with ``carry``."""
    d = stream.select(F.col(key).cast("string").alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"),
                      F.lit(kind).alias("kind"),
                      (F.col(tiebreak).cast("long") if tiebreak else F.lit(0).cast("long")).alias("tiebreak"),
                      (F.col(number).cast("double") if number else F.lit(None).cast("double")).alias("number"),
                      F.to_json(F.struct(*stream.columns), JSON).alias("payload")).where(F.col("us").isNotNull())
    own = F.floor(F.col("us") / width_us).cast("bigint")
    end_us = (own + 1) * width_us
    d = d.withColumn("own", own).withColumn("end", F.timestamp_micros(end_us)).withColumn("end_ms", F.floor(end_us / 1000).cast("bigint"))
    slab = lambda c: F.floor(c / SLAB).cast("bigint")
    real = F.col("slab") == slab(F.col("own"))
    return (d.withWatermark("end", delay)
            .select("*", F.explode(F.sequence(slab(F.col("own")), slab(F.col("own") + reach))).alias("slab"))
            .select(F.pmod(F.xxhash64("key"), F.lit(SHARDS)).cast("int").alias("shard"), "slab",
                    "end", "end_ms", "key", "us", "kind", "tiebreak", real.alias("real"), "number",
                    (F.col("payload") if carry else F.when(real, F.col("payload"))).alias("payload")))


def _closed(rows: DataFrame, width_us: int, reach: int, close: Callable, carry: bool, schema: str) -> DataFrame:
    return rows.groupBy("shard", "slab").transformWithStateInPandas(
        BucketState(width_us, reach, close, carry), schema, "append", "EventTime")


def _payload(schema, name: str):
    return F.from_json(name, schema, JSON)


def rolling_range_stream(stream: DataFrame, key: str, ts: str, value: str, seconds: int, delay: str,
                         prefix: str = "range", sub_buckets: int = 1) -> DataFrame:
    """B11 as a stream: what ``temporal.rolling_range`` gives, the columns of ``stream`` with count, sum
    and avg of the key's rows in [ts - seconds, ts]."""
    span, k = seconds * 1_000_000, max(1, sub_buckets)
    width = -(-span // k)

    def close(kept):
        import numpy as np
        import pandas as pd

        code, rank, times, place = _ranks(kept)
        order = np.argsort(place(code, rank), kind="stable")
        kept, code, rank = kept.take(order), code[order], rank[order]
        at, real = place(code, rank), kept["real"].to_numpy()
        x = kept["number"].to_numpy()      # NaN where null
        null = np.isnan(x)
        first = place(code[real], np.searchsorted(times, kept["us"].to_numpy()[real] - span, "left"))
        ends = np.column_stack((np.searchsorted(at, first, "left"), np.searchsorted(at, at[real], "right"))).ravel()
        # sums of the slices themselves, not differences of running sums
        slices = lambda v: np.add.reduceat(np.append(v, v[:1] * 0), ends)[::2]
        n, total = slices((~null).astype(np.int64)), slices(np.where(null, 0.0, x))
        with np.errstate(all="ignore"):
            return pd.DataFrame({"payload": kept["payload"].to_numpy()[real], "n": ends[1::2] - ends[::2],
                                 "total": np.where(n > 0, total, np.nan), "mean": np.where(n > 0, total / n, np.nan), "some": n > 0})

    rows = _bucketed(stream, key, ts, width, k, delay, 0, None, value, False)
    out = _closed(rows, width, k, close, False, "payload string, n long, total double, mean double, some boolean")
    return out.select(_payload(stream.schema, "payload").alias("r"), "*").select(
        "r.*", F.col("n").alias(f"{prefix}{seconds}_count"), F.when(F.col("some"), F.col("total")).alias(f"{prefix}{seconds}_sum"),
        F.when(F.col("some"), F.col("mean")).alias(f"{prefix}{seconds}_avg"))


def asof_features_stream(labels: DataFrame, features: DataFrame, key: str, label_ts: str, feature_ts: str, ttl_seconds: int,
                         feature_cols: list[str], tiebreak: str, delay: str, sub_buckets: int = 4) -> DataFrame:
    """B26 as a stream: what ``serving.asof_features`` gives, each label row with the latest feature row of
    its key at or before it and not older than the time to live. A null key matches nothing."""
    ttl, k = ttl_seconds * 1_000_000, max(1, sub_buckets)
    width = -(-ttl // k)

    def close(kept):
        import numpy as np
        import pandas as pd

        code, rank, times, place = _ranks(kept)
        kind, us = kept["kind"].to_numpy(), kept["us"].to_numpy()
        lab, fea = np.flatnonzero((kind == 1) & kept["real"].to_numpy()), np.flatnonzero(kind == 0)
        fea = fea[np.lexsort((kept["tiebreak"].to_numpy()[fea], place(code[fea], rank[fea])))]
        last = np.searchsorted(place(code[fea], rank[fea]), place(code[lab], rank[lab]), "right") - 1
        fea = np.append(fea, -1)           # -1: none
        found = fea[last]
        ok = (found >= 0) & (code[found] == code[lab]) & (us[found] >= us[lab] - ttl)
        payload = np.append(kept["payload"].to_numpy(), None)
        lab, found = payload[lab], payload[np.where(ok, found, len(payload) - 1)]
        return pd.DataFrame({"label": lab, "feature": found})

    fea = features.select(key, feature_ts, tiebreak, *[c for c in feature_cols if c not in (key, feature_ts, tiebreak)])
    rows = _bucketed(labels, key, label_ts, width, 0, delay, 1, None, None, True).unionByName(
        # null keys move the watermark on but are not kept (asking for the time column keeps the filter behind the watermark)
        _bucketed(fea, key, feature_ts, width, k, delay, 0, tiebreak, None, True).where(F.col("key").isNotNull() | F.col("end").isNull()))
    out = _closed(rows, width, k, close, True, "label string, feature string")
    f = _payload(fea.schema, "feature")
    return out.select(_payload(labels.schema, "label").alias("r"), f.alias("f")).select(
        "r.*", F.col(f"f.{tiebreak}").alias(f"feature_{tiebreak}"), *[F.col(f"f.{c}").alias(c) for c in feature_cols])


class LabelState(StatefulProcessor):
    """The predictions of a shard of keys that wait for their label, and its labels of the last
    ``delay``, each an Arrow table: calls to the state store follow the shards, not the rows.

    Gives a row for each prediction (``n`` 1) when it comes, with its label if that is there, and
    one (``n`` 0) when the label comes later. All lie before the watermark by their ``due``."""

    def __init__(self, delay_us: int):
        self.delay_us = delay_us

    def init(self, handle) -> None:
        import pyarrow as pa

        self.kept = handle.getValueState("rows", "rows binary")
        self.schema = pa.schema([("key", pa.string()), ("us", pa.int64()), ("due_us", pa.int64()), ("real", pa.bool_()), ("scored", pa.bool_()), ("score", pa.float64()),
                                 ("value", pa.string())])

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        new = pd.concat(list(rows), ignore_index=True)[self.schema.names]
        new = new[new["us"] > watermark]
        held = self.kept.get() if self.kept.exists() else None
        old = pa.ipc.open_stream(bytes(held[0])).read_all().to_pandas() if held else new[:0]
        old = old[np.where(old["real"], old["due_us"], old["us"] + self.delay_us) > watermark]
        wait = pd.concat([old[old["real"]], new[new["real"]]], ignore_index=True)
        came = np.arange(len(wait)) >= int(old["real"].sum())
        labels = pd.concat([old[~old["real"]], new[~new["real"]]], ignore_index=True).drop_duplicates("key")
        at = pd.Index(labels["key"]).get_indexer(wait["key"])      # labels have keys, and -1 is none
        at[wait["key"].isna()] = -1
        l_us, l_value = (np.append(labels[c].to_numpy(), none)[at] for c, none in (("us", 0), ("value", None)))
        hit = (at >= 0) & (l_us >= wait["us"].to_numpy()) & (l_us <= wait["due_us"].to_numpy())
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(pa.Table.from_pandas(pd.concat([wait[~hit], labels], ignore_index=True), schema=self.schema, preserve_index=False))
        self.kept.update((sink.getvalue().to_pybytes(),))
        told = came | hit
        yield pd.DataFrame({"due": wait["due_us"].to_numpy().astype("datetime64[us]")[told], "n": came[told].astype(np.int64), "hit": hit[told],
                            "predicted": wait["value"].to_numpy()[told], "scored": wait["scored"].to_numpy(bool)[told],
                            "score": wait["score"].to_numpy()[told], "actual": np.where(hit, l_value, None)[told]})

    def close(self) -> None:
        pass


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {interval})").first()[0]


def quality_stream(predictions: DataFrame, actuals: DataFrame, key: str, ts: str, actual_ts: str, predicted: str, score: str,
                   actual: str, wait: str, delay: str, window: str) -> DataFrame:
    """B30 as a stream: per window of prediction time, n_predictions, n_unmatched (no label within
    ``wait``), accuracy of ``predicted`` and RMSE of ``score`` against the labels that came.

    Labels may come up to ``wait`` after the prediction and be delivered again: within the
    watermark, one label counts per key. Predictions are counted when they come and matched when
    both are there (:class:`LabelState`); a window closes when no label can come for it."""
    spark = predictions.sparkSession
    wait_us, delay_us, window_us = (_micros(spark, x) for x in (wait, delay, window))

    def side(df, time, value, number, due, real):
        # pandas does not tell null from NaN: "scored" does
        us = F.unix_micros("ts")
        d = (df.select(F.col(key).cast("string").alias("key"), F.col(time).cast("timestamp").alias("ts"), F.col(value).cast("string").alias("value"),
                       number.cast("double").alias("score")).withWatermark("ts", delay))
        return d.select(F.pmod(F.xxhash64("key"), F.lit(QUALITY_SHARDS)).cast("int").alias("shard"), "ts", "key", us.alias("us"), (us + due).alias("due_us"),
                        F.lit(real).alias("real"), F.col("score").isNotNull().alias("scored"), "score", "value").where(F.col("us").isNotNull())

    # labels without a key move the watermark on but are not kept
    rows = side(predictions, ts, predicted, F.col(score), wait_us, True).unionByName(
        side(actuals, actual_ts, actual, F.lit(None), 0, False).where(F.col("key").isNotNull() | F.col("ts").isNull()))
    out = rows.groupBy("shard").transformWithStateInPandas(
        LabelState(delay_us), "due timestamp, n long, hit boolean, predicted string, scored boolean, score double, actual string",
        "append", "EventTime", eventTimeColumnName="due")
    came = F.col("actual").cast(actuals.schema[actual].dataType)
    right = F.col("predicted").cast(predictions.schema[predicted].dataType) == came
    err = F.pow(F.when(F.col("scored"), F.coalesce("score", F.lit(float("nan")))) - came, 2)
    return (out.groupBy(F.window("due", f"{window_us} microseconds", f"{window_us} microseconds", f"{wait_us % window_us} microseconds").alias("w"))
            .agg(F.sum("n").alias("n_predictions"), (F.sum("n") - F.count_if("hit")).alias("n_unmatched"),
                 F.avg(F.when(F.col("hit"), right.cast("double"))).alias("accuracy"),
                 F.sqrt(F.avg(F.when(F.col("hit"), err))).alias("rmse"))
            .select((F.col("w.start") - F.expr(f"INTERVAL {wait}")).alias("window_start"), "n_predictions", "n_unmatched", "accuracy", "rmse"))


@contextmanager
def with_rocksdb(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which lists, timers and expiry need, and
    commit its changes. The state has as many partitions as the cluster has cores, but no more
    than shuffles have, or ``partitions``: each is opened and committed in every micro-batch. A
    checkpoint keeps the number it was started with."""
    shuffles = "spark.sql.shuffle.partitions"
    conf = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
            shuffles: str(partitions or min(int(spark.conf.get(shuffles)), spark.sparkContext.defaultParallelism))}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_stream(spark: SparkSession, out: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 partitions: int | None = None):
    """Append results to the table at ``path``; ``partitions`` of the state: see :func:`with_rocksdb`."""
    w = out.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    with with_rocksdb(spark, partitions):
        q = w.start()
    if available_now:
        q.awaitTermination()
    return q
