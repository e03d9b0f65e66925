"""Structured Streaming: watermarks, routed sinks, and the stateful flow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from keyflow.operators.routing import KINDS, split
from keyflow.operators.tables import new_folder


def watermark(df: DataFrame, ts: str | None = None, delay: str | None = None, fn: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """None: no watermark. A delay bounds how late rows may be ('0 seconds': never). A function replaces both.

    Spark's watermark follows the latest row of all partitions, so a quiet partition never holds it back.
    """
    if fn:
        return df.transform(fn)
    return df.withWatermark(ts, delay) if ts and delay else df


def late_rows(df: DataFrame, ts: str, order: str, delay: str) -> DataFrame:
    """Rows of a bounded table that a watermark of this delay would find late.

    The order is cut into ranges, one a shuffle partition. Each range has its own running maximum; to that comes the
    greatest of the ranges before, from a table with one row a range. Rows are written once with their range, because
    ranges are cut by a sample that differs each time. A stream does the same in foreachBatch without a sort.
    """
    spark = df.sparkSession
    path = new_folder(spark, "late-rows")
    # a number of partitions that is given stays as it is; without one small ranges are put together
    ranged = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), order).withColumn("__range", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    tops = rows.groupBy("__range").agg(F.max(ts).alias("__top"))
    before = tops.select("__range", F.max("__top").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)).alias("__before"))
    inside = F.max(ts).over(W.partitionBy("__range").orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    seen = rows.withColumn("__inside", inside).join(F.broadcast(before), "__range")
    late = F.col(ts) < F.greatest("__inside", "__before") - F.expr(f"interval {delay}")
    return seen.where(late).select(df.columns)


def write_routed(df: DataFrame, sinks: dict[str, Callable[[DataFrame, int], None]], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Every batch is computed once and given to the sink of each kind with the batch's number, by which a sink can tell a repeated batch."""

    def put(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            for kind, part in split(batch).items():
                if kind in sinks:
                    sinks[kind](part, number)
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A batch overwrites its own folder, so a batch that is run again leaves its rows once."""
    return lambda part, number: part.write.mode("overwrite").parquet(f"{path}/batch={number}")


def copy_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stop_at_first(df: DataFrame, order: str, found: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Give the first mismatch to ``found``, once; the caller stops the query when it has been called."""
    state = {"done": False}

    def look(batch: DataFrame, _: int) -> None:
        if not state["done"]:
            hit = batch.where("mismatch").orderBy(order).limit(1)
            if hit.take(1):
                state["done"] = True
                found(hit)

    return df.writeStream.foreachBatch(look).option("checkpointLocation", checkpoint).start()


class LastValue(StatefulProcessor):
    """Gives each row the last value that earlier rows of its key had. Rows of a batch are put in order first.

    Rows arrive as pandas, where a NaN and a null are the same: both count as missing."""

    def __init__(self, order: str, column: str, kind: T.DataType, ttl_ms: int | None = None):
        self.order, self.column, self.kind, self.ttl_ms = order, column, kind, ttl_ms

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", T.StructType([T.StructField("value", self.kind)]), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        before = last
        batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        seen = []
        for value in batch[self.column]:
            seen.append(last)
            last = last if pd.isna(value) else value
        if last is not None and last != before:
            self.last.update((last,))
        yield batch.assign(**{f"state_{self.column}": seen})

    def close(self) -> None:
        pass


def stateful(df: DataFrame, key: str, order: str, column: str, ttl_ms: int | None = None) -> DataFrame:
    """The streaming form of running_state for one column."""
    kind = df.schema[column].dataType
    out = T.StructType([*df.schema.fields, T.StructField(f"state_{column}", kind)])
    return df.groupBy(key).transformWithStateInPandas(statefulProcessor=LastValue(order, column, kind, ttl_ms), outputStructType=out, outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")


def run_stream(source: DataFrame, key: str, order: str, column: str, before: Callable[[DataFrame], DataFrame], rule: Callable[[DataFrame], DataFrame], sinks: dict[str, Callable[[DataFrame, int], None]], checkpoint: str, trigger: dict | None = None, ttl_ms: int | None = None) -> StreamingQuery:
    """The whole flow as a stream: before (parse, checks, enrichment), the key's state, the rule, and a sink for each kind.

    before gives rows with key, order and column, the value that a row leaves behind (null: none), and rule sees it as
    state_<column>, as it was before the row, and adds ``kind``. Both are plain DataFrame functions; only the state itself
    goes through Python. A row's value is state for later rows even if its rule fails, so before has to give null for
    rows that may not leave one. With ttl_ms state expires by processing time; Spark then runs batches without rows as
    well, so such a stream is stopped by its owner, not by ``availableNow``.
    """
    return write_routed(rule(stateful(before(source), key, order, column, ttl_ms)), sinks, checkpoint, trigger)


def counted(df: DataFrame, name: str, kind: str = "kind") -> DataFrame:
    """df observed: each batch reports its rows by kind under a name."""
    return df.observe(name, *[F.count(F.when(F.col(kind) == k, 1)).alias(k) for k in KINDS])
