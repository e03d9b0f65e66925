"""The stateful flow as a stream: a change log for each key, a rule between reading and appending, and rows in order."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from keyflow.functions import trees
from keyflow.streaming.streams import write_routed

CHANGES = "array<struct<type: string, path: array<string>, value: string>>"
STAGE, TEXT = "ValueEnvelope.map", "Exception in map: ValueEnvelope/"
#: rule(row, state) gives what goes out and the changes (type, path, value) that it leaves; an exception is a failed row.
Rule = Callable[[dict, dict], tuple[object, list[tuple[str, list[str], object]]]]


def _checked(changes) -> list[tuple[str, list[str], object]]:
    """Changes of a rule, all or none: an unknown type, a path that is no list of names or a value that is no JSON fails the row."""
    out = []
    for kind, path, value in changes or ():
        if kind not in ("set", "append"):
            raise ValueError(f"unknown change {kind}")
        if not isinstance(path, (list, tuple)) or not all(isinstance(p, str) for p in path):
            raise ValueError("a path is a list of names")
        out.append((kind, list(path), json.loads(json.dumps(value))))
    return out


class ChangeLog(StatefulProcessor):
    """Per key: read the state, run the rule, give its outcome, and append its changes only if it succeeded.

    State variables: ``paths``, a map from each path to the number, type and value of what still counts of its changes,
    so it grows with the paths that are there and not with the rows (with ttl_ms a path that is not written again for so
    long is gone), and ``rows``, how many rows the key has had and how many failed. With idle_ms a processing-time timer
    takes all state of a key that has had no row for so long; each batch of the key puts it off.
    """

    def __init__(self, order: list[str], rule: Rule, ttl_ms: int | None, idle_ms: int | None):
        self.order, self.rule, self.ttl_ms, self.idle_ms = order, rule, ttl_ms, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.paths = handle.getMapState("paths", "path string", "number long, kind string, value string", self.ttl_ms)
        self.rows = handle.getValueState("rows", "seen long, failed long", None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = {tuple(json.loads(p[0])): (int(e[0]), e[1], json.loads(e[2])) for p, e in self.paths.iterator()}
        log, (seen, failed) = trees.Latest(kept), self.rows.get() if self.rows.exists() else (0, 0)
        batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        told = {c: [] for c in ("kind", "stage", "errors", "out", "state", "changes", "row_number")}
        for row in batch.astype(object).where(batch.notna(), None).to_dict("records"):
            state, row_errors, value, changes = trees.text(log.tree), None, None, []
            try:
                value, changes = self.rule(row, json.loads(state))
                value, changes = json.dumps(value, ensure_ascii=False), _checked(changes)
            except Exception as e:  # noqa: BLE001  any failure of a rule is an outcome of its row
                row_errors, value, changes, failed = [f"{TEXT}{e}"], None, [], failed + 1
            for change in changes:
                log.add(*change)
            seen += 1
            given = ("error" if row_errors else "value", STAGE if row_errors else None, row_errors or [], value, state, [{"type": t, "path": p, "value": json.dumps(v, ensure_ascii=False)} for t, p, v in changes], seen)
            for column, x in zip(told.values(), given, strict=True):
                column.append(x)
        name = lambda path: (json.dumps(path, ensure_ascii=False),)
        for path in log.gone:
            self.paths.removeKey(name(path))
        for path in log.changed:
            number, kind, value = log.entries[path]
            self.paths.updateValue(name(path), (number, kind, json.dumps(value, ensure_ascii=False)))
        self.rows.update((seen, failed))
        if self.idle_ms:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield batch.assign(**told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.paths.clear()
        self.rows.clear()
        return iter([])

    def close(self) -> None:
        pass


def with_log(df: DataFrame, key: str, order: list[str], rule: Rule, ttl_ms: int | None = None, idle_ms: int | None = None) -> DataFrame:
    """df, a stream, with kind (value or error), stage, errors, out (JSON text), state (as the rule saw it), changes and row_number.

    Rows of a key that come in one batch are put in order; later batches come later. A row sees the changes of all rows of
    its key before it whose rules succeeded. The added columns replace old ones of their names.
    """
    df = df.drop("kind", "stage", "errors", "out", "state", "changes", "row_number")
    out = T.StructType([*df.schema.fields, *T._parse_datatype_string(f"kind string, stage string, errors array<string>, out string, state string, changes {CHANGES}, row_number long").fields])
    mode = "ProcessingTime" if ttl_ms or idle_ms else "None"
    return df.groupBy(key).transformWithStateInPandas(statefulProcessor=ChangeLog(order, rule, ttl_ms, idle_ms), outputStructType=out, outputMode="Append", timeMode=mode)


def run_log_stream(source: DataFrame, key: str, order: list[str], before: Callable[[DataFrame], DataFrame], rule: Rule, sinks: dict[str, Callable[[DataFrame, int], None]], checkpoint: str, trigger: dict | None = None, ttl_ms: int | None = None, idle_ms: int | None = None) -> StreamingQuery:
    """The whole flow: before (parse, checks, lookups: DataFrame functions), state, rule and append per key, a sink for each kind."""
    return write_routed(with_log(before(source), key, order, rule, ttl_ms, idle_ms), sinks, checkpoint, trigger)


def log_of(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, row_number, idx, type, path, value) of what with_log() appended, as operators.folds takes them; value is a VARIANT."""
    each = rows.select(key, "row_number", F.posexplode("changes").alias("idx", "change"))
    return each.select(key, "row_number", "idx", "change.type", "change.path", F.parse_json("change.value").alias("value"))


class InSequence(StatefulProcessor):
    """Rows of a key leave by their number, however they come: those ahead of a gap wait in state until it is closed.

    wait_ms bounds the wait: when nothing could leave for so long, the gap is given up and what waits leaves in order. A
    number that has left already leaves at once, marked late, and a number that waits already is a repetition and goes.
    """

    def __init__(self, number: str, first: int, schema: T.StructType, wait_ms: int | None):
        self.number, self.first, self.schema, self.wait_ms = number, first, schema, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "number long")
        self.waiting = handle.getMapState("waiting", "number long", self.schema)

    def _leave(self, now: int | None, all_: bool) -> Iterator[pd.DataFrame]:
        """What can leave; with all_ gaps are passed over. Reads numbers first, then only the rows that leave."""
        due, numbers = self.next.get()[0] if self.next.exists() else self.first, sorted(int(k[0]) for k in self.waiting.keys())
        rows, left = [], len(numbers)
        for n in numbers:
            if n != due and not all_:
                break
            rows.append(tuple(self.waiting.getValue((n,))))
            self.waiting.removeKey((n,))
            due, left = n + 1, left - 1
        if rows:
            self.next.update((due,))
        if self.wait_ms and now is not None:
            timers = list(self.handle.listTimers())
            if rows or not left:
                for at in timers:
                    self.handle.deleteTimer(at)
                timers = []
            if left and not timers:
                self.handle.registerTimer(now + self.wait_ms)
        if rows:
            yield pd.DataFrame(rows, columns=self.schema.names).assign(late=False)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))
        due = self.next.get()[0] if self.next.exists() else self.first
        late = batch[batch[self.number] < due]
        if len(late):
            yield late.sort_values(self.number, kind="stable").assign(late=True)
        for row in batch[batch[self.number] >= due].astype(object).itertuples(index=False):
            values = tuple(None if x is None or x is pd.NaT or isinstance(x, float) and x != x else x for x in row)
            at = (int(values[self.schema.names.index(self.number)]),)
            if not self.waiting.containsKey(at):
                self.waiting.updateValue(at, values)
        yield from self._leave(timerValues.getCurrentProcessingTimeInMs() if self.wait_ms else None, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._leave(None, True)

    def close(self) -> None:
        pass


def in_sequence(df: DataFrame, key: str, number: str, first: int = 0, wait_ms: int | None = None) -> DataFrame:
    """df, a stream, with late: rows of each key in order of their number, from ``first``, without gaps. Rows without a number are left out."""
    df = df.where(F.col(number).isNotNull()).drop("late")
    out = T.StructType([*df.schema.fields, T.StructField("late", T.BooleanType())])
    return df.groupBy(key).transformWithStateInPandas(statefulProcessor=InSequence(number, first, df.schema, wait_ms), outputStructType=out, outputMode="Append", timeMode="ProcessingTime" if wait_ms else "None")


def split_late(df: DataFrame, ts: str, delay: str, on_time: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """A stream whose rows go to on_time, and those older than the watermark to late, instead of being dropped.

    The watermark of a batch is, as Spark's own, the latest time of all batches before it less the delay. The latest time
    of each batch is a table of one row below the checkpoint, by the batch's number, so a batch that is run again is split
    as before. Rows without a time are on time.
    """
    spark = df.sparkSession
    tops = f"{checkpoint.rstrip('/')}-tops"

    def put(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            seen = _tops(spark, tops, df.schema[ts].dataType).where(F.col("batch") < number).agg(F.max("top").alias("top")).first()["top"]
            batch.agg(F.max(ts).alias("top")).write.mode("overwrite").parquet(f"{tops}/batch={number}")
            is_late = F.coalesce(F.col(ts) < F.lit(seen).cast(df.schema[ts].dataType) - F.expr(f"interval {delay}"), F.lit(False)) if seen is not None else F.lit(False)
            on_time(batch.where(~is_late), number)
            late(batch.where(is_late), number)
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def _tops(spark, path: str, kind: T.DataType) -> DataFrame:
    schema = T.StructType([T.StructField("top", kind), T.StructField("batch", T.LongType())])
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def with_policy(spark, policy: str) -> None:
    """How watermarks of several sources meet: ``min``, the slowest decides (a quiet source holds all back), or ``max``, the fastest."""
    if policy not in ("min", "max"):
        raise ValueError("policy is min or max")
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)


