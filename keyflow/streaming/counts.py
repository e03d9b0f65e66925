"""Running counts of what sinks have written, over batches and restarts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyflow.streaming.streams import parquet_sink, write_routed

Sink = Callable[[DataFrame, int], None]


class Totals:
    """Total rows by kind, kept below a folder as one small file for each of the last two batches.

    A batch's file holds the totals up to it. A batch that is run again, after a failure or a restart, starts from those of
    the batch before it and replaces its own file, so no row is counted twice or lost.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.folder))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _read(self, number: int) -> dict[str, int]:
        at = self._fs.open(self._path(f"{self.folder}/{number}.json"))
        try:
            return json.loads(bytes(at.readAllBytes()).decode())
        finally:
            at.close()

    def before(self, number: int) -> dict[str, int]:
        earlier = [n for n in self._numbers() if n < number]
        return self._read(earlier[-1]) if earlier else {}

    def put(self, number: int, counts: dict[str, int]) -> None:
        total = self.before(number)
        for kind, n in counts.items():
            total[kind] = total.get(kind, 0) + n
        at, done = self._path(f"{self.folder}/_{number}"), self._path(f"{self.folder}/{number}.json")
        out = self._fs.create(at, True)
        out.write(bytearray(json.dumps(total).encode()))
        out.close()
        self._fs.delete(done, False)
        self._fs.rename(at, done)
        for old in [n for n in self._numbers() if n < number - 1]:
            self._fs.delete(self._path(f"{self.folder}/{old}.json"), False)

    def read(self) -> dict[str, int]:
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else {}


def counting(sinks: dict[str, Sink], totals: Totals) -> dict[str, Sink]:
    """Sinks that count what they write: the rows are observed on their way, so nothing is read or computed twice.

    A sink has to write what it is given, as its count is known when its own job has ended. Counts are put down when the
    last sink of a batch has written, before the batch is done.
    """
    seen: dict[int, dict[str, int]] = {}

    def counted(kind: str, sink: Sink) -> Sink:
        def put(part: DataFrame, number: int) -> None:
            rows = Observation()
            sink(part.observe(rows, F.count(F.lit(1)).alias("n")), number)
            counts = seen.setdefault(number, {})
            counts[kind] = rows.get["n"]
            if len(counts) == len(sinks):
                totals.put(number, seen.pop(number))

        return put

    return {kind: counted(kind, sink) for kind, sink in sinks.items()}


def write_counted(df: DataFrame, sinks: dict[str, Sink], checkpoint: str, totals: Totals, trigger: dict | None = None) -> StreamingQuery:
    """write_routed with running counts of all kinds."""
    return write_routed(df, counting(sinks, totals), checkpoint, trigger)


def copy_counted(df: DataFrame, path: str, checkpoint: str, totals: Totals, trigger: dict | None = None, kind: str = "copied") -> StreamingQuery:
    """Rows of a stream as they are, with their running count. A batch that is run again overwrites its own folder."""
    sink = counting({kind: parquet_sink(path)}, totals)[kind]
    return df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
