"""A source for topics that are kept as files, with partitions and offsets as a broker has them.

A topic is a folder with a folder for each partition, which holds segments: files ``<first offset>-<offset behind>.jsonl``
with a record on each line, ``{"key", "value", "headers": [{"key", "value"}], "timestamp"}``, texts and milliseconds. A
segment is put there whole and never changed; old ones may be deleted. That is how topics are archived, and how one is
replayed where no broker is at hand. Rows have the columns of the broker's own reader, so what follows is the same.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "topic_files"
COLUMNS = "key binary, value binary, headers array<struct<key: string, value: binary>>, topic string, partition int, offset long, timestamp timestamp"
_ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("headers", pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())]))), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC"))])
_SEGMENT = re.compile(r"(\d+)-(\d+)\.jsonl")
BATCH = 1000


class DataLost(RuntimeError):
    """Offsets that were to be read are not there any more."""


@dataclass
class Span(InputPartition):
    """Offsets from first to last, without last, of one segment."""

    path: str
    partition: int
    at: int
    first: int
    last: int


class Topic:
    """The segments of a topic's folder, as they are now."""

    def __init__(self, options: dict):
        if not options.get("path"):
            raise ValueError(f"{NAME} needs a path")
        self.fs, self.path = fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] or options["path"].startswith("file:") else (fs.LocalFileSystem(), options["path"])
        self.name = options.get("topic") or self.path.rstrip("/").rpartition("/")[2]
        #: as for a broker's topic: any start but latest is earliest
        self.from_latest = options.get("startingoffsets") == "latest"
        self.rows = int(options.get("rowsperpartition", 100_000))
        self.strict = str(options.get("failondataloss", "true")).lower() != "false"

    def segments(self) -> dict[int, list[tuple[int, int, str]]]:
        """(first offset, offset behind, path) of each partition's segments, in order."""
        found: dict[int, list[tuple[int, int, str]]] = {}
        for info in self.fs.get_file_info(fs.FileSelector(self.path, recursive=True, allow_not_found=True)):
            parent, name = info.path.split("/")[-2:] if "/" in info.path else ("", info.path)
            match = _SEGMENT.fullmatch(name)
            if match and parent.isdigit() and info.type == fs.FileType.File:
                found.setdefault(int(parent), []).append((int(match[1]), int(match[2]), info.path))
        return {p: sorted(s) for p, s in sorted(found.items())}

    def earliest(self) -> dict[str, int]:
        return {str(p): s[0][0] for p, s in self.segments().items()}

    def latest(self) -> dict[str, int]:
        return {str(p): s[-1][1] for p, s in self.segments().items()}

    def spans(self, start: dict[str, int], end: dict[str, int]) -> list[Span]:
        """What has to be read from start to end, in spans of at most ``rows``; a partition that start does not know is new and read from its begin."""
        out, segments = [], self.segments()
        for p, last in sorted(end.items(), key=lambda x: int(x[0])):
            mine = segments.get(int(p), [])
            at = start.get(p, mine[0][0] if mine else last)
            for first, behind, path in mine:
                low, high = max(at, first), min(last, behind)
                if low >= high:
                    continue
                if low > at and self.strict:
                    raise DataLost(f"{self.name}, partition {p}: offsets {at} to {low - 1} are not there any more")
                out += [Span(path, int(p), first, x, min(x + self.rows, high)) for x in range(low, high, self.rows)]
                at = high
            if at < last and self.strict:
                raise DataLost(f"{self.name}, partition {p}: offsets {at} to {last - 1} are not there any more")
        return out

    def read(self, span: Span) -> Iterator[pa.RecordBatch]:
        rows = []
        with self.fs.open_input_stream(span.path) as raw:
            for offset, line in enumerate(_lines(raw), span.at):
                if offset >= span.last:
                    break
                if offset >= span.first:
                    rows.append(self._row(json.loads(line), span.partition, offset))
                if len(rows) == BATCH:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def _row(self, record: dict, partition: int, offset: int) -> dict:
        as_bytes = lambda x: None if x is None else x.encode()
        headers = [{"key": h["key"], "value": as_bytes(h.get("value"))} for h in record["headers"]] if record.get("headers") is not None else None
        moment = record.get("timestamp")
        return {"key": as_bytes(record.get("key")), "value": as_bytes(record.get("value")), "headers": headers, "topic": self.name, "partition": partition, "offset": offset, "timestamp": None if moment is None else moment * 1000}


def _lines(raw) -> Iterator[bytes]:
    """Lines of a stream, read in pieces: a segment is never held whole."""
    left = b""
    while piece := raw.read(1 << 20):
        *whole, left = (left + piece).split(b"\n")
        yield from whole
    if left:
        yield left


class _Batch(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Span]:
        topic = Topic(self.options)
        return topic.spans(topic.earliest(), topic.latest())

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return Topic(self.options).read(partition)


class _Stream(DataSourceStreamReader):
    """Offsets are a map from partition to the next offset; Spark keeps them in the checkpoint, so a restart goes on behind what was committed."""

    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:
        topic = Topic(self.options)
        return topic.latest() if topic.from_latest else topic.earliest()

    def latestOffset(self) -> dict:
        return Topic(self.options).latest()

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return Topic(self.options).spans(start, end)

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return Topic(self.options).read(partition)

    def commit(self, end: dict) -> None:
        pass


class TopicFiles(DataSource):
    """Options: path, topic (else the folder's name), startingOffsets (earliest or latest), rowsPerPartition, failOnDataLoss."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> DataSourceReader:
        return _Batch({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream({k.lower(): v for k, v in self.options.items()})


def registered(spark: SparkSession) -> str:
    """The name of the source's format, which the session knows from here on."""
    spark.dataSource.register(TopicFiles)
    return NAME
