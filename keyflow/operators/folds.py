"""Folds over the whole log of a key, in order, made of partial states that are merged."""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from keyflow.functions import trees


@dataclass(frozen=True)
class Fold:
    """A fold whose state of a part of a log can be merged with that of the part behind it.

    start() is the state of no rows; step(state, row) takes a row as a dict; merge(a, b) is the state of a's rows and then
    b's, so merge has to be associative but need not commute; finish(state) is what is given out, as a string.
    """

    start: Callable[[], Any]
    step: Callable[[Any, dict], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], str | None]


def fold_log(log: DataFrame, key: str, order: list[str], fold: Fold, columns: list[str]) -> DataFrame:
    """(key, state): the fold over each key's rows in order.

    Rows are sorted by ranges of (key, order), so a key that holds a third of the log is folded by many tasks, each over
    its range; what meets in one task is a partial state for each range of the key. Rows of a null key are one key.
    Rows that are equal in key and order follow each other in any order. A task holds the state of one key at a time.
    """
    kind = log.schema[key].dataType
    arrow, named = to_arrow_type(kind), f"`{key}` {kind.simpleString()}"
    parts = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def over(batches: Iterator[pa.RecordBatch], take: Callable[[Any, dict], Any], give: Callable[[Any, Any], tuple], kinds: list, names: list[str]) -> Iterator[pa.RecordBatch]:
        """One row of give(key, state) for each run of rows with one key."""
        now, state, some, rows = None, None, False, []
        for batch in batches:
            for row in batch.to_pylist():
                if not some or row[key] != now:
                    if some:
                        rows.append(give(now, state))
                    now, state, some = row[key], None, True
                state = take(state, row)
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows = []
        if some:
            rows.append(give(now, state))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        take = lambda state, row: fold.step(fold.start() if state is None else state, row)
        return over(batches, take, lambda k, state: (k, part, pickle.dumps(state)), [arrow, pa.int32(), pa.binary()], [key, "__part", "__piece"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def take(state, row):
            piece = pickle.loads(row["__piece"])  # noqa: S301  written by partial()
            return piece if state is None else fold.merge(state, piece)

        return over(batches, take, lambda k, state: (k, fold.finish(state)), [arrow, pa.string()], [key, "state"])

    ranged = log.select(key, *[c for c in dict.fromkeys([*order, *columns]) if c != key]).repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
    pieces = ranged.mapInArrow(partial, f"{named}, __part int, __piece binary")
    return pieces.repartition(key).sortWithinPartitions(key, "__part").mapInArrow(merged, f"{named}, state string")


def _step(state: tuple, row: dict) -> tuple:
    return trees.then(state, trees.patch(row["type"], row["path"], json.loads(row["value"]).get("v"))) if row["path"] else state


#: The tree that a log of sets and appends leaves.
TREE = Fold(lambda: ("in", {}), _step, trees.then, lambda state: trees.text(trees.apply({}, state)))


def fold_tree(log: DataFrame, key: str, order: list[str], kind: str = "type", path: str = "path", value: str = "value") -> DataFrame:
    """(key, state): the tree, as JSON text with sorted names, that a log of (type set or append, path, value) leaves.

    value may be a VARIANT, so that a set can give a map or a list, or of any other type; a null value is a null in the
    tree. See ``functions.trees`` for what paths that stand above or below each other do.
    """
    rows = log.select(key, *[c for c in order if c != key], F.col(kind).alias("type"), F.col(path).alias("path"), F.to_json(F.struct(F.col(value).alias("v"))).alias("value"))
    return fold_log(rows, key, order, TREE, ["type", "path", "value"])


def tree_snapshot(log: DataFrame, key: str, order: list[str], start: str = "{}", **columns: str) -> DataFrame:
    """(key, state): as fold_tree, a VARIANT, over a state that each key starts with (JSON text of a map)."""
    first = json.loads(start)
    if not isinstance(first, dict):
        raise ValueError("a state is a map")
    fold = Fold(TREE.start, TREE.step, TREE.merge, lambda state: trees.text(trees.apply(json.loads(start), state)))
    rows = log.select(key, *[c for c in order if c != key], F.col(columns.get("kind", "type")).alias("type"), F.col(columns.get("path", "path")).alias("path"), F.to_json(F.struct(F.col(columns.get("value", "value")).alias("v"))).alias("value"))
    return fold_log(rows, key, order, fold, ["type", "path", "value"]).withColumn("state", F.parse_json("state"))
