"""Keyed, ordered state: an append-only change log and what follows from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


def append_log(df: DataFrame, key: str, order: list[str], changes: str = "changes") -> DataFrame:
    """Rows (key, seq, idx, change) of batches in order; null batches and entries leave nothing behind."""
    numbered = with_log_seq(df.where(F.size(F.coalesce(changes, F.array())) > 0), key, order)
    return numbered.select(key, "seq", F.posexplode(changes).alias("idx", "change")).where("change is not null")


def with_log_seq(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """df with seq, the number of the batch in its key: 0, 1, 2 ..."""
    return df.withColumn("seq", (F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1).cast("long"))


def fold_set(log: DataFrame, key: str, order: list[str], path: str = "path", value: str = "value") -> DataFrame:
    """(key, path, value) with the last set of each path; partial maxima meet in the shuffle, no group is collected.

    A path is a name or an array of names. With arrays a set replaces what stands below its path, and a set below a path
    makes a tree of what stood there: each path is joined by its prefixes, and of two that exclude each other the later
    set stays. Null and empty paths are ignored.
    """
    if not isinstance(log.schema[path].dataType, T.ArrayType):
        return log.groupBy(key, path).agg(F.max_by(value, F.struct(*order)).alias(value))
    last = log.where(F.size(path) > 0).groupBy(key, path).agg(F.max_by(value, F.struct(*order)).alias(value), F.max(F.struct(*order)).alias("__at"))
    inner = last.select(F.col(key).alias("__key"), F.col(path).alias("__inner"), F.col("__at").alias("__in"), F.explode(F.expr(f"transform(filter(sequence(0, size({path})), i -> i > 0 and i < size({path})), i -> slice({path}, 1, i))")).alias("__outer"))
    both = inner.join(last, F.col("__key").eqNullSafe(F.col(key)) & (F.col("__outer") == F.col(path)))
    gone = both.select("__key", F.when(F.col("__in") > F.col("__at"), F.col("__outer")).otherwise(F.col("__inner")).alias("__gone")).distinct()
    return last.join(gone, F.col(key).eqNullSafe(F.col("__key")) & (F.col(path) == F.col("__gone")), "left_anti").drop("__at")


def fold_append(log: DataFrame, key: str, order: list[str], path: str = "path", value: str = "value", strict: bool = False) -> DataFrame:
    """(key, path, items): what sets and appends leave of each path. A set starts anew with its value alone; an append to
    a value that is no list replaces it, or with ``strict`` marks an error. log has ``type`` set or append."""
    w = W.partitionBy(key, path).orderBy(*order)
    part = log.withColumn("__sets", F.count(F.when(F.col("type") == "set", 1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    last = part.groupBy(key, path, "__sets").agg(
        F.sort_array(F.collect_list(F.when(F.col("type") == "append", F.struct(*order, F.col(value).alias("__v"))))).alias("added"),
        F.max(F.when(F.col("type") == "set", F.col(value))).alias("set"),
    )
    last = last.withColumn("__top", F.max("__sets").over(W.partitionBy(key, path))).where("__sets = __top")
    items = F.when(F.size("added") > 0, F.transform("added", lambda x: x["__v"])).otherwise(F.array("set"))
    out = last.select(key, path, items.alias("items"), ((F.size("added") > 0) & F.col("set").isNotNull()).alias("error"))
    return out if strict else out.drop("error")


def running_state(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """df with state_<column>: the last value that earlier rows of the key have."""
    w = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumns({f"state_{c}": F.last(c, ignorenulls=True).over(w) for c in columns})


def sticky(df: DataFrame, key: str, order: list[str], column: str) -> DataFrame:
    """df with sticky_<column>: the row's own value, or else the last that earlier rows of the key have."""
    return df.withColumn(f"sticky_{column}", F.last(column, ignorenulls=True).over(W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def ring_log(df: DataFrame, key: str, order: list[str], value: str, n: int = 6) -> DataFrame:
    """df with ring, the values of the last n earlier rows, oldest first."""
    return df.withColumn("ring", F.collect_list(value).over(W.partitionBy(key).orderBy(*order).rowsBetween(-n, -1)))


def state_snapshot(log: DataFrame, key: str, order: list[str], paths: dict[str, str]) -> DataFrame:
    """A row for each key with a column for each path: its last value or the path's default."""
    last = [F.coalesce(F.max_by("value", F.when(F.col("path") == p, F.struct(*order))), F.lit(d)).alias(p) for p, d in paths.items()]
    return log.groupBy(key).agg(*last)


def with_log_size(df: DataFrame, key: str, order: list[str], changes: str) -> DataFrame:
    """df with own_entries and log_entries, those of the key so far."""
    own = F.coalesce(F.size(changes), F.lit(0)).cast("long")
    return df.withColumn("own_entries", own).withColumn("log_entries", F.sum("own_entries").over(W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def order_by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of a key in one partition and in order."""
    return df.repartition(key).sortWithinPartitions(key, *order)
