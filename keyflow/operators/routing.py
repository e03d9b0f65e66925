"""Kinds of results, errors, comparison with what was expected, and retries as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

KINDS = ("value", "error", "retry", "mismatch")


def split(df: DataFrame, kind: str = "kind") -> dict[str, DataFrame]:
    """df by kind; rows of an unknown kind are errors of stage ``splitter``."""
    known = df.withColumn("stage", F.when(F.col(kind).isin(*KINDS), F.col("stage") if "stage" in df.columns else F.lit(None)).otherwise(F.lit("splitter")))
    known = known.withColumn(kind, F.when(F.col(kind).isin(*KINDS), F.col(kind)).otherwise(F.lit("error")))
    return {k: known.where(F.col(kind) == k) for k in KINDS}


def failure_errors(causes: str) -> Column:
    """The first three causes, and dots behind three or more."""
    return F.concat(F.slice(causes, 1, 3), F.when(F.size(causes) >= 3, F.array(F.lit("..."))).otherwise(F.expr("cast(array() as array<string>)")))


def kind_by_time(duration: str, limit) -> Column:
    """retry where it took longer than the limit, else value."""
    return F.when(F.col(duration) > limit, "retry").otherwise("value")


def prefix_errors(errors: str, prefix: str) -> Column:
    return F.transform(errors, lambda e: F.concat(F.lit(prefix), e))


#: What a row that failed or waited too long keeps; its changes are emptied, so nothing of it reaches the state.
ENVELOPE = ["domain_id", "domain_type", "event_type", "data", "state"]
_NO_CHANGES = "cast(array() as array<struct<path: array<string>, value: string>>)"


def _failed(df: DataFrame, kind: str, keep: list[str], **more: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in {*keep, "changes", "kind", *more}]
    return df.select(*keep, *rest, F.lit(kind).alias("kind"), F.expr(_NO_CHANGES).alias("changes"), *[v.alias(k) for k, v in more.items()])


def to_error(df: DataFrame, stage: str, causes: str = "causes", keep: list[str] = ENVELOPE) -> DataFrame:
    """Rows with causes (texts "Class: message", outermost first) as error rows: header, data and state kept, changes emptied."""
    return _failed(df.where(F.size(causes) > 0), "error", keep, stage=F.lit(stage), errors=failure_errors(causes)).drop(causes)


def to_retry(df: DataFrame, limit, stage: str, duration: str = "duration", keep: list[str] = ENVELOPE) -> DataFrame:
    """Rows that took longer than the limit as retry rows with count 0: header, data and state kept, changes emptied."""
    return _failed(df.where(F.col(duration) > limit), "retry", keep, stage_name=F.lit(stage), retries=F.lit(0))


def all_errors(*found: Column) -> Column:
    """Errors (arrays, null: none) of several checks in one list."""
    return F.concat(*[F.coalesce(e, F.expr("cast(array() as array<string>)")) for e in found])


def when_good(errors: str, value: Column, otherwise: Column | None = None) -> Column:
    """value where there are no errors, else what recovers from them (null if nothing does)."""
    return F.when(F.size(errors) == 0, value).otherwise(F.lit(None) if otherwise is None else otherwise)


def mismatch_record(df: DataFrame, given: Column, state: Column, actual: Column, expected: Column) -> DataFrame:
    """df of compare() with mismatch_record where the projections differ: what went in, the state, both projections, both outputs."""
    c = F.col
    return df.withColumn("mismatch_record", F.when(c("mismatch"), F.struct(given.alias("input"), state.alias("cepState"), c("actual_projection").alias("actualProjection"), c("expected_projection").alias("expectedProjection"), actual.alias("actualOutput"), expected.alias("expectedOutput"))))


def compare(df: DataFrame, actual: Column, expected: Column) -> DataFrame:
    """df with actual_projection, expected_projection and mismatch; two nulls are equal."""
    out = df.withColumns({"actual_projection": actual, "expected_projection": expected})
    return out.withColumn("mismatch", ~F.col("actual_projection").eqNullSafe(F.col("expected_projection")))


def first_mismatch(df: DataFrame, order: list[str]) -> DataFrame:
    """The first mismatch; each task keeps one row."""
    return df.where("mismatch").orderBy(*order).limit(1)


def schedule_retries(df: DataFrame, stages: DataFrame, granularity: int) -> DataFrame:
    """df (topic, domain_id, acquired_ms, retries) with due_ms, bucket and give_up.

    stages: retry, timeout_ms, jitter_ms. The jitter is a hash, so that replays agree.
    """
    rows = df.join(F.broadcast(stages), df["retries"] == stages["retry"], "left").drop("retry")
    jitter = F.pmod(F.crc32(F.concat_ws(":", "topic", "domain_id", F.col("retries").cast("string"))), F.col("jitter_ms") + 1)
    due = F.col("acquired_ms") + F.col("timeout_ms") + jitter
    rows = rows.withColumns({"due_ms": due, "give_up": F.col("timeout_ms").isNull()})
    return rows.withColumn("bucket", F.floor(F.col("due_ms") / granularity) * granularity).drop("timeout_ms", "jitter_ms")


def dedupe_retries(df: DataFrame, arrival: str) -> DataFrame:
    """One entry for each topic and domain: the earliest bucket, of equal ones the first to arrive."""
    w = W.partitionBy("topic", "domain_id").orderBy("bucket", arrival)
    return df.where("not give_up").withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def retries_due(df: DataFrame, now_ms: int, granularity: int) -> DataFrame:
    """Entries up to the bucket of now."""
    return df.where(F.col("bucket") <= now_ms // granularity * granularity)


def dedupe_offsets(df: DataFrame, done: DataFrame, key: str = "domain_id", offset: str = "offset") -> DataFrame:
    """Offsets of a key that are not done yet, each once."""
    return df.dropDuplicates([key, offset]).join(done, [key, offset], "left_anti")


def backlog(df: DataFrame, key: str = "domain_id", offset: str = "offset") -> DataFrame:
    """df with place (0: in flight) in its key's queue."""
    return df.withColumn("place", (F.row_number().over(W.partitionBy(key).orderBy(offset)) - 1).cast("long"))


def retry_counts(df: DataFrame, arrival: str, now_ms: int, granularity: int) -> DataFrame:
    """Counts of scheduled retries: given_up, added, earlier_exists (a bucket before or like it is already held), moved
    (into an earlier bucket than held) and removed (due at now and held).

    Of a topic and domain one entry is held at a time: rows are seen in order of arrival, and the bucket that is held
    before a row is the least of those before it.
    """
    w = W.partitionBy("topic", "domain_id").orderBy(arrival)
    stays, held = ~F.col("give_up"), F.col("__held")
    rows = df.withColumn("bucket", F.when(stays, F.col("bucket"))).withColumn("__held", F.min("bucket").over(w.rowsBetween(W.unboundedPreceding, -1)))
    n = lambda cond, name: F.count(F.when(cond, 1)).alias(name)
    each = rows.groupBy("topic", "domain_id").agg(n(~stays, "given_up"), n(stays & held.isNull(), "added"), n(held <= F.col("bucket"), "earlier_exists"), n(held > F.col("bucket"), "moved"), F.min("bucket").alias("held"))
    each = each.withColumn("removed", F.when(F.col("held") <= now_ms // granularity * granularity, 1).otherwise(0))
    return each.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("given_up", "added", "earlier_exists", "moved", "removed")])


def retries_by_stage(df: DataFrame) -> DataFrame:
    """Scheduled retries of each stage."""
    return df.where("not give_up").groupBy("retries").agg(F.count(F.lit(1)).alias("n"))
