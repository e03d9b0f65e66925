"""Counts, latencies and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

NAME = r"^[A-Za-z0-9_.-]{1,120}$"


def outcome_counts(df: DataFrame, kind: str = "kind") -> DataFrame:
    """Rows by kind, and their total under ``total``."""
    return df.rollup(kind).agg(F.count(F.lit(1)).alias("n"), F.grouping(kind).alias("__all")).select(F.when(F.col("__all") == 1, "total").otherwise(F.col(kind)).alias(kind), "n")


def latency_quantiles(df: DataFrame, by: str, latency: str) -> DataFrame:
    """Exact p50, p95 and p99 of latencies, of which negative ones count as 0."""
    x = F.greatest(F.lit(0.0), F.col(latency))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[F.percentile(x, p / 100).alias(f"p{p}") for p in (50, 95, 99)])


def last_n(df: DataFrame, by: str, order: str, n: int = 2048) -> DataFrame:
    """The latest n rows of each group; Spark cuts groups to n in each task before they are shuffled."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(by).orderBy(F.col(order).desc()))).where(F.col("__n") <= n).drop("__n")


def rate(df: DataFrame, ts: str, by: str, seconds: int = 60, slide: int | None = None) -> DataFrame:
    """Rows a second in windows."""
    w = F.window(ts, f"{seconds} seconds", f"{slide or seconds} seconds")
    return df.groupBy(w.alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n", (F.col("n") / seconds).alias("rate"))


KINDS = ("value", "error", "retry", "mismatch")


def running_totals(each: DataFrame, start: str, columns: list[str], prefix: str = "total_") -> DataFrame:
    """each with running totals in order of a time: within days, plus those of the days before, of which there is one row each.

    So no task has more than the rows of a day, or the days.
    """
    day = F.date_trunc("day", start)
    days = each.groupBy(day.alias("__day")).agg(*[F.sum(c).alias(f"__{c}") for c in columns])
    earlier = W.orderBy("__day").rowsBetween(W.unboundedPreceding, -1)
    days = days.select("__day", *[F.coalesce(F.sum(f"__{c}").over(earlier), F.lit(0)).alias(f"__{c}") for c in columns])
    inside = W.partitionBy("__day").orderBy(start).rowsBetween(W.unboundedPreceding, 0)
    rows = each.withColumn("__day", day).join(F.broadcast(days), "__day")  # a row a day
    return rows.withColumns({f"{prefix}{c}": F.sum(c).over(inside) + F.col(f"__{c}") for c in columns}).drop("__day", *[f"__{c}" for c in columns])


def perf_windows(df: DataFrame, ts: str, kind: str, seconds: int) -> DataFrame:
    """Per window of a length: counts by kind, running totals, rate of all kinds, and error and mismatch shares (0 where empty)."""
    each = df.groupBy(F.window(ts, f"{seconds} seconds").alias("w")).agg(*[F.count(F.when(F.col(kind) == k, 1)).alias(k) for k in KINDS])
    each = each.select(F.col("w.start").alias("start"), *KINDS)
    share = lambda a: F.coalesce(F.try_divide(F.col(f"total_{a}"), F.col("total_value") + F.col(f"total_{a}")), F.lit(0.0))
    out = running_totals(each, "start", list(KINDS))
    return out.withColumns({"rate": sum(F.col(k) for k in KINDS) / seconds, "error_share": share("error"), "mismatch_share": share("mismatch")})


def perf_report(df: DataFrame, ts: str, kind: str, seconds: int, since: Column | None = None) -> DataFrame:
    """perf_windows() as reports at the end of each window: what was added since the report before (delta_*), the rate of
    all kinds since the job began, and the seconds since the first report that has a value (elapsed, 0 before).

    since: when the job began; else the start of the first window.
    """
    out = perf_windows(df, ts, kind, seconds)
    lowest = out.agg(F.min("start").alias("__first"), F.min(F.when(F.col("value") > 0, F.col("start"))).alias("__valued"))
    epoch = lambda c: F.unix_timestamp(c.cast("timestamp"))
    out = out.join(F.broadcast(lowest))  # one row
    began = since if since is not None else F.col("__first")
    took = F.greatest(epoch(F.col("start")) + seconds - epoch(began), F.lit(1))
    elapsed = F.greatest(F.coalesce(epoch(F.col("start")) - epoch(F.col("__valued")), F.lit(0)), F.lit(0)).cast("long")
    return out.withColumns({f"delta_{k}": F.col(k) for k in KINDS} | {"elapsed": elapsed, "overall_rate": sum(F.col(f"total_{k}") for k in KINDS) / took}).drop("__first", "__valued")


def throughput(df: DataFrame, ts: str, seconds: int = 2) -> DataFrame:
    each = df.groupBy(F.window(ts, f"{seconds} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n")
    return running_totals(each, "start", ["n"], "__total_").withColumnRenamed("__total_n", "total")


def latency_sketches(df: DataFrame, by: list[str], latency: str, k: int = 200) -> DataFrame:
    """Rows (by, n, sketch): a sketch of quantiles, of bounded size, for each group of latencies, of which negative ones count as 0.

    Sketches of windows or parts can be stored and merged later (``merged_quantiles``); each combines before the shuffle,
    so a group of any size has one small row a task. The error is one of rank: RANK_ERROR for k = 200, less for larger k.
    """
    x = F.greatest(F.lit(0.0), F.col(latency))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(x, k).alias("sketch"))


#: By how much the rank of a sketch's quantile may be off, as a share of all rows, with k = 200 and 99 % confidence.
RANK_ERROR = 0.0265


def merged_quantiles(sketches: DataFrame, by: list[str], quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """(by, n, p50 ...) of latency_sketches() merged over whatever else they were grouped by."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(*by, "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(f"p{round(100 * q)}") for q in quantiles])


def quantile_summary(df: DataFrame, quantile: str, value: str) -> DataFrame:
    """Average and largest value of each quantile over subtasks."""
    return df.groupBy(quantile).agg(F.avg(value).alias("avg"), F.max(value).alias("max"))


def name_fits(name: str) -> Column:
    return F.col(name).rlike(NAME)


def check_metric_names(df: DataFrame, name: str, seen: str, n: int) -> DataFrame:
    """Distinct names by when they were first seen, with accepted: a legal name among the first n legal ones."""
    first = df.groupBy(name).agg(F.min(seen).alias("first_seen")).withColumn("legal", name_fits(name))
    w = W.partitionBy("legal").orderBy("first_seen", name)  # distinct names only
    return first.withColumn("accepted", F.col("legal") & (F.row_number().over(w) <= n))
