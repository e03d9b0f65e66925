"""Registries: what a configuration names by type, and what users add to it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Functions from (DataFrame, configuration) to DataFrame by the type that a configuration names.
ENRICHERS: dict[str, Callable[[DataFrame, dict], DataFrame]] = {}


def enricher(kind: str, registry: dict | None = None):
    """Register a function as the enricher of a type; a type that is taken is an error."""
    into = ENRICHERS if registry is None else registry

    def keep(fn):
        if kind in into:
            raise ValueError(f"enricher {kind} is registered already")
        into[kind] = fn
        return fn

    return keep


def run_enrichers(df: DataFrame, configs: list[dict], registry: dict | None = None, event: str = "event_type") -> DataFrame:
    """df after the enricher of each configuration (type, out, event, scope ...), in order.

    scope ``event`` (default) leaves other events' rows with a null in ``out``; scope ``all`` enriches every row, whatever
    event the configuration stands under. Rows are never split: the same plan serves both.
    """
    known = ENRICHERS if registry is None else registry
    unknown = sorted({c["type"] for c in configs} - set(known))
    if unknown:
        raise ValueError(f"unknown types {', '.join(unknown)}; known: {', '.join(sorted(known))}")
    for c in configs:
        df = known[c["type"]](df, c)
        if c.get("event") is not None and c.get("scope", "event") == "event":
            df = df.withColumn(c["out"], F.when(F.col(event) == c["event"], F.col(c["out"])))
    return df


def apply_aspect(df: DataFrame, kind: str, registry: dict[str, Column], out: str, errors: str = "errors") -> DataFrame:
    """df with ``out``: the registered expression of the type in a row's column ``kind``.

    Rows without a type pass with null. An unknown type is an error that names the known ones.
    """
    value = F.lit(None)
    for name, column in registry.items():
        value = F.when(F.col(kind) == name, column).otherwise(value)
    bad = F.col(kind).isNotNull() & ~F.col(kind).isin(list(registry))
    text = F.concat(F.lit("unknown type "), F.col(kind), F.lit(f"; known: {', '.join(sorted(registry))}"))
    before = F.col(errors) if errors in df.columns else F.expr("cast(array() as array<string>)")
    return df.withColumns({out: value, errors: F.concat(before, F.when(bad, F.array(text)).otherwise(F.expr("cast(array() as array<string>)")))})


def fold_state(log: DataFrame, key: str, order: list[str], path: str, value: str, start: Column, step: Callable[[Column, Column], Column]) -> DataFrame:
    """(key, state): a user's fold over the latest value of each path of a key, oldest first, by Spark's own ``aggregate``.

    The log is compacted before it is folded, by maxima that combine before the shuffle, so a key's row has as many
    entries as it has paths, however long its log.
    """
    last = log.groupBy(key, path).agg(F.max(F.struct(*order, F.col(value).alias("__v"))).alias("__last"))
    kept = last.groupBy(key).agg(F.array_sort(F.collect_list("__last")).alias("__log"))
    return kept.select(key, F.aggregate("__log", start, lambda acc, x: step(acc, x["__v"])).alias("state"))
