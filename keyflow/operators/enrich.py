"""Enrichment: constants and left joins to lookups, in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.sources.lookups import message_key

BROADCAST_ROWS = 1_000_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it has few rows; larger tables are left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def enrich_fixed(df: DataFrame, out: str, value: Column | None) -> DataFrame:
    return df if value is None else df.withColumn(out, value)


def enrich_lookup(df: DataFrame, inputs: list[str], out: str, mapping: dict[str, str], sep: str = ".") -> DataFrame:
    """A mapping of the configuration; any null input leaves out null."""
    pairs = [x for kv in mapping.items() for x in map(F.lit, kv)]
    key = message_key([F.col(c).cast("string") for c in inputs], sep)
    return df.withColumn(out, F.try_element_at(F.create_map(*pairs), key)) if pairs else df.withColumn(out, F.lit(None).cast("string"))


def enrich_table(df: DataFrame, inputs: list[str], lookup: DataFrame, out: str, sep: str = ".", when: Column | None = None, small: bool | None = None) -> DataFrame:
    """Left join to a lookup (key, columns ...), whose columns become the struct ``out``; null where no row matches.

    ``when`` limits it to some rows. Keys of messages drop empty parts at the front; those of files do not.
    """
    columns = [c for c in lookup.columns if c != "key"]
    key = message_key([F.col(c).cast("string") for c in inputs], sep)
    key = F.when(when, key) if when is not None else key
    side = lookup.select(F.col("key").alias("__key"), F.struct(*columns).alias(out))
    side = F.broadcast(side) if small else side if small is False else sized(side)
    return df.withColumn("__in", key).join(side, F.col("__in") == F.col("__key"), "left").drop("__in", "__key")


def enrich_all(df: DataFrame, enrichers: list[tuple[list[list[str]], list[list[str]], Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Enrichers (needs, makes, function) in the order of what they need of each other."""
    left, made = list(enrichers), []
    while left:
        waiting = [tuple(p) for e in left for p in e[1]]
        ready = [e for e in left if not any(tuple(n[: len(w)]) == w for n in e[0] for w in waiting if w not in [tuple(p) for p in e[1]])]
        if not ready:
            raise ValueError("enrichers need each other: " + ", ".join(".".join(p) for e in left for p in e[1]))
        made += ready
        left = [e for e in left if e not in ready]
    for _, _, run in made:
        df = run(df)
    return df


def enrich_api(df: DataFrame, inputs: list[str], out: str, client: Callable[[], Callable[[str], tuple[int, str]]]) -> DataFrame:
    """Call a service once for each distinct key: 2xx gives JSON text, 204 and 404 none, others an error.

    client() is called once for each partition and returns a function from key to (status, body).
    """
    key = F.nullif(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in inputs]), F.lit(""))
    rows = df.withColumn("__key", key)

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()
        for batch in batches:
            said = [ask(k) for k in batch["__key"]]
            yield pd.DataFrame({"__key": batch["__key"], out: [b if 200 <= s < 300 and s != 204 else None for s, b in said], f"{out}_error": [None if 200 <= s < 300 or s == 404 else f"status {s}: {b[:200]}" for s, b in said]})

    answers = rows.select("__key").where("__key is not null").distinct().mapInPandas(call, f"__key string, {out} string, {out}_error string")
    return rows.join(answers, "__key", "left").drop("__key")
