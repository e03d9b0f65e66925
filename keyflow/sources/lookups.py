"""Lookup tables from delimited files."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LookupUnreadable(ValueError):
    """A lookup whose file is not there, not allowed to be read, or on a file system that is not installed."""


def sas(account: str, token: str) -> dict[str, str]:
    """Options for a blob store's account that is read with a shared access signature."""
    host = f"{account}.dfs.core.windows.net"
    return {f"fs.azure.account.auth.type.{host}": "SAS", f"fs.azure.sas.fixed.token.{host}": token.lstrip("?")}


def bearer(account: str, secret: str, client: str = "", endpoint: str = "") -> dict[str, str]:
    """Options for a blob store's account that is read with bearer tokens, which a client's secret gets from an endpoint."""
    host = f"{account}.dfs.core.windows.net"
    oauth = {"auth.type": "OAuth", "oauth.provider.type": "org.apache.hadoop.fs.azurebfs.oauth2.ClientCredsTokenProvider", "oauth2.client.id": client, "oauth2.client.secret": secret, "oauth2.client.endpoint": endpoint}
    return {f"fs.azure.account.{k}.{host}": v for k, v in oauth.items()}


def load_lookup(spark: SparkSession, path: str, in_cols: list[str], out_cols: list[str], sep: str = ",", key_sep: str = ".", auth: dict[str, str] | None = None) -> DataFrame:
    """Rows (key, out columns ...) of a CSV file with a header, on any file system that Spark reads.

    auth: options of the file system, as sas() and bearer() give them. They go with this file's reads and never into the
    session or an error's text. A file that cannot be read is a LookupUnreadable, here and not when rows are asked for.
    Repeated or unknown columns are errors. Of rows with equal keys the last in the file wins. Short rows have nulls.
    """
    reader = lambda: spark.read.options(**(auth or {}))
    try:
        head = reader().text(path).limit(1).first()
    except (AnalysisException, Py4JJavaError, PySparkException) as e:
        why = str(e).splitlines()[0] if str(e) else type(e).__name__
        for secret in (auth or {}).values():
            why = why.replace(secret, "***") if secret else why
        raise LookupUnreadable(f"cannot read the lookup {path}: {why}") from None
    if head is None:
        raise ValueError(f"{path} has no header")
    names = [x.strip().strip('"') for x in head[0].lstrip("﻿").split(sep)]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns that occur twice: {', '.join(twice)}")
    unknown = [c for c in [*in_cols, *out_cols] if c not in names]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}; there are {', '.join(names)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = reader().schema(schema).csv(path, header=True, sep=sep, quote='"', escape='"', enforceSchema=True)
    # file, block and order of reading give a row's place, whatever task reads it
    rows = rows.select("*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("__at"))
    return last_wins(rows.withColumn("key", composite_key([F.coalesce(F.col(c), F.lit("")) for c in in_cols], key_sep)), ["key"], "__at", out_cols)


def last_wins(rows: DataFrame, keys: list[str], order: str, out_cols: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*out_cols), F.col(order)).alias("__out")).select(*keys, *[F.col(f"__out.{c}") for c in out_cols])


def composite_key(parts: list[Column], sep: str = ".") -> Column:
    """Parts joined; null if any is."""
    ok = F.lit(True)
    for p in parts:
        ok = ok & p.isNotNull()
    return F.when(ok, F.concat_ws(sep, *parts))


def message_key(parts: list[Column], sep: str = ".") -> Column:
    """As composite_key, but empty parts at the front leave no separator behind, as messages' keys are built."""
    return F.regexp_replace(composite_key(parts, sep), "^(" + "".join("\\" + c for c in sep) + ")+", "")


def lookup_values(keys: DataFrame, lookup: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """keys with values, the ordered list of output values; empty where no row matches."""
    return keys.join(lookup.select(F.col(key).alias(key), F.array(value).alias("values")), key, "left").withColumn("values", F.coalesce("values", F.expr("cast(array() as array<string>)")))


def available_lookups(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the .csv files of a folder."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select(F.regexp_extract("path", r"([^/]+)\.csv$", 1).alias("name"))
    return names.distinct().orderBy("name")
