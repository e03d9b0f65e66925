"""Raw records in and out: normalizing message-topic rows, and payloads for the four outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.sources import topics

UNKNOWN = "unknown"
HEADERS = ("domainId", "traceparent", "tracestate", "baggage")


def topic_options(cfg: dict) -> dict[str, str]:
    """Options of the message-topic reader; any start but ``latest`` is ``earliest``."""
    start = cfg.get("starting_offsets", "earliest")
    out = {"kafka.bootstrap.servers": cfg["servers"], "subscribe": cfg["topic"], "startingOffsets": "latest" if start == "latest" else "earliest", "includeHeaders": "true"}
    if cfg.get("group_id"):
        out["kafka.group.id"] = cfg["group_id"]
    if cfg.get("parallelism"):
        out["minPartitions"] = str(cfg["parallelism"])
    out["kafka.metadata.max.age.ms"] = str(cfg.get("discovery_ms", 60_000))
    return out


def read_raw(spark: SparkSession, cfg: dict, stream: bool = True) -> DataFrame:
    """Rows of a topic, of one kept as files (``format`` topic_files: path, topic, starting_offsets), or of any other format named in cfg (``format``, ``path``, ``schema``, ``options``)."""
    reader = spark.readStream if stream else spark.read
    fmt = cfg.get("format", "kafka")
    if fmt == topics.NAME:
        options = {"path": cfg["path"], "topic": cfg.get("topic", ""), "startingOffsets": cfg.get("starting_offsets", "earliest")} | cfg.get("options", {})
        return reader.format(topics.registered(spark)).options(**options).load()
    if fmt == "kafka":
        return reader.format(fmt).options(**topic_options(cfg)).load()
    reader = reader.format(fmt).options(**cfg.get("options", {}))
    if cfg.get("schema"):
        reader = reader.schema(cfg["schema"])
    return reader.load(cfg["path"]) if cfg.get("path") else reader.load()


def header(name: str, headers: str = "headers") -> Column:
    """The last header of a name as text; empty is null."""
    return F.nullif(F.expr(f"cast(try_element_at(filter({headers}, h -> h.key = '{name}'), -1).value as string)"), F.lit(""))


def normalize_raw(df: DataFrame) -> DataFrame:
    """value, headers, partition, offset, timestamp as raw records; rows without a value are dropped."""
    return df.where(F.col("value").isNotNull()).select(
        F.col("value").cast("string").alias("raw_value"),
        F.coalesce(header("domainId"), F.lit(UNKNOWN)).alias("domain_id"),
        *(header(h).alias(h) for h in HEADERS[1:]),
        F.col("timestamp").alias("broker_ts"),
        "partition",
        "offset",
    )


def with_traceparent(df: DataFrame, topic: str) -> DataFrame:
    """A blank traceparent becomes one made of where the record stands, so that replays agree."""
    at = F.concat_ws(":", F.lit(topic), F.col("partition").cast("string"), F.col("offset").cast("string"))
    made = F.concat(F.lit("00-"), F.md5(at), F.lit("-"), F.substring(F.md5(F.concat(at, F.lit(":span"))), 1, 16), F.lit("-01"))
    return df.withColumn("traceparent", F.when(F.length(F.trim(F.coalesce("traceparent", F.lit("")))) == 0, made).otherwise(F.col("traceparent")))


def _json(value: Column, kind: str) -> Column:
    return F.coalesce(value, F.lit(f'{{"kind":"{kind}","error":"serialize"}}'))


def _headers(**values: Column) -> Column:
    """Header list without those that are empty."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()])
    return F.filter(pairs, lambda h: F.coalesce(h["value"], F.lit("")) != "")


def to_value_records(df: DataFrame) -> DataFrame:
    """domain_id, out (array or null) and header columns as key, value, headers, timestamp."""
    value = F.coalesce(F.to_json("out"), F.lit("null"))
    head = _headers(traceparent=F.col("traceparent"), domainId=F.col("domain_id"), cepEntries=F.col("cep_entries"), duration=F.col("duration"))
    return df.select(F.col("domain_id").alias("key"), value.alias("value"), head.alias("headers"), F.when(F.col("broker_ts") >= F.lit("1970-01-01").cast("timestamp"), F.col("broker_ts")).alias("timestamp"))


def _failure(df: DataFrame, kind: str, body: dict[str, Column], heads: dict[str, Column]) -> DataFrame:
    value = F.to_json(F.struct(F.lit(kind).alias("kind"), *[c.alias(k) for k, c in body.items()]), {"ignoreNullFields": "false"})
    return df.select(F.col("domain_id").alias("key"), _json(value, kind).alias("value"), _headers(**heads).alias("headers"))


def to_error_records(df: DataFrame) -> DataFrame:
    c = F.col
    return _failure(df, "error", {"stage": c("stage"), "domainType": c("domain_type"), "domainId": c("domain_id"), "eventType": c("event_type"), "errors": c("errors"), "payload": c("payload")}, {"stage": c("stage"), "rawMessage": c("raw_value")})


def to_retry_records(df: DataFrame, kind: str = "retry") -> DataFrame:
    c, stage = F.col, F.coalesce("stage", F.lit(""))
    return _failure(df, kind, {"domainType": c("domain_type"), "domainId": c("domain_id"), "eventType": c("event_type"), "stageName": stage, "payload": c("payload")}, {"stageName": stage})


def to_mismatch_records(df: DataFrame) -> DataFrame:
    return to_retry_records(df, "mismatch")
