"""Configuration as tables: behaviour files, permutations of parameters, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASPECTS = ("validation", "transformation", "enrichment", "bizlogic")
_EVENT = "struct<" + ", ".join(f"{a}: map<string, string>" for a in ASPECTS) + ">"


def load_config(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (param_key, event_type, aspect, module, type, body) of all JSON files of a folder tree; unreadable files have error.

    The path below the folder, without .json, is the param_key with ':' between its parts.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    rel = F.regexp_replace(F.regexp_extract(F.col("_metadata.file_path"), f"{folder.rstrip('/').rsplit('/', 1)[-1]}/(.*)\\.json$", 1), "/", ":")
    return flatten_config(files.select(rel.alias("param_key"), F.from_json("value", f"events map<string, {_EVENT}>").alias("config")))


def flatten_config(df: DataFrame) -> DataFrame:
    """df (param_key, config) as one row for each aspect."""
    events = df.select("param_key", F.explode_outer("config.events").alias("event_type", "e"))
    entries = F.expr("concat(" + ", ".join(f"transform(coalesce(map_entries(e.{a}), array()), x -> named_struct('aspect', '{a}', 'module', x.key, 'body', x.value))" for a in ASPECTS) + ")")
    rows = events.select("param_key", "event_type", F.explode_outer(entries).alias("x"))
    return rows.select("param_key", "event_type", "x.aspect", "x.module", F.get_json_object("x.body", "$.type").alias("type"), "x.body", F.when(F.col("event_type").isNull(), F.lit("unreadable or empty")).alias("error"))


def override_rules(df: DataFrame) -> DataFrame:
    """Rows of flatten_config with only bizlogic aspects."""
    return df.where("aspect = 'bizlogic'")


_MODULES = "map<string, map<string, string>>"


def override_payload(df: DataFrame, payload: str = "payload", root: str = "root") -> DataFrame:
    """Rows (param_key, event_type, module, type, cel, rule_key, root, projection) of payloads that replace deployed rules.

    A payload is the JSON ``{"celProjection": ..., "config": {param_key: {"events": {event: {aspect: {module: {...}}}}}}}``.
    Only the aspect bizlogic counts; events and keys without it give no row. Where payloads, in order of column
    ``at``, have the same key, the latest one's rules stand, all of them. A payload that is no JSON or has no config has one row with error.
    """
    read = F.from_json(payload, f"struct<celProjection: string, config: map<string, struct<events: map<string, {_MODULES}>>>>")
    rows = df.select("at", F.col(root).alias("root"), read.alias("p"))
    bad = rows.where("p.config is null").select("at", F.lit("payload without a config").alias("error"))
    keys = rows.select("at", "root", F.col("p.celProjection").alias("projection"), F.explode("p.config").alias("param_key", "c"))
    some = F.exists(F.map_values("c.events"), lambda e: F.size(F.coalesce(F.try_element_at(e, F.lit("bizlogic")), F.expr("cast(map() as map<string, string>)"))) > 0)
    keys = keys.where(F.coalesce(some, F.lit(False)))
    last = keys.groupBy("param_key").agg(F.max("at").alias("at"))
    events = keys.join(last, ["param_key", "at"]).select("param_key", "root", "projection", F.explode("c.events").alias("event_type", "e"))
    modules = events.select("param_key", "root", "projection", "event_type", F.explode(F.try_element_at("e", F.lit("bizlogic"))).alias("module", "body"))
    out = modules.select("param_key", "event_type", "module", F.get_json_object("body", "$.type").alias("type"), F.get_json_object("body", "$.cel").alias("cel"), F.concat_ws("::", "param_key", F.concat_ws(":", "module", F.lit("bizlogic"), "event_type")).alias("rule_key"), "root", "projection", F.lit(None).cast("string").alias("error"))
    return out.unionByName(bad.drop("at"), allowMissingColumns=True)


def module_names(df: DataFrame) -> DataFrame:
    """Sorted distinct modules of bizlogic, validation and transformation."""
    parts = [df.where(F.col("aspect") == a).select("module") for a in ("bizlogic", "validation", "transformation")]
    return reduce(DataFrame.union, parts).distinct().orderBy("module")


def schema_names(df: DataFrame, name: str) -> DataFrame:
    """Distinct trimmed names, each with an error if blank."""
    return df.select(F.trim(name).alias("name")).distinct().withColumn("error", F.when(F.coalesce("name", F.lit("")) == "", F.lit("blank schema name")))


def permutations(dims: list[DataFrame]) -> DataFrame:
    """param_key for each combination of one value of each dimension (single columns); the sizes' product is the size."""
    named = [d.select(d.columns[0]).toDF(f"v{i}") for i, d in enumerate(dims)]
    return reduce(lambda a, b: a.crossJoin(b), named).select(F.concat_ws(":", *[f"v{i}" for i in range(len(named))]).alias("param_key"))


def missing_configs(wanted: DataFrame, there: DataFrame) -> DataFrame:
    return wanted.join(there, "param_key", "left_anti")


def duplicate_configs(there: DataFrame) -> DataFrame:
    """(param_key, event_type, aspect, module, n) of what is configured more than once."""
    return there.groupBy("param_key", "event_type", "aspect", "module").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def root_errors(df: DataFrame) -> DataFrame:
    """Rows (name, error) of root configurations (name, path, parameters array): no schema path, no parameters."""
    found = F.array(F.when(F.trim(F.coalesce("path", F.lit(""))) == "", "no schema path"), F.when(F.coalesce(F.size("parameters"), F.lit(0)) <= 0, "no parameters"))
    return df.select("name", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("error"))


def config_errors(df: DataFrame) -> DataFrame:
    """Rows (name, at, error) of parameters (name, legal array, default_value)."""
    blank = F.exists("legal", lambda v: F.trim(v) == "")
    found = F.array(F.when(F.size("legal") == 0, "no legal values"), F.when(blank, "blank legal value"), F.when(F.col("default_value").isNull(), "no default"), F.when(~F.array_contains("legal", F.col("default_value")), "default is not legal"))
    return df.select("name", F.posexplode(F.filter(found, lambda x: x.isNotNull())).alias("at", "error"))
