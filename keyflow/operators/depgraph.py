"""Dependency graph over producers of paths. Nodes: label, owns and requires (arrays of paths, a path an array of names)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from keyflow.operators.tables import new_folder, stored


def _owned(nodes: DataFrame) -> DataFrame:
    return nodes.select("label", F.explode("owns").alias("path"))


def _prefix(a: str, b: str) -> Column:
    return F.slice(F.col(b), 1, F.size(a)) == F.col(a)


def duplicate_producers(nodes: DataFrame) -> DataFrame:
    """(path, first, second): paths that two nodes own; the first by label, and each later one."""
    w = W.partitionBy("path").orderBy("label")
    return _owned(nodes).select("path", F.first("label").over(w).alias("first"), F.col("label").alias("second"), F.row_number().over(w).alias("n")).where("n > 1").drop("n")


def overlapping_producers(nodes: DataFrame) -> DataFrame:
    """(outer, inner, outer_label, inner_label): a path that is a proper prefix of another.

    Each path is joined by its prefixes, so this is an equi-join however many paths there are.
    """
    own = _owned(nodes)
    inner = own.select(F.col("label").alias("inner_label"), F.col("path").alias("inner"), F.explode(F.expr("transform(filter(sequence(0, size(path)), i -> i > 0 and i < size(path)), i -> slice(path, 1, i))")).alias("path"))
    return inner.join(own.withColumnRenamed("label", "outer_label"), "path").select(F.col("path").alias("outer"), "inner", "outer_label", "inner_label")


def derive_edges(nodes: DataFrame) -> DataFrame:
    """Distinct (producer, consumer): each required path's deepest owner among its prefixes; a node does not need itself."""
    need = nodes.select(F.col("label").alias("consumer"), F.explode("requires").alias("need"))
    steps = need.select("consumer", "need", F.explode(F.expr("transform(sequence(1, size(need)), i -> slice(need, 1, i))")).alias("path"))
    found = steps.join(_owned(nodes).withColumnRenamed("label", "producer"), "path")
    w = W.partitionBy("consumer", "need").orderBy(F.size("path").desc(), F.col("path").desc(), "producer")
    nearest = found.withColumn("n", F.row_number().over(w)).where("n = 1")
    return nearest.where("producer <> consumer").select("producer", "consumer").distinct()


def topo_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(label, level): 0 for nodes that need none, else one more than the highest needed. A cycle is an error that names its nodes.

    Each level is a table of the nodes not yet placed and how many of their producers are missing; those without a missing
    one are placed and taken off the others. A level reads the table before it and the edges, which are written once.
    """
    folder = new_folder(nodes.sparkSession, "levels")
    labels = nodes.select("label").distinct()
    links = edges.join(labels.withColumnRenamed("label", "producer"), "producer", "left_semi").select("producer", "consumer").distinct()
    links = stored(links, f"{folder}/edges")
    need = links.groupBy(F.col("consumer").alias("label")).agg(F.count(F.lit(1)).alias("missing"))
    rows, level = stored(labels.join(need, "label", "left").select("label", F.coalesce("missing", F.lit(0)).alias("missing")), f"{folder}/nodes/level=0"), 0
    while rows.where("missing > 0").take(1):
        placed = rows.where("missing = 0").select(F.col("label").alias("producer"))
        if not placed.take(1):
            raise ValueError("cycle among " + ", ".join(r[0] for r in rows.orderBy("label").limit(50).collect()))
        came = links.join(placed, "producer").groupBy(F.col("consumer").alias("label")).agg(F.count(F.lit(1)).alias("came"))
        level += 1
        rows = stored(rows.where("missing > 0").join(came, "label", "left").select("label", (F.col("missing") - F.coalesce("came", F.lit(0))).alias("missing")), f"{folder}/nodes/level={level}")
    return nodes.sparkSession.read.schema("label string, missing long, level int").parquet(f"{folder}/nodes").where("missing = 0").select("label", "level")
