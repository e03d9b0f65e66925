"""Connected components of links, distributed, and which pairs of a bucket have to be looked at for them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import Scratch, is_empty

#: Sketches of 128 bits: the most bits that differ in a candidate pair, and in nodes that count as close to and far from a leader.
MOST, CLOSE, FAR = 30, 15, 45
#: Of a leader with so many members or fewer, each two are looked at by their marks; beyond that, differences are joined.
GROUP = 128


def _print(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame, scratch: Scratch | None = None, name: str = "components") -> DataFrame:
    """Rows (id, component): each id of links (a, b) with the smallest id that it is linked to, however far.

    The rounds' tables go to the caller's scratch, under names that begin with name, and stay as long as it does.

    Alternating large-star and small-star steps, which need a number of rounds that grows with the logarithm of the
    longest chain. Every round is written as a table, so lineage stays short and a lost executor costs one round.
    Links are grouped by their smaller or larger end and only minima are kept of a group: no group is collected.
    """
    scratch = scratch or Scratch(links.sparkSession, "components")
    edges = scratch.write(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{name}-0")
    old, n = _print(edges), 0
    while True:
        # large star: the larger neighbours of a node are linked to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: the smaller neighbours of a node and itself are linked to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = scratch.write(small, f"{name}-{n + 1}")
        scratch.drop(f"{name}-{n}")
        new, n = _print(edges), n + 1
        if new == old:
            break
        old = new
    nodes = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


def small(df: DataFrame, rows: int = 500_000) -> bool:
    """Whether df, whose rows are a few numbers each, has few enough to be broadcast; at most one row more is looked at."""
    return df.limit(rows + 1).count() <= rows


def semi(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of df whose key is in ids: by broadcast if ids are few, else by a shuffle."""
    return df.join(F.broadcast(ids) if small(ids) else ids, on, "left_semi")


def with_few(df: DataFrame, other: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join with a table of which each key has one row: by broadcast if it has few rows."""
    return df.join(F.broadcast(other) if small(other) else other, on, how)


def distance(x: str, y: str) -> Column:
    """How many bits of two sketches (low, high) differ."""
    return F.expr(f"bit_count({x}.low ^ {y}.low) + bit_count({x}.high ^ {y}.high)")


def fits(n_a: str, n_b: str, percent: int) -> Column:
    """Whether sets of these sizes can meet the threshold."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def odd_bits(rows: np.ndarray, hashes: np.ndarray, n: int, words: int) -> np.ndarray:
    """For each of n sets, 64 * words bits (int64, n x words): whether it has an odd number of elements at that place.

    hashes are the sets' distinct elements, rows the set of each. Two sets differ in as many elements as bits, or more.
    """
    size = 64 * words
    odd = np.bincount(rows.astype(np.int64) * size + (hashes.view(np.uint64) & np.uint64(size - 1)).astype(np.int64), minlength=n * size) & 1
    return np.packbits(odd.reshape(n, size).astype(np.uint8), axis=1).view(np.int64)


def may_link(x: str, y: str, words: int, percent: int) -> Column:
    """Whether two sets can meet the threshold by size and odd_bits(). No pair that meets it is left out."""
    bits = F.expr(" + ".join(f"bit_count({x}.bits[{i}] ^ {y}.bits[{i}])" for i in range(words)))
    return fits(f"{x}.size", f"{y}.size", percent) & ((100 + percent) * bits <= (100 - percent) * (F.col(f"{x}.size") + F.col(f"{y}.size")))


def linked(index: DataFrame, about: DataFrame, percent: int, verifier, scratch: Scratch, words: int) -> DataFrame:
    """All links (a, b) that the components of an exact similarity need, without pairs that they make needless.

    index: bucket, node; similar nodes share a bucket. about: node and the size of its set, or a sketch (low, high) of it;
    rows may repeat.

    1. Every node of a bucket is held against its leader, the node with most company in all its buckets: no more pairs
       than rows. Links found make components; within one, further links change nothing.
    2. Two nodes x and y of one leader L that are in different components. Let dx and dy be the differences of their sets
       to that of L. The difference of x and y is that of dx and dy, so x and y are alike only if dx and dy overlap by
       ``(|dx| + |dy| - D) / 2``, where D = (100 - percent) / (100 + percent) * (|x| + |y|) is what two like sets may
       differ by. One of them, say x, is not linked to L, so |dx| is above its own D and that overlap is positive: in
       one order of all elements, a like pair shares one of the first few of dx and dy (prefix and positional filter).
       The order is by how many members of L have the element in their difference, rarest first: of a group of near
       copies, first come those that each has of its own. So a group whose members all differ from its leader gives few
       pairs, however large it is. Of a leader with ``GROUP`` members or fewer each two are looked at instead.
    3. With sketches, only pairs that differ in ``MOST`` bits or fewer are candidates. Nodes far from their leader are
       held against others of the bucket that are not close to it; by the triangle inequality of the number of bits no
       close one can be a candidate. Step 2 has the rest.

    Pairs are compared only if size and odd_bits() of their sets allow a link, which drops none that is one.

    verifier(nodes) prepares what is needed to compare any of these nodes and returns two functions and a table: one keeps
    the linked ones of pairs (a, b), one gives for pairs (lead, node) the rows (lead, node, lead_size, size, elements), the
    elements of the difference. The table has node, size of its set and bits, its odd_bits() of so many words.
    """
    spark, sketched = index.sparkSession, "sketch" in about.columns
    of = "sketch" if sketched else "size"
    bucket = Window.partitionBy("bucket")
    ends = index.select("bucket", "node", F.min("node").over(bucket).alias("lo"), F.max("node").over(bucket).alias("hi")).where("lo <> hi")
    # dealt by bucket already, so neither distinct rows nor their number need another shuffle
    shared = scratch.write(ends.select("bucket", "node").dropDuplicates(["bucket", "node"]).withColumn("n", F.count(F.lit(1)).over(bucket)), "shared")
    none = spark.createDataFrame([], "a long, b long")
    if is_empty(shared):
        return none
    weight = scratch.write(shared.groupBy("node").agg(F.sum("n").alias("weight")), "weight")
    mine = scratch.write(with_few(about, weight, "node").groupBy("node").agg(*[F.first(c).alias(c) for c in ("weight", of)]), "mine")
    lead = F.max(F.struct("weight", (-F.col("node")).alias("minus"), of)).over(bucket)
    known = with_few(shared.drop("n"), mine, "node").withColumn("lead", lead).drop("weight")
    led = known.withColumn(f"lead_{of}", F.col(f"lead.{of}")).withColumn("lead", -F.col("lead.minus"))
    led = led.withColumn("far", distance("sketch", "lead_sketch") if sketched else F.lit(0))
    able = F.col("far") <= MOST if sketched else fits("size", "lead_size", percent)
    led = scratch.write(led.withColumn("able", able).drop(f"lead_{of}"), "led")
    scratch.drop("shared", "weight", "mine")
    members = scratch.write(led.where((F.col("node") != F.col("lead")) & (F.col("far") <= FAR)).select("lead", "node", "able").distinct(), "members")
    star = members.where("able").select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct()
    links, parts, deltas = none, None, None

    def possible(pairs: DataFrame, marks: DataFrame) -> DataFrame:
        x, y = (marks.select(F.col("node").alias(node), F.struct("size", "bits").alias(name)) for node, name in (("a", "x"), ("b", "y")))
        return pairs.join(x, "a").join(y, "b").where(may_link("x", "y", words, percent)).select("a", "b")

    if not is_empty(members):
        verify, deltas, marks = verifier(members.select("node").union(members.select("lead")).distinct())
        links = scratch.write(verify(scratch.write(possible(star, marks), "star")), "star-links")
    if not is_empty(links):
        parts = components(links, scratch, "parts")

    def component(df: DataFrame, node: str, name: str) -> DataFrame:
        if parts is None:
            return df.withColumn(name, F.col(node))
        return with_few(df, parts.select(F.col("id").alias(node), F.col("component").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))

    pairs = none
    if deltas is not None:
        told = component(component(members.select("lead", "node"), "node", "component"), "lead", "lead_component")
        mixed = told.groupBy("lead").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi").select("lead", "n")
        told = scratch.write(told.join(mixed, "lead"), "mixed")
        few, many = told.where(F.col("n") <= GROUP), scratch.write(told.where(F.col("n") > GROUP).drop("n"), "large")
        pairs = _by_marks(few.join(marks, "node"), words, percent)
        if not is_empty(many):
            by_deltas = _by_deltas(scratch.write(many.join(deltas(many.select("lead", "node")), ["lead", "node"]), "deltas"), percent)
            pairs = pairs.unionByName(possible(by_deltas.distinct(), marks))
    if sketched:
        pairs = pairs.unionByName(_by_sketches(component(led, "node", "component")))
    pairs = scratch.write(pairs.distinct().join(star, ["a", "b"], "left_anti"), "pairs")
    if is_empty(pairs):
        return links
    if sketched or deltas is None:  # nodes far from all leaders come in only here
        verify, _, marks = verifier(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        pairs = scratch.write(possible(pairs, marks), "possible")
    return scratch.write(links.unionByName(verify(pairs)), "links")


def _by_marks(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Candidates (a, b) of members (lead, node, component, lead_component, size, bits): of each leader, two of different components of which one is not in the leader's."""
    own = F.col("component") != F.col("lead_component")
    x, y = rows.where(own).alias("x"), rows.withColumn("own", own).alias("y")
    once = ~F.col("y.own") | (F.col("x.node") < F.col("y.node"))
    on = (F.col("x.lead") == F.col("y.lead")) & (F.col("x.component") != F.col("y.component")) & once & may_link("x", "y", words, percent)
    return x.join(y, on).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def _by_deltas(rows: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) of members (lead, node, component, lead_component, lead_size, size, elements); see linked()."""
    single = rows.select("lead", "node", F.explode_outer("elements").alias("element")).where("element is not null")
    many = single.groupBy("lead", "element").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranked = single.join(many, ["lead", "element"], "left").groupBy("lead", "node").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "element"))).alias("elements"))
    rows = rows.drop("elements").join(ranked, ["lead", "node"])
    less, more = 100 - percent, 100 + percent
    own = F.col("component") != F.col("lead_component")
    n = F.size("elements")
    most = F.floor(less * (F.col("size") + F.floor(F.col("size") * 100 / percent)) / more) + 1
    half = F.floor((more * n + less * (F.col("size") - F.col("lead_size"))) / (2 * more)) + 1
    keep = F.greatest(F.lit(0), F.when(own, most).otherwise(half)).cast("int")
    tokens = rows.select("lead", "node", "component", "size", own.alias("own"), n.alias("n"), F.posexplode_outer(F.slice("elements", F.lit(1), keep)).alias("at", "token")).where("token.n > 1").withColumn("element", F.col("token.element")).drop("token")
    x, y = tokens.where("own").alias("x"), tokens.alias("y")
    common = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    enough = 2 * more * common >= more * (F.col("x.n") + F.col("y.n")) - less * (F.col("x.size") + F.col("y.size"))
    once = ~F.col("y.own") | (F.col("x.node") < F.col("y.node"))
    on = (F.col("x.lead") == F.col("y.lead")) & (F.col("x.element") == F.col("y.element")) & (F.col("x.component") != F.col("y.component")) & once & fits("x.size", "y.size", percent) & enough
    return x.join(y, on).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def _by_sketches(led: DataFrame) -> DataFrame:
    """Candidates (a, b) of which one is far from the leader of their bucket."""
    x, y = led.where(F.col("far") > FAR).alias("x"), led.where(F.col("far") > CLOSE).alias("y")
    once = (F.col("y.far") <= FAR) | (F.col("x.node") < F.col("y.node"))
    on = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") != F.col("y.component")) & once & (distance("x.sketch", "y.sketch") <= MOST)
    return x.join(y, on).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
