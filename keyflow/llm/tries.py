"""Prefix trie of rebuilt conversations, by union-find over the longest common prefixes of sorted neighbours.

A turn is a digest of 16 bytes of its role and text, a conversation the sequence of its turns' digests. Sequences are
sorted by ranges of (sequence, conv_id), so copies of one conversation spread over tasks; each run of equal sequences
becomes pieces (how many, the smallest conv_id, and the conv_ids as text), of which equal sequences have few. Distinct
sequences are then sorted into ranges and read in runs of ``CHUNK`` turns, each of which makes a forest:

1. Neighbours in order are joined by edges as deep as their longest common prefix (LCP). Edges are taken in descending
   depth; each joins two components of a union-find and creates a branching node at that depth, or adds a child to the
   left component's top where that has the depth already. Nodes of a single child lie between a node and its parent.
2. What lies below the LCPs with the sequences before and behind a run is complete and leaves as it is. The rest, the
   nodes along the run's first and last sequence up to these LCPs, is contracted: one row for each, with sums over the
   complete parts below it, named by a digest of its prefix.
3. Contracted rows of one name are the same node in several runs and are merged. What they sum is additive: members,
   childless nodes, children, and saved tokens as (members - 1) * words; the "- 1", like a child, is counted in the run
   where the node appears first. Only the parents' conv_ids are looked up afterwards.

A run is held in memory, never a table or a group; a conversation is one row of 16 bytes and a number for each turn.

Rows without a conv_id take no part. Turns of a conversation are in order of turn (null first), then role and digest,
so repeated rows are turns of their own and ties have one order. Null role or text is empty. Without rows there is no
node, not even the root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyflow.llm.common import Scratch, in_batches, table
from keyflow.llm.graph import with_few

WIDTH, CHUNK, PIECE, HEADS, FAMILY = 16, 200_000, 8192, 4, 20
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = "key binary, depth long, conv_id long, parent_key binary, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_TYPES = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.string()]
_NAMES = [f.split()[0] for f in NODE.split(", ")]


def turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, at, digest, words) of conversations (conv_id, turn, role, text), at from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), digest.alias("digest"), words.alias("words"))
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest")) - 1
    return rows.select("conv_id", at.alias("at"), "digest", "words")


def rebuilt(numbered: DataFrame) -> DataFrame:
    """Rows (conv_id, at, digest, words) of turns(): the first h turns of the family's first conversation, then the own ones after h.

    Every conv_id has, besides, a row without digest, so that one without turns stays.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    each = numbered.where("at = 0").select("conv_id", base.alias("base"), h.alias("h"))
    heads = numbered.where((F.col("conv_id") % FAMILY == 0) & (F.col("at") < HEADS - 1)).withColumnRenamed("conv_id", "base")
    lent = each.where("h > 0").join(heads, "base").where("at < h").select("conv_id", "at", "digest", "words")
    none = each.select("conv_id", F.lit(None).cast("int").alias("at"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("int").alias("words"))
    return numbered.where(F.col("at") >= h).unionByName(lent).unionByName(none)


def sequences(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, seq, words): digests of a conversation's turns one behind the other, and how many words each has."""
    one = F.when(F.col("digest").isNotNull(), F.struct("at", F.hex("digest").alias("digest"), "words"))
    got = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("t"))
    return got.select("conv_id", F.unhex(F.array_join("t.digest", "")).alias("seq"), F.col("t.words").alias("words"))


def pieces_of(convs: DataFrame) -> DataFrame:
    """Rows (seq, words, first, n, ids) of sequences() in order of (seq, conv_id): runs of equal ones, ids as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now, words, ids = [], None, None, []

        def close() -> None:
            if ids:
                rows.append((now, words, ids[0], len(ids), ",".join(map(str, ids))))
                ids.clear()

        for batch in batches:
            for conv, seq, w in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if seq != now or len(ids) == PIECE:
                    close()
                    now, words = seq, w
                ids.append(conv)
            if len(rows) >= 1000:
                yield _batch(rows)
                rows = []
        close()
        if rows:
            yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["seq", "words", "first", "n", "ids"])

    ranged = convs.select("conv_id", "seq", "words").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    return in_batches(ranged).mapInArrow(run, "seq binary, words array<int>, first long, n long, ids string")


def lcp(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at their start."""
    n, step = min(len(a), len(b)), 4096
    for at in range(0, n, step):
        if a[at : at + step] != b[at : at + step]:
            end = min(n, at + step)
            x, y = (np.frombuffer(s[at:end], np.uint8) for s in (a, b))
            unlike = np.flatnonzero(x != y)
            return (at + int(unlike[0])) // WIDTH if len(unlike) else end // WIDTH
    return n // WIDTH


def range_edges(ranged: DataFrame) -> DataFrame:
    """Rows (range, before, behind): LCPs of a range's first sequence with the one before and of its last with the next; -1: none.

    One row a range, so one task has as many rows as there are ranges.
    """
    ends = ranged.groupBy("range").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    w = Window.orderBy("range")
    beside = ends.select("range", "lo", "hi", F.lag("hi").over(w).alias("before"), F.lead("lo").over(w).alias("behind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, hi, before, behind = (batch.column(i).to_pylist() for i in range(1, 5))
            deep = lambda x, y: [-1 if b is None else lcp(a, b) for a, b in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deep(lo, before), pa.int32()), pa.array(deep(hi, behind), pa.int32())], ["range", "before", "behind"])

    return beside.mapInArrow(run, "range int, before int, behind int")


def _names(seq: bytes, deepest: int) -> list[bytes]:
    """Digests of a sequence's prefixes of 0, 1 ... turns."""
    running, out = hashlib.blake2b(digest_size=16), []
    for d in range(deepest + 1):
        if d:
            running.update(seq[WIDTH * (d - 1) : WIDTH * d])
        out.append(running.copy().digest())
    return out


def forest(run: list[tuple], before: int, behind: int) -> list[tuple]:
    """Rows of NODE for a run of distinct sequences in order, each (seq, words, n, smallest conv_id, digest of its conv_ids)."""
    m = len(run)
    depth = [len(s[0]) // WIDTH for s in run]
    n, least, lo, hi, parent = [s[2] for s in run], [s[3] for s in run], list(range(m)), list(range(m)), [-1] * m
    edges = np.array([lcp(run[i - 1][0], run[i][0]) for i in range(1, m)], np.int64)
    group, top = list(range(m)), list(range(m))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i in np.argsort(-edges, kind="stable").tolist():  # of one depth from left to right, so only a left top can have it
        a, b, d = root(i), root(i + 1), int(edges[i])
        x, y = top[a], top[b]
        if depth[x] != d:
            depth.append(d), n.append(n[x]), least.append(least[x]), lo.append(lo[x]), hi.append(hi[x]), parent.append(-1)
            parent[x] = x = len(depth) - 1
        parent[y] = x
        n[x], least[x], hi[x] = n[x] + n[y], min(least[x], least[y]), hi[y]
        if a < b:
            group[b], top[a] = a, x
        else:
            group[a], top[b] = b, x

    left, right = _names(run[0][0], before), _names(run[-1][0], behind)
    children, leaves, saved, has = [0] * len(depth), [0] * len(depth), [0] * len(depth), [False] * len(depth)

    def name(v: int, d: int) -> bytes | None:
        """The digest of a node that goes on beyond this run; None: all of it is here."""
        return left[d] if lo[v] == 0 and d <= before else right[d] if hi[v] == m - 1 and d <= behind else None

    out = []
    for v in sorted(range(len(depth)), key=lambda v: -depth[v]):  # children come before their parents
        if not has[v]:
            leaves[v] = 0 if v == m - 1 and behind == depth[v] else 1
        up, words = parent[v], run[lo[v]][1]
        ends = run[v][4] if v < m else None
        for d in range(depth[v], depth[up] if up >= 0 else -1, -1):
            own = lo[v] > 0 or d > before  # not in the run before
            if d:
                saved[v] += (n[v] - own) * words[d - 1]
            above = v if up < 0 or d - 1 > depth[up] else up
            key, parent_key = name(v, d), name(above, d - 1) if d else None
            out.append((key, d, least[v], parent_key, least[above] if d and parent_key is None else None, n[v], children[v], leaves[v], saved[v], ends))
            children[v], ends = int(own), None
        if up >= 0:
            children[up] += children[v]
            leaves[up] += leaves[v]
            saved[up] += saved[v]
            has[up] = True
    return out


def forests(ranged: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows of NODE for pieces with their range: complete nodes once, without a key, others once a run with the key they merge by."""
    sides = range_edges(ranged)
    rows = ranged.join(F.broadcast(sides), "range").repartition("range").sortWithinPartitions("range", "seq", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the run so far
        now, size, sha, before = None, 0, None, -1

        def made(behind: int) -> pa.RecordBatch:
            rows = forest(held, before, behind)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)

        def add() -> None:
            nonlocal size
            held.append((now["seq"], now["words"], now["n"], now["first"], sha.hexdigest()))
            size += len(now["words"]) + 1

        for batch in batches:
            for x in batch.to_pylist():
                if now is not None and x["range"] == now["range"] and x["seq"] == now["seq"]:
                    sha.update(b"," + x["ids"].encode())
                    now["n"] += x["n"]
                    continue
                if now is not None:
                    add()
                    if x["range"] != now["range"]:
                        yield made(now["behind"])
                        held, size, before = [], 0, x["before"]
                    elif size >= chunk:
                        deep = lcp(now["seq"], x["seq"])
                        yield made(deep)
                        held, size, before = [], 0, deep
                else:
                    before = x["before"]
                now, sha = x, hashlib.sha256(x["ids"].encode())
        if now is not None:
            add()
            yield made(now["behind"])

    return in_batches(rows.select("range", "seq", "words", "first", "n", "ids", "before", "behind")).mapInArrow(run, NODE)


def trie(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations (conv_id, turn, role, text); see the contract of op12."""
    spark = conversations.sparkSession
    scratch = Scratch(spark, "trie")
    numbered = scratch.write(turns(conversations), "turns")
    pieces = pieces_of(sequences(rebuilt(numbered)))
    # the number of ranges is given, so that none are put together; ranges are cut by a sample, so rows are written with theirs
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = scratch.write(pieces.repartitionByRange(parts, "seq").withColumn("range", F.spark_partition_id()), "ranges")
    nodes = scratch.write(forests(ranged, chunk), "nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    shared = nodes.where("key is not null").groupBy("key").agg(F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.min("parent_key").alias("parent_key"), *sums, F.max("ends_sha256").alias("ends_sha256"))
    shared = scratch.write(shared, "shared")
    whole = nodes.where("key is null")
    above = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("__parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    open_ = whole.where("parent_key is not null").unionByName(shared.withColumn("parent_conv_id", F.lit(None).cast("long")), allowMissingColumns=True)
    told = with_few(open_, above, "parent_key", "left").withColumn("parent_conv_id", F.col("__parent")).select(columns)
    return told.unionByName(whole.where("parent_key is null").select(columns)).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


_DIGEST = f"sha256(length(role) || ':' || role || text)[1:{2 * WIDTH}]"
_BYTE = "list_reduce(range(8), lambda z, k: xor(z >> 1, 3988292384 * (z & 1)), xor(a, b))"
_CRC = f"xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint), lambda a, b: {_BYTE}, 4294967295), 4294967295)"
ORACLE = f"""
with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, {_DIGEST}) - 1 as pos, {_DIGEST} as digest, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
c as (select conv_id, conv_id - conv_id % {FAMILY} as base, {_CRC} % {HEADS} as h from (select distinct conv_id from t)),
r as (select c.conv_id, pos, digest, words from c join t on t.conv_id = c.base and pos < h union all select c.conv_id, pos, digest, words from c join t using (conv_id) where pos >= h),
s as (select conv_id, coalesce(list(digest order by pos) filter (where digest is not null), []) as seq, coalesce(list(words order by pos) filter (where digest is not null), []) as words from c left join r using (conv_id) group by conv_id),
p as (select conv_id, seq[1:d] as seq, d, case when d > 0 then words[d] else 0 end as w, d = len(seq) as ends from s, unnest(range(len(seq) + 1)) as u(d)),
n as (select seq, d, any_value(w) as w, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256 from p group by seq, d),
k as (select seq[1:d - 1] as seq, count(*) as n_children from n where d > 0 group by 1),
b as (select n.*, coalesce(n_children, 0) as n_children from n left join k using (seq)),
x as (select seq[1:u.e] as seq, sum((n_children = 0)::int)::bigint as n_leaves, sum((n_convs - 1) * w)::bigint as saved_tokens from b, unnest(range(d + 1)) as u(e) group by 1)
select b.conv_id, b.d as depth, a.conv_id as parent_conv_id, b.n_convs, b.n_children, n_leaves, saved_tokens, b.ends_sha256
from b join x using (seq) left join n a on b.d > 0 and a.d = b.d - 1 and a.seq = b.seq[1:b.d - 1]"""
QUERIES = {"op12_prefix_trie": op12_prefix_trie}
ORACLES = {"op12_prefix_trie": ORACLE}
