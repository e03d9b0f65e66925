"""Hard-negative mining: integer scores of anchors against all vectors by Strassen tiles, and heaps that merge.

Vectors become integer blocks: rows of a partition are packed, as they are read, into matrices of at most ``BLOCK_ROWS``
rows, so no key decides where a vector goes. A tile is an anchor block times a candidate block. Its product is Strassen's
recursion on int64 matrices: odd sides are padded with a zero row or column, seven half-sized products are combined by
integer additions. Below ``LEAF`` a product is one matrix multiplication, in doubles where the largest possible sum is
under 2**53 and so exact, else in int64. All of it is exact modulo 2**64, and so right for every score that a long holds;
vectors of different lengths are compared as if padded with zeros.

Two passes over the tiles. The first keeps a heap of ``POSITIVES`` same-label rows for each anchor; the second knows each
positive's score p and keeps, for each anchor and positive, a heap of ``NEGATIVES`` rows of other labels whose score s
fulfils ``low * p <= 100 * s <= high * p``, as whole numbers a window from ceil(low * p / 100) to floor(high * p / 100).
A heap is a set of at most k (score, vec_id); merging two is taking the best k of both. A task merges its tiles' heaps,
a window of k rows by anchor merges those of tasks, and Spark cuts each task's share to k before it shuffles them.

Anchor blocks are broadcast where all of them together are under ``BROADCAST_BYTES``; beyond that they are dealt in
groups, each with its own lanes of the candidates, and joined by a shuffle. The work is anchors times vectors, as asked.

Rows without vec_id or label, with a null vector or a component that is null or not finite take no part; nor do those
with a component whose 256-fold is outside the longs. An empty vector scores 0. A row is "other" if its vec_id is
another one: rows that share a vec_id are each a candidate of their own, and each an anchor of its own unless equal in
all columns used. Without rows the result is empty. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyflow.llm.common import Scratch, in_batches, table

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
BLOCK_ROWS, LEAF, BROADCAST_BYTES, GROUP_BLOCKS = 1024, 128, 32 << 20, 32
_WORST = np.iinfo(np.int64).min
_EXACT = 2.0**53
BLOCK = "block long, width int, ids binary, labels binary, matrix binary"
HEAP = "block long, row int, slot int, score long, vec_id long"


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b modulo 2**64, exactly; doubles only where no sum can leave the whole numbers that they hold."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    most = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1]
    if most < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _even(m: np.ndarray) -> np.ndarray:
    rows, columns = m.shape
    return np.pad(m, ((0, rows % 2), (0, columns % 2))) if rows % 2 or columns % 2 else m


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices modulo 2**64."""
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, columns) <= leaf or a.shape[1] < 2:
        return product(a, b)
    a, b = _even(a), _even(b)
    r, k, c = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :k], a[:r, k:], a[r:, :k], a[r:, k:]
    b11, b12, b21, b22 = b[:k, :c], b[:k, c:], b[k:, :c], b[k:, c:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * c), np.int64)
    out[:r, :c] = m1 + m4 - m5 + m7
    out[:r, c:] = m3 + m5
    out[r:, :c] = m2 + m4
    out[r:, c:] = m1 - m2 + m3 + m6
    return out[:rows, :columns]


class Heaps:
    """The best k (score, vec_id) of each of n slots: higher scores first, then smaller ids. Two heaps merge into one."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.slot, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(n, _WORST)  # the k-th score of a full slot; lower ones need not be offered

    def offer(self, slots: np.ndarray, scores: np.ndarray, able: np.ndarray, ids: np.ndarray) -> None:
        """Take a matrix of scores whose rows are these slots and whose columns are ids; only able entries count."""
        able = able & (scores >= self.least[slots][:, None])
        crowded = np.flatnonzero(able.sum(axis=1) > 4 * self.k)
        if len(crowded):
            sent = np.where(able[crowded], scores[crowded], _WORST)
            kth = np.partition(sent, sent.shape[1] - self.k, axis=1)[:, sent.shape[1] - self.k]
            able[crowded] &= scores[crowded] >= kth[:, None]
        row, column = np.nonzero(able)
        if len(row):
            self.merge(slots[row], scores[row, column], ids[column])

    def merge(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.ids, ids)))
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, slot)
        keep = np.arange(len(slot)) - first < self.k
        self.slot, self.score, self.ids = slot[keep], score[keep], ids[keep]
        full = np.arange(len(self.slot)) - np.searchsorted(self.slot, self.slot) == self.k - 1
        self.least[self.slot[full]] = self.score[full]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, label, vector) of vectors (vec_id, embedding, label) that take part; vector is of whole numbers."""
    fine = "forall(embedding, x -> x is not null and not isnan(x) and abs(cast(x as double)) * 256 < 9.2e18D)"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").where(f"vec_id is not null and label is not null and embedding is not null and {fine}")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select("vec_id", label.alias("label"), F.expr("transform(embedding, x -> cast(floor(256 * cast(x as double)) as long))").alias("vector"))


def packed(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of usable() as blocks of at most block_rows, where they are: no shuffle. Rows of a block are in order of vec_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, []

        def block(part: pa.Table) -> pa.RecordBatch:
            nonlocal number
            number += 1
            part = part.combine_chunks()
            ids, labels = (part.column(i).to_numpy() for i in (0, 1))
            lists = part.column(2).combine_chunks()
            sizes, flat = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().to_numpy()
            matrix = np.zeros((len(ids), int(sizes.max())), np.int64)
            matrix[np.repeat(np.arange(len(ids)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
            order = np.lexsort((labels, ids))
            return pa.RecordBatch.from_pylist([{"block": number, "width": matrix.shape[1], "ids": ids[order].tobytes(), "labels": labels[order].tobytes(), "matrix": matrix[order].tobytes()}], pa.schema([("block", pa.int64()), ("width", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "matrix"))]))

        n = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, block_rows - n)
                held.append(part)
                at, n = at + part.num_rows, n + part.num_rows
                if n == block_rows:
                    yield block(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield block(pa.Table.from_batches(held))

    return in_batches(rows.select("vec_id", "label", "vector")).mapInArrow(run, BLOCK)


def _matrix(raw: bytes, rows: int, width: int, full: int) -> np.ndarray:
    out = np.frombuffer(raw, np.int64).reshape(rows, width)
    return np.pad(out, ((0, 0), (0, full - width))) if full > width else out


def _long(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def tiles(anchors: DataFrame, candidates: DataFrame, limit: int = BROADCAST_BYTES, group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """Each anchor block beside each candidate block, anchors' columns named a_*: every tile once.

    Anchor blocks under the limit are broadcast. Otherwise they are cut into groups of blocks, candidate blocks into
    lanes; a group and a lane meet in one task, to which each anchor block is sent once a lane, each candidate block once a group.
    """
    named = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns])
    n, size = named.agg(F.count(F.lit(1)), F.sum(F.length("a_matrix"))).first()
    if (size or 0) <= limit:
        return candidates.withColumn("all", F.lit(0)).join(F.broadcast(named.withColumn("all", F.lit(0))), "all").drop("all")
    groups, lanes = n // group_blocks + 1, candidates.count() // group_blocks + 1
    each = lambda k: F.explode(F.expr(f"sequence(0L, {k - 1}L)"))
    left = candidates.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes))).withColumn("group", each(groups))
    right = named.withColumn("group", F.pmod(F.xxhash64("a_block"), F.lit(groups))).withColumn("lane", each(lanes))
    return left.join(right.hint("shuffle_hash"), ["group", "lane"]).drop("group", "lane")


def _searched(tiles_: DataFrame, k: int, windows: tuple[int, int] | None, leaf: int, most: int = 64) -> DataFrame:
    """Heaps (block, row, slot, score, vec_id) of each task; slot is the positive's place, or 0 in the first pass.

    Scores are made and dropped tile by tile. A task holds the heaps of at most ``most`` anchor blocks; more are sent on
    as they are and begun anew, for heaps of one anchor merge whatever they have seen.
    """
    second = windows is not None
    columns = ["a_block", "a_width", "a_ids", "a_labels", "a_matrix", *(["a_slots", "a_p_scores"] if second else []), "width", "ids", "labels", "matrix"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, Heaps] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for number, h in heaps.items():
                if len(h.slot):
                    wide = POSITIVES if second else 1
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h.slot), number)), pa.array((h.slot // wide).astype(np.int32)), pa.array((h.slot % wide).astype(np.int32)), pa.array(h.score), pa.array(h.ids)], ["block", "row", "slot", "score", "vec_id"])

        for batch in batches:
            for i in range(batch.num_rows):
                x = {c: batch.column(c)[i].as_py() for c in columns}
                a_ids, a_labels, ids, labels = (_long(x[c]) for c in ("a_ids", "a_labels", "ids", "labels"))
                full = max(x["a_width"], x["width"])
                scores = strassen(_matrix(x["a_matrix"], len(a_ids), x["a_width"], full), np.ascontiguousarray(_matrix(x["matrix"], len(ids), x["width"], full).T), leaf)
                if x["a_block"] not in heaps:
                    if len(heaps) >= most:
                        yield from told()
                        heaps.clear()
                    heaps[x["a_block"]] = Heaps(len(a_ids) * (POSITIVES if second else 1), k)
                heap, same, rows = heaps[x["a_block"]], a_labels[:, None] == labels, np.arange(len(a_ids))
                if not second:
                    heap.offer(rows, scores, same & (a_ids[:, None] != ids), ids)
                    continue
                # each slot is an anchor's row and the place of one of its positives
                slots, wanted = _long(x["a_slots"]), _long(x["a_p_scores"])
                for place in range(POSITIVES):
                    at = np.flatnonzero(slots % POSITIVES == place)
                    row, p = slots[at] // POSITIVES, wanted[at]
                    least, top = _ceil(p, windows[0]), _floor(p, windows[1])
                    some = np.flatnonzero(least <= top)
                    row, own = row[some], scores[row[some]]
                    heap.offer(slots[at][some], own, ~same[row] & (own >= least[some][:, None]) & (own <= top[some][:, None]), ids)
        yield from told()

    return tiles_.select(columns).mapInArrow(run, HEAP)


def _floor(p: np.ndarray, percent: int) -> np.ndarray:
    """floor(percent * p / 100) without leaving int64: p is cut into hundreds and the rest."""
    return p // 100 * percent + p % 100 * percent // 100


def _ceil(p: np.ndarray, percent: int) -> np.ndarray:
    return p // 100 * percent + -(-(p % 100 * percent) // 100)


def merged(heaps: DataFrame, k: int) -> DataFrame:
    """The best k of each (block, row, slot), with their rank from 1."""
    w = Window.partitionBy("block", "row", "slot").orderBy(F.desc("score"), "vec_id")
    return heaps.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mined(vectors: DataFrame, is_anchor: str = "vec_id % 100 = 0", percents: tuple[int, int] = (LOW, HIGH), block_rows: int = BLOCK_ROWS, leaf: int = LEAF, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (vec_id, embedding, label)."""
    scratch, rows = Scratch(vectors.sparkSession, "negatives"), usable(vectors)
    # blocks are written once: they are read twice, and a lost executor must not number them anew
    candidates = scratch.write(packed(rows, block_rows).repartition("block"), "candidates")
    some = rows.where(is_anchor).distinct()
    anchors = scratch.write(packed(some, block_rows), "anchors")
    first = _searched(tiles(anchors, candidates, limit), POSITIVES, None, leaf)
    positives = scratch.write(merged(first, POSITIVES).select("block", "row", (F.col("rank") - 1).cast("int").alias("slot"), F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")), "positives")
    # a block's positives are POSITIVES for each of its rows at most
    about = positives.groupBy("block").agg(F.sort_array(F.collect_list(F.struct((F.col("row").cast("long") * POSITIVES + F.col("slot")).alias("at"), "positive_score"))).alias("p"))
    told = _with_positives(anchors.join(about, "block"))
    second = _searched(tiles(told, candidates, limit), NEGATIVES, percents, leaf)
    found = merged(second, NEGATIVES).select("block", "row", "slot", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = _ids(anchors)
    out = found.join(positives, ["block", "row", "slot"]).join(ids, ["block", "row"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _with_positives(blocks: DataFrame) -> DataFrame:
    """Anchor blocks with slots and p_scores, the list p as two binaries of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("p").to_pylist()
            extra = [pa.array([np.array([x[f] for x in p], np.int64).tobytes() for p in lists], pa.binary()) for f in ("at", "positive_score")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *extra], [*names, "slots", "p_scores"])

    names = ["block", "width", "ids", "labels", "matrix"]
    return blocks.select(*names, "p").mapInArrow(run, f"{BLOCK}, slots binary, p_scores binary")


def _ids(blocks: DataFrame) -> DataFrame:
    """Rows (block, row, anchor_id) of anchor blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = _long(raw)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)], ["block", "row", "anchor_id"])

    return blocks.select("block", "ids").mapInArrow(run, "block long, row int, anchor_id long")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
a as (select *, row_number() over () as a from (select distinct * from v where vec_id % 100 = 0)),
s as (select a, a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])), 0)::bigint as score
  from a join v b on b.vec_id <> a.vec_id),
p as (select a, anchor_id, other_id as positive_id, score as positive_score, row_number() over (partition by a order by score desc, other_id) as k from s where same qualify k <= {POSITIVES}),
n as (select p.anchor_id, positive_id, row_number() over (partition by p.a, p.k order by s.score desc, other_id) as rank, other_id as negative_id, positive_score, s.score as negative_score
  from p join s on s.a = p.a and not same and {LOW} * positive_score <= 100 * score and 100 * score <= {HIGH} * positive_score qualify rank <= {NEGATIVES})
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n"""
QUERIES = {"op11_hard_negatives": op11_hard_negatives}
ORACLES = {"op11_hard_negatives": ORACLE}
