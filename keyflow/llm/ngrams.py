"""Exact Jaccard join of documents on word n-grams, by vertical partitioning, down to connected components.

All n-grams stand in one global order, that of their hashes, which is cut into fragments; every document is cut at the
same places. It is used twice.

Candidates: sets of sizes a and b that meet the threshold differ in at most D = (1 - t) / (1 + t) * (a + b) n-grams, and
each of these spoils one fragment, so of m > D fragments m - D are equal. Fragments are ranked by size, then hash, which
is the same rank in every document; of the m - D equal ones the highest stands among the D + 1 highest of both
documents. So D + 1 fragments of a document are its signatures, and small ones, which unrelated documents may share, are
left out first. m depends on the size's power of two; a document whose partners may be above the next power also has
signatures of that level. Nothing has to be counted over the corpus, and frequent n-grams do no harm: they share a
fragment with others.

Overlaps: of the documents that share a signature the order is cut into ``FRAGMENTS`` fragments; fragments of two
documents are intersected separately and the partial overlaps summed for each pair, so no task needs two whole documents.

Texts with equal words are one class, of which the smallest doc_id takes part. Null texts and texts without words have
empty sets and link with nothing; fewer than ``N`` words are one n-gram. n-grams are compared by 63-bit hashes. A doc_id
is expected to stand for one text: of different texts under one id, one takes part, whole and alone. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm.common import Scratch, held, in_batches, is_empty, table
from keyflow.llm.graph import components, linked, odd_bits, semi, with_few

N, PERCENT, FRAGMENTS = 4, 85, 8
#: Of graph.odd_bits() of a document.
WORDS = 16
_BYTES = np.random.Generator(np.random.PCG64(20240611)).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def normalized(text: bytes | None) -> bytes:
    """A-Z lower-cased, words with one blank between them. bytes.split() and bytes.lower() know ASCII only, as is wanted."""
    return b" ".join(text.lower().split()) if text else b""


def key_of(data: bytes) -> bytes | None:
    """What texts of equal words share; null without words."""
    return hashlib.blake2b(data, digest_size=16).digest() if data else None


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


class Hasher:
    """Hashes of byte ranges from running sums: sum(table[byte] * base ** place), shifted back to place 0."""

    def __init__(self):
        self.up, self.down = _powers(_BASE, 1 << 16), _powers(_BACK, 1 << 16)

    def grams(self, data: bytes, n: int) -> np.ndarray:
        """Distinct hashes (63 bits, ascending) of the n-grams of a normalized text."""
        if not data:
            return np.zeros(0, np.int64)
        if len(data) >= len(self.up):
            self.up, self.down = _powers(_BASE, 2 * len(data)), _powers(_BACK, 2 * len(data))
        raw = np.frombuffer(data, np.uint8)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * self.up[: len(raw)])])
        blanks = np.flatnonzero(raw == 32)
        starts, ends = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(raw)]])
        if len(starts) >= n:
            starts, ends = starts[: len(starts) - n + 1], ends[n - 1 :]
        else:
            starts, ends = starts[:1], ends[-1:]
        h = (sums[ends] - sums[starts]) * self.down[starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return np.unique((h >> np.uint64(1)).astype(np.int64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def differing(a: int, b: int, percent: int) -> int:
    """How many n-grams may stand in just one of two sets of these sizes that meet the threshold."""
    return (100 - percent) * (a + b) // (100 + percent)


def signatures(grams: np.ndarray, percent: int) -> np.ndarray:
    """Hashes (63 bits) of the highest fragments of a set of n-gram hashes (ascending), for each level it has partners on."""
    size, out = len(grams), []
    if not size:
        return np.zeros(0, np.int64)
    most, mixed, top = size * 100 // percent, _mixed(grams.view(np.uint64)), grams.view(np.uint64) >> np.uint64(32)
    for level in range(size.bit_length() - 1, most.bit_length()):
        last = (2 << level) - 1
        bound = differing(last, last, percent)
        m, keep = bound + max(2, bound // 8), differing(size, min(last, most), percent) + 1
        place = top * np.uint64(m) >> np.uint64(31)
        starts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        here, many, sums = place[starts], np.diff(np.append(starts, size)), np.add.reduceat(mixed, starts)
        if len(here) < keep:  # empty fragments rank last
            rest = np.setdiff1d(np.arange(m, dtype=np.uint64), here)
            here, many, sums = np.concatenate([here, rest]), np.concatenate([many, np.zeros(len(rest), np.int64)]), np.concatenate([sums, np.zeros(len(rest), np.uint64)])
        found = _mixed(sums ^ _mixed(here + np.uint64(level + 1 << 40))) >> np.uint64(1)
        out.append(found[np.lexsort((found, -many))[:keep]])
    return np.concatenate(out).astype(np.int64)


def bits_of(grams: np.ndarray) -> np.ndarray:
    return odd_bits(np.zeros(len(grams), np.int64), grams, 1, WORDS)[0]


def features(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Per row of docs (doc_id, text): key of its words, size of its set, signatures, odd_bits()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = held("ngrams", Hasher)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    data = normalized(text)
                    grams = hasher.grams(data, n)
                    rows.append((key_of(data), len(grams), signatures(grams, percent), bits_of(grams)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True))],
                    ["doc_id", "key", "size", "signatures", "bits"],
                )

    return in_batches(docs.select("doc_id", "text")).mapInArrow(run, "doc_id long, key binary, size int, signatures array<long>, bits array<long>")


def segments(docs: DataFrame, n: int = N) -> DataFrame:
    """Rows (node, key, fragment, grams) of docs (doc_id, text), one for each fragment; key is that of features()."""
    edges = [(1 << 63) // FRAGMENTS * k for k in range(1, FRAGMENTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = held("ngrams", Hasher)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    data = normalized(text)
                    grams, key = hasher.grams(data, n), key_of(data)
                    rows += [(doc, key, k, x) for k, x in enumerate(np.split(grams, np.searchsorted(grams, edges)))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64())), strict=True)], ["node", "key", "fragment", "grams"])

    return in_batches(docs.select("doc_id", "text")).mapInArrow(run, "node long, key binary, fragment int, grams array<long>")


def classes(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id, the smallest doc_id reachable by links."""
    return joined(docs, features(docs, n, percent), n, percent)


def joined(docs: DataFrame, rows: DataFrame, n: int, percent: int, screen: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """classes() by the signatures of rows (doc_id, key, size, signatures, bits ...), which like documents share.

    screen(pairs, features) may leave out pairs (a, b) of doc_ids before their sets are compared; features has, of rows,
    the one that stands for each doc_id, as node.
    """
    stays, scratch = Scratch(docs.sparkSession, "ngrams"), Scratch(docs.sparkSession, "ngram-pairs")
    found = scratch.write(rows, "features")
    usable = found.where("size > 0 and doc_id is not null")
    nodes = usable.groupBy("key").agg(F.min("doc_id").alias("node"))
    own = nodes.groupBy(F.col("node").alias("doc_id")).agg(F.min("key").alias("own"))
    # texts that another row stands for: few, so that signatures need no shuffle to get rid of theirs
    others = usable.select("doc_id", "key").join(own, "doc_id", "left").where("own is null or own <> key").select("doc_id", "key").distinct()
    others = scratch.write(others, "others")
    chosen = with_few(usable, others, ["doc_id", "key"], "left_anti")
    index = chosen.select(F.explode_outer("signatures").alias("bucket"), F.col("doc_id").alias("node")).where("bucket is not null")
    about = chosen.select(F.col("doc_id").alias("node"), "size")

    compared: list[str] = []

    def verifier(ids: DataFrame):
        marks = scratch.write(with_few(chosen.select(F.col("doc_id").alias("node"), "size", "bits"), ids, "node").dropDuplicates(["node"]), f"marks-{len(compared)}")

        def both(pairs: DataFrame, a: str, b: str) -> DataFrame:
            """Pairs with the fragments of both, which only the documents of these pairs are cut into."""
            compared.append(f"segments-{len(compared)}")
            nodes = pairs.select(F.col(a).alias("doc_id")).union(pairs.select(b)).distinct()
            texts = semi(docs.select("doc_id", "text"), nodes, "doc_id")
            # of a doc_id that has several texts only the fragments of the one that stands for it
            mine = with_few(segments(texts, n), others.withColumnRenamed("doc_id", "node"), ["node", "key"], "left_anti").drop("key")
            parts = scratch.write(mine.dropDuplicates(["node", "fragment"]), compared[-1])
            x, y = parts.select(F.col("node").alias(a), "fragment", F.col("grams").alias("x")), parts.select(F.col("node").alias(b), "fragment", F.col("grams").alias("y"))
            return pairs.join(x, a).join(y, [b, "fragment"])

        def verify(pairs: DataFrame) -> DataFrame:
            if screen is not None:
                pairs = scratch.write(screen(pairs, chosen.withColumnRenamed("doc_id", "node")), f"screened-{len(compared)}")
            partial = both(pairs, "a", "b").select("a", "b", F.size("x").alias("n_a"), F.size("y").alias("n_b"), F.size(F.array_intersect("x", "y")).alias("common"))
            total = partial.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n_a", "n_b", "common")])
            return total.where(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")

        def deltas(pairs: DataFrame) -> DataFrame:
            partial = both(pairs, "lead", "node").select("lead", "node", F.size("x").alias("n_x"), F.size("y").alias("n_y"), F.array_except("y", "x").alias("more"), F.array_except("x", "y").alias("less"))
            lists = [F.flatten(F.collect_list(c)) for c in ("more", "less")]
            return partial.groupBy("lead", "node").agg(F.sum("n_x").alias("lead_size"), F.sum("n_y").alias("size"), F.concat(*lists).alias("elements"))

        return verify, deltas, marks

    links = linked(index, about, percent, verifier, scratch, WORDS)
    told = found.select("doc_id", "key", F.col("size").cast("long").alias("n_shingles")).join(nodes, "key", "left")
    if not is_empty(links):
        told = told.join(components(links, scratch).withColumnRenamed("id", "node"), "node", "left").withColumn("node", F.coalesce("component", "node"))
    out = stays.write(told.select("doc_id", "n_shingles", F.coalesce("node", "doc_id").alias("component_id")), "classes")
    scratch.drop()
    return out


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op9_ngram_jaccard": op9_ngram_jaccard}
ORACLES: dict[str, str] = {}
