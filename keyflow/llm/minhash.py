"""Near duplicates by MinHash: minima under many universal hash functions, bands, verification of signatures, exact sets.

A document's set is its distinct n-word shingles, hashed to 63 bits. ``MINIMA`` functions x -> a * x mod 2**64, cut to
their upper 32 bits (multiply-shift with odd a, a universal family), give a minimum each; two sets have one in common
with the probability of their Jaccard similarity. ``BANDS`` bands of ``ROWS`` minima are buckets: a pair at similarity
0.85 shares one with a probability of 1 - 7e-9, one at 0.3 with 0.08. A bucket's members are held against its leader
and then against each other by their differences to it (``graph.linked``), so a large group does not become its pairs.
Candidates whose signatures agree in fewer minima than ``least_agreeing`` says (a like pair does so with a chance under
1e-9) are dropped by their signatures alone; the others are confirmed on their full sets, fragment by fragment. Links
make components by alternating large-star and small-star steps, each written as a table.

Texts with equal words are one class, of which the smallest doc_id takes part; fewer than ``N`` words are one shingle.
Null texts and texts without words have empty sets, link with nothing and are kept. Rows without a doc_id link with
nothing and are kept. A doc_id is expected to stand for one text: of different texts under one id, one takes part.
Rows that repeat a doc_id are kept or not together. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm.common import held, in_batches, table
from keyflow.llm.ngrams import Hasher, bits_of, joined, key_of, normalized

N, PERCENT, BANDS, ROWS = 3, 85, 32, 5
MINIMA = BANDS * ROWS
_FACTORS = np.random.Generator(np.random.PCG64(85)).integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 15


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """A row of MINIMA numbers (32 bits) for each set of shingle hashes, none of which is empty."""
    out = np.empty((len(sets), MINIMA), np.uint32)
    flat = np.concatenate(sets).view(np.uint64)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    for k, factor in enumerate(_FACTORS):
        out[:, k] = np.minimum.reduceat(flat * factor, starts) >> np.uint64(32)
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    """A 63-bit key for each band, different from band to band."""
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(mins), BANDS)).copy()
    cut = mins.reshape(len(mins), BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        h = (h ^ cut[:, :, r]) * _BASE
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(1)).astype(np.int64)


@cache
def least_agreeing(percent: int, chance: float = 1e-9) -> int:
    """The most minima c of which one can ask that a pair at the threshold agrees in c or more but for this chance."""
    p, below = percent / 100, 0.0
    for c in range(MINIMA + 1):
        below += math.comb(MINIMA, c) * p**c * (1 - p) ** (MINIMA - c)
        if below >= chance:
            return c
    return MINIMA


def features(docs: DataFrame, n: int = N) -> DataFrame:
    """Per row of docs (doc_id, text): key of its words, size of its set, signatures (the bands' keys), minima and odd_bits()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = held("ngrams", Hasher)

        def told(ids: list, keys: list, sets: list[np.ndarray]) -> pa.RecordBatch:
            some = [i for i, s in enumerate(sets) if len(s)]
            bands, raw = [None] * len(sets), [None] * len(sets)
            if some:
                mins = minima([sets[i] for i in some])
                for i, b, m in zip(some, band_keys(mins), mins, strict=True):
                    bands[i], raw[i] = b, m.tobytes()
            columns = (ids, keys, [len(s) for s in sets], bands, raw, [bits_of(s) for s in sets])
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "key", "size", "signatures", "minima", "bits"])

        for batch in batches:
            ids, keys, sets, size = [], [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                data = normalized(text)
                grams = hasher.grams(data, n)
                ids.append(doc), keys.append(key_of(data)), sets.append(grams)
                size += len(grams)
                if size >= _BLOCK:  # so many numbers stay in a core's cache over all functions
                    yield told(ids, keys, sets)
                    ids, keys, sets, size = [], [], [], 0
            if ids:
                yield told(ids, keys, sets)

    return in_batches(docs.select("doc_id", "text")).mapInArrow(run, "doc_id long, key binary, size int, signatures array<long>, minima binary, bits array<long>")


def agreeing(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, x, y) whose minima x and y agree often enough, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, MINIMA) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least_agreeing(percent)))

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id, the smallest doc_id reachable by links."""

    def screen(pairs: DataFrame, features_: DataFrame) -> DataFrame:
        each = features_.select("node", "minima").dropDuplicates(["node"])
        x, y = (each.select(F.col("node").alias(node), F.col("minima").alias(name)) for node, name in (("a", "x"), ("b", "y")))
        return agreeing(pairs.join(x, "a").join(y, "b"), percent)

    return joined(docs, features(docs, n), n, percent, screen)


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


QUERIES = {"op13_minhash_near_dedup": op13_minhash_near_dedup}
ORACLES: dict[str, str] = {}
