"""Benchmark decontamination: a prefix-filtered set join with exact verification over item-sized windows.

A window is ``WINDOW`` consecutive words of an item (a shorter item is one window) and has to be contained whole, so
by the prefix principle one shingle of it is enough to join on: its rarest, by counts over all documents. A document
that holds that shingle is a candidate; the length and positional bound (the window has to fit around the shingle
inside the text) and a comparison of all the window's words follow.

Items are cut into parts of ``PART_WORDS`` windows, which overlap by a window less a word, so every window of an item stands
in one of its parts and a long item needs no more memory than others. The benchmark is read in blocks of about
``BLOCK_WORDS`` words, hashed by part; each block is two narrow passes over the documents, one to count and one to mark,
and what is marked is written before the next, so a task has one block at a time and documents are never shuffled. The
work is that of the documents times the blocks.

Null and empty texts have no words; an item without words has no window. Repeated rows are each judged. Other columns
of documents pass through ``annotate``, except that added names (n_words, hit_ranges, hit_items) replace old ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.llm.common import Scratch, ascii_lower, held, in_batches, table

WINDOW, SHINGLE, BLOCK_WORDS, PART_WORDS = 13, 3, 1_000_000, 100_000
_FACTOR, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
RANGES = "array<struct<start: int, end: int>>"


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: bytes of other alphabets are all 128 or more, so bytes split as code points do."""
    return text.translate(_SPLIT).split() if text else []


class Block:
    """Windows of some items over small word numbers. 0 stands for words that no item has.

    A shingle's code is a hash of its word numbers, modulo 2**64: two shingles of one code would only make a candidate
    more, which the comparison of all words drops.
    """

    def __init__(self, items: list[tuple], number: int = 0):
        self.name = f"before-{number}"
        self.vocabulary: dict[bytes, int] = {}
        numbered = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        found: dict[tuple[int, ...], set[str]] = {}  # an item without an id has windows but no name
        for item, text in items:
            ids = [numbered(w) for w in words_of(text.encode() if text is not None else None)]
            for i in range(max(len(ids) - WINDOW, 0) + 1):
                if ids:
                    found.setdefault(tuple(ids[i : i + WINDOW]), set()).update([str(item)] if item is not None else [])
        self.windows = list(found)
        self.items = [sorted(x) for x in found.values()]
        self.sizes = sorted({min(SHINGLE, len(w)) for w in self.windows})
        self.codes = {g: np.unique([self.code(w[i : i + g]) for w in self.windows if min(SHINGLE, len(w)) == g for i in range(len(w) - g + 1)]).astype(np.int64) for g in self.sizes}

    def code(self, ids: tuple[int, ...]) -> int:
        out = 0
        for x in ids:
            out = (out * _FACTOR + x) & _MASK
        return out - (1 << 64) if out >> 63 else out

    def choose(self, counts: dict[tuple[int, int], int]) -> None:
        """For each window its rarest shingle and where in the window that stands, grouped by shingle."""
        self.prefix = {}
        for g in self.sizes:
            rows = []
            for n, w in enumerate(self.windows):
                if min(SHINGLE, len(w)) == g:
                    codes = [self.code(w[i : i + g]) for i in range(len(w) - g + 1)]
                    at = min(range(len(codes)), key=lambda i: (counts.get((g, codes[i]), 0), codes[i], i))
                    rows.append((codes[at], n, at))
            rows.sort()
            codes, first, size = np.unique(np.array([r[0] for r in rows], np.int64), return_index=True, return_counts=True)
            self.prefix[g] = (codes, first, size, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        self.length = np.array([len(w) for w in self.windows])
        self.flat = np.array([x for w in self.windows for x in w], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])[:-1]

    def numbers(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of texts one after another, a 0 behind each, and where each text begins."""
        get, ids, starts = self.vocabulary.get, [], [0]
        for text in texts:
            ids += [get(w, 0) for w in words_of(text)]
            ids.append(0)
            starts.append(len(ids))
        return np.array(ids, np.int64), np.array(starts)

    def shingles(self, ids: np.ndarray, g: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and codes of runs of g known words."""
        known = ids > 0
        ok = known[: len(ids) - g + 1].copy()
        for k in range(1, g):
            ok &= known[k : len(ids) - g + 1 + k]
        at = np.flatnonzero(ok)
        code = ids[at].view(np.uint64)
        for k in range(1, g):
            code = code * np.uint64(_FACTOR) + ids[at + k].view(np.uint64)
        return at, code.view(np.int64)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, window) of every occurrence."""
        places, windows = [], []
        for g, (codes, first, size, window, offset) in self.prefix.items():
            at, code = self.shingles(ids, g)
            i = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            same = codes[i] == code
            at, i = at[same], i[same]
            n = size[i]
            pick = np.repeat(first[i] - np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64), n) + np.arange(n.sum()) if len(i) else np.zeros(0, np.int64)
            w, start = window[pick], np.repeat(at, n) - offset[pick]
            fits = (start >= 0) & (start + self.length[w] <= len(ids))
            w, start = w[fits], start[fits]
            for length in np.unique(self.length[w]):
                some = self.length[w] == length
                ww, ss, k = w[some], start[some], np.arange(length)
                for j in range(0, len(ww), 1 << 16):
                    a, b = ss[j : j + (1 << 16)], ww[j : j + (1 << 16)]
                    equal = (ids[a[:, None] + k] == self.flat[self.offset[b][:, None] + k]).all(axis=1)
                    places.append(a[equal])
                    windows.append(b[equal])
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *places]), np.concatenate([empty, *windows])


def _as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def _pieces(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def shingle_counts(docs: DataFrame, block: Block) -> dict[tuple[int, int], int]:
    """How often each shingle of the block's windows stands in all documents: as many rows as the block has shingles."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("decontaminate", dict)
        total = {g: np.zeros(len(codes), np.int64) for g, codes in block.codes.items()}
        for batch in batches:
            for part in _pieces(batch):
                ids, _ = block.numbers(_as_bytes(part.column(0)))
                for g, codes in block.codes.items():
                    _, code = block.shingles(ids, g)
                    i = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    total[g] += np.bincount(i[codes[i] == code], minlength=len(codes))
        for g, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), g), pa.int64()), pa.array(block.codes[g][some]), pa.array(n[some])], ["g", "code", "n"])

    rows = in_batches(docs.select("text")).mapInArrow(count, "g long, code long, n long").groupBy("g", "code").agg(F.sum("n").alias("n")).collect()
    return {(r["g"], r["code"]): r["n"] for r in rows}


def _mark(docs: DataFrame, block: Block, rest: list[str], first: bool) -> DataFrame:
    """docs with the block's occurrences added to n_words, hit_ranges and hit_items; text is the first column."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                ids, starts = block.numbers(_as_bytes(part.column(0)))
                place, window = block.hits(ids)
                own = np.searchsorted(starts, place, side="right") - 1
                ranges, items = [[] for _ in range(part.num_rows)], [set() for _ in range(part.num_rows)]
                for d, p, w in sorted(zip(own.tolist(), place.tolist(), window.tolist(), strict=True)):
                    a = p - int(starts[d])
                    b = a + len(block.windows[w])
                    if ranges[d] and ranges[d][-1]["end"] >= a:
                        ranges[d][-1]["end"] = max(b, ranges[d][-1]["end"])
                    else:
                        ranges[d].append({"start": a, "end": b})
                    items[d].update(block.items[w])
                if not first:
                    for d, (r, x) in enumerate(zip(part.column("hit_ranges").to_pylist(), part.column("hit_items").to_pylist(), strict=True)):
                        ranges[d] += r
                        items[d].update(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ["text", *rest]]
                    + [
                        pa.array(np.diff(starts) - 1, pa.int64()),
                        pa.array(ranges, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    ["text", *rest, "n_words", "hit_ranges", "hit_items"],
                )

    schema = T.StructType([docs.schema[c] for c in ["text", *rest]])
    schema = schema.add("n_words", "long").add("hit_ranges", T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()))).add("hit_items", T.ArrayType(T.StringType()))
    return in_batches(docs).mapInArrow(mark, schema)


def parts_of(benchmark: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """Rows (item_id, at, text) of benchmark (item_id, text): items of up to part_words windows as they are, longer ones in parts."""
    n = F.coalesce(F.length("text"), F.lit(0))
    words = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD), F.lit(0)).alias("words")
    cut = f"transform(sequence(0, greatest(size(words) - {WINDOW}, 0), {part_words}), i -> array_join(slice(words, i + 1, {part_words + WINDOW - 1}), ' '))"
    short = benchmark.where(n <= part_words).select("item_id", F.lit(0).alias("at"), "text")
    long = benchmark.where(n > part_words).select("item_id", words).select("item_id", F.posexplode(F.expr(cut)).alias("at", "text"))
    return short.unionByName(long)


def blocks_of(benchmark: DataFrame, block_words: int = BLOCK_WORDS, part_words: int = PART_WORDS) -> Iterator[Block]:
    """The benchmark's parts of items in blocks, each bounded, by a hash of what the part is of."""
    rows = parts_of(benchmark.select("item_id", "text"), min(part_words, block_words))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = total // (2 * block_words) + 1  # a word has a separator
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "at", "text"), F.lit(n)) == k)
        block = Block([tuple(r) for r in part.select("item_id", "text").collect()], k)
        if block.windows or (k == n - 1):
            yield block


def annotate(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, part_words: int = PART_WORDS) -> DataFrame:
    """docs with n_words, hit_ranges (disjoint within a block, by words) and hit_items (sorted as strings)."""
    added = ("n_words", "hit_ranges", "hit_items")
    rest = [c for c in docs.columns if c not in ("text", *added)]
    rows, scratch, last = docs.select("text", *rest), None, None
    for block in blocks_of(benchmark, block_words, part_words):
        block.choose(shingle_counts(docs, block) if block.windows else {})
        if last:
            scratch = scratch or Scratch(docs.sparkSession, "blocks")
            rows = scratch.write(rows, block.name)
            scratch.drop(last)  # read by the table just written; the last one is read by what is returned
        rows = _mark(rows, block, rest, not last)
        last = block.name
    return rows


def n_hit():
    """Words inside any range; ranges of different blocks may overlap."""
    step = "(a, r) -> named_struct('n', a.n + greatest(0, r.end - greatest(a.to, r.start)), 'to', greatest(a.to, r.end))"
    return F.expr(f"aggregate(array_sort(hit_ranges), named_struct('n', 0, 'to', 0), {step}, a -> cast(a.n as long))")


def contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", n_hit().alias("n_hit"), "hit_items").select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated")
    )


ORACLE = f"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as words from documents),
b as (select item_id::varchar as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as words from benchmark),
w as (select distinct item, least(len(words), {WINDOW}) as n, array_to_string(words[i:i + least(len(words), {WINDOW}) - 1], ' ') as k from b, unnest(range(1, greatest(len(words) - {WINDOW}, 0) + 2)) as t(i) where len(words) > 0),
p as (select doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') as k from d, (select distinct n from w), unnest(range(1, len(words) - n + 2)) as t(i)),
h as (select doc_id, i, n, item from p join w using (n, k)),
c as (select doc_id, count(distinct i + j) as n_hit from h, unnest(range(n)) as t(j) group by doc_id),
it as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from h group by doc_id)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit > 0 and 20 * n_hit >= len(words), false) as contaminated from d left join c using (doc_id) left join it using (doc_id)"""
QUERIES = {"op8_decontamination": op8_decontamination}
ORACLES = {"op8_decontamination": ORACLE}
