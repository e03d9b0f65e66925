"""Fuzzy line deduplication: MinHash bands find lines that may be alike, exact Jaccard decides, one line of a component stays.

A line's set is its character shingles (white space around the line does not count). Lines are alike if their sets of
``K`` characters have a Jaccard similarity of 0.8 or more, or, where both have ``SHORT`` code points or fewer, those of
``K_SHORT``: so one changed character of a line of 30 does not part it from its copy, while long lines of one language,
which share most of their shorter shingles, are told apart. Each kind has its own signatures and bands; both go through
one search for candidates, in which a line is one node for each kind: the last bit of a node's number says which.

Signatures are MinHash by one permutation: each shingle is hashed once, the hash's range is cut into ``BINS`` bins, a bin
keeps its least value, and an empty bin takes that of another one, at places that are the same for all lines. A pair at
similarity 0.8 meets in one of 12 bands of 5 with probability 0.99. One bit of each bin makes a sketch, and candidates
differ in ``graph.MOST`` of its 128 bits at most (at similarity 0.8: 13 +- 4), so lines that meet in a band by chance
are never compared. Candidates are verified on their shingle sets, links make components by distributed union-find,
and of each component the first line by (doc_id, text's hash, line number) stays.

Equal lines are one node and need no signature to find each other. Lines without a character other than white space are
kept. Lines shorter than ``K_SHORT`` are alike only if equal. Null texts have no lines. A row is known by its doc_id and
text, so different texts under one doc_id, or under none, are told apart, and rows equal in both are treated as one.
Other columns pass through ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm.common import Scratch, held, in_batches, is_empty, table
from keyflow.llm.graph import components, linked, odd_bits, with_few

K, K_SHORT, SHORT, BANDS, ROWS, BINS, PERCENT = 5, 3, 100, 12, 5, 128, 80
#: Of graph.odd_bits() of a line.
WORDS = 2
_BASE = 0x9E3779B97F4A7C15
_EMPTY = np.uint64((1 << 64) - 1)
_RANDOM = np.random.Generator(np.random.PCG64(20240611))
_PLACES = _RANDOM.integers(0, BINS, (64, BINS))
_SALT = _RANDOM.integers(0, 1 << 63, BINS, dtype=np.uint64)
#: How much of what goes is broadcast.
GONE_ROWS, GONE_NUMBERS = 300_000, 4_000_000
SPACES = "\t\n\x0b\x0c\r "


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _runs(chars: np.ndarray, k: int) -> np.ndarray:
    if k == 1:
        return chars
    half = k // 2 if k % 2 == 0 else 1
    a, b = _runs(chars, k - half), chars if half == 1 else None
    b = a if b is None else b
    n = max(0, len(chars) - k + 1)
    return a[:n] * np.uint64(pow(_BASE, half, 1 << 64)) + b[k - half : k - half + n]


def shingle_hashes(chars: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k code points."""
    h = _runs(chars, k)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def signatures(lines: list[str], k: int = K) -> np.ndarray:
    """One row of ``BINS`` minima for each line of k characters or more."""
    sizes = np.array([len(x) for x in lines], np.int64)
    h = shingle_hashes(codes("".join(lines)), k)
    at = np.repeat(np.arange(0, BINS * len(lines), BINS), sizes)[: len(h)] + (h >> np.uint64(57)).astype(np.int64)
    h <<= np.uint64(7)
    # shingles that reach into the next line never are a minimum
    ends = np.cumsum(sizes)[:-1]
    for i in range(1, k):
        h[ends - i] = _EMPTY
    out = np.full(len(lines) * BINS, _EMPTY, np.uint64)
    np.minimum.at(out, at, h)
    out = out.reshape(len(lines), BINS)
    row, bin_ = np.nonzero(out == _EMPTY)
    first, least = out.copy(), out.min(axis=1)
    for places in _PLACES:
        if not len(row):
            break
        value = first[row, places[bin_]]
        found = value != _EMPTY
        out[row[found], bin_[found]] = value[found]
        row, bin_ = row[~found], bin_[~found]
    out[row, bin_] = least[row]
    return out


def band_keys(sig: np.ndarray, kind: int) -> np.ndarray:
    """A 63-bit key for each band, different from band to band and kind to kind."""
    out = np.empty((len(sig), BANDS), np.int64)
    for b in range(BANDS):
        h = np.full(len(sig), 1000 * kind + b, np.uint64)
        for r in range(ROWS):
            h = (h ^ sig[:, b * ROWS + r]) * np.uint64(_BASE)
            h ^= h >> np.uint64(31)
        out[:, b] = (h >> np.uint64(1)).astype(np.int64)
    return out


def sketches(sig: np.ndarray) -> np.ndarray:
    """128 bits for each line, as two numbers."""
    bits = ((sig ^ _SALT) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(63)
    return np.packbits(bits.astype(np.uint8), axis=1).view(np.int64)


def line_table(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, own, line, node, key, text, sets) for each line of docs (doc_id, text) that is not blank.

    own is the hash of the row's text, node the line's hash of 64 bits of which the last is 0, key one of 128 bits. sets:
    kind (K or K_SHORT), sketch and bands; text: the line. For lines that a task has met just before there are no sets and
    no text.
    """
    one = pa.struct([("kind", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def sets(lines: list[str], kind: int) -> pa.StructArray:
        sig = signatures(lines, kind)
        low_high, n = sketches(sig), len(lines)
        bands = pa.ListArray.from_arrays(np.arange(0, (n + 1) * BANDS, BANDS, dtype=np.int32), pa.array(band_keys(sig, kind).ravel()))
        return pa.StructArray.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(low_high[:, 0]), pa.array(low_high[:, 1]), bands], fields=list(one))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("lines", dict)
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 300):
                part = batch.slice(at, 300)
                doc_at, numbers, nodes, keys, fresh = [], [], [], [], []
                new = {K: ([], []), K_SHORT: ([], [])}
                for row, text in enumerate(part.column(1).to_pylist()):
                    for i, line in enumerate(text.split("\n") if text else ()):
                        if line := line.strip(SPACES):
                            raw = line.encode()
                            node = xxhash.xxh64_intdigest(raw) & -2
                            fresh.append(None)
                            if node not in seen:
                                seen.add(node)
                                for kind, (rows_of, texts) in new.items():
                                    if kind <= len(line) and (kind == K or len(line) <= SHORT):
                                        rows_of.append(len(nodes))
                                        texts.append(line)
                                        fresh[-1] = line
                            doc_at.append(row)
                            numbers.append(i)
                            nodes.append(node)
                            keys.append(xxhash.xxh3_128_digest(raw))
                if not nodes:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                found = {kind: sets(texts, kind) for kind, (_, texts) in new.items() if texts}
                values, rows = pa.concat_arrays(found.values()) if found else pa.array([], one), np.array([i for kind in found for i in new[kind][0]], np.int64)
                order = np.argsort(rows, kind="stable")
                offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(nodes)))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), values.take(pa.array(order)))
                where = pa.array(doc_at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()).take(where), part.column(2).take(where), pa.array(numbers, pa.int32()), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(keys, pa.binary()), pa.array(fresh, pa.string()), lists],
                    ["doc_id", "own", "line", "node", "key", "text", "sets"],
                )

    return in_batches(docs.select("doc_id", "text", own().alias("own"))).mapInArrow(
        run, "doc_id long, own long, line int, node long, key binary, text string, sets array<struct<kind: int, low: long, high: long, bands: array<long>>>"
    )


def own() -> Column:
    """What tells rows of one doc_id, or of none, apart."""
    return F.xxhash64("text")


def base(node: str) -> Column:
    """The number of a line without its kind."""
    return F.col(node).bitwiseAND(F.lit(-2))


def line_texts(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows (node, text) of these nodes of either kind, each once."""
    texts = lines.where("text is not null").select(F.col("node").alias("line"), "text")
    return with_few(texts, nodes.select(base("node").alias("line"), "node"), "line").select("node", "text").dropDuplicates(["node"])


def marks_of(lines: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the shingle sets of up to 1,024 lines of k characters or more, and their odd_bits()."""
    sizes = np.array([len(x) for x in lines], np.int64)
    h, row = shingle_hashes(codes("".join(lines)), k), np.repeat(np.arange(len(lines)), sizes)
    # shingles that reach into the next line are none
    whole = (np.repeat(np.cumsum(sizes), sizes) - np.arange(len(row)) >= k)[: len(h)]
    found = np.unique(row[: len(h)][whole].astype(np.uint64) << np.uint64(54) | h[whole] >> np.uint64(10))
    row = (found >> np.uint64(54)).astype(np.int64)
    return np.bincount(row, minlength=len(lines)), odd_bits(row, found, len(lines), WORDS)


def marked(texts: DataFrame) -> DataFrame:
    """Rows (node, text) with size and bits of their shingle sets; see graph.linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind in (K, K_SHORT):
                part = batch.filter(pa.array([kind_of(n) == kind for n in batch.column(0).to_pylist()], pa.bool_()))
                if part.num_rows:
                    sizes, bits = marks_of(part.column(1).to_pylist(), kind)
                    lists = pa.ListArray.from_arrays(np.arange(0, (len(bits) + 1) * WORDS, WORDS, dtype=np.int32), pa.array(bits.ravel()))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes.astype(np.int32)), lists], ["node", "text", "size", "bits"])

    return in_batches(texts.select("node", "text")).mapInArrow(run, "node long, text string, size int, bits array<long>")


def kind_of(node: int) -> int:
    return K_SHORT if node & 1 else K


def shingles(line: str, k: int) -> set[str]:
    return {line[i : i + k] for i in range(len(line) - k + 1)}


def similar(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, x, y) whose lines x and y have a Jaccard similarity of percent or more, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, x, y in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                s, t = shingles(x, kind_of(a)), shingles(y, kind_of(a))
                common = len(s & t)
                keep.append(100 * common >= percent * (len(s) + len(t) - common) > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return in_batches(pairs.select("a", "b", "x", "y")).mapInArrow(run, "a long, b long")


def differences(pairs: DataFrame) -> DataFrame:
    """Rows (lead, node, lead_size, size, elements) of (lead, node, x, y): what one has and the other has not; see graph.linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lead, x, y in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                s, t = (np.unique(shingle_hashes(codes(line), kind_of(lead))) for line in (x, y))
                rows.append((len(s), len(t), np.setxor1d(s, t, True).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.list_(pa.int64())), strict=True))], ["lead", "node", "lead_size", "size", "elements"])

    return in_batches(pairs.select("lead", "node", "x", "y")).mapInArrow(run, "lead long, node long, lead_size int, size int, elements array<long>")


def duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, line): the lines of docs (doc_id, text) that do not stay."""
    return not_staying(docs, percent).select("doc_id", "line")


def links_of(lines: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between nodes of line_table(), as many as components need."""
    made: list[str] = []
    node = F.col("node").bitwiseOR(F.when(F.col("set.kind") == K_SHORT, 1).otherwise(0).cast("long"))
    sets = lines.select("node", F.explode_outer("sets").alias("set")).where("set is not null").withColumn("node", node)
    index = sets.select(F.explode_outer("set.bands").alias("bucket"), "node").where("bucket is not null")
    about = sets.select("node", F.struct("set.low", "set.high").alias("sketch"))

    def verifier(nodes: DataFrame):
        made.append(f"texts-{len(made)}")
        texts = scratch.write(marked(line_texts(lines, nodes)), made[-1])

        def both(pairs: DataFrame, a: str, b: str) -> DataFrame:
            return pairs.join(texts.select(F.col("node").alias(a), F.col("text").alias("x")), a).join(texts.select(F.col("node").alias(b), F.col("text").alias("y")), b).select(a, b, "x", "y")

        return lambda pairs: similar(both(pairs, "a", "b"), percent), lambda pairs: differences(both(pairs, "lead", "node")), texts.select("node", "size", "bits")

    found = linked(index, about, percent, verifier, scratch, WORDS)
    return found.select(base("a").alias("a"), base("b").alias("b"))


def not_staying(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """duplicates() with own(), by which rows of one doc_id are told apart. All tables on the way to this one are dropped."""
    stays, scratch = Scratch(docs.sparkSession, "lines-gone"), Scratch(docs.sparkSession, "lines")
    lines = scratch.write(line_table(docs), "lines")
    links = links_of(lines, percent, scratch)
    each = lines.select("doc_id", "own", "line", "key", "node")
    if is_empty(links):
        grouped = each.withColumn("group", F.col("key"))
    else:
        of = components(links, scratch).select(F.col("id").alias("node"), "component")
        grouped = with_few(each, of, "node", "left").withColumn("group", F.coalesce(F.col("component").cast("string").cast("binary"), "key"))
    at = F.struct("doc_id", "own", "line")
    first = grouped.groupBy("group").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last").select("group", "first")
    gone = stays.write(grouped.join(first, "group").where(at != F.col("first")).select("doc_id", "own", "line").distinct(), "gone")
    scratch.drop()
    return gone


def kept_text(text: str, dropped: str) -> Column:
    """The text of a column without the lines whose numbers stand in another one."""
    return F.expr(f"if(coalesce(size({dropped}), 0) = 0, {text}, array_join(filter(split({text}, '\\n'), (x, i) -> not array_contains({dropped}, i)), '\\n'))")


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with their lines of duplicates() taken out of text, and dropped, the numbers of these (null: none)."""
    gone = not_staying(docs, percent).groupBy(F.col("doc_id").alias("__of"), F.col("own").alias("__own")).agg(F.array_sort(F.collect_list("line")).alias("dropped"))
    n, numbers = gone.agg(F.count(F.lit(1)), F.sum(F.size("dropped"))).first()
    if n <= GONE_ROWS and (numbers or 0) <= GONE_NUMBERS:
        gone = F.broadcast(gone)  # so the texts need no shuffle; 24 bytes a row and 4 a number
    rest = docs.drop("dropped")
    both = rest.join(gone, rest["doc_id"].eqNullSafe(gone["__of"]) & (own() == gone["__own"]), "left").drop("__of", "__own")
    return both.withColumn("text", kept_text("text", "dropped"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.array_join("dropped", ",").alias("dropped_lines"), F.crc32("text").alias("text_crc32"), F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op2_line_dedup": op2_line_dedup}
ORACLES: dict[str, str] = {}
