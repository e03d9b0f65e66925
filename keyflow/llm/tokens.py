"""Token ids in binary files, coded by a static range asymmetric numeral system (rANS).

Three passes. Texts are tokenized where they lie and the ids written as a table, with each task's counts of ids. The
counts over all documents make one frequency table. The ids are then dealt out by ranges of doc_id, sorted, and each
task codes its range into files: a header, the shared table, and independent blocks. A block has its documents' ids
and lengths, ``lanes`` coder states side by side (symbol i belongs to lane i % lanes) and a CRC; blocks start anew, so
each is a checkpoint from which a reader can begin. Files say which range they belong to and how many ids came before
them in it; the reader adds the ids of all earlier ranges.

Null and empty texts have the end id only. A null doc_id sorts first. Repeated rows are stored one by one; rows of one
doc_id are in order of their ids.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm.common import Scratch, held, in_batches, shared_folder, table

END_ID, BITS, LANES = 2, 18, 4096
BLOCK_TOKENS, FILE_TOKENS, RANGE_TOKENS = 1 << 20, 4 << 20, 8 << 20
CACHE_WORDS, TAILS = 1_000_000, ".,;:!?"
OTHER_SPACE = re.compile(r"[^\S\n]")
MAGIC = b"KFTOKEN1"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves, others from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(sorted(set(range(256)).difference(plain)))}


_BYTE_LETTERS = _byte_letters()


class WordTokenizer:
    """Encodes texts with the tokenizers library, once for each unit of a bounded cache.

    A byte-level pre-tokenizer never joins what stands before a single blank or line end with what stands behind it, so
    a text is units one after another: a word with the blank before it, or a line end and the word behind it. Other
    tokenizers, texts with other runs of white space, or with a special token in a unit, are encoded whole. A new unit of
    letters alone is one part to the pre-tokenizer, so it goes to the library's model as it is; other new units are
    encoded together, with line ends between them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.wide = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.wide.itemsize == 2 else "I"
        self.cache: dict[str, bytes | bool] = {}
        about = json.loads(self.tokenizer.to_str())
        parts = [about["pre_tokenizer"] or {}]
        self.by_units = parts[0].get("type") == "ByteLevel" and parts[0].get("use_regex", True) and not parts[0].get("add_prefix_space") and not about["normalizer"]
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.by_units = self.by_units and len(self.line_end) == 1
        self.tails = dict(zip(TAILS, self._ids(list(TAILS)), strict=True))
        self.end = np.array(self.line_end, self.wide).tobytes()
        self.model = self.tokenizer.model

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: set[str]) -> None:
        # a mark behind a letter or digit starts a part of its own
        marked = [u for u in units if u[-1:] in self.tails and u[-2:-1].isalnum()]
        units = units.difference(marked) | {u[:-1] for u in marked}
        units -= self.cache.keys()
        self.cache.update(dict.fromkeys(units & {"", "\n"}, False))
        units -= {"", "\n"}
        everything = "\n".join(units)
        special = [s for s in self.special if s in everything]
        if special or OTHER_SPACE.search(everything):
            others = [u for u in units if OTHER_SPACE.search(u) or any(s in u for s in special)]
            units.difference_update(others)
            # parts of their own unless they start with white space or hold a special token
            bad = [u for u in others if u[u[0] == "\n"].isspace() or any(s in u for s in special)]
            self.cache.update(dict.fromkeys(bad, False))
            others = sorted(set(others).difference(bad))
            self.cache.update(zip(others, self._ids([u if u[0] == "\n" else " " + u for u in others]), strict=True))
        letters = [u for u in units if u.isalpha() or u[0] == "\n" and u[1:].isalpha()]
        self.cache.update(zip(letters, map(self._of_letters, letters), strict=True))
        end, k, plain = self.end, self.wide.itemsize, list(units.difference(letters))
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            text = "\n".join([u[1:] if u[0] == "\n" else " " + u for u in some])
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.wide)
            ends = (k * np.append(np.flatnonzero(ids == self.line_end[0]), len(ids))).tolist()
            raw, starts = ids.tobytes(), [0, *[e + k for e in ends]]
            self.cache.update(zip(some, [end + raw[i:j] if u[0] == "\n" else raw[i:j] for u, i, j in zip(some, starts, ends, strict=False)], strict=True))
        for u in marked:
            ids = self.cache[u[:-1]]
            self.cache[u] = ids + self.tails[u[-1]] if ids else False

    def _of_letters(self, unit: str) -> bytes:
        head, part = (self.end, unit[1:]) if unit[0] == "\n" else (b"", " " + unit)
        part = part.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return head + array(self.code, [t.id for t in self.model.tokenize(part)]).tobytes()

    @staticmethod
    def units(text: str) -> list[str]:
        return ("\n" + text.replace("\n", " \n")).split(" ")

    def _joined(self, text: str, parts: list[bytes | bool | None]) -> bytes:
        try:
            return b"".join(parts)[self.wide.itemsize :]
        except TypeError:  # a unit that is none of its own, or that the cache has lost
            return self._ids([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text. Units are looked up once; those that are new are learnt together, and their texts looked up again."""
        if not self.by_units:
            return [self._ids([text])[0] if text else b"" for text in texts]
        get, out, again, new = self.cache.get, [], [], set()
        for text in texts:
            if not text:
                out.append(b"")
                continue
            units = self.units(text)
            parts = list(map(get, units))
            if None in parts:
                new.update(u for u, p in zip(units, parts, strict=True) if p is None)
                again.append((len(out), text, units))
                out.append(b"")
            else:
                out.append(self._joined(text, parts))
        if again:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
                new.update(u for _, _, units in again for u in units)
            self._learn(new)
            for at, text, units in again:
                out[at] = self._joined(text, list(map(get, units)))
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


def tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, which Spark uses again for other tasks."""
    return held(("tokens", path), lambda: WordTokenizer(path))


TOKENS = "doc_id long, n_tokens long, ids binary, symbols array<int>, counts array<long>"


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """A row for each of docs (doc_id, text): its ids, end id last. And one for each task, with symbols and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        end = np.array([end_id], t.wide).tobytes()
        total = np.zeros(1, np.int64)
        names, types = ["doc_id", "n_tokens", "ids", "symbols", "counts"], [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(1).to_pylist()
                ids = [x + end for x in t.encode_all(texts)]
                seen = np.bincount(np.frombuffer(b"".join(ids), t.wide), minlength=len(total))
                seen[: len(total)] += total
                total = seen
                nothing = [None] * len(ids)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(([len(x) // t.wide.itemsize for x in ids], ids, nothing, nothing), types[1:], strict=True))], names)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(([None], [None], [None], [some], [total[some]]), types, strict=True)], names)

    return in_batches(docs.select("doc_id", "text")).mapInArrow(run, TOKENS)


class Frequencies:
    """Counts of ids scaled to 2 ** BITS slots; each id that occurs has one at least."""

    def __init__(self, symbols: np.ndarray, counts: np.ndarray):
        self.symbols, self.slots = symbols.astype(np.uint32), self._scaled(counts)
        self.start = np.concatenate([[0], np.cumsum(self.slots)])[:-1].astype(np.uint64)
        self.index = np.full(int(symbols.max()) + 1, -1, np.int64)
        self.index[symbols] = np.arange(len(symbols))
        self.of_slot = np.repeat(np.arange(len(symbols), dtype=np.int32), self.slots.astype(np.int64))

    @staticmethod
    def _scaled(counts: np.ndarray) -> np.ndarray:
        size = 1 << BITS
        # one slot stays free, so that no id fills the range: its state could not be renormalized in 64 bits
        slots = np.maximum(1, counts.astype(np.float64) / counts.sum() * (size - 1 - len(counts))).astype(np.int64)
        slots[int(np.argmax(counts))] += size - 1 - slots.sum()
        return slots.astype(np.uint64)

    @classmethod
    def of(cls, rows: list[tuple[int, int]]) -> Frequencies:
        rows = sorted(rows)
        return cls(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64))

    def packed(self) -> bytes:
        return zlib.compress(np.diff(self.symbols, prepend=0).astype("<u4").tobytes() + self.slots.astype("<u4").tobytes(), 6)

    @classmethod
    def unpacked(cls, data: bytes) -> Frequencies:
        both = np.frombuffer(zlib.decompress(data), "<u4")
        n = len(both) // 2
        out = cls.__new__(cls)
        out.symbols, out.slots = np.cumsum(both[:n], dtype=np.uint32), both[n:].astype(np.uint64)
        out.start = np.concatenate([[0], np.cumsum(out.slots)])[:-1].astype(np.uint64)
        out.of_slot = np.repeat(np.arange(n, dtype=np.int32), both[n:])
        return out


def encode(ids: np.ndarray, table_: Frequencies, lanes: int = LANES) -> tuple[int, bytes]:
    """(lanes used, states and words). Encoded backwards, so that decoding runs forwards."""
    n = len(ids)
    lanes = max(1, min(lanes, n // 256))
    s = table_.index[ids]
    f, c = table_.slots[s], table_.start[s]
    most = f << np.uint64(64 - BITS)
    x = np.full(lanes, 1 << 32, np.uint64)
    words = []
    for at in range((n - 1) // lanes * lanes, -1, -lanes) if n else ():
        end = min(at + lanes, n)
        y, g = x[: end - at], f[at:end]
        full = y >= most[at:end]
        if full.any():
            words.append((y[full] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
            y = np.where(full, y >> np.uint64(32), y)
        q = y // g
        x[: end - at] = (q << np.uint64(BITS)) + (y - q * g) + c[at:end]
    return lanes, x.astype("<u8").tobytes() + b"".join(reversed(words))


def decode(data: bytes, n: int, lanes: int, table_: Frequencies) -> np.ndarray:
    x = np.frombuffer(data, "<u8", lanes).astype(np.uint64)
    words = np.frombuffer(data, "<u4", offset=8 * lanes).astype(np.uint64)
    out, at_word, mask = np.empty(n, np.uint32), 0, np.uint64((1 << BITS) - 1)
    for at in range(0, n, lanes):
        end = min(at + lanes, n)
        y = x[: end - at]
        slot = y & mask
        s = table_.of_slot[slot.astype(np.int64)]
        out[at:end] = table_.symbols[s]
        y = table_.slots[s] * (y >> np.uint64(BITS)) + slot - table_.start[s]
        low = np.flatnonzero(y < np.uint64(1 << 32))
        y[low] = (y[low] << np.uint64(32)) | words[at_word : at_word + len(low)]
        at_word += len(low)
        x[: end - at] = y
    return out


def pack_block(docs: list[tuple[int | None, bytes]], wide: np.dtype, table_: Frequencies) -> bytes:
    """Length and CRC of what follows; then documents, lanes, ids and codes."""
    names = np.array([d if d is not None else 0 for d, _ in docs], "<i8")
    null = np.packbits([d is None for d, _ in docs]).tobytes()
    sizes = np.array([len(x) // wide.itemsize for _, x in docs], "<u4")
    ids = np.frombuffer(b"".join(x for _, x in docs), wide).astype(np.int64)
    lanes, codes = encode(ids, table_)
    meta = zlib.compress(np.diff(names, prepend=0).astype("<i8").tobytes() + sizes.tobytes() + null, 1)
    body = struct.pack("<IIQII", len(docs), lanes, len(ids), len(meta), zlib.crc32(ids.astype("<u4").tobytes())) + meta + codes
    return struct.pack("<QI", len(body), zlib.crc32(body)) + body


def unpack_block(data: bytes, at: int, table_: Frequencies) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """(doc_ids, sizes, ids, where the next block starts); both checksums are compared."""
    length, crc = struct.unpack_from("<QI", data, at)
    at += 12
    body = data[at : at + length]
    if zlib.crc32(body) != crc:
        raise ValueError("a block of a token file is damaged")
    n_docs, lanes, n, n_meta, crc_ids = struct.unpack_from("<IIQII", body)
    meta = zlib.decompress(body[24 : 24 + n_meta])
    names = np.cumsum(np.frombuffer(meta, "<i8", n_docs))
    sizes = np.frombuffer(meta, "<u4", n_docs, 8 * n_docs)
    null = np.unpackbits(np.frombuffer(meta, np.uint8, offset=12 * n_docs))[:n_docs]
    ids = decode(body[24 + n_meta :], n, lanes, table_)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc_ids:
        raise ValueError("the ids of a block differ from those encoded")
    return [None if z else int(d) for d, z in zip(names, null, strict=True)], sizes, ids, at + length


def file_of(part: int, before: int, blocks: list[bytes], packed: bytes) -> bytes:
    head = struct.pack("<IQII", part, before, len(blocks), len(packed))
    return MAGIC + head + packed + b"".join(blocks)


def write_files(tokens: DataFrame, table_: Frequencies, total: int, wide: str, folder: str) -> None:
    """Write rows (doc_id, ids) in ascending doc_id order: ranges by task, files in each by the ids before them."""
    wide_, packed = np.dtype(wide), table_.packed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, done, blocks, docs, held = TaskContext.get().partitionId(), 0, 0, [], [], 0
        put = lambda: pa.RecordBatch.from_arrays([pa.array([file_of(part, before, blocks, packed)], pa.binary())], ["content"])
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs.append((doc, ids))
                held += len(ids) // wide_.itemsize
                if held >= BLOCK_TOKENS:
                    blocks.append(pack_block(docs, wide_, table_))
                    done, docs, held = done + held, [], 0
                    if done - before >= FILE_TOKENS:
                        yield put()
                        before, blocks = done, []
        if docs:
            blocks.append(pack_block(docs, wide_, table_))
        if blocks:
            yield put()

    ranges = max(1, -(-total // RANGE_TOKENS))
    rows = tokens.select("doc_id", "ids").repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "ids").mapInArrow(run, "content binary")
    rows.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(folder)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document: doc_id, part, part_start (ids before it in its range), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                if data[:8] != MAGIC:
                    raise ValueError("not a token file")
                part, start, n_blocks, n_packed = struct.unpack_from("<IQII", data, 8)
                at = 28 + n_packed
                table_ = Frequencies.unpacked(data[28:at])
                for _ in range(n_blocks):
                    docs, sizes, ids, at = unpack_block(data, at, table_)
                    raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(sizes, dtype=np.int64)
                    starts = ends - sizes
                    crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs, pa.int64()), pa.array(np.full(len(docs), part), pa.int32()), pa.array(starts + start), pa.array(sizes.astype(np.int64)), pa.array(crcs, pa.int64())],
                        ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"],
                    )
                    start += int(ends[-1])

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")


def store(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> None:
    """Tokenize docs (doc_id, text) and write the files into a new folder."""
    scratch = Scratch(docs.sparkSession, "tokens")
    rows = scratch.write(tokenized(docs, path, end_id), "ids")
    counted = rows.where("symbols is not null").select(F.explode(F.arrays_zip("symbols", "counts")).alias("x")).groupBy("x.symbols").agg(F.sum("x.counts").alias("n")).collect()
    if counted:  # a row for each id of the vocabulary at most
        total = sum(r["n"] for r in counted)
        write_files(rows.where("symbols is null"), Frequencies.of([tuple(r) for r in counted]), total, WordTokenizer(path).wide.str, folder)
    scratch.drop()


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the files with start, the ids of all documents before them."""
    rows = Scratch(spark, "token-index").write(read_files(spark, folder), "rows")
    sums, base, before = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect(), [], 0
    for r in sums:  # a row for each range, of RANGE_TOKENS ids
        base.append((r["part"], before))
        before += r["n"]
    bases = spark.createDataFrame(base, "part int, base long")
    return rows.join(F.broadcast(bases), "part", "left").select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_folder(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    store(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    if docs.take(1):
        return read_store(spark, folder)
    return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")


QUERIES = {"op4_token_files": op4_token_files}
ORACLES: dict[str, str] = {}
