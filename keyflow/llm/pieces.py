"""SentencePiece encoding and decoding with N-best segmentation.

A text is its pieces' lattice; a path's score is the sum of its pieces' scores. A forward Viterbi pass gives the best
score to each place, which is the exact cost of what is left when paths are built backwards from the end, so A* takes
them off its heap in order of their total and the first ``N_BEST`` that arrive are the best.

The public model is one of BPE, whose scores are the ranks of its merges, so the best path by scores is in general not
the segmentation that merging gives: these are the n best of the lattice, not the library's ids.

No piece holds a blank behind another character, nor a line end, so the lattice of a text falls apart at its words. New words go
through forward and backward Viterbi together, in arrays, into a bounded cache: best path, score, and the loss of the
second best. In a text's N best only the N - 1 words whose second path costs least can deviate; these are searched by
A* and combined. Characters without a piece become byte pieces, below every other score.

Null and empty texts have no pieces, score 0 and one path. A text that holds the blank's own sign does not come back
from decoding. Equal scores are ordered by the search, which is
deterministic. Repeated rows are encoded one by one; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm.common import held, in_batches, table

N_BEST, CACHE_WORDS, BLANK = 4, 500_000, "▁"
HASH, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(44)


class Pieces:
    def __init__(self, path: str, n_best: int = N_BEST):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_best, ids = n_best, range(sp.get_piece_size())
        usable = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.piece = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in usable}
        self.longest = max(map(len, self.piece))
        self.tails = {c for c in ".,;:!?" if not any(p[i - 1].isalnum() for p in self.piece for i in range(1, len(p)) if p[i] == c)}
        self.ends_part = not any("\n" in p and len(p) > 1 for p in self.piece)
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        self.byte_score = min(s for _, s in self.piece.values()) - 10
        for c in range(128):  # an ASCII character without a piece is one byte piece
            self.piece.setdefault(chr(c), (self.byte[c], self.byte_score))
        self.raw = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else sp.id_to_piece(i).replace(BLANK, " ").encode() for i in ids]
        self.known = np.array(sorted(ord(p) for p in self.piece if len(p) == 1), np.uint32)
        self.power = [np.uint64(pow(int(HASH), k, 1 << 64)) for k in range(self.longest + 1)]
        self.by_size = {}
        for size in range(1, self.longest + 1):
            rows = sorted((self._hash(p), i, s) for p, (i, s) in self.piece.items() if len(p) == size)
            keys = np.array([r[0] for r in rows], np.uint64)
            likely = np.zeros(1 << 20, bool)  # by the first 20 bits of a hash; most strings are no piece
            likely[keys >> SHIFT] = True
            self.by_size[size] = (keys, np.array([r[1] for r in rows], np.uint16), np.array([r[2] for r in rows]), likely)
            assert len({r[0] for r in rows}) == len(rows)
        self.number: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.score, self.loss, self.size = np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
        self.searched: dict[str, list] = {}

    @staticmethod
    def _hash(piece: str) -> int:
        out = 0
        for c in piece:
            out = (out * int(HASH) + ord(c)) % (1 << 64)
        return out

    def lattice(self, word: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each end, the (start, score, ids) of the pieces that end there."""
        get, longest, ends = self.piece.get, self.longest, [[]]
        for end in range(1, len(word) + 1):
            edges = [(start, p[1], (p[0],)) for start in range(max(0, end - longest), end) if (p := get(word[start:end]))]
            if not edges or edges[-1][0] != end - 1:
                raw = word[end - 1].encode()
                edges.append((end - 1, len(raw) * self.byte_score, tuple(self.byte[b] for b in raw)))
            ends.append(edges)
        return ends

    def best(self, word: str, n: int | None = None) -> list[tuple[float, tuple[int, ...]]]:
        """The n best (score, ids) of a word, best first."""
        n, ends = n or self.n_best, self.lattice(word)
        forward = [0.0]
        for edges in ends[1:]:
            forward.append(max([forward[start] + score for start, score, _ in edges]))
        heap, order, found = [(-forward[-1], len(word), 0, 0.0, None)], 0, []
        while heap and len(found) < n:
            total, at, _, behind, path = heapq.heappop(heap)
            if at == 0:
                ids = []
                while path:
                    ids += path[0]
                    path = path[1]
                found.append((-total, tuple(ids)))
                continue
            for start, score, ids in ends[at]:
                order += 1
                heapq.heappush(heap, (-(forward[start] + score + behind), start, order, score + behind, (ids, path)))
        return found

    def paths(self, word: str) -> list[tuple[float, tuple[int, ...]]]:
        """best(), kept for a while."""
        found = self.searched.get(word)
        if found is None:
            if len(self.searched) > CACHE_WORDS // 8:
                self.searched.clear()
            i, found = self.number.get(word), self.best(word)
            raw = self.viterbi([word], len(word))[0][0] if i is None else self.ids[i]
            first = tuple(np.frombuffer(raw, "<u2").tolist())
            if found[0][1] != first:  # equal scores: of these the one that encode() gives stands first
                found = [(found[0][0], first), *[p for p in found if p[1] != first][: self.n_best - 1]]
            self.searched[word] = found
        return found

    def learn(self, words: set[str]) -> None:
        """Put (ids of the best path, score, loss of the second best) of new words into the cache.

        No piece holds one of ``tails`` behind a letter or digit, so such a word is the one before the mark and the mark.
        """
        if len(self.number) + len(words) > CACHE_WORDS:
            self.number.clear()
            self.ids.clear()
            self.score, self.loss, self.size = np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
        ends = [w for w in words if w[-1] in self.tails and w[-2:-1].isalnum()]
        self._learn_whole((words.difference(ends) | {w[:-1] for w in ends} | {w[-1] for w in ends}) - self.number.keys())
        if ends:
            a, b = [self.number[w[:-1]] for w in ends], [self.number[w[-1]] for w in ends]
            for w, i, j in zip(ends, a, b, strict=True):
                self.number[w] = len(self.number)
                self.ids.append(self.ids[i] + self.ids[j])
            self.score = np.concatenate([self.score, self.score[a] + self.score[b]])
            self.loss = np.concatenate([self.loss, np.minimum(self.loss[a], self.loss[b])])
            self.size = np.concatenate([self.size, self.size[a] + self.size[b]])

    def _learn_whole(self, words: set[str]) -> None:
        scores, losses, had = [], [], len(self.ids)
        by_size: dict[int, list[str]] = {}
        for w in words:
            by_size.setdefault(len(w), []).append(w)
        for size, group in sorted(by_size.items()):
            for at in range(0, len(group), 20_000):
                some = group[at : at + 20_000]
                ids, score, loss = self.viterbi(some, size)
                for w in some:
                    self.number[w] = len(self.number)
                self.ids += ids
                scores.append(score)
                losses.append(loss)
        self.score, self.loss = np.concatenate([self.score, *scores]), np.concatenate([self.loss, *losses])
        self.size = np.concatenate([self.size, np.array([len(x) // 2 for x in self.ids[had:]], np.int64)])

    def meet(self, texts: list[str | None]) -> list[list[str]]:
        """The words of texts. The new ones are learnt together, which arrays are good for."""
        split = [self.words(text or "") for text in texts]
        new = set(itertools.chain.from_iterable(split)) - self.number.keys()
        if len(new) <= CACHE_WORDS:
            self.learn(new)
        return split

    def viterbi(self, words: list[str], size: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Forward and backward Viterbi over words of one size at once: ids of the best path, its score, loss of the second.

        The second best path leaves the best one by an edge, so it is the best path through some edge off it.
        """
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), size)
        known = np.isin(chars, self.known).all(axis=1)
        if size > 48 or not known.all():
            return self._one_by_one(words) if size > 48 else self._mixed(words, size, known)
        n, none = len(words), -np.inf
        prefix = np.zeros((size + 1, n), np.uint64)
        for i in range(size):
            prefix[i + 1] = prefix[i] * HASH + chars[:, i]
        forward, back, piece = np.full((size + 1, n), none), np.zeros((size + 1, n), np.int16), np.zeros((size + 1, n), np.uint16)
        forward[0] = 0
        edges: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for end in range(1, size + 1):
            for start in range(max(0, end - self.longest), end):
                keys, ids, piece_scores, likely = self.by_size[end - start]
                key = prefix[end] - prefix[start] * self.power[end - start]
                maybe = np.flatnonzero(likely[key >> SHIFT])
                if len(maybe):
                    key = key[maybe]
                    i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    same = keys[i] == key
                    hit, i = maybe[same], i[same]
                    edges[start, end] = hit, piece_scores[i]
                    total = forward[start, hit] + piece_scores[i]
                    better = total > forward[end, hit]
                    at = hit[better]
                    forward[end, at], back[end, at], piece[end, at] = total[better], start, ids[i[better]]
        behind, on = np.full((size + 1, n), none), np.zeros((size + 1, n), bool)
        behind[size], on[size] = 0, True
        second = np.full(n, none)
        for end in range(size, 0, -1):
            for start in range(end - 1, max(0, end - self.longest) - 1, -1):
                hit, score = edges.get((start, end), (None, None))
                if hit is not None and len(hit):
                    through = score + behind[end, hit]
                    behind[start, hit] = np.maximum(behind[start, hit], through)
                    best = on[end, hit] & (back[end, hit] == start)
                    on[start, hit] |= best
                    second[hit] = np.maximum(second[hit], np.where(best, none, through + forward[start, hit]))
        mask = on[1:].T
        raw, ends = piece[1:].T[mask].astype("<u2").tobytes(), (2 * np.cumsum(mask.sum(axis=1))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], forward[size], forward[size] - second

    def _one_by_one(self, words: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        found = [self.best(w, 2) for w in words]
        losses = [p[0][0] - p[1][0] if len(p) > 1 else np.inf for p in found]
        return [np.array(p[0][1], "<u2").tobytes() for p in found], np.array([p[0][0] for p in found]), np.array(losses)

    def _mixed(self, words: list[str], size: int, known: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words with characters that no piece has are searched one by one."""
        ids: list[bytes] = [b""] * len(words)
        score, loss = np.zeros(len(words)), np.zeros(len(words))
        for where, run in ((np.flatnonzero(known), lambda w: self.viterbi(w, size)), (np.flatnonzero(~known), self._one_by_one)):
            if len(where):
                some, score[where], loss[where] = run([words[i] for i in where])
                for i, x in zip(where.tolist(), some, strict=True):
                    ids[i] = x
        return ids, score, loss

    def words(self, text: str) -> list[str]:
        """Parts of a text that no piece joins: words with their blanks, and line ends."""
        if not text:
            return []
        text = text.replace(BLANK, " ")
        if "  " in text or text[0] == " " or text[-1] == " " or not self.ends_part:
            line = "\n|" if self.ends_part else ""
            other = "\n" if self.ends_part else ""
            return re.findall(f"{BLANK}+[^{BLANK}{other}]*|{line}[^{BLANK}{other}]+", BLANK + text.replace(" ", BLANK))
        return list(filter(None, (BLANK + text.replace(" ", " " + BLANK)).replace("\n", " \n ").split(" ")))

    def encode(self, text: str | None, words: list[str] | None = None) -> tuple[np.ndarray, list[float], list[tuple]]:
        """(ids of the best path, scores of the n best, how each differs: (place of the word, which of its paths) ...)."""
        return self.search(text, words)[:3]

    def search(self, text: str | None, words: list[str] | None = None) -> tuple[np.ndarray, list[float], list[tuple], list[list]]:
        """encode(), and for each of the n best what differs from the ids of the best: (place, how many go, the ids that come) ..."""
        words = self.words(text or "") if words is None else words
        at = list(map(self.number.get, words))
        if None in at:
            self.learn({w for w, i in zip(words, at, strict=True) if i is None})
            at = list(map(self.number.get, words))
            if None in at:  # the cache was emptied
                self.learn(set(words) - self.number.keys())
                at = list(map(self.number.get, words))
            if None in at:  # more new words than it holds
                self.number.clear()
                self.ids.clear()
                self.score, self.loss, self.size = np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
                return self._large(words)
        return self._combined(words, b"".join(map(self.ids.__getitem__, at)), self.score[at].sum() if at else 0.0, self.loss[at], self.size[at])

    def _large(self, words: list[str]) -> tuple[np.ndarray, list[float], list[tuple], list[list]]:
        """A text with more different words than the cache holds."""
        ids, total, losses, sizes = [], 0.0, [], []
        for i in range(0, len(words), CACHE_WORDS // 2):
            some = words[i : i + CACHE_WORDS // 2]
            self.learn(set(some) - self.number.keys())
            at = list(map(self.number.get, some))
            if None in at:
                self.learn(set(some) - self.number.keys())
                at = list(map(self.number.get, some))
            ids.append(b"".join(map(self.ids.__getitem__, at)))
            total += self.score[at].sum()
            losses.append(self.loss[at])
            sizes.append(self.size[at])
        return self._combined(words, b"".join(ids), total, np.concatenate(losses), np.concatenate(sizes))

    def _combined(self, words: list[str], raw: bytes, total: float, losses: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[float], list[tuple], list[list]]:
        """Only the words whose second path costs least can deviate in one of the n best."""
        n, ids = self.n_best, np.frombuffer(raw, "<u2")
        near = np.flatnonzero(losses <= np.partition(losses, n - 2)[n - 2]) if len(losses) >= n and n > 1 else np.arange(len(losses))
        near = sorted(near[np.isfinite(losses[near])].tolist(), key=lambda i: (losses[i], i))[: n - 1]
        ways = [(0.0, ())]
        for i in near:
            paths = self.paths(words[i])
            ways = sorted((loss + paths[0][0] - s, how + (((i, k),) if k else ())) for loss, how in ways for k, (s, _) in enumerate(paths))[:n]
        ends = np.cumsum(sizes) if len(ways) > 1 else ()
        changes = [[(int(ends[i] - sizes[i]), int(sizes[i]), self.paths(words[i])[k][1]) for i, k in sorted(how)] for _, how in ways]
        return ids, [float(total) - loss for loss, _ in ways], [how for _, how in ways], changes

    def path(self, text: str, how: tuple) -> list[int]:
        """All ids of one of the n best."""
        which = dict(how)
        return [i for at, w in enumerate(self.words(text)) for i in self.paths(w)[which.get(at, 0)][1]]

    def decode(self, ids) -> str:
        raw = b"".join([self.raw[i] for i in ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def pieces(path: str, n_best: int = N_BEST) -> Pieces:
    """One for each Python worker."""
    return held(("pieces", path, n_best), lambda: Pieces(path, n_best))


PATHS = "array<struct<score: double, n_pieces: long, ids_crc32: long, decodes: boolean, changes: array<struct<at: int, gone: int, ids: array<int>>>>>"
ENCODED = f"doc_id long, n_pieces long, n_paths long, best_score double, last_score double, ids_crc32 long, decodes boolean, paths {PATHS}"
_CHANGE = pa.struct([("at", pa.int32()), ("gone", pa.int32()), ("ids", pa.list_(pa.int32()))])
_PATH = pa.struct([("score", pa.float64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("decodes", pa.bool_()), ("changes", pa.list_(_CHANGE))])


def changed(ids: np.ndarray, changes: list[tuple]) -> np.ndarray:
    """The ids of another path from those of the best."""
    out, done = [], 0
    for at, gone, new in changes:
        out += [ids[done:at], np.array(new, ids.dtype)]
        done = at + gone
    return np.concatenate([*out, ids[done:]])


def path_ids(rank: int) -> Column:
    """The ids of the path of a rank (0: the best) of encoded(with_ids=True); null if a text has fewer paths."""
    # from the last change to the first, so that places hold
    return F.expr(
        f"if(size(paths) > {rank}, aggregate(reverse(get(paths, {rank}).changes), ids, (x, c) -> concat(slice(x, 1, c.at), c.ids, slice(x, c.at + c.gone + 1, size(x)))), null)"
    )


def encoded(docs: DataFrame, path: str, n_best: int = N_BEST, with_ids: bool = False) -> DataFrame:
    """Per row of docs (doc_id, text): the best path's size, CRC and (with_ids) ids, the scores of the best and the last
    of the n best, whether decoding gives the text back, and paths.

    paths has all n best, best first: score, size, CRC of the ids, whether they decode to the text, and what differs
    from the best path's ids: from place ``at``, ``gone`` ids make way for others (path_ids() puts them in).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, n_best)
        plain = lambda ids: b"".join([model.raw[i] for i in ids])
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows, all_ids = batch.slice(at, 500), [], []
                texts = part.column(1).to_pylist()
                for text, words in zip(texts, model.meet(texts), strict=True):
                    ids, scores, _, changes = model.search(text, words)
                    flat, want, paths = ids.tolist(), text or "", []
                    good = model.decode(flat) == want
                    for score, change in zip(scores, changes, strict=True):
                        # where each change has the bytes of what it replaces, all bytes are those of the best path
                        same = all(plain(flat[a : a + gone]) == plain(new) for a, gone, new in change)
                        other = changed(ids, change)
                        crc = zlib.crc32(other.astype("<u4").tobytes())
                        paths.append((score, len(other), crc, good if same else model.decode(other.tolist()) == want, change))
                    rows.append((len(flat), len(scores), scores[0], scores[-1], paths[0][2], good, [dict(zip(_PATH.names, (*p[:4], [dict(zip(_CHANGE.names, c, strict=True)) for c in p[4]]), strict=True)) for p in paths]))
                    all_ids.append(flat)
                types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_(), pa.list_(_PATH))
                columns = [part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))]
                names = ["doc_id", "n_pieces", "n_paths", "best_score", "last_score", "ids_crc32", "decodes", "paths"]
                if with_ids:
                    columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return in_batches(docs.select("doc_id", "text")).mapInArrow(run, ENCODED + (", ids array<int>" if with_ids else ""))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op3_sentencepiece": op3_sentencepiece}
ORACLES: dict[str, str] = {}
