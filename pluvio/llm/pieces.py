"""SentencePiece encoding and decoding with seeded merge-dropout.

Pieces are made by merges: the pair of neighbours whose union has the best score merges first, the leftmost of equals. With
dropout, each candidate merge is skipped when a keyed hash of the seed, the doc_id, the word's place in the text and the candidate's
place in the word falls below the rate: every occurrence of a word is drawn by itself, and every run draws alike. Any segmentation
decodes to the text: what has no piece becomes byte pieces. Vocabulary files are read, never trained; their path is a parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, mapped, mix64

SPACE = "▁"
DROPOUT, SEED = 0.1, 17
LONG_WORD, ROWS = 40, 20_000
_NONE = np.int32(2**31 - 1)
_STRANGE = 1 << 24  # symbols from here on are characters that no piece holds


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary: symbols are pieces and the single characters that pieces hold; merges map pairs of symbols to pieces."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        usable = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        if n > 1 << 16:
            raise ValueError(f"{path} has {n} pieces; ids are stored in 16 bits")
        self.size = n
        self.bytes_of = [b""] * n
        self.byte_ids = [0] * 256
        for i in range(n):
            if sp.is_byte(i):
                value = int(names[i][3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
            elif usable[i]:
                self.bytes_of[i] = names[i].replace(SPACE, " ").encode("utf-8")
        self.symbols = {names[i].replace(SPACE, " "): i for i in range(n) if usable[i]}
        scores = sorted({sp.get_score(i) for i in self.symbols.values()}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        for c in sorted({c for x in self.symbols for c in x} - set(self.symbols)):
            self.symbols[c] = n + len(self.symbols)
        pairs = {}
        for x, i in list(self.symbols.items()):
            for cut in range(1, len(x)):
                a, b = self.symbols.get(x[:cut]), self.symbols.get(x[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = (rank[sp.get_score(i)], i)
        self.pairs = pairs
        self.chars = {x: i for x, i in self.symbols.items() if len(x) == 1}
        keys = np.array([(a << 32) + b + 1 for a, b in pairs], np.uint64)
        bits = max(12, int(len(keys) * 4).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        table, at = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        slot = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):  # linear probing, all keys at once
            free = todo[table[slot[todo]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            table[slot[put]], at[slot[put]] = keys[put], put
            todo = np.setdiff1d(todo, put)
            slot[todo] = (slot[todo] + 1) & self._mask
        self._table, self._at = table, at
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        self._rank, self._piece = values[:, 0], values[:, 1]

    def merges(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score's rank (_NONE: no merge) and the piece of each pair."""
        key = ((a.astype(np.uint64) << np.uint64(32)) + b.astype(np.uint64) + np.uint64(1)).ravel()
        slot = ((key * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)
        rank, piece = np.full(len(key), _NONE), np.zeros(len(key), np.int32)
        todo = np.arange(len(key))
        while len(todo):
            found = self._table[slot[todo]]
            hit = found == key[todo]
            i = todo[hit]
            e = self._at[slot[i]]
            rank[i], piece[i] = self._rank[e], self._piece[e]
            todo = todo[~hit & (found != 0)]
            slot[todo] = (slot[todo] + 1) & self._mask
        return rank.reshape(a.shape), piece.reshape(a.shape)

    def _skipped(self, lane: np.ndarray, begin: np.ndarray, middle: np.ndarray, end: np.ndarray, rate: float) -> np.ndarray:
        place = (begin.astype(np.uint64) << np.uint64(42)) | (middle.astype(np.uint64) << np.uint64(21)) | end.astype(np.uint64)
        return (mix64(mix64(place) + lane) >> np.uint64(32)) < np.uint64(int(rate * 2**32))

    def encode_points(self, points: np.ndarray, starts: np.ndarray, lanes: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words, one after the other, and where each word's begin.

        ``points`` are the words' code points, with a space for the vocabulary's own mark; ``starts`` where each word begins, and the end."""
        distinct = np.flatnonzero(np.bincount(points, minlength=1))
        ids = np.array([self.chars.get(chr(c), _STRANGE + i) for i, c in enumerate(distinct)], np.int64)
        dense = np.zeros(int(distinct[-1]) + 1 if len(distinct) else 1, np.int32)
        dense[distinct] = np.arange(len(distinct))
        place = dense[points]
        first = self.merges(np.repeat(ids, len(ids)), np.tile(ids, len(ids))) if len(ids) <= 1024 else None
        symbols = ids.astype(np.int32)[place]
        length = np.diff(starts)
        many = np.zeros(len(length), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, and their ids row by row with a mask
        order = np.argsort(length, kind="stable")
        cuts = np.searchsorted(length[order], np.arange(1, LONG_WORD + 2))
        for n, (i, j) in enumerate(zip(cuts, cuts[1:]), 1):
            for k in range(i, j, ROWS):
                words = order[k : min(k + ROWS, j)]
                at = starts[words][:, None] + np.arange(n)
                s = symbols[at]
                if n > 1:
                    if first is not None:
                        pair = place[at[:, :-1]].astype(np.int64) * len(ids) + place[at[:, 1:]]
                        rank, piece = first[0][pair], first[1][pair]
                    else:
                        rank, piece = self.merges(s[:, :-1], s[:, 1:])
                    alive, after = self._merge(s, rank, piece, lanes[words], rate)
                else:
                    alive, after = np.ones(s.shape, np.bool_), np.ones(s.shape, np.int64)
                odd = np.flatnonzero(((s >= self.size) & alive).any(axis=1))
                if len(odd):
                    for r in odd.tolist():
                        spans = [(int(s[r, c]), c, int(after[r, c])) for c in np.flatnonzero(alive[r])]
                        parts.append((words[r : r + 1], *self._spelled(spans, points[at[r]])))
                    plain = np.setdiff1d(np.arange(len(words)), odd)
                    words, s, alive = words[plain], s[plain], alive[plain]
                parts.append((words, s, alive))
        for w in order[cuts[-1] :].tolist():
            own = points[starts[w] : starts[w + 1]]
            parts.append((np.array([w]), *self._spelled(self._agenda(_text(own), lanes[w : w + 1], rate), own)))
        for words, _, alive in parts:
            many[words] = alive.sum(axis=1)
        begin = np.concatenate(([0], np.cumsum(many)))
        out = np.empty(begin[-1], np.uint16)
        for words, s, alive in parts:
            to = begin[words][:, None] + np.cumsum(alive, axis=1) - 1
            out[to[alive]] = s[alive]
        return out, begin

    def _spelled(self, spans: list[tuple[int, int, int]], points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One row of ids; a symbol that is no piece becomes its bytes."""
        ids: list[int] = []
        for symbol, a, b in spans:
            ids += [symbol] if 0 <= symbol < self.size else [self.byte_ids[x] for x in _text(points[a:b]).encode("utf-8", "surrogatepass")]
        return np.array([ids], np.int32), np.ones((1, len(ids)), np.bool_)

    def _merge(self, s: np.ndarray, rank: np.ndarray, piece: np.ndarray, lane: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """Words of one length at once, a row each: every round merges each unfinished word's best candidate, in place.

        ``s`` holds a symbol where it begins. Gives where symbols begin, and where the next one does."""
        n, width = s.shape
        column = np.arange(width, dtype=np.int64)
        flat, after, before = s.reshape(-1), np.tile(column + 1, n), np.tile(column - 1, n)
        alive = np.ones(n * width, np.bool_)
        wide = np.full((n, width), _NONE, np.int32)
        wide[:, :-1] = rank
        made = np.zeros((n, width), np.int32)
        made[:, :-1] = piece
        made = made.reshape(-1)
        if rate:
            wide[:, :-1][self._skipped(lane[:, None], column[None, :-1], column[None, 1:], column[None, 1:] + 1, rate)] = _NONE
        base, todo = np.arange(n) * width, np.arange(n)
        while len(todo):
            rows = wide if len(todo) == n else wide[todo]
            j = rows.argmin(axis=1)
            live = rows[np.arange(len(todo)), j] != _NONE
            todo, j = todo[live], j[live]
            if not len(todo):
                break
            start = base[todo]
            at = start + j
            right = after[at]
            end = after[start + right]
            fresh = made[at]
            flat[at], after[at] = fresh, end
            alive[start + right] = False
            ranks = wide.reshape(-1)
            ranks[start + right] = _NONE
            ranks[at] = _NONE
            left = before[at]
            inner, outer = np.flatnonzero(left >= 0), np.flatnonzero(end < width)
            before[(start + end)[outer]] = j[outer]
            i, o = (start + left)[inner], at[outer]
            a = np.concatenate((flat[i], fresh[outer]))
            b = np.concatenate((fresh[inner], flat[(start + end)[outer]]))
            r, q = self.merges(a, b)
            known = np.flatnonzero(r != _NONE)
            to = np.concatenate((i, o))[known]
            r, q = r[known], q[known]
            if rate and len(known):
                middle = np.concatenate((j[inner], end[outer]))[known]
                stop = np.concatenate((end[inner], after[(start + end)[outer]]))[known]
                which = np.concatenate((todo[inner], todo[outer]))[known]
                r = np.where(self._skipped(lane[which], to - base[which], middle, stop, rate), _NONE, r)
            ranks[i] = _NONE
            ranks[to], made[to] = r, q
        return alive.reshape(n, width), after.reshape(n, width)

    def _agenda(self, word: str, lane: np.ndarray, rate: float) -> list[tuple[int, int, int]]:
        """(symbol, begin, end) of a long word's pieces, by a heap of candidates."""
        n = len(word)
        symbol = [self.chars.get(c, -1) for c in word]
        begin, end, left, right = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(pairs: list[tuple[int, int]]) -> None:
            found = [(i, j, self.pairs[symbol[i], symbol[j]]) for i, j in pairs if (symbol[i], symbol[j]) in self.pairs]
            if rate and found:
                places = np.array([(begin[i], begin[j], end[j]) for i, j, _ in found], np.int64)
                skip = self._skipped(lane, places[:, 0], places[:, 1], places[:, 2], rate)
                found = [x for x, no in zip(found, skip) if not no]
            for i, j, (rank, piece) in found:
                heapq.heappush(heap, (rank, begin[i], i, end[j], piece))

        offer([(i, i + 1) for i in range(n - 1)])
        alive = [True] * n
        while heap:
            _, at, i, stop, piece = heapq.heappop(heap)
            j = right[i] if alive[i] else n
            if j >= n or begin[i] != at or end[j] != stop or (symbol[i], symbol[j]) not in self.pairs or self.pairs[symbol[i], symbol[j]][1] != piece:
                continue
            symbol[i], end[i], right[i], alive[j] = piece, end[j], right[j], False
            if right[j] < n:
                left[right[j]] = i
            offer([(a, b) for a, b in ((left[i], i), (i, right[i])) if a >= 0 and b < n])
        return [(symbol[i], begin[i], end[i]) for i in range(n) if alive[i]]

    def decode(self, ids: np.ndarray) -> str:
        """The text that any segmentation of it gives back."""
        data = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return data[1:].decode("utf-8", "surrogatepass") if data else ""


def _text(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all texts, a space before each; where words begin (and the end), and each word's text and number in it.

    A word begins at a space after something else: one of several spaces keeps the others. An empty text has none."""
    points = np.frombuffer("".join([f" {t}" for t in texts if t]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    first = np.concatenate(([0], np.cumsum(size)))
    begins = points == 32
    begins[1:] &= ~begins[:-1]
    begins[first[:-1][size > 0]] = True
    starts = np.flatnonzero(begins)
    text = np.searchsorted(first, starts, "right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, first)[text]
    return points, np.append(starts, len(points)), text, number


class Encoder:
    def __init__(self, path: str, rate: float = DROPOUT, seed: int = SEED) -> None:
        self.pieces, self.rate, self.seed = Pieces(path), rate, seed

    def encode(self, texts: list[str], doc_ids: list[int | None]) -> list[np.ndarray]:
        points, starts, text, number = words_of(texts)
        keys = np.array([(d or 0) & (1 << 64) - 1 for d in doc_ids], np.uint64)
        lanes = mix64(mix64(mix64(keys) + np.uint64(self.seed & (1 << 64) - 1))[text] + number.astype(np.uint64)) if len(text) else np.empty(0, np.uint64)
        ids, begin = self.pieces.encode_points(points, starts, lanes, self.rate)
        cuts = begin[np.searchsorted(text, np.arange(len(texts) + 1))]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, rate: float, seed: int) -> Encoder:
    """One a process: reading the vocabulary takes a second."""
    key = (path, rate, seed)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def encode_documents(docs: DataFrame, path: str | None = None, rate: float = DROPOUT, seed: int = SEED, with_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, ids_sha256, decoded_sha256, lossless and, unless left out, ids of every document's whole text.

    Null and empty texts have no pieces; a null id draws as 0 does; rows of one id and text draw alike; an empty table gives an empty result.
    ids_sha256 covers the ids as little-endian 16-bit numbers, which vocabularies of more than 65536 pieces are refused for. decoded_sha256 is
    that of the text which the ids decode to. The vocabulary file is sent to every executor."""
    path = path or default_model()
    docs.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)
    kinds = {"doc_id": pa.int64(), "n_pieces": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "lossless": pa.bool_()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(SparkFiles.get(name), rate, seed)
        for batch in batches(it, 2 << 20):
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for doc_id, text, ids in zip(doc_ids, texts, e.encode([t or "" for t in texts], doc_ids)):
                back = e.pieces.decode(ids)
                row = (doc_id, len(ids), hashlib.sha256(ids.astype("<u2").tobytes()).hexdigest(), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == (text or ""))
                rows.append((*row, ids.astype(np.int32)) if with_ids else row)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))

    schema = "doc_id long, n_pieces long, ids_sha256 string, decoded_sha256 string, lossless boolean" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(mapped, run, schema)
