"""Byte-level BPE by backtracking.

A text is cut into words by the vocabulary's pattern. In a word, an Aho-Corasick automaton over all tokens gives the longest token from every
place; tokens are taken greedily, and one that cannot stand beside its predecessor gives way to its next shorter prefix, or, where none is left, to
a shorter predecessor. Places from which nothing went on are marked, so each is tried once and the work is linear in the word's length. Two tokens
can stand side by side exactly if no merge across their border comes before those that made them; that is looked up in a table which is filled as pairs
turn up. The outcome is the one sequence that merging by rank gives. Ids are turned back into bytes by a table of offsets into all tokens' bytes.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, mapped

NEVER = 1 << 62
#: Words up to so many characters are remembered, this many of them; pairs of tokens, this many.
WORD_CHARS, WORDS, PAIRS = 48, 1 << 19, 1 << 19

#: The pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same where a text has only these characters, for which \w, \d and \s of the faster module mean letters and digits, digits, and white space.
LATIN = r"[\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]*"
LATIN_PATTERN = r" ?[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Ranges of code points that are letters or numbers in the installed tables but were not yet assigned in Unicode 16, whose
#: tables the pattern was written for.
UNASSIGNED = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a "
    "11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 "
    "18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 "
    "1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """How vocabulary files write bytes: printable Latin-1 as itself, the others, in order, as the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Joined:
    """Strings of bytes by number: a blob and the offsets in it. ``gather`` strings together those of many numbers at once."""

    def __init__(self, parts: list[bytes]) -> None:
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.offset = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))

    def gather(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in order, and where each one's end."""
        start = self.offset[ids]
        size = self.offset[ids + 1] - start
        end = np.cumsum(size)
        return self.blob[np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)], end


class Vocabulary:
    """A byte-level BPE file: tokens, merges by rank, the automaton, the pair table and the offset table."""

    def __init__(self, path: str) -> None:
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        extra = spec.get("added_tokens") or []
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{path} is no byte-level BPE without normaliser and prefix space")
        if any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in extra):
            raise ValueError(f"{path} has added tokens that take in what surrounds them")
        self.count = 1 + max([*model["vocab"].values(), *(x["id"] for x in extra)])
        spelled = [b""] * self.count
        for token, i in model["vocab"].items():
            spelled[i] = bytes(letters[c] for c in token)
        for x in extra:
            spelled[x["id"]] = x["content"].encode()
        self.size = [len(b) for b in spelled]
        self.added = {x["content"]: x["id"] for x in extra}
        self.bytes_of, self.digits_of = Joined(spelled), Joined([b"%d," % i for i in range(self.count)])
        # of each token: the rank of the merge that made it (-1: a byte) and its two parts
        self.born, self.left, self.right = [-1] * self.count, [-1] * self.count, [-1] * self.count
        self.rank: dict[int, int] = {}
        vocab, known = model["vocab"], {i for t, i in model["vocab"].items() if len(t) == 1}
        for rank, pair in enumerate(model["merges"]):
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = vocab["".join(pair.split(" ") if isinstance(pair, str) else pair)]
            if a not in known or b not in known or made in known:
                raise ValueError(f"merge {rank} of {path} uses a token before it is made or makes one twice")
            known.add(made)
            self.born[made], self.left[made], self.right[made] = rank, a, b
            self.rank[a * self.count + b] = rank
        self.automaton = ahocorasick.Automaton()
        for i in known:
            self.automaton.add_word(spelled[i].decode("latin-1"), i)
        self.automaton.make_automaton()
        # the longest token that a token begins with
        by_bytes = {spelled[i]: i for i in known}
        self.shorter = [-1] * self.count
        for i in known:
            self.shorter[i] = next((by_bytes[spelled[i][:k]] for k in range(self.size[i] - 1, 0, -1) if spelled[i][:k] in by_bytes), -1)
        self.beside: dict[int, bool] = {}

    def _apart(self, a: int, b: int) -> bool:
        """Whether no merge joins ``a`` and ``b``, or the parts at their border while these still stand.

        Walks back in time: of the two pieces at the border, the one made later is undone. A piece on the left is gone from the merge on that
        takes it in; one on the right is still there at a merge of equal rank, which takes place from left to right."""
        gone_a = gone_b = NEVER
        while True:
            rank = self.rank.get(a * self.count + b, NEVER)
            if rank < gone_a and rank <= gone_b and rank != NEVER:
                return False
            if self.born[a] < 0 and self.born[b] < 0:
                return True
            if self.born[a] > self.born[b]:
                gone_a, a = self.born[a], self.right[a]
            else:
                gone_b, b = self.born[b], self.left[b]

    def fits(self, a: int, b: int) -> bool:
        key = a * self.count + b
        found = self.beside.get(key)
        if found is None:
            if len(self.beside) >= PAIRS:
                self.beside.clear()
            found = self.beside[key] = self._apart(a, b)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of a word; bytes that no token holds are an error, as no byte-level vocabulary leaves any out."""
        n, size, fits = len(word), self.size, self.fits
        longest = [-1] * n
        for end, token in self.automaton.iter(word.decode("latin-1")):
            longest[end - size[token] + 1] = token  # ends rise, so the longest stays
        if -1 in longest:
            raise ValueError("a byte that no token holds")
        out: list[int] = []
        at, dead = 0, bytearray(n + 1)
        token = longest[0] if n else -1
        while at < n:
            end = at + size[token]
            if not dead[end] and (not out or fits(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
                continue
            token = self.shorter[token]
            while token < 0:  # nothing goes on from here: the token before gives way
                if not out:
                    raise ValueError("no sequence of tokens is what merging gives")
                dead[at] = 1
                token = out.pop()
                at -= size[token]
                token = self.shorter[token]
        return out


class _Words(dict):
    """The packed ids of words, encoded when first asked for."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> bytes:
        v = self.vocabulary
        ids = [v.added[word]] if word in v.added else v.encode_word(word.encode("utf-8", "surrogatepass"))
        packed = np.array(ids, "<i4").tobytes()
        if len(word) <= WORD_CHARS:
            if len(self) >= WORDS:
                self.clear()
            self[word] = packed
        return packed


class Codec:
    def __init__(self, path: str) -> None:
        import regex

        self.vocabulary = Vocabulary(path)
        self._words = _Words(self.vocabulary)
        self._latin, self._cut_latin, self._cut = re.compile(LATIN), re.compile(LATIN_PATTERN), regex.compile(PATTERN)
        unassigned = "".join("-".join(rf"\U{int(x, 16):08x}" for x in part.split("-")) for part in UNASSIGNED.split())
        letter, number = (rf"[\p{{{x}}}--[{unassigned}]]" for x in "LN")
        neither = rf"[^\s[\p{{L}}--[{unassigned}]][\p{{N}}--[{unassigned}]]]"
        self._cut_old = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{neither}+|\s+(?!\S)|\s+")
        self._new = regex.compile(f"[{unassigned}]")
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self._added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None

    def words(self, text: str) -> list[str]:
        if self._latin.fullmatch(text):
            cut = self._cut_latin
        else:
            cut = self._cut_old if self._new.search(text) else self._cut
        if self._added is None or not self._added.search(text):
            return cut.findall(text)
        parts = self._added.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else cut.findall(part))]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self._words.__getitem__, self.words(text))), "<i4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self.vocabulary.bytes_of.gather(ids)[0].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """Bytes that are no UTF-8 become U+FFFD; ids that the vocabulary lacks are an error."""
        if len(ids) and not (0 <= ids.min() and ids.max() < self.vocabulary.count):
            raise ValueError("an id that the vocabulary lacks")
        return self.decode_bytes(ids).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One a process: building the automaton takes a second."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _sent(df: DataFrame, path: str | None) -> str:
    """The name under which every executor finds the vocabulary file."""
    path = path or default_vocabulary()
    df.sparkSession.sparkContext.addFile(path)
    return os.path.basename(path)


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, lossless and, unless left out, ids of every document's whole text.

    ids_sha256 is that of the decimal ids joined by commas, decoded_sha256 that of the text which the ids decode to. Added tokens' strings in a
    text are these tokens. Null and empty texts have no tokens; null ids stay; equal rows give equal rows; an empty table gives an empty result; other
    columns are not carried along. A word of any length is encoded in time linear in it."""
    name = _sent(docs, path)
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "lossless": pa.bool_()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(SparkFiles.get(name))
        for batch in batches(it, 1 << 20):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            each = [c.encode(t) for t in texts]
            ids, cuts = np.concatenate(each), np.cumsum([0, *map(len, each)])
            (digits, ends), (back, back_ends) = c.vocabulary.digits_of.gather(ids), c.vocabulary.bytes_of.gather(ids)
            at, back_at = (np.concatenate(([0], x))[cuts] for x in (ends, back_ends))
            rows: list[list] = [[] for _ in kinds]
            for k, (doc_id, text, mine) in enumerate(zip(batch.column(0).to_pylist(), texts, each)):
                decoded = back[back_at[k] : back_at[k + 1]].tobytes().decode("utf-8", "replace")
                commas = digits[at[k] : max(at[k], at[k + 1] - 1)].tobytes()  # without the last comma
                row = (doc_id, len(mine), hashlib.sha256(commas).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), decoded == text)
                for column, value in zip(rows, (*row, mine) if with_ids else row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds.values())], names=list(kinds))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, lossless boolean" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(mapped, run, schema)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows with doc_id and ids. Null ids give a null text, none an empty one."""
    name = _sent(encoded, path)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(SparkFiles.get(name))
        for batch in it:
            texts = [None if x is None else c.decode(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").transform(mapped, run, "doc_id long, text string")
