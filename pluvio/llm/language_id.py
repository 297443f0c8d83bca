"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the product (binding) of its letters' vectors, each permuted by
its place; a text is the sum (bundle) of its trigrams, a language the bundle of its training texts. A text gets the language
whose prototype has the highest cosine with it. Training counts cover all labelled rows outside the held-out fold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, mapped, mix64

DIMENSIONS, SEED = 1024, 5
UNKNOWN = "und"
_BATCH_BYTES = 1 << 20
_COLUMNS = 4096  # trigrams of a batch whose vectors are held at once
_is_letter: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _is_letter
    if _is_letter is None:
        _is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)
    return _is_letter


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """The vector of each code point, drawn from it and SEED; 0 is the gap between words."""
    words = DIMENSIONS // 64
    lanes = mix64(mix64(points.astype(np.uint64) + np.uint64(SEED << 32))[:, None] + np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    bits = np.unpackbits(np.ascontiguousarray(lanes).astype("<u8").view(np.uint8).reshape(len(points), -1), axis=1)
    return (bits.astype(np.int8) << 1) - 1


class Trigrams:
    """The trigrams of a batch of texts: the different ones, and which of them each text has how often.

    Runs of what is no letter count as one gap; every text begins and ends with one, so a single letter makes a trigram, and no
    text touches another. A letter is its lower-case code point."""

    def __init__(self, texts: list[str]) -> None:
        lowered = [f" {t.lower()} " for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
        letter = letter_table()[points]
        keep = letter.copy()
        keep[1:] |= letter[:-1] | (row[1:] != row[:-1])
        keep[:1] = True
        points, letter, row = points[keep], letter[keep], row[keep]
        present = np.zeros(0x110000, np.bool_)
        present[points[letter]] = True
        alphabet = np.flatnonzero(present)
        place = np.zeros(0x110000, np.int32)
        place[alphabet] = np.arange(1, len(alphabet) + 1)
        ids = np.where(letter, place[points], 0).astype(np.int64)
        n = len(alphabet) + 1
        middle = np.flatnonzero((row[:-2] == row[2:]) & ((ids[:-2] > 0) | (ids[1:-1] > 0) | (ids[2:] > 0))) if len(ids) > 2 else np.empty(0, np.int64)
        codes = (ids[middle] * n + ids[middle + 1]) * n + ids[middle + 2]
        self.texts, self.row, self.has = len(texts), row[middle], np.bincount(row[letter], minlength=len(texts)) > 0
        if n**3 <= 1 << 22:
            seen = np.zeros(n**3, np.bool_)
            seen[codes] = True
            self.codes = np.flatnonzero(seen)
            where = np.zeros(n**3, np.int32)
            where[self.codes] = np.arange(len(self.codes))
            self.at = where[codes]
        else:
            self.codes, self.at = np.unique(codes, return_inverse=True)
        self._letters, self._n = letter_vectors(np.concatenate(([0], alphabet))), n

    def vectors(self, a: int, b: int) -> np.ndarray:
        """permute(permute(x)) * permute(y) * z for the trigrams xyz from a to b; the permutation is a rotation."""
        codes = self.codes[a:b]
        x, y, z = codes // self._n**2, codes // self._n % self._n, codes % self._n
        return np.roll(self._letters, 2, axis=1)[x] * np.roll(self._letters, 1, axis=1)[y] * self._letters[z]

    def bundles(self, group: np.ndarray | None = None, groups: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The sum of the trigrams' vectors of each text (or group of texts), and how many different ones it has.

        Sums are whole numbers below 2 ** 24 at every step, or doubles, so no order of adding shows."""
        row, n = (self.row, self.texts) if group is None else (group[self.row], groups)
        out, different = np.zeros((n, DIMENSIONS), np.float64), np.zeros(n, np.int64)
        kind = np.float32 if len(row) < 1 << 24 else np.float64
        for a in range(0, len(self.codes), _COLUMNS):
            b = min(a + _COLUMNS, len(self.codes))
            own = np.flatnonzero((self.at >= a) & (self.at < b)) if len(self.codes) > _COLUMNS else slice(None)
            counts = np.bincount(row[own] * (b - a) + self.at[own] - a, minlength=n * (b - a)).reshape(n, b - a)
            different += np.count_nonzero(counts, axis=1)
            out += counts.astype(kind) @ self.vectors(a, b).astype(kind)
        return out, different


def _bundle_languages(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches(it, _BATCH_BYTES):
        langs = batch.column(1).to_pylist()
        names = sorted(set(langs))
        group = np.array([names.index(x) for x in langs])
        own, _ = Trigrams(batch.column(0).to_pylist()).bundles(group, len(names))
        for name, x in zip(names, own):
            sums[name] = sums[name] + x if name in sums else x
    for name, x in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([name] * DIMENSIONS, pa.string()), pa.array(np.arange(DIMENSIONS)), pa.array(np.rint(x).astype(np.int64))], ["lang", "at", "n"])


def train(docs: DataFrame, held_out: Column) -> tuple[list[str], np.ndarray]:
    """The languages and their prototypes, of unit length.

    Tasks bundle their texts by language, whole numbers are summed, and one vector a language comes to the driver."""
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out).select("text", "lang")
    sums = rows.transform(mapped, _bundle_languages, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(sums["lang"].to_pylist()))
    if not langs:
        return [], np.zeros((0, DIMENSIONS))
    where = {x: i for i, x in enumerate(langs)}
    prototypes = np.zeros((len(langs), DIMENSIONS))
    prototypes[np.array([where[x] for x in sums["lang"].to_pylist()]), sums["at"].to_numpy()] = sums["n"].to_numpy()
    return langs, prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], *keep: str, evidence: bool = False) -> DataFrame:
    """lang_pred and score beside the columns ``keep``; with ``evidence`` also n_trigrams, the different ones of the text. Reads the text and nothing else.

    score is the cosine to nine places, 0 at least, and 0 for ``und``. ``und``: the text is null or has no letter, or nothing was learned.
    Equal cosines: the first language by code point. Equal texts get equal rows, wherever they stand."""
    langs, prototypes = model
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    if evidence:
        schema = schema.add("n_trigrams", "long")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, _BATCH_BYTES, "_text_of_row"):
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            trigrams = Trigrams(texts)
            bundle, seen = trigrams.bundles()
            if langs:
                cosine = np.round((bundle @ prototypes.T) / np.maximum(np.linalg.norm(bundle, axis=1, keepdims=True), 1e-6), 9)
                best = cosine.argmax(axis=1)
                for i in np.flatnonzero(trigrams.has):
                    names[i] = langs[best[i]]
                    scores[i] = min(1.0, max(0.0, float(cosine[i, best[i]])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64()), *([pa.array(seen, pa.int64())] if evidence else [])], names=[f.name for f in schema])

    return docs.select(*keep, F.col("text").alias("_text_of_row")).transform(mapped, run, schema)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5
