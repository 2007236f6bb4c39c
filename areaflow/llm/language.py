"""Language by filters that hold, for every n-gram, a bit per language.

Learning counts letter trigrams per language over all training texts and keeps
those with at least a fixed share of their language's trigrams, so a language has
at most one over that share of them at any corpus size.  They go into one Bloom
filter sliced by bits: a slot is a word with a bit for each language, and the
conjunction of an n-gram's slots names all languages that contain it.  A text adds
up these bits per language; the count expected from false positives alone, known
from how full each slice is, is taken off, and the largest share wins.

Defined results: null texts and texts without a letter are ``und`` with score 0,
as is everything where nothing was learned; of equal shares the language first in
order wins; rows are independent, so repeated rows give repeated results; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow.llm import texts

#: Least share of a language's trigrams; at most 1 / MIN_SHARE trigrams of a language are kept.
MIN_SHARE = 2e-5
HASHES = 3
_PIECE = 1 << 20
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Which code points are letters."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS


def trigrams(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed lower-case trigrams around each letter, the text each belongs to, and whether a text has a letter.

    What is no letter counts as a space; the last 21 bits are the last character.
    """
    lowered = [f" {s.lower()} " for s in strings]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = _letters()[codes]
    codes = np.where(is_letter, codes, 32).astype(np.uint64)
    owner = np.repeat(np.arange(len(lowered)), [len(s) for s in lowered])
    middle = np.flatnonzero(is_letter)  # texts begin and end with a space, so neighbours are their own
    packed = (codes[middle - 1] << np.uint64(42)) | (codes[middle] << np.uint64(21)) | codes[middle + 1]
    has_letter = np.zeros(len(strings), bool)
    has_letter[owner[middle]] = True
    return packed, owner[middle], has_letter


@dataclass
class Filters:
    """``slots``: words of a bit per language, 64 languages to a column; ``full``: chance of a wrong hit each."""

    languages: list[str]
    slots: np.ndarray
    full: np.ndarray

    @staticmethod
    def _places(packed: np.ndarray, size: int) -> Iterator[np.ndarray]:
        x = packed * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        y = x * np.uint64(0xC2B2AE3D27D4EB4F)
        y ^= y >> np.uint64(29)
        for _ in range(HASHES):
            yield (x & np.uint64(size - 1)).astype(np.intp)
            x = x + (y | np.uint64(1))

    @classmethod
    def build(cls, learned: dict[str, np.ndarray]) -> Filters:
        languages = sorted(learned)
        largest = max((len(g) for g in learned.values()), default=1)
        size = 1 << max(10, int(np.ceil(np.log2(8 * largest))))
        slots = np.zeros((size, max(1, -(-len(languages) // 64))), dtype=np.uint64)
        full = np.zeros(len(languages))
        for i, language in enumerate(languages):
            bit = np.uint64(1 << (i % 64))
            for places in cls._places(learned[language].astype(np.uint64), size):
                slots[np.unique(places), i // 64] |= bit
            full[i] = float(((slots[:, i // 64] & bit) != 0).mean()) ** HASHES
        return cls(languages, slots, full)

    def containing(self, packed: np.ndarray) -> np.ndarray:
        """For each n-gram the bits of all languages that contain it."""
        found = None
        for places in self._places(packed, len(self.slots)):
            found = self.slots[places] if found is None else found & self.slots[places]
        return found

    def decide(self, strings: list[str]) -> tuple[list[str], np.ndarray]:
        packed, owner, has_letter = trigrams(strings)
        n = len(strings)
        if not self.languages or not len(packed):
            return ["und"] * n, np.zeros(n)
        found = self.containing(packed)
        seen = np.bincount(owner, minlength=n)
        share = np.zeros((n, len(self.languages)))
        for i in range(len(self.languages)):
            bits = (found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            share[:, i] = np.bincount(owner, weights=bits, minlength=n)
        share /= np.maximum(seen, 1)[:, None]
        share = np.clip((share - self.full) / np.maximum(1 - self.full, 1e-9), 0, 1)
        best = share.argmax(axis=1)
        total = share.sum(axis=1)
        score = np.where(total > 0, share[np.arange(n), best] / np.maximum(total, 1e-12), 0.0)
        return [self.languages[b] if h else "und" for b, h in zip(best, has_letter, strict=True)], score


def _summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(grams, return_inverse=True)
    return unique, np.bincount(place, weights=counts).astype(np.int64)


def count_trigrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, gram, n`` over all rows; every task adds up its own part first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for piece in texts.pieces(batches, "text", _PIECE):
            langs, strings = piece.column("lang").to_pylist(), texts.strings(piece.column("text"))
            for lang in set(langs):
                packed, _, _ = trigrams([s for s, x in zip(strings, langs, strict=True) if x == lang])
                grams, counts = np.unique(packed, return_counts=True)
                if lang in totals:
                    grams, counts = np.r_[totals[lang][0], grams], np.r_[totals[lang][1], counts]
                    grams, counts = _summed(grams, counts)
                totals[lang] = grams, counts
        for lang, (grams, counts) in totals.items():
            columns = [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    narrow = docs.select(docs[text].alias("text"), docs[lang].alias("lang")).filter("lang IS NOT NULL")
    return narrow.mapInArrow(task, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", min_share: float = MIN_SHARE) -> Filters:
    """Filters from all rows of ``docs``; the driver gets at most 1 / min_share trigrams of a language."""
    counted = count_trigrams(docs, text, lang)
    sums = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counted.join(sums, "lang").filter(F.col("n") >= min_share * F.col("total"))
    found = kept.select("lang", "gram").toPandas()
    return Filters.build({str(k): np.sort(g["gram"].to_numpy(np.uint64)) for k, g in found.groupby("lang")})


def predict(docs: DataFrame, filters: Filters, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``lang_pred`` and ``score``, the winner's part of all corrected shares."""
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.slots, filters.full))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(*shared.value)
        for piece in texts.pieces(batches, "text", _PIECE):
            langs, score = own.decide(texts.strings(piece.column("text")))
            score = np.where(np.array(langs) == "und", 0.0, score)
            columns = [piece.column("doc_id"), pa.array(langs, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return narrow.mapInArrow(task, f"doc_id {kind}, lang_pred string, score double")
