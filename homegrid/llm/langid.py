"""Language identification with bit-sliced Bloom filters of byte n-grams.

One table of masks serves all languages: bit l of an entry belongs to the Bloom filter of
language l, so the AND over the places of an n-gram is the set of all languages that contain
it. Per language the hits of a text are counted, corrected for the filter's false positives,
and the language with the largest share wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from homegrid.llm.arrow import byte_set, chunks, column_of, lower_table, mix
from homegrid.llm.labels import remainder

SIZES = (2, 3, 4)
PLACES, HASHES = 1 << 20, 3
#: Documents of each language that the filters are fitted on, about this many at most.
PER_LANGUAGE = 3000
#: An n-gram belongs to the languages that have it at least this often against the one that has it most.
SHARE, LEAST = 0.05, 2
LETTER = regex.compile(r"\p{L}")
WORD = byte_set(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


def ngrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each row's letters, all else being one blank, and their rows."""
    n = len(data)
    code = np.where(WORD[data], lower_table()[data], 32).astype(np.uint64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    value, out, rows = code.copy(), [], []
    for k in range(1, max(SIZES)):
        if n <= k:
            break
        value = (value[:-1] << np.uint64(8)) | code[k:]
        if k + 1 in SIZES:
            blank = (value & np.uint64(0xFF)) == 32
            inner = ((value >> np.uint64(8)) & np.uint64(0xFF)) == 32
            use = (row[: n - k] == row[k:]) & ~(blank & inner)
            out.append(mix(value[use] * np.uint64(8) + np.uint64(k)))
            rows.append(row[: n - k][use])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(rows)


@dataclass
class Filters:
    """Masks of 64 languages a word: ``masks`` is (PLACES, words); ``rates`` the false positives."""

    languages: list[str]
    masks: np.ndarray
    rates: np.ndarray

    @staticmethod
    def places(grams: np.ndarray) -> list[np.ndarray]:
        second = (grams >> np.uint64(32)) | np.uint64(1)
        return [((grams + np.uint64(k) * second) & np.uint64(PLACES - 1)).astype(np.int64) for k in range(HASHES)]

    @staticmethod
    def build(languages: list[str], grams: np.ndarray, owner: np.ndarray) -> Filters:
        masks = np.zeros((PLACES, -(-len(languages) // 64) or 1), np.uint64)
        for spot in Filters.places(grams):
            np.bitwise_or.at(masks, (spot, owner // 64), np.uint64(1) << (owner % 64).astype(np.uint64))
        full = np.array([np.count_nonzero((masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)) for k in range(len(languages))])
        return Filters(languages, masks, (full / PLACES) ** HASHES)

    def shares(self, grams: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
        """(row, language): the share of the row's n-grams that the language contains."""
        spots = self.places(grams)
        total = np.maximum(1, np.bincount(rows, minlength=n_rows))
        out = np.zeros((n_rows, len(self.languages)))
        for word in range(self.masks.shape[1]):
            mask = self.masks[spots[0], word]
            for spot in spots[1:]:
                mask = mask & self.masks[spot, word]
            for k in range(word * 64, min(len(self.languages), word * 64 + 64)):
                hit = ((mask >> np.uint64(k % 64)) & np.uint64(1)).astype(np.float64)
                seen = np.bincount(rows, hit, minlength=n_rows)
                out[:, k] = np.maximum(0, (seen - self.rates[k] * total) / (total * (1 - self.rates[k])))
        return out


def fit_languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Filters | None:
    """Filters from text and lang of the rows outside the held-out fold; None if there are none.

    Each language is thinned to about ``per_language`` rows by a hash of their id, so the
    n-grams that come to the driver are bounded by that parameter.
    """
    usable = docs.select("doc_id", "lang", "text").where("lang is not null and text is not null").where(remainder(4) != 2)
    counts = sorted(usable.groupBy("lang").count().collect())
    if not counts:
        return None
    languages = [r["lang"] for r in counts]
    number = F.create_map([F.lit(x) for i, r in enumerate(counts) for x in (r["lang"], i)])
    part = F.create_map([F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_language / r["count"]))])
    fine = 1_000_000
    sample = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(fine)) < F.element_at(part, F.col("lang")) * fine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, at in chunks(batches):
            grams, rows = ngrams(data, at)
            owner = column_of(block, "k").to_numpy(zero_copy_only=False)[rows]
            for k in np.unique(owner).tolist():
                found, n = np.unique(grams[owner == k], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), k, np.int32)), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["k", "gram", "n"]
                )

    counted = sample.select(F.element_at(number, F.col("lang")).alias("k"), "text").mapInArrow(run, "k int, gram long, n long")
    grams = counted.groupBy("k", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST).toArrow()
    if not grams.num_rows:
        return None
    k, gram, n = (grams.column(c).to_numpy() for c in ("k", "gram", "n"))
    rate = n / np.bincount(k, n, minlength=len(languages))[k]
    order = np.argsort(gram, kind="stable")
    k, gram, rate = k[order], gram[order], rate[order]
    head = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    most = np.repeat(np.maximum.reduceat(rate, head), np.diff(np.concatenate([head, [len(gram)]])))
    use = rate >= SHARE * most
    return Filters.build(languages, gram[use].view(np.uint64), k[use].astype(np.int64))


def predict_languages(docs: DataFrame, filters: Filters | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    ``und`` and 0 where the text is null or has no letter, or nothing was learned. Ties go
    to the language that comes first by name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(filters)  # fixed size: PLACES masks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for part, data, at in chunks(batches, most=1 << 18):
            n = part.num_rows
            if known is None:
                best, score, names = np.zeros(n, int), np.zeros(n), ["und"]
            else:
                grams, rows = ngrams(data, at)
                share = known.shares(grams, rows, n)
                best = share.argmax(1)
                score = share.max(1) / np.maximum(share.sum(1), 1e-12)
                names = known.languages
            texts = column_of(part, "text").to_pylist()
            some = [known is not None and t is not None and LETTER.search(t) is not None for t in texts]
            pred = [names[b] if s else "und" for b, s in zip(best.tolist(), some, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "doc_id"), column_of(part, "held_out"), pa.array(pred, pa.string()), pa.array(np.where(some, np.clip(score, 0, 1), 0.0))],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), (remainder(4) == 2).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
