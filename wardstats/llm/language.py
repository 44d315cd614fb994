"""Language identification with bit-sliced Bloom filters of byte n-grams, one bit a language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, discard, map_batches, slices, stored
from .words import LOWER, mix, text_bytes

GRAM = 4
CELLS = 1 << 20  # at least; a filter has CELLS_A_GRAM for each n-gram of its largest language
CELLS_A_GRAM = 8
HASHES = 2
SHARE = 0.2  # of the largest frequency among the languages, to count as a language's n-gram
LEAST, LEAST_OF = 3, 10_000  # occurrences of an n-gram in a language of LEAST * LEAST_OF or more; fewer in a smaller one
LEAST_SHARE = 1e-6  # and of all n-grams of a language; so it has a million at most
UNKNOWN = "und"

_FOLD = LOWER.copy()
_FOLD[[*range(0, 65), *range(91, 97), *range(123, 128)]] = 32


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of lower-cased letters (other ASCII bytes are blanks), and the text of each.

    A text has a blank before and after it, so all but a lone ASCII letter has n-grams.
    """
    plain, at = text_bytes(column)
    at = np.asarray(at, np.int64)
    data = np.full(len(plain) + 2 * len(column), 32, np.uint8)
    data[np.arange(len(plain)) + 2 * np.repeat(np.arange(len(column)), np.diff(at)) + 1] = plain
    at = at + 2 * np.arange(len(at))
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    data = _FOLD[data]
    code = np.zeros(n, np.uint32)
    blanks = np.zeros(n, np.int8)
    for k in range(GRAM):
        code = (code << np.uint32(8)) | data[k : k + n]
        blanks += data[k : k + n] == 32
    good = blanks < GRAM - 1
    for f in at[1:-1]:
        good[max(0, f - GRAM + 1) : f] = False
    places = np.flatnonzero(good)
    return code[places], np.searchsorted(at, places, "right") - 1


def cells(codes: np.ndarray, size: int) -> list[np.ndarray]:
    """The cells of each n-gram among ``size``, a power of two; one array a hash."""
    h = mix(codes.astype(np.uint64) + np.uint64(1))
    return [((h >> np.uint64(32 * k)) & np.uint64(size - 1)).astype(np.int64) for k in range(HASHES)]


def least_count(total: int) -> float:
    """Occurrences that an n-gram needs in a language of ``total``: one counts where there are few."""
    return max(min(LEAST, total / LEAST_OF), LEAST_SHARE * total)


@dataclass
class LanguageFilters:
    """``bits[slice][cell]``: a bit for each language of the slice that has an n-gram there."""

    languages: list[str]
    bits: np.ndarray

    def rates(self) -> np.ndarray:
        """Rate of false positives of each language's filter, from its share of set cells."""
        fill = [((self.bits[i >> 5] >> np.uint32(i & 31)) & 1).mean() for i in range(len(self.languages))]
        return np.array(fill) ** HASHES

    def scores(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per text: n-grams, and how many each language contains, less the expected false positives."""
        codes, owner = grams(column)
        n = np.bincount(owner, minlength=len(column)).astype(float)
        out = np.zeros((len(column), len(self.languages)))
        at = cells(codes, self.bits.shape[1])
        rates = np.minimum(self.rates(), 0.999)
        for s, bits in enumerate(self.bits):
            mask = bits[at[0]]
            for more in at[1:]:
                mask &= bits[more]
            for i in range(32 * s, min(32 * s + 32, len(self.languages))):
                has = (mask >> np.uint32(i & 31)) & np.uint32(1)
                hits = np.bincount(owner, weights=has, minlength=len(column))
                out[:, i] = np.maximum(0, (hits - n * rates[i]) / (1 - rates[i]))
        return n, out


def learn_languages(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageFilters:
    """Filters from the texts with a language; all of them, whole.

    Every task counts its n-grams by language; sums over all tasks decide which
    languages have an n-gram: those with ``least_count`` occurrences and ``SHARE``
    of the n-gram's highest relative frequency. The filters' size follows the largest language.
    What comes to the driver is one mask a cell at most for each 32 languages. Rows
    with a null language or text teach nothing; without any, there are no languages.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            codes = np.concatenate([p[0] for p in parts])
            found, back = np.unique(codes, return_inverse=True)
            return found, np.bincount(back, weights=np.concatenate([p[1] for p in parts]), minlength=len(found))

        for batch in slices(batches, "text"):
            names = np.array(batch.column("lang").to_pylist(), object)
            codes, owner = grams(batch.column("text"))
            for name in set(names):
                found, n = np.unique(codes[(names == name)[owner]], return_counts=True)
                held.setdefault(name, []).append((found, n.astype(float)))
                if len(held[name]) >= 8:
                    held[name] = [merged(held[name])]
        for name, parts in held.items():
            found, n = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(n, pa.int64())], ["lang", "gram", "n"]
            )

    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    counts = stored(counts, "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageFilters([], np.zeros((1, CELLS), np.uint32))

    least = {name: least_count(n) for name, n in totals.items()}

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {name: i for i, name in enumerate(languages)}
        for batch in batches:
            sets = [[], []]
            for gram, found in zip(batch.column("gram").to_pylist(), batch.column("found").to_pylist()):
                rate = {f["lang"]: f["n"] / totals[f["lang"]] for f in found if f["n"] >= least[f["lang"]]}
                top = max(rate.values(), default=0)
                for name, r in rate.items():
                    if r >= SHARE * top:
                        sets[0].append(place[name])
                        sets[1].append(gram)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in sets], ["place", "gram"])

    by_gram = counts.groupBy("gram").agg(F.collect_list(F.struct("lang", "n")).alias("found"))  # a row a language at most
    chosen = stored(by_gram.mapInArrow(choose, "place long, gram long"), "chosen")
    most = chosen.groupBy("place").count().agg(F.max("count")).collect()[0][0] or 0
    size = max(CELLS, 1 << (CELLS_A_GRAM * most - 1).bit_length()) if most else CELLS

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, codes = (np.array(c, np.int64) for c in batch.columns)
            for cell in cells(codes.astype(np.uint32), size):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (place >> 5, cell, 1 << (place & 31))], ["slice", "cell", "mask"])

    masks = chosen.mapInArrow(fill, "slice long, cell long, mask long").groupBy("slice", "cell").agg(F.bit_or("mask").alias("mask"))
    at_slice, cell, mask = (c.to_numpy() for c in masks.toArrow().columns)
    bits = np.zeros((-(-len(languages) // 32), size), np.uint32)
    bits[at_slice, cell] = mask
    for table in (counts, chosen):
        discard(table)
    return LanguageFilters(languages, bits)


def predict_languages(docs: DataFrame, model: LanguageFilters, text: str = "text", lang: str = "lang_pred", score: str = "score", reject: bool = False) -> DataFrame:
    """``docs`` with the language of each whole text and the share of its n-grams in that language.

    ``und`` and 0 for a text that is null or has no letter; a text with letters
    but no known n-gram gets the first language and 0, and ``und`` if none was
    learned. Ties go to the first language by name. Columns of ``docs`` named
    like the two new ones are replaced; names may hold dots. Any length of text. With ``reject`` a text that has n-grams,
    but none in any language after the correction, is ``und`` too.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c.lower() not in (lang.lower(), score.lower())]
    rows = docs.select(*map(column, kept), F.lit(None).cast("string").alias(lang), F.lit(None).cast("double").alias(score))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        for batch in slices(batches, text):
            names, shares = [], []
            texts = batch.column(text).to_pylist()
            n, scores = model.scores(batch.column(text))
            for i, t in enumerate(texts):
                if not model.languages or not t or not any(c.isalpha() for c in t):
                    names.append(UNKNOWN)
                    shares.append(0.0)
                    continue
                best = int(scores[i].argmax())
                if reject and n[i] and scores[i, best] <= 0:
                    names.append(UNKNOWN)
                    shares.append(0.0)
                    continue
                names.append(model.languages[best])
                shares.append(float(min(1.0, scores[i, best] / n[i])) if n[i] else 0.0)
            columns = dict(zip(batch.schema.names, batch.columns)) | {lang: pa.array(names, pa.string()), score: pa.array(shares, pa.float64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return map_batches(rows, run, rows.schema)
