"""Importance resampling towards a target's n-grams, with their CRCs taken from running ones.

A text's words, one space between, are scanned once and the running CRC-32
behind each word is stored. As a CRC is linear over GF(2), the one of any run
of words follows from two running ones: the CRC up to the run's end, XOR the
CRC up to its start moved on by the run's length in bytes. Buckets of these are
counted over all texts and over the target; a text weighs the mean gain of its
n-grams' buckets, and a Gumbel draw by its id turns weights into a sample.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width, slices, stored
from .words import ALNUM, Words

BUCKETS = 10_000
GRAMS = (1, 1)  # shortest and longest run of words
LEAST_WORDS = 20
PER_CENT = 10
SEED = "2024"
_REFLECTED = 0xEDB88320  # fixed value: the polynomial of CRC-32


def _byte_shift() -> np.ndarray:
    """What each of the 32 bits of a CRC becomes when a zero byte follows."""
    out = []
    for bit in range(32):
        crc = 1 << bit
        for _ in range(8):
            crc = (crc >> 1) ^ (_REFLECTED if crc & 1 else 0)
        out.append(crc)
    return np.array(out, np.uint32)


def _apply(matrix: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = np.zeros(len(crc), np.uint32)
    for bit in range(32):
        out ^= np.where((crc >> np.uint32(bit)) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


def _tables(matrix: np.ndarray) -> np.ndarray:
    """The matrix as four look-ups, one for each byte of a CRC."""
    values = np.arange(256, dtype=np.uint32)
    return np.stack([_apply(matrix, values << np.uint32(8 * k)) for k in range(4)])


_SHIFTS: list[np.ndarray] = []  # by 1, 2, 4, ... bytes


def moved_on(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRCs as they are after ``size`` zero bytes: a table look-up for each bit of the size."""
    out, size = crc.astype(np.uint32), np.asarray(size, np.int64)
    for bit in range(int(size.max(initial=0)).bit_length()):
        if len(_SHIFTS) <= bit:
            matrix = _byte_shift() if not bit else _apply_all(_SHIFTS[-1])
            _SHIFTS.append(_tables(matrix))
        at = np.flatnonzero((size >> bit) & 1)
        x, table = out[at], _SHIFTS[bit]
        out[at] = table[0][x & 255] ^ table[1][(x >> 8) & 255] ^ table[2][(x >> 16) & 255] ^ table[3][x >> 24]
    return out


def _apply_all(table: np.ndarray) -> np.ndarray:
    """The matrix of a shift done twice."""
    x = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(2):
        x = table[0][x & 255] ^ table[1][(x >> 8) & 255] ^ table[2][(x >> 16) & 255] ^ table[3][x >> 24]
    return x


class RunningCrcs:
    """Words of a column of texts, one space before each, with the running CRC behind each word."""

    def __init__(self, column: pa.Array):
        words = Words(column, ALNUM, lower=True, hashed=False)
        self.first = words.first
        # Each word and the byte before it, which becomes the space, in one buffer.
        sizes = words.ends - words.starts
        ends = np.cumsum(sizes + 1)
        joined = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
        inside = np.ones(len(joined), bool)
        inside[ends - sizes - 1] = False
        mark = np.zeros(len(words.data) + 1, np.int8)
        mark[words.starts] += 1
        mark[words.ends] -= 1
        joined[inside] = words.data[np.cumsum(mark[:-1]).astype(bool)]
        raw, cut = memoryview(joined.tobytes()), [0, *ends.tolist()]
        crcs: list[int] = []
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            pieces = [raw[s:e] for s, e in zip(cut[a:b], cut[a + 1 : b + 1])]
            crcs += accumulate(pieces, lambda crc, piece: zlib.crc32(piece, crc), initial=0)
        # One more value a text: the CRC of nothing, before its first word.
        self.after = np.array(crcs, np.uint32)
        self.ends, self.sizes = ends, sizes

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The text and the CRC of each run of n words, in order."""
        counts = np.maximum(np.diff(self.first) - n + 1, 0)
        owner = np.repeat(np.arange(len(counts)), counts)
        if not len(owner):
            return owner, np.zeros(0, np.uint32)
        begin = np.arange(len(owner)) + (self.first[:-1] - np.cumsum(counts) + counts)[owner]
        last = begin + n - 1
        size = self.ends[last] - self.ends[begin] + self.sizes[begin]
        # Behind the space before the run, and behind its last word.
        space = np.uint32(zlib.crc32(b" "))
        before = moved_on(self.after[begin + owner], np.ones(len(begin), np.int64)) ^ space
        return owner, self.after[last + owner + 1] ^ moved_on(before, size)


def bucket_counts(texts: DataFrame, text: str, grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How many runs of words of all texts fall into each bucket; each task counts its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            crcs = RunningCrcs(batch.column("text"))
            for n in range(grams[0], grams[1] + 1):
                total += np.bincount(crcs.runs(n)[1] % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    counts = texts.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # one row a bucket at most
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share in the target over its share in the source, both plus one a bucket."""
    buckets, s, t = len(source), float(source.sum()), float(target.sum())
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + buckets) / ((a + 1.0) * (t + buckets)))) for a, b in pairs], np.int64)


def gumbel(key: Column, seed: str = SEED) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of sha256 of ``seed:key``; a null key is empty."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_scores(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS, seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs``, stored.

    ``weight`` is the floored mean gain of a text's n-grams (repeats count), 0
    without any, ``score`` that and a Gumbel draw by its id. A null or empty
    text has no words. Rows that repeat are counted and scored each; an empty
    target makes gains of the corpus alone. Any length of text.
    """
    spark = docs.sparkSession
    gains = bucket_gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, target_text, grams, buckets))
    known = spark.sparkContext.broadcast(gains)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            crcs = RunningCrcs(batch.column("text"))
            features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            for n in range(grams[0], grams[1] + 1):
                owner, crc = crcs.runs(n)
                sums = np.concatenate(([0], np.cumsum(known.value[crc % np.uint32(buckets)])))
                bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
                features += np.diff(bounds)
                total += np.diff(sums[bounds])
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            arrays = [pa.array(x, pa.int64()) for x in (np.diff(crcs.first), features, weight)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")
    return stored(found.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "importance")


def ranked(scores: DataFrame, per_cent: int = PER_CENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scores`` with the rank of the drawn rows, 1 for the highest score, ties to smaller ids; null for others.

    Drawn are floor(per_cent * N / 100) of the N rows with ``least_words``
    words. Rows are dealt by ranges of (score, id) and sorted there; each
    range's first rank follows from the ranges' sizes, a number each. Rows with
    one score and id are spread by a number of their own, so a repeated row is
    no hot range; that number repeats with its task, as ``scores`` is a written
    table. Null ids come last.
    """
    fit = scores.where(F.col("n_words") >= least_words)
    drawn = fit.count() * per_cent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("spread")]
    names = scores.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            places = [pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *places], [*batch.schema.names, "part", "place"])
            at += n

    dealt = fit.withColumn("spread", F.rand(7)).repartitionByRange(shuffle_width(scores.sparkSession), *order).sortWithinPartitions(*order)
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scores.schema)
    placed = stored(dealt.select(*names).mapInArrow(number, f"{shape}, part int, place long"), "ranges")
    sizes = sorted(map(tuple, placed.groupBy("part").agg(F.count("*")).collect()))  # one row a range
    before = [(part, end - n) for (part, n), end in zip(sizes, accumulate(n for _, n in sizes))]
    first = F.broadcast(scores.sparkSession.createDataFrame(before, "part int, before long"))
    rank = F.col("before") + F.col("place") + 1
    drawn_rows = placed.join(first, "part").select(*names, F.when(rank <= drawn, rank).alias("rank"))
    rest = scores.where(~F.coalesce(F.col("n_words") >= least_words, F.lit(False))).select(*names, F.lit(None).cast("long").alias("rank"))
    return drawn_rows.unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns; ``more`` goes to ``importance_scores``.

    Rows meet the drawn ids by a join on the id, so rows that repeat a drawn id
    come along with it; null ids are never drawn here.
    """
    ids = ranked(importance_scores(docs, target, key, text, **more)).where("rank is not null").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(ids, key, "left_semi").select(*docs.columns)
