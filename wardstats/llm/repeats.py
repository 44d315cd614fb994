"""Suffix-array dedup to a limited depth: bytes inside any string of 200 bytes that starts twice go.

Suffixes are ordered only through their first ``size`` bytes, digit by digit
from the most significant, and a suffix alone in its group leaves at once. The
first digit is the suffix's minimiser, half its bytes, which consecutive
suffixes share, so one row stands for many. The second is the whole string of
such a run: if that is repeated, so are all its suffixes. What is left goes to
its group's bucket, where a radix sort on 8-byte digits follows, as deep as
``size``. Groups that remain are exactly the repeated strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored
from .windows import answered_windows, distinct_texts, packed_strings, per_document, super_windows, windows_by_minimiser, with_spans
from .words import _BYTE, U64, covered, maximal_runs, mix, text_bytes

SIZE, DIGIT = 200, 100


def radix_groups(bucket: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """A number for each row, the same for rows of one bucket with the same bytes.

    Most-significant-digit passes of 8 bytes; a row alone in its group takes no further part.
    """
    n, width = windows.shape
    _, group = np.unique(bucket, return_inverse=True)
    out, live = np.zeros(n, np.int64), np.arange(n)
    used = 0
    for a in range(0, width, 8):
        digit = np.zeros((len(live), 8), np.uint8)
        digit[:, : min(8, width - a)] = windows[live, a : a + 8]
        order = np.lexsort((digit.view(">u8").ravel(), group))
        g, d = group[order], digit.view(">u8").ravel()[order]
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(g) != 0) | (d[1:] != d[:-1])
        number = np.cumsum(new) - 1
        size = np.bincount(number)
        alone = size[number] == 1
        out[live[order[alone]]] = used + np.arange(alone.sum())
        used += int(alone.sum())
        live, group = live[order[~alone]], number[~alone]
        if not len(live):
            return out
    _, last = np.unique(group, return_inverse=True)
    out[live] = used + last
    return out


def _cut(column: pa.Array, wanted: list[list[tuple[int, int]]], size: int) -> list[list[bytes]]:
    data, at = text_bytes(column)
    raw = data.tobytes()
    return [[raw[a + s : a + s + n + size - 1] for s, n in own] for a, own in zip(at.tolist(), wanted)]


def _ordered(column: pa.Array, mini: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """The suffixes of packed strings to their depth; equal ones of a bucket get one number."""
    data, at = text_bytes(column)
    count = np.diff(at) - (size - 1)
    owner = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    if not len(owner):
        return owner, inside, owner, owner
    rows = np.lib.stride_tricks.sliding_window_view(data, size)[at[owner] + inside]
    return owner, inside, _hashes(rows).view(np.int64), radix_groups(mini[owner], rows)


def _total(group: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return np.bincount(group, weights=weight).astype(np.int64)


def _hashes(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), U64)
    for k in range(rows.shape[1]):
        out = out * U64(0x9E3779B97F4A7C15) + _BYTE[rows[:, k]]
    return mix(out)


def repeated_spans(texts: DataFrame, size: int = SIZE, digit: int = DIGIT) -> DataFrame:
    """(uid, start, length) in bytes of strings that start more than once; ``texts``: (uid, weight, text), the weight is its number of rows."""

    def run(column: pa.Array):
        data, at = text_bytes(column)
        return super_windows(data, at, size, digit, _BYTE)

    every = windows_by_minimiser(texts, run, "suffix-runs")
    # Tables of counts are written first: a join of two plain shuffles can split a hot digit.
    shared = stored(every.groupBy("mini").agg(F.sum("weight").alias("total")).where("total > 1").select("mini"), "shared")
    live = stored(every.join(shared, "mini"), "shared-runs")
    whole = live.groupBy("mini", "string").agg(F.sum("weight").alias("total"), F.min(F.struct("uid", "start", "windows")).alias("r"))
    whole = stored(whole, "whole-runs")
    done = live.join(whole.where("total > 1").select("mini", "string"), ["mini", "string"])
    done = done.select("uid", "start", (F.col("windows") + (size - 1)).alias("length"))

    # Runs that are alone as a whole meet the other runs of their first digit.
    mixed = whole.groupBy("mini").agg(F.count("*").alias("strings"), F.min("total").alias("least")).where("strings > 1 and least = 1")
    mixed = stored(mixed.select("mini", "strings"), "mixed")
    wanted = whole.join(mixed, "mini").select("r.uid", "r.start", "r.windows", "mini", (F.col("total") == 1).alias("asks"), "strings")
    strings = packed_strings(texts, wanted, lambda column, own: _cut(column, own, size))
    again = answered_windows(
        strings, lambda column, mini: _ordered(column, mini, size), _total, lambda total, weight: total > 1, F.sum, size, "ordered-suffixes"
    )
    return done.unionByName(again)


def kept_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, digit: int = DIGIT) -> DataFrame:
    """Per distinct text: (hash, n_bytes, n_removed, n_spans, kept), ``kept`` being the bytes that stay."""
    texts = distinct_texts(docs, key, text)
    spans = repeated_spans(texts.withColumn("weight", F.col("n")), size, digit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = text_bytes(batch.column("text"))
            n_removed, n_spans, kept = [], [], []
            for a, b, spans in zip(at[:-1].tolist(), at[1:].tolist(), batch.column("spans").to_pylist()):
                gone = np.zeros(b - a, bool)
                if spans:
                    gone = covered(np.array([s["start"] for s in spans]), np.array([s["length"] for s in spans]), b - a)
                n_removed.append(int(gone.sum()))
                n_spans.append(len(maximal_runs(gone)[0]))
                kept.append(data[a:b][~gone].tobytes())
            arrays = [pa.array(np.diff(at), pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("hash"), *arrays], ["hash", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = with_spans(texts, spans).select("hash", "text", "spans")
    return rows.mapInArrow(run, "hash binary, n_bytes long, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, digit: int = DIGIT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): documents without bytes of strings of ``size`` bytes that start anywhere else too.

    Strings are judged on the input and never cross documents; overlaps count.
    A null text is empty. A text in two rows, of one id or not, repeats all its
    strings, so nothing of it stays if it has ``size`` bytes or more. ``kept`` is
    binary: a cut may fall inside a character.
    """
    return per_document(docs, kept_texts(docs, key, text, size, digit), key, text)
