"""Substring dedup by super-k-mers: word windows that also occur in an earlier document go.

Super-windows (runs of windows that share a minimiser) are counted by
minimiser. Those whose minimiser occurs in one document only are done; equal
whole strings are folded; the strings that are left travel packed to their
minimiser's bucket, where their windows are sorted and the smallest document of
each found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored
from .windows import NO_ID, answered_windows, distinct_texts, packed_strings, per_document, super_windows, windows_by_minimiser, with_spans
from .words import Words, covered, runs

WINDOW, CORE = 50, 26


def _cut(column: pa.Array, wanted: list[list[tuple[int, int]]], size: int) -> list[list[bytes]]:
    words = Words(column)
    return [[words.joined(int(f) + s, int(f) + s + n + size - 1) for s, n in own] for f, own in zip(words.first, wanted)]


def _sorted(column: pa.Array, mini: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """The windows of packed strings; equal ones of a bucket stand together once sorted and get one number."""
    words = Words(column)
    at, hashes = runs(words.hashes, words.first, size)
    owner = np.searchsorted(words.first, at, "right") - 1
    order = np.lexsort((hashes, mini[owner]))
    m, h = mini[owner][order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (m[1:] != m[:-1]) | (h[1:] != h[:-1])
    group = np.zeros(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return owner, at - words.first[owner], hashes.view(np.int64), group


def _least(group: np.ndarray, weight: np.ndarray) -> np.ndarray:
    out = np.full(group.max(initial=-1) + 1, NO_ID)
    np.minimum.at(out, group, weight)
    return out


def repeated_spans(texts: DataFrame, size: int = WINDOW, core: int = CORE) -> DataFrame:
    """(uid, start, length) in words: windows of each text that also start in a document with a smaller id.

    ``texts``: (uid, weight, text); the weight is the document id.
    """

    def run(column: pa.Array):
        words = Words(column)
        return super_windows(words.hashes, words.first, size, core)

    every = windows_by_minimiser(texts, run, "super-windows")
    # Tables of counts are written first: a join of two plain shuffles can split a hot minimiser.
    shared = stored(every.groupBy("mini").agg(F.min("weight").alias("least"), F.max("weight").alias("most")).where("least < most"), "shared")
    live = stored(every.join(shared.select("mini"), "mini"), "shared-windows")
    whole = live.groupBy("mini", "string").agg(F.min(F.struct("weight", "uid", "start")).alias("r"))
    whole = stored(whole.select("mini", "string", F.col("r.weight").alias("first"), F.col("r.uid").alias("ruid"), F.col("r.start").alias("rstart")), "strings")
    met = stored(live.join(whole, ["mini", "string"]), "met")
    done = met.where("first < weight").select("uid", "start", (F.col("windows") + (size - 1)).alias("length"))

    # One of each string's occurrences (all in its first document at most ask) meets the bucket's other strings.
    mixed = whole.groupBy("mini").agg(F.min("first").alias("least"), F.count("*").alias("strings")).where("strings > 1")
    mixed = stored(mixed, "mixed")
    reps = met.where("first = weight").join(mixed, "mini")
    reps = reps.where("least < weight or (uid = ruid and start = rstart)")
    wanted = reps.select("uid", "start", "windows", "mini", (F.col("least") < F.col("weight")).alias("asks"), "strings")
    strings = packed_strings(texts, wanted, lambda column, own: _cut(column, own, size))
    late = answered_windows(
        strings, lambda column, mini: _sorted(column, mini, size), _least, lambda first, weight: first < weight, F.min, size, "sorted-windows"
    )
    return done.unionByName(late)


def kept_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW, core: int = CORE) -> DataFrame:
    """Per distinct text (hash, first_id, n_words, n_removed, kept, plain) of its first document.

    ``kept``: the words that stay, one space between.
    """
    texts = distinct_texts(docs, key, text)
    spans = repeated_spans(texts.withColumn("weight", F.coalesce("first_id", F.lit(NO_ID))), size, core)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            removed, kept = [], []
            for d, spans in enumerate(batch.column("spans").to_pylist()):
                a, b = int(words.first[d]), int(words.first[d + 1])
                gone = np.zeros(b - a, bool)
                if spans:
                    gone = covered(np.array([s["start"] for s in spans]), np.array([s["length"] for s in spans]), b - a)
                stay = np.flatnonzero(~gone) + a
                raw = words.data
                kept.append(b" ".join([raw[s:e].tobytes() for s, e in zip(words.starts[stay].tolist(), words.ends[stay].tolist())]).decode())
                removed.append(int(gone.sum()))
            arrays = [batch.column("hash"), batch.column("first_id"), pa.array(words.counts(), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["hash", "first_id", "n_words", "n_removed", "kept"])

    rows = with_spans(texts, spans).select("hash", "first_id", "text", "spans")
    return rows.mapInArrow(run, "hash binary, first_id long, n_words long, n_removed long, kept string")


def for_documents(docs: DataFrame, results: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW, kept: str = "kept", none="") -> DataFrame:
    """(doc_id, n_words, n_removed, ``kept``) of every row of ``docs``.

    The first document of a text has the text's result; in a copy with a larger
    id (or none) every word of a text of ``size`` words or more goes. Shorter
    texts stay whole.
    """
    rows = per_document(docs, results, key, text)
    first = F.col("doc_id").cast("long").eqNullSafe(F.col("first_id")) | (F.col("n_words") < size)
    return rows.select(
        "doc_id", "n_words", F.when(first, F.col("n_removed")).otherwise(F.col("n_words")).alias("n_removed"),
        F.when(first, F.col(kept)).otherwise(F.lit(none)).alias(kept),
    )


def without_repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW, core: int = CORE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): documents without words that an earlier document's windows cover.

    A window is ``size`` consecutive words of one document; it goes if the same
    words start in a document with a smaller id, judged on the input. A null or
    empty text has no words. A null id is later than all others, and two null
    ids, or rows that repeat an id, are neither earlier than one another.
    """
    return for_documents(docs, kept_texts(docs, key, text, size, core), key, text, size)
