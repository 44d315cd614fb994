"""Benchmark decontamination: broadcast set of benchmark n-grams, scanned over every document's word windows."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, discard, map_batches, slices, stored, unused
from .words import ALNUM, Words, covered, maximal_runs, runs

WINDOW = 10
BLOCK_ROWS = 500_000  # windows in one broadcast
MARKS = ["n_words", "n_hit", "items", "hit_words"]


def benchmark_windows(benchmark: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """Distinct rows (n, window, item): each run of ``window`` words of an item, or all its words if they are fewer.

    A null or wordless text has no window. A null id marks words but is no item.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"), ALNUM, lower=True)
            ids, sizes, texts, items = batch.column("item").to_pylist(), [], [], []
            for d, item in enumerate(ids):
                a, b = int(words.first[d]), int(words.first[d + 1])
                n = min(window, b - a)
                for i in range(a, b - n + 1 if n else a):
                    sizes.append(n)
                    texts.append(words.joined(i, i + n))
                    items.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes, pa.int32()), pa.array(texts, pa.binary()), pa.array(items, pa.string())], ["n", "window", "item"]
            )

    rows = benchmark.select(F.col(text).alias("text"), F.col(item_id).cast("string").alias("item"))
    return rows.mapInArrow(emit, "n int, window binary, item string").distinct()


class WindowSet:
    """Windows by length: sorted hashes, a bitmap to refuse most others, and the words and items to verify."""

    def __init__(self, rows: list):
        self.by_length = {}
        for n in sorted({r["n"] for r in rows}):
            items = defaultdict(set)
            for r in rows:
                if r["n"] == n:
                    items[bytes(r["window"])].add(r["item"])
            texts = sorted(items)
            found = Words(pa.array(texts, pa.binary()), ALNUM)
            at, hashes = runs(found.hashes, found.first, n)
            by_hash = defaultdict(list)
            for h, t in zip(hashes.tolist(), texts):
                by_hash[h].append((t, items[t]))
            bits = np.zeros(1 << 20, bool)
            bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.by_length[n] = (np.unique(hashes), bits, dict(by_hash))

    def find(self, words: Words) -> Iterator[tuple[int, int, set]]:
        """(first word, length, items) of each occurrence, its words compared."""
        for n, (hashes, bits, by_hash) in self.by_length.items():
            at, got = runs(words.hashes, words.first, n)
            near = np.flatnonzero(bits[(got >> np.uint64(44)).astype(np.int64)])
            near = near[np.isin(got[near], hashes)]
            for i in near.tolist():
                start = int(at[i])
                text = words.joined(start, start + n)
                for known, items in by_hash[int(got[i])]:
                    if known == text:
                        yield start, n, items


def _scan(docs: DataFrame, text: str, marked: list[str], known, keep_text: str | None) -> DataFrame:
    """One pass over the documents: marks of this block's windows added to those of earlier blocks."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = known.value
        for batch in slices(batches, text):
            words = Words(batch.column(text), ALNUM, lower=True)
            hit = np.zeros(len(words.starts), bool)
            items = [set(x or ()) for x in batch.column(marked[2]).to_pylist()]
            first = words.first
            for d, old in enumerate(batch.column(marked[3]).to_pylist()):
                if old:
                    n = first[d + 1] - first[d]
                    hit[first[d] : first[d + 1]] = np.unpackbits(np.frombuffer(old, np.uint8), count=int(n)).astype(bool)
            for start, n, ids in windows.find(words):
                hit[start : start + n] = True
                items[int(np.searchsorted(first, start, "right")) - 1].update(x for x in ids if x is not None)
            sums = np.concatenate(([0], np.cumsum(hit)))
            hits = sums[first[1:]] - sums[first[:-1]]
            packed = [np.packbits(hit[a:b]).tobytes() if n else None for a, b, n in zip(first[:-1], first[1:], hits)]
            marks = [
                pa.array(words.counts(), pa.int64()), pa.array(hits, pa.int64()),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(packed, pa.binary()),
            ]
            columns = dict(zip(batch.schema.names, batch.columns)) | dict(zip(marked, marks))
            if keep_text:
                columns[keep_text] = _without(batch.column(text), words, hit)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return map_batches(docs, scan, docs.schema)


def _without(column: pa.Array, words: Words, hit: np.ndarray) -> pa.Array:
    """Texts without each maximal run of hit words, from its first letter to its last."""
    out = column.to_pylist()
    for d in range(len(out)):
        a, b = words.first[d], words.first[d + 1]
        if not hit[a:b].any():
            continue
        raw, base, at, parts = out[d].encode(), words.offsets[d], 0, []
        for s, e in zip(*maximal_runs(hit[a:b])):
            parts.append(raw[at : words.starts[a + s] - base])
            at = words.ends[a + e - 1] - base
        out[d] = b"".join([*parts, raw[at:]]).decode()
    return pa.array(out, pa.string())


def mark_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
    window: int = WINDOW, block_rows: int = BLOCK_ROWS, remove_spans: bool = False, marks: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the columns ``marks``: words, words inside benchmark windows, items, a bit for each word.

    The windows are dealt by hash into blocks of about ``block_rows``, so that
    what is collected and broadcast at once has a known size whatever the
    benchmark's; each block is one map over the documents, without a shuffle.
    ``remove_spans`` cuts the hit words out of the text.

    Null or empty text: no words, no hit; any length of text. Repeated documents
    are marked each. No item, or items without words: nothing is hit. Names may
    hold dots; ``marks`` are ``MARKS``, made new by underscores, unless given.
    """
    spark = docs.sparkSession
    names = marks or [unused(docs.columns, m) for m in MARKS]
    windows = stored(benchmark_windows(benchmark, item_text, item_id, window), "windows")
    blocks = max(1, -(-windows.count() // block_rows))
    kinds = ["long", "long", "array<string>", "binary"]
    marked = docs.select(*map(column, docs.columns), *[F.lit(None).cast(k).alias(n) for n, k in zip(names, kinds)])
    for block in range(blocks):
        rows = windows.where(F.pmod(F.xxhash64("n", "window", "item"), F.lit(blocks)) == block).collect()
        last = block == blocks - 1
        marked = _scan(marked, text, names, spark.sparkContext.broadcast(WindowSet(rows)), text if remove_spans and last else None)
        if not last:
            marked = stored(marked, "marked")
    discard(windows)
    return marked


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", spans: bool = False, **more) -> DataFrame:
    """``docs`` without contaminated documents, or with their hit words cut out (``spans``); the columns stay."""
    marks = [unused(docs.columns, m) for m in MARKS]
    marked = mark_contamination(docs, benchmark, text, remove_spans=spans, marks=marks, **more)
    return (marked if spans else marked.where(column(marks[1]) == 0)).select(*map(column, docs.columns))


def contamination_report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """Per document: words, hit words, items found and a digest of their ids."""
    rows = docs.select(column(key).alias("doc_id"), column(text).alias("text"))
    marked = mark_contamination(rows, benchmark, **more)
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
