"""Fixed-length windows of long sequences, grouped into runs that share a minimiser.

Every window of ``size`` symbols contains ``size - core + 1`` runs of ``core``
symbols; the one with the smallest hash, the leftmost among equals, is its
minimiser. That depends on the window's content alone, so equal windows have
equal minimisers at equal places. Consecutive windows with one minimiser make
one super-window, the string from the first one's start to the last one's end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, text_key
from .words import _BASE, U64, _powers, mix

PLACE = U64((1 << 26) - 1)
SEGMENT = 1 << 20  # symbols looked at together
NO_ID = (1 << 63) - 1
BUCKET_STRINGS = 1000  # strings of one minimiser that one task looks at together
SLICE_STRINGS = 1000
ANSWER = ["mini", "window", "weight", "uid", "start", "length"]

_grown: list[np.ndarray] = [_powers(_BASE, 1), _powers(_BASE, 1)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_grown[0]) < n:
        _grown[:] = [_powers(b, n + n // 2) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _grown


class Ranges:
    """Hashes of any ranges of a sequence of 64-bit symbols, from prefix sums."""

    def __init__(self, symbols: np.ndarray):
        up, self.down = _powers_to(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, U64)
        np.cumsum(symbols * up[: len(symbols)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, lengths) -> np.ndarray:
        return mix((self.sums[starts + lengths] - self.sums[starts]) * self.down[starts] + np.asarray(lengths).astype(U64))

    def every(self, length: int) -> np.ndarray:
        """Of all ranges of one length."""
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.down[:n] + U64(length))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by running minima from both ends of blocks."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    square = padded.reshape(blocks, width)
    left = np.minimum.accumulate(square, 1).ravel()
    right = np.minimum.accumulate(square[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def super_windows(symbols: np.ndarray, first: np.ndarray, size: int, core: int, values: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start, windows, minimiser, string hash) of each super-window; starts count from the text's first symbol.

    ``first`` are the texts' bounds in ``symbols``, which are 64-bit hashes, or
    places in ``values``. A text is looked at in
    segments, so a long one needs no more memory than many short ones; a
    super-window over a segment's end comes as two.
    """
    step = SEGMENT - size
    parts: list[list[tuple[int, int, int]]] = [[]]  # (text, from, to)
    held = 0
    for t, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b - a < size:
            continue
        for s in range(a, b - size + 1, step):
            e = min(b, s + step + size - 1)
            if held and held + e - s > SEGMENT:
                parts.append([])
                held = 0
            parts[-1].append((t, s, e))
            held += e - s
    for part in parts:
        if not part:
            continue
        joined = np.concatenate([symbols[s:e] for _, s, e in part])
        joined = joined if values is None else values[joined]
        lengths = np.array([e - s for _, s, e in part])
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        ranges = Ranges(joined)
        hashes = ranges.every(core)
        places = np.arange(len(hashes), dtype=U64)
        anchor = (sliding_min((hashes & ~PLACE) | places, size - core + 1) & PLACE).astype(np.int64)
        good = np.ones(len(anchor), bool)
        for b in bounds[1:-1]:
            good[max(0, b - size + 1) : b] = False
        at = np.flatnonzero(good)
        new = np.concatenate(([True], (np.diff(anchor[at]) != 0) | (np.diff(at) != 1)))
        begin = at[new]
        windows = np.diff(np.concatenate((np.flatnonzero(new), [len(at)])))
        owner = np.searchsorted(bounds, begin, "right") - 1
        text = np.array([t for t, _, _ in part])[owner]
        start = begin - bounds[owner] + np.array([s for _, s, _ in part])[owner] - first[text]
        yield text, start, windows, hashes[anchor[begin]], ranges(begin, windows + (size - 1))


def distinct_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(uid, hash, text, first_id, n): every distinct text once, written to the shared folder.

    ``first_id`` is the smallest document id (null if all are), ``n`` the number
    of rows. Copies meet by a 128-bit hash after each task has folded its own,
    so a text with a third of all rows costs one row a task.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = rows.groupBy(text_key(F.col("text")).alias("hash")).agg(
        F.first("text").alias("text"), F.min("id").alias("first_id"), F.count("*").alias("n")
    )
    return stored(grouped.select(F.monotonically_increasing_id().alias("uid"), "*"), "texts")


def per_document(docs: DataFrame, results: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, columns of ``results``) for every row of ``docs``, by the hash of its text."""
    rows = docs.select(F.col(key).alias("doc_id"), text_key(F.col(text)).alias("hash"))
    return rows.join(results, "hash").drop("hash")


def windows_by_minimiser(texts: DataFrame, run: Callable, label: str) -> DataFrame:
    """(uid, weight, start, windows, minimiser, string) of every super-window, stored.

    ``run`` maps a batch's text column to the arrays of ``super_windows``.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SEGMENT):
            uid, weight = (np.array(batch.column(c), np.int64) for c in ("uid", "weight"))
            for text, start, windows, mini, string in run(batch.column("text")):
                arrays = [uid[text], weight[text], start, windows, mini.view(np.int64), string.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], ["uid", "weight", "start", "windows", "mini", "string"])

    shape = "uid long, weight long, start long, windows long, mini long, string long"
    return stored(texts.select("uid", "weight", "text").mapInArrow(emit, shape), label)


def packed_strings(texts: DataFrame, wanted: DataFrame, cut: Callable) -> DataFrame:
    """The strings of some super-windows, cut from their texts and sent to their minimiser's bucket.

    ``wanted``: (uid, start, windows, mini, asks, strings), the last being the
    number of strings in the bucket. A bucket of more than ``BUCKET_STRINGS`` is
    dealt over as many parts as it takes, each in order of the minimisers.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            uid, weight, found = (batch.column(c).to_pylist() for c in ("uid", "weight", "found"))
            strings = cut(batch.column("text"), [[(f["start"], f["windows"]) for f in fs] for fs in found])
            for u, w, fs, own in zip(uid, weight, found, strings):
                rows += [(f["mini"], f["strings"], w, u, f["start"], f["asks"], s) for f, s in zip(fs, own)]
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.binary()]
            columns = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["mini", "strings", "weight", "uid", "start", "asks", "packed"])

    by_text = wanted.groupBy("uid").agg(F.collect_list(F.struct("start", "windows", "mini", "asks", "strings")).alias("found"))
    rows = texts.select("uid", "weight", "text").join(by_text, "uid").mapInArrow(
        emit, "mini long, strings long, weight long, uid long, start long, asks boolean, packed binary"
    )
    parts = F.ceil(F.col("strings") / BUCKET_STRINGS)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("packed"), parts)).repartition("mini", "part")
    return rows.sortWithinPartitions("mini", "part")


def whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by minimiser, in slices of about ``SLICE_STRINGS`` that end where a bucket does."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        mini = np.array(batch.column("mini"), np.int64)
        ends = np.flatnonzero(mini[1:] != mini[:-1]) + 1
        if held and len(mini) and held[-1].column("mini")[-1].as_py() != mini[0]:
            ends = np.concatenate(([0], ends))
        at, size = 0, sum(h.num_rows for h in held)
        for end in ends.tolist():
            if size + end - at >= SLICE_STRINGS:
                yield pa.concat_batches([*held, batch.slice(at, end - at)])
                held, at, size = [], end, 0
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.concat_batches(held)


def answered_windows(strings: DataFrame, expand: Callable, fold: Callable, says: Callable, merge, size: int, label: str) -> DataFrame:
    """(uid, start, length): where the asking strings' windows are repeated.

    ``expand`` gives the windows of some strings (string, place in it, hash,
    number of its group of equals in one bucket), ``fold`` a value of each group
    from its strings' weights, and ``says`` whether that value answers a weight.
    A bucket in one part is answered there and then. Of a bucket in several
    parts, the groups' values meet by minimiser and hash (``merge``), and the
    windows not yet answered ask those.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_buckets(batches):
            mini, uid, weight, start, of = (np.array(batch.column(c), np.int64) for c in ("mini", "uid", "weight", "start", "strings"))
            asks = np.array(batch.column("asks").to_pylist(), bool)
            owner, inside, names, group = expand(batch.column("packed"), mini)
            value = fold(group, weight[owner])
            yes = asks[owner] & says(value[group], weight[owner])
            change = np.ones(len(owner), bool)
            change[1:] = owner[1:] != owner[:-1]
            first = np.flatnonzero(yes & (change | ~np.concatenate(([False], yes[:-1]))))
            last = np.flatnonzero(yes & np.concatenate((change[1:] | ~yes[1:], np.ones(min(1, len(yes)), bool))))
            at = owner[first]
            yield _answer(uid=uid[at], start=start[at] + inside[first], length=last - first + size)
            many = of[owner] > BUCKET_STRINGS
            _, one = np.unique(group[many], return_index=True)
            one = np.flatnonzero(many)[one]
            yield _answer(mini=mini[owner[one]], window=names[one], weight=value[group[one]])
            left = np.flatnonzero(many & asks[owner] & ~yes)
            at = owner[left]
            yield _answer(mini=mini[at], window=names[left], weight=weight[at], uid=uid[at], start=start[at] + inside[left])

    found = stored(strings.mapInArrow(run, ", ".join(f"{c} long" for c in ANSWER)), label)
    done = found.where("length is not null").select("uid", "start", "length")
    values = stored(found.where("uid is null").groupBy("mini", "window").agg(merge("weight").alias("value")), f"{label}-values")
    left = found.where("uid is not null and length is null").join(values, ["mini", "window"])
    left = left.where(says(F.col("value"), F.col("weight")))
    return done.unionByName(left.select("uid", "start", F.lit(size).cast("long").alias("length")))


def _answer(**columns: np.ndarray) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[c], pa.int64()) if c in columns else pa.nulls(n, pa.int64()) for c in ANSWER]
    return pa.RecordBatch.from_arrays(arrays, ANSWER)


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``texts`` with an array of its (start, length) spans, null if it has none."""
    return texts.join(spans.groupBy("uid").agg(F.collect_list(F.struct("start", "length")).alias("spans")), "uid", "left")
