"""Token files: ids in canonical length-limited Huffman code, in blocks that can be read alone.

A written set is a folder of two tables:

* ``code``: (symbol, length) of every id that occurs. The code itself is
  canonical, that is, it follows from the lengths: shorter codes first, equal
  lengths by symbol.
* ``blocks``: (first_token, n_tokens, doc_ids, doc_tokens, checkpoints, bits):
  some whole documents that follow one another, their ids and numbers of ids,
  and the place of the block's first id among all. ``bits`` is the code of the
  block's ids, first bit highest; ``checkpoints`` are the bit offsets of every
  64th id, so that a block is decoded from many places at once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cleaned_shuffles, discard, shuffle_width, slices, stored
from .tokens import END_ID, encoder
from .words import text_bytes

MAX_BITS = 20
CHECKPOINT = 64
BLOCK_TOKENS = 1 << 16
SAMPLED = 16  # places a range that bounds are chosen from
BLOCKS = "first_token long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, checkpoints binary, bits binary"


def code_lengths(counts: dict[int, int], limit: int = MAX_BITS) -> dict[int, int]:
    """Best code lengths of at most ``limit`` bits: package-merge over the symbols by count.

    A single symbol has one bit. A limit without room for all symbols is raised
    to the least that has it.
    """
    if len(counts) <= 1:
        return {s: 1 for s in counts}
    limit = max(limit, (len(counts) - 1).bit_length())
    order = sorted(counts, key=lambda s: (counts[s], s))
    weights = np.array([counts[s] for s in order], np.int64)
    # Each level merges the symbols with the pairs of the level below. Only how many
    # symbols the chosen part of a level holds matters, from the top level down.
    levels, pairs = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate((weights, pairs))
        rank = np.argsort(both, kind="stable")
        levels.append(rank < len(weights))
        merged = both[rank]
        merged = merged[: len(merged) // 2 * 2]
        pairs = merged[0::2] + merged[1::2]
    lengths, take = np.zeros(len(order), np.int64), 2 * len(order) - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    return dict(zip(order, lengths.tolist()))


class Code:
    """Canonical code of (symbol, length) pairs, with the tables to write and read it."""

    def __init__(self, lengths: dict[int, int]):
        ordered = sorted(lengths.items(), key=lambda x: (x[1], x[0]))
        self.limit = max([x[1] for x in ordered], default=1)
        top = max(lengths, default=0) + 1
        self.length, self.code = np.zeros(top, np.int64), np.zeros(top, np.uint64)
        self.symbol_at = np.zeros(1 << self.limit, np.uint32)
        self.length_at = np.ones(1 << self.limit, np.uint8)
        code = last = 0
        for symbol, n in ordered:
            code <<= n - last
            last = n
            self.length[symbol], self.code[symbol] = n, code
            room = self.limit - n
            self.symbol_at[code << room : (code + 1) << room] = symbol
            self.length_at[code << room : (code + 1) << room] = n
            code += 1

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of the ids, and the bit offset of every ``CHECKPOINT``-th."""
        n = self.length[ids]
        ends = np.cumsum(n)
        begins = ends - n
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros(total // 32 + 2, np.uint64)
        slot = begins >> 5
        value = self.code[ids] << (64 - (begins & 31) - n).astype(np.uint64)
        if len(ids):
            firsts = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
            words[slot[firsts]] += np.add.reduceat(value >> np.uint64(32), firsts)
            words[slot[firsts] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), firsts)
        return words.astype(">u4").tobytes()[: (total + 7) // 8], begins[::CHECKPOINT].astype("<u4")

    def decode(self, bits: bytes, checkpoints: np.ndarray, n_tokens: int) -> np.ndarray:
        """The ids again: all checkpoints advance together, one table look-up an id."""
        raw = np.frombuffer(bits + bytes(16), np.uint8).astype(np.uint32)
        # 32 bits from each byte on.
        wide = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        at = checkpoints.astype(np.int64)
        out = np.zeros((len(at), CHECKPOINT), np.uint32)
        last = len(wide) - 1
        for k in range(CHECKPOINT):
            byte = np.minimum(at >> 3, last)
            window = (wide[byte] << (at & 7).astype(np.uint32)) >> np.uint32(32 - self.limit)
            out[:, k] = self.symbol_at[window]
            at += self.length_at[window]
        return out.ravel()[:n_tokens]


def _bounds(rows: DataFrame, parts: int) -> list[tuple]:
    """Where (key, spread) pass from one range to the next, from about ``SAMPLED`` places a range.

    A null key comes first. ``spread`` tells rows of one key apart, so a key
    with a third of all rows has bounds inside.
    """
    total = rows.count()
    if parts < 2 or not total:
        return []
    share = min(1.0, SAMPLED * parts / total)
    some = rows.where(F.pmod(F.xxhash64("spread"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) or 1))
    found = sorted((r["known"], r["doc_id"] or 0, r["spread"]) for r in some.collect())
    return sorted({found[len(found) * i // parts] for i in range(1, parts)}) if found else []


def _ordered(docs: DataFrame, tokenizer: str, end_id: int, parts: int) -> DataFrame:
    """(bucket, doc_id, within, n_tokens, ids, counts): each bucket's documents in ascending order, in one task.

    Buckets are ranges of doc_id, and inside one id of a number that spreads its
    rows; their bounds come from the ids alone. ``within`` counts the ids before
    a document in its bucket. Each task adds a row without a bucket, whose
    ``counts`` are its occurrences of every id, so that nobody has to read the
    ids again to count them.
    """
    keyed = docs.withColumn("known", F.col("doc_id").isNotNull()).withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    bounds = _bounds(keyed.select("known", "doc_id", "spread"), parts)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.width).tobytes()
        for batch in slices(batches, "text"):
            ids = [x + end for x in enc.packed(batch.column("text").to_pylist())]
            keys, spread = batch.column("doc_id"), batch.column("spread")
            places = zip(keys.to_pylist(), spread.to_pylist())
            bucket = [bisect_right(bounds, (k is not None, k or 0, s)) for k, s in places]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), keys, spread, pa.array(ids, pa.binary())], ["bucket", "doc_id", "spread", "ids"]
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, now, at, total = encoder(tokenizer).width, None, 0, np.zeros(0, np.int64)
        names = ["bucket", "doc_id", "ids", "within", "n_tokens", "counts"]
        for batch in batches:
            data, ends = text_bytes(batch.column("ids"))
            n, within = (np.diff(ends) // width.itemsize).tolist(), []
            own = np.bincount(data.view(width) if len(data) else [], minlength=len(total))
            own[: len(total)] += total
            total = own
            for bucket, k in zip(batch.column("bucket").to_pylist(), n):
                if bucket != now:
                    now, at = bucket, 0
                within.append(at)
                at += k
            arrays = [batch.column(c) for c in names[:3]] + [pa.array(within, pa.int64()), pa.array(n, pa.int64()), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names)
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip([None] * 5 + [total.astype("<i8").tobytes()], kinds)], names)

    ids = keyed.select("doc_id", "text", "spread").mapInArrow(tokenize, "bucket int, doc_id long, spread long, ids binary")
    ids = ids.repartition(parts, "bucket").sortWithinPartitions("bucket", F.asc_nulls_first("doc_id"), "spread")
    return ids.mapInArrow(count, "bucket int, doc_id long, ids binary, within long, n_tokens long, counts binary")


def _counts(tokens: DataFrame) -> DataFrame:
    """(symbol, n) over all ids, from the counts of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column("counts"):
                n = np.frombuffer(own.as_buffer(), "<i8")
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(n[seen], pa.int64())], ["symbol", "n"])

    own = tokens.where("counts is not null").select("counts")
    return own.mapInArrow(run, "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str, key: str = "doc_id", text: str = "text",
    end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the token files of ``docs`` to ``path``, a folder that all executors can write to.

    A document is its ids and ``end_id``; a null or empty text is the end id
    alone. Documents stand in ascending order of their keys, null keys first;
    rows with the same key stand in no particular order. No documents: a
    code without symbols and no block. Any length of text; other columns take
    no part.
    """
    spark = docs.sparkSession
    width = encoder(tokenizer).width.str
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tokens = stored(_ordered(rows, tokenizer, end_id, 2 * shuffle_width(spark)), "tokens")

    counts = {r["symbol"]: r["n"] for r in _counts(tokens).collect()}  # at most the vocabulary
    lengths = code_lengths(counts)
    code = spark.sparkContext.broadcast(Code(lengths))
    before, at = {}, 0  # one number a bucket: the ids before it
    placed = tokens.where("bucket is not null").drop("counts")
    for r in sorted(placed.groupBy("bucket").agg(F.sum("n_tokens").alias("n")).collect()):
        before[r["bucket"]], at = at, at + r["n"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that follow one another, encoded together until they have ``block_tokens`` ids."""
        docs_of, held, first, n = [], [], 0, 0

        def block() -> pa.RecordBatch:
            bits, points = code.value.encode(np.frombuffer(b"".join(held), width))
            ids, sizes = zip(*docs_of)
            values = [first, n, list(ids), list(sizes), points.tobytes(), bits]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            names = ["first_token", "n_tokens", "doc_ids", "doc_tokens", "checkpoints", "bits"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "within", "n_tokens", "ids")))
            for bucket, doc_id, within, size, ids in rows:
                start = before[bucket] + within
                if n and (n >= block_tokens or start != first + n):
                    yield block()
                    docs_of, held, n = [], [], 0
                if not n:
                    first = start
                docs_of.append((doc_id, size))
                held.append(ids)
                n += size
        if n:
            yield block()

    with cleaned_shuffles(spark):
        spark.createDataFrame([*lengths.items()], "symbol int, length int").coalesce(1).write.parquet(f"{path}/code")
        written = placed.mapInArrow(blocks, BLOCKS)
        written.write.option("compression", "none").parquet(f"{path}/blocks")
    discard(tokens)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of written token files; ids are little-endian unsigned 32-bit integers.

    Each block is decoded alone, so a read is one map and can start anywhere.
    """
    lengths = {r["symbol"]: r["length"] for r in spark.read.parquet(f"{path}/code").collect()}
    code = spark.sparkContext.broadcast(Code(lengths))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = code.value.decode(r["bits"], np.frombuffer(r["checkpoints"], "<u4"), r["n_tokens"])
                ends = np.cumsum(r["doc_tokens"])
                starts = ends - r["doc_tokens"]
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(r["doc_ids"], pa.int64()), pa.array(starts + r["first_token"], pa.int64()),
                        pa.array(r["doc_tokens"], pa.int64()),
                        pa.array([raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").select("first_token", "n_tokens", "doc_ids", "doc_tokens", "checkpoints", "bits")
    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
