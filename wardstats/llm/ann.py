"""Approximate nearest neighbours by balanced posting lists around centroids.

Centroids come from a bounded sample and are searched by a proximity graph in
memory. Every vector stands in the list of its nearest centroid, and boundary
vectors also in others almost as near. A query reads the lists whose centroids
are within a ratio of its nearest one.

Queries with near first lists share a block, and a vector comes to a block once
for all lists that its queries read. The block's vectors are dealt over parts;
each passes by in bounded slices, while every query keeps its k best so far. So
the comparison gives k rows a query and part, however many lists it reads.

The ratio is measured: some of the queries are compared with every vector, and
it grows until the lists that they would read hold the wanted share of their
true neighbours; if no ratio does, all lists are read.

Largest inner product becomes smallest distance by one more component: each
vector gets the root of (largest squared norm - own squared norm), a query 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_width, stored

SAMPLE = 20_000  # vectors that centroids are fitted on
LIST_SIZE = 1024  # mean length of a list
MOST_LISTS = 16_384  # below the 32,768 bits of one of Spark's bitmaps
REPLICAS, REPLICA_RATIO = 4, 1.1
SEARCH_RATIO = 1.16  # at least; grows until RECALL is met
RECALL, HELD_OUT = 0.995, 256  # share of true neighbours, and the queries that it is measured on
LEAST_SEEN = 8  # a query's lists hold at least this many times k vectors
BEAM = 24
DEGREE = 16
CHUNK = 4096  # vectors that a task compares at once, and the least that are worth a part
QUERY_BLOCK = 4096
PARTS = 8  # of a block at most, unless all queries' results would still be fewer than the vectors


@dataclass
class Centroids:
    """Centroids and, for each, its nearest others; ``search`` walks that graph for many points at once."""

    points: np.ndarray
    near: np.ndarray
    entries: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, n: int, rounds: int = 8) -> Centroids:
        """Lloyd's rounds from evenly spaced sample rows; an empty centroid stays where it is. Near ones get near numbers."""
        points = sample[np.linspace(0, len(sample) - 1, n).astype(int)].copy()
        for _ in range(rounds):
            own = np.concatenate([_distances(part, points).argmin(1) for part in np.array_split(sample, len(sample) // 2048 + 1)])
            count = np.bincount(own, minlength=n)
            sums = np.zeros_like(points)
            np.add.at(sums, own, sample)
            points[count > 0] = sums[count > 0] / count[count > 0, None]
        points = points[_in_space(points)]
        degree = min(DEGREE, n - 1)
        near = []
        for part in np.array_split(np.arange(n), n // 2048 + 1):
            d = _distances(points[part], points)
            d[np.arange(len(part)), part] = np.inf
            near.append(np.argsort(d, 1, kind="stable")[:, :degree])
        near = np.concatenate(near).astype(np.int64)
        # One long edge each keeps far parts reachable.
        far = (np.arange(n) * 7919 + 1) % n
        return cls(points, np.concatenate([near, far[:, None]], 1), np.unique(np.linspace(0, n - 1, 8).astype(int)))

    def search(self, x: np.ndarray, ratio: float, least: float = 0.0) -> np.ndarray:
        """Squared distance of each point to each centroid that its walk met; others are infinite.

        Best first: the nearest centroid not yet expanded, until ``BEAM`` are
        expanded and the next is out of ``_reach``.
        """
        rows, n = np.arange(len(x)), len(self.points)
        seen = np.full((len(x), n), np.inf)
        seen[:, self.entries] = _distances(x, self.points[self.entries])
        todo = seen.copy()
        for step in range(n):
            best = todo.argmin(1)
            d = todo[rows, best]
            live = np.flatnonzero(np.isfinite(d) & ((step < BEAM) | (d <= _reach(seen.min(1), ratio, least))))
            if not len(live):
                break
            todo[live, best[live]] = np.inf
            neighbours = self.near[best[live]]
            new = np.isinf(seen[live[:, None], neighbours])
            r, c = np.nonzero(new)
            at, to = live[r], neighbours[r, c]
            dist = ((x[at] - self.points[to]) ** 2).sum(1)
            seen[at, to] = dist
            todo[at, to] = dist
        return seen


def _reach(nearest: np.ndarray, ratio: float, least: float) -> np.ndarray:
    """Squared distance up to which centroids count: ``ratio`` times the nearest, which counts as ``least`` at least."""
    return np.full_like(nearest, np.inf) if np.isinf(ratio) else ratio**2 * np.maximum(nearest, least)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None])


def _in_space(points: np.ndarray) -> np.ndarray:
    """Places of the points in an order that halves them along their widest axis, and each half again."""
    if len(points) < 2:
        return np.arange(len(points))
    order = np.argsort(points[:, points.var(0).argmax()], kind="stable")
    return np.concatenate([half[_in_space(points[half])] for half in np.array_split(order, 2)])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _padded(lists: pa.Array) -> np.ndarray:
    """The lists of each vector, and -1 up to ``REPLICAS``."""
    n = lists.value_lengths().to_numpy()
    at = np.full((len(n), REPLICAS), -1)
    at[np.arange(REPLICAS) < n[:, None]] = lists.flatten().to_numpy()
    return at


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): vectors without null, zero or holding null or non-finite components, as doubles.

    Rows that repeat an id and its vector count once; a null id takes no part.
    """
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False))).dropDuplicates(["id", "v"])


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    sample: int = SAMPLE, search_ratio: float = SEARCH_RATIO, recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, by inner product in double precision.

    Ties go to the smaller vec_id; a query's own id is no candidate. Vectors of
    another length than the queries' most frequent one take no part. Fewer than
    k candidates in all: all of them. No usable vector or query: no rows.
    Queries read centroids within ``search_ratio`` at least, and further until
    ``recall`` is met on ``HELD_OUT`` of them.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows, asked = usable(vectors, key, vector), usable(queries, key, vector)
    sizes = asked.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema)
    dim = sizes[0]["d"]
    rows, asked = stored(rows.where(F.size("v") == dim), "vectors"), asked.where(F.size("v") == dim)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    total, top = rows.agg(F.count("*"), F.max(norm)).collect()[0]
    if not total:
        return spark.createDataFrame([], schema)

    share = min(1.0, sample / total)
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))) if share < 1 else rows
    fit = [r["v"] for r in chosen.orderBy("id").select("v").collect()] or [r["v"] for r in rows.limit(1).collect()]
    fit = np.array(fit)
    fit = np.concatenate([fit, np.sqrt(np.maximum(0, top - (fit * fit).sum(1)))[:, None]], 1)
    n_lists = int(min(MOST_LISTS, max(1, round(total / LIST_SIZE)), len(fit)))
    graph = spark.sparkContext.broadcast(Centroids.fit(fit, n_lists))  # MOST_LISTS vectors at most

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        most = max(16, 4_000_000 // n_lists)
        for batch in batches:
            for i in range(0, batch.num_rows, most):
                part = batch.slice(i, most)
                yield part, _matrix(part.column("v"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in chunks(batches):
            more = np.sqrt(np.maximum(0, top - (x * x).sum(1)))[:, None]
            d = graph.value.search(np.concatenate([x, more], 1), REPLICA_RATIO)
            order = np.argsort(d, 1, kind="stable")[:, :REPLICAS]
            near = np.take_along_axis(d, order, 1)
            lists = [o[ok].tolist() for o, ok in zip(order, near <= REPLICA_RATIO**2 * near[:, :1])]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))], ["id", "v", "lists"])

    shape = "id long, v array<double>, lists array<int>"
    postings = stored(rows.mapInArrow(assign, shape), "postings")
    length = {r["l"]: r["n"] for r in postings.select(F.explode("lists").alias("l")).groupBy("l").agg(F.count("*").alias("n")).collect()}
    lengths = np.array([length.get(i, 0) for i in range(n_lists)])

    held_out = asked.orderBy(F.xxhash64("id"), "id", "v").limit(HELD_OUT).collect()
    some = np.array([r["v"] for r in held_out])
    place, true_lists = _true_neighbours(postings, np.array([r["id"] for r in held_out]), some, k)
    ratio, usual = _measured_ratio(graph.value, lengths, some, place, true_lists, k, search_ratio, recall)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in chunks(batches):
            order, wanted = _wanted(graph.value, lengths, x, k, ratio, usual)
            lists = [o[ok].tolist() for o, ok in zip(order, wanted)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))], ["id", "v", "lists"])

    probes = stored(asked.mapInArrow(choose, shape), "probes")
    asks = {r["l"]: r["n"] for r in probes.groupBy(F.col("lists")[0].alias("l")).agg(F.count("*").alias("n")).collect()}
    homes = spark.createDataFrame(_homes([asks.get(i, 0) for i in range(n_lists)]), "near int, first int, spread int")
    block = (F.col("first") + F.pmod(F.xxhash64("id", "v"), F.col("spread"))).cast("int").alias("block")
    probes = probes.withColumn("near", F.col("lists")[0]).join(F.broadcast(homes), "near").select(block, "id", "v", "lists")

    # The lists that a block reads, as bits: 4 kB a block of queries.
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col("l") + 1)).alias("bits")
    found = probes.select("block", F.explode("lists").alias("l")).groupBy("block").agg(bits).collect()
    blocks = np.array([r["block"] for r in found])
    reads = np.stack([np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")[: n_lists + 1] for r in found]).astype(bool)
    most = max(PARTS, total // (k * sum(asks.values())))
    parts = np.clip(-(-(reads[:, :n_lists] @ lengths) // CHUNK), 1, most)
    dealing = spark.sparkContext.broadcast((blocks, reads, parts))

    # Cells of a block and a part: first the queries, as of list -1, then the vectors by the first list read.
    cell = "block int, part int, l int, id long, v array<double>, lists array<int>"
    shares = F.broadcast(spark.createDataFrame([(int(b), int(n)) for b, n in zip(blocks, parts)], "block int, parts int"))
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    asking = probes.join(shares, "block").select("block", part, F.lit(-1).alias("l"), "id", "v", "lists")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, reads, parts = dealing.value
        most = max(1, 16_384 // len(blocks))
        for batch in batches:
            for i in range(0, batch.num_rows, most):
                vectors = batch.slice(i, most)
                at = _padded(vectors.column("lists"))
                hits = reads[:, at]
                b, row = np.nonzero(hits.any(2))
                place = np.mod(vectors.column("dealt").to_numpy()[row], parts[b])
                columns = [blocks[b], place, at[row, hits[b, row].argmax(1)]]
                rest = vectors.select(["id", "v", "lists"]).take(pa.array(row))
                columns = [pa.array(c.astype(np.int32)) for c in columns]
                yield pa.RecordBatch.from_arrays([*columns, *rest.columns], ["block", "part", "l", "id", "v", "lists"])

    held = postings.withColumn("dealt", F.xxhash64("id")).mapInArrow(deal, cell)
    cells = asking.unionByName(held).repartition(shuffle_width(spark), "block", "part").sortWithinPartitions("block", "part", "l")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, last = _Cell(k, n_lists), None
        for batch in batches:
            places = np.stack([batch.column(c).to_numpy() for c in ("block", "part")], 1)
            queries = batch.column("l").to_numpy() < 0
            ends = np.flatnonzero((places[1:] != places[:-1]).any(1) | (queries[1:] != queries[:-1])) + 1
            for start, end in zip([0, *ends], [*ends, len(places)]):
                if last != (last := tuple(places[start])):
                    yield cell.found()
                    cell = _Cell(k, n_lists)
                if queries[start]:
                    cell.ask(batch.slice(start, end - start))
                else:
                    for i in range(start, end, CHUNK):
                        cell.meet(batch.slice(i, min(CHUNK, end - i)))
        yield cell.found()

    pairs = cells.mapInArrow(compare, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _wanted(graph: Centroids, lengths: np.ndarray, x: np.ndarray, k: int, ratio: float, usual: float) -> tuple[np.ndarray, np.ndarray]:
    """Lists of each query from the nearest on, and whether it reads them: by ratio, and on until they hold enough vectors."""
    d = graph.search(np.concatenate([x, np.zeros((len(x), 1))], 1), ratio, usual)
    order = np.argsort(d, 1, kind="stable")
    near = np.take_along_axis(d, order, 1)
    held = np.cumsum(lengths[order], 1) - lengths[order]
    return order, (near <= _reach(near[:, :1], ratio, usual)) | (held < REPLICAS * LEAST_SEEN * k)


def _true_neighbours(postings: DataFrame, own: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the query, lists of a neighbour, -1 for none) of the queries' k nearest of all rows.

    Each task holds k rows a query, whatever it reads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, ids, lists = np.zeros((len(q), 0)), np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0, REPLICAS), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                part = batch.slice(i, CHUNK)
                new = np.array(part.column("id"), np.int64)
                rough = q @ _matrix(part.column("v")).T
                rough[own[:, None] == new[None]] = -np.inf
                at = np.array([x + [-1] * (REPLICAS - len(x)) for x in part.column("lists").to_pylist()])
                top = np.argsort(-rough, 1)[:, :k] if len(new) <= k else np.argpartition(-rough, k - 1, 1)[:, :k]
                score = np.concatenate([score, np.take_along_axis(rough, top, 1)], 1)
                ids, lists = np.concatenate([ids, new[top]], 1), np.concatenate([lists, at[top]], 1)
                best = np.argsort(-score, 1, kind="stable")[:, :k]
                score, ids = np.take_along_axis(score, best, 1), np.take_along_axis(ids, best, 1)
                lists = np.take_along_axis(lists, best[:, :, None], 1)
        r, c = np.nonzero(np.isfinite(score))
        columns = [pa.array(r), pa.array(score[r, c]), pa.array(ids[r, c]), pa.array(lists[r, c].tolist(), pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["place", "score", "id", "lists"])

    rows = postings.mapInArrow(run, "place long, score double, id long, lists array<int>")
    best = Window.partitionBy("place").orderBy(F.desc("score"), "id")
    found = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("place", "lists").collect()  # HELD_OUT times k
    return np.array([r["place"] for r in found], int), np.array([r["lists"] for r in found], int).reshape(-1, REPLICAS)


def _measured_ratio(
    graph: Centroids, lengths: np.ndarray, q: np.ndarray, place: np.ndarray, lists: np.ndarray, k: int, least: float, recall: float
) -> tuple[float, float]:
    """The first ratio from ``least`` on by which queries find that share of their true neighbours, and the queries' usual distance.

    The usual squared distance to the nearest centroid is the median: a query
    on top of a centroid has as far to look as others.
    """
    usual = float(np.median(graph.search(np.concatenate([q, np.zeros((len(q), 1))], 1), 1.0).min(1)))
    ratio = least
    while len(place) and ratio < 2:
        order, wanted = _wanted(graph, lengths, q, k, ratio, usual)
        read = np.zeros_like(wanted)
        np.put_along_axis(read, order, wanted, 1)
        if ((lists >= 0) & read[place[:, None], lists]).any(1).mean() >= recall:
            return ratio, usual
        ratio = 1 + (ratio - 1) * 1.25 if ratio > 1 else 1.01
    return (np.inf if len(place) else least), usual


def _homes(asks: list[int]) -> list[tuple[int, int, int]]:
    """(list, first block, number of blocks) for the queries nearest to each list.

    Lists with near numbers share a block of ``QUERY_BLOCK`` queries; more than
    that in one list are dealt over blocks of their own.
    """
    out, block, held = [], 0, 0
    for i, n in enumerate(asks):
        if held and held + n > QUERY_BLOCK:
            block, held = block + 1, 0
        spread = max(1, -(-n // QUERY_BLOCK))
        out.append((i, block, spread))
        block, held = (block + spread, 0) if spread > 1 else (block, held + n)
    return out


class _Cell:
    """The queries of a block and their k best of the vectors met, each query from the lists that it reads.

    Holds a flag for each query and list: at most about ``QUERY_BLOCK`` times ``MOST_LISTS`` bytes.
    """

    def __init__(self, k: int, n_lists: int):
        self.k, self.n_lists = k, n_lists
        self.own, self.q, self.want = np.zeros(0, np.int64), None, np.zeros((0, n_lists + 1), bool)
        self.row, self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.floor = np.zeros(0)  # the k-th best score so far

    def ask(self, batch: pa.RecordBatch) -> None:
        q, lists = _matrix(batch.column("v")), batch.column("lists")
        want = np.zeros((len(q), self.n_lists + 1), bool)  # the last for the -1 of no list
        want[np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
        self.own = np.concatenate([self.own, batch.column("id").to_numpy()])
        self.q = q if self.q is None else np.concatenate([self.q, q])
        self.want = np.concatenate([self.want, want])
        self.floor = np.full(len(self.own), -np.inf)

    def meet(self, batch: pa.RecordBatch) -> None:
        ids = batch.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x, at = ids[order], _matrix(batch.column("v"))[order], _padded(batch.column("lists"))[order]
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        live = np.flatnonzero(self.want[:, np.unique(at)].any(1))
        new = [self._nearest(x, ids, at, starts, live[i : i + 256]) for i in range(0, len(live), 256)]
        self._keep(*(np.concatenate(column) for column in zip((self.row, self.id, self.score), *new)))

    def _nearest(self, x: np.ndarray, ids: np.ndarray, at: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, id, score) of all that may be among those queries' k nearest ids.

        Found roughly by a matrix product, whose last digits may differ between
        equal rows; all that are as near as the k-th but for such digits are then
        computed in one fixed order of additions.
        """
        q, want, k = self.q[rows], self.want[rows], self.k
        rough = q @ x.T
        slack = 1e-9 * (1 + np.abs(rough).max())
        if not want[:, np.unique(at[:, 0])].all():
            rough[~np.any([want[:, lists] for lists in at.T], 0)] = -np.inf
        rough[self.own[rows][:, None] == ids[None]] = -np.inf
        best = rough if len(starts) == len(ids) else np.maximum.reduceat(rough, starts, 1)
        floor = self.floor[rows]
        if len(starts) > k:
            floor = np.maximum(floor, np.partition(best, len(starts) - k, 1)[:, len(starts) - k])
        row, col = np.nonzero((rough >= (floor - slack)[:, None]) & np.isfinite(rough))
        exact = np.zeros(len(row))
        for d in range(q.shape[1]):
            exact += x[col, d] * q[row, d]
        return rows[row], ids[col], exact

    def _keep(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        order = np.lexsort((-score, ids, row))
        row, ids, score = row[order], ids[order], score[order]
        one = np.r_[True, (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])][: len(row)]
        row, ids, score = row[one], ids[one], score[one]
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        self.floor[row[rank == self.k - 1]] = score[rank == self.k - 1]
        self.row, self.id, self.score = row[rank < self.k], ids[rank < self.k], score[rank < self.k]

    def found(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.own[self.row]), pa.array(self.id), pa.array(self.score)], ["query_id", "vec_id", "score"])
