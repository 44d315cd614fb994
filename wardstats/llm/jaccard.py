"""N-gram Jaccard join with parity sketches.

Each text's shingles are dealt by hash into the parts of a sketch, whose number
depends on the size band. A part holds the parity of each of 2^32 places, as
the XOR of a random word for every shingle, so it keeps its value unless a
shingle of that part comes or goes. Two sets of sizes a and b with similarity
J >= 0.8 differ in at most d = (a + b) / 9 shingles, so in at most d parts.

By the pigeonhole principle two such texts agree in at least t + 1 of their
first d + t + 1 parts that are not empty. Texts with fewer parts in common with
any other are done. The others drop their t most frequent parts, as one of the
rest must still agree, and meet in those. A second sketch of fixed size holds
the parity of the shingles that fall on each of its bits; its Hamming distance
is at most d too, so texts further apart are no candidates, though they share a
part. Candidates are verified on the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, discard, intermediate, slices, stored, text_key
from .components import components
from .windows import Ranges, distinct_texts, per_document
from .words import U64, Words, mix, runs

SHINGLE = 5
SIMILAR = 80  # per cent
BITS = 1024  # of the sketch that candidates are compared by
MEETINGS = 2  # rounds in which each component tries one pair before all that are left are tried
BEFORE = 12  # of a text's keys, just smaller than one, that go with it into the join


def shingle_sets(column: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, by text and hash, and each text's bounds in them.

    A text of fewer than ``n`` words has one shingle, all its words; without words none.
    """
    words = Words(column, lower=True)
    at, hashes = runs(words.hashes, words.first, n)
    owner = np.searchsorted(words.first, at, "right") - 1
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        places = np.searchsorted(owner, short)
        hashes = np.insert(hashes, places, Ranges(words.hashes)(words.first[short], counts[short]))
        owner = np.insert(owner, places, short)
    bounds = np.searchsorted(owner, np.arange(len(column) + 1)).tolist()
    for a, b in zip(bounds[:-1], bounds[1:]):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (np.diff(owner) != 0) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(column) + 1))


def sketch_keys(shingles: np.ndarray, size: int, band: int, similar: int = SIMILAR) -> tuple[np.ndarray, int]:
    """Keys of the first parts of one sorted set's sketch in a band, and t.

    Band j is for sizes from 4^j. A part's key is its number and its parities.
    The longer t, the longer a passage that many texts share may be without
    making them candidates; small sets, of which it is a larger part, have more.
    There are so many parts that few shingles share one. A set with fewer parts
    than wanted drops fewer: at least parts - d of them agree, one has to stay.
    """
    low = 4**band
    spare = (low - 1) // 2 if low <= 64 else low // 8
    differ = int((size + size * 100 // similar) * (100 - similar) // (100 + similar))
    parts = max(16 * low, 4096)
    part = ((shingles >> U64(32)) * U64(parts)) >> U64(32)  # in order, as the shingles are
    firsts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    wanted = differ + spare + 1
    if len(firsts) > wanted:
        shingles, firsts = shingles[: firsts[wanted]], firsts[:wanted]
    spare = min(spare, max(0, len(firsts) - differ - 1))
    parity = np.bitwise_xor.reduceat(mix((shingles & U64(0xFFFFFFFF)) + U64(1)), firsts)
    return mix(parity ^ mix(part[firsts] + (U64(band + 1) << U64(56)))), spare


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """Parities of the shingles on each of ``BITS`` bits, as 64-bit words."""
    odd = np.bincount((shingles & U64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(texts: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """(uid, n_shingles, bits, band, spare, keys) of every text, in its own size band and, if a partner may be in the next, there too.

    In the second of these rows ``bits`` is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingles, at = shingle_sets(batch.column("text"))
            rows: list[tuple] = []
            for uid, a, b in zip(batch.column("uid").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                n = b - a
                band = (n.bit_length() - 1) // 2 if n else 0
                bands = [band, band + 1] if n * 100 // similar >= 4 ** (band + 1) else [band]
                for j in bands:
                    keys, spare = sketch_keys(shingles[a:b], n, j, similar) if n else (np.zeros(0, U64), 0)
                    bits = parity_bits(shingles[a:b]) if j == band else None
                    rows.append((uid, n, bits, j, spare, keys.view(np.int64)))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            names = ["uid", "n_shingles", "bits", "band", "spare", "keys"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    shape = "uid long, n_shingles long, bits array<long>, band int, spare int, keys array<long>"
    return stored(texts.select("uid", "text").mapInArrow(run, shape), "sketches")


def _words(bits: str) -> list[Column]:
    return [F.col(bits)[i] for i in range(BITS // 64)]


def within_reach(n: str, bits: list[Column], other_n: str, other_bits: list[Column], similar: int = SIMILAR) -> Column:
    """Whether two texts' sizes, and the Hamming distance of their bits, leave room for that similarity."""
    apart = [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(bits, other_bits)]
    sizes = F.least(n, other_n) * 100 >= F.greatest(n, other_n) * similar
    return sizes & (sum(apart) * (100 + similar) <= (F.col(n) + F.col(other_n)) * (100 - similar))


def reachable(pairs: DataFrame, sizes: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """Those of the pairs (a, b) that sizes and sketches leave room for."""
    for side in ("a", "b"):
        own = sizes.select(F.col("uid").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
        pairs = pairs.join(own, side)
    return pairs.where(within_reach("n_a", _words("bits_a"), "n_b", _words("bits_b"), similar)).select("a", "b")


def candidate_groups(sketched: DataFrame) -> DataFrame:
    """(key, uid): the rarer parts of the texts that have enough parts in common with others; similar texts share a key."""
    parts = sketched.select("uid", "band", "spare", F.explode("keys").alias("key"))
    # Counts are written first: a join of two plain shuffles can split a hot key.
    common = stored(parts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "common")
    # A hash table of the counts, one row a key, saves sorting the keys of all texts.
    shared = parts.join(common.hint("shuffle_hash"), "key").groupBy("uid", "band", "spare").agg(F.collect_list(F.struct("n", "key")).alias("keys"))
    rare = F.slice(F.array_sort("keys"), F.lit(1), F.size("keys") - F.col("spare"))
    groups = shared.where(F.size("keys") > F.col("spare")).select("uid", F.explode(rare).alias("k"))
    groups = groups.select(F.col("k.key").alias("key"), "uid")
    groups = stored(groups, "rare")
    again = stored(groups.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "again")
    found = stored(groups.join(again, "key"), "candidates")
    for table in (common, groups, again):
        discard(table)
    return found


def verified(pairs: DataFrame, texts: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in slices(batches, "right", 1_000_000):
            a, b, texts = batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("left")
            shingles, at = shingle_sets(batch.column("right"))
            good = []
            for i in range(len(a)):
                if a[i] != last:
                    last, left = a[i], shingle_sets(texts.slice(i, 1))[0]
                right = shingles[at[i] : at[i + 1]]
                both = len(np.intersect1d(left, right, assume_unique=True))
                if both and 100 * both >= similar * (len(left) + len(right) - both):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(good, pa.int64())) for c in ("a", "b")], ["a", "b"])

    rows = pairs.join(texts.select(F.col("uid").alias("b"), F.col("text").alias("right")), "b")
    rows = rows.join(texts.select(F.col("uid").alias("a"), F.col("text").alias("left")), "a")
    return stored(rows.select("a", "left", "b", "right").mapInArrow(run, "a long, b long"), "verified")


def similar_components(texts: DataFrame, sketched: DataFrame, sizes: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """(node, label): texts that are linked, over other texts too, to a smaller one, or are that one.

    Texts first meet the smallest of one group, then of all their groups, and
    last every text of their groups that is not in their component yet. So a
    group of copies costs a link each, and no pair that could join two
    components is left out. Texts whose sketches are too far apart don't meet.
    The keys are deleted once they have been met.
    """
    groups = candidate_groups(sketched)
    discard(sketched)
    alive = stored(texts.select("uid", "text").join(groups.select("uid").distinct(), "uid"), "alive")
    leaders = stored(groups.groupBy("key").agg(F.min("uid").alias("a")), "leaders")
    star = groups.join(leaders, "key").where("a < uid").select("a", F.col("uid").alias("b")).distinct()
    star = stored(reachable(star, sizes, similar), "star")
    tried = stored(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
    labels = components(verified(tried, alive, similar))

    def labelled(rows: DataFrame, node: str, name: str) -> DataFrame:
        own = labels.select(F.col("node").alias(node), F.col("label").alias("_label"))
        return rows.join(own, node, "left").withColumn(name, F.coalesce("_label", node)).drop("_label")

    def apart(pairs: DataFrame) -> DataFrame:
        return labelled(labelled(pairs, "a", "la"), "b", "lb").where("la <> lb")

    def tie(links: DataFrame) -> None:
        """Components of the components that the links join: a pair of them counts once."""
        nonlocal labels
        joined = apart(links).select(F.col("la").alias("a"), F.col("lb").alias("b"))
        joined = components(joined)
        whole = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("_label")), "label", "left")
        whole = whole.select("node", F.coalesce("_label", "label").alias("label"))
        # Nodes that stood alone so far have no row yet; those with one are their component's label, or tied above.
        new = joined.join(labels, "node", "left_anti").select("node", "label")
        old, labels = labels, stored(whole.unionByName(new), "labels")
        for table in (old, joined):
            discard(table)

    more = stored(apart(star.join(tried, ["a", "b"], "left_anti")).select("a", "b"), "pairs")
    tie(verified(more, alive, similar))
    tried = tried.unionByName(more)

    # What is left are pairs of texts in different components. A pair comes out
    # at a key unless a common one stands among the few just smaller than it on
    # both sides; the smallest common key has none, so no pair is lost, and
    # texts with most keys in common come out once.
    own = stored(labelled(groups, "uid", "l"), "labelled")
    open_keys = own.groupBy("key").agg(F.min("l").alias("first"), F.max("l").alias("last")).where("first < last").select("key")
    opened = own.join(stored(open_keys, "open-keys"), "key").groupBy("uid").agg(F.min("l").alias("l"), F.array_sort(F.collect_list("key")).alias("keys"))
    smaller = F.transform("keys", lambda k, i: F.struct(
        k.alias("key"), F.when(i > 0, F.get("keys", i - 1)).alias("last"),
        F.slice("keys", F.greatest(i - BEFORE, F.lit(0)) + 1, F.least(i, F.lit(BEFORE))).alias("before"),
    ))
    # A column a word of the bits: this join reads them for every pair under a key.
    sketch = [f"bits{i}" for i in range(BITS // 64)]
    left = opened.join(sizes, "uid").select("uid", "l", "n_shingles", *[x.alias(c) for x, c in zip(_words("bits"), sketch)], F.inline(smaller))
    left = stored(left, "open")
    discard(own)
    right = left.select("key", *[F.col(c).alias(f"{c}_b") for c in ("uid", "l", "n_shingles", *sketch, "last", "before")])
    # The cheapest first: near copies mostly agree in the key before as well.
    near = F.expr("uid < uid_b and l <> l_b and coalesce(last <> last_b, true)")
    near = near & within_reach("n_shingles", [F.col(c) for c in sketch], "n_shingles_b", [F.col(f"{c}_b") for c in sketch], similar)
    near = near & ~F.arrays_overlap("before", "before_b")
    cross = left.join(right, "key").where(near).select(*[F.col(c).alias(n) for c, n in (("uid", "a"), ("uid_b", "b"), ("l", "la"), ("l_b", "lb"))])
    # Written first: else Spark may look for the pairs already tried before it folds equal ones.
    cross = stored(cross.distinct(), "cross")
    discard(left)
    rest = stored(cross.join(tried, ["a", "b"], "left_anti"), "pairs")
    # First one pair for each component: where it holds, the others between the two need no look.
    # Pairs keep their components' labels until a tie changes them.
    for _ in range(MEETINGS):
        larger = F.greatest("la", "lb").alias("l")
        first = stored(rest.groupBy(larger).agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b"), "pairs")
        tie(verified(first, alive, similar))
        # Written between: else Spark looks for the pairs just verified before it drops those of one component.
        rest = stored(apart(rest.select("a", "b")), "pairs")
        rest = stored(rest.join(first, ["a", "b"], "left_anti"), "pairs")
    tie(verified(rest, alive, similar))
    discard(alive)
    return labels


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: int = SIMILAR) -> DataFrame:
    """(hash, n_shingles, label, component) of every distinct text; ``component`` is its component's smallest id."""
    with intermediate() as keep:
        texts = distinct_texts(docs, key, text)
        sketched = sketches(texts, similar)
        sizes = stored(sketched.where("bits is not null").select("uid", "n_shingles", "bits"), "sizes")
        labels = similar_components(texts, sketched, sizes, similar)
        ids = texts.select("uid", "hash", "first_id").join(sizes.drop("bits"), "uid").join(labels.withColumnRenamed("node", "uid"), "uid", "left")
        ids = keep(ids.select("hash", "first_id", "n_shingles", F.coalesce("label", "uid").alias("label")), "classes")
    least = ids.groupBy("label").agg(F.min("first_id").alias("component"))
    return ids.join(least, "label").select("hash", "n_shingles", "label", "component")


def near_duplicate_components(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Copies meet by a hash of the text, other texts by the join. A null or empty
    text, or one of blanks, has no shingle, is linked with nothing and is its
    own component. A component without any id has a null one. Repeated rows
    come out as often as they are in ``docs``.
    """
    rows = per_document(docs, classes(docs, key, text, similar), key, text)
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id").cast("long"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"))


def first_of_components(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: int = SIMILAR) -> DataFrame:
    """``docs`` with one row of each component, one of its smallest id; rows without shingles all stay.

    Null ids come last. Of several rows with that id in the component any one stays.
    """
    found = classes(docs, key, text, similar)
    own = F.col(key).cast("long")
    # A null id is told apart by a flag, so that the join's keys also group the rows after it.
    keys = {"id": F.coalesce(own, F.lit(0).cast("long")), "known": own.isNotNull(), "hash": text_key(F.col(text))}
    ids = docs.select(*[c.alias(n) for n, c in keys.items()]).distinct().join(found, "hash")
    first = F.when(F.col("known"), F.col("id")).eqNullSafe(F.col("component"))
    one = ids.where(first & (F.col("n_shingles") > 0)).groupBy("label").agg(F.min(F.struct("id", "known", "hash")).alias("k"))
    one = stored(one.select("k.*"), "firsts")
    rows = docs.select(F.struct(*map(column, docs.columns)).alias("row"), *[c.alias(n) for n, c in keys.items()])
    blank = rows.where(~F.coalesce(F.col("row").getField(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).select("row")
    firsts = rows.join(one, [*keys]).groupBy(*keys).agg(F.first("row").alias("row"))
    both = firsts.select("row").unionByName(blank)
    return both.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
