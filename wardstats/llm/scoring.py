"""Language-model scores of whole texts by a weighted backoff automaton over word n-grams.

A text is read as a start, its words and one end. Single words are smoothed by
one, and each longer context h towards the context h' without its first word:

    p(w)   = (c(w) + 1) / (N + V + 1)
    p(w|h) = (c(hw) + M p(w|h')) / (c(h) + M)

Every seen n-gram shorter than the order is a state, and so is the root. State h
has an arc of weight log10 p(w|h) for each seen hw, which leads to the longest
state that hw ends in, and a failure arc of weight log10 (M / (c(h) + M)) to h'.
The root has an arc for every word. The probabilities of a state add up to one.
A text's score is the weight of its path: one traversal from left to right
carries the state, takes the word's arc where there is one, and else follows
failure arcs until there is.

The model grows with the corpus, so no task ever holds it whole. Documents are
dealt by hash into chunks of bounded size. A chunk asks for the counts of its
own distinct n-grams; requests are dealt by hash ranges, where counts from all
chunks meet; and each chunk gets its answers, which make the automaton of just
the n-grams that its texts can walk through. An n-gram of three words or more
is asked for only if other chunks have both n-grams in it that are one word
shorter; else no other chunk can have it, and the chunk knows all occurrences.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, stored
from .words import U64, Words, mix

CHUNK_BYTES = 10_000_000
ORDER = 3
PRIOR = 20.0  # M: how many occurrences the estimate from the shorter context is worth
SEGMENT = 512  # words that one lane of the traversal reads of a text

_END, _START, _STEP = U64(0x1D2A6F37C5B1E943), U64(0x7C3E9A5512B4D06F), U64(0x9E3779B97F4A7C15)


class Chunk:
    """The distinct n-grams of a chunk's texts, by order.

    ``keys[k]`` are the sorted hashes of those of order k, ``at[k]`` the number
    of the one that ends at each place, ``context[k]`` and ``suffix[k]`` the
    numbers of the ones a word shorter that lack its last and its first word.
    The start stands at the beginning of each text and is the last number of
    order 1; it has no key. A null text has the end alone.
    """

    def __init__(self, texts: pa.Array, learn: np.ndarray, order: int):
        words = Words(texts, lower=True)
        counts = words.counts()
        self.first = np.concatenate(([0], np.cumsum(counts + 2)))
        size = self.first[-1]
        token = np.full(size, _START, U64)
        token[self.first[1:] - 1] = _END
        inside = np.ones(size, bool)
        inside[self.first[:-1]] = inside[self.first[1:] - 1] = False
        token[inside] = words.hashes
        place = np.arange(size) - np.repeat(self.first[:-1], counts + 2)
        weight = np.repeat(learn, counts + 2)
        self.keys, self.at, self.context, self.suffix, self.local = {}, {}, {}, {}, {}
        grams = token
        for k in range(1, order + 1):
            if k > 1:
                grams = mix(np.concatenate(([U64(0)], grams[:-1])) * _STEP + token)
            ends = np.flatnonzero(place >= max(1, k - 1))
            self.keys[k], number = np.unique(grams[ends], return_inverse=True)
            self.at[k] = np.full(size, len(self.keys[k]), np.int32)
            self.at[k][ends] = number
            self.local[k] = np.bincount(number, weights=weight[ends], minlength=len(self.keys[k])).astype(np.int64)
            if k > 1:
                self.context[k], self.suffix[k] = (np.empty(len(self.keys[k]), np.int32) for _ in range(2))
                self.context[k][number] = self.at[k - 1][ends - 1]
                self.suffix[k][number] = self.at[k - 1][ends]

    def asked(self, k: int) -> np.ndarray:
        """Which n-grams of order k other chunks may have: those whose shorter ones they have."""
        if k < 3:
            return np.ones(len(self.keys[k]), bool)
        return self.elsewhere[k - 1][self.context[k]] & self.elsewhere[k - 1][self.suffix[k]]

    def totals(self, replies: pa.Table, orders: Iterable[int]) -> dict[int, np.ndarray]:
        """Occurrences in the whole corpus of each n-gram of these orders, from the answers for this chunk.

        Sets ``elsewhere[k]``: which of them other chunks have, in texts to learn from or others.
        """
        out, self.elsewhere = {}, {}
        of, part = (replies.column(c).to_numpy() for c in ("gram_order", "part"))
        for k in orders:
            rows = np.flatnonzero(of == k)
            rows = rows[np.argsort(part[rows])]
            found = _unpacked(replies.column("counts").take(pa.array(rows)).to_pylist(), "<i8")
            asked = self.asked(k)
            out[k], self.elsewhere[k] = self.local[k].copy(), np.zeros(len(self.keys[k]), bool)
            out[k][asked], self.elsewhere[k][asked] = found >> 1, found & 1
        return out


def _packed(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, so that the high bytes' zeros lie together and compress."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpacked(planes: list[bytes], kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(width, -1).T).view(kind).ravel() for p in planes]
    return np.concatenate([np.zeros(0, kind), *parts])


class Automaton:
    """States, arcs and failure arcs of the n-grams of one chunk, from their counts.

    State 0 is the root; those of the n-grams of order k follow from ``base[k]``.
    """

    def __init__(self, chunk: Chunk, counts: dict[int, np.ndarray], total: int, kinds: int, texts: int, prior: float = PRIOR):
        self.chunk, self.order = chunk, len(counts)
        self.root = (counts[1] + 1.0) / (total + kinds + 1.0)
        self.seen = {k: n > 0 for k, n in counts.items()}
        self.base, p = {1: 1}, {1: self.root}
        failure, backoff, depth = [[0]], [[0.0]], [[0]]
        for k in range(1, self.order):
            n = np.append(counts[1], texts) if k == 1 else counts[k]
            self.base[k + 1] = self.base[k] + len(n)
            failure.append(np.zeros(len(n), np.int64) if k == 1 else self.base[k - 1] + chunk.suffix[k])
            backoff.append(np.log10(prior / (n + prior)))
            depth.append(np.full(len(n), k))
            p[k + 1] = (counts[k + 1] + prior * p[k][chunk.suffix[k + 1]]) / (n[chunk.context[k + 1]] + prior)
        self.failure, self.backoff, self.depth = (np.concatenate(x) for x in (failure, backoff, depth))
        self.weight = {k: np.log10(x) for k, x in p.items()}
        self.to = {k: self.base[k] + np.arange(len(p[k])) for k in range(1, self.order)}
        longest = chunk.suffix[self.order] if self.order > 1 else np.zeros(len(p[1]), np.int64)
        self.to[self.order] = self.base[self.order - 1] + longest if self.order > 1 else longest
        self.to[1] = np.where(self.seen[1], self.to[1], 0)
        self.start = self.base[1] + len(counts[1]) if self.order > 1 else 0

    def step(self, state: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state after the token at each place, and the weight of the arcs to it."""
        state, weight = state.copy(), np.zeros(len(state))
        reached = np.zeros(len(state), np.int64)
        for k in range(self.order, 0, -1):
            here = np.flatnonzero(self.depth[state] == k - 1)
            arc = self.chunk.at[k][places[here]]
            if k > 1:
                there = self.seen[k][arc]
                fail, here, arc = here[~there], here[there], arc[there]
                weight[fail] += self.backoff[state[fail]]
                state[fail] = self.failure[state[fail]]
            weight[here] += self.weight[k][arc]
            reached[here] = self.to[k][arc]
            state[here] = -1  # depth of the last state, the longest: not met again on the way down
        return reached, weight

    def walk(self) -> np.ndarray:
        """log10 probability of each token at its place (0 at the starts), by one traversal of every text.

        Lanes of ``SEGMENT`` tokens advance together. One that begins inside a
        text first reads, from the root, the tokens that a state can hold.
        """
        first = self.chunk.first
        tokens = np.diff(first) - 1
        lanes = -(-tokens // SEGMENT)
        text = np.repeat(np.arange(len(tokens)), lanes)
        number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin = first[text] + 1 + number * SEGMENT
        end = np.minimum(begin + SEGMENT, first[text + 1])
        warm = np.where(number > 0, self.order - 1, 0)
        state = np.where(number > 0, 0, self.start)
        by_length = np.argsort(begin - warm - end, kind="stable")
        begin, end, warm, state = (x[by_length] for x in (begin, end, warm, state))
        length = end - begin + warm
        out = np.zeros(first[-1])
        for t in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -t, "left"))
            places = begin[:live] - warm[:live] + t
            state, weight = self.step(state[:live], places)
            own = warm[:live] <= t
            out[places[own]] = weight[own]
        return out


def score_documents(docs: DataFrame, learn: Column, text: str = "text", order: int = ORDER) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score of each whole text.

    ``learn`` says which rows to learn from (null: not). A null or empty text is
    its end token. Repeated rows are counted and scored each. Nothing to learn
    from: every count is 0. A text of any length is read whole, within one task.
    Columns may have any name; those with the new names are replaced.
    """
    new = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept = [c for c in docs.columns if c.lower() not in new]
    names = [f"c{i}" for i in range(len(kept))]
    own = names[[c.lower() for c in kept].index(text.lower())]
    size = docs.agg(F.sum(F.octet_length(column(text)))).collect()[0][0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    rows = docs.select(
        F.struct(*[column(c).alias(n) for c, n in zip(kept, names)]).alias("row"), F.coalesce(learn, F.lit(False)).alias("learn")
    ).withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int"))
    texts = rows.select("chunk", F.col("row")[own].alias("text"), "learn")

    def read(table: pa.Table, texts: pa.Array, order: int) -> Chunk:
        return Chunk(texts, np.array(table.column("learn").to_pylist(), bool), order)

    def messages(number: int, chunk: Chunk, orders: list[int]) -> pa.Table:
        """The n-grams that a chunk asks for: a row for each range that holds any."""
        out = []
        for k in orders:
            wanted = chunk.asked(k)
            keys, n = chunk.keys[k][wanted], chunk.local[k][wanted]
            part = ((keys >> U64(32)) * U64(chunks) >> U64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=chunks))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                gaps = np.diff(keys[a:b], prepend=U64(0)).astype("<u8")
                out.append((int(part[a]), number, k, _packed(gaps), _packed(n[a:b].astype("<u4"))))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["part", "chunk", "gram_order", "grams", "counts"])

    def first_ask(key: tuple, table: pa.Table) -> pa.Table:
        orders = list(range(1, min(order, 2) + 1))
        return messages(key[0].as_py(), read(table, table.column("text").combine_chunks(), max(orders)), orders)

    def ask(k: int):
        def run(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
            chunk = read(table, table.column("text").combine_chunks(), k)
            chunk.totals(replies, range(1, k))
            return messages(key[0].as_py(), chunk, [k])

        return run

    def answer(table: pa.Table) -> pa.Table:
        """For each chunk, in the order it asked in, twice the sum over all chunks, plus one if several asked.

        Each range adds its totals.
        """
        of = table.column("gram_order").to_numpy()
        sent = [None] * len(table)
        totals = [0, 0]
        for k in np.unique(of).tolist():
            rows = np.flatnonzero(of == k)
            take = pa.array(rows)
            asked = [np.cumsum(_unpacked([g], "<u8"), dtype=U64) for g in table.column("grams").take(take).to_pylist()]
            n = _unpacked(table.column("counts").take(take).to_pylist(), "<u4")
            found, back = np.unique(np.concatenate(asked), return_inverse=True)
            sums = np.bincount(back, weights=n, minlength=len(found)).astype("<i8")
            if k == 1:
                totals = [int(sums.sum()), int((sums > 0).sum())]
            told = 2 * sums + (np.bincount(back, minlength=len(found)) > 1)
            ends = np.cumsum([len(a) for a in asked])
            for row, a, e in zip(rows.tolist(), asked, ends.tolist()):
                sent[row] = _packed(told[back[e - len(a) : e]].astype("<i8"))
        first = [1] + [0] * (len(table) - 1)
        return pa.table(
            [table.column("chunk"), table.column("part"), table.column("gram_order"), pa.array(sent, pa.binary()), *(pa.array([t * f for f in first], pa.int64()) for t in totals)],
            ["chunk", "part", "gram_order", "counts", "tokens", "kinds"],
        )

    request = "part int, chunk int, gram_order int, grams binary, counts binary"
    reply = "chunk int, part int, gram_order int, counts binary, tokens long, kinds long"
    asked = texts.groupBy("chunk").applyInArrow(first_ask, request)
    rounds = [stored(asked.groupBy("part").applyInArrow(answer, reply), "answers")]
    answers = rounds[0]
    total, kinds = answers.agg(F.sum("tokens"), F.sum("kinds")).collect()[0]
    total, kinds = total or 0, kinds or 0
    for k in range(3, order + 1):
        asked = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(ask(k), request)
        rounds.append(stored(asked.groupBy("part").applyInArrow(answer, reply), "answers"))
        answers = answers.unionByName(rounds[-1])
    learned = rows.where("learn").count()

    def score(table: pa.Table, replies: pa.Table) -> pa.Table:
        columns = table.column("row").combine_chunks()
        chunk = read(table, columns.field(own), order)
        counts = chunk.totals(replies, range(1, order + 1))
        model = Automaton(chunk, counts, total, kinds, learned)
        at, first = chunk.at[1], chunk.first[:-1]
        known = np.append(counts[1] > 0, False)[at].astype(np.int64)
        base = np.append(np.log10(model.root), 0.0)[at]
        values = [np.diff(chunk.first) - 1, np.add.reduceat(known, first), np.full(len(first), total), np.add.reduceat(base, first), np.add.reduceat(model.walk(), first)]
        return pa.table([columns, *(pa.array(v) for v in values)], ["row", *new])

    shape = T.StructType([rows.schema["row"]])
    for name in new:
        shape.add(name, T.DoubleType() if name.endswith("score") else T.LongType())
    dealt = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, shape)
    return dealt.select(*[F.col("row")[n].alias(n) for n in names], *new).toDF(*kept, *new)
