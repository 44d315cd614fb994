"""Secret scans with a trigram inverted index, in DataFrame functions only.

Each rule's regular expression gives a Boolean query of trigrams that any match
must contain. Postings of those trigrams are intersected per document, and only
documents that satisfy a rule's query run its expression. A rule without
mandatory trigrams scans every document.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, unused

MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the group that must be ``least`` characters long."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three base kinds, then well-known public key formats.
# Runs of a least length stand for "match, then drop short ones": both give the same spans,
# as a run that is too short holds no longer one.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
]
MORE = [
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
RULES = BASE + MORE

# A query: sets of trigrams, of which one must be wholly present; None asks for nothing.
Query = frozenset[frozenset[str]] | None


def _either(queries: list[Query]) -> Query:
    if any(q is None for q in queries):
        return None
    sets = {s for q in queries for s in q}
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    sets = {s | t for s in a for t in b}
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _of_strings(strings: set[str]) -> Query:
    sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
    return _either([frozenset([s]) if s else None for s in sets])


def _class(items) -> set[str] | None:
    """The characters of a class, if they are few."""
    out = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            out.add(chr(value).lower())
        elif kind is sre.RANGE and value[1] - value[0] < 8:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _walk(items) -> tuple[set[str] | None, Query]:
    """All strings that the items match, if few and known; and the query of what they must contain."""
    now, known, query = {""}, True, None

    def broken(more: Query) -> None:
        nonlocal now, known, query
        query = _both(_both(query, _of_strings(now)), more)
        now, known = {""}, False

    for kind, value in items:
        strings, inner = None, None
        if kind is sre.LITERAL:
            strings = {chr(value).lower()}
        elif kind is sre.IN:
            strings = _class(value)
        elif kind is sre.SUBPATTERN:
            strings, inner = _walk(value[3])
        elif kind is sre.BRANCH:
            parts = [_walk(x) for x in value[1]]
            if all(p[0] is not None for p in parts):
                strings = set().union(*(p[0] for p in parts))
            else:
                inner = _either([q if s is None else _of_strings(s) for s, q in parts])
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, sub = value
            some, inner = _walk(sub)
            if some is not None and (low, high) == (0, 1):
                strings, inner = some | {""}, None
            elif some is not None and low == high and len(some) ** low <= MOST_STRINGS:
                strings = {""}
                for _ in range(low):
                    strings = {a + b for a in strings for b in some}
            elif low == 0:
                inner = None
            elif some is not None:
                inner = _of_strings(some)
        if strings is not None and len(now) * len(strings) <= MOST_STRINGS:
            now = {a + b for a in now for b in strings}
        else:
            broken(inner if strings is None else _of_strings(strings))
    if known:
        return now, _of_strings(now)
    return None, _both(query, _of_strings(now))


def trigram_query(pattern: str) -> Query:
    """Sets of lower-case trigrams: a text that matches holds all of at least one set; None: any text may match.

    A string of fewer than three characters asks for nothing.
    """
    return _walk(_parser.parse(pattern))[1]


def trigram_postings(docs: DataFrame, key: str, text: str, trigrams: list[str]) -> DataFrame:
    """Inverted index of the given trigrams: a row (trigram, key) for each document that contains it, in either case."""
    rows = docs.select(F.col(key).alias("key"), F.lower(text).alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return rows.select("key", F.explode(found).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(key, kinds): the rules whose query the postings of a document satisfy."""
    grams = postings.groupBy("key").agg(F.collect_set("trigram").alias("grams"))

    def holds(query: Query) -> Column:
        out = F.lit(False)
        for s in sorted(map(sorted, query)):
            out = out | (F.size(F.array_except(F.array(*map(F.lit, s)), "grams")) == 0)
        return out

    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]))
    return grams.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0)


SPAN = "struct<start:int,order:int,end:int>"
STEPS = 256  # matches whose places are added up together


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Leftmost non-overlapping matches as structs (start, order, end), in code points, end exclusive.

    The text between the matches gives their places: the parts of ``split`` and
    the matches take turns. Places are sums of lengths, taken in blocks of
    ``STEPS`` matches, so the work grows with the matches.
    """
    none = F.array().cast(f"array<{SPAN}>")

    def sized(hits: Column) -> Column:
        kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
        parts = F.slice(F.split(text, rule.pattern, -1), 1, F.size(hits))
        zipped = F.zip_with(parts, hits, lambda p, h: F.struct(F.length(p).alias("part"), F.length(h).alias("size")))
        return F.zip_with(zipped, kept, lambda z, k: F.struct(z["part"].alias("part"), z["size"].alias("size"), F.length(k).alias("kept")))

    def added(start: Column, block: Column) -> Column:
        begun = F.struct(start.alias("at"), none.alias("out"))

        def step(acc: Column, x: Column) -> Column:
            first = acc["at"] + x["part"]
            end = first + x["size"]
            found = F.struct(first.alias("start"), F.lit(order).alias("order"), end.alias("end"))
            out = F.when(x["kept"] >= rule.least, F.concat(acc["out"], F.array(found))).otherwise(acc["out"])
            return F.struct(end.alias("at"), out.alias("out"))

        return F.aggregate(block, begun, step)["out"]

    def placed(matches: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(matches), F.lit(STEPS)), lambda i: F.slice(matches, i, STEPS))

        def summed(blocks: Column) -> Column:
            sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x["part"] + x["size"]))
            starts = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
            return _with(starts, lambda at: F.flatten(F.transform(blocks, lambda b, i: added(F.get(at, i), b))))

        return _with(blocks, summed)

    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    return _with(hits, lambda hits: F.when(F.size(hits) > 0, _with(sized(hits), placed)).otherwise(none))


def find_secrets(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES, spans: str = "secret_spans") -> DataFrame:
    """``docs`` with an array of (start, order, end) for every rule's matches, by start, then the rule's order.

    The documents meet the candidates of the index by a hash of their whole
    row; a collision only makes a document run an expression in vain. A null or
    empty text has no span; repeated rows have the same spans each; the work
    grows with a text's length and matches, however many. A column of
    ``docs`` named ``spans`` is replaced.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not None}
    kept = [c for c in docs.columns if c.lower() != spans.lower()]
    keyed = docs.select(F.struct(*map(column, kept)).alias("row"), F.xxhash64(*map(column, kept)).alias("key"))
    if indexed:
        words = sorted({t for q in indexed.values() for s in q for t in s})
        postings = trigram_postings(keyed.select("key", F.col("row").getField(text).alias("text")), "key", "text", words)
        found = candidates(postings, indexed)
        keyed = keyed.join(found, "key", "left")
    else:
        keyed = keyed.withColumn("kinds", F.lit(None).cast("array<string>"))
    value = F.coalesce(F.col("row").getField(text), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    each = []
    for i, rule in enumerate(rules):
        own = rule_spans(value, rule, i)
        each.append(F.when(F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)), own).otherwise(none) if rule.kind in indexed else own)
    return keyed.select(F.col("row"), F.array_sort(F.concat(*each)).alias("spans")).select(
        *[F.col("row").getField(c).alias(c) for c in kept], F.col("spans").alias(spans)
    )


def span_text(spans: Column, rules: list[Rule] = RULES) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span's text replaced by ``mark`` (overlapping spans by one); the columns stay."""
    own = unused(docs.columns, "secret_spans")
    found = find_secrets(docs, text, rules, own)
    value = column(text)

    def cut(part: Column, first: Column, spans: Column) -> Column:
        """The text from place ``first`` on, without the spans that start there or later."""
        begun = F.struct(first.alias("at"), F.lit("").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            new = s["start"] >= acc["at"]
            more = F.concat(acc["out"], F.substring(part, acc["at"] - first + 1, s["start"] - acc["at"]), F.lit(mark))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(new, more).otherwise(acc["out"]).alias("out"))

        return F.aggregate(spans, begun, step, lambda acc: F.concat(acc["out"], F.substring(part, acc["at"] - first + 1, F.length(part))))

    clean = F.when(F.size(column(own)) > 0, cut(value, F.lit(0), column(own))).otherwise(value)
    return found.select(*[clean.alias(c) if c == text else column(c) for c in docs.columns])


def secret_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: spans by base kind, a digest of the base spans, and all spans."""
    found = find_secrets(docs.select(column(key).alias("doc_id"), column(text).alias("text")))
    base = F.filter("secret_spans", lambda s: s["order"] < len(BASE))

    def of(order: int) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["order"] == order)).cast("long")

    counts = [of(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secret_spans")).alias("spans"))
