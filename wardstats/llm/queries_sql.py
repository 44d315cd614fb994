"""The corpus queries that SQL can express, over whole tables, for DuckDB.

They count and compare plainly, without the operators' methods: every window,
shingle or byte string is spelt out. Packing, language, scores, token files and
the vector index need a tokenizer, a learned model or an approximate search.
"""

from __future__ import annotations

from .licenses import MORE
from .secrets import BASE, RULES

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ITEM_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
WORD = r"'[^\x20\x09-\x0D]+'"

DECONTAMINATION = f"""
WITH item AS (SELECT item_id, regexp_extract_all({LOWER}, {ITEM_WORD}) AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, regexp_extract_all({LOWER}, {ITEM_WORD}) AS w FROM documents),
sized AS (SELECT doc_id, w, size FROM doc JOIN (SELECT DISTINCT size FROM item_window) s ON len(w) >= size),
doc_window AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
hit AS (SELECT doc_id, item_id, i, size FROM doc_window JOIN item_window USING (size, win)),
place AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(place.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(place.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN place USING (doc_id) LEFT JOIN named USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({LOWER}, {WORD}) AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT doc.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, min(reach.b) AS component_id
FROM doc JOIN reach ON reach.a = doc.doc_id LEFT JOIN size ON size.doc_id = doc.doc_id GROUP BY doc.doc_id
"""

# A byte is two hex digits; texts are cut in blocks of 1000 starts, so that finding a string is cheap.
SUFFIX_REPEATS = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, length(h) // 2 AS n FROM doc),
block AS (
  SELECT doc_id, n, pos, substr(h, 2 * pos + 1, 2400) AS part
  FROM (SELECT doc_id, h, n, unnest(range(0, n - 199, 1000)) AS pos FROM sized WHERE n >= 200)),
string AS (
  SELECT doc_id, pos + i AS i, md5(substr(part, 2 * i + 1, 400)) AS s
  FROM (SELECT doc_id, pos, part, unnest(range(0, least(1000, n - 199 - pos))) AS i FROM block)),
again AS (SELECT s FROM string GROUP BY s HAVING count(*) > 1),
start AS (SELECT doc_id, i, i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 200 AS fresh FROM string SEMI JOIN again USING (s)),
run AS (SELECT doc_id, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM start),
span AS (SELECT doc_id, r, min(i) AS a, max(i) + 200 AS b FROM run GROUP BY doc_id, r),
total AS (SELECT doc_id, count(*) AS n, sum(b - a) AS gone FROM span GROUP BY doc_id),
edge AS (
  SELECT doc_id, b AS a, lead(a, 1, NULL) OVER w AS b FROM span WINDOW w AS (PARTITION BY doc_id ORDER BY r)
  UNION ALL SELECT doc_id, 0, min(a) FROM span GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS k
  FROM edge JOIN sized USING (doc_id) GROUP BY doc_id)
SELECT doc_id, sized.n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(total.n, 0) AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM sized LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

SUBSTRING_DEDUP = f"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)),
first AS (SELECT s, min(doc_id) AS first_id FROM win GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM win JOIN first USING (s) WHERE first_id < doc_id),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS k FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""


def _secrets() -> str:
    """Matches and the texts between them take turns, so running lengths give the places."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    found = " UNION ALL ".join(
        f"SELECT doc_id, {quoted(r.kind)} AS kind, {i} AS rank, {r.least} AS least, string_split_regex(t, {p}) AS parts, "
        f"regexp_extract_all(t, {p}) AS hits, regexp_extract_all(t, {p}, {r.group}) AS kept FROM doc"
        for i, r in enumerate(RULES)
        for p in [quoted(r.pattern)]
    )
    base = f"rank < {len(BASE)}"
    counts = ", ".join(f"count(*) FILTER (kind = {quoted(r.kind)}) AS n_{r.kind}" for r in BASE)
    listed = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank)"
    return f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
hit AS (
  SELECT doc_id, kind, rank, least, unnest(parts[:len(hits)]) AS part, unnest(hits) AS hit, unnest(kept) AS kept,
    unnest(range(1, len(hits) + 1)) AS k
  FROM found WHERE len(hits) > 0),
placed AS (
  SELECT doc_id, kind, rank, least, kept, length(hit) AS n,
    sum(length(part) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY k) AS b FROM hit),
span AS (SELECT doc_id, kind, rank, CAST(b - n AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM placed WHERE length(kept) >= least),
summed AS (SELECT doc_id, {counts}, {listed} FILTER ({base}) AS base, {listed} AS spans FROM span GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN summed USING (doc_id)
"""


def _licenses() -> str:
    """Base phrases by comparing slices of the words; other templates by runs of three words, nine diagonals together."""
    base = "('mit', ['under', 'the', 'mit', 'license']), ('apache-2', ['apache', 'license', 'version', '2']), ('cc-by-nc', ['cc', 'by', 'nc'])"
    more = ", ".join(f"('{t.label}', string_split('{t.text}', ' '))" for t in MORE)
    return f"""
WITH doc AS (SELECT doc_id, regexp_extract_all({LOWER}, {ITEM_WORD}) AS w FROM documents),
base AS (SELECT * FROM (VALUES {base}) t(label, p)),
template AS (SELECT *, row_number() OVER (ORDER BY label, p) AS t FROM (SELECT * FROM base UNION ALL SELECT * FROM (VALUES {more}) t(label, p))),
spot AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc WHERE len(w) > 2),
phrase AS (SELECT doc_id, label, i - 1 AS i FROM spot, base WHERE w[i] = p[1] AND w[i:i + len(p) - 1] = p),
based AS (
  SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM phrase GROUP BY doc_id),
run AS (SELECT doc_id, i - 1 AS i, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM spot),
place AS (
  SELECT t, label, len(p) AS size, j - 1 AS j, p[j] AS x, p[j + 1] AS y, p[j + 2] AS z
  FROM (SELECT t, label, p, unnest(range(1, len(p) - 1)) AS j FROM template)),
vote AS (SELECT DISTINCT doc_id, t, label, size, i - j AS d, j FROM run JOIN place USING (x, y, z)),
cover AS (
  SELECT doc_id, t, label, CAST(count(DISTINCT b.j + o) AS DOUBLE) / size AS share
  FROM (SELECT DISTINCT doc_id, t, label, size, d FROM vote) a JOIN (SELECT doc_id, t, d, j FROM vote) b USING (doc_id, t),
    (SELECT unnest([0, 1, 2]) AS o) WHERE b.d BETWEEN a.d AND a.d + 8 GROUP BY doc_id, t, label, size, a.d),
noted AS (
  SELECT doc_id, max(share) AS score, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (share >= 0.8) AS l FROM cover GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word,
  coalesce(based.l, '') AS base_labels, coalesce(noted.l, '') AS labels, coalesce(score, 0.0) AS score
FROM doc LEFT JOIN based USING (doc_id) LEFT JOIN noted USING (doc_id)
"""


def _clusters(k: int = 40, rounds: int = 5) -> str:
    """All distances anew in every round, a component a row."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
far{n} AS MATERIALIZED (SELECT r, j, sum((q - c) * (q - c)) AS distance FROM part JOIN centre{n} USING (d) GROUP BY r, j),
near{n} AS MATERIALIZED (SELECT r, arg_min(j, (distance, j)) AS j, min(distance) AS distance FROM far{n} GROUP BY r)""")
        if n < rounds:
            steps.append(f"""
mean{n} AS (SELECT j, d, CAST(floor(sum(q)::DOUBLE / count(*)) AS BIGINT) AS c FROM near{n} JOIN part USING (r) GROUP BY j, d),
centre{n + 1} AS MATERIALIZED (SELECT j, d, coalesce(mean{n}.c, centre{n}.c) AS c FROM centre{n} LEFT JOIN mean{n} USING (j, d))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(x, lambda y: CAST(floor(256 * y) AS BIGINT)) AS v
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
  WHERE len(x) = 64 AND len(list_filter(x, lambda y: y IS NOT NULL AND isfinite(y))) = 64),
part AS MATERIALIZED (SELECT r, unnest(v) AS q, unnest(range(64)) AS d FROM kept),
seed AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v, r) - 1 AS j FROM kept QUALIFY j < {k}),
centre0 AS MATERIALIZED (SELECT j, d, q AS c FROM seed JOIN part USING (r)),{",".join(steps)},
digest AS (SELECT j, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM centre{rounds} GROUP BY j)
SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{rounds} JOIN kept USING (r) JOIN digest USING (j)
"""


def _resampling() -> str:
    """CRC-32 of every distinct word, byte by byte, with the table that its polynomial gives."""
    table = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    byte = "(instr('0123456789ABCDEF', h[2 * i - 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i]) - 1"
    step = f"lambda c, b: xor(c >> 8, list_extract({table}, xor(c & 255, b) + 1))"
    return f"""
WITH doc AS (SELECT doc_id, regexp_extract_all({LOWER}, {ITEM_WORD}) AS w FROM documents),
item AS (SELECT regexp_extract_all({LOWER}, {ITEM_WORD}) AS w FROM benchmark),
known AS (SELECT word, hex(encode(word)) AS h FROM (SELECT unnest(w) AS word FROM doc UNION SELECT unnest(w) FROM item)),
crc AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h) // 2 + 1), lambda i: CAST({byte} AS BIGINT))), {step}),
    4294967295) % 10000 AS bucket FROM known),
feature AS (SELECT doc_id, bucket FROM (SELECT doc_id, unnest(w) AS word FROM doc) JOIN crc USING (word)),
source AS (SELECT bucket, count(*) AS s FROM feature GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(w) AS word FROM item) JOIN crc USING (word) GROUP BY bucket),
total AS (SELECT (SELECT coalesce(sum(s), 0) FROM source)::DOUBLE AS ss, (SELECT coalesce(sum(t), 0) FROM target)::DOUBLE AS tt),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000) / ((s + 1)::DOUBLE * (tt + 10000)))) AS BIGINT) AS g
  FROM source LEFT JOIN target USING (bucket), total),
summed AS (SELECT doc_id, count(*) AS n, CAST(sum(g) AS BIGINT) AS g FROM feature JOIN gain USING (bucket) GROUP BY doc_id),
drawn AS (
  SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features,
    coalesce((g - ((g % n) + n) % n) // n, 0) AS weight, ('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT AS h
  FROM doc LEFT JOIN summed USING (doc_id)),
scored AS (
  SELECT doc_id, words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM drawn),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place,
    10 * (count(*) FILTER (words >= 20) OVER ()) // 100 AS many FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= many THEN place END AS rank FROM placed
"""


ORACLE = {
    "op1_decontamination": DECONTAMINATION,
    "op3_jaccard_join": JACCARD,
    "op4_suffix_repeats": SUFFIX_REPEATS,
    "op8_secrets": _secrets(),
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op11_license_scan": _licenses(),
    "op12_centroid_clusters": _clusters(),
    "op13_importance_resampling": _resampling(),
}
