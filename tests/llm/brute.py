"""The contracts of the registered queries, one document after the other."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SECRETS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def lower(text):
    return (text or "").encode().lower().decode()


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def decontamination(docs, items, window=10):
    places = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall(lower(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            places[tuple(words[i : i + n])].add(item)
    lengths = {len(w) for w in places}
    out = []
    for doc_id, text in docs:
        words = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                got = places.get(tuple(words[i : i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in got if x is not None}
        out.append((doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def jaccard(docs, n=5):
    sets = []
    for _, text in docs:
        words = WORD.findall(lower(text))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set())
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in by[x] if j < i).items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def repeats(docs, size=200):
    texts = [(text or "").encode() for _, text in docs]
    count = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for (doc_id, _), t in zip(docs, texts):
        gone, until, spans = bytearray(len(t)), 0, 0
        for i in range(len(t) - size + 1):
            if count[t[i : i + size]] > 1:
                spans += i > until or not until
                start = max(i, until)
                gone[start : i + size] = b"\1" * (i + size - start)
                until = i + size
        out.append((doc_id, len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone) if not g))))
    return out


def substrings(docs, size=50):
    first = {}
    words = [WORD.findall(text or "") for _, text in docs]
    ids = [math.inf if d is None else d for d, _ in docs]
    for d, w in zip(ids, words):
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            first[k] = min(first.get(k, d), d)
    out = []
    for (doc_id, _), d, w in zip(docs, ids, words):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone[i : i + size] = True
        out.append((doc_id, len(w), int(gone.sum()), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def secrets(docs):
    out = []
    for doc_id, text in docs:
        found = []
        for k, (pattern, group, least) in enumerate(SECRETS.values()):
            found += [(m.start(), k, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
        kinds = list(SECRETS)
        count = Counter(k for _, k, _ in found)
        out.append((doc_id, count[0], count[1], count[2], sha(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found)))))
    return out


def nearest(vectors, every=20, k=20):
    rows = {
        i: np.array(v, float) for i, v in vectors
        if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    ids = np.array(sorted(rows))
    matrix = np.stack([rows[i] for i in ids])
    out = {}
    for q in ids[ids % every == 0]:
        s = np.zeros(len(ids))
        for d in range(matrix.shape[1]):
            s += matrix[:, d] * rows[q][d]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def held_out(doc_id, of, rest):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % of == rest


def scores(docs, prior, order):
    tokens = [[0, *WORD.findall(lower(t)), None] for _, t in docs]
    seen, n_texts = Counter(), 0
    for (d, _), ts in zip(docs, tokens):
        if not held_out(d, 7, 2):
            n_texts += 1
            for k in range(1, order + 1):
                seen.update(tuple(ts[i : i + k]) for i in range(k == 1, len(ts) - k + 1))
    one = {gram[0]: n for gram, n in seen.items() if len(gram) == 1}
    total, kinds = sum(one.values()), len(one)
    seen[(0,)] = n_texts

    def chance(gram):
        if len(gram) == 1:
            return (seen[gram] + 1) / (total + kinds + 1)
        return (seen[gram] + prior * chance(gram[1:])) / (seen[gram[:-1]] + prior)

    out = []
    for (d, _), (start, *ts) in zip(docs, tokens):
        base = score = 0.0
        for i, w in enumerate(ts):
            base += math.log10((one.get(w, 0) + 1) / (total + kinds + 1))
            score += math.log10(chance((start, *ts)[max(0, i + 2 - order) : i + 2]))
        out.append((d, held_out(d, 7, 2), len(ts), sum(one.get(w, 0) > 0 for w in ts), total, base, score))
    return out


def token_rows(docs, tokenizer, end=1):
    """(doc_id, start, ids) in ascending order of the ids."""
    start, out = 0, []
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, ids))
        start += len(ids)
    return out


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def licenses(docs, templates, run=3, near=8):
    """``templates``: (label, words, base) each."""
    out = []
    for doc_id, text in docs:
        words = ALNUM.findall(lower(text))
        base, labels, score = [], set(), 0.0
        for label, own, is_base in templates:
            own = own.split()
            if is_base:
                base += [(i, label) for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
            places = defaultdict(list)
            for j in range(len(own) - run + 1):
                places[tuple(own[j : j + run])].append(j)
            votes = {(i - j, j) for i in range(len(words) - run + 1) for j in places.get(tuple(words[i : i + run]), [])}
            for d in {d for d, _ in votes}:
                covered = {j + k for e, j in votes if d <= e <= d + near for k in range(run)}
                score = max(score, len(covered) / len(own))
                if len(covered) / len(own) >= 0.8:
                    labels.add(label)
        starts = [i for i, _ in base]
        listed = ",".join(sorted({x for _, x in base}))
        out.append((doc_id, len(words), len(base), min(starts, default=None), max(starts, default=None), listed, ",".join(sorted(labels)), score))
    return out


def clusters(vectors, k=40, rounds=5, size=64):
    kept = [
        (i, [math.floor(256 * float(x)) for x in v]) for i, v in vectors
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, sha(f"2:{r[0]}"), r[1]))
    centres = [list(q) for _, q in order[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, q in kept:
            groups[nearest(q)[1]].append(q)
        for j, own in groups.items():
            centres[j] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(q)) for i, q in kept]
    inertia = Counter()
    for _, distance, j in found:
        inertia[j] += distance
    return [(i, j, d, inertia[j], sum(inertia.values()), sha(",".join(map(str, centres[j])))) for i, d, j in found]


def resampling(docs, items, grams=(1, 1), buckets=10_000, per_cent=10, least=20):
    def features(text):
        words = ALNUM.findall(lower(text))
        return [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(grams[0], grams[1] + 1) for i in range(len(words) - n + 1)]

    source, target = Counter(x for _, t in docs for x in features(t)), Counter(x for t in items for x in features(t))
    s, t = sum(source.values()), sum(target.values())
    rows = []
    for doc_id, text in docs:
        own = features(text)
        gains = [math.floor(1000 * math.log((target[x] + 1) * (s + buckets) / ((source[x] + 1) * (t + buckets)))) for x in own]
        weight = sum(gains) // len(own) if own else 0
        h = int(sha(f"2024:{'' if doc_id is None else doc_id}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(own), weight, score, len(ALNUM.findall(lower(text))) >= least))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(fit) * per_cent // 100
    return [(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(fit)] + [(*r[:4], None) for r in rows if not r[4]]
