"""License scans, centroid clusters and importance resampling against brute force, on odd rows."""

import random
import zlib

import pyarrow as pa
import pytest

from tests.llm import brute
from tests.llm.test_operators import corpus, docs, pairs, same  # noqa: F401
from wardstats.llm import clusters, licenses, resampling
from wardstats.llm.common import ship_package

PERMISSION = next(t.text for t in licenses.MORE if t.label == "mit")


@pytest.fixture(scope="module")
def licensed(spark):
    ship_package(spark)
    words = PERMISSION.split()
    changed = words[:6] + ["kindly", "hereby"] + words[6:14] + words[15:]
    broken = words[:12] + ["other"] * 40 + words[12:]
    texts = [
        None, "", "!", "cc", "CC BY", "CC-BY-NC 4.0", "Released under the MIT License.", "under the MIT license " * 3, " ".join(words).title(),
        "so " + " ".join(changed) + " end", " ".join(broken), "Apache License, Version 2.0 (see under the mit\nlicense) cc by nc", "Undér the mİt license",
        "under the KMIT license", "gnu lesser general public license", "x " * 4000 + "under the mit license " + "y " * 4000,
        "the mit license " * 500, " ".join(words * 3), "apache license version", "the mit license under the mit",
    ]
    rows = [(i, t, "n", "l") for i, t in enumerate(texts)]
    rows += [rows[6]] * 3 + [(None, texts[6], "n", "l"), (None, None, None, None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, n_words string, hash string").repartition(3)


def test_licenses(licensed):
    rows, table = licensed
    own = [(t.label, t.text, t.base) for t in licenses.TEMPLATES]
    same(licenses.license_report(table).collect(), brute.licenses(pairs(rows), own))


def test_license_spans(licensed):
    _, table = licensed
    texts = {bytes(r["h"]): r["doc_id"] for r in table.select("doc_id", licenses.text_key(table["text"]).alias("h")).collect() if r["doc_id"] is not None}
    found = {}
    for r in licenses.license_spans(table).collect():
        found.setdefault(texts[bytes(r["hash"])], []).append((r["label"], r["start"], r["end"], round(r["share"], 3)))
    n = len(PERMISSION.split())
    assert found[8] == [("mit", 0, n, 1.0)]
    label, start, end, share = found[9][0]
    assert (label, start, end) == ("mit", 1, n + 2) and 0.8 <= share < 1
    assert [r[:3] for r in sorted(found[7])] == [("mit", 0, 12)]
    assert 10 not in found or all(r[0] != "mit" for r in found[10])


def test_licenses_take_no_python(licensed, capsys):
    licenses.license_report(licensed[1]).explain()
    assert not any(word in capsys.readouterr().out for word in ("Python", "Pandas", "Arrow"))
    with pytest.raises(ValueError):
        licenses.template_places(licensed[1].sparkSession, [licenses.Template("x", "two words")])


@pytest.mark.parametrize("n", [0, 5, 90])
def test_clusters(spark, n):
    ship_package(spark)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(n)]
    odd = [(1000, None), (1001, []), (1002, [0.5] * 63), (1003, [None] * 64), (1004, [float("nan")] + [0.0] * 63), (1005, [float("inf")] * 64)]
    if n > 5:
        rows += [rows[3], (None, rows[4][1]), (95, [0.0] * 64), (96, [-0.001] * 64), *[(97 + i, rows[7][1]) for i in range(20)]]
    table = spark.createDataFrame([(*r, "c", 1) for r in rows + odd], "vec_id long, embedding array<float>, cluster string, d int").repartition(3)
    values = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    same(clusters.cluster_report(*clusters.clusters(table)).collect(), brute.clusters(values))


def test_clusters_refuse_what_a_long_cannot_hold(spark):
    table = spark.createDataFrame([(1, [1e300] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        clusters.clusters(table)


def test_running_crcs():
    texts = ["The quick  brown-fox", "", None, "Été naïve x", "!a", "x" * 70000 + " y z", "a b"]
    crcs = resampling.RunningCrcs(pa.array(texts))
    for n in (1, 2, 3):
        owner, crc = crcs.runs(n)
        want = [
            (i, zlib.crc32(" ".join(w[j : j + n]).encode()))
            for i, w in enumerate(brute.ALNUM.findall(brute.lower(t)) for t in texts) for j in range(len(w) - n + 1)
        ]
        assert list(zip(owner.tolist(), crc.tolist())) == want


@pytest.mark.parametrize("grams", [(1, 1), (1, 3)])
def test_resampling(spark, docs, corpus, grams):  # noqa: F811
    items = [corpus[15][1], None, "", corpus[20][1]]
    target = spark.createDataFrame([(t,) for t in items], "text string")
    scores = resampling.importance_scores(docs, target, grams=grams)
    got = resampling.ranked(scores, per_cent=40).select("doc_id", "n_features", "weight", "score", "rank").collect()
    want = brute.resampling(pairs(corpus), items, grams, per_cent=40)
    same(got, want)
    ids = {r[0] for r in want if r[4]} - {None}
    drawn = resampling.resampled(docs, target)
    assert drawn.columns == docs.columns
    assert {r["doc_id"] for r in resampling.ranked(scores, per_cent=40).where("rank is not null").collect()} - {None} == ids


def test_resampling_ties_of_one_row(spark):
    ship_package(spark)
    rows = [(7, "w " * 30)] * 50 + [(8, "w " * 30)] * 10
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = resampling.ranked(resampling.importance_scores(table, table.limit(0)), per_cent=50).collect()
    same([(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found], brute.resampling(rows, [], per_cent=50))
