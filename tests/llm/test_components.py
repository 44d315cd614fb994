"""Components of links, against plain search, in one task and over many."""

from __future__ import annotations

import random

import numpy as np
import pytest

from wardstats.llm import common, jaccard
from wardstats.llm.components import components, forest


def plain(links):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            node = todo.pop()
            if node not in out:
                out[node] = start
                todo += near[node]
    return out


def chain(n, seed):
    order = list(range(n))
    random.Random(seed).shuffle(order)
    return list(zip(order, order[1:]))


GRAPHS = {
    "none": [],
    "itself": [(4, 4), (4, 4)],
    "chain": chain(300, 1),
    "hub": [(i, 500) for i in range(300)] + [(900, 901)],
    "random": [(random.Random(i).randrange(400), random.Random(-i).randrange(400)) for i in range(1, 250)] * 2,
}


@pytest.mark.parametrize("name", GRAPHS)
def test_forest(name):
    links = np.array(GRAPHS[name], np.int64).reshape(-1, 2)
    nodes, roots = forest(links[:, 0], links[:, 1])
    assert dict(zip(nodes.tolist(), roots.tolist())) == plain(GRAPHS[name])


@pytest.mark.parametrize("task_links", [1_000_000, 20])
@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name, task_links):
    links = spark.createDataFrame(GRAPHS[name], "a long, b long").repartition(3)
    rows = components(links, task_links).collect()
    assert {r["node"]: r["label"] for r in rows} == plain(GRAPHS[name]) and len(rows) == len({r["node"] for r in rows})


def test_intermediate_tables_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda spark: str(tmp_path))
    left = lambda: sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    with common.intermediate() as outer:
        with common.intermediate() as keep:
            first = common.stored(spark.range(3), "first")
            second = keep(first, "second")
        assert left() == ["second"] and second.count() == 3
        with pytest.raises(ZeroDivisionError), common.intermediate():
            common.stored(second, "third")
            raise ZeroDivisionError
        assert left() == ["second"]
        last = outer(second, "last")
    assert left() == ["last"] and last.count() == 3


def test_near_duplicates_leave_one_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda spark: str(tmp_path))
    docs = spark.createDataFrame([(i, " ".join(map(str, range(i % 4, 40)))) for i in range(9)], "doc_id long, text string")
    assert jaccard.near_duplicate_components(docs).count() == 9
    assert [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["classes"]


def test_a_cluster_needs_a_shared_folder():
    class Session:
        conf = {}
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(ValueError):
        common.shared_folder(Session)


def test_the_pipeline_leaves_its_last_table(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(common, "shared_folder", lambda spark: str(tmp_path))
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() and [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["packing"]
