"""Connected components, and near copies grouped by them."""

import os

from entiva.llm import near_dedup
from entiva.llm.components import components
from entiva.session import Workspace


def test_stars_need_no_round(spark):
    workspace = Workspace(spark)
    pairs = [(1, k) for k in range(2, 30)] + [(40, 41)]
    links = spark.createDataFrame(pairs, "a long, b long")
    found = {r.node: r.component for r in components(links, workspace, "stars").collect()}
    assert found == {b: a for a, b in pairs}
    folder = workspace.folder("").removeprefix("file://").rstrip("/")
    assert [n for n in os.listdir(folder) if n.startswith("stars")] == ["stars_round_0"]


def test_tangled_links_become_stars(spark):
    pairs = [(k, k + 1) for k in range(1, 60)] + [(80, 90), (80, 91), (85, 91), (90, 85)]
    links = spark.createDataFrame([*pairs, (None, 3), (7, 7)], "a long, b long")
    found = {r.node: r.component for r in components(links, Workspace(spark), "chain").collect()}
    assert found == {k: 1 for k in range(2, 61)} | {85: 80, 90: 80, 91: 80}


def test_relabelled_groups_reach_their_least_id(spark):
    # a chain of edits: neighbours are alike, its ends are not
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(60):
        words[k] = f"x{k}"
        rows.append((100 - k, " ".join(words)))
    found = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), leaders=1)
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(56)} for i, t in rows}
    parent = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    parent[a] = parent[b] = min(parent[a], parent[b])
    assert {r.doc_id: r.component_id for r in found.collect()} == parent
