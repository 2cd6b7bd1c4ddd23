"""Components of links between near copies: known after one pass, whatever their length, and in groups of any size."""

from __future__ import annotations

import numpy as np
import pytest

from kinolytics.llm import near_text


@pytest.mark.parametrize("links_of_a_group", [1 << 18, 7])
def test_heads_of_chains_take_no_rounds(spark, monkeypatch, links_of_a_group):
    monkeypatch.setattr(near_text, "LINKS", links_of_a_group)
    rounds = []
    whole = near_text.connected_components
    monkeypatch.setattr(near_text, "connected_components", lambda *a: rounds.append(1) or whole(*a))
    order = np.random.default_rng(3).permutation(60).tolist()
    links = [(order[k], order[k + 1]) for k in range(59) if k % 20 != 19] + [(1000, 1000 + k) for k in range(1, 5)]
    found = {r["component"]: r["head"] for r in near_text.heads_of(spark.createDataFrame(links, "src long, dst long")).collect()}
    want = {x: min(order[k - k % 20 : k - k % 20 + 20]) for k, x in enumerate(order)} | {1000 + k: 1000 for k in range(5)}
    assert found == want
    assert bool(rounds) == (links_of_a_group == 7)


def test_merged_labels_of_no_and_some_edges(spark):
    label = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 4), (-5, -5)], "digest long, component long")
    got = lambda edges: sorted(tuple(r) for r in near_text.merged(label, spark.createDataFrame(edges, "src long, dst long")).collect())
    assert got([]) == [(-5, -5), (1, 1), (2, 1), (3, 3), (4, 4)]
    assert got([(2, 3), (4, -5)]) == [(-5, -5), (1, 1), (2, 1), (3, 1), (4, -5)]
