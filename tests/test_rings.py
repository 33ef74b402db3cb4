"""Many rings at once against one by one, and links that are joined where they lie."""

import random

import pyarrow as pa

from tessera.functions import polygons
from tessera.operators import graph

RINGS = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))


def test_areas_of_many_rings_are_those_of_one_pair():
    rng = random.Random(1)

    def ring():
        at = (lambda: float(rng.randrange(6))) if rng.random() < 0.5 else lambda: rng.uniform(0, 6)
        own = [(at(), at()) for _ in range(rng.randrange(8))]
        return own + own[: rng.randrange(2)] if rng.random() < 0.8 else own[:1] + own

    left, right = ([ring() for _ in range(1000)] for _ in range(2))
    left[5] = right[9] = None
    arrow = lambda rings: pa.array([None if r is None else [{"x": x, "y": y} for x, y in r] for r in rings], RINGS)
    got = polygons.all_boolean_areas(arrow(left), arrow(right))
    want = [(None,) * 3 if a is None or b is None else polygons.boolean_areas(a, b) for a, b in zip(left, right)]
    assert [tuple(x.values()) for x in got.to_pylist()] == want
    assert [tuple(x.values()) for x in polygons.all_boolean_areas(arrow(left)[300:400], arrow(right)[300:400]).to_pylist()] == want[300:400]


def test_links_of_a_task_are_joined_at_once(spark, monkeypatch):
    """A long chain in one partition needs no rounds; dealt at random it gives the same components."""
    rounds, settle = [], graph.settle
    monkeypatch.setattr(graph, "settle", lambda df, name: rounds.append(name) or settle(df, name))
    chain = spark.createDataFrame([(i, i + 1) for i in range(3000) if i % 1000 != 999], "a long, b long")
    want = [(i, i // 1000 * 1000) for i in range(3000)]
    found = lambda edges: sorted(map(tuple, graph.connected_components(edges, small=0).select("node", "component").collect()))
    assert found(chain.repartition(1)) == want
    assert len(rounds) <= 3
    assert found(chain.repartition(7)) == want
