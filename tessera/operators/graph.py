"""Order-dependent and transitive operators as fixpoints over edges.

Each round is a plan of joins and windows; its result is written to the shared
folder, so plans don't grow with the rounds and a lost executor costs one round.
Rounds follow the longest chain of decisions, and the last of them are over a
handful of edges. Once no more than ``small`` are left, which is counted, one task
works off this end of a chain in order; the result is the same, and with 0 there are
rounds to the last.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..plans.storage import settle

#: Edges that are left to one task at the end, at most: less than a megabyte.
SMALL = 1000
#: Links that a task joins at once: some tens of megabytes.
FOREST = 1 << 20


def _whole(df: DataFrame, work, schema) -> DataFrame:
    """``work`` over all rows, which are known to be few, in the order that they have in their only partition."""

    def run(batches):
        held = list(batches)
        if held:
            yield work(pd.concat(held, ignore_index=True))

    return df.mapInPandas(run, schema)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", small: int = SMALL) -> DataFrame:
    """node, component of every node with an edge; a component's name is its smallest node.

    Large-star and small-star contractions: rounds grow with the logarithm of a
    chain's length, and a hub is reduced before it is shuffled.
    """
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b")
    if links.schema["a"].dataType == links.schema["b"].dataType == LongType():
        links = links.mapInArrow(_forests, links.schema)
    links = settle(links.distinct(), "edges")
    before = None
    while True:
        if links.count() <= small:
            kind = links.schema["a"].dataType.simpleString()
            return _whole(links.repartition(1), _components, f"node {kind}, component {kind}")
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pair = F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        links = settle(large.join(least, "a").select(F.explode(pair).alias("e")).select("e.a", "e.b").where("a <> b").distinct(), "edges")
        state = tuple(links.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())
        if state == before:
            break
        before = state
    roots = links.groupBy("a").agg(F.min("b").alias("component"))
    return roots.select(F.col("a").alias("node"), "component").union(roots.select(F.col("component").alias("node"), "component").distinct())


def _forests(batches) -> Iterator[pa.RecordBatch]:
    """Links that join the same nodes as the partition's own, each from a node to the smallest that its stretch of links reaches.

    Whatever the partitions hold is right; where they hold neighbours, few rounds are left.
    """
    held: list[pa.RecordBatch] = []

    def stars():
        nodes, ends = np.unique(np.concatenate([np.asarray(x.column(c)) for c in (0, 1) for x in held]), return_inverse=True)
        first, second = np.split(ends, 2)
        root = np.arange(len(nodes))
        while len(first):
            x, y = root[first], root[second]
            apart = x != y
            first, second, x, y = first[apart], second[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(root, hop := root[root]):
                root = hop
        own = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], names=held[0].schema.names)

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= FOREST:
            yield stars()
            held.clear()
    if held:
        yield stars()


def _components(edges: pd.DataFrame) -> pd.DataFrame:
    parent: dict = {}

    def find(n):
        while parent.setdefault(n, n) != n:
            parent[n] = n = parent[parent[n]]
        return n

    for x, y in zip(edges.a, edges.b, strict=True):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)
    return pd.DataFrame({"node": list(parent), "component": [find(n) for n in parent]})


def greedy_match(edges: DataFrame, order: Sequence, by: Sequence[str] = (), a: str = "a", b: str = "b", small: int = SMALL) -> DataFrame:
    """The edges that a sequential greedy 1:1 assignment picks, within each group ``by``.

    order: columns that make a strict total order. An edge that comes first at both
    its ends is picked by the sequential rule whatever the others do; picking all
    such edges at once, until none is left, gives its result.
    """
    left, picked, done = settle(edges, "candidates"), [], False
    at_a = Window.partitionBy(*by, a).orderBy(*order)
    at_b = Window.partitionBy(*by, b).orderBy(*order)

    def in_order(rows: pd.DataFrame) -> pd.DataFrame:
        used_a, used_b, kept = set(), set(), []
        keys = list(zip(*(rows[c] for c in by), strict=True)) if by else [()] * len(rows)
        for i, (k, x, y) in enumerate(zip(keys, rows[a], rows[b], strict=True)):
            if (k, x) not in used_a and (k, y) not in used_b:
                used_a.add((k, x))
                used_b.add((k, y))
                kept.append(i)
        return rows.iloc[kept]

    while not done:
        if left.count() <= small:
            picked.append(_whole(left.repartition(1).sortWithinPartitions(*order), in_order, left.schema))
            break
        first = left.withColumn("_a", F.row_number().over(at_a)).withColumn("_b", F.row_number().over(at_b)).where("_a = 1 and _b = 1").drop("_a", "_b")
        taken = settle(first, "picked")
        picked.append(taken)
        rest = left.join(taken.select(*by, a), [*by, a], "left_anti").join(taken.select(*by, b), [*by, b], "left_anti")
        left = settle(rest.select(*edges.columns), "candidates")
        done = left.isEmpty()
    out = picked[0]
    for more in picked[1:]:
        out = out.union(more)
    return out


def greedy_suppress(edges: DataFrame, by: Sequence[str] = (), small: int = SMALL) -> DataFrame:
    """The nodes that greedy suppression drops: ``by`` and lo. Edges lead from the better node hi to the worse one lo.

    A node that no live better neighbour can drop is kept, and drops its worse
    neighbours; edges of dropped nodes die. All others wait for the next round.
    """
    left, dropped = settle(edges.select(*by, "hi", "lo"), "conflicts"), []

    def in_rounds(rows: pd.DataFrame) -> pd.DataFrame:
        names, lost = [*by, "lo"], []
        rows = rows.assign(_hi=list(zip(*(rows[c] for c in (*by, "hi")), strict=True)), _lo=list(zip(*(rows[c] for c in names), strict=True)))
        while len(rows):
            falls = rows[~rows._hi.isin(set(rows._lo))].drop_duplicates("_lo")
            lost.append(falls[names])
            gone = set(falls._lo)
            rows = rows[~rows._lo.isin(gone) & ~rows._hi.isin(gone)]
        return pd.concat(lost, ignore_index=True) if lost else rows[names]

    while n := left.count():
        if n <= small:
            dropped.append(_whole(left.repartition(1), in_rounds, left.select(*by, "lo").schema))
            left = left.limit(0)
            break
        tops = left.select(*by, F.col("hi").alias("node")).distinct().join(left.select(*by, F.col("lo").alias("node")), [*by, "node"], "left_anti")
        lost = settle(left.join(tops.withColumnRenamed("node", "hi"), [*by, "hi"]).select(*by, "lo").distinct(), "dropped")
        dropped.append(lost)
        rest = left.join(lost, [*by, "lo"], "left_anti").join(lost.withColumnRenamed("lo", "hi"), [*by, "hi"], "left_anti")
        left = settle(rest.select(*by, "hi", "lo"), "conflicts")
    out = left.select(*by, "lo")
    for more in dropped:
        out = out.union(more)
    return out
