"""Rings that need more than expressions: repair, simplification, buffering, boolean areas, tracing. NumPy only, used in batches."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

Ring = list[tuple[float, float]]
#: Crossings that are worked out at once, about.
AT_ONCE = 1 << 20


def signed_area(ring: Ring) -> float:
    return sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1])) / 2


def _cross(a, b, c, d):
    """Where the segments a-b and c-d cross inside both, or none."""
    rx, ry, sx, sy = b[0] - a[0], b[1] - a[1], d[0] - c[0], d[1] - c[1]
    det = rx * sy - ry * sx
    if det == 0:
        return None
    t = ((c[0] - a[0]) * sy - (c[1] - a[1]) * sx) / det
    u = ((c[0] - a[0]) * ry - (c[1] - a[1]) * rx) / det
    return (t, u, (a[0] + t * rx, a[1] + t * ry)) if 0 < t < 1 and 0 < u < 1 else None


def opened(ring: Ring) -> Ring:
    """Without a closing or a repeated point."""
    out = [p for p, q in zip(ring, [None, *ring]) if p != q]
    return out[:-1] if len(out) > 1 and out[0] == out[-1] else out


def simple(ring: Ring) -> bool:
    ring = opened(ring)
    n = len(ring)
    if n < 3 or not signed_area(ring):
        return False
    edges = list(zip(ring, ring[1:] + ring[:1]))
    return not any(_cross(*edges[i], *edges[j]) for i in range(n) for j in range(i + 2, n) if (j + 1) % n != i)


def repaired(ring: Ring) -> Ring | None:
    """The largest of the simple rings that a ring falls into at its crossings; none if nothing with an area is left."""
    todo, best = [opened(ring)], None
    while todo:
        own = todo.pop()
        n = len(own)
        if n < 3:
            continue
        edges = list(zip(own, own[1:] + own[:1]))
        cut = next(((i, j, c[2]) for i in range(n) for j in range(i + 2, n) if (j + 1) % n != i and (c := _cross(*edges[i], *edges[j]))), None)
        if cut:
            i, j, p = cut
            todo += [[p, *own[i + 1 : j + 1]], [p, *own[j + 1 :], *own[: i + 1]]]
        elif abs(signed_area(own)) > 0 and (best is None or abs(signed_area(own)) > abs(signed_area(best))):
            best = own
    return [*best, best[0]] if best else None


def simplified(ring: Ring, tolerance: float) -> Ring:
    """Points further than the tolerance from the chord of their stretch, and the ends of it."""
    own = opened(ring)
    if len(own) < 4:
        return [*own, *own[:1]]
    far = max(range(len(own)), key=lambda i: (own[i][0] - own[0][0]) ** 2 + (own[i][1] - own[0][1]) ** 2)

    def keep(points: Ring) -> Ring:
        (x0, y0), (x1, y1) = points[0], points[-1]
        length = math.hypot(x1 - x0, y1 - y0) or 1.0
        gaps = [abs((x1 - x0) * (y0 - y) - (x0 - x) * (y1 - y0)) / length for x, y in points[1:-1]]
        if not gaps or max(gaps) <= tolerance:
            return [points[0], points[-1]]
        at = gaps.index(max(gaps)) + 1
        return keep(points[: at + 1])[:-1] + keep(points[at:])

    out = keep(own[: far + 1])[:-1] + keep([*own[far:], own[0]])
    return out


def buffered(ring: Ring, by: float, steps: int = 16) -> Ring:
    """The convex hull of discs around the points: the exact buffer, but for the arcs' steps, of a convex ring."""
    points = sorted({(x + by * math.cos(2 * math.pi * k / steps), y + by * math.sin(2 * math.pi * k / steps)) for x, y in opened(ring) for k in range(steps)})

    def half(own):
        out: Ring = []
        for p in own:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    hull = half(points) + half(points[::-1])
    return [*hull, hull[0]]


def boolean_areas(a: Ring, b: Ring) -> tuple[float, float, float]:
    """Areas of a without b, b without a, and both: strips between all corners and crossings, in which edges don't cross."""
    rings = [opened(a), opened(b)]
    edges = [(p, q, k) for k, r in enumerate(rings) for p, q in zip(r, r[1:] + r[:1])]
    xs = {p[0] for r in rings for p in r}
    xs |= {c[2][0] for i, (p, q, _) in enumerate(edges) for u, v, _ in edges[i + 1 :] if (c := _cross(p, q, u, v))}
    out = [0.0, 0.0, 0.0]
    marks = sorted(xs)
    for x0, x1 in zip(marks, marks[1:]):
        middle = (x0 + x1) / 2
        rows = sorted((p[1] + (q[1] - p[1]) * (middle - p[0]) / (q[0] - p[0]), k) for p, q, k in edges if min(p[0], q[0]) < middle < max(p[0], q[0]))
        inside = [False, False]
        for (y, k), following in zip(rows, rows[1:]):
            inside[k] = not inside[k]
            which = 2 if all(inside) else 0 if inside[0] else 1 if inside[1] else None
            if which is not None:
                out[which] += (following[0] - y) * (x1 - x0)  # the mean height of a trapezoid is its height in the middle
    return out[0], out[1], out[2]


def traced(mask: np.ndarray) -> Ring:
    """The outer boundary of the first region of a mask, along pixel sides, as a closed ring of col, row."""
    rows, cols = np.nonzero(mask)
    if not len(rows):
        return []
    set_at = lambda r, c: 0 <= r < mask.shape[0] and 0 <= c < mask.shape[1] and bool(mask[r, c])
    r, c = int(rows[0]), int(cols[0])
    start, at, step, out = (c, r), (c, r), (1, 0), []
    while True:
        out.append(at)
        x, y = at = (at[0] + step[0], at[1] + step[1])
        ahead_left = {(1, 0): (y - 1, x), (0, 1): (y, x), (-1, 0): (y, x - 1), (0, -1): (y - 1, x - 1)}[step]
        ahead_right = {(1, 0): (y, x), (0, 1): (y, x - 1), (-1, 0): (y - 1, x - 1), (0, -1): (y - 1, x)}[step]
        if set_at(*ahead_left):
            step = (step[1], -step[0])
        elif not set_at(*ahead_right):
            step = (-step[1], step[0])
        if at == start:
            break
    turns = [p for p, q, n in zip(out, out[-1:] + out[:-1], out[1:] + out[:1]) if (p[0] - q[0]) * (n[1] - p[1]) != (p[1] - q[1]) * (n[0] - p[0])]
    return [*turns, turns[0]]


RING = "array<struct<x:double,y:double>>"


def _plain(ring) -> Ring:
    return [(p["x"], p["y"]) for p in ring]


def ring_function(work: Callable[[Ring], Ring | None]) -> Callable[[Column], Column]:
    """A function of rings as a batched column function; null for null."""

    def batch(column: pd.Series) -> pd.Series:
        made = (None if r is None else work(_plain(r)) for r in column)
        return pd.Series([None if r is None else [{"x": float(x), "y": float(y)} for x, y in r] for r in made])

    return F.pandas_udf(batch, RING)


def repair(ring: Column) -> Column:
    return ring_function(repaired)(ring)


def simplify(ring: Column, tolerance: float) -> Column:
    return ring_function(lambda r: simplified(r, tolerance))(ring)


def buffer(ring: Column, by: float) -> Column:
    return ring_function(lambda r: buffered(r, by))(ring)


def _all_opened(rings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x and y of the points of all rings without closing or repeated points, and the rings' ends."""
    points = rings.flatten()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(rings), 0), np.int64)
    x, y = (np.asarray(points.field(i)).astype(float) for i in (0, 1))
    ring, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
    first = np.zeros(len(x), bool)
    first[(ends - sizes)[sizes > 0]] = True
    kept = first | (x != np.roll(x, 1)) | (y != np.roll(y, 1))
    x, y, ring = x[kept], y[kept], ring[kept]
    sizes = np.bincount(ring, minlength=len(sizes))
    begin, last = (np.cumsum(sizes) - sizes)[sizes > 1], np.cumsum(sizes)[sizes > 1] - 1
    closing = last[(x[begin] == x[last]) & (y[begin] == y[last])]
    x, y, ring = (np.delete(v, closing) for v in (x, y, ring))
    return x, y, np.cumsum(np.bincount(ring, minlength=len(sizes)))


def _same_sizes(ax, ay, bx, by) -> np.ndarray:
    """boolean_areas of many pairs at once, a row of points for each ring: the same steps in the same order."""
    x0, y0 = np.hstack([ax, bx]), np.hstack([ay, by])
    x1, y1 = (np.hstack([np.roll(u, -1, 1), np.roll(v, -1, 1)]) for u, v in ((ax, bx), (ay, by)))
    of_b = np.repeat([False, True], [ax.shape[1], bx.shape[1]])
    marks = [x0]
    with np.errstate(divide="ignore", invalid="ignore"):
        for i in range(x0.shape[1] - 1):
            own, rest = slice(i, i + 1), slice(i + 1, None)
            rx, ry, sx, sy = x1[:, own] - x0[:, own], y1[:, own] - y0[:, own], x1[:, rest] - x0[:, rest], y1[:, rest] - y0[:, rest]
            det = rx * sy - ry * sx
            t = ((x0[:, rest] - x0[:, own]) * sy - (y0[:, rest] - y0[:, own]) * sx) / det
            u = ((x0[:, rest] - x0[:, own]) * ry - (y0[:, rest] - y0[:, own]) * rx) / det
            # where edges don't cross, a corner is named again: its strip is empty
            marks.append(np.where((det != 0) & (0 < t) & (t < 1) & (0 < u) & (u < 1), x0[:, own] + t * rx, x0[:, own]))
        marks = np.sort(np.hstack(marks), axis=1)
        low, high, out = np.minimum(x0, x1), np.maximum(x0, x1), np.zeros((3, len(x0)))
        for m in range(marks.shape[1] - 1):
            some = np.flatnonzero(marks[:, m] < marks[:, m + 1])
            if not len(some):
                continue
            left, right = marks[some, m], marks[some, m + 1]
            middle = ((left + right) / 2)[:, None]
            across = (low[some] < middle) & (middle < high[some])
            y = np.where(across, y0[some] + (y1[some] - y0[some]) * (middle - x0[some]) / (x1[some] - x0[some]), np.inf)
            order = np.argsort(y, axis=1, kind="stable")
            y, across, b = np.take_along_axis(y, order, 1), np.take_along_axis(across, order, 1), of_b[order]
            in_a, in_b = (np.cumsum(across & k, axis=1) % 2 == 1 for k in (~b, b))
            for i in range(y.shape[1] - 1):
                area = np.where(across[:, i + 1], (y[:, i + 1] - y[:, i]) * (right - left), 0.0)
                for k, inside in enumerate((in_a[:, i] & ~in_b[:, i], in_b[:, i] & ~in_a[:, i], in_a[:, i] & in_b[:, i])):
                    out[k, some] += np.where(inside, area, 0.0)
    return out


def all_boolean_areas(left: pa.Array, right: pa.Array) -> pa.Array:
    """boolean_areas of each pair of two arrays of rings, null where one is; pairs of rings of equal sizes go together."""
    none = np.asarray(pc.or_(pc.is_null(left), pc.is_null(right)))
    (ax, ay, a_ends), (bx, by, b_ends) = _all_opened(left), _all_opened(right)
    a_sizes, b_sizes = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    out = np.zeros((3, len(none)))
    kinds = np.stack([a_sizes, b_sizes], 1)
    for n, m in np.unique(kinds[~none], axis=0).tolist():
        if not n + m:
            continue
        rows = np.flatnonzero((a_sizes == n) & (b_sizes == m) & ~none)
        step = max(1, AT_ONCE // (n + m) ** 2)
        for s in range(0, len(rows), step):
            own = rows[s : s + step]
            at, to = (a_ends[own] - n)[:, None] + np.arange(n), (b_ends[own] - m)[:, None] + np.arange(m)
            out[:, own] = _same_sizes(ax[at], ay[at], bx[to], by[to])
    return pa.StructArray.from_arrays([pa.array(v, mask=none) for v in out], names=["only_a", "only_b", "both"])


def boolean_area(a: Column, b: Column) -> Column:
    """struct only_a, only_b, both of two rings."""

    def batch(left: pa.Array, right: pa.Array) -> pa.Array:
        return all_boolean_areas(left, right)

    return F.arrow_udf(batch, "only_a double, only_b double, both double")(a, b)
