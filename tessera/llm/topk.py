"""Exact top-k search by inner product with vector-approximation files.

Vectors are dealt to groups of bounded size, queries to blocks of bounded size.
Each group is written once, as two files: approximations, that is each component's
cell in a byte and what the cells span, and the exact vectors. A task takes a block
and a group: it scans the approximations, whose cells bound every score from above
and below, and then reads exact vectors in the order of their bounds until no unread
one can enter the query's k best. Some of the groups are searched first; the k best
scores that they give let most of the others be passed over without a read.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _shared

#: Vectors of a group, about.
GROUP_ROWS = 8192
#: Queries of a block, about.
BLOCK_ROWS = 2048
#: Vectors whose approximations are scanned at once.
SCAN_ROWS = 2048
#: Cells of a component; a byte holds the number.
CELLS = 64
#: Exact vectors read at once.
READ_ROWS = 32
#: One in so many groups is searched first.
FIRST = 16
#: Tasks of a search, at most.
MOST_TASKS = 1 << 15
_LONG = (1 << 63) - 1
_WHOLE = 2.0**53


def quantised(column: str = "embedding", scale: float = 256.0) -> Column:
    """floor(scale * x) of each component, as double."""
    return F.transform(F.col(column), lambda x: _whole(x, scale))


def _whole(x: Column, scale: float) -> Column:
    y = F.lit(scale) * x.cast("double")
    # floor() gives a long, which large doubles don't fit; they are whole numbers as they are
    return F.when(F.abs(y) < F.lit(_WHOLE), F.floor(y).cast("double")).otherwise(y)


class ApproximationFile:
    """Cells of a group's vectors and what they span: [low, high] of each component's cells."""

    def __init__(self, codes: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.codes, self.low, self.high = codes, low, high

    @classmethod
    def of(cls, vectors: np.ndarray, cells: int = CELLS) -> ApproximationFile:
        n, dims = vectors.shape
        marks = np.sort(vectors, axis=0)[(np.arange(1, cells) * n) // cells] if n else np.zeros((cells - 1, dims))
        codes = np.empty((n, dims), np.uint8)
        low, high = np.zeros((dims, cells)), np.zeros((dims, cells))
        for d in range(dims):
            codes[:, d] = code = np.searchsorted(marks[:, d], vectors[:, d], side="right")
            least, most = np.full(cells, np.inf), np.full(cells, -np.inf)
            np.minimum.at(least, code, vectors[:, d])
            np.maximum.at(most, code, vectors[:, d])
            used = least <= most
            low[d, used], high[d, used] = least[used], most[used]
        return cls(codes, low, high)

    def to_bytes(self, ids: np.ndarray) -> bytes:
        return struct.pack("<3q", *self.codes.shape, self.low.shape[1]) + b"".join(np.ascontiguousarray(x).tobytes() for x in (self.low, self.high, ids.astype(np.int64), self.codes))

    @classmethod
    def over(cls, block) -> tuple[ApproximationFile, np.ndarray]:
        """A file's approximations and ids, in bytes that need not be copied."""
        n, dims, cells = struct.unpack_from("<3q", block)
        table = dims * cells
        low, high = (np.frombuffer(block, np.float64, table, 24 + 8 * table * i).reshape(dims, cells) for i in (0, 1))
        ids = np.frombuffer(block, np.int64, n, 24 + 16 * table)
        return cls(np.frombuffer(block, np.uint8, n * dims, 24 + 16 * table + 8 * n).reshape(n, dims), low, high), ids

    def largest(self) -> np.ndarray:
        """Each component's largest absolute value."""
        return np.maximum(np.abs(self.low), np.abs(self.high)).max(1) if self.low.size else np.zeros(len(self.low))

    def bounds(self, queries: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of each query's score with each vector of the range, from its cells alone."""
        at = np.arange(self.codes.shape[1])
        low, high = self.low[at, self.codes[begin:end]], self.high[at, self.codes[begin:end]]
        with np.errstate(over="ignore", invalid="ignore"):
            middle, spread = queries @ (low / 2 + high / 2).T, np.abs(queries) @ (high / 2 - low / 2).T
            # whole numbers below 2**53 add up exactly; larger sums are off by less than this
            size = np.abs(queries) @ self.largest()
            spread += np.where(size < _WHOLE / 2, 0.0, size * 2.0**-40)[:, None]
            low, high = middle - spread, middle + spread
        low[np.isnan(low)], high[np.isnan(high)] = -np.inf, np.inf
        return low, high


def _exact(vectors: np.ndarray, query: np.ndarray, small: bool) -> list[int]:
    """Whole scores; sums that doubles can't hold are made of whole numbers of any size."""
    if small:
        return (vectors @ query).astype(np.int64).tolist()
    whole = [int(x) for x in query.tolist()]
    return [sum(a * int(b) for a, b in zip(whole, v, strict=True)) for v in vectors.tolist()]


def search_block(queries: np.ndarray, query_ids: np.ndarray, file: ApproximationFile, vectors: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None) -> list[list[tuple[int, int]]]:
    """Each query's k best (score, id) of the file but for its own id; ties go to the smaller id. Scores below floor may be left out."""
    best: list[list[tuple[int, int]]] = [[] for _ in range(len(queries))]
    floor = np.full(len(queries), -np.inf) if floor is None else floor.copy()
    with np.errstate(over="ignore"):
        small = np.abs(queries) @ file.largest() < _WHOLE
    for begin in range(0, len(ids), SCAN_ROWS):
        end = min(begin + SCAN_ROWS, len(ids))
        low, high = file.bounds(queries, begin, end)
        own = query_ids[:, None] == ids[None, begin:end]
        low[own], high[own] = -np.inf, -np.inf
        certain = np.partition(low, end - begin - k, axis=1)[:, end - begin - k] if end - begin >= k else np.full(len(queries), -np.inf)
        near = (high >= np.maximum(floor, certain)[:, None]) & ~own
        for q in np.flatnonzero(near.any(1)):
            picks = np.flatnonzero(near[q])
            order = np.lexsort((ids[begin + picks], -high[q, picks]))
            picks, found = picks[order], best[q]
            upper, named = high[q, picks].tolist(), ids[begin + picks].tolist()
            for at in range(0, len(picks), READ_ROWS):
                # what follows has no larger bound, and with the same bound no smaller id
                if len(found) >= k and (-upper[at], named[at]) > (found[k - 1][0], found[k - 1][1]) and upper[at] <= -found[k - 1][0]:
                    break
                read = begin + picks[at : at + READ_ROWS]
                found = sorted(found + [(-s, i) for s, i in zip(_exact(vectors[read], queries[q], small[q]), named[at : at + READ_ROWS], strict=True)])[:k]
            best[q] = found
            if len(found) >= k:
                floor[q] = max(floor[q], _below(-found[k - 1][0]))
    return [[(-s, i) for s, i in x] for x in best]


def _below(score: int) -> float:
    """A double that is the score, or less where doubles are too coarse."""
    try:
        value = float(score)
    except OverflowError:
        return -math.inf if score < 0 else math.nextafter(math.inf, 0)
    return value if value <= score else math.nextafter(value, -math.inf)


def _order(score: int) -> bytes:
    """Bytes that sort as the scores do, whatever their size."""
    size = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    key = struct.pack(">H", len(size)) + size
    return b"\1" + key if score >= 0 else b"\0" + bytes(255 - x for x in key) + b"\xff"


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if len(column) else pa.array([], pa.float64())
    return np.ascontiguousarray(flat, np.float64).reshape(len(column), dims)


def _written(rows: DataFrame, part: Column, folder: str, approximate: bool) -> list[tuple[int, int, int]]:
    """Writes the rows of each length and part as files; returns dims, part and rows of all."""

    def write(key, group):
        dims, number = key[0].as_py(), key[1].as_py()
        ids, vectors = np.asarray(group.column("vec_id")), _matrix(group.column("vector"), dims)
        order = np.lexsort((*vectors.T[::-1], ids))
        ids, vectors = ids[order], vectors[order]
        if approximate:
            _shared.write_shared(f"{folder}/cells-{dims}-{number}", ApproximationFile.of(vectors).to_bytes(ids))
            _shared.write_shared(f"{folder}/exact-{dims}-{number}", vectors.tobytes())
        else:
            _shared.write_shared(f"{folder}/asked-{dims}-{number}", ids.tobytes() + vectors.tobytes())
        return pa.table({"dims": [dims], "part": [number], "n": [len(ids)]}, schema=pa.schema([("dims", pa.int32()), ("part", pa.int32()), ("n", pa.int32())]))

    made = rows.withColumn("part", part.cast("int")).groupBy("dims", "part").applyInArrow(write, "dims int, part int, n int")
    return sorted(tuple(r) for r in made.collect())


def exact_top_k(vectors: DataFrame, k: int = 5, every: int = 50, group_rows: int = GROUP_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k best vectors of each query: query_id, rank (from 1), vec_id, score.

    vectors: vec_id long, embedding array of numbers; other columns are left
    aside. Queries are the rows whose vec_id is divisible by ``every``; an id that
    comes more than once there asks once, with its smallest vector. Every row but
    those of the query's own id is a candidate, repeated rows too. Rows with a null
    id, a null vector or a component that is null, NaN, infinite or beyond a double
    once quantised take no part. Vectors meet only such of their own length. Ties
    go to the smaller vec_id. Scores are whole numbers of any size; one beyond a
    long is ranked as what it is and returned as the nearest long. An empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: F.coalesce(F.abs(F.lit(256.0) * x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").where(sound).select("vec_id", quantised().alias("vector"), F.size("embedding").alias("dims"))
    is_query = F.col("vec_id") % every == 0
    n, asked = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    groups, blocks = max(1, -(-n // group_rows)), max(1, -(-asked // block_rows))
    folder = _shared.shared_folder(spark, "vectors")
    _shared.bounded_arrow(spark)
    held = _written(rows, F.pmod(F.monotonically_increasing_id(), F.lit(groups)), folder, True)
    asking = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dims", F.size("vector"))
    asking = _written(asking, F.pmod(F.xxhash64("vec_id"), F.lit(blocks)), folder, False)

    def search(parts: list[tuple[int, int]], floors: bool) -> DataFrame:
        blocks_of = {d: [b for e, b, _ in asking if e == d] for d in {d for d, _, _ in asking}}
        parts = [x for x in parts if x[0] in blocks_of]
        ends = np.cumsum([len(blocks_of[d]) for d, _ in parts], dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        kind = "block int, query_id long, vec_id long, score long, order binary"

        def run(batches):
            schema = pa.schema([("block", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("order", pa.binary())])
            for batch in batches:
                for pair in batch.column(0).to_pylist():
                    at = int(np.searchsorted(ends, pair, side="right"))
                    dims, part = parts[at]
                    block = blocks_of[dims][int(ends[at]) - 1 - pair]
                    raw = _shared.map_shared(f"{folder}/asked-{dims}-{block}")
                    m = len(raw) // (8 + 8 * dims)
                    q_ids, q = np.frombuffer(raw, np.int64, m), np.frombuffer(raw, np.float64, m * dims, 8 * m).reshape(m, dims)
                    file, ids = ApproximationFile.over(_shared.map_shared(f"{folder}/cells-{dims}-{part}"))
                    exact = np.frombuffer(_shared.map_shared(f"{folder}/exact-{dims}-{part}"), np.float64).reshape(len(ids), dims)
                    floor = np.full(m, -np.inf)
                    if floors and (dims, block) in known:
                        low = np.frombuffer(_shared.map_shared(f"{folder}/floors-{dims}-{block}"), np.float64)
                        floor[np.searchsorted(q_ids, low[::2].view(np.int64))] = low[1::2]
                    found = search_block(q, q_ids, file, exact, ids, k, floor)
                    out = [(block, i, other, max(-_LONG - 1, min(_LONG, s)), _order(s)) for i, best in zip(q_ids.tolist(), found, strict=True) for s, other in best]
                    yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], f.type) for c, f in enumerate(schema)], schema=schema)

        known = {(d, b) for d, b in floored} if floors else set()
        tasks = min(total, MOST_TASKS, max(1, spark.sparkContext.defaultParallelism * 4))
        return spark.range(0, total, 1, max(1, tasks)).mapInArrow(run, kind)

    order = Window.partitionBy("query_id").orderBy(F.desc("order"), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)

    first, later = [(d, p) for d, p, _ in held if p % FIRST == 0], [(d, p) for d, p, _ in held if p % FIRST]
    found = search(first, False)
    floored: list = []
    if later:
        found = _shared.through_table(top(found).drop("rank"), "found")
        sizes = {(d, b): n for d, b, n in asking}

        def floor(key, group):
            block = key[0].as_py()
            rows = sorted(zip(group.column("query_id").to_pylist(), (_score(x) for x in group.column("order").to_pylist())), key=lambda x: (x[0], -x[1]))
            made = []
            for dims in {d for d, b in sizes if b == block}:
                raw = _shared.map_shared(f"{folder}/asked-{dims}-{block}")
                own = set(np.frombuffer(raw, np.int64, sizes[dims, block]).tolist())
                low = [(i, _below(rows[at + k - 1][1])) for at, (i, _) in enumerate(rows) if i in own and (not at or rows[at - 1][0] != i) and at + k <= len(rows) and rows[at + k - 1][0] == i]
                table = np.empty(2 * len(low))
                table[::2].view(np.int64)[:] = [i for i, _ in low]
                table[1::2] = [s for _, s in low]
                _shared.write_shared(f"{folder}/floors-{dims}-{block}", table.tobytes())
                made.append((dims, block))
            return pa.table({"dims": [d for d, _ in made], "block": [b for _, b in made]}, schema=pa.schema([("dims", pa.int32()), ("block", pa.int32())]))

        floored = [(r.dims, r.block) for r in found.groupBy("block").applyInArrow(floor, "dims int, block int").collect()]
        found = found.unionByName(search(later, True))
    return top(found).select("query_id", "rank", "vec_id", "score")


def _score(order: bytes) -> int:
    """The score of its bytes."""
    if order[0]:
        return int.from_bytes(order[3:], "big")
    return -int.from_bytes(bytes(255 - x for x in order[3:-1]), "big")
