"""Best-fit packing of token pieces into sequences with a grouping genetic algorithm.

Pieces that fill a sequence stay alone. The others are dealt to cells of bounded
size and best-fitted there. Where that needs more sequences than their tokens do, a
population of packings of the cell evolves on several islands: a crossover takes
whole well-filled sequences of one parent into the other, drops the sequences that
hold an injected piece for a second time, and best-fits what they displace; a
mutation empties some sequences and fills them anew. Between epochs each island's
elite migrates to the next island; the fewest sequences win. Islands are rows, so
they run anywhere and can be repeated. The sequences of a cell that stay open are
taken apart again and meet those of other cells in a next round, until one cell
holds all that is left.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared
from .bpe import Encoder

CAPACITY = 4096
#: Tokens and pieces of a cell, about.
CELL_TOKENS, CELL_PIECES = 4 << 20, 1 << 16
#: The share of a cell's sequences that may meet those of other cells again, at most, and the room that such a sequence has.
OPEN_SHARE, OPEN_ROOM = 0.25, 16
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
GENERATIONS = 8
END_ID = 1
#: Tasks of an epoch, at most.
MOST_TASKS = 1 << 14
_SLOT = 1 << 24


def best_fit(bins: list[list[int]], pieces: list[int], size: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Puts each piece, in the order given, where least room is left; opens a sequence where none has room."""
    room = [capacity - sum(size[i] for i in x) for x in bins]
    free = sorted(r * _SLOT + b for b, r in enumerate(room) if r)
    for i in pieces:
        at = bisect_left(free, size[i] * _SLOT)
        if at < len(free):
            r, b = divmod(free.pop(at), _SLOT)
            bins[b].append(i)
        else:
            r, b = capacity, len(bins)
            bins.append([i])
        if r > size[i]:
            insort(free, (r - size[i]) * _SLOT + b)
    return bins


def fitness(bins: list[list[int]], size: list[int], capacity: int = CAPACITY) -> tuple[int, float]:
    """Fewer sequences are better, then fuller ones."""
    return -len(bins), sum((sum(size[i] for i in x) / capacity) ** 2 for x in bins)


def crossover(a: list[list[int]], b: list[list[int]], size: list[int], rng: random.Random, capacity: int = CAPACITY) -> list[list[int]]:
    """``a`` with the well-filled sequences of a part of ``b`` in it."""
    full = [x for x in b if sum(size[i] for i in x) >= capacity - 2]
    inject = rng.sample(full, rng.randint(1, max(1, len(full) // 2))) if full else [max(b, key=lambda x: sum(size[i] for i in x))]
    held = {i for x in inject for i in x}
    kept, displaced = [list(x) for x in inject], []
    for x in a:
        if held.isdisjoint(x):
            kept.append(list(x))
        else:
            displaced += [i for i in x if i not in held]
    displaced.sort(key=lambda i: (-size[i], i))
    return best_fit(kept, displaced, size, capacity)


def fill(loose: list[int], size: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Packs pieces into one sequence after the other: the largest piece that is left, and those others that fill it best.

    What sums the others reach is a number's bits; a sequence is done once its room is reached.
    """
    left = sorted(loose, key=lambda i: (-size[i], i))
    bins = []
    while left:
        own, room = [left[0]], capacity - size[left[0]]
        sums, steps, within = 1, [], (1 << room + 1) - 1
        for i in left[1:]:
            if size[i] <= room and (more := (sums | sums << size[i]) & within) != sums:
                steps.append((i, sums))
                sums = more
                if sums >> room & 1:
                    break
        at = sums.bit_length() - 1
        for i, before in reversed(steps):
            if not before >> at & 1:
                own.append(i)
                at -= size[i]
        bins.append(own)
        taken = set(own)
        left = [i for i in left if i not in taken]
    return bins


def mutate(a: list[list[int]], size: list[int], rng: random.Random, capacity: int = CAPACITY) -> list[list[int]]:
    """Empties the least filled sequences and some others, and fills them anew."""
    used = [sum(size[i] for i in x) for x in a]
    order = sorted(range(len(a)), key=lambda b: used[b])
    drop = {*order[: max(2, len(a) // 20)], *rng.sample(range(len(a)), min(len(a), max(6, len(a) // 20)))}
    loose = [i for b in drop for i in a[b]]
    return [list(x) for b, x in enumerate(a) if b not in drop] + fill(loose, size, capacity)


def evolve(size: list[int], seed: int, arrived: list[list[list[int]]], capacity: int = CAPACITY, population: int = POPULATION, generations: int = GENERATIONS) -> list[list[int]]:
    """An island's best packing. It stops at the bound that no packing can beat."""
    if not size:
        return []
    rng = random.Random(seed)
    least = -(-sum(size) // capacity)
    decreasing = sorted(range(len(size)), key=lambda i: (-size[i], i))
    pool = [x for x in arrived if x]
    if not pool:
        pool = [best_fit([], decreasing, size, capacity)]
    score = lambda x: fitness(x, size, capacity)
    best = max(pool, key=score)
    while len(best) > least and len(pool) < population:
        noise = {i: size[i] * (1 + 0.05 * rng.random()) for i in decreasing}
        pool.append(best_fit([], sorted(decreasing, key=lambda i: -noise[i]), size, capacity))
        best = max(pool, key=score)
    for _ in range(generations):
        if len(best) <= least:
            break
        a, b = rng.sample(pool, 2) if len(pool) > 1 else (pool[0], pool[0])
        child = crossover(a, b, size, rng, capacity)
        if rng.random() < 0.5:
            child = mutate(child, size, rng, capacity)
        worst = min(range(len(pool)), key=lambda i: score(pool[i]))
        if score(child) >= score(pool[worst]):
            pool[worst] = child
        best = max(pool, key=score)
    return best


def _numbers(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for b, x in enumerate(bins):
        for i in x:
            out[i] = b
    return out


def _bins(numbers: list[int]) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(max(numbers, default=-1) + 1)]
    for i, b in enumerate(numbers):
        out[b].append(i)
    return out


def _places(bins: list[int], size: list[int], capacity: int, last: bool) -> tuple[list[int], list[bool]]:
    """Each piece's offset, and whether its sequence is taken apart again: the least filled ones, none in the last round."""
    filled: dict[int, int] = {}
    at = []
    for n, b in zip(size, bins, strict=True):
        at.append(filled.get(b, 0))
        filled[b] = at[-1] + n
    open_ = sorted((b for b, n in filled.items() if n < capacity - OPEN_ROOM), key=lambda b: (filled[b], b))
    again = set() if last else set(open_[: max(1, int(len(filled) * OPEN_SHARE))])
    return at, [b in again for b in bins]


def pack(pieces: DataFrame, capacity: int = CAPACITY, cell_tokens: int = CELL_TOKENS, cell_pieces: int = CELL_PIECES, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Adds sequence_id and offset to pieces, which have a length from 1 to ``capacity`` and columns of any other name.

    Offsets of a sequence begin with 0 and leave no gap; nothing is dropped or
    cut. Repeated rows are pieces of their own. An empty table stays empty.
    """
    given, row = pieces.columns, "_row"
    while row in given:
        row = f"_{row}"
    table = _shared.through_table(pieces, "pieces").withColumn(row, F.monotonically_increasing_id())
    done = table.where(F.col("length") >= capacity).select(F.struct(*given).alias("item"), (-1 - F.col(row)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = table.where(F.col("length") < capacity).select(F.struct(*given).alias("item"), F.col(row).alias("row"), F.col("length").cast("int").alias("length"))
    number = 0
    while True:
        n, tokens = rest.agg(F.count("*"), F.sum("length")).first()
        cells = max(1, -(-n // cell_pieces), -(-(tokens or 0) // cell_tokens))
        packed = _round(rest.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(cells))), capacity, cells == 1, islands, epochs)
        ids = F.lit(number << 56) + F.col("cell") * F.lit(1 << 24) + F.col("bin")
        done = done.unionByName(packed.where(~F.col("open")).select("item", ids.alias("sequence_id"), F.col("place").alias("offset")))
        if cells == 1:
            break
        rest = packed.where("open").select("item", "row", "length")
        number += 1
    return done.select("item.*", "sequence_id", "offset")


def _round(pieces: DataFrame, capacity: int, last: bool, islands: int, epochs: int) -> DataFrame:
    """Packs each cell's pieces (item, row, length, cell) for itself; adds bin, place and open."""
    import pyarrow as pa
    from pyspark.sql import types as T

    _shared.bounded_arrow(pieces.sparkSession)
    kind = T.StructType([*pieces.schema.fields, T.StructField("bin", T.LongType()), T.StructField("place", T.LongType()), T.StructField("open", T.BooleanType()), T.StructField("least", T.BooleanType())])

    def first(key, group):
        size = group.column("length").to_pylist()
        best = best_fit([], sorted(range(len(size)), key=lambda i: (-size[i], i)), size, capacity)
        bins = _numbers(best, len(size))
        at, again = _places(bins, size, capacity, last)
        least = len(best) <= -(-sum(size) // capacity)
        for name, values in (("bin", pa.array(bins, pa.int64())), ("place", pa.array(at, pa.int64())), ("open", pa.array(again, pa.bool_())), ("least", pa.array([least] * len(size), pa.bool_()))):
            group = group.append_column(name, values)
        return group

    fitted = _shared.through_table(pieces.groupBy("cell").applyInArrow(first, kind), "fitted")
    packed, hard = fitted.where("least").drop("least"), fitted.where("not least")
    if not hard.head(1):
        return packed
    cells = _shared.through_table(hard.groupBy("cell").agg(F.collect_list(F.struct("item", "row", "length", "bin")).alias("items")), "cells")

    def island_epoch(batches):
        schema = pa.schema([("cell", pa.int64()), ("island", pa.int32()), ("size", pa.list_(pa.int32())), ("elite", pa.list_(pa.int32())), ("used", pa.int64()), ("fill", pa.float64())])
        for batch in batches:
            out = []
            for cell, island, size, arrived in zip(*(batch.column(c).to_pylist() for c in ("cell", "island", "size", "arrived")), strict=True):
                best = evolve(size, (cell * 64 + island) * 64 + len(arrived), [_bins(x) for x in arrived], capacity)
                used = fitness(best, size, capacity)
                out.append({"cell": cell, "island": island, "size": size, "elite": _numbers(best, len(size)), "used": -used[0], "fill": used[1]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    numbers = lambda c: F.transform("items", lambda x: x[c].cast("int"))
    tasks = min(MOST_TASKS, cells.count() * islands)  # few bytes, but much to do: not to be put together into few tasks
    state = cells.select("cell", numbers("length").alias("size"), F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.array(numbers("bin")).alias("arrived"))
    for epoch in range(epochs):
        state = state.repartition(tasks, "cell", "island").mapInArrow(island_epoch, "cell long, island int, size array<int>, elite array<int>, used long, fill double")
        if epoch + 1 < epochs:
            state = _shared.through_table(state, "elites")
            away = state.select("cell", ((F.col("island") + 1) % islands).alias("island"), F.col("elite").alias("arriving"))
            state = state.join(away, ["cell", "island"]).select("cell", "size", "island", F.array("elite", "arriving").alias("arrived"))
    best = state.groupBy("cell").agg(F.max_by(F.struct("size", "elite"), F.struct(-F.col("used"), "fill", -F.col("island"))).alias("x")).select("cell", "x.size", "x.elite")

    def offsets(batches):
        for batch in batches:
            cell, sizes, elites = (batch.column(c).to_pylist() for c in ("cell", "size", "elite"))
            found = [_places(own, size, capacity, last) for size, own in zip(sizes, elites, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(elites, pa.list_(pa.int64())), pa.array([x for x, _ in found], pa.list_(pa.int64())), pa.array([x for _, x in found], pa.list_(pa.bool_()))], names=["cell", "bins", "places", "opens"])

    placed = cells.join(best.mapInArrow(offsets, "cell long, bins array<long>, places array<long>, opens array<boolean>"), "cell")
    evolved = placed.select("cell", F.explode(F.arrays_zip("items", "bins", "places", "opens")).alias("x"))
    evolved = evolved.select("x.items.item", "x.items.row", "x.items.length", "cell", F.col("x.bins").alias("bin"), F.col("x.places").alias("place"), F.col("x.opens").alias("open"))
    return packed.unionByName(_shared.through_table(evolved, "evolved"))


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Each document's ids with the end id, cut into pieces of ``capacity``: doc_id, piece, start, length, ids_crc32."""

    def work():
        encoder = Encoder(path)

        def step(chunk):
            columns: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc, ids in zip(chunk.column("doc_id").to_pylist(), encoder.encode(chunk.column("text").to_pylist()), strict=True):
                ids = np.append(ids, end_id).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    for c, x in zip(columns, (doc, k, start, len(own), zlib.crc32(own.tobytes())), strict=True):
                        columns[c].append(x)
            return columns

        return step

    return _shared.map_chunks(docs.select(F.col("doc_id").cast("long"), _shared.text_of()), work, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, **parameters) -> DataFrame:
    """Packs whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Documents longer than a sequence are
    cut, others never. Null ids and repeated rows are documents like any other;
    other columns are left aside.
    """
    return pack(token_pieces(docs, path, capacity), capacity, **parameters)
