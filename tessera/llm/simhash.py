"""SimHash near-duplicates with a Gray-order hierarchical index.

Every text gets a 64-bit fingerprint; equal ones are one from there on. Two
fingerprints that differ in at most two bits agree in at least one of three blocks
of bits, so each is indexed three times, rotated so that another block leads, and
dealt to ranges of the Gray order. In that order codes that share their leading
bits are neighbours. A range becomes a tree: a node keeps the bits that all codes
below share and no node above has, so the differences on the way down add up, and
a node that exceeds the limit takes its whole group with it. A block so common
that it fills several ranges is searched from range to range, where a range's
leading bits allow it. Links become components by alternating star contractions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

WORDS = 3
SEED = 42
DISTANCE = 2
#: Codes of a range, about; with very many codes more, so that ranges stay few.
RANGE_CODES = 4096
MOST_RANGES = 4096
LEAF, FAN = 16, 8
#: Pairs of a query and a node that a search holds at once, about.
FRONTIER = 1 << 21

_LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def shingle_hashes(text: str, words: int = WORDS, seed: int = SEED) -> list[int]:
    """XXH64 of each run of so many words, lower-cased in A-Z and joined by spaces."""
    from xxhash import xxh64_intdigest

    found = text.encode().lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxh64_intdigest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = (ends[: len(found) - words + 1] - np.fromiter(map(len, found[: len(found) - words + 1]), np.int64) - 1).tolist()
    return [xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]


def fingerprints(texts: list[str], words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprints of texts; a text without words has no bit set."""
    return majority([shingle_hashes(t, words, seed) for t in texts])


def majority(hashes: list) -> np.ndarray:
    """A bit is 1 if it is set in over half of a text's hashes."""
    n = np.fromiter(map(len, hashes), np.int64, len(hashes))
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    flat = np.concatenate([np.array(hashes[i], np.uint64) for i in full]).view(np.uint8).reshape(-1, 8)
    blocks = -(-n[full] // 255)  # so many hashes at most add up in lanes of a byte
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    begin = np.repeat(np.cumsum(n[full]) - n[full], blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    lanes = np.stack([np.add.reduceat(_LANES[flat[:, j]], begin) for j in range(8)], 1).view(np.uint8).reshape(-1, 64)
    counts = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
    bits = np.packbits(2 * counts > n[full][:, None], axis=1, bitorder="little")
    out[full] = np.ascontiguousarray(bits).view(np.uint64).ravel()
    return out


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of a code in the reflected Gray order."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def gray_code(ranks: np.ndarray) -> np.ndarray:
    return ranks ^ (ranks >> np.uint64(1))


def rotations(distance: int) -> list[tuple[int, int]]:
    """For each block of bits: how far it lies from the top, and its width."""
    blocks = distance + 1
    at = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def rotated(codes: np.ndarray, by: int) -> np.ndarray:
    return codes if not by else (codes << np.uint64(by)) | (codes >> np.uint64(64 - by))


class GrayIndex:
    """The hierarchical index over codes in Gray order."""

    def __init__(self, codes: np.ndarray):
        """codes: sorted by Gray rank."""
        self.codes = codes
        spans, width = [], LEAF
        while True:
            spans.append(np.arange(0, len(codes), width))
            if len(spans[-1]) <= 1:
                break
            width *= FAN
        spans.reverse()
        shared_above = np.zeros(1, np.uint64)
        self.levels = []
        for depth, begin in enumerate(spans):
            every, some = np.bitwise_and.reduceat(codes, begin), np.bitwise_or.reduceat(codes, begin)
            shared = ~(every ^ some)
            above = shared_above[np.arange(len(begin)) // FAN] if depth else np.zeros(len(begin), np.uint64)
            mask = shared & ~above
            self.levels.append((mask, every & mask))
            shared_above = shared
        self.rest = ~shared_above

    def search(self, queries: np.ndarray, distance: int):
        """Yields (query, place) arrays of pairs that differ in at most so many bits."""
        todo = [(0, len(queries))]
        while todo:
            begin, end = todo.pop()
            q, node, so_far = np.arange(begin, end), np.zeros(end - begin, np.int64), np.zeros(end - begin, np.uint8)
            for depth, (mask, pattern) in enumerate(self.levels):
                if depth:
                    if len(q) * FAN > FRONTIER and end - begin > 1:
                        break
                    node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    q, so_far = np.repeat(q, FAN), np.repeat(so_far, FAN)
                    inside = node < len(mask)
                    q, node, so_far = q[inside], node[inside], so_far[inside]
                so_far = so_far + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
                near = so_far <= distance
                q, node, so_far = q[near], node[near], so_far[near]
            else:
                if len(q) * LEAF <= FRONTIER or end - begin == 1:
                    place = (node[:, None] * LEAF + np.arange(LEAF)).ravel()
                    leaf = np.repeat(node, LEAF)
                    q, so_far = np.repeat(q, LEAF), np.repeat(so_far, LEAF)
                    inside = place < len(self.codes)
                    q, so_far, leaf, place = q[inside], so_far[inside], leaf[inside], place[inside]
                    near = so_far + np.bitwise_count((queries[q] ^ self.codes[place]) & self.rest[leaf]) <= distance
                    yield q[near], place[near]
                    continue
            middle = (begin + end) // 2
            todo += [(begin, middle), (middle, end)]


def _join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b: the smallest of what is linked."""
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return labels
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        least = np.minimum(la, lb)
        np.minimum.at(labels, la, least)
        np.minimum.at(labels, lb, least)
        while not np.array_equal(labels, hop := labels[labels]):
            labels = hop


def _leading(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask and pattern of the leading code bits that all ranks of each range share."""
    low = np.concatenate([[np.uint64(0)], bounds])
    high = np.concatenate([bounds - np.uint64(1), [np.uint64(2**64 - 1)]])
    differ = low ^ high
    for shift in (1, 2, 4, 8, 16, 32):
        differ |= differ >> np.uint64(shift)
    mask = ~differ
    return mask, gray_code(low) & mask


def links(codes: DataFrame, distance: int = DISTANCE, range_codes: int = RANGE_CODES) -> DataFrame:
    """Links a-b between distinct codes (column code long), enough of them to join all that differ in at most so many bits."""
    n = codes.count()
    turns = rotations(distance)
    parts = min(MOST_RANGES, max(1, -(-n // range_codes)))

    def ranks(batches):
        for batch in batches:
            own = np.asarray(batch.column("code")).view(np.uint64)
            for turn, (by, _) in enumerate(turns):
                ordered = (gray_rank(rotated(own, by)) ^ np.uint64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), turn, np.int32)), pa.array(ordered)], names=["turn", "rank"])

    _shared.bounded_arrow(codes.sparkSession)
    bounds = [np.zeros(0, np.uint64)] * len(turns)
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        for r in codes.mapInArrow(ranks, "turn int, rank long").groupBy("turn").agg(F.percentile_approx("rank", at, F.lit(20 * parts)).alias("at")).collect():
            bounds[r.turn] = np.unique(np.array(r.at, np.int64).view(np.uint64) ^ np.uint64(1 << 63))
            bounds[r.turn] = bounds[r.turn][bounds[r.turn] > 0]

    def deal(batches):
        kinds = [(b, *_leading(b)) for b in bounds]
        for batch in batches:
            own = np.asarray(batch.column("code")).view(np.uint64)
            for turn, ((by, width), (edge, mask, pattern)) in enumerate(zip(turns, kinds, strict=True)):
                code = rotated(own, by)
                rank = gray_rank(code)
                last = rank | np.uint64((1 << (64 - width)) - 1)  # of the ranks that share the block
                home, end = np.searchsorted(edge, rank, side="right"), np.searchsorted(edge, last, side="right")
                who, where, visits = [np.arange(len(own))], [home], [np.zeros(len(own), bool)]
                going, step = np.flatnonzero(end > home), 1
                while len(going):
                    to = home[going] + step
                    near = np.bitwise_count((code[going] ^ pattern[to]) & mask[to]) <= distance
                    who.append(going[near])
                    where.append(to[near])
                    visits.append(np.ones(near.sum(), bool))
                    step += 1
                    going = going[home[going] + step <= end[going]]
                picks = np.concatenate(who)
                for s in range(0, len(picks), 1 << 16):
                    x = slice(s, s + (1 << 16))
                    m = len(picks[x])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(m, turn, np.int32)), pa.array(np.concatenate(where)[x].astype(np.int32)), pa.array(own[picks[x]].view(np.int64)), pa.array(np.concatenate(visits)[x])], names=["turn", "part", "code", "visits"])

    def search(key, group):
        own, visits = np.asarray(group.column("code")).view(np.uint64), np.asarray(group.column("visits"))
        by = turns[key[0].as_py()][0]
        code = rotated(own, by)
        order = np.lexsort((gray_rank(code), visits))
        own, code, at_home = own[order], code[order], int((~visits).sum())
        labels = np.arange(len(code))
        if at_home and len(code) > 1:
            index = GrayIndex(code[:at_home])
            for a, b in index.search(code, distance):
                differ = a != b
                labels = _join_labels(labels, a[differ], b[differ])
        far = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.table({"a": own[far].view(np.int64), "b": own[labels[far]].view(np.int64)}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return codes.mapInArrow(deal, "turn int, part int, code long, visits boolean").groupBy("turn", "part").applyInArrow(search, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of the edges a-b: the smallest node that it reaches.

    Large-star and small-star steps in turn; each state is written to the shared
    folder, so lineage stays short and a lost executor costs one step.
    """
    found = _shared.through_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = found.select("a", "b").union(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        found = _shared.through_table(small, "links")
        state = found.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return found.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
        before = state


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, words: int = WORDS, range_codes: int = RANGE_CODES) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links reach, of every row.

    A null or empty text has the fingerprint zero, which links like any other.
    Repeated rows keep a row each. A row without a doc_id takes part; if none of its
    component has one, component_id is null. An empty table gives an empty result.
    """

    def work():
        def step(chunk):
            return {"doc_id": chunk.column("doc_id"), "code": fingerprints(chunk.column("text").to_pylist(), words).view(np.int64)}

        return step

    prints = _shared.map_chunks(docs.select(F.col("doc_id").cast("long"), _shared.text_of()), work, "doc_id long, code long")
    found = grouped(_shared.through_table(prints, "fingerprints"), distance, range_codes)
    return found.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def grouped(prints: DataFrame, distance: int = DISTANCE, range_codes: int = RANGE_CODES) -> DataFrame:
    """doc_id, code, component_id of written rows doc_id, code."""
    codes = _shared.through_table(prints.groupBy("code").agg(F.min("doc_id").alias("first")), "codes")
    roots = components(links(codes.select("code"), distance, range_codes))
    linked = _shared.through_table(codes.join(_linked(roots), "code").select("code", "first", "root"), "linked")
    named = linked.join(linked.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("code", "component_id")
    groups = codes.join(named, "code", "left").select("code", F.coalesce("component_id", "first").alias("component_id"))
    return prints.join(groups, "code", "left").select("doc_id", "code", "component_id")


def one_of_each(docs: DataFrame, distance: int = DISTANCE, words: int = WORDS, range_codes: int = RANGE_CODES) -> DataFrame:
    """One row, in all its columns, of each component: the first one of the table.

    Rows are numbered by split and place. The numbers that stay are written as a bit
    map for each split, and the rows are filtered where they lie: texts are never
    shuffled, and copies of a row don't meet in one task.
    """
    row, code = "_row", "_code"
    while row in docs.columns:
        row = f"_{row}"
    while code in docs.columns:
        code = f"_{code}"
    ahead = docs.withColumn(row, F.monotonically_increasing_id()).withColumn(code, F.lit(0).cast("long"))

    def mark(batches):
        for chunk in _shared.chunks(batches):
            codes = fingerprints([x or "" for x in chunk.column("text").to_pylist()], words).view(np.int64)
            yield from chunk.set_column(chunk.column_names.index(code), code, pa.array(codes)).to_batches()

    _shared.bounded_arrow(docs.sparkSession)
    table = _shared.through_table(ahead.mapInArrow(mark, ahead.schema), "numbered")
    found = grouped(table.select(F.col(row).alias("doc_id"), F.col(code).alias("code")), distance, range_codes)
    return first_rows(table.drop(code), found, row)


def first_rows(table: DataFrame, found: DataFrame, row: str) -> DataFrame:
    """The rows of a written table whose number, in the column row, is the component_id that found has for them as doc_id."""
    folder = _shared.shared_folder(table.sparkSession, "stay")

    def write(key, group):
        split = key[0].as_py()
        places = np.asarray(group.column("place"))
        bits = np.zeros(int(places.max()) + 1, bool)
        bits[places] = True
        _shared.write_shared(f"{folder}/{split}", np.packbits(bits).tobytes())
        return pa.table({"split": [split], "n": [len(places)]}, schema=pa.schema([("split", pa.int64()), ("n", pa.int64())]))

    place = F.col("doc_id").bitwiseAND(F.lit((1 << 33) - 1))
    stay = found.where(F.col("doc_id") == F.col("component_id")).select(F.shiftright("doc_id", 33).alias("split"), place.alias("place"))
    written = {r.split for r in stay.groupBy("split").applyInArrow(write, "split long, n long").select("split").collect()}

    def keep(batches):
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            numbers = np.asarray(batch.column(row))
            splits, places = numbers >> 33, numbers & ((1 << 33) - 1)
            mask = np.zeros(len(numbers), bool)
            for split in np.unique(splits).tolist():
                if split not in maps:  # a split without a row that stays has no bit map; any other's must be there
                    maps[split] = np.frombuffer(_shared.map_shared(f"{folder}/{split}"), np.uint8) if split in written else np.zeros(0, np.uint8)
                own = np.flatnonzero((splits == split) & (places >> 3 < len(maps[split])))
                mask[own] = (maps[split][places[own] >> 3] >> (7 - (places[own] & 7))) & 1
            yield batch.filter(pa.array(mask)).drop_columns([row])

    return table.mapInArrow(keep, table.drop(row).schema)


def _linked(roots: DataFrame) -> DataFrame:
    """code, root of all linked codes, the roots themselves too."""
    return roots.select(F.col("node").alias("code"), "root").union(roots.select(F.col("root").alias("code"), "root")).distinct()
