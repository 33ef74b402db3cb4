"""Near-duplicates by SimHash, confirmed and completed by the resemblance of word shingles.

Two texts are alike if the sets of their five-word shingles have a Jaccard
similarity of 0.8 or more. Every distinct set gets a SimHash fingerprint. Sets whose
fingerprints differ in few bits are found by the Gray-order index of simhash.py, and
compared; those that are alike are one group from there on.
Alike sets were seen to differ in up to 14 of 64 bits, further than any index of
fingerprints reaches. So a prefix index then looks for what links those groups and
the other sets, and no pair is missed:
in any fixed order of shingles, alike sets of n shingles share one among the first
n - ceil(0.8 n) + 1 of each. The order puts those last that a sample of the sets
holds more than once, the most frequent at the very end; a sample only decides how
many pairs are looked at, not which are found. Equal sets are one from there on.
Sets lie in files of the shared folder and are memory-mapped by the tasks that
compare; a set that is linked is not compared within its group again, so a crowd of
near copies costs a comparison for each, not for each pair.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared, simhash

WORDS = 5
#: The least similarity, as a fraction.
SIMILAR = (4, 5)
#: Bits in which fingerprints that the index finds may differ.
DISTANCE = 3
#: Sets of the sample that the order is taken from, about.
SAMPLE = 16384
#: Entries of the index that a task holds, about.
PART_ENTRIES = 1 << 20
#: Files of sets that a task keeps open.
OPEN = 256
_ENTRY = np.dtype([("shingle", "<u8"), ("at", "<i8"), ("place", "<i4"), ("n", "<i4")])
_PLACE_BITS = 21  # an address is split, chunk, place: 22, 20 and 21 bits


class _Sets:
    """The files of sets, by address."""

    def __init__(self, folder: str):
        self.folder, self.open, self.near = folder, {}, {}

    def file(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the sets of a file, and all their shingles."""
        if number not in self.open:
            if len(self.open) >= OPEN:
                self.open.pop(next(iter(self.open)))
            blob = _shared.map_shared(f"{self.folder}/{number}")
            (n,) = struct.unpack_from("<q", blob)
            self.open[number] = np.frombuffer(blob, np.int64, n + 1, 8), np.frombuffer(blob, np.uint64, offset=8 * (n + 2))
        return self.open[number]

    def get(self, at: int) -> np.ndarray:
        ends, shingles = self.file(at >> _PLACE_BITS)
        i = at & ((1 << _PLACE_BITS) - 1)
        return shingles[ends[i] : ends[i + 1]]

    def size(self, at: int) -> int:
        ends, i = self.file(at >> _PLACE_BITS)[0], at & ((1 << _PLACE_BITS) - 1)
        return int(ends[i + 1] - ends[i])

    def root(self, at: int, known: set[int]) -> int:
        """The first set of the group that fingerprints gave, the set itself if they gave none; known: files with groups."""
        number = at >> _PLACE_BITS
        if number not in known:
            return at
        if number not in self.near:
            if len(self.near) >= OPEN:
                self.near.pop(next(iter(self.near)))
            self.near[number] = np.frombuffer(_shared.map_shared(f"{self.folder}/{number}.near"), np.int64).reshape(2, -1)
        own, roots = self.near[number]
        i = int(np.searchsorted(own, at))
        return int(roots[i]) if i < len(own) and own[i] == at else at


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The distinct shingles of each text, in order."""
    return [np.unique(np.array(simhash.shingle_hashes(t, words), np.uint64)) for t in texts]


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return _enough(int((both[1:] == both[:-1]).sum()), len(both))


def _enough(common, total):
    """Whether sets of so many shingles together are alike; numbers or arrays."""
    top, bottom = SIMILAR
    return (top + bottom) * common >= top * total


def _written(docs: DataFrame, row: str, code: str, at: str, fingerprint: str, folder: str) -> DataFrame:
    """The rows with number, hash of the set, address and fingerprint; the sets go to the folder."""
    ahead = docs.withColumn(row, F.monotonically_increasing_id()).withColumns({c: F.lit(0).cast("long") for c in (code, at, fingerprint)})

    def run(batches):
        from xxhash import xxh64_intdigest

        for k, chunk in enumerate(_shared.chunks(batches)):
            if not chunk.num_rows:
                continue
            sets = shingle_sets([x or "" for x in chunk.column("text").to_pylist()])
            split = chunk.column(row)[0].as_py() >> 33
            number = split << 20 | k
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int64)
            _shared.write_shared(f"{folder}/{number}", struct.pack("<q", len(sets)) + ends.tobytes() + np.concatenate(sets).astype(np.uint64).tobytes())
            codes = np.array([xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            prints = simhash.majority(sets).view(np.int64)
            for name, values in ((code, codes), (at, (number << _PLACE_BITS) + np.arange(len(sets))), (fingerprint, prints)):
                chunk = chunk.set_column(chunk.column_names.index(name), name, pa.array(values))
            yield from chunk.to_batches()

    _shared.bounded_arrow(docs.sparkSession)
    return _shared.through_table(ahead.mapInArrow(run, ahead.schema), "numbered")


def _frequent(firsts: DataFrame, folder: str, n: int, sample: int) -> str:
    """A file of the shingles that more than one set of a sample holds, and in how many: the end of the order."""
    most = (1 << 31) - 1
    # 2**31 - 1 is prime, so that what is kept doesn't follow splits or places
    limit = most if n <= sample else most * sample // n
    some = firsts.where(F.pmod(F.xxhash64("code"), F.lit(most)) < limit)

    def read(key, group):
        sets = _Sets(folder)
        found = [sets.get(a) for a in group.column("at").to_pylist()]
        shingles, counts = np.unique(np.concatenate(found), return_counts=True)
        return pa.table({"shingle": shingles.view(np.int64), "n": counts}, schema=pa.schema([("shingle", pa.int64()), ("n", pa.int64())]))

    seen = some.groupBy("file").applyInArrow(read, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    shingles, counts = np.asarray(seen.column("shingle")).view(np.uint64), np.asarray(seen.column("n")).astype(np.uint64)
    order = np.argsort(shingles)
    _shared.write_shared(f"{folder}/frequent", np.concatenate([shingles[order], counts[order]]).tobytes())
    return f"{folder}/frequent"


def _entries(firsts: DataFrame, folder: str, frequent: str, parts: int) -> DataFrame:
    """Blobs of the first shingles of each set, dealt by shingle."""

    def run(key, group):
        sets, both = _Sets(folder), np.frombuffer(_shared.map_shared(frequent), np.uint64)
        known, often = both[: len(both) // 2], both[len(both) // 2 :]
        at = np.sort(np.asarray(group.column("at")))
        shard, blobs = [], []
        for s in range(0, len(at), 2048):
            own = at[s : s + 2048]
            found = [sets.get(a) for a in own.tolist()]
            n = np.fromiter(map(len, found), np.int64, len(found))
            flat, which = np.concatenate(found), np.repeat(np.arange(len(found)), n)
            last = np.zeros(len(flat), np.uint64)
            if len(known):
                place = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                hit = known[place] == flat
                last[hit] = often[place[hit]]
            order = np.lexsort((flat, last, which))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            first = place < (n + (-SIMILAR[0] * n // SIMILAR[1]) + 1)[which]
            entries = np.zeros(int(first.sum()), _ENTRY)
            entries["shingle"], entries["at"], entries["place"], entries["n"] = flat[order][first], own[which][first], place[first], n[which][first]
            where = (entries["shingle"] % np.uint64(parts)).astype(np.int32)
            by = np.argsort(where, kind="stable")
            cuts = np.searchsorted(where[by], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                shard.append(p)
                blobs.append(entries[by[cuts[p] : cuts[p + 1]]].tobytes())
        return pa.table({"part": shard, "blob": blobs}, schema=pa.schema([("part", pa.int32()), ("blob", pa.binary())]))

    return firsts.groupBy("file").applyInArrow(run, "part int, blob binary")


def _joined(sets: _Sets, at: np.ndarray, place: np.ndarray, n: np.ndarray, root: list[int] | None = None) -> list[tuple[int, int]]:
    """Links between the sets that have a shingle, so many that all alike ones are joined.

    A pair is left to another shingle if too little follows this one: it shares an
    earlier one then, if it is alike. Sets of one root are joined already.
    """
    groups: list[list[int]] = []
    roots: list[set[int]] = []
    out, held = [], {}
    root = at.tolist() if root is None else root

    def own(i):
        if i not in held:
            held[i] = sets.get(int(at[i]))
        return held[i]

    for i in range(len(at)):
        met = []
        for g, group in enumerate(groups):
            if root[i] in roots[g]:
                met.append(g)
                continue
            members = np.array(group)
            able = _enough(np.minimum(n[members] - place[members], n[i] - place[i]), n[members] + n[i])
            for j in members[able].tolist():
                if alike(own(i), own(j)):
                    out.append((int(at[i]), int(at[j])))
                    met.append(g)
                    break
        if not met:
            groups.append([i])
            roots.append({root[i]})
            continue
        groups[met[0]].append(i)
        roots[met[0]].add(root[i])
        for g in reversed(met[1:]):
            groups[met[0]] += groups.pop(g)
            roots[met[0]] |= roots.pop(g)
    return out


def near(firsts: DataFrame, folder: str, distance: int = DISTANCE) -> DataFrame:
    """a, b: sets whose fingerprints are near each other's and that are alike, each with the first one of its group.

    firsts: at and print of distinct sets. Fingerprints that the Gray-order index links are
    candidates for one group; within it sets are compared themselves.
    """
    codes = _shared.through_table(firsts.select(F.col("print").alias("code")).distinct(), "codes")
    found = simhash._linked(simhash.components(simhash.links(codes, distance))).withColumnsRenamed({"code": "print", "root": "other"})
    dealt = _shared.through_table(firsts.select("at", "print").join(found, "print", "left").select("at", F.coalesce("other", "print").alias("near")), "near")
    several = dealt.groupBy("near").agg(F.count("*").alias("n")).where("n > 1").select("near")

    def confirm(key, group):
        sets, at = _Sets(folder), np.sort(np.asarray(group.column("at")))
        n = np.fromiter(map(sets.size, at.tolist()), np.int64, len(at))
        root = {}

        def top(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in _joined(sets, at, np.zeros(len(at), np.int64), n):
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
        own = [(x, top(x)) for x in list(root)]
        return pa.table({"a": [x for x, _ in own], "b": [y for _, y in own]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return _shared.through_table(dealt.join(several, "near").groupBy("near").applyInArrow(confirm, "a long, b long"), "near")


def _near_files(alike_ones: DataFrame, folder: str) -> set[int]:
    """Writes the groups of near() beside the files of sets; the numbers of the files that have some."""

    def write(key, group):
        number, own = key[0].as_py(), np.stack([np.asarray(group.column(c)) for c in ("a", "b")])
        _shared.write_shared(f"{folder}/{number}.near", np.ascontiguousarray(own[:, np.argsort(own[0])]).tobytes())
        return pa.table({"file": [number]}, schema=pa.schema([("file", pa.int64())]))

    by_file = alike_ones.withColumn("file", F.shiftright("a", _PLACE_BITS)).groupBy("file")
    return {r.file for r in by_file.applyInArrow(write, "file long").collect()}


def links(firsts: DataFrame, folder: str, sample: int = SAMPLE, part_entries: int = PART_ENTRIES, distance: int = DISTANCE) -> DataFrame:
    """Links a-b between the addresses of distinct sets (columns code, at, file, print), enough of them to join all that are alike.

    First those that fingerprints find, then what the prefix index adds to their groups.
    """
    found = near(firsts, folder, distance)
    known = _near_files(found, folder)
    frequent = _frequent(firsts, folder, firsts.count(), sample)

    def sizes(key, group):
        ends = np.diff(_Sets(folder).file(key[0].as_py())[0])
        return pa.table({"n": [int(ends.sum())]}, schema=pa.schema([("n", pa.int64())]))

    total = firsts.select("file").distinct().groupBy("file").applyInArrow(sizes, "n long").agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total * (SIMILAR[1] - SIMILAR[0]) // SIMILAR[1] // part_entries))

    def search(key, group):
        sets = _Sets(folder)
        entries = np.concatenate([np.frombuffer(b, _ENTRY) for b in group.column("blob").to_pylist()])
        order = np.argsort(entries["shingle"], kind="stable")
        ranked = entries["shingle"][order]
        cuts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]]))
        out = []
        for c in np.flatnonzero(np.diff(cuts) > 1).tolist():
            x = entries[order[cuts[c] : cuts[c + 1]]]
            x = x[np.argsort(x["at"])]
            root = [sets.root(a, known) for a in x["at"].tolist()]
            if any(r != root[0] for r in root):
                out += _joined(sets, x["at"], x["place"].astype(np.int64), x["n"].astype(np.int64), root)
        return pa.table({"a": [a for a, _ in out], "b": [b for _, b in out]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return found.union(_entries(firsts, folder, frequent, parts).groupBy("part").applyInArrow(search, "a long, b long"))


def one_of_each(docs: DataFrame, sample: int = SAMPLE, part_entries: int = PART_ENTRIES) -> DataFrame:
    """One row, in all its columns, of each component of alike texts: the first one of the table.

    Texts without words are alike. Rows are kept by bit maps where they lie, as in simhash.
    """
    row, code, at, fingerprint = "_row", "_code", "_at", "_print"
    while {row, code, at, fingerprint} & set(docs.columns):
        row, code, at, fingerprint = f"_{row}", f"_{code}", f"_{at}", f"_{fingerprint}"
    folder = _shared.shared_folder(docs.sparkSession, "sets")
    table = _written(docs, row, code, at, fingerprint, folder)
    by_code = table.groupBy(F.col(code).alias("code")).agg(F.min(row).alias("first"), F.min(at).alias("at"), F.min(fingerprint).alias("print"))
    firsts = _shared.through_table(by_code.withColumn("file", F.shiftright("at", _PLACE_BITS)), "firsts")
    roots = simhash._linked(simhash.components(links(firsts.select("code", "at", "file", "print"), folder, sample, part_entries))).withColumnRenamed("code", "at")
    linked = _shared.through_table(firsts.join(roots, "at").select("code", "first", "root"), "linked")
    named = linked.join(linked.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("code", "component_id")
    groups = firsts.join(named, "code", "left").select("code", F.coalesce("component_id", "first").alias("component_id"))
    found = table.select(F.col(row).alias("doc_id"), F.col(code).alias("code")).join(groups, "code", "left").select("doc_id", "component_id")
    return simhash.first_rows(table.drop(code, at, fingerprint), found, row)
