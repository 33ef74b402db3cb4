"""Language-model scoring with an Elias-Fano n-gram trie.

The trie has three levels, cut into shards by an n-gram's first word; each shard of
each level is one file of the shared folder, written once and memory-mapped by every
task that reads it. The first level is the sorted hashes of all words. The children
of a node are runs of the next level, found by monotone pointers. A second word is
kept by its number, a third by its place among the successors of the second, so
that numbers are small where contexts are; each run continues the last, which makes
the level one increasing sequence. Pointers and levels are Elias-Fano sequences,
searched by successor queries. Probabilities are smoothed by absolute discounting,
interpolated down to add-one unigrams, and quantised to a byte.
"""

from __future__ import annotations

import json
import struct
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

HELD_OUT, HELD_OUT_REST = 7, 2
#: What an n-gram of two or more words is discounted by, and how often one must be seen to be kept.
DISCOUNT = 0.75
SEEN = 1
#: Shards of the trie, at least; there are more if the input has more splits.
LEAST_SHARDS, MOST_SHARDS = 64, 1 << 14
#: Bytes of text that are worked on at once.
CHUNK_CHARS = 10 << 20
NUMBER_BYTES = 8 << 20
#: N-grams that a task counts before it passes them on.
COUNTED = 2 << 20
#: Files of levels that a task holds open, and bytes of them, about.
OPEN_FILES, OPEN_BYTES = 4096, 512 << 20
#: A word can't be this.
END = b"\n"
_SEED = 7
_SOLID = np.ones(256, bool)
_SOLID[list(b" \t\n\x0b\x0c\r")] = False
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


# -- Elias-Fano sequences -------------------------------------------------------------------------


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(values) * width >> 6) + 2, np.uint64)
    if width:
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(out, word, values << off)
        over = off + np.uint64(width) > 64
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(64) - off[over]))
    return out


#: The place of the k-th set bit of a byte, at 8 * byte + k.
_IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[k] for byte in range(256) for k in range(8)], np.int64)


class EliasFano:
    """An increasing sequence of unsigned numbers over arrays that may be memory-mapped."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.width, self.low, self.high, self.ones, self.zeros = n, width, low, high, ones, zeros
        self.mask = np.uint64((1 << width) - 1)
        self.hints: list[np.ndarray | None] = [None, None]

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        last = int(values[-1]) if n else 0
        width = max(0, ((last + 1) // max(n, 1)).bit_length() - 1)
        top = (values >> np.uint64(width)).astype(np.int64)
        bits = n + (last >> width) + 2
        at = top + np.arange(n)
        high = np.zeros((bits >> 6) + 1, np.uint64)
        np.bitwise_or.at(high, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        zeros = np.arange(len(ones)) * 64 - ones
        return cls(n, width, _pack_bits(values & np.uint64((1 << width) - 1), width), high, ones.astype(np.uint32), zeros.astype(np.uint32))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.width)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        out = self.low[word] >> off
        up = (np.uint64(64) - off) & np.uint64(63)
        out |= np.where(off > 0, self.low[word + 1] << up, np.uint64(0))
        return out & self.mask

    @staticmethod
    def _in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The place of the k-th set bit: its byte by the bytes' running counts, then by a table."""
        u = np.uint64
        counts = word - ((word >> u(1)) & u(0x5555555555555555))
        counts = (counts & u(0x3333333333333333)) + ((counts >> u(2)) & u(0x3333333333333333))
        counts = ((counts + (counts >> u(4))) & u(0x0F0F0F0F0F0F0F0F)) * u(0x0101010101010101)
        k = k.astype(np.uint64)
        byte = np.bitwise_count(((k * u(0x0101010101010101) | u(0x8080808080808080)) - counts) & u(0x8080808080808080)).astype(np.uint64) << u(3)
        before = ((counts << u(8)) >> byte) & u(255)
        return byte.astype(np.int64) + _IN_BYTE[(((word >> byte) & u(255)) << u(3)) + k - before]

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        directory = self.ones if ones else self.zeros
        if (hints := self.hints[ones]) is None:  # the word of every 32nd bit, worked out at first use
            marks = np.arange(0, int(directory[-1]) + 1, 32, dtype=np.uint32)
            hints = self.hints[ones] = np.minimum(np.searchsorted(directory, marks, side="right") - 1, len(directory) - 2)
        word = hints[k >> 5]
        near = k.astype(np.uint32)
        for _ in range(2):
            word = word + (directory[word + 1] <= near)
        far = np.flatnonzero(directory[word + 1] <= near)
        if len(far):
            word[far] = np.searchsorted(directory, near[far], side="right") - 1
        bits = self.high[word] if ones else ~self.high[word]
        return word * 64 + self._in_word(bits, k - directory[word].astype(np.int64))

    def _following(self, at: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
        """The k-th set or unset bit, which is the next one after the place at: mostly in the same word."""
        word, off = at >> 6, (at & 63).astype(np.uint64)
        bits = self.high[word] if ones else ~self.high[word]
        bits = bits & (np.uint64(0xFFFFFFFFFFFFFFFE) << off)
        out = (word << 6) + np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1))
        far = np.flatnonzero(bits == 0)
        if len(far):
            out[far] = self._select(k[far], ones)
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places."""
        return ((self._select(i, True) - i).astype(np.uint64) << np.uint64(self.width)) | self._low(i)

    def get_both(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at places and at those after them."""
        at = self._select(i, True)
        after = self._following(at, i + 1, True)
        width = np.uint64(self.width)
        return ((at - i).astype(np.uint64) << width) | self._low(i), ((after - i - 1).astype(np.uint64) << width) | self._low(i + 1)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The first place whose number is x or more; n if there is none."""
        return self.find(x)[0]

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place whose number is x or more, and whether it is x."""
        top = x >> np.uint64(self.width)
        out, hit = np.full(len(x), self.n, np.int64), np.zeros(len(x), bool)
        inside = np.flatnonzero(top < np.uint64(self.zeros[-1])) if self.n else np.zeros(0, np.int64)
        if not len(inside):
            return out, hit
        top, rest = top[inside].astype(np.int64), x[inside] & self.mask
        before, after = np.full(len(top), -1, np.int64), np.empty(len(top), np.int64)
        later = top > 0
        before[later] = self._select(top[later] - 1, False)
        after[later] = self._following(before[later], top[later], False)
        after[~later] = self._select(top[~later], False)
        begin = before + 1 - top
        end = np.minimum(after - top, self.n)
        begin = np.minimum(begin, end)
        live = np.flatnonzero(begin < end)
        a, b, x = begin[live], end[live], rest[live]
        while len(live):
            middle = (a + b) >> 1
            low = self._low(middle)
            less = low < x
            hit[inside[live[low == x]]] = True
            a, b = np.where(less, middle + 1, a), np.where(less, b, middle)
            begin[live] = a
            going = np.flatnonzero(a < b)
            live, a, b, x = live[going], a[going], b[going], x[going]
        out[inside] = begin
        return out, hit

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.size": np.array([self.n, self.width], np.int64), f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.ones": self.ones, f"{name}.zeros": self.zeros}

    @classmethod
    def over(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, width = arrays[f"{name}.size"].tolist()
        return cls(n, width, *(arrays[f"{name}.{x}"] for x in ("low", "high", "ones", "zeros")))


def _to_file(uri: str, arrays: dict[str, np.ndarray]) -> None:
    head = json.dumps([[k, v.dtype.str, len(v)] for k, v in arrays.items()]).encode()
    head += b" " * (-(len(head) + 8) % 8)
    _shared.write_shared(uri, struct.pack("<q", len(head)) + head + b"".join(x + b"\0" * (-len(x) % 8) for x in (v.tobytes() for v in arrays.values())))


def _from_file(uri: str) -> dict[str, np.ndarray]:
    block = _shared.map_shared(uri)
    (size,) = struct.unpack("<q", block[:8])
    out, at = {}, 8 + size
    for name, kind, n in json.loads(bytes(block[8 : 8 + size])):
        out[name] = np.frombuffer(block, kind, n, at)
        at += out[name].nbytes + -out[name].nbytes % 8
    return out


def quantise(values: np.ndarray, levels: int = 255) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a byte and what they stand for: the means of equally many values, but zero for code 0."""
    book = np.zeros(levels + 1)
    if not len(values):
        return np.zeros(0, np.uint8), book
    kinds = np.unique(values)
    edges = kinds if len(kinds) <= levels else np.unique(np.sort(values)[(np.arange(1, levels + 1) * len(values)) // levels - 1])
    codes = np.minimum(np.searchsorted(edges, values, side="left"), len(edges) - 1) + 1
    total = np.bincount(codes, weights=values, minlength=levels + 1)
    count = np.bincount(codes, minlength=levels + 1)
    book[count > 0] = total[count > 0] / count[count > 0]
    return codes.astype(np.uint8), book


# -- counting ---------------------------------------------------------------------------------------


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first)


def _blob(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and counts, by byte planes of the differences."""
    import zstandard

    steps = np.diff(keys, prepend=np.zeros(1, keys.dtype)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes() + np.minimum(counts, 2**32 - 1).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return struct.pack("<q", len(keys)) + zstandard.ZstdCompressor(level=1).compress(planes)


def _unblob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    (n,) = struct.unpack("<q", blob[:8])
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8:]), np.uint8)
    steps = np.ascontiguousarray(planes[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    counts = np.ascontiguousarray(planes[8 * n :].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


class _Tally:
    """Counts of (shard, key), handed on as blobs of a shard."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, shards: np.ndarray, keys: np.ndarray):
        order = np.argsort(shards.astype(np.uint16), kind="stable")
        shards, keys = shards[order], keys[order]
        cuts = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])) if len(shards) else np.zeros(0, np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], len(shards))):
            k, n = _summed(keys[a:b])
            self.held.append((int(shards[a]), k, n))
            self.size += len(k)

    def flush(self):
        by: dict[int, list] = {}
        for shard, k, n in self.held:
            by.setdefault(shard, []).append((k, n))
        out: dict[str, list] = {"shard": [], "blob": []}
        for shard, parts in sorted(by.items()):
            out["shard"].append(shard)
            out["blob"].append(_blob(*_summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))))
        self.held, self.size = [], 0
        return pa.RecordBatch.from_pydict({"shard": pa.array(out["shard"], pa.int32()), "blob": pa.array(out["blob"], pa.binary())})


def _counted(numbers: DataFrame, keys):
    """Blobs of the counts of what ``keys()(numbers, n)`` finds: arrays of shards and of keys."""

    def run(batches):
        find, tally = keys(), _Tally()
        for chunk in _shared.chunks(batches, "numbers", NUMBER_BYTES):
            tally.add(*find(*_read_numbers(chunk)))
            if tally.size > COUNTED:
                yield tally.flush()
        yield tally.flush()

    _shared.bounded_arrow(numbers.sparkSession)
    return numbers.select("numbers").mapInArrow(run, "shard int, blob binary")


def _read_numbers(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The words' numbers of all texts, -1 for unknown ones, and the tokens of each."""
    parts = [np.frombuffer(x, "<i8" if wide else "<i4") for x, wide in ((bytes(x[1:]), x[0]) for x in chunk.column("numbers").to_pylist())]
    return np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64), np.array([len(x) for x in parts], np.int64)


def _merged(group) -> tuple[np.ndarray, np.ndarray]:
    parts = [_unblob(x) for x in group.column("blob").to_pylist()]
    return _summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))


# -- the trie ---------------------------------------------------------------------------------------


@dataclass
class Trie:
    """Where the levels are, and what is known of the whole: shards, where each one's word numbers begin, tokens."""

    folder: str
    shards: int
    bases: np.ndarray | None = None
    tokens: int = 0

    def __post_init__(self):
        self.written = np.zeros((4, self.shards), bool)
        self.open: dict[tuple[int, int], dict] = {}
        self.opened = 0

    def __getstate__(self):
        return (self.folder, self.shards, self.bases, self.tokens, self.written)

    def __setstate__(self, state):
        self.folder, self.shards, self.bases, self.tokens, self.written = state
        self.close()

    def close(self) -> None:
        self.open, self.opened = {}, 0

    @property
    def words(self) -> int:
        return int(self.bases[-1])

    def uri(self, level: int, shard: int) -> str:
        return f"{self.folder}/{level}/{shard}"

    def level(self, level: int, shard: int) -> dict:
        """A shard's arrays, mapped at first use; none if nothing was written for it. A file that is missing is an error."""
        if (found := self.open.get((level, shard))) is None:
            arrays = _from_file(self.uri(level, shard)) if self.written[level, shard] else {}
            found = dict(arrays)
            for name in {k.partition(".")[0] for k in arrays if k.endswith(".size")}:
                found[name] = EliasFano.over(arrays, name)
            if self.opened > OPEN_BYTES or len(self.open) > OPEN_FILES:
                self.close()
            self.open[level, shard] = found
            self.opened += sum(x.nbytes for x in arrays.values())
        return found

    def end(self) -> int:
        """The number of the end of a text."""
        return int(self.find_words([END])[0][0])

    def shard_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bases, numbers, side="right") - 1

    def _by_shard(self, shards: np.ndarray):
        order = np.argsort(shards.astype(np.uint16), kind="stable")  # so short that it is a radix sort
        cuts = np.concatenate([[0], np.cumsum(np.bincount(shards, minlength=self.shards))])
        for s in np.flatnonzero(np.diff(cuts)):
            yield int(s), order[cuts[s] : cuts[s + 1]]

    def find_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words' numbers, -1 for unknown ones, and their counts."""
        return self.find_hashes(word_hashes(words))

    def find_hashes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        numbers, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for s, rows in self._by_shard(hash_shard(hashes, self.shards)):
            level = self.level(1, s)
            if not level or not level["words"].n:
                continue
            at, hit = level["words"].find(hashes[rows])
            numbers[rows[hit]] = self.bases[s] + at[hit]
            counts[rows[hit]] = level["count"][at[hit]]
        return numbers, counts

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), np.int64)
        for s, rows in self._by_shard(self.shard_of(numbers)):
            out[rows] = self.level(1, s)["count"][numbers[rows] - self.bases[s]]
        return out

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.tokens + self.words + 1.0))

    def child(self, level: int, shard: int, nodes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of nodes of the level above in a shard: the child with the value (-1: none), its place among them, and how many there are."""
        found = self.level(level, shard)
        place, at, many = np.full(len(nodes), -1, np.int64), np.full(len(nodes), -1, np.int64), np.zeros(len(nodes), np.int64)
        if not found or not found["next"].n:
            return at, place, many
        # neighbours often ask of one node: its run is found once
        first = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]])) if len(nodes) else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(nodes))))
        begin, end = (x.astype(np.int64) for x in found["pointers"].get_both(nodes[first]))
        start = np.zeros(len(first), np.uint64)
        later = np.flatnonzero((begin > 0) & (end > begin))
        start[later] = found["next"].get(begin[later] - 1) + np.uint64(1)
        begin, end, start = begin[of], end[of], start[of]
        many = end - begin
        rows = np.flatnonzero(many)
        x = start[rows] + values[rows].astype(np.uint64)
        to, hit = found["next"].find(x)
        hit &= to < end[rows]
        at[rows[hit]] = to[hit]
        place[rows[hit]] = to[hit] - begin[rows[hit]]
        return at, place, many

    def bigrams(self, first: np.ndarray, second: np.ndarray, values: bool = True):
        """Of known first words: shard, node (-1: none), place, log10 probability of the second (nan if no node) and back-off of the first."""
        shard = self.shard_of(first)
        node, place, value, away = np.full(len(first), -1, np.int64), np.full(len(first), -1, np.int64), np.full(len(first), np.nan), np.zeros(len(first))
        for s, rows in self._by_shard(shard):
            own = first[rows] - self.bases[s]
            known = second[rows] >= 0
            node[rows[known]], place[rows[known]], _ = self.child(2, s, own[known], second[rows[known]])
            if values and (found := self.level(2, s)):
                away[rows] = found["away.book"][found["away"][own]]
                hit = rows[node[rows] >= 0]
                value[hit] = found["value.book"][found["value"][node[hit]]]
        return shard, node, place, value, away

    def trigrams(self, shard: np.ndarray, node: np.ndarray, place: np.ndarray):
        """Of nodes of two words and the place of a third (-1: none): its log10 probability (nan if there is no node), and the nodes' back-off."""
        value, away = np.full(len(node), np.nan), np.zeros(len(node))
        for s, rows in self._by_shard(shard):
            found = self.level(3, s)
            if not found:
                continue
            away[rows] = found["away.book"][found["away"][node[rows]]]
            rows = rows[place[rows] >= 0]
            at, _, _ = self.child(3, s, node[rows], place[rows])
            hit = at >= 0
            value[rows[hit]] = found["value.book"][found["value"][at[hit]]]
        return value, away


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words, repeat(_SEED)), np.uint64, len(words))


def hash_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of hashes, so that a shard's words are in the order of their numbers."""
    return ((hashes >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)).astype(np.int64)


def read_words(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of the distinct words of texts, the end last; all tokens as places among them; each text's tokens."""
    column = texts.combine_chunks().cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    solid = _SOLID[data]
    edge = np.ones(len(data) + 1, bool)  # where a place differs from the one before; texts end words too
    edge[1:-1] = solid[1:] != solid[:-1]
    edge[offsets - offsets[0]] = True
    edge = np.flatnonzero(edge)
    begin, length = edge[:-1], np.diff(edge)
    words = solid[begin] if len(begin) else np.zeros(0, bool)
    begin, length = begin[words], length[words]
    tokens = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(length)]).astype(np.int64)), pa.py_buffer(_LOWER[data[solid]])]).dictionary_encode()
    hashes = word_hashes([*tokens.dictionary.to_pylist(), END])
    n = np.diff(np.searchsorted(begin, offsets - offsets[0]))
    local = np.full(len(begin) + len(n), len(hashes) - 1, np.int64)
    inner = np.ones(len(local), bool)
    inner[np.cumsum(n + 1) - 1] = False
    local[inner] = np.asarray(tokens.indices)
    return hashes, local, n + 1


def _before(values: np.ndarray, n: np.ndarray, end: int) -> np.ndarray:
    """Each token's predecessor; a text's first token follows an end."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[(np.cumsum(n) - n)[n > 0]] = end
    return out


def _pairs(first: np.ndarray, second: np.ndarray, words: int):
    """Distinct pairs, and which of them each pair is."""
    if words * words < 2**62:
        keys, which = np.unique(first * (words + 1) + second + 1, return_inverse=True)
        return keys // (words + 1), keys % (words + 1) - 1, which
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
    which = np.empty(len(a), np.int64)
    which[order] = np.cumsum(new) - 1
    return a[new], b[new], which


def _write_level(trie: Trie, level: int, shard: int, parents: np.ndarray, values: np.ndarray, nodes: int, more: dict) -> None:
    """Children by parent and value, in order, as pointers and one increasing sequence."""
    many = np.bincount(parents, minlength=nodes) if len(parents) else np.zeros(nodes, np.int64)
    pointers = np.concatenate([[0], np.cumsum(many)])
    last = pointers[1:][many > 0] - 1
    widths = values[last].astype(np.uint64) + np.uint64(1)
    base = np.repeat(np.concatenate([np.zeros(1, np.uint64), np.cumsum(widths)])[:-1] if len(widths) else widths, many[many > 0])
    _to_file(trie.uri(level, shard), EliasFano.encode(pointers).arrays("pointers") | EliasFano.encode(base + values.astype(np.uint64)).arrays("next") | more)


def _smoothed(parents: np.ndarray, counts: np.ndarray, of: np.ndarray, lower: np.ndarray, nodes: int, discount: float) -> dict:
    """Quantised log10 probabilities of children, and of what their parents leave to the lower order; of: the parents' counts."""
    share = np.maximum(counts - discount, 0) / of[parents]
    left = np.maximum(1 - np.bincount(parents, weights=share, minlength=nodes), 1e-6) if len(parents) else np.ones(nodes)
    value, value_book = quantise(np.log10(share + left[parents] * 10.0**lower))
    has = np.bincount(parents, minlength=nodes) > 0 if len(parents) else np.zeros(nodes, bool)
    away = np.zeros(nodes, np.uint8)
    away[has], away_book = quantise(np.log10(left[has]))
    return {"value": value, "value.book": value_book, "away": away, "away.book": away_book}


def first_level(docs: DataFrame, shards: int | None = None) -> Trie:
    """The trie's words, counted over all texts."""
    spark = docs.sparkSession
    docs = docs.select(_shared.text_of())
    if shards is None:
        splits = max(1, docs.rdd.getNumPartitions())
        shards = max(LEAST_SHARDS, min(MOST_SHARDS, 1 << (splits - 1).bit_length()))
    trie = Trie(_shared.shared_folder(spark, "trie"), shards)

    def unigrams(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def hand_on():
            hashes, counts = _summed(np.concatenate([h for h, _ in held]), np.concatenate([n for _, n in held]))
            cuts = np.searchsorted(hash_shard(hashes, shards), np.arange(shards + 1))
            own = np.flatnonzero(np.diff(cuts))
            return pa.RecordBatch.from_pydict({"shard": pa.array(own, pa.int32()), "blob": pa.array([_blob(hashes[cuts[s] : cuts[s + 1]], counts[cuts[s] : cuts[s + 1]]) for s in own], pa.binary())})

        for chunk in _shared.chunks(batches, chars=CHUNK_CHARS):
            hashes, local, _ = read_words(chunk.column("text"))
            held.append((hashes, np.bincount(local, minlength=len(hashes))))
            size += len(hashes)
            if size > COUNTED:
                yield hand_on()
                held, size = [], 0
        if held:
            yield hand_on()

    def build(key, group):
        shard = key[0].as_py()
        hashes, counts = _merged(group)
        _to_file(trie.uri(1, shard), EliasFano.encode(hashes).arrays("words") | {"count": counts})
        return pa.table({"shard": [shard], "n": [len(hashes)], "total": [int(counts.sum())]}, schema=pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("total", pa.int64())]))

    _shared.bounded_arrow(spark)
    sizes = np.zeros(shards, np.int64)
    for r in docs.mapInArrow(unigrams, "shard int, blob binary").groupBy("shard").applyInArrow(build, "shard int, n long, total long").collect():
        sizes[r.shard] = r.n
        trie.written[1, r.shard] = True
        trie.tokens += r.total
    trie.bases = np.concatenate([[0], np.cumsum(sizes)])
    return trie


def number_documents(docs: DataFrame, trie: Trie, seen: int = SEEN) -> tuple[DataFrame, DataFrame]:
    """The texts as numbers of words, with what unigrams say of them; and blobs of the pairs in texts that aren't held out.

    Both come of one pass over the texts and are written once; later passes read numbers only.
    """
    words = trie.words
    kind = "<i4" if words < 2**31 else "<i8"
    head = bytes([kind == "<i8"])
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, numbers binary, shard int, blob binary"

    def run(batches):
        tally = _Tally()
        columns = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("numbers", pa.binary()), ("shard", pa.int32()), ("blob", pa.binary())]

        def row(n, **values):
            return pa.RecordBatch.from_arrays([pa.array(values[c], t) if c in values else pa.nulls(n, t) for c, t in columns], names=[c for c, _ in columns])

        def pairs():
            blobs = tally.flush()
            return row(len(blobs), shard=blobs.column(0), blob=blobs.column(1))

        for chunk in _shared.chunks(batches, chars=CHUNK_CHARS):
            if not chunk.num_rows:
                continue
            hashes, local, n = read_words(chunk.column("text"))
            number, count = trie.find_hashes(hashes)
            counts, numbers = count[local], number[local]
            starts = np.cumsum(n) - n
            held_out = np.array(chunk.column("held_out").to_pylist(), bool)
            raw = numbers.astype(kind)
            yield row(len(n), doc_id=chunk.column("doc_id").combine_chunks(), held_out=held_out, n_tokens=n, n_known=np.add.reduceat((counts > 0).astype(np.int64), starts), base_score=np.add.reduceat(trie.unigram(counts), starts), numbers=[head + raw[a : a + k].tobytes() for a, k in zip(starts, n)])
            often = counts >= seen
            first = _before(numbers, n, int(number[-1]))
            keep = often & _before(often, n, bool(count[-1] >= seen)) & ~np.repeat(held_out, n)
            first, second = first[keep], numbers[keep]
            where = trie.shard_of(first)
            tally.add(where, ((first - trie.bases[where]) * words + second).astype(np.uint64))
            if tally.size > COUNTED:
                yield pairs()
        yield pairs()

    _shared.bounded_arrow(docs.sparkSession)
    table = _shared.through_table(docs.select(F.col("doc_id").cast("long"), _held_out().alias("held_out"), _shared.text_of()).mapInArrow(run, schema), "numbers")
    return table.where(F.col("numbers").isNotNull()).drop("shard", "blob"), table.where(F.col("blob").isNotNull()).select("shard", "blob")


def further_levels(trie: Trie, numbers: DataFrame, pairs: DataFrame, discount: float = DISCOUNT, seen: int = SEEN) -> None:
    """Pairs and triples; an n-gram can be kept only if the shorter ones in it are."""
    words = trie.words

    def second_level(key, group):
        shard = key[0].as_py()
        keys, counts = _merged(group)
        keys, counts = keys[counts >= seen].astype(np.int64), counts[counts >= seen]
        parents, values = keys // words, keys % words
        of = trie.level(1, shard)["count"].astype(float)
        more = _smoothed(parents, counts, of, trie.unigram(trie.counts(values)), len(of), discount)
        _write_level(trie, 2, shard, parents, values, len(of), more | {"count": counts.astype(np.min_scalar_type(int(counts.max(initial=0))))})
        return pa.table({"shard": [shard], "n": [len(keys)]}, schema=pa.schema([("shard", pa.int32()), ("n", pa.int64())]))

    for r in pairs.groupBy("shard").applyInArrow(second_level, "shard int, n long").collect():
        trie.written[2, r.shard] = True
    end = trie.end()

    def three():
        def find(numbers, n):
            first, second, which = _pairs(_before(numbers, n, end), numbers, words)
            known = np.flatnonzero((first >= 0) & (second >= 0))
            shard, node, place = (np.full(len(first), -1, np.int64) for _ in range(3))
            shard[known], node[known], place[known], _, _ = trie.bigrams(first[known], second[known], values=False)
            shard, node, place = shard[which], node[which], place[which]
            inner = np.ones(len(numbers), bool)
            inner[(np.cumsum(n) - n)[n > 0]] = False
            at = np.flatnonzero(inner)
            at = at[(node[at - 1] >= 0) & (place[at] >= 0)]
            return shard[at - 1], (node[at - 1].astype(np.uint64) << np.uint64(32)) | place[at].astype(np.uint64)

        return find

    def third_level(key, group):
        shard = key[0].as_py()
        keys, counts = _merged(group)
        keys, counts = keys[counts >= seen], counts[counts >= seen]
        parents, places = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        above = trie.level(2, shard)
        own, which = np.unique(parents, return_inverse=True)
        middle = _values(above, own)[which]
        lower = np.zeros(len(keys))
        for s, at in trie._by_shard(trie.shard_of(middle)):
            other = trie.level(2, s)
            lower[at] = other["value.book"][other["value"][other["pointers"].get(middle[at] - trie.bases[s]).astype(np.int64) + places[at]]]
        more = _smoothed(parents, counts, above["count"].astype(float), lower, above["next"].n, discount)
        _write_level(trie, 3, shard, parents, places, above["next"].n, more)
        return pa.table({"shard": [shard], "n": [len(keys)]}, schema=pa.schema([("shard", pa.int32()), ("n", pa.int64())]))

    for r in _counted(numbers, three).groupBy("shard").applyInArrow(third_level, "shard int, n long").collect():
        trie.written[3, r.shard] = True
    trie.close()


def _values(level: dict, nodes: np.ndarray) -> np.ndarray:
    """The second words' numbers of nodes: what they add to their run's beginning."""
    if not len(nodes):
        return nodes
    parent = level["pointers"].successor((nodes + 1).astype(np.uint64)) - 1
    begin = level["pointers"].get(parent).astype(np.int64)
    start = np.zeros(len(nodes), np.uint64)
    later = begin > 0
    start[later] = level["next"].get(begin[later] - 1) + np.uint64(1)
    return (level["next"].get(nodes) - start).astype(np.int64)


def score_numbers(trie: Trie, end: int, numbers: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The log10 probability of each text by the whole trie."""
    if not len(n):
        return np.zeros(0)
    first, second, which = _pairs(_before(numbers, n, end), numbers, trie.words)
    counts = np.zeros(len(second), np.int64)
    known = np.flatnonzero(second >= 0)
    counts[known] = trie.counts(second[known])
    known = np.flatnonzero(first >= 0)
    shard, node, place, two, away = (np.full(len(first), x) for x in (-1, -1, -1, np.nan, 0.0))
    shard[known], node[known], place[known], two[known], away[known] = trie.bigrams(first[known], second[known])
    value = np.where(np.isnan(two), away + trie.unigram(counts), two)[which]
    inner = np.ones(len(numbers), bool)
    inner[np.cumsum(n) - n] = False
    at = np.flatnonzero(inner)
    before = which[at - 1].astype(np.int32 if len(first) < 1 << 31 else np.int64)
    there = node[before] >= 0
    at, before = at[there], before[there]
    order = np.argsort(before)  # by context, so that neighbours read the same places
    at, before = at[order], before[order]
    three, away = trie.trigrams(shard[before], node[before], place[which[at]])
    value[at] = np.where(np.isnan(three), away + value[at], three)
    return np.add.reduceat(value, np.cumsum(n) - n)


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % HELD_OUT == HELD_OUT_REST, F.lit(False))


def score_documents(docs: DataFrame, trie: Trie | None = None, shards: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Without a trie one is trained on the rows that aren't held out. A null or empty
    text is its end alone; a null doc_id is not held out. Repeated rows are learned
    from and scored as often as they come; with nothing to learn from, every token
    is unknown. An empty table gives an empty result; other columns are left aside.
    Words are told apart by 64-bit hashes.
    """
    if trie is None:
        trie = first_level(docs.where(~_held_out()), shards)
        numbers, pairs = number_documents(docs, trie)
        further_levels(trie, numbers.where(~F.col("held_out")), pairs)
    else:
        numbers, _ = number_documents(docs, trie)
    end = trie.end()

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        for chunk in _shared.chunks(batches, "numbers", NUMBER_BYTES):
            if chunk.num_rows:
                scores = pa.array(score_numbers(trie, end, *_read_numbers(chunk)))
                kept = chunk.drop_columns(["numbers"]).append_column("score", scores)
                yield pa.RecordBatch.from_arrays([x.combine_chunks() for x in kept.select(schema.names).columns], schema=schema)

    _shared.bounded_arrow(docs.sparkSession)
    scored = numbers.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(trie.tokens).cast("long").alias("train_tokens"), "base_score", "score")
