"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

Frequent words of the corpus are compiled, with the ids that the vocabulary's
merges give them, into a minimal acyclic automaton: states with the same right
language are one, and every arc carries a number. The numbers on a word's path
add up to its rank, which selects its ids. The automaton is a few arrays in one
file of the shared folder, memory-mapped by every task. Words that it lacks are
merged exactly, many at a time.

Results are those of the ``tokenizers`` library; chunks with characters whose
normalisation is more than lower-casing go to that library itself.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import struct
from collections import Counter, defaultdict
from heapq import heapify, heappop, heappush
from itertools import count, islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

#: A word is frequent if one split of the input holds it so often.
FREQUENT = 24
#: Words of the lexicon: the most frequent ones of the whole corpus.
LEXICON_WORDS = 1 << 16
#: Whitespace-separated chunks, and characters of them, that a task remembers before it forgets all but the most used quarter.
REMEMBERED, REMEMBERED_CHARS = 400_000, 32 << 20
#: Words of more bytes are merged one by one, by a heap of their pairs.
LONG_WORD = 256

_SPECIAL = ("<|startoftext|>", "<|endoftext|>")
_SPECIAL_RE = regex.compile("(" + "|".join(map(regex.escape, _SPECIAL)) + ")")
#: The vocabulary's own split, with the separator of joined chunks.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")
#: Characters for which normalisation is lower-casing alone.
_PLAIN = regex.compile(r"[\x21-\x7E¡-¬®-ÿ–—‘’“”…€]*")
_PLAIN_LINES = regex.compile(r"[\n\x21-\x7E¡-¬®-ÿ–—‘’“”…€]*")
#: As _PIECES, for lower-cased characters of _PLAIN_LINES alone.
_PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\na-zªµºß-öø-ÿ0-9²³¹¼-¾]+|\n")
#: Not white space for the vocabulary, but for str.split().
_ODD_SPACE = regex.compile("[\x1c-\x1f]")


class KeyTable:
    """Open addressing from 64-bit keys to positions, looked up by whole arrays."""

    def __init__(self, slots: np.ndarray, values: np.ndarray):
        self.slots, self.values, self.mask = slots, values, np.uint64(len(slots) - 1)
        self.shift = np.uint64(64 - (len(slots) - 1).bit_length())

    @classmethod
    def build(cls, keys: np.ndarray, values: np.ndarray) -> KeyTable:
        size = 1 << max(4, (4 * len(keys)).bit_length())
        out = cls(np.full(size, -1, np.int64), np.zeros(size, np.int64))
        at, left = out._home(keys), np.arange(len(keys))
        while len(left):
            free = out.slots[at[left]] == -1
            first = left[free]
            _, one = np.unique(at[first], return_index=True)
            put = first[one]
            out.slots[at[put]], out.values[at[put]] = keys[put], values[put]
            left = left[out.slots[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (size - 1)
        return out

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for keys that are missing."""
        at = self._home(keys)
        found = self.slots[at]
        out = np.where(found == keys, self.values[at], -1)
        left = np.flatnonzero((found != keys) & (found != -1))
        while len(left):
            at[left] = (at[left] + 1) & np.int64(self.mask)
            found = self.slots[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found != -1)]
        return out


def _matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words, a row each, and their lengths."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    out = np.zeros((len(words), int(n.max(initial=0))), np.uint8)
    out[np.arange(out.shape[1]) < n[:, None]] = flat
    return out, n


def _in_order(flat: np.ndarray, n: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs that follow one another, and their lengths, put in the order of their places."""
    order = np.empty(len(places), np.int64)
    order[places] = np.arange(len(places))
    take, n = _shared.ragged(np.cumsum(n) - n, n, order)
    return flat[take], n


class Merges:
    """The vocabulary's merges, applied to many words at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.base = 1 << 17
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in plain}
        for b in range(256):
            shown.setdefault(b, chr(256 + b - sum(x < b for x in plain)))
        self.first = np.array([vocab[shown[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[shown[b] + "</w>"] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.pairs = KeyTable.build(keys, np.arange(len(keys), dtype=np.int64) * self.base + made)
        self.tokens = {i: t for t, i in vocab.items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}

    def apply(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word: the leftmost pair of lowest rank is merged, again and again."""
        flat, n = self.apply_flat(words)
        return np.split(flat, np.cumsum(n)[:-1]) if len(words) else []

    def apply_flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As apply, but all ids in one array, and each word's number of ids."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        sizes = sizes[order]
        short, start = int(np.searchsorted(sizes, LONG_WORD, "right")), 0
        parts, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while start < short:  # words of about a length, so that rows are well filled
            longest = max(8, int(sizes[start]) * 5 // 4)
            end = min(start + max(1, (1 << 21) // longest), int(np.searchsorted(sizes[:short], longest, "right")))
            flat, n = self._merge([words[i] for i in order[start:end].tolist()])
            parts.append(flat)
            counts.append(n)
            start = end
        for i in order[short:].tolist():
            parts.append(self._merge_long(words[i]))
            counts.append(np.array([len(parts[-1])], np.int64))
        return _in_order(np.concatenate(parts), np.concatenate(counts), order)

    def _merge_long(self, word: bytes) -> np.ndarray:
        """As _merge, of one word in time that grows little faster than its length: a heap of pairs over linked places."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        ids[-1] = int(self.last[word[-1]])
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        ranks = self.pairs.get(np.array(ids[:-1], np.int64) * self.base + np.array(ids[1:], np.int64)).tolist()
        heap = [(value, i) for i, value in enumerate(ranks) if value >= 0]
        heapify(heap)
        known: dict[int, int] = {}

        def push(i: int, j: int) -> None:
            key = ids[i] * self.base + ids[j]
            if (value := known.get(key)) is None:
                value = known[key] = int(self.pairs.get(np.array([key], np.int64))[0])
            current[i] = value
            if value >= 0:
                heappush(heap, (value, i))

        current = [*ranks, -1]  # the value of the pair that begins at a place; -1 for none
        while heap:
            value, i = heappop(heap)
            if current[i] != value:
                continue
            j = after[i]
            ids[i], after[i], current[j] = value % self.base, after[j], -1
            current[i] = -1
            if after[j] >= 0:
                before[after[j]] = i
                push(i, after[j])
            if before[i] >= 0:
                push(before[i], i)
            ids[j] = -1
        return np.array([x for x in ids if x >= 0], np.int64)

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text, n = _matrix(words)
        at, rows = np.arange(text.shape[1]), np.arange(len(words))
        ids = np.where(at < n[:, None], self.first[text], -1)
        ids[rows[n > 0], n[n > 0] - 1] = self.last[text[rows[n > 0], n[n > 0] - 1]]
        none = np.int64(1) << 60
        parts, counts, places = [], [], []

        def ranks(left, right):
            got = self.pairs.get(np.where((left >= 0) & (right >= 0), left * self.base + right, -2))
            return np.where(got < 0, none, got)

        rank = ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), -1)
        while len(rows):
            best = rank.argmin(1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            value = rank[np.arange(len(rows)), best] if rank.shape[1] else np.full(len(rows), none)
            over = value == none
            if over.any():
                parts.append(ids[over][at < n[over, None]])
                counts.append(n[over])
                places.append(rows[over])
                keep = ~over
                rows, ids, n, rank, best, value = rows[keep], ids[keep], n[keep], rank[keep], best[keep], value[keep]
                if not len(rows):
                    break
            r = np.arange(len(rows))
            ids[r, best] = value % self.base
            move = at[None, : ids.shape[1] - 1] > best[:, None]
            ids[:, :-1] = np.where(move, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = np.where(best < ids.shape[1] - 1, -1, ids[:, -1])
            n = n - 1
            move = at[None, : rank.shape[1] - 1] >= best[:, None]
            rank[:, :-1] = np.where(move, rank[:, 1:], rank[:, :-1])
            rank[:, -1] = none
            rank[r, best] = ranks(ids[r, best], np.where(best + 1 < n, ids[r, np.minimum(best + 1, ids.shape[1] - 1)], -1))
            left = best > 0
            if left.any():
                x, b = r[left], best[left]
                rank[x, b - 1] = ranks(ids[x, b - 1], ids[x, b])
            if len(rows) and (width := int(n.max())) < ids.shape[1] * 3 // 4:
                ids, rank = ids[:, : max(width, 1)].copy(), rank[:, : max(width - 1, 0)].copy()
                at = np.arange(ids.shape[1])
        return _in_order(np.concatenate(parts), np.concatenate(counts), np.concatenate(places))


def compile_lexicon(words: list[bytes], ids: list[np.ndarray]) -> bytes:
    """The minimal acyclic automaton of the words, as one block of bytes.

    Words are added in order; once a suffix can no longer change, its states are
    replaced by equal ones from a register, so that suffixes are shared.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    register: dict[tuple, int] = {}
    arcs: list[tuple[int, int, int, int]] = []  # state, byte, target, number
    finals: list[int] = []
    sizes: list[int] = []

    def freeze(state: dict) -> int:
        """The number of an equal state, which it becomes if there is none."""
        key = (state[-1], tuple(sorted((b, t) for b, t in state.items() if b >= 0)))
        if (same := register.get(key)) is not None:
            return same
        register[key] = own = len(finals)
        finals.append(state[-1])
        before = state[-1]
        for b, t in key[1]:
            arcs.append((own, b, t, before))
            before += sizes[t]
        sizes.append(before)
        return own

    path: list[dict] = [{-1: 0}]
    last = b""
    for i in order:
        word = words[i]
        common = next((k for k, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        while len(path) > common + 1:
            state = path.pop()
            path[-1][last[len(path) - 1]] = freeze(state)
        for b in word[common:]:
            path.append({-1: 0})
            path[-2][b] = -1
        path[-1][-1] = 1
        last = word
    while len(path) > 1:
        state = path.pop()
        path[-1][last[len(path) - 1]] = freeze(state)
    root = freeze(path[0])
    flat = [ids[i] for i in order]
    found = np.array(arcs, np.int64).reshape(-1, 4)
    table = KeyTable.build(found[:, 0] << 8 | found[:, 1], found[:, 2] << 32 | found[:, 3])
    n = np.array([len(x) for x in flat], np.int64)
    parts = [table.slots, table.values, np.array(finals, np.int64), np.concatenate([[0], np.cumsum(n)]).astype(np.int64), np.concatenate([*flat, []]).astype(np.int32)]
    out = io.BytesIO()
    out.write(struct.pack("<6q", root, *map(len, parts)))
    for x in parts:
        out.write(x.tobytes())
    return out.getvalue()


class Lexicon:
    """A compiled lexicon over bytes that need not be copied."""

    def __init__(self, block):
        self.root, *sizes = struct.unpack("<6q", block[:48])
        at, parts = 48, []
        for n, kind in zip(sizes, (np.int64, np.int64, np.int64, np.int64, np.int32), strict=True):
            parts.append(np.frombuffer(block, kind, n, at))
            at += parts[-1].nbytes
        self.table, (self.finals, self.offsets, self.ids) = KeyTable(*parts[:2]), parts[2:]

    def rank(self, words: list[bytes]) -> np.ndarray:
        """Each word's rank in the lexicon, -1 if it isn't there."""
        out = np.full(len(words), -1, np.int64)
        if not len(words) or not len(self.finals):
            return out
        longest = 64
        rows = np.array([i for i, w in enumerate(words) if 0 < len(w) <= longest], np.int64)
        if not len(rows):
            return out
        text, n = _matrix([words[i] for i in rows])
        state, number, live = np.full(len(rows), self.root, np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows))
        for k in range(text.shape[1]):
            ended = n[live] == k
            whole = live[ended][self.finals[state[ended]] == 1]
            out[rows[whole]] = number[whole]
            live, state = live[~ended], state[~ended]
            step = self.table.get(state << 8 | text[live, k])
            live, state, step = live[step >= 0], step[step >= 0] >> 32, step[step >= 0]
            number[live] += step & 0xFFFFFFFF
        whole = live[self.finals[state] == 1]
        out[rows[whole]] = number[whole]
        return out


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.data, self.n = np.zeros(1 << 16, kind), 0

    def append(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(max(len(self.data), len(more)), self.data.dtype)])
        self.data[self.n : self.n + len(more)] = more
        self.n += len(more)


class Encoder:
    """Encodes texts by chunks between white space, each of which is worked out once."""

    def __init__(self, path: str, lexicon: Lexicon | None = None, decoded: bool = False):
        from tokenizers import Tokenizer

        self.merges, self.lexicon, self.decoded = Merges(path), lexicon, decoded
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.shown = self.merges.tokens
        self._begin()

    def _begin(self) -> None:
        self.known: dict[str, int] = defaultdict(count().__next__)
        self.flat, self.offsets, self.lengths, self.uses = Growing(np.int32), Growing(np.int64), Growing(np.int64), Growing(np.int64)
        self.texts: list[bytes] = []
        self.used = self.chars = 0

    def _forget(self) -> None:
        """Keeps what was used most, and more than once: a quarter of what may be remembered, at most."""
        words, uses, texts = list(self.known), self.uses.data[: self.uses.n], self.texts
        order = np.argsort(-uses, kind="stable")[: REMEMBERED // 4]
        order = order[uses[order] > 1]
        sizes = np.fromiter((len(words[i]) for i in order.tolist()), np.int64, len(order))
        order = order[np.cumsum(sizes) <= REMEMBERED_CHARS // 4]
        ids, n = self.ids(order), self.lengths.data[order]
        self._begin()
        for i in order.tolist():
            self.known[words[i]]
        self.texts = [texts[i] for i in order.tolist()] if self.decoded else []
        self.flat.append(ids)
        self.offsets.append(np.cumsum(n) - n)
        self.lengths.append(n)
        self.uses.append(uses[order] // 2)
        self.used, self.chars = len(ids), int(sizes[: len(order)].sum())

    def _exact(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)

    def _split(self, text: str) -> list[str]:
        """Chunks of the text; a special token is a chunk, and so is a text whose white space is odd."""
        if _ODD_SPACE.search(text):
            return [text]
        if "<|" in text and _SPECIAL_RE.search(text):
            return [x for part in _SPECIAL_RE.split(text) for x in ([part] if part in _SPECIAL else part.split())]
        return text.split()

    def _pieces(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Of plain chunks: all ids, each chunk's number of ids, and, if asked for, each chunk's decoded text."""
        pieces = _PLAIN_PIECES.findall("\n".join(new).lower())
        at: dict[str, int] = defaultdict(count().__next__)
        at["\n"]
        where = np.fromiter(map(at.__getitem__, pieces), np.int64, len(pieces))
        words = list(at)[1:]
        n = np.zeros(len(words), np.int64)
        parts, offsets = [np.zeros(0, np.int32)], np.zeros(len(words), np.int64)
        own = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        own[own >= self.offsets.n] = -1  # not worked out yet
        rank, kept, left = np.full(len(words), -1, np.int64), np.flatnonzero(own >= 0), np.flatnonzero(own < 0)  # a piece that is a chunk too has that chunk's ids
        if len(kept):
            n[kept] = k = self.lengths.data[own[kept]]
            offsets[kept] = np.cumsum(k) - k
            parts.append(self.ids(own[kept]))
        if self.lexicon:
            rank[left] = self.lexicon.rank([words[i].encode() for i in left.tolist()])
        seen, unseen = np.flatnonzero(rank >= 0), left[rank[left] < 0]
        if len(seen):
            at_lexicon = self.lexicon.offsets
            n[seen] = at_lexicon[rank[seen] + 1] - at_lexicon[rank[seen]]
            offsets[seen] = sum(map(len, parts)) + at_lexicon[rank[seen]]
            parts.append(self.lexicon.ids)
        if len(unseen):
            merged, k = self.merges.apply_flat([words[i].encode() for i in unseen.tolist()])
            n[unseen] = k
            offsets[unseen] = sum(map(len, parts)) + np.cumsum(k) - k
            parts.append(merged)
        flat = np.concatenate(parts)
        n, offsets = np.concatenate([[0], n]), np.concatenate([[0], offsets])
        take, _ = _shared.ragged(offsets, n, where)
        ends = np.concatenate([np.flatnonzero(where == 0), [len(where)]])
        so_far = np.concatenate([[0], np.cumsum(n[where])])[ends]
        decoded: list[bytes] = []
        if self.decoded:
            shown = self.shown
            texts = ["", *(" ".join([shown[i] for i in flat[o : o + k].tolist()]) for o, k in zip(offsets[1:].tolist(), n[1:].tolist(), strict=True))]
            of, begin = [texts[i] for i in where.tolist()], 0
            for end in ends.tolist():
                decoded.append((of[begin] if end == begin + 1 else " ".join(of[begin:end])).encode())
                begin = end + 1
        return flat[take].astype(np.int32), np.diff(so_far, prepend=0), decoded

    def _resolve(self, new: list[str]) -> None:
        """Appends the ids of new chunks."""
        odd = np.zeros(len(new), bool)
        if not _PLAIN_LINES.fullmatch("\n".join(new)):
            odd[:] = [not _PLAIN.fullmatch(x) for x in new]
        odd |= np.fromiter((x in _SPECIAL for x in new), bool, len(new)) if any(x in self.known for x in _SPECIAL) else False
        plain, odds = np.flatnonzero(~odd), np.flatnonzero(odd)
        n = np.zeros(len(new), np.int64)
        texts: list[bytes] = [b""] * len(new) if self.decoded else []
        parts = []
        if len(plain):
            flat, n[plain], decoded = self._pieces(new if len(plain) == len(new) else [new[i] for i in plain])
            parts.append(flat)
            for i, x in zip(plain.tolist(), decoded):
                texts[i] = x
        for i in odds.tolist():
            parts.append(self._exact(new[i]))
            n[i] = len(parts[-1])
            if self.decoded:
                texts[i] = " ".join([self.shown[x] for x in parts[-1].tolist()]).encode()
        order = np.concatenate([plain, odds])
        offsets = np.zeros(len(new), np.int64)
        offsets[order] = self.used + np.cumsum(n[order]) - n[order]
        self.offsets.append(offsets)
        self.lengths.append(n)
        for x in parts:
            self.flat.append(x)
        self.texts += texts
        self.used += int(n.sum())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return [self.ids(x) for x in self.chunks(texts)]

    def ids(self, picks: np.ndarray) -> np.ndarray:
        """The ids of chunks, one after the other."""
        return self.flat.data[_shared.ragged(self.offsets.data, self.lengths.data, picks)[0]]

    def chunks(self, texts: list[str]) -> list[np.ndarray]:
        """The chunks of each text, as numbers of what this encoder knows."""
        if len(self.known) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self._forget()
        before, out = len(self.known), []
        for text in texts:
            chunks = self._split(text)
            out.append(np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks)))
        if new := list(islice(reversed(self.known), len(self.known) - before))[::-1]:
            self.chars += sum(map(len, new))
            self._resolve(new)
            self.uses.append(np.zeros(len(new), np.int64))
        if out:
            self.uses.data[: self.uses.n] += np.bincount(np.concatenate(out), minlength=self.uses.n)
        return out

    def decode(self, picks: np.ndarray) -> bytes:
        """The decoded text of chunks, in UTF-8."""
        texts = self.texts
        return b" ".join([x for x in [texts[i] for i in picks.tolist()] if x])


def frequent_words(docs: DataFrame, frequent: int = FREQUENT, most: int = LEXICON_WORDS) -> list[bytes]:
    """The frequent words of all texts, at most ``most`` of them; ties go to the smaller word."""

    def work():
        total: Counter = Counter()

        def count(batches):
            for chunk in _shared.chunks(batches):
                for text in chunk.column("text").to_pylist():
                    total.update(text.split())
                if len(total) > 4 * REMEMBERED:  # words that stay rare make room
                    for x in [x for x, n in total.items() if n < 2]:
                        del total[x]
            words: Counter = Counter()
            for x, n in total.items():
                if n >= frequent and _PLAIN.fullmatch(x):
                    for piece in _PIECES.findall(x.lower()):
                        words[piece] += n
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(words), pa.string()), "n": pa.array(list(words.values()), pa.int64())})

        return count

    _shared.bounded_arrow(docs.sparkSession)
    counted = docs.select(_shared.text_of()).mapInArrow(work(), "word string, n long")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return [r.word.encode() for r in top.select("word").collect()]


def build_lexicon(docs: DataFrame, path: str, **bounds) -> str:
    """Compiles the lexicon of the texts' frequent words into a shared file; returns its URI."""
    words = [w for w in frequent_words(docs, **bounds) if len(w) <= 64]
    uri = f"{_shared.shared_folder(docs.sparkSession, 'lexicon')}/automaton"
    _shared.write_shared(uri, compile_lexicon(words, Merges(path).apply(words)))
    return uri


def encode_documents(docs: DataFrame, path: str, **bounds) -> DataFrame:
    """Ids and decoded text of every document: doc_id, ids (array), decoded (string).

    A null text counts as empty and has no ids; other columns are left aside; each
    row is worked on for itself, so repeated rows give repeated results and an
    empty table an empty one.
    """
    lexicon = build_lexicon(docs, path, **bounds)

    def work():
        encoder = Encoder(path, Lexicon(_shared.map_shared(lexicon)), decoded=True)

        def step(chunk):
            picks = encoder.chunks(chunk.column("text").to_pylist())
            ids = [encoder.ids(x) for x in picks]
            return {"doc_id": chunk.column("doc_id"), "ids": ids, "decoded": [encoder.decode(x).decode() for x in picks]}

        return step

    return _shared.map_chunks(docs.select(F.col("doc_id").cast("long"), _shared.text_of()), work, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, path: str, **bounds) -> DataFrame:
    """As encode_documents, but digests of ids and decoded text in their place, made where the ids are."""
    lexicon = build_lexicon(docs, path, **bounds)

    def work():
        encoder = Encoder(path, Lexicon(_shared.map_shared(lexicon)), decoded=True)

        def step(chunk):
            picks = encoder.chunks(chunk.column("text").to_pylist())
            n, ids, decoded = [], [], []
            for x in picks:
                own = encoder.ids(x)
                n.append(len(own))
                ids.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(x)).hexdigest())
            return {"doc_id": chunk.column("doc_id"), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

        return step

    return _shared.map_chunks(docs.select(F.col("doc_id").cast("long"), _shared.text_of()), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
