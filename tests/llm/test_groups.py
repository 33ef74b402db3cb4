import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tessera.llm import packing, simhash
from tessera.llm.queries import op8_simhash, op10_packing, tokenizer_path


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_index_finds_all_pairs(distance):
    rng = np.random.default_rng(distance)
    codes = rng.integers(0, 2**64, 150, dtype=np.uint64)
    near = rng.choice(codes, 300)
    for _ in range(3):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64))
    codes = np.unique(np.concatenate([codes, near]))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    assert (simhash.gray_code(simhash.gray_rank(codes)) == codes).all()
    found = set()
    for a, b in simhash.GrayIndex(codes).search(codes, distance):
        found |= set(zip(a.tolist(), b.tolist()))
    want = np.argwhere(np.bitwise_count(codes[:, None] ^ codes[None]) <= distance)
    assert found == set(map(tuple, want.tolist()))


def roots(codes, distance=2):
    parent = list(range(len(codes)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i] ^ codes) <= distance):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def test_components_over_many_ranges(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 200, dtype=np.uint64)
    chain = [base[0]]
    for _ in range(400):  # a long chain, and a crowd around one code
        chain.append(chain[-1] ^ (np.uint64(1) << np.uint64(rng.integers(0, 64))))
    crowd = base[1] ^ (np.uint64(1) << rng.integers(0, 64, 64).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 64).astype(np.uint64))
    codes = np.unique(np.concatenate([base, np.array(chain), crowd]))
    df = spark.createDataFrame([(int(x),) for x in codes.view(np.int64)], "code long")
    got = dict(simhash._linked(simhash.components(simhash.links(df, 2, range_codes=25))).collect())
    own, mine = roots(codes), defaultdict(set)
    for i, r in enumerate(own):
        mine[r].add(int(codes.view(np.int64)[i]))
    for group in mine.values():
        assert {got.get(x, x) for x in group} == ({min(group)} if len(group) > 1 else group)


def plain_fingerprint(text):
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in text.encode().decode().replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_query_is_brute_force(spark, sf, documents):
    got = {r.doc_id: r for r in op8_simhash(spark, sf).collect()}
    codes = np.array([plain_fingerprint(t) for t in documents.text], np.uint64)
    own = roots(codes)
    least = {}
    for i, r in enumerate(own):
        least[r] = min(least.get(r, 10**18), int(documents.doc_id[i]))
    for i, doc in enumerate(documents.doc_id):
        assert got[doc].fingerprint == f"{int(codes[i]):016x}"
        assert got[doc].component_id == least[own[i]]


def test_long_runs_of_one_shingle():
    assert int(simhash.fingerprints(["a b c " * 400])[0]) == plain_fingerprint("a b c " * 400)


def check_packing(rows, capacity=4096):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_query(spark, sf, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rows = op10_packing(spark, sf).collect()
    used = check_packing(rows)
    pieces = {(r.doc_id, r.piece): r for r in rows}
    total = n = 0
    for doc, text in zip(documents.doc_id, documents.text):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for k, start in enumerate(range(0, len(ids), 4096)):
            own, r = ids[start : start + 4096], pieces[doc, k]
            assert (r.start, r.length, r.ids_crc32) == (start, len(own), zlib.crc32(own.tobytes()))
            n += 1
    assert n == len(rows)
    assert used <= math.ceil(total / 4096) * 1.02 + 1


def test_evolution_keeps_every_piece_and_beats_best_fit(documents):
    """On pieces with lengths of real documents that best-fit alone packs into more sequences than needed."""
    saved = 0
    for seed in range(4):
        rng = random.Random(seed)
        size = [n for n in (len(t.split()) * 4 // 3 for t in documents.text) if 700 < n < 4096] + [rng.choice([1400, 1365, 1331, 2100, 1996, 700, 650]) for _ in range(300)]
        first = packing.best_fit([], sorted(range(len(size)), key=lambda i: -size[i]), size)
        best = packing.evolve(size, seed, [])
        assert sorted(i for b in best for i in b) == list(range(len(size)))
        assert all(sum(size[i] for i in b) <= 4096 for b in best) and len(best) <= len(first)
        saved += len(first) - len(best)
    assert saved >= 4


def test_sequences_are_filled_exactly_where_sums_allow():
    size = [3000, 1000, 96, 500, 2000, 2096]
    assert sorted(map(sorted, packing.fill(list(range(6)), size))) == [[0, 1, 2], [3], [4, 5]]
    assert packing.fill([], size) == []


def test_crossover_keeps_well_filled_sequences():
    rng = random.Random(2)
    size = [rng.randint(200, 2000) for _ in range(80)]
    orders = [sorted(range(80), key=lambda i: -size[i]), list(range(80))]
    a, b = (packing.best_fit([], o, size) for o in orders)
    child = packing.crossover(a, b, size, rng)
    assert sorted(i for x in child for i in x) == list(range(80))
    assert all(sum(size[i] for i in x) <= 4096 for x in child)


def test_pieces_keep_their_columns(spark):
    df = spark.createDataFrame([(i, 1 + (i * 37) % 4096, "x", 5) for i in range(500)], "doc_id long, length long, cell string, bins int")
    out = packing.pack(df, cell_tokens=100_000)
    assert out.columns == ["doc_id", "length", "cell", "bins", "sequence_id", "offset"]
    assert out.count() == 500
    check_packing(out.collect())


def test_cells_share_what_they_leave_open(spark):
    """Short pieces in many small cells need no more sequences than their tokens do, but one."""
    df = spark.createDataFrame([(i, 1 + i % 13) for i in range(6000)], "doc_id long, length int")
    rows = packing.pack(df, capacity=256, cell_tokens=2000).collect()
    assert sorted(r.doc_id for r in rows) == list(range(6000))
    assert check_packing(rows, 256) <= math.ceil(sum(1 + i % 13 for i in range(6000)) / 256) + 1
