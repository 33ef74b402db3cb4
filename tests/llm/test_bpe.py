import random

import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe
from tessera.llm.queries import op2_bpe, tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def compare(library, encoder, texts):
    for text, picks in zip(texts, encoder.chunks(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.ids(picks).tolist() == want
        assert encoder.decode(picks).decode() == library.decode(want, skip_special_tokens=False)


def test_as_the_library_does(library, documents):
    rng = random.Random(1)
    odd = ["", " ", "a\xa0b\x85c　d", "It's WE'LL 's", "<|startoftext|>x<|endoftext|> <|endoftext|", "İΣς ﬁ Å", "x\x1cy z", "日本語 🙂", "q" * 500]
    odd += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 500), rng.randrange(0, 0xD800), 32, 10])) for _ in range(50)) for _ in range(400)]
    words = sorted({w.lower().encode() for t in documents.text[:50] for w in t.split() if bpe._PIECES.fullmatch(w.lower())})
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words, bpe.Merges(PATH).apply(words)))
    for known in (None, lexicon):
        compare(library, bpe.Encoder(PATH, known, decoded=True), [*documents.text, *odd])


def test_long_words(library):
    """Words of thousands of letters are the library's too, and take time that grows little faster than they do."""
    import time

    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshrdlu", k=n)) for n in (250, 256, 257, 300, 2000, 9000)] + ["ab" * 700, "e" * 5001, "the" * 400, "!?" * 300, "é" * 999]
    compare(library, bpe.Encoder(PATH, decoded=True), [" ".join(words), *words])
    began = time.process_time()
    assert len(bpe.Merges(PATH).apply([("".join(rng.choices("etaoinshrdlu", k=200_000))).encode()])[0]) > 50_000
    assert time.process_time() - began < 20


def test_a_forgetful_encoder_gives_the_same(library, documents):
    encoder = bpe.Encoder(PATH, decoded=True)
    for name in ("REMEMBERED", "REMEMBERED_CHARS"):
        before = getattr(bpe, name)
        setattr(bpe, name, 100)
        try:
            for i in range(0, 60, 10):
                compare(library, encoder, list(documents.text[i : i + 10]))
                assert len(encoder.known) < 20_000
        finally:
            setattr(bpe, name, before)


def test_what_is_used_most_is_merged_once(library, monkeypatch):
    """It is neither forgotten with rare words nor merged anew as a part of another chunk."""
    monkeypatch.setattr(bpe, "REMEMBERED", 400)
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=9))
    often, merged = [word() for _ in range(60)], []
    encoder = bpe.Encoder(PATH, decoded=True)
    merge = encoder.merges._merge
    monkeypatch.setattr(encoder.merges, "_merge", lambda words: merged.extend(words) or merge(words))
    for i in range(8):
        compare(library, encoder, [" ".join([*often, *often, *(word() for _ in range(300))])])
        compare(library, encoder, [" ".join(f"{x.title()},{i}." for x in often)])
        assert len(encoder.known) < 1200
    assert all(merged.count(x.encode()) == 1 for x in often)


def test_plain_pieces_are_the_vocabularys():
    plain = [c for c in map(chr, range(0x3000)) if c == "\n" or bpe._PLAIN.fullmatch(c)]
    rng = random.Random(7)
    for text in [*plain, *("".join(rng.choices([*plain, *"'''stremvld"], k=300)) for _ in range(300))]:
        assert bpe._PLAIN_PIECES.findall(text.lower()) == bpe._PIECES.findall(text.lower())


def test_the_automaton_is_minimal_and_ranks_words():
    words = sorted({a + b for a in (b"walk", b"talk", b"play", b"stay") for b in (b"", b"s", b"ed", b"ing")})
    ids = bpe.Merges(PATH).apply(words)
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words, ids))
    assert lexicon.rank(words).tolist() == list(range(len(words)))
    assert (lexicon.rank([b"", b"wal", b"walke", b"walkingx", b"zebra"]) == -1).all()
    right = lambda p: frozenset(w[len(p) :] for w in words if w.startswith(p))
    assert len(lexicon.finals) == len({right(w[:k]) for w in words for k in range(len(w) + 1)})


def test_query(spark, sf, library, documents):
    import hashlib

    import numpy as np

    got = {r.doc_id: r for r in op2_bpe(spark, sf).collect()}
    for doc, text in zip(documents.doc_id, documents.text):
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
