import math
import os
import re
import zlib
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import lm
from tessera.llm.queries import op3_language_model


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300), st.lists(st.integers(0, 2**41), min_size=1, max_size=60))
def test_elias_fano(values, asked):
    v, q = np.sort(np.array(values, np.uint64)), np.array(asked, np.uint64)
    e = lm.EliasFano.encode(v)
    place, hit = e.find(q)
    assert (place == np.searchsorted(v, q)).all() and (hit == np.isin(q, v)).all()
    if len(v):
        assert (e.get(np.arange(len(v))) == v).all()
    if len(v) > 1:
        a, b = e.get_both(np.arange(len(v) - 1))
        assert (a == v[:-1]).all() and (b == v[1:]).all()


def tokens(text):
    lower = lambda w: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
    return [lower(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + ["\n"]


def test_query_is_the_model_by_brute_force(spark, sf, documents):
    got = {r.doc_id: r for r in op3_language_model(spark, sf).collect()}
    texts = [tokens(t) for t in documents.text]
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i in documents.doc_id]
    learned = [t for t, h in zip(texts, out) if not h]
    c = Counter(w for t in learned for w in t)
    n, v, cut = sum(c.values()), len(c), lm.DISCOUNT
    two = {k: x for k, x in Counter(p for t in learned for p in zip(["\n", *t], t)).items() if x >= lm.SEEN}
    three = {k: x for k, x in Counter(p for t in learned for p in zip(["\n", *t], t, t[1:]) if p[:2] in two and p[1:] in two).items() if x >= lm.SEEN}
    used, used2 = Counter(), Counter()
    for (a, b), x in two.items():
        used[a] += x - cut
    for (a, b, w), x in three.items():
        used2[a, b] += x - cut
    p1 = lambda w: (c[w] + 1) / (n + v + 1)

    def p2(a, w):
        if not c[a]:
            return p1(w)
        return (two[a, w] - cut if (a, w) in two else 0) / c[a] + max(1 - used[a] / c[a], 1e-6) * p1(w)

    def p3(a, b, w):
        if (a, b) not in two:
            return p2(b, w)
        return (three[a, b, w] - cut if (a, b, w) in three else 0) / two[a, b] + max(1 - used2[a, b] / two[a, b], 1e-6) * p2(b, w)

    assert abs(sum(p2("the", w) for w in c) + max(1 - used["the"] / c["the"], 0) / (n + v + 1) - 1) < 1e-9
    for doc, t, h in zip(documents.doc_id, texts, out):
        r = got[doc]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10(p1(w)) for w in t), rel_tol=1e-9)
        line = ["\n", *t]
        exact = math.log10(p2("\n", t[0])) + sum(math.log10(p3(*line[i - 1 : i + 2])) for i in range(1, len(t)))
        assert abs(r.score - exact) < 0.06 * len(t) + 1e-6  # bytes stand for ranges of probabilities
    frame = pd.DataFrame([r.asDict() for r in got.values()])
    held = frame[frame.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_what_is_seen_once_counts(spark):
    """Pairs and triples of a single training text make the same held-out text likelier than its words do."""
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    learned, asked = next(i for i in range(100) if not out(i)), next(i for i in range(100) if out(i))
    text = "one two three four five six"
    df = spark.createDataFrame([(learned, text), (asked, text)], "doc_id long, text string")
    got = {r.doc_id: r for r in lm.score_documents(df).collect()}[asked]
    p1 = 2 / (7 + 7 + 1)
    p2 = 1 - lm.DISCOUNT + lm.DISCOUNT * p1
    p3 = 1 - lm.DISCOUNT + lm.DISCOUNT * p2
    assert math.isclose(got.base_score, 7 * math.log10(p1), rel_tol=1e-9)
    assert abs(got.score - math.log10(p2) - 6 * math.log10(p3)) < 0.06 * 7


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbÉé \t\n\x0b\x1c　"), max_size=12)), max_size=6), st.integers(0, 2))
def test_words_of_texts(texts, skip):
    texts = [t or "" for t in texts]
    column = pa.chunked_array([pa.array(texts, pa.string()).slice(skip)])
    hashes, local, n = lm.read_words(column)
    want = [[w.encode() for w in tokens(t)] for t in texts[skip:]]
    assert n.tolist() == [len(w) for w in want]
    assert hashes[local].tolist() == lm.word_hashes([w for t in want for w in t]).tolist()
    assert len(set(hashes.tolist())) == len(hashes)


def test_a_missing_file_is_an_error(spark):
    df = spark.createDataFrame([(i, f"one two three {'abcdefgh'[i]}") for i in range(8)], "doc_id long, text string")
    trie = lm.first_level(df)
    numbers, pairs = lm.number_documents(df, trie)
    lm.further_levels(trie, numbers, pairs)
    assert len(lm.score_documents(df, trie).collect()) == 8
    shard = int(np.flatnonzero(trie.written[2])[0])
    os.remove(urlparse(trie.uri(2, shard)).path)
    with pytest.raises(Exception, match="FileNotFoundError"):
        lm.score_documents(df, trie).collect()
