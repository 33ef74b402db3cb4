import math
import zlib

import numpy as np
import pandas as pd

from tessera.llm import crf, langid
from tessera.llm.queries import op4_language, op6_quality

BIG = "/root/testdata/sf0.01"


def test_language_accuracy_on_held_out_rows(spark):
    docs = pd.read_parquet(f"{BIG}/documents.parquet")
    got = op4_language(spark, BIG).toPandas().merge(docs[["doc_id", "lang"]], on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert got.score.between(0, 1).all()
    assert (got[got.held_out].lang_pred == got[got.held_out].lang).mean() > 0.95
    assert got.rejected.mean() < 0.03


def test_quality_on_held_out_rows(spark):
    labels = pd.read_parquet(f"{BIG}/labels.parquet")
    got = op6_quality(spark, BIG).toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(0)
    model = crf.Model(np.zeros(3 * crf._SELF), rng.normal(size=(2, 2)), 0.0, 1.0, 0.0)
    n = np.array([4, 1, 3])
    lines = crf.Lines(np.cumsum(n) - n, n, np.ones(8, np.int64), np.zeros((8, len(crf.BUCKETS)), np.uint8))
    emit = rng.normal(size=8)
    got, pairs = model.marginals(lines, emit, pairs=np.ones(8))
    want, expected = np.zeros(8), np.zeros((2, 2))
    for b, k in zip(lines.begin, n):
        weights = {}
        for code in range(2**k):
            y = [code >> i & 1 for i in range(k)]
            weights[tuple(y)] = np.exp(sum(emit[b + i] * y[i] for i in range(k)) + sum(model.transitions[y[i], y[i + 1]] for i in range(k - 1)))
        total = sum(weights.values())
        for y, w in weights.items():
            for i in range(k):
                want[b + i] += y[i] * w / total
            for i in range(k - 1):
                expected[y[i], y[i + 1]] += w / total
    assert np.allclose(got, want) and np.allclose(pairs, expected)


def test_a_line_knows_its_neighbours_within_its_document():
    lines = crf.line_features(["a b c\n*** ### ***", "d e f"])
    columns = crf._columns(lines)
    k = len(crf.BUCKETS)
    assert (columns[0, k : 2 * k] == -1).all() and (columns[1, 2 * k :] == -1).all() and (columns[2, k:] == -1).all()
    assert (columns[1, k : 2 * k] - crf._SELF == columns[0, :k]).all()


def naive_score(model, text):
    """A document's score by plain recursions over its lines."""
    lines = crf.line_features([text])
    columns = crf._columns(lines)
    emit = [model.bias + sum(model.weights[c] for c in row if c >= 0) for row in columns]
    t = model.transitions
    forward, backward = [(1.0, math.exp(emit[0]))], [(1.0, 1.0)]
    for e in emit[1:]:
        a, b = forward[-1]
        x, y = a * math.exp(t[0, 0]) + b * math.exp(t[1, 0]), (a * math.exp(t[0, 1]) + b * math.exp(t[1, 1])) * math.exp(e)
        forward.append((x / (x + y), y / (x + y)))
    for e in reversed(emit[1:]):
        a, b = backward[-1]
        b *= math.exp(e)
        x, y = math.exp(t[0, 0]) * a + math.exp(t[0, 1]) * b, math.exp(t[1, 0]) * a + math.exp(t[1, 1]) * b
        backward.append((x / (x + y), y / (x + y)))
    backward.reverse()
    good = [f[1] * b[1] / (f[0] * b[0] + f[1] * b[1]) for f, b in zip(forward, backward)]
    weight = [max(1, len(x)) for x in text.split("\n")]
    quality = sum(g * w for g, w in zip(good, weight)) / sum(weight)
    return 1 / (1 + math.exp(-(model.slope * quality + model.intercept)))


def test_quality_query_is_brute_force(spark, sf, documents):
    model = crf.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r.doc_id: r.score for r in op6_quality(spark, sf).collect()}
    for doc, text in zip(documents.doc_id, documents.text):
        assert math.isclose(got[doc], naive_score(model, text), rel_tol=1e-6, abs_tol=1e-9)


def test_the_slope_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    lines = crf.line_features(["Good line here, and more.\nAnother one.", "### $$$\n!!! !!!\n***", "one"])
    labels = np.array([1, 0, 1])
    model = crf.Model(rng.normal(size=3 * crf._SELF), rng.normal(size=(2, 2)), 0.3, 0.0, 0.0)
    slope, base = crf._slope(model, lines, labels, crf._columns(lines)), crf.log_likelihood(model, lines, labels)
    for i in [0, 3, 14, 62, 100, 3 * crf._SELF, *range(3 * crf._SELF + 1, 3 * crf._SELF + 5)]:
        other = crf.Model(model.weights.copy(), model.transitions.copy(), model.bias, 0.0, 0.0)
        if i < 3 * crf._SELF:
            other.weights[i] += 1e-6
        elif i == 3 * crf._SELF:
            other.bias += 1e-6
        else:
            other.transitions.ravel()[i - 3 * crf._SELF - 1] += 1e-6
        assert abs((crf.log_likelihood(other, lines, labels) - base) / 1e-6 - slope[i]) < 1e-4


def test_training_sees_ends_of_texts_and_one_row_of_each_document(spark):
    text = "\n".join(f"line {i}" for i in range(1000))
    spread = crf.spread_lines(text).split("\n")
    assert spread[0] == "line 0" and spread[-1] == "line 999" and len(spread) == crf.RUNS * crf.RUN_LINES
    docs = spark.createDataFrame([(i, "Some words, of a good text." if i % 2 else "## $$ !!") for i in range(40)] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2, "doc_id long, quality int")
    once = crf.fit(docs.distinct(), labels.distinct())
    assert np.allclose(crf.fit(docs, labels).weights, once.weights)


def test_language_query_is_brute_force(spark, sf, documents):
    import zstandard as z

    model = langid.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    settings = z.ZstdCompressionParameters(compression_level=1, min_match=4, strategy=z.STRATEGY_LAZY, hash_log=17, chain_log=17, search_log=4, target_length=32, window_log=19, write_content_size=False, write_checksum=False, write_dict_id=False)
    got = {r.doc_id: r.lang_pred for r in op4_language(spark, sf).collect()}
    for doc, text in zip(documents.doc_id[::5], documents.text[::5]):
        plain = langid._normal(text)
        size = lambda words: sum(len(z.ZstdCompressor(dict_data=z.ZstdCompressionDict(words, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=settings).compress(plain[i : i + langid.BLOCK_CHARS].encode())) for i in range(0, len(plain), langid.BLOCK_CHARS))
        assert got[doc] == min(sorted(model.dictionaries), key=lambda x: size(model.dictionaries[x]))


def test_every_language_is_learned_and_texts_to_their_ends(spark):
    """Three hundred languages of one short document each; a word that only the end of a long text holds."""
    name = lambda i: "".join(chr(97 + (i * 7 + k * (i + 3)) % 26) for k in range(9)) + chr(97 + i % 26) + chr(97 + i // 26)
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(ids[i], f"l{i:03d}", f"{name(i)} {name(i)[::-1]} {name(i)}") for i in range(300)]
    rows += [(ids[300], "long", "filler words of it " * 3000 + "zyxwvutsrqponmlkji quixotically"), (ids[301], "tiny", "q"), (ids[302], "none", "123"), (ids[302], "none", None)]
    model = langid.fit(spark.createDataFrame(rows * 2, "doc_id long, lang string, text string"))
    assert set(model.dictionaries) == {f"l{i:03d}" for i in range(300)} | {"long", "tiny"}
    ready = langid.Model(model.dictionaries).prepare()
    assert all(ready.predict(f"{name(i)} {name(i)[::-1]}")[0] == f"l{i:03d}" for i in (0, 100, 256, 257, 299))
    assert ready.predict("zyxwvutsrqponmlkji quixotically")[0] == "long"
