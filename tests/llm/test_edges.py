"""Every operator over odd rows and over an empty table."""

import pytest

from tessera.llm import bpe, crf, extract, langid, licences, linefreq, lm, packing, simhash, topk
from tessera.llm.queries import tokenizer_path

LABELS = "doc_id long, quality int, toxic int"


def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 0, 0), (8, 0, None), (None, 1, 0), (99, 1, 0), (3, None, 0)], LABELS)


OPERATORS = {
    "bpe": lambda s, d: bpe.digest_documents(d, tokenizer_path()),
    "encoded": lambda s, d: bpe.encode_documents(d, tokenizer_path()),
    "lm": lambda s, d: lm.score_documents(d),
    "langid": lambda s, d: langid.identify(d, langid.fit(d)),
    "crf": lambda s, d: crf.score_documents(d, crf.fit(d, labels(s))),
    "linefreq": lambda s, d: linefreq.judge(d),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "licences": lambda s, d: licences.scan(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(spark, odd, odd_rows, name):
    assert OPERATORS[name](spark, odd).count() == len(odd_rows)


@pytest.mark.parametrize("name", [*OPERATORS, "packing"])
def test_nothing_of_nothing(spark, none, name):
    run = OPERATORS.get(name) or (lambda s, d: packing.pack_documents(d, tokenizer_path()))
    assert run(spark, none).count() == 0


def test_packing_of_odd_rows(spark, odd, odd_rows):
    rows = packing.pack_documents(odd, tokenizer_path()).collect()
    assert sum(r.piece == 0 for r in rows) == len(odd_rows)
    assert sum(r.length for r in rows if r.doc_id == 2) == 1


def test_stages_keep_columns(spark, odd):
    kept = crf.keep_good(odd, crf.fit(odd, labels(spark)))
    assert kept.columns == odd.columns
    assert langid.keep_certain(odd, langid.fit(odd)).columns == odd.columns
    one = simhash.one_of_each(odd)
    assert one.columns == odd.columns
    assert one.where("text = 'same text here'").count() == 1


def test_stages_on_nothing(spark, none):
    empty = spark.createDataFrame([], LABELS)
    for kept in (crf.keep_good(none, crf.fit(none, empty)), langid.keep_certain(none, langid.fit(none)), simhash.one_of_each(none)):
        assert kept.columns == none.columns and kept.count() == 0


def test_nothing_learned(spark, odd, odd_rows):
    blank = odd.withColumn("lang", odd.text.substr(0, 0))
    assert langid.identify(odd, langid.Model({})).where("rejected and lang_pred = 'und' and score = 0").count() == len(odd_rows)
    assert crf.score_documents(blank, crf.fit(blank, spark.createDataFrame([], LABELS))).where("score = 0.5").count() == len(odd_rows)
    assert set(langid.fit(odd).dictionaries) <= {"en"}


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (None, "v", "<p>hello", "x"), (None, "v", "<p>hello", "x")], "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract.extract_pages(pages).collect())
    assert got == [(0, "hello", 5), (0, "hello", 5), (1, "", 0), (2, "", 0)]
    assert extract.extract_pages(pages.limit(0)).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [9.0, 9.0]), (7, []), (50, [-1.0, 0.5]), (8, [1e30, 1.0]), (9, [3.0])]
    v = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.exact_top_k(v).collect()}
    assert got[0, 2] == (1, 256 * 256 * 5) and got[0, 3] == (2, 256 * 256 * 5) and got[0, 1][0] == 8
    assert {k[0] for k in got} == {0, 50}
    assert topk.exact_top_k(v.limit(0)).count() == 0
