import re
from collections import Counter
from itertools import combinations

import pandas as pd

import corpus_pipeline
from tessera.llm import crf, langid

SF = "/root/testdata/sf0.01"


def shingles(text):
    """The set of a text's runs of five words, in lower case."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    given = docs.toPandas()
    model = crf.fit(docs, labels)
    good = corpus_pipeline.quality_classifier(spark, docs, SF)
    assert good.columns == docs.columns
    want = given[model.score(given.text.tolist()) >= 0.3]
    kept = good.toPandas()
    assert sorted(kept.doc_id) == sorted(want.doc_id)
    clean = pd.read_parquet(f"{SF}/labels.parquet").query("quality == 1").doc_id
    assert clean.isin(kept.doc_id).mean() > 0.98

    languages = langid.fit(good).prepare()
    certain = corpus_pipeline.language_id(spark, good, SF)
    assert sorted(certain.toPandas().doc_id) == sorted(kept[[not languages.predict(t)[2] for t in kept.text]].doc_id)

    one = corpus_pipeline.simhash_near_dedup(spark, certain, SF).toPandas()
    left = certain.toPandas()
    kinds = {i: shingles(t) for i, t in zip(left.doc_id, left.text)}
    group, holders = {i: i for i in kinds}, {}
    for i, own in kinds.items():
        for x in own or {""}:  # texts without words are alike
            holders.setdefault(x, []).append(i)
    common = Counter(pair for own in holders.values() for pair in combinations(own, 2))
    for (i, j), n in common.items():  # the groups of alike texts, by counting what all pairs share
        if group[i] != group[j] and 5 * n >= 4 * (len(kinds[i]) + len(kinds[j]) - n):
            old, new = group[j], group[i]
            group = {k: new if g == old else g for k, g in group.items()}
    assert len(set(group.values())) < len(left)
    assert sorted(group[i] for i in one.doc_id) == sorted(set(group.values()))

    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert sorted(set(packed.doc_id)) == sorted(one.doc_id)


def test_stages_on_odd_rows_and_on_nothing(spark, odd, odd_rows, none):
    """What the stages' docstrings say of nulls, empty and very long texts, repeated rows and empty tables."""
    good = corpus_pipeline.quality_classifier(spark, odd, SF)
    assert good.columns == odd.columns
    certain = corpus_pipeline.language_id(spark, odd, SF)
    assert certain.columns == odd.columns and all(r.text and any(c.isalpha() for c in r.text) for r in certain.collect())
    one = corpus_pipeline.simhash_near_dedup(spark, odd, SF).collect()
    assert sum(r.text == "same text here" for r in one) == 1 and sum(not (r.text or "").split() for r in one) == 1
    assert {r.text for r in one if (r.text or "").split()} == {t for _, t, *_ in odd_rows if (t or "").split()}
    packed = corpus_pipeline.best_fit_packing(spark, odd, SF).collect()
    assert sum(r.piece == 0 for r in packed) == len(odd_rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
