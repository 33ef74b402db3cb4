"""From raw documents to packed training sequences; counted as part of tessera.llm.

Each stage takes what its predecessor kept. The first three drop whole rows and
return the columns of documents; the last returns a row for each piece of the
documents that are left, with its place in a training sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import _shared, crf, langid, packing, resemblance
from tessera.llm.queries import tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the classifier calls good; it learns from the labelled ones among docs.

    A null or empty text is scored as one empty line. Where nothing is labelled all rows stay. Rows are judged one by
    one: repeated rows and ties fare alike, long texts are scored whole, an empty table stays empty, other columns pass.
    """
    return crf.keep_good(docs, crf.fit(docs, _shared.table(spark, sf_dir, "labels")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not in doubt.

    Null texts and texts without a letter go, and so do ties of two languages. It learns from the rows of docs that have
    a language; where none has, every row is in doubt. Repeated rows fare alike, long texts are read whole, an empty
    table stays empty, other columns pass.
    """
    return langid.keep_certain(docs, langid.fit(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike by 0.8 or more: found by SimHash, confirmed and completed by their sets.

    The first row of the table stays. Null, empty and blank texts are alike and leave one row; a text of fewer than five
    words is one shingle. Repeated rows are alike, whatever their doc_id, null or not. An empty table stays empty, other
    columns pass, whatever their names.
    """
    return resemblance.one_of_each(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences.

    A null or empty text is the end id alone; a longer one than a sequence is cut, nothing is dropped. Rows with null or
    repeated ids are documents of their own; an empty table gives no sequence; other columns are left aside.
    """
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("best-fit packing", best_fit_packing),
]
#: SQL has neither the classifier nor the compression; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each over what the one before it kept, written and read again between them."""
    docs = _shared.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = _shared.through_table(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
