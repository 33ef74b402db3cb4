"""Language identification by compression.

A raw-content zstandard dictionary of each language's own text makes text of that
language compress best. Every text is encoded, block by block, with each language's
dictionary; the language with the fewest bytes wins. Where the second best is as
good but for a narrow margin, the document is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _shared

HELD_OUT, HELD_OUT_REST = 3, 1
#: The sample that is learned from: documents of each language, and of all, at most; of a long text so many spans of so many
#: characters, spread evenly from its first to its last. Every language has a document at least.
TRAIN_DOCUMENTS, ALL_DOCUMENTS = 200, 1 << 16
SPANS, SPAN_CHARS = 8, 512
#: Parts of a language that its documents are drawn from, step by step, before they meet: no step after the first reads more
#: than eight draws for one part.
PARTS = (64, 8, 1)
#: Bytes of a language's dictionary, and of all, at most; with very many languages each one's is smaller.
DICTIONARY_BYTES, ALL_BYTES, LEAST_BYTES = 96 << 10, 128 << 20, 256
#: Characters that are encoded at once, so that the dictionary stays what matters.
BLOCK_CHARS = 2048
#: The margin below which a document is rejected, as a share of the best language's bytes.
NARROW = 0.004
UNKNOWN = "und"
#: Bytes that a raw dictionary has at least.
LEAST = 8
_LETTER = regex.compile(r"\p{L}")
_CLEAN = regex.compile(r"[\d\p{S}\p{Cc}#*%&@/\\|_]+")


def _normal(text: str) -> str:
    """Words in lower case, without figures and symbols; a word said over and over counts once."""
    words = _CLEAN.sub(" ", text).lower().split()
    return " ".join([w for w, before in zip(words, ["", *words]) if w != before])


@dataclass
class Model:
    dictionaries: dict[str, bytes]
    encoders: list = field(default_factory=list)

    def prepare(self) -> Model:
        import zstandard as z

        settings = z.ZstdCompressionParameters(compression_level=1, min_match=4, strategy=z.STRATEGY_LAZY, hash_log=17, chain_log=17, search_log=4, target_length=32, window_log=19, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.encoders = []
        for text in self.dictionaries.values():
            words = z.ZstdCompressionDict(text, dict_type=z.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=settings)
            self.encoders.append(z.ZstdCompressor(dict_data=words, compression_params=settings))
        return self

    def sizes(self, text: str) -> np.ndarray:
        """Bytes of the text with each dictionary."""
        text = _normal(text)
        out = np.zeros(len(self.encoders), np.int64)
        for at in range(0, len(text), BLOCK_CHARS):
            block = text[at : at + BLOCK_CHARS].encode()
            for i, encoder in enumerate(self.encoders):
                out[i] += len(encoder.compress(block))
        return out

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, score and whether the margin is too narrow."""
        if not self.encoders or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        order = np.argsort(sizes, kind="stable")
        best = list(self.dictionaries)[order[0]]
        if len(order) == 1:
            return best, 1.0, False
        gap = float(sizes[order[1]] - sizes[order[0]])
        margin = gap / max(1.0, float(sizes[order[0]]))
        return best, 1.0 - 0.5 * float(np.exp(-gap / 2.0 - 20 * margin)), gap < 1 or margin < NARROW


def _learned():
    return F.crc32(F.col("doc_id").cast("string")) % HELD_OUT != HELD_OUT_REST


def _spread(text):
    """Of a text: all of it, or if it is long, spans of it at even distances."""
    n = F.length(text)
    begin = lambda i: (F.floor(i * (n - SPAN_CHARS) / (SPANS - 1)) + 1).cast("int")
    spans = F.transform(F.sequence(F.lit(0), F.lit(SPANS - 1)), lambda i: F.substring(text, begin(i), F.lit(SPAN_CHARS)))
    return F.when(n > SPANS * SPAN_CHARS, F.array_join(spans, " ")).otherwise(text)


def fit(docs: DataFrame, documents: int = TRAIN_DOCUMENTS, size: int = DICTIONARY_BYTES) -> Model:
    """A dictionary for each language, from the learnable documents whose ids hash lowest among those that have a letter.

    All languages are learned, however many. Rows of one doc_id and language are one
    document, with the smallest of their texts.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & _learned() & F.col("text").rlike(r"\p{L}"))
    ids = texts.select("doc_id", "lang").distinct()
    languages = max(1, ids.agg(F.count_distinct("lang")).first()[0])
    documents, size = max(1, min(documents, ALL_DOCUMENTS // languages)), max(LEAST_BYTES, min(size, ALL_BYTES // languages))
    draw = ids
    for parts in PARTS:  # a language's documents are thinned in parts, so that none meets all of them in one task
        part = F.pmod(F.hash("doc_id"), F.lit(parts))
        order = Window.partitionBy("lang", part).orderBy(F.xxhash64("doc_id"), "doc_id")
        draw = draw.withColumn("n", F.row_number().over(order)).where(F.col("n") <= documents)
    draw = draw.select("doc_id", F.col("lang").alias("drawn"))
    drawn = texts.join(F.broadcast(draw), (texts.doc_id == draw.doc_id) & (texts.lang == draw.drawn), "left_semi")
    rows = drawn.select("doc_id", "lang", _spread(F.col("text")).alias("text")).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r.lang, []).append((r.doc_id, r.text))
    out = {}
    for lang in sorted(by):
        data, seen = b"", set()
        for _, text in sorted(by[lang]):
            if text not in seen and len(data) < size:
                seen.add(text)
                data += _normal(text).encode()
        data = data[:size].decode(errors="ignore").encode()
        out[lang] = data if len(data) >= LEAST else (b" " + data) * LEAST  # a dictionary has some bytes
    return Model(out)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1) and rejected of every row.

    A null text or one without a letter is ``und`` with score 0, and rejected; so is
    every text if nothing could be learned. Ties go to the language that sorts first,
    and are rejected. A null doc_id is not held out. Rows are judged one by one, so
    repeated rows alike; an empty table gives an empty result; other columns are left
    aside.
    """

    def work():
        ready = Model(model.dictionaries).prepare()

        def step(chunk):
            found = [ready.predict(x) for x in chunk.column("text").to_pylist()]
            return {"doc_id": chunk.column("doc_id"), "lang_pred": [x[0] for x in found], "score": [x[1] for x in found], "rejected": [x[2] for x in found]}

        return step

    judged = _shared.map_chunks(docs.select(F.col("doc_id").cast("long"), _shared.text_of()), work, "doc_id long, lang_pred string, score double, rejected boolean")
    return judged.select("doc_id", F.coalesce(~_learned(), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def keep_certain(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, in all their columns, whose language is not in doubt.

    Null texts, texts without a letter and ties are in doubt, and so is everything if
    nothing was learned. Repeated rows fare alike; an empty table stays empty.
    """

    def work():
        ready = Model(model.dictionaries).prepare()
        return lambda texts: [not ready.predict(x)[2] for x in texts]

    return _shared.filter_rows(docs, work)
