"""Quality rules: repetition inside a document, and lines that many documents of a host share.

Normalised lines are hashed, and for each host and hash the distinct documents are
counted. Lines above the limit, a share of the host's documents, are removed, and a
document that has lost too many of its words is rejected.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

#: The share of a host's distinct documents that may hold a line, and documents that always may.
LIMIT_SHARE, LIMIT_LEAST = 0.05, 5
#: The least share of its words that a document keeps.
KEPT_SHARE = 0.3
_SPACE = "\t\n\x0b\x0c\r "
_SYMBOLS = "#*$%&|<>"
_FIGURES = regex.compile(r"\d+")
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def line_hash(line: str) -> int:
    """Of the line in lower case, with single spaces, figures as 0."""
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(_FIGURES.sub("0", " ".join(line.lower().split()))) - (1 << 63)


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of three that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    a = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    _, pair = np.unique(a[:-1] * len(known) + a[1:], return_inverse=True)
    _, which, count = np.unique(pair[:-1] * len(known) + a[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def measure(text: str) -> tuple[tuple[int, ...], dict[int, int]]:
    """The base measures, and the words of each distinct line by its hash."""
    words = text.encode().split()
    lines: dict[int, int] = {}
    seen: set[str] = set()
    twice = 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            twice += line in seen
            seen.add(line)
            key = line_hash(line)
            lines[key] = lines.get(key, 0) + len(line.encode().split())
    chars = len(text) - sum(text.count(c) for c in _SPACE)
    return (len(words), chars, sum(text.count(c) for c in _SYMBOLS), twice, repeat_words(words)), lines


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, text_hash, the measures and the lines (hash, words) of every row."""

    def work():
        from xxhash import xxh64_intdigest

        def step(chunk):
            found = [measure(x) for x in chunk.column("text").to_pylist()]
            out = {"doc_id": chunk.column("doc_id"), "host": chunk.column("host"), "text_hash": [xxh64_intdigest(x.encode()) - (1 << 63) for x in chunk.column("text").to_pylist()]}
            for i, part in enumerate(MEASURES.split(", ")):
                out[part.split()[0]] = [x[0][i] for x in found]
            out["lines"] = [[{"hash": k, "words": n} for k, n in x[1].items()] for x in found]
            return out

        return step

    own = F.coalesce(F.col(host).cast("string"), F.lit("")) if host in docs.columns else F.lit("")
    source = docs.select(F.col("doc_id").cast("long"), own.alias("host"), _shared.text_of())
    return _shared.map_chunks(source, work, f"doc_id long, host string, text_hash long, {MEASURES}, lines array<struct<hash:long,words:long>>")


def common_lines(table: DataFrame, share: float = LIMIT_SHARE, least: int = LIMIT_LEAST) -> DataFrame:
    """host, hash of the lines that more than ``least`` distinct documents of the host hold, and more than ``share`` of them."""
    document = F.coalesce("doc_id", "text_hash").alias("document")  # rows without an id are told apart by their texts
    sizes = table.select("host", document).distinct().groupBy("host").agg(F.count("*").alias("all"))
    lines = table.select("host", document, F.explode("lines.hash").alias("hash")).distinct()
    often = lines.groupBy("host", "hash").agg(F.count("*").alias("documents")).where(F.col("documents") > least)
    return often.join(sizes, "host").where(F.col("documents") > share * F.col("all")).select("host", "hash")


def judge(docs: DataFrame, host: str = "source", share: float = LIMIT_SHARE, least: int = LIMIT_LEAST, kept_share: float = KEPT_SHARE) -> DataFrame:
    """doc_id, the measures, removed_words, common (hashes of removed lines), base_failed and kept of every row.

    A null text has no words and fails the base rules; a null or missing host is the
    empty one. Rows of one doc_id and host are one document, and repeated rows get the
    same verdict; rows without a doc_id are one document if their text is the same. A
    line that comes as often as the limit stays. An empty table gives an empty result; columns other than doc_id, text and the host's are
    left aside.
    """
    table = _shared.through_table(measures(docs, host), "measures")
    lines = table.select("host", "text_hash", F.explode("lines").alias("line")).select("host", "text_hash", F.col("line.hash").alias("hash"), F.col("line.words").alias("words")).distinct()
    cut = lines.join(common_lines(table, share, least), ["host", "hash"]).groupBy("host", "text_hash").agg(F.sum("words").alias("removed_words"), F.collect_set("hash").alias("common"))
    out = table.join(cut, ["host", "text_hash"], "left")
    removed = F.coalesce("removed_words", F.lit(0))
    failed = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    kept = ~failed & (F.col("n_words") - removed >= kept_share * F.col("n_words"))
    return out.select("doc_id", *[x.split()[0] for x in MEASURES.split(", ")], removed.alias("removed_words"), F.coalesce("common", F.array().cast("array<long>")).alias("common"), failed.alias("base_failed"), kept.alias("kept"))


def remove_lines(text: str, common: set[int]) -> str:
    """The text without its common lines."""
    return "\n".join([x for x in text.split("\n") if not x.strip(_SPACE) or line_hash(x) not in common])
