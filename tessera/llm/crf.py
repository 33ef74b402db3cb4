"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its features, and those of the lines before and after it,
weigh for one or the other; neighbouring labels weigh with each other. The
probabilities that a line is good, from the forward-backward recursions and
weighted by the lines' lengths, make the document's quality.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared

#: The sample that the weights are learned from: labelled documents of each class, at most, and of a text with more lines so
#: many runs of so many lines, spread evenly from its first to its last.
TRAIN_DOCUMENTS = 1500
RUNS, RUN_LINES = 8, 16
ROUNDS = 120
#: What squares of the weights, and of those of neighbouring labels, count against the likelihood.
DECAY, PAIR_DECAY = 1e-3, 5e-2
HELD_OUT = 5
THRESHOLD = 0.3

#: Upper limits of a feature's buckets.
BUCKETS = {
    "symbols": (0.0, 0.02, 0.06, 0.12, 0.25),
    "capitals": (0.0, 0.05, 0.15, 0.4, 0.8),
    "digits": (0.0, 0.02, 0.06, 0.15, 0.35),
    "calls": (0.0, 0.01, 0.04, 0.1, 0.2),
    "marks": (0.0, 0.01, 0.03, 0.08, 0.2),
    "word_length": (2.0, 4.0, 6.0, 8.0, 12.0),
    "bars": (0.0, 0.01, 0.03, 0.06, 0.12),
    "repeats": (0.0, 0.05, 0.2, 0.4, 0.7),
    "distinct": (0.2, 0.4, 0.6, 0.8, 0.95),
    "words": (0.0, 2.0, 5.0, 15.0, 60.0),
}
_KINDS = np.zeros((6, 256), np.uint8)
_KINDS[0, list(b"#*$%&|<>~^_=+@\\{}[]")] = 1
_KINDS[1, 65:91] = 1
_KINDS[2, 48:58] = 1
_KINDS[3, list(b"!?")] = 1
_KINDS[4, list(b".,;:\"'()-/")] = 1
_KINDS[5, list(b"|")] = 1


@dataclass
class Lines:
    """Lines of documents: where a document's begin, how many it has, their lengths and buckets."""

    begin: np.ndarray
    n: np.ndarray
    length: np.ndarray
    buckets: np.ndarray


def line_features(texts: list[str]) -> Lines:
    lines = [x.split("\n") for x in texts]
    n = np.fromiter(map(len, lines), np.int64, len(lines))
    flat = [x for own in lines for x in own]
    length = np.fromiter(map(len, flat), np.int64, len(flat))
    data = np.frombuffer(("\n".join(flat) + "\n").encode(), np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    counts = np.stack([np.add.reduceat(k[data], starts, dtype=np.int64) for k in _KINDS]) if len(starts) else np.zeros((6, 0), np.int64)
    words, repeats, distinct = (np.zeros(len(flat)) for _ in range(3))
    for i, x in enumerate(flat):
        if w := x.split():
            words[i], distinct[i] = len(w), len(set(w))
            repeats[i] = sum(map(eq, w, w[1:]))
    size, count = np.maximum(ends - starts, 1), np.maximum(words, 1)
    values = [counts[0] / size, counts[1] / size, counts[2] / size, counts[3] / size, counts[4] / size, length / count, counts[5] / size, repeats / count, distinct / count, words]
    buckets = np.stack([np.searchsorted(limits, v, side="left") for limits, v in zip(BUCKETS.values(), values, strict=True)], 1).astype(np.uint8)
    return Lines(np.cumsum(n) - n, n, length, buckets)


_WIDTH = 6
_SELF = len(BUCKETS) * _WIDTH


def _columns(lines: Lines) -> np.ndarray:
    """The numbers of a line's features: its own, those of the line before, those of the line after; -1 for none."""
    own = lines.buckets.astype(np.int64) + np.arange(len(BUCKETS)) * _WIDTH
    before, after = np.full_like(own, -1), np.full_like(own, -1)
    first = np.zeros(len(own), bool)
    first[lines.begin[lines.n > 0]] = True
    before[1:] = np.where(first[1:, None], -1, own[:-1] + _SELF)
    after[:-1] = np.where(first[1:, None], -1, own[1:] + 2 * _SELF)
    return np.concatenate([own, before, after], 1)


@dataclass
class Model:
    weights: np.ndarray
    transitions: np.ndarray
    bias: float
    slope: float
    intercept: float

    def emissions(self, columns: np.ndarray) -> np.ndarray:
        return np.append(self.weights, 0.0)[columns].sum(1) + self.bias

    def marginals(self, lines: Lines, emit: np.ndarray, pairs: np.ndarray | None = None):
        """The probability that each line is good; with ``pairs``, weights of lines, also the expected weights of neighbouring labels."""
        order = np.argsort(-lines.n, kind="stable")
        begin, n = lines.begin[order], lines.n[order]
        score = np.zeros((len(emit), 2))
        score[:, 1] = emit
        forward, backward = score.copy(), np.zeros_like(score)
        longest = int(n.max(initial=0))
        live = [int(x) for x in np.searchsorted(-n, -np.arange(1, longest + 1), side="right")]
        for t in range(1, longest):
            at = begin[: live[t]] + t
            forward[at] += np.logaddexp(forward[at - 1, 0, None] + self.transitions[0], forward[at - 1, 1, None] + self.transitions[1])
        for t in range(longest - 2, -1, -1):
            at = begin[: live[t + 1]] + t
            ahead = backward[at + 1] + score[at + 1]
            backward[at] = np.logaddexp(ahead[:, 0, None] + self.transitions[:, 0], ahead[:, 1, None] + self.transitions[:, 1])
        total = forward + backward
        good = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -700, 700)))
        if pairs is None:
            return good
        whole = np.logaddexp(total[:, 0], total[:, 1])
        inner = np.ones(len(emit), bool)
        inner[lines.begin[lines.n > 0]] = False
        at = np.flatnonzero(inner)
        joint = forward[at - 1][:, :, None] + self.transitions + (score[at] + backward[at])[:, None, :] - whole[at, None, None]
        return good, (np.exp(joint) * pairs[at, None, None]).sum(0)

    def quality(self, lines: Lines) -> np.ndarray:
        """The length-weighted mean of the lines' marginals."""
        good = self.marginals(lines, self.emissions(_columns(lines)))
        weight = np.maximum(lines.length, 1).astype(float)
        return np.add.reduceat(good * weight, lines.begin) / np.add.reduceat(weight, lines.begin) if len(lines.n) else np.zeros(0)

    def score(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.quality(line_features(texts)) + self.intercept, -30, 30)))


def log_likelihood(model: Model, lines: Lines, labels: np.ndarray) -> float:
    """What train() ascends: each document's log-likelihood over its number of lines, their mean, less the squares of the weights."""
    emit, total = model.emissions(_columns(lines)), 0.0
    for begin, n, y in zip(lines.begin, lines.n, labels):
        score = np.array([0.0, emit[begin]])
        for e in emit[begin + 1 : begin + n]:
            score = np.logaddexp(*(score[:, None] + model.transitions)) + [0.0, e]
        total += (y * emit[begin : begin + n].sum() + (n - 1) * model.transitions[y, y] - np.logaddexp(*score)) / n
    return total / len(labels) - 0.5 * DECAY * float((model.weights**2).sum() + model.bias**2) - 0.5 * PAIR_DECAY * float((model.transitions**2).sum())


def _slope(model: Model, lines: Lines, labels: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The slope of log_likelihood: weights, bias, transitions."""
    truth, share = np.repeat(labels, lines.n), np.repeat(1 / lines.n / len(labels), lines.n)
    inner = np.ones(len(truth), bool)
    inner[lines.begin] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[at - 1], truth[at]), share[at])
    good, pairs = model.marginals(lines, model.emissions(columns), pairs=share)
    miss = share * (truth - good)
    own = np.bincount(np.where(columns < 0, 3 * _SELF, columns).ravel(), np.repeat(miss, columns.shape[1]), 3 * _SELF + 1)[: 3 * _SELF]
    return np.concatenate([own - DECAY * model.weights, [miss.sum() - DECAY * model.bias], (seen - pairs - PAIR_DECAY * model.transitions).ravel()])


def train(lines: Lines, labels: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Weights by penalised likelihood, every line labelled as its document is and documents weighing alike; then a logistic curve from quality to label."""
    model = Model(np.zeros(3 * _SELF), np.zeros((2, 2)), 0.0, 0.0, 0.0)
    if not len(labels):
        return model
    columns = _columns(lines)
    parameters = np.zeros(3 * _SELF + 5)
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, rounds + 1):
        slope = _slope(model, lines, labels, columns)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        parameters = parameters + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        model.weights, model.bias, model.transitions = parameters[: 3 * _SELF], float(parameters[3 * _SELF]), parameters[3 * _SELF + 1 :].reshape(2, 2)
    x = np.stack([model.quality(lines), np.ones(len(labels))], 1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(2)
        w = w + np.linalg.solve(hessian, x.T @ (labels - p) - 0.5 * w)
    model.slope, model.intercept = float(w[0]), float(w[1])
    return model


def _held_out(of: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of == 0, F.lit(False))


def spread_lines(text: str) -> str:
    """All lines of a text, or if there are many, runs of them at even distances."""
    lines = text.split("\n")
    if len(lines) <= RUNS * RUN_LINES:
        return text
    begins = [i * (len(lines) - RUN_LINES) // (RUNS - 1) for i in range(RUNS)]
    return "\n".join([x for b in begins for x in lines[b : b + RUN_LINES]])


def fit(docs: DataFrame, labels: DataFrame, held_out: int = HELD_OUT, documents: int = TRAIN_DOCUMENTS) -> Model:
    """Learns from at most ``documents`` documents of each label, those whose ids hash lowest, none of them held out.

    Rows of one doc_id are one document; an id with both labels teaches both.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality")).where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~_held_out(held_out))
    draw = None
    for q in (0, 1):
        own = known.where(F.col("quality") == q).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
        draw = own if draw is None else draw.union(own)
    sample = docs.select(F.col("doc_id").cast("long"), _shared.text_of()).join(F.broadcast(draw), "doc_id")

    def work():
        def step(chunk):
            lines = line_features([spread_lines(x) for x in chunk.column("text").to_pylist()])
            own = [slice(b, b + n) for b, n in zip(lines.begin.tolist(), lines.n.tolist(), strict=True)]
            return {"doc_id": chunk.column("doc_id"), "quality": chunk.column("quality"), "length": [lines.length[x] for x in own], "buckets": [lines.buckets[x].tobytes() for x in own]}

        return step

    made = _shared.map_chunks(sample, work, "doc_id long, quality int, length array<long>, buckets binary")
    # one row of each document and label, however often it comes
    made = made.groupBy("doc_id", "quality").agg(F.min(F.struct("buckets", "length")).alias("x")).select("doc_id", "quality", "x.length", "x.buckets")
    rows = sorted(made.collect(), key=lambda r: (r.doc_id, r.quality))
    n = np.array([len(r.length) for r in rows], np.int64)
    buckets = np.frombuffer(b"".join(bytes(r.buckets) for r in rows), np.uint8).reshape(-1, len(BUCKETS))
    lengths = np.array([x for r in rows for x in r.length], np.int64)
    return train(Lines(np.cumsum(n) - n, n, lengths, buckets), np.array([r.quality for r in rows], np.int64))


def score_documents(docs: DataFrame, model: Model, held_out: int = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if score >= threshold) of every row.

    A null or empty text is one empty line, scored like any other. A null doc_id is
    never held out. Without labels the model knows nothing and scores one half.
    Rows are scored one by one: repeated rows alike, an empty table as empty; other
    columns are left aside.
    """

    def work():
        def step(chunk):
            return {"doc_id": chunk.column("doc_id"), "score": model.score(chunk.column("text").to_pylist())}

        return step

    scored = _shared.map_chunks(docs.select(F.col("doc_id").cast("long"), _shared.text_of()), work, "doc_id long, score double")
    return scored.select("doc_id", _held_out(held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, in all their columns, that the model doesn't reject.

    A null or empty text is scored as one empty line. Without labels every score is
    one half, and all rows stay. Repeated rows fare alike; an empty table stays empty.
    """
    return _shared.filter_rows(docs, lambda: lambda texts: (model.score(texts) >= threshold).tolist())
