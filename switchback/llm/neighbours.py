"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a bag of words, word shapes and a few statistics, hashed to FEATURES
columns. A bounded sample of labelled texts gives the weights of columns and,
by a singular value decomposition, the latent space. Its vectors are broadcast;
every document is compared with all of them by blocked cosine products, and the
labels of the nearest vote by similarity, corrected for the sample's shares.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchback.llm.common import BATCH_ROWS, held_out, short_batches

#: Labelled texts of each label that the vectors are made of, those of smallest hash.
SAMPLE = 1500
#: Columns of a text's row, of them the last ones for its statistics, and dimensions of the latent space.
FEATURES, OWN_COLUMNS, DIMENSIONS = 2048, 256, 48
NEIGHBOURS = 25
#: Vectors compared at once, and statistics' weight against that of all words together.
BLOCK, STATISTICS_WEIGHT = 1024, 1.4
#: Steps into which a share is cut.
STEPS = 10
#: Remembered words of a task; a full memo is emptied, which changes no result. Longer words are not remembered.
MEMO, MEMO_CHARS = 200_000, 40

_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")
_SYMBOLS = "#*$%&|<>!=_{}[]\\^~@"


def _column(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % (FEATURES - OWN_COLUMNS)


def _own_column(statistic: str) -> int:
    return FEATURES - 1 - zlib.crc32(statistic.encode()) % OWN_COLUMNS


def shape(word: str) -> str:
    """Runs of letters as ``A`` or ``a`` by whether all are capitals, of digits as ``0``; other signs as they are, at most eight."""
    runs = _LETTERS.sub(lambda m: "A" if m[0].isupper() else "a", word[:64])
    return _DIGITS.sub("0", runs)[:8]


class _Words(dict):
    """What is known of a word: its two columns, whether it has symbols, whether it is in capitals."""

    def __missing__(self, word: str) -> tuple[int, int, bool, bool]:
        known = (
            _column("w:" + word.lower()), _column("s:" + shape(word)), any(c in _SYMBOLS for c in word), len(word) > 1 and word.isupper()
        )
        if len(word) <= MEMO_CHARS:
            if len(self) > MEMO:
                self.clear()
            self[word] = known
        return known


def _bucket(share: float) -> int:
    return min(STEPS, int(np.ceil(share * STEPS)))


def bag(text: str, known: _Words) -> tuple[list[int], list[float], list[int]]:
    """Columns of words and shapes with how often each is met, and the columns of the text's statistics."""
    words = text.split()
    n = len(words)
    counts: Counter = Counter()
    symbols = capitals = 0
    distinct = Counter(words)
    for word, k in distinct.items():
        a, b, symbol, capital = known[word]
        counts[a] += k
        counts[b] += k
        symbols += k * symbol
        capitals += k * capital
    pairs = len(set(zip(words, words[1:])))
    same = sum(x == y for x, y in zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    share = lambda k, of: _bucket(k / of) if of else STEPS + 1
    statistics = [
        f"length:{min(n, 2**14).bit_length()}", f"symbols:{share(symbols, n)}", f"capitals:{share(capitals, n)}", f"same:{share(same, n)}",
        f"pairs:{share(max(0, n - 1 - pairs), n - 1 if n > 1 else 0)}", f"lines:{share(len(lines) - len(set(lines)), len(lines))}",
        f"letters:{min(20, round(sum(map(len, words)) / n)) if n else 'none'}",
    ]
    return list(counts), [float(v) for v in counts.values()], [_own_column(s) for s in statistics]


def rows_of(texts: list[str], known: _Words) -> np.ndarray:
    """A row of FEATURES a text: damped counts of unit length, and statistics beside them."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, text in enumerate(texts):
        columns, counts, statistics = bag(text, known)
        if columns:
            values = 1 + np.log(np.array(counts, np.float32))
            out[i, columns] = values / np.linalg.norm(values)
        np.add.at(out[i], statistics, np.float32(STATISTICS_WEIGHT / np.sqrt(len(statistics))))
    return out


class Model:
    """Weights of columns, the latent space, and the labelled vectors in it."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, totals: dict[int, int], dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS):
        n = len(rows)
        self.neighbours = min(neighbours, n)
        self.weights = np.log((1 + n) / (1 + (rows > 0).sum(axis=0))).astype(np.float32) + 1 if n else np.ones(FEATURES, np.float32)
        share = sum(totals.values())
        self.prior = totals.get(1, 0) / share if share else 0.5
        self.labels = labels.astype(np.float64)
        if not n:
            return
        weighted = rows * self.weights
        # right singular vectors from the smaller of the two products
        if n <= FEATURES:
            values, left = np.linalg.eigh((weighted @ weighted.T).astype(np.float64))
            keep = np.argsort(values)[::-1][:dimensions]
            keep = keep[values[keep] > 1e-6 * values.max()]
            self.space = (weighted.T @ left[:, keep] / np.sqrt(values[keep])).astype(np.float32)
        else:
            values, right = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
            keep = np.argsort(values)[::-1][:dimensions]
            self.space = right[:, keep].astype(np.float32)
        self.vectors = self._unit(weighted @ self.space)
        # what a vote of each label counts, so that shares of the sample stand for those of all labelled texts
        sampled = {y: int((labels == y).sum()) for y in (0, 1)}
        self.votes = np.array([totals[int(y)] / sampled[int(y)] for y in labels])

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(length > 0, length, 1)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Similarities and numbers of the nearest vectors of each row, over all vectors in blocks."""
        q = self._unit((rows * self.weights) @ self.space)
        best = np.zeros((len(q), 0), np.float32)
        which = np.zeros((len(q), 0), np.int64)
        for at in range(0, len(self.vectors), BLOCK):
            near = q @ self.vectors[at : at + BLOCK].T
            best = np.hstack([best, near])
            which = np.hstack([which, np.broadcast_to(np.arange(at, at + near.shape[1]), near.shape)])
            if best.shape[1] > self.neighbours:
                keep = np.argpartition(-best, self.neighbours - 1, axis=1)[:, : self.neighbours]
                best, which = np.take_along_axis(best, keep, 1), np.take_along_axis(which, keep, 1)
        return best, which

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.labels) or not len(rows):
            return np.full(len(rows), self.prior)
        near, which = self.nearest(rows)
        weight = np.maximum(near, 0).astype(np.float64) ** 2 * self.votes[which]
        total = weight.sum(axis=1)
        vote = (weight * self.labels[which]).sum(axis=1)
        return np.where(total > 0, vote / np.where(total > 0, total, 1), self.prior)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS) -> Model:
    """Fits on at most ``sample`` texts of each label outside the held-out fold; label totals count all of that fold.

    Only rows with a doc_id and a label of 0 or 1 count. A document labelled
    both ways is in both samples. One scan of ``docs``; what reaches the driver
    is at most 2 * ``sample`` rows of FEATURES numbers.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.filter(~held_out(F.col("doc_id"))).distinct()
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = known.filter("y = 0").orderBy(*order).limit(sample).unionByName(known.filter("y = 1").orderBy(*order).limit(sample))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = _Words()
        for batch in batches:
            yield pd.Series([r.tobytes() for r in rows_of([t or "" for t in batch], words)], dtype=object)

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    made = short_batches(texts).select("doc_id", "y", F.pandas_udf(run, "binary")("text").alias("row")).distinct().collect()
    made.sort(key=lambda r: (r["doc_id"], r["y"], r["row"]))
    rows = np.frombuffer(b"".join(bytes(r["row"]) for r in made), np.float32).reshape(-1, FEATURES)
    return Model(rows, np.array([r["y"] for r in made], np.int64), totals, dimensions, neighbours)


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """Every row of ``docs`` with ``score``, 0 to 1, from the whole text alone.

    Null texts are empty; an empty text has statistics and so neighbours. A
    text that is near no labelled one, and every text if there are no labels,
    scores the share of label 1. A column named as ``out`` is replaced; rows
    stay as they are, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted, words = cloudpickle.loads(shared.value), _Words()
        for batch in batches:
            texts = [t or "" for t in batch]
            parts = [fitted.scores(rows_of(texts[at : at + BATCH_ROWS], words)) for at in range(0, len(texts), BATCH_ROWS)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return short_batches(docs).withColumn(out, F.pandas_udf(run, "double")(F.col("text")))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
