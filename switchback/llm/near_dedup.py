"""MinHash near-dedup: banded minima, signature and exact verification, components.

Texts of equal shingle sets form a class, and only one document of a class is
hashed further. Candidates come from bands of minima. All members of a bucket
are compared with its anchor, the member that shares most buckets, never all
with all: those that the anchor C links need no comparison among themselves,
since components are asked for. Two others, A and B, share at most
min(|A and C|, |B and C|) shingles of C, so a link of theirs needs a known number
of shingles outside of C in common. Only pairs of different components that can
have those are compared too: they meet by their rarest shingles outside of C, and
bitmaps of all of these bound how many they share. No pair that shares a band is
left out but by such an exact bound.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchback.llm.common import fresh_name, landed_small, order_id, short_batches
from switchback.llm.components import components
from switchback.session import cut_lineage, drop_tables

#: A pair of similarity 0.75 shares none of 50 bands of 5 minima with probability 1.3e-6.
BANDS, ROWS = 50, 5
SHINGLE_WORDS, PERCENT = 5, 75
#: How often shingles that no two components share, and then documents with too few others, are taken out.
PEELS = 2
#: Words of 64 bits in which a document's shingles outside of an anchor are marked.
WORDS = 8
#: Signatures agree in fewer than 60 of 100 minima with probability below 1e-7 at similarity 0.75.
LEAST_AGREEMENT = 0.6
#: Remembered word hashes of a task; a full memo is emptied, which changes no result.
MEMO = 500_000
FINGERPRINT = "n_shingles long, digest binary, signature binary, bands array<long>"

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[1]
    return x ^ (x >> np.uint64(29))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: dict, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(size, n)
    mixed = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        mixed = _scramble(mixed * _ODD[0] + h[j : n - width + 1 + j])
    return np.unique(mixed)


class Minima:
    """Many universal hashes x -> a x + b of 32 bits, their minima over a set, and band keys of those."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(20_240)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 2**31, (bands * rows, 1)).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 2**32, (bands * rows, 1)).astype(np.uint32)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), 2**32 - 1, np.uint32)
        for at in range(0, len(x), 4096):
            np.minimum(least, (self.a * x[at : at + 4096] + self.b).min(axis=1), out=least)
        return least

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """One 64-bit key a band for rows of minima."""
        parts = minima.reshape(len(minima), self.bands, self.rows).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
        for j in range(self.rows):
            key = _scramble(key * _ODD[0] + parts[:, :, j])
        return key.view(np.int64)


def fingerprints(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc`` and, a row for a row, the set's size and digest, 16 bits of each minimum, and the band keys."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes, minima = _WordHashes(), Minima(bands, rows)
        for batch in batches:
            sets = [shingle_set(t, hashes) for t in batch]
            least = np.stack([minima.of(s) for s in sets]) if sets else np.zeros((0, bands * rows), np.uint32)
            keys = minima.keys(least)
            low = least.astype("<u2")
            some = [len(s) > 0 for s in sets]
            yield pd.DataFrame({
                "n_shingles": np.array([len(s) for s in sets], np.int64),
                "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if x else None for s, x in zip(sets, some)],
                "signature": [low[i].tobytes() if x else None for i, x in enumerate(some)],
                "bands": [keys[i] if x else None for i, x in enumerate(some)],
            })

    made = short_batches(docs).select(order_id(F.col("doc_id")).alias("doc"), F.pandas_udf(run, FINGERPRINT)(F.col("text")).alias("f"))
    return made.select("doc", "f.*")


def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(len(s), -1) for s in (a, b))
    return pd.Series((x == y).mean(axis=1) if len(a) else np.zeros(0))


def _linked(percent: int):
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hashes, last = _WordHashes(), (None, None)
        for left, right in batches:
            out = []
            for a, b in zip(left, right):
                if last[0] is not a and last[0] != a:
                    last = (a, shingle_set(a, hashes))
                other = shingle_set(b, hashes)
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                out.append(both > 0 and 100 * both >= percent * (len(last[1]) + len(other) - both))
            yield pd.Series(out, dtype=bool)

    return run


def _with_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with the texts ``t_a`` and ``t_b``, the pairs of one ``a`` side by side."""
    ids = landed_small(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct())
    texts = docs.select(order_id(F.col("doc_id")).alias("doc"), "text").join(ids, "doc")
    own = lambda k: texts.select(F.col("doc").alias(k), F.col("text").alias(f"t_{k}"))
    return pairs.join(own("b"), "b").join(own("a"), "a")


def verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, percent: int = PERCENT, agreement: float = LEAST_AGREEMENT) -> DataFrame:
    """Those of the candidate ``pairs`` (a, b) that are linked: first by sizes and signatures, then on full sets."""
    r = reps.select("doc", "n_shingles", "signature")
    side = lambda k: r.select(F.col("doc").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("signature").alias(f"s_{k}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    near = near.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    near = near.filter(F.pandas_udf(_agreement_udf, "double")("s_a", "s_b") >= agreement)
    likely = cut_lineage(near.select("a", "b").distinct())
    return _with_texts(likely, docs).filter(F.pandas_udf(_linked(percent), "boolean")("t_a", "t_b")).select("a", "b").distinct()


def _agreement_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return _agreement(a, b)


def _outside(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Sizes of the second set and of the intersection, and the second set without the first."""
    hashes, last = _WordHashes(), (None, None)
    for left, right in batches:
        rows = []
        for a, b in zip(left, right):
            if last[0] is not a and last[0] != a:
                last = (a, shingle_set(a, hashes))
            other = shingle_set(b, hashes)
            rest = np.setdiff1d(other, last[1], assume_unique=True)
            rows.append((len(other), len(other) - len(rest), rest.view(np.int64)))
        yield pd.DataFrame(rows, columns=["n", "both", "rest"])


def compared_with_anchors(reps: DataFrame) -> DataFrame:
    """``a, b``: the anchor of each bucket with every other member, a pair once over all buckets.

    The anchor is the member whose buckets hold most documents, of several the smallest doc.
    """
    rows = reps.select("doc", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = cut_lineage(rows.join(sizes, "key"))
    middle = members.groupBy("doc").agg(F.sum("size").alias("met"))
    ranked = members.select("key", "doc").join(middle, "doc")
    anchors = ranked.groupBy("key").agg(F.max(F.struct("met", -F.col("doc"))).alias("x")).select("key", (-F.col("x.col2")).alias("a"))
    pairs = cut_lineage(members.select("key", F.col("doc").alias("b")).join(anchors, "key").filter("a <> b").select("a", "b").distinct())
    drop_tables(members)
    return pairs


def beyond_anchors(compared: DataFrame, found: DataFrame, reps: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, b``: pairs of different components, both compared with one anchor, that its exact bounds leave open."""

    def need(x: Column, y: Column) -> Column:
        """Shingles that linked sets of these sizes share at least."""
        return F.ceil(percent * (x + y) / (100 + percent))

    sizes = reps.groupBy("doc").agg(F.min("n_shingles").alias("least"))
    labelled = compared.withColumnRenamed("a", "anchor").withColumnRenamed("b", "doc").join(found.withColumnRenamed("node", "doc"), "doc", "left")
    labelled = cut_lineage(labelled.withColumn("component", F.coalesce("component", "doc")))
    several = labelled.join(sizes, "doc").groupBy("anchor").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("least").alias("least"))
    open_ = labelled.join(several.filter("x < y").select("anchor", "least"), "anchor")
    texts = _with_texts(cut_lineage(open_.withColumnsRenamed({"anchor": "a", "doc": "b"})), docs)
    made = texts.withColumn("o", F.pandas_udf(_outside, "n long, both long, rest array<long>")("t_a", "t_b")).drop("t_a", "t_b")
    made = made.select(F.col("a").alias("anchor"), F.col("b").alias("doc"), "component", "least", "o.*")
    # a partner is no smaller than percent of n, and no smaller than any document compared with this anchor
    made = made.withColumn("must", need(F.col("n"), F.greatest(F.col("least"), F.ceil(percent * F.col("n") / 100))) - F.col("both"))
    made = cut_lineage(made.filter(F.size("rest") >= F.col("must")))

    rows = made.select("anchor", "doc", "component", "n", "both", F.greatest("must", F.lit(1)).alias("must"), F.explode("rest").alias("h"))
    for _ in range(PEELS):
        shared = rows.groupBy("anchor", "h").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("held"))
        rows = rows.drop("held").join(shared.filter("x < y").select("anchor", "h", "held"), ["anchor", "h"])
        enough = rows.groupBy("anchor", "doc").agg(F.count("*").alias("left"), F.min("must").alias("least")).filter("left >= least")
        rows = cut_lineage(rows.join(enough.select("anchor", "doc"), ["anchor", "doc"]))
    # of so many shared shingles one is among the rarest of each, when that many less one are left away
    bits = [
        F.bit_or(F.when(F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(WORDS - 1)) == w, F.expr("shiftleft(1L, cast(h & 63 AS int))")).otherwise(F.lit(0).cast("long"))).alias(f"w{w}")
        for w in range(WORDS)
    ]
    own = rows.groupBy("anchor", "doc", "component", "n").agg(
        F.array_sort(F.collect_list(F.struct("held", "h"))).alias("of"), F.min("must").alias("must"), F.max("both").alias("both"),
        F.count("*").alias("size"), *bits,
    )
    kept = ["anchor", "doc", "component", "n", "both", "size", *[f"w{w}" for w in range(WORDS)]]
    rare = own.select(*kept, F.explode(F.slice("of", F.lit(1), F.size("of") - F.col("must").cast("int") + 1)).alias("r"))
    rare = cut_lineage(rare.select(*kept, F.col("r.h").alias("h")))

    def meet(left: DataFrame, right: DataFrame, on: list[str], further: Column) -> DataFrame:
        x, y = left.alias("x"), right.alias("y")
        same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in on]
        similar = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
        pairs = x.join(y, [*same, F.col("x.component") != F.col("y.component"), similar, further])
        return pairs.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b"))

    def left_over(a: str, b: str) -> Column:
        """At most so many shingles outside of C do both have: a bit that only ``a`` has set is a shingle that only ``a`` has."""
        lone = sum((F.bit_count(F.col(f"{a}.w{w}").bitwiseAND(F.bitwise_not(F.col(f"{b}.w{w}")))) for w in range(1, WORDS)),
                   F.bit_count(F.col(f"{a}.w0").bitwiseAND(F.bitwise_not(F.col(f"{b}.w0")))))
        return F.col(f"{a}.size") - lone

    inside = made.filter("must <= 0").select("anchor", "doc", "component", "n", "both")  # they may be linked by shingles of C alone
    asked, of_anchor = need(F.col("x.n"), F.col("y.n")), F.least("x.both", "y.both")
    ordered = F.col("x.doc") < F.col("y.doc")
    outside = asked <= of_anchor + F.least(left_over("x", "y"), left_over("y", "x"))
    return meet(rare, rare, ["anchor", "h"], ordered & outside).unionByName(meet(inside, inside, ["anchor"], (asked <= of_anchor) & ordered)).distinct()


def near_components(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT) -> DataFrame:
    """``doc, n_shingles, component``, a row for each row of ``docs``; ids as of ``order_id``.

    Documents are linked at 100 * intersection >= ``percent`` * union of their
    five-word shingle sets, checked on the full sets. Texts without words are
    linked with nothing. Rows that repeat a doc_id are one document: it is
    linked with whatever one of them is; rows without one likewise.
    """
    prints = cut_lineage(fingerprints(docs, bands, rows))
    wide = F.struct("n_shingles", "signature", "bands")
    reps = cut_lineage(
        prints.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("doc").alias("doc"), F.min_by(wide, "doc").alias("f"))
        .select("digest", "doc", "f.*")
    )
    compared = compared_with_anchors(reps)
    links = cut_lineage(verified(compared, reps, docs, percent).unionByName(_same_doc(prints)))
    found = components(links)
    more = cut_lineage(verified(beyond_anchors(compared, found, reps, docs, percent), reps, docs, percent))
    if not more.isEmpty():
        found = components(links.unionByName(more))
    by_class = reps.select("digest", "doc").join(found.withColumnRenamed("node", "doc"), "doc", "left").select(
        "digest", F.coalesce("component", "doc").alias("of_class")
    )
    joined = prints.select("doc", "n_shingles", "digest").join(by_class, "digest", "left")
    return joined.select("doc", "n_shingles", F.coalesce("of_class", "doc").alias("component"))


def _same_doc(prints: DataFrame) -> DataFrame:
    """Links for a doc_id repeated with other texts: a class is named by its smallest doc_id, and such a document joins its classes."""
    own = prints.filter(F.col("digest").isNotNull())
    several = own.groupBy("doc").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).filter(F.col("x") != F.col("y")).select("doc")
    named = own.groupBy("digest").agg(F.min("doc").alias("name"))
    repeated = own.join(several, "doc").select("doc", "digest").distinct()
    return repeated.join(named, "digest").filter(F.col("doc") != F.col("name")).select(F.col("name").alias("a"), F.col("doc").alias("b"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document has the smallest doc_id of its component."""
    own = fresh_name(docs, "own")
    found = near_components(docs).filter(F.col("doc") == F.col("component")).select(F.col("doc").alias(own)).distinct()
    return docs.withColumn(own, order_id(F.col("doc_id"))).join(found, own, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


cloudpickle.register_pickle_by_value(sys.modules[__name__])
