"""Quality rules from suffix arrays: how much of a text repeats, and the longest repeat.

The words of a batch of texts are numbered per text, so suffixes of different
texts never share a first word and one suffix array serves the whole batch. It
is built by prefix doubling; a suffix that has become unique is not sorted
again. One walk in text order gives the longest common prefixes of neighbours.
A maximal repeat is an interval of that array, and its occurrences
are the positions whose longer neighbour prefix reaches its length, so the
union of all spans is the union of those prefixes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchback.llm.common import fresh_name, short_batches

SYMBOLS = "#*$%&|<>"
WHITE = "\t\n\x0b\x0c\r "
#: Words whose suffixes are sorted together; a longer text is a batch of its own.
BATCH_WORDS = 200_000

#: Base rules.
MIN_WORDS, MOST_REPEATED_PERCENT, WINDOW = 50, 50, 3
#: The verdict: repeats count from so many words on; the share of words they may cover, and the share the longest may be.
REPEAT_WORDS, MOST_COVERED, MOST_LONGEST = 5, 0.4, 0.25

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_covered long, longest_repeat long"
)


def prefix_ranks(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Two ranks of positions: equal while the next ``least`` symbols or fewer are equal (the largest power of two), and unique ones.

    A rank is the place of its group's first suffix among all sorted suffixes,
    so splitting a group leaves the ranks of others as they are.
    """
    n = len(symbols)
    _, inverse, counts = np.unique(symbols, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse].astype(np.int32)
    active = np.flatnonzero(counts[inverse] > 1)
    step, group = 1, rank.copy()
    while len(active):
        ahead = active + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        order = np.lexsort((second, rank[active]))
        at, head, second = active[order], rank[active][order], second[order]
        opens = np.ones(len(at), bool)
        opens[1:] = head[1:] != head[:-1]
        splits = opens.copy()
        splits[1:] |= second[1:] != second[:-1]
        index = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(opens, index, 0))
        part = np.maximum.accumulate(np.where(splits, index, 0))
        rank[at] = head + (part - begin)
        width = np.diff(np.append(np.flatnonzero(splits), len(at)))
        active = np.sort(at[np.repeat(width > 1, width)])
        step *= 2
        if step <= least:
            group = rank.copy()
    return group, rank


def common_prefixes(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of suffixes ``b`` and those sorted just before them, ``a``.

    In text order a length is at most one less than the one before, so all
    comparisons together are linear in the text.
    """
    signs, n = symbols.tolist(), len(symbols)
    order = np.argsort(b)
    out, last, length = [], -2, 0
    for p, q in zip(b[order].tolist(), a[order].tolist()):
        length = length - 1 if p == last + 1 and length else 0
        top = n - max(p, q)
        while length < top and signs[p + length] == signs[q + length]:
            length += 1
        out.append(length)
        last = p
    lengths = np.empty(len(b), np.int64)
    lengths[order] = out
    return lengths


def longest_repeats(symbols: np.ndarray, least: int) -> np.ndarray:
    """For each position the length of the longest substring from there that also begins elsewhere; 0 below ``least``.

    Symbols of different texts must differ.
    """
    n = len(symbols)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    group, rank = prefix_ranks(symbols, least)
    members = np.flatnonzero(np.bincount(group, minlength=n)[group] > 1)
    if not len(members):
        return out
    members = members[np.argsort(rank[members], kind="stable")]
    a, b = members[:-1], members[1:]
    together = group[a] == group[b]
    a, b = a[together], b[together]
    shared = common_prefixes(symbols, a, b)
    shared[shared < least] = 0
    np.maximum.at(out, a, shared)
    np.maximum.at(out, b, shared)
    return out


def covered(lengths: np.ndarray) -> np.ndarray:
    """Which positions the spans [p, p + lengths[p]) cover."""
    n = len(lengths)
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(lengths)
    edges[starts] += 1
    np.subtract.at(edges, starts + lengths[starts], 1)
    return np.cumsum(edges[:n]) > 0


def repeats_of(texts: list[list[bytes]], window: int, least: int) -> list[tuple[int, int, int]]:
    """Per text: words in repeated windows, words in repeats of ``least`` words or more, longest repeat."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes: dict[bytes, int] = {}
    flat = np.fromiter((codes.setdefault(w, len(codes)) for t in texts for w in t), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    lengths = longest_repeats(owner * max(1, len(codes)) + flat, min(window, least))
    long = np.where(lengths >= least, lengths, 0)
    windows = np.bincount(owner, covered(np.where(lengths >= window, window, 0)), len(texts))
    spans = np.bincount(owner, covered(long), len(texts))
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, owner, long)
    return [(int(w), int(s), int(m)) for w, s, m in zip(windows, spans, most)]


def text_stats(texts: list[str], window: int = WINDOW, least: int = REPEAT_WORDS) -> list[tuple[int, ...]]:
    """The columns of STATS for each text."""
    out, waiting, waiting_words = [], [], 0
    base = []

    def flush():
        nonlocal waiting, waiting_words
        out.extend(repeats_of(waiting, window, least))
        waiting, waiting_words = [], 0

    for text in texts:
        words = text.encode("utf-8", "surrogatepass").split()  # at ASCII white space only
        lines = [x for x in text.split("\n") if x.strip(WHITE)]
        base.append((len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))))
        if waiting and waiting_words + len(words) > BATCH_WORDS:
            flush()
        waiting.append(words)
        waiting_words += len(words)
    flush()
    return [(*b, *r) for b, r in zip(base, out)]


def _stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in STATS.split(", ")]
    for batch in batches:
        yield pd.DataFrame(text_stats([t or "" for t in batch]), columns=names, dtype="int64")


def quality(docs: DataFrame, most_covered: float = MOST_COVERED, most_longest: float = MOST_LONGEST, out: str = "quality") -> DataFrame:
    """Every row of ``docs`` with a struct ``quality``: the counts of STATS, ``base_failed`` and ``kept``.

    A text that passes the base rules is kept unless its repeats of REPEAT_WORDS
    words or more cover over ``most_covered`` of it, or the longest one is over
    ``most_longest`` of it. Null and empty texts have no words and fail. A text
    of any length a row can hold is judged whole; its suffixes take memory of a
    small multiple of its words. Rows and other columns stay; a column of the
    struct's name is replaced; every text is judged by itself, so repeated rows
    get equal verdicts and no shuffle is needed.
    """
    made = fresh_name(docs, "made", out)
    s = F.col(made)
    n = s["n_words"]
    failed = (n < MIN_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEATED_PERCENT * n)
    good = (s["n_covered"] <= most_covered * n) & (s["longest_repeat"] <= most_longest * n)
    fields = [s[c.split()[0]].alias(c.split()[0]) for c in STATS.split(", ")]
    struct = F.struct(*fields, failed.alias("base_failed"), (~failed & good).alias("kept"))
    return short_batches(docs).withColumn(made, F.pandas_udf(_stats, STATS)(F.col("text"))).withColumn(out, struct).drop(made)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
