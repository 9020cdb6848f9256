"""Toxicity: a learned lexicon, Levenshtein automata over its trie, and context windows.

Terms are words and word beginnings that labelled toxic texts hold far more
often than others. A word of a text is read by the automaton of all terms with
their misspellings: states are sets of trie nodes with the edits spent so far,
made once when first met. Hits count as quotation or as abuse by the words and
quotation marks around them.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchback.llm.common import held_out, short_batches
from switchback.session import cut_lineage

#: Labelled texts of each label that lexicon and weights are learned on, those of smallest hash. Shares of terms and the
#: score's constant are corrected by how many of each label there are in all.
SAMPLE = 7500
#: A term is held by so many toxic texts, and by this many times the share of toxic texts as of clean ones, by the lower bound
#: of a 95 % interval in the sample. A rare label asks for more: LEAST_SHARE of all its texts are toxic.
LEAST_TEXTS, LEAST_SHARE = 8, 0.5
#: Texts with a term the sample may hold by chance; a term of no clean text there counts as in half a one.
CHANCE = 0.5
STEM_CHARS = (4, 12)
WORD = r"[\p{L}\p{N}]+"
SIGNS = "*@$"
_WORD = re.compile(r"[*@$]*\w+(?:[*@$]+\w+)*")
WINDOW = 8
#: What a misspelled hit and a quoted one count against an exact one. Labels hold too few of them to learn it.
MISSPELLED, QUOTED = 0.7, 0.15
#: From this weight on (of 55 texts with the term at most one is clean) terms may be misspelled at the first letter,
#: with four letters, and beside a beginning of theirs. Weaker terms would take too many ordinary words with them.
RARE_WEIGHT = 4.0
#: Words near a term that so many clean texts hold, and toxic ones no more often, are no misspellings of it.
ORDINARY_TEXTS = 3
#: Evidence beyond which a text is no more toxic.
MOST = 8.0
MEMO, MEMO_CHARS = 300_000, 40

#: Signs and words that mark quotation near a hit, and words that address someone.
QUOTES = "\"“”„«»‘’"
REPORTING = frozenset(
    "said says say called calls quote quoted quotes wrote writes word words term slur insult insults sagte sagt nannte zitat wort "
    "dit disait citation mot dijo dice cita palabra llamado".split()
)
ADDRESSING = frozenset("you your youre u ur du dich dir dein deine tu te ton ta toi vous votre eres tus usted".split())


def edits_allowed(chars: int) -> int:
    return 0 if chars < 5 else 1 if chars < 9 else 2


class LexiconAutomaton:
    """Reads words and finds the term they are, begin with, or misspell.

    ``terms``: (text, whether it is a beginning, weight). Terms of weight 0 are
    ordinary words and read without edits. The first sign has to be right
    unless ``first_edits``. ``hit(word)``: (weight, edits) of the best term, or None.
    """

    def __init__(self, terms: list[tuple[str, bool, float]], first_edits: bool = False):
        self.first_edits = first_edits
        self.children: list[dict[str, int]] = [{}]
        self.words: list[tuple[int, float] | None] = [None]
        self.stems: list[tuple[int, float] | None] = [None]
        self.reach = [0]
        for text, stem, weight in terms:
            allowed = edits_allowed(len(text) - (2 if stem else 0))
            if len(text) == 4 and not stem and weight >= RARE_WEIGHT:
                allowed = 1
            if not weight:
                allowed = 0
            at = 0
            self.reach[0] = max(self.reach[0], allowed if first_edits else 0)
            for c in text:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.words.append(None)
                    self.stems.append(None)
                    self.reach.append(0)
                at = self.children[at][c]
                self.reach[at] = max(self.reach[at], allowed)
            ends = self.stems if stem else self.words
            ends[at] = max(ends[at] or (0, 0.0), (allowed, weight), key=lambda e: e[1])
        self.states: dict = {}
        self.start = self._state({0: 0}, None)
        self.dead = self._state({}, None)

    def _state(self, nodes: dict[int, int], found: tuple[int, float] | None) -> tuple:
        """(nodes with edits, best beginning so far, result at a word's end, transitions)."""
        todo = list(nodes.items())
        while todo:  # a sign of the term left out
            node, edits = todo.pop()
            if edits < self.reach[node]:
                for child in self.children[node].values():
                    if edits + 1 <= self.reach[child] and nodes.get(child, 9) > edits + 1:
                        nodes[child] = edits + 1
                        todo.append((child, edits + 1))
        for node, edits in nodes.items():
            stem = self.stems[node]
            if stem and edits <= stem[0]:
                found = min(found or (9, 0.0), (edits, -stem[1]))
        result = found
        for node, edits in nodes.items():
            word = self.words[node]
            if word and edits <= word[0]:
                result = min(result or (9, 0.0), (edits, -word[1]))
        return (nodes, found, result, {})

    def _next(self, state: tuple, c: str) -> tuple:
        nodes: dict[int, int] = {}
        for node, edits in state[0].items():
            child = self.children[node].get(c)
            if child is not None and edits <= self.reach[child]:
                nodes[child] = min(nodes.get(child, 9), edits)
            if edits < self.reach[node]:
                nodes[node] = min(nodes.get(node, 9), edits + 1)
                for child in self.children[node].values():
                    if edits + 1 <= self.reach[child]:
                        nodes[child] = min(nodes.get(child, 9), edits + 1)
        if not nodes and state[1] is None:
            return self.dead
        made = self._state(nodes, state[1])
        key = (frozenset(made[0].items()), made[1])
        return self.states.setdefault(key, made)

    def hit(self, word: str) -> tuple[float, int] | None:
        state = self.start
        for c in word:
            following = state[3].get(c)
            if following is None:
                following = state[3][c] = self._next(state, c)
            state = following
            if state is self.dead:
                return None
        return None if state[2] is None else (-state[2][1], state[2][0])


def reader(terms: list[tuple[str, bool, float]]):
    """``hit`` of all terms, those of RARE_WEIGHT with edits at the first letter; fewest edits first, then the largest weight."""
    rare = [t for t in terms if not t[2] or t[2] >= RARE_WEIGHT]
    both = [LexiconAutomaton(rare, first_edits=True), LexiconAutomaton([t for t in terms if 0 < t[2] < RARE_WEIGHT])]

    def hit(word: str) -> tuple[float, int] | None:
        return min((h for h in (a.hit(word) for a in both) if h), key=lambda h: (h[1], -h[0]), default=None)

    return hit


class _Hits(dict):
    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, word: str):
        found = self.find(word)
        if len(word) <= MEMO_CHARS:  # so the memo's bytes have a bound too
            if len(self) > MEMO:
                self.clear()
            self[word] = found
        return found


class Scorer:
    """Features of a text and, with fitted weights, its score."""

    def __init__(self, terms: list[tuple[str, bool, float]], weights: list[float] | None = None):
        self.hit = reader(terms)
        self.weights, self.memo = weights, _Hits(self.find)

    def find(self, word: str) -> tuple[float, int] | None:
        """The hit of a word without the signs before it, or with them if it is an ordinary word then, as in ``$lime``."""
        bare = word.lstrip(SIGNS)
        found = self.hit(bare)
        if found and not found[0] and bare != word and word[0] != "*":  # stars are emphasis too
            found = self.hit(word)
        return found if found and found[0] else None

    def features(self, text: str) -> list[float]:
        """Evidence up to MOST, the summed weights of hits by what they count, and whether an unquoted hit addresses someone."""
        low = text.lower()
        distinct = set(_WORD.findall(low))
        hits = {w: h for w, h in zip(distinct, map(self.memo.__getitem__, distinct)) if h is not None}
        if not hits:
            return [0.0, 0.0]
        places = [(m.start(), m.end(), m[0]) for m in _WORD.finditer(low)]
        evidence = addressed = 0.0
        for i, (start, end, word) in enumerate(places):
            if word not in hits:
                continue
            weight, edits = hits[word]
            around = places[max(0, i - WINDOW) : i + WINDOW + 1]
            words = {w for _, _, w in around}
            marks = [sum(map(low[a:b].count, QUOTES)) for a, b in ((around[0][0], start), (end, around[-1][1]))]
            quoted = (marks[0] % 2 and marks[1] > 0) or bool(words & REPORTING)
            evidence += weight * (MISSPELLED if edits else 1.0) * (QUOTED if quoted else 1.0)
            if not quoted and words & ADDRESSING:
                addressed = 1.0
        return [min(evidence, MOST), addressed]

    def score(self, text: str) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """``text, toxic`` of at most ``sample`` rows of each label outside the held-out fold, landed, and how many of each there are in all."""
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    first = lambda label: known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = F.broadcast(first(0).unionByName(first(1)))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return cut_lineage(texts.join(chosen, "doc_id").select("text", "toxic")), totals


def term_counts(labelled: DataFrame) -> DataFrame:
    """``term, a, b``: how many toxic and clean texts of the sample hold a word; landed."""
    words = labelled.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("term"))
    return cut_lineage(words.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")))


def label_counts(labelled: DataFrame) -> dict[int, int]:
    return {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}


def learn_terms(labelled: DataFrame) -> list[tuple[str, bool, float]]:
    """The terms of ``text, toxic`` rows that stand for themselves alone."""
    sampled = label_counts(labelled)
    return terms_of_counts(term_counts(labelled), sampled, sampled)


def terms_of_counts(counted: DataFrame, sampled: dict[int, int], totals: dict[int, int]) -> list[tuple[str, bool, float]]:
    """Words and beginnings of words that tell toxic texts, with how far each rules out a clean text as its weight.

    ``counted`` are counts in a sample; a clean text of it stands for
    ``totals[0] / sampled[0]`` of all, a toxic one likewise. A term is left out if
    a shorter beginning of it tells as much. Words of RARE_WEIGHT stay, since
    beginnings are allowed fewer edits or none.
    """
    if not sampled.get(0) or not sampled.get(1):
        return []
    up = {k: totals[k] / sampled[k] for k in (0, 1)}
    least, most = STEM_CHARS
    stems = counted.filter(F.char_length("term") > least).select(
        F.explode(F.transform(F.sequence(F.lit(least), F.least(F.char_length("term") - 1, F.lit(most))), lambda n: F.substring("term", F.lit(1), n))).alias("term"),
        "a", "b",
    ).groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("words")).filter("words >= 3").drop("words")
    both = counted.withColumn("stem", F.lit(False)).unionByName(stems.withColumn("stem", F.lit(True)))
    # shares in a sample of the labels' true shares, of as many texts as were seen
    a, b = F.col("a") * up[1], F.col("b") * up[0]
    share, n = a / (a + b), F.col("a") + F.col("b")
    low = (share + 1.92 / n - 1.96 * F.sqrt(share * (1 - share) / n + 0.9604 / (n * n))) / (1 + 3.84 / n)
    # of the texts of a label, how many hold the term: toxic ones against clean ones, none seen counted as CHANCE
    weight = F.log((a + b + up[1]) / (b + CHANCE * up[0]))
    enough = (F.col("a") >= LEAST_TEXTS) & (F.col("a") * sampled[0] > F.col("b") * sampled[1])
    rows = both.filter(enough & (low >= LEAST_SHARE)).select("term", "stem", low.alias("low"), weight.alias("weight")).collect()
    kept: dict[str, float] = {}
    out = []
    for r in sorted(rows, key=lambda r: (not r["stem"], len(r["term"]), r["term"])):
        shorter = max((kept[r["term"][:k]] for k in range(1, len(r["term"]) + 1) if r["term"][:k] in kept), default=None)
        if shorter is None or r["low"] > shorter + 0.05 or not r["stem"] and r["weight"] >= RARE_WEIGHT:
            if r["stem"]:
                kept[r["term"]] = r["low"]
            out.append((r["term"], r["stem"], max(0.1, float(r["weight"]))))
    return out


def ordinary_words(counted: DataFrame, sampled: dict[int, int], terms: list[tuple[str, bool, float]]) -> list[tuple[str, bool, float]]:
    """Words of clean labelled texts that would be read as misspellings, as terms of weight 0."""
    common = counted.filter((F.col("b") >= ORDINARY_TEXTS) & (F.col("a") * sampled[0] <= F.col("b") * sampled[1])).select("term")
    find = reader(terms)
    return sorted((r["term"], False, 0.0) for r in common.collect() if (hit := find(r["term"])) and hit[1])


def fit_weights(features: np.ndarray, toxic: np.ndarray, rounds: int = 30, ridge: float = 1.0) -> list[float]:
    """Logistic regression by Newton's method on the bounded sample."""
    x = np.hstack([np.ones((len(features), 1)), features])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = ridge * np.r_[0.0, np.ones(len(w) - 1)]
        slope = x.T @ (toxic - p) - penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        w = w + np.linalg.solve(curve, slope)
    return [float(v) for v in w]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[tuple[str, bool, float]], list[float]]:
    """Terms and weights, with one scan of ``docs``. Without both labels there are no terms and every text scores 0.5 or below.

    What a misspelled and a quoted hit count is fixed, not learned.
    """
    labelled, totals = labelled_sample(docs, labels, sample)
    sampled = label_counts(labelled)
    counted = term_counts(labelled)
    terms = terms_of_counts(counted, sampled, totals)
    if not terms:
        return [], [-2.0, 0.0, 0.0]
    terms += ordinary_words(counted, sampled, terms)
    made = labelled.select("toxic", F.pandas_udf(_features(docs, terms), "array<double>")("text").alias("x")).collect()
    weights = fit_weights(np.array([r["x"] for r in made]), np.array([r["toxic"] for r in made], float))
    # the sample shows labels in other shares than they have; only the constant depends on that
    constant = weights[0] + math.log(totals[1] / sampled[1]) - math.log(totals[0] / sampled[0])
    return terms, [constant, *(max(0.0, w) for w in weights[1:])]  # a hit never speaks against toxicity


def _features(df: DataFrame, terms: list):
    shared = df.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield pd.Series([scorer.features(t or "") for t in batch], dtype=object)

    return run


def score(docs: DataFrame, model: tuple[list, list[float]], out: str = "score") -> DataFrame:
    """Every row of ``docs`` with ``score``, 0 to 1, from the whole text alone; null texts are empty.

    A column of that name is replaced; rows stay as they are, repeated ones
    with equal scores, no shuffle. A text of any length a row can hold is read
    whole, word by word.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            yield pd.Series([scorer.score(t or "") for t in batch], dtype="float64")

    return short_batches(docs).withColumn(out, F.pandas_udf(run, "double")(F.col("text")))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
