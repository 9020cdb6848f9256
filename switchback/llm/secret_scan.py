"""Secret scans: fixed patterns, plus what automata inferred from their matches find likely.

The matches of the fixed patterns in the corpus are the labelled credentials. A
prefix tree of each kind is merged into a probabilistic automaton, and every
long run of token signs anywhere is scored by the likelihood of its format
against that of ordinary runs, those that recur, whose pairs of signs are counted
over all documents.
"""

from __future__ import annotations

import itertools
import math
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchback.llm.automata import Automaton, Background
from switchback.llm.common import short_batches
from switchback.session import cut_lineage

#: What a base match is. Letters of names match in either case.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "format")
#: What is scored: runs of token signs.
CANDIDATE = r"[A-Za-z0-9+/_-]{12,}={0,2}"

#: A candidate is what base spans leave of such a run, of so many signs or more.
LEAST_CANDIDATE = 12
#: About so many distinct credentials of a kind are fitted on, those of smallest hash; longer ones are cut in pieces of PIECE signs,
#: each a credential of its own. Everything is scored.
SAMPLE, PIECE = 1500, 256
#: A candidate is a secret if its likelihood as a credential against that as an ordinary run is beyond what this share of
#: ordinary runs reach.
FALSE_POSITIVES = 0.001
#: Scores of ordinary runs are counted in steps of this many nats.
STEP = 0.5
#: Remembered signs of all candidates; a full memo is emptied.
MEMO_SIGNS = 4_000_000

_ASSIGN = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 signs or more is matched whole, others never
_CANDIDATE = re.compile(CANDIDATE)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base matches, leftmost and non-overlapping in each kind."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def pieces(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the candidates: runs of token signs without what ``spans`` cover."""
    out, taken, k = [], sorted((s, e) for _, s, e in spans), 0
    for m in _CANDIDATE.finditer(text):
        start, stop = m.span()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        for s, e in itertools.takewhile(lambda t: t[0] < stop, itertools.islice(taken, k, None)):
            if s - start >= LEAST_CANDIDATE:
                out.append((start, s))
            start = max(start, e)
        if stop - start >= LEAST_CANDIDATE:
            out.append((start, stop))
    return out


class Formats:
    """Automata of the labelled kinds against the background of ordinary runs, of counted ``pairs`` of signs.

    ``least_nats`` is what a candidate's score has to reach; it is part of the
    model, so that workers decide as the driver does.
    """

    def __init__(self, labelled: dict[str, list[str]], pairs: dict[tuple[str, str], int] | list[str], least_nats: float = 0.0):
        self.background, self.least_nats = Background(pairs), least_nats
        self.models = [Automaton(labelled[kind]) for kind in KINDS if labelled.get(kind)]

    def score(self, s: str) -> float:
        """How many nats likelier ``s`` is as the likeliest credential than as an ordinary run."""
        return max(m.log_likelihood(s) for m in self.models) - self.background.log_likelihood(s)

    def is_secret(self, s: str) -> bool:
        return self.score(s) > self.least_nats


class Scanner:
    def __init__(self, formats: Formats | None):
        self.formats, self.memo, self.signs = formats, {}, 0

    def _secret(self, s: str) -> bool:
        known = self.memo.get(s)
        if known is None:
            if self.signs > MEMO_SIGNS:
                self.memo.clear()
                self.signs = 0
            known = self.memo[s] = self.formats.is_secret(s)
            self.signs += len(s)
        return known

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """Base spans and the candidates beside them that score as secrets, by start and kind."""
        found = base_spans(text)
        if self.formats and self.formats.models:
            found += [("format", s, e) for s, e in pieces(text, found) if self._secret(text[s:e])]
        return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def labelled_strings(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``kind, value``: of each kind about ``sample`` distinct base matches, by hash; long ones in pieces.

    All documents are searched and all distinct pieces counted; those are taken
    whose hash lies in the first ``sample`` parts of so many of its range.
    """
    text = F.coalesce("text", F.lit(""))
    cut = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.char_length(v) - 1) / PIECE).cast("int")), lambda i: F.substring(v, i * PIECE + 1, F.lit(PIECE)))
    of = lambda kind, found: F.transform(
        F.flatten(F.transform(F.filter(found, lambda v: F.char_length(v) >= LEAST[kind]), cut)), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    )
    both = F.concat(
        of("assign", F.regexp_extract_all(text, F.lit("(?i)" + ASSIGN), F.lit(2))),
        of("access", F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0))),
        of("hex", F.regexp_extract_all(text, F.lit(_HEX.pattern), F.lit(0))),
    )
    distinct = cut_lineage(docs.select(F.explode(both).alias("x")).select("x.*").distinct())
    counts = distinct.groupBy("kind").agg(F.count("*").alias("n"))  # a row a kind
    share = F.pmod(F.xxhash64("value"), F.lit(1_000_000)) / 1e6
    return distinct.join(F.broadcast(counts), "kind").filter(share * F.col("n") < sample).select("kind", "value")


def ordinary_runs(docs: DataFrame) -> DataFrame:
    """``value, n``: the candidates of all documents and how often each occurs. Base matches are cut out of them."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter = Counter()
            for text in batch["text"]:
                found.update(text[s:e] for s, e in pieces(text, base_spans(text)))
            yield pd.DataFrame({"value": list(found), "n": list(found.values())})

    texts = short_batches(docs).select(F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(find, "value string, n long").groupBy("value").agg(F.sum("n").alias("n"))


def ordinary_pairs(runs: DataFrame) -> DataFrame:
    """``a, b, n``: how often sign ``b`` follows ``a`` in the distinct ``runs``, ``^`` before the first sign.

    At most as many rows as pairs of token signs, whatever the size of ``runs``.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs: Counter = Counter()
        for batch in batches:
            for s in batch["value"]:
                pairs.update(zip("^" + s, s))
        yield pd.DataFrame([(a, b, n) for (a, b), n in pairs.items()], columns=["a", "b", "n"])

    return runs.select("value").mapInPandas(count, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, sample: int = SAMPLE, false_positives: float = FALSE_POSITIVES) -> Formats:
    """Fits the automata on the driver, on about ``sample`` credentials of a kind, the pairs of ordinary runs and their scores.

    Ordinary are all runs that occur more than once in the corpus: words recur,
    unlabelled credentials as a rule do not. The score a secret has to pass is
    the smallest that at most ``false_positives`` of ordinary runs, counted as
    often as they occur, are beyond, and at least the one that outweighs such odds against it. Without credentials
    there are no automata and only base spans are found.
    """
    strings: dict[str, list[str]] = {}
    for row in sorted(labelled_strings(docs, sample).collect()):
        strings.setdefault(row["kind"], []).append(row["value"])
    runs = cut_lineage(ordinary_runs(docs).filter("n > 1"))
    formats = Formats(strings, {(r["a"], r["b"]): r["n"] for r in ordinary_pairs(runs).collect()})
    if not formats.models:
        return formats
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(formats))

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = cloudpickle.loads(shared.value)
        for batch in batches:
            steps: Counter = Counter()
            for s, n in zip(batch["value"], batch["n"]):
                score = fitted.score(s)
                steps[max(0, math.ceil(score / STEP))] += n
            yield pd.DataFrame({"step": list(steps), "n": list(steps.values())})

    counted = {r["step"]: r["n"] for r in runs.mapInPandas(scores, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).collect()}
    allowed, beyond = false_positives * sum(counted.values()), 0
    least = -math.log(false_positives)
    for step in sorted(counted, reverse=True):
        beyond += counted[step]
        if beyond > allowed:
            least = max(least, step * STEP)
            break
    formats.least_nats = least
    return formats


def scan(docs: DataFrame, formats: Formats | None, spans: str = "spans") -> DataFrame:
    """Every row of ``docs`` with ``spans``, array<struct<kind, start, end>> in code points, end exclusive.

    Null and empty texts have none. A column of that name is replaced, all
    others stay; repeated rows get equal spans. Without ``formats`` only base
    spans are found. Each text is scanned whole, however long, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(formats))  # by value, with its thresholds

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(cloudpickle.loads(shared.value))
        for batch in batches:
            yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in scanner.spans(t or "")] for t in batch], dtype=object)

    kind = "array<struct<kind:string,start:int,end:int>>"
    return short_batches(docs).withColumn(spans, F.pandas_udf(run, kind)(F.col("text")))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span replaced; overlapping spans are replaced as one."""
    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        new = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(new.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
