"""Probabilistic automata inferred from strings: a prefix tree whose statistically compatible states are merged."""

from __future__ import annotations

import math
import sys
from collections import Counter

from pyspark import cloudpickle


#: Signs a token can hold, and the share of a state's probability that signs never met there have together.
#: Credentials of alphabets that no label shows pass through it, by many more signs than an ordinary run would need.
TOKEN_SIGNS, ESCAPE = 68, 0.05
#: Pairs that a first sign has beside those met, so that few met ones tell little.
BACK_OFF = 50.0


class Automaton:
    """States with counts of arrivals, ends and symbols. State 0 is the start."""

    def __init__(self, strings: list[str], alpha: float = 0.01):
        self.arrived, self.ended, self.out = [0], [0], [{}]  # out: symbol -> [state, count]
        for s in strings:
            self._insert(s)
        self._merge(math.sqrt(0.5 * math.log(2 / alpha)))
        self._number()

    def _insert(self, s: str) -> None:
        at = 0
        self.arrived[0] += 1
        for c in s:
            edge = self.out[at].get(c)
            if edge is None:
                self.arrived.append(0)
                self.ended.append(0)
                self.out.append({})
                edge = self.out[at][c] = [len(self.out) - 1, 0]
            edge[1] += 1
            at = edge[0]
            self.arrived[at] += 1
        self.ended[at] += 1

    def _differ(self, x: int, n: int, y: int, m: int, bound: float) -> bool:
        """Hoeffding: whether x of n and y of m are unlikely to be one frequency."""
        return abs(x / n - y / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            n, m = self.arrived[x], self.arrived[y]
            if min(n, m) <= bound * bound:  # too few to tell anything apart, and so all below them
                continue
            if self._differ(self.ended[x], n, self.ended[y], m, bound):
                return False
            for c in self.out[x].keys() | self.out[y].keys():
                p, q = self.out[x].get(c, (None, 0)), self.out[y].get(c, (None, 0))
                if self._differ(p[1], n, q[1], m, bound):
                    return False
                if p[1] and q[1]:
                    todo.append((p[0], q[0]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        todo = [(into, tree)]
        while todo:
            x, y = todo.pop()
            self.arrived[x] += self.arrived[y]
            self.ended[x] += self.ended[y]
            for c, (child, count) in self.out[y].items():
                edge = self.out[x].get(c)
                if edge is None:
                    self.out[x][c] = [child, count]
                else:
                    edge[1] += count
                    todo.append((edge[0], child))

    def _merge(self, bound: float) -> None:
        settled, known = [0], {0}
        while True:
            # the border: successors of settled states that are not settled, most visited first
            border = [(-self.arrived[e[0]], x, c) for x in settled for c, e in self.out[x].items() if e[0] not in known]
            if not border:
                return
            _, x, c = min(border)
            state = self.out[x][c][0]
            for other in settled:
                if self._compatible(other, state, bound):
                    self.out[x][c][0] = other
                    self._fold(other, state)
                    break
            else:
                settled.append(state)
                known.add(state)

    def _number(self) -> None:
        """Keeps reachable states, with log probabilities; a share of each state's goes evenly to all token signs."""
        order, place = [0], {0: 0}
        for x in order:
            for state, _ in self.out[x].values():
                if state not in place:
                    place[state] = len(order)
                    order.append(state)
        escape = ESCAPE / TOKEN_SIGNS
        self.steps, self.likely = [], []
        for x in order:
            on = sum(n for _, n in self.out[x].values())
            self.steps.append({c: (place[s], math.log((1 - ESCAPE) * n / on + escape)) for c, (s, n) in self.out[x].items() if n})
            best = max(self.out[x].values(), key=lambda e: e[1], default=(0, 0))[0]
            self.likely.append(place.get(best, 0))
        self.unseen = math.log(escape)
        del self.arrived, self.ended, self.out

    def log_likelihood(self, s: str) -> float:
        """Of the signs of ``s`` one after the other, wherever it ends."""
        at, total = 0, 0.0
        for c in s:
            step = self.steps[at].get(c)
            if step is None:
                total += self.unseen
                at = self.likely[at]
            else:
                at, p = step
                total += p
        return total


class Background:
    """Pairs of adjacent signs in ordinary candidates; each first sign has BACK_OFF pairs more, dealt as all signs are.

    ``ordinary``: the candidates, or how often each pair is in them.
    """

    def __init__(self, ordinary: list[str] | dict[tuple[str, str], int]):
        pairs = ordinary if isinstance(ordinary, dict) else Counter(p for s in ordinary for p in zip("^" + s, s))
        firsts, signs = Counter(), Counter()
        for (a, b), n in pairs.items():
            firsts[a] += n
            signs[b] += n
        total = sum(signs.values()) + 0.5 * TOKEN_SIGNS
        self.share = {b: (n + 0.5) / total for b, n in signs.items()}
        self.unseen = 0.5 / total
        self.firsts = firsts
        self.pairs = {(a, b): math.log((n + BACK_OFF * self.share[b]) / (firsts[a] + BACK_OFF)) for (a, b), n in pairs.items()}

    def log_likelihood(self, s: str) -> float:
        total = 0.0
        for a, b in zip("^" + s, s):
            p = self.pairs.get((a, b))
            total += math.log(BACK_OFF * self.share.get(b, self.unseen) / (self.firsts[a] + BACK_OFF)) if p is None else p
        return total


cloudpickle.register_pickle_by_value(sys.modules[__name__])
