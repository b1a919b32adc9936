"""Probabilistic automata learned from examples by merging compatible states.

The examples form a prefix tree with counts.  Walking from its root, each state is
merged with an earlier one when a Hoeffding bound can't tell their next-symbol and
end frequencies apart, all the way down (Carrasco and Oncina's state merging);
otherwise it is kept.  Random stretches of a format fold into loops, fixed ones stay.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass


@dataclass
class Automaton:
    """Per state: symbol -> (next state, log2 chance); log2 chance of ending."""

    steps: list[dict[str, tuple[int, float]]]
    ends: list[float]
    shortest: int
    longest: int

    def log2_likelihood(self, text: str) -> float:
        """-inf for what the automaton doesn't accept."""
        state, total = 0, 0.0
        for c in text:
            step = self.steps[state].get(c)
            if step is None:
                return -math.inf
            state = step[0]
            total += step[1]
        return total + self.ends[state]


class _Tree:
    def __init__(self, examples: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.here, self.end = [0], [0]
        for text in examples:
            at = 0
            self.here[0] += 1
            for c in text:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.here)
                    self.next.append({})
                    self.here.append(0)
                    self.end.append(0)
                at = self.next[at][c]
                self.here[at] += 1
            self.end[at] += 1
        #: times each state goes on with each symbol
        self.goes = [Counter({c: self.here[k] for c, k in step.items()}) for step in self.next]


def _alike(f: int, n: int, g: int, m: int, alpha: float) -> bool:
    return abs(f / n - g / m) < math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))


def _compatible(tree: _Tree, a: int, b: int, alpha: float) -> bool:
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        n, m = tree.here[a], tree.here[b]
        if not _alike(tree.end[a], n, tree.end[b], m, alpha):
            return False
        for c in tree.goes[a].keys() | tree.goes[b].keys():
            if not _alike(tree.goes[a][c], n, tree.goes[b][c], m, alpha):
                return False
            if c in tree.next[a] and c in tree.next[b]:
                x, y = tree.next[a][c], tree.next[b][c]
                if x != y and y not in (a, b) and x not in (a, b):
                    todo.append((x, y))
    return True


def _fold(tree: _Tree, into: int, tail: int) -> None:
    """Add the subtree ``tail`` to state ``into``."""
    todo = [(into, tail)]
    while todo:
        into, tail = todo.pop()
        tree.here[into] += tree.here[tail]
        tree.end[into] += tree.end[tail]
        tree.goes[into].update(tree.goes[tail])
        for c, child in tree.next[tail].items():
            if c in tree.next[into]:
                todo.append((tree.next[into][c], child))
            else:
                tree.next[into][c] = child


def learn(examples: list[str], alpha: float = 0.05) -> Automaton:
    tree = _Tree(sorted(examples))
    kept, parent = [0], {}
    while True:
        open_ = {(s, c): t for s in kept for c, t in tree.next[s].items() if t not in parent and t != 0}
        if not open_:
            break
        (source, symbol), state = max(open_.items(), key=lambda x: (tree.here[x[1]], x[0][1]))
        # the state before it first: random stretches become loops
        for other in dict.fromkeys([source, *reversed(kept)]):
            if _compatible(tree, other, state, alpha):
                tree.next[source][symbol] = other
                _fold(tree, other, state)
                break
        else:
            parent[state] = source
            kept.append(state)
    number = {s: i for i, s in enumerate(kept)}
    steps, ends = [], []
    for s in kept:
        n = tree.here[s]
        steps.append({c: (number[t], math.log2(tree.goes[s][c] / n)) for c, t in tree.next[s].items()})
        ends.append(math.log2(tree.end[s] / n) if tree.end[s] else -math.inf)
    sizes = [len(x) for x in examples]
    return Automaton(steps, ends, min(sizes), max(sizes))


class Background:
    """What ordinary tokens look like: chances of a character after the two before it, by
    counts of tokens, smoothed over one character less each time (Witten and Bell).  Half
    of each chance is uniform, so characters that these tokens lack are no evidence."""

    def __init__(self, tokens: list[str], alphabet: str, order: int = 2):
        self.order, self.floor = order, 1 / (len(set(alphabet)) + 1)
        self.seen: list[dict[str, Counter]] = [defaultdict(Counter) for _ in range(order + 1)]
        for token in tokens:
            padded = "\n" * order + token
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    self.seen[k][padded[i - k : i]][padded[i]] += 1
        self.total = [{c: (sum(n.values()), len(n)) for c, n in level.items()} for level in self.seen]
        self.known: dict[str, float] = {}

    def _log2(self, gram: str) -> float:
        """log2 chance of the last character of ``gram`` after those before it."""
        bits = self.known.get(gram)
        if bits is None:
            chance = self.floor
            for k in range(self.order + 1):
                context = gram[self.order - k : self.order]
                if (found := self.total[k].get(context)) is None:
                    break
                n, different = found
                chance = (self.seen[k][context][gram[-1]] + different * chance) / (n + different)
            self.known[gram] = bits = math.log2((chance + self.floor) / 2)
        return bits

    def log2_likelihood(self, text: str) -> float:
        padded, size = "\n" * self.order + text, self.order + 1
        return sum(self._log2(padded[i : i + size]) for i in range(len(text)))


def learn_all(labelled: list[tuple[str, str]], least: int = 20) -> dict[str, Automaton]:
    """One automaton for each label with at least ``least`` different examples."""
    by: dict[str, set[str]] = defaultdict(set)
    for label, text in labelled:
        by[label].add(text)
    return {k: learn(list(v)) for k, v in sorted(by.items()) if len(v) >= least}
