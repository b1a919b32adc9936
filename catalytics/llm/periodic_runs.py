"""Periodic runs of words by suffix-tree longest common extensions (operator 13).

A run is a stretch of words with smallest period q, at least ``max(SHORTEST, REPEATS * q)``
words long, that no neighbouring word extends with that period.  For each text:

1. Words become numbers, and the text is cut to the stretches that can hold a run
   (``stretches``): inside a run every three words in a row occur ``REPEATS - 1`` times
   or more, so what lies outside such triples is in no run.  This cut is exact.
2. Ukkonen's algorithm builds the suffix trees of a stretch and of its reversal.
3. An Euler tour of a tree gives the order of its leaves and, between leaves next to
   each other, the depth of the lowest node passed.  Minima over ranges of those depths
   come from a sparse table, so the lowest common ancestor of two leaves, hence the
   longest common extension of two places, takes constant time, forwards and backwards.
4. The longest Lyndon word at each place, for the order of the words and for the reversed
   order, is the root of a run, if one starts there: it ends at the next smaller suffix,
   which the order of the leaves gives.  Every run has such a root, so extending each of
   these 2n candidates in both directions finds all runs.

A map over the texts: no shuffle and no state; all steps are linear in the text (the
sparse table n log n numbers), however long it is, so a text needs the memory of one task.

Defined results: a null or empty text has no words and no runs; equal rows get equal
results, one each; an empty table gives no rows.  Only the id and the text are read, so
extra columns with clashing names do no harm; a null id is handed through.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import small_batches

SHORTEST = 6
REPEATS = 4

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Tree:
    """Suffix tree of a list of numbers over 0 (a closing 0 is added), by Ukkonen.

    ``child`` maps ``node * width + first symbol`` to the node below; node 0 is the
    root, and the edge into a node is ``text[start[node]:end[node]]``.
    """

    def __init__(self, symbols: list[int]):
        self.text = text = [*symbols, 0]
        self.size = size = len(text)
        self.width = width = max(text) + 1
        self.start, self.end, self.child = [0], [0], {}
        start, end, child, link = self.start, self.end, self.child, [0]
        node = edge = along = waiting = 0
        for at, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not along:
                    edge = at
                key = node * width + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(at)
                    end.append(size)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    first = start[below]
                    length = min(end[below], at + 1) - first
                    if along >= length:
                        edge += length
                        along -= length
                        node = below
                        continue
                    if text[first + along] == symbol:
                        if unlinked:
                            link[unlinked] = node
                        along += 1
                        break
                    middle = len(start)
                    child[key] = middle
                    start += (first, at)
                    end += (first + along, size)
                    link += (0, 0)
                    child[middle * width + symbol] = middle + 1
                    start[below] = first + along
                    child[middle * width + text[first + along]] = below
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif along:
                    along -= 1
                    edge = at - waiting + 1

    def leaves(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(starts of the suffixes, depths passed before each) along an Euler tour.

        Children are visited by their first symbol, or from the largest on with the
        closing symbol still first, if ``reverse``.
        """
        keys = np.fromiter(self.child, np.int64, len(self.child))
        nodes = np.fromiter(self.child.values(), np.int64, len(self.child))
        parents, symbols = np.divmod(keys, self.width)
        order = np.lexsort(((self.width - symbols) % self.width if reverse else symbols, parents))
        parents, nodes = parents[order], nodes[order]
        marks = np.searchsorted(parents, np.arange(len(self.start) + 1)).tolist()
        lengths = (np.array(self.end) - np.array(self.start)).tolist()
        below = nodes.tolist()
        depth, starts, passed, low = [0] * len(self.start), [], [], 0
        tour = [(0, marks[0])]  # a node and the next of its children
        while tour:
            node, at = tour.pop()
            if at >= marks[node + 1]:
                continue
            low = min(low, depth[node])
            tour.append((node, at + 1))
            kid = below[at]
            depth[kid] = depth[node] + lengths[kid]
            if marks[kid] == marks[kid + 1]:
                starts.append(self.size - depth[kid])
                passed.append(low)
                low = self.size
            else:
                tour.append((kid, marks[kid]))
        return np.array(starts), np.array(passed)


class Extensions:
    """Longest common extension of two places of a text, in constant time each."""

    def __init__(self, starts: np.ndarray, passed: np.ndarray):
        self.rank = np.empty(len(starts), np.int64)
        self.rank[starts] = np.arange(len(starts))
        self.minima = [passed.astype(np.int32)]
        while (step := 1 << (len(self.minima) - 1)) * 2 <= len(passed):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-step], last[step:]))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For different places a and b (the closing symbol's place is allowed)."""
        one, two = self.rank[a], self.rank[b]
        low, high = np.minimum(one, two) + 1, np.maximum(one, two) + 1
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            rows = np.flatnonzero(level == k)
            table = self.minima[k]
            out[rows] = np.minimum(table[low[rows]], table[high[rows] - (1 << int(k))])
        return out


def _next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one with a smaller rank (the last place has rank 0)."""
    out, stack = [0] * len(rank), []
    for at, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = at
        stack.append(at)
    return np.array(out[:-1], np.int64)


def runs_of(symbols: list[int]) -> np.ndarray:
    """(start, length, period) of every repetition of at least twice its period."""
    n = len(symbols)
    if n < 2:
        return np.empty((0, 3), np.int64)
    tree = Tree(symbols)
    starts, passed = tree.leaves()
    other, _ = tree.leaves(reverse=True)
    forward = Extensions(starts, passed)
    backward = Extensions(*Tree(symbols[::-1]).leaves())
    turned = np.empty(n + 1, np.int64)
    turned[other] = np.arange(n + 1)
    places = np.arange(n)
    begin = np.concatenate([places, places])
    after = np.concatenate([_next_smaller(forward.rank.tolist()), _next_smaller(turned.tolist())])
    period = after - begin
    right = after + forward.of(begin, after)
    left = begin - backward.of(n - begin, n - after)
    long = right - left >= 2 * period
    return np.unique(np.stack([left, right - left, period], 1)[long], axis=0)


def stretches(codes: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the parts of a text that can hold a run; every run is in one of them.

    A run is longer than three words and repeats ``REPEATS`` times, so each of its word
    triples occurs ``REPEATS - 1`` times in it.  Parts are cut again until none shrinks.
    """
    out, open_parts = [], [(0, len(codes))]
    while open_parts:
        start, end = open_parts.pop()
        if end - start < SHORTEST:
            continue
        part = codes[start:end].astype(np.int64)
        pairs = np.unique(part[:-1] * (part.max() + 1) + part[1:], return_inverse=True)[1]
        _, triple, count = np.unique(pairs[:-1] * (part.max() + 1) + part[2:], return_inverse=True, return_counts=True)
        often = np.concatenate([[False], count[triple] >= REPEATS - 1, [False]])
        turns = np.flatnonzero(often[1:] != often[:-1])
        found = [(start + int(a), start + int(b) + 2) for a, b in zip(turns[::2], turns[1::2], strict=True)]
        if found == [(start, end)]:
            out.append((start, end))
        else:
            open_parts += found
    return sorted(out)


def find_runs(words: list) -> np.ndarray:
    """All runs of a text's words: rows (start, length, period) by start, then period."""
    numbers: dict = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found = [np.empty((0, 3), np.int64)]
    for start, end in stretches(codes):
        _, symbols = np.unique(codes[start:end], return_inverse=True)
        runs = runs_of((symbols + 1).tolist())
        runs = runs[runs[:, 1] >= np.maximum(SHORTEST, REPEATS * runs[:, 2])]
        found.append(runs + [start, 0, 0])
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    change: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(id, n_words, runs, collapsed) of every text: its runs by start, then period, and
    the text without repetitions.  ``change`` may give other words for an id and its words."""
    read = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judge(batches):
        for batch in small_batches(batches):
            ids, texts = batch.column(0), batch.column(1)
            counts, runs, rest = [], [], []
            for key, text in zip(ids.to_pylist(), texts.to_pylist(), strict=True):
                words = (text or "").encode().split()  # bytes split at [\x20\x09-\x0D] only
                if change:
                    words = change(key, words)
                found = find_runs(words)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found.tolist()])
                rest.append(collapse(words, found).decode())
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(rest, pa.string())], names=["id", "n_words", "runs", "collapsed"])

    id_type = read.schema["id"].dataType.simpleString()
    found = read.mapInArrow(judge, f"id {id_type}, n_words bigint, runs {RUNS}, collapsed string")
    return found.withColumnRenamed("id", id_column)


def longest(runs: str = "runs"):
    """The run with the greatest length; of equal ones the smallest start, then period (null: none)."""
    ranked = F.transform(F.col(runs), lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(ranked)
