"""The lattice of a block of words and its fold, by array operations inside a task.

A block's words are lanes, longest first, and their characters lie place by place: those
at place e are one stretch, a lane each, so a step of all words is a slice.

* Lattice: all substrings of a word, one character longer each level, are joined to the
  prefixes of the pieces by (prefix, next character); exact keys, no hash stands for a
  text.  Those that are pieces are the level's edges, in order of their ends.
* Fold: for each end, the edges are tried on all lanes, long ones first; the edge whose pair
  with the last piece of the prefix before it stays apart is taken.  Whether two pieces stay
  apart follows from these two alone, and is remembered.
* Where few lanes are left (long words), the pairs of all edges that meet are judged
  together, and a plain walk takes the edges.  A very long word goes through both in
  stretches, so memory holds little more than its characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MIXER = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a code point.
CODE = 21
#: Pairs of pieces that a task remembers (as a power of two).
PAIRS = 20
#: Pairs that are judged at once.
JUDGED = 1 << 14
#: Lanes below which the fold walks word by word, and places that such a walk prepares at once.
FEW, WALKED = 24, 1 << 12
#: Characters of the words that are folded together; a longer word goes in stretches of so many.
BLOCK = 1 << 18
#: Ids of the words that a task remembers.
REMEMBERED = 1 << 21


@dataclass(frozen=True)
class Table:
    """Whole numbers to whole numbers, both at least 0, by open addressing."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, entries: dict[int, int]) -> Table:
        size = 1 << max(4, (4 * len(entries)).bit_length())
        out = cls(np.full(size, -1, np.int64), np.full(size, -1, np.int32))
        keys, values = np.fromiter(entries, np.int64, len(entries)), np.fromiter(entries.values(), np.int32, len(entries))
        slots = out._slots(keys)
        while len(keys):
            _, first = np.unique(slots, return_index=True)
            put = first[out.keys[slots[first]] < 0]
            out.keys[slots[put]], out.values[slots[put]] = keys[put], values[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & (size - 1)
        return out

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * MIXER) >> np.uint64(65 - len(self.keys).bit_length())).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it has none."""
        slots = self._slots(keys)
        there = self.keys[slots]
        same = there == keys
        out = np.where(same, self.values[slots], np.int32(-1))
        rest = np.flatnonzero(~same & (there >= 0))
        while len(rest):
            slots[rest] = (slots[rest] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[rest]]
            same = there == keys[rest]
            out[rest[same]] = self.values[slots[rest[same]]]
            rest = rest[~same & (there >= 0)]
        return out


@dataclass(frozen=True)
class Parts:
    """By piece, the parts at one of its sides that stand alone before a merge takes them."""

    first: np.ndarray  # of each piece, and where the last one's end
    node: np.ndarray
    rank: np.ndarray


@dataclass(frozen=True)
class Pieces:
    """A vocabulary as arrays."""

    prefixes: Table  # (prefix, next character) to the longer prefix
    piece: np.ndarray  # by prefix: the id of the piece that it is, or -1
    crossing: Table  # (right part, left part) to the rank of the piece that they make
    right: Parts
    left: Parts
    longest: int
    first_byte: int

    @property
    def unknown(self) -> int:
        """Stands for the id of a character that is no piece; it has no parts."""
        return len(self.right.first) - 2


def pieces_of(pieces: list[tuple[str, int, int, list[int], list[int]]], ids: int, longest: int, first_byte: int) -> Pieces:
    """From (text, id, rank, ranks that take its right parts, and its left parts) of each."""
    children: dict[int, int] = {}
    piece = [-1]
    for text, i, *_ in pieces:
        node = 0
        for c in text:
            node = children.setdefault(node << CODE | ord(c), len(piece))
            if node == len(piece):
                piece.append(-1)
        piece[node] = i
    nodes: dict[str, int] = {}

    def parts(side: int, cut) -> tuple[Parts, set[str]]:
        each: list[list[tuple[int, int]]] = [[] for _ in range(ids + 1)]
        texts = set()
        for p in pieces:
            for size, rank in enumerate(p[side], 1):
                if rank >= 0:
                    texts.add(part := cut(p[0], size))
                    each[p[1]].append((nodes.setdefault(part, len(nodes)), rank))
        first = np.r_[0, np.cumsum([len(x) for x in each])]
        node, rank = np.array([x for some in each for x in some] or np.empty((0, 2)), np.int64).T
        return Parts(first, node.copy(), rank.astype(np.int32)), texts

    right, ends = parts(3, lambda t, n: t[len(t) - n :])
    left, starts = parts(4, lambda t, n: t[:n])
    crossing = {
        nodes[t[:m]] << 32 | nodes[t[m:]]: rank for t, _, rank, *_ in pieces for m in range(1, len(t)) if t[:m] in ends and t[m:] in starts
    }
    return Pieces(Table.of(children), np.array(piece, np.int32), Table.of(crossing), right, left, longest, first_byte)


@dataclass(frozen=True)
class Lattice:
    """Edges of a block's words by level (the piece's length less 1), in order of their ends."""

    lane_of: np.ndarray  # by word
    sizes: np.ndarray  # by lane
    width: np.ndarray  # lanes at each place
    off: np.ndarray  # where each place begins
    codes: np.ndarray
    ends: list[np.ndarray]
    ids: list[np.ndarray]


def laid_out(codes: np.ndarray, sizes: np.ndarray) -> Lattice:
    """A block without edges.  ``codes``: the code points of all words in a row; ``sizes``: of
    each word."""
    order = np.argsort(-sizes, kind="stable")
    lane_of = np.empty(len(sizes), np.int64)
    lane_of[order] = np.arange(len(sizes))
    width = np.searchsorted(-sizes[order], -np.arange(1, sizes.max(initial=0) + 1), "right")
    off = np.r_[0, np.cumsum(width)]
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    laid = np.empty(len(codes), np.int64)
    laid[off[place] + np.repeat(lane_of, sizes)] = codes
    return Lattice(lane_of, sizes[order], width, off, laid, [], [])


def joined(x: Lattice, p: Pieces) -> Lattice:
    """The block with its edges."""
    place = np.repeat(np.arange(len(x.width)), x.width)
    # the same lane's next place, or -1
    following = np.arange(len(place)) + x.width[place]
    following[following - x.off[place + 1] >= np.r_[x.width, 0][place + 1]] = -1
    end, node = np.arange(len(place)), p.prefixes.find(x.codes)
    known = np.where(node >= 0, p.piece[node], -1)
    ends, ids = [end], [np.where(known >= 0, known, np.int32(p.unknown))]
    for _ in range(1, p.longest):
        on = np.flatnonzero(node >= 0)
        end = following[end[on]]
        on, end = on[end >= 0], end[end >= 0]
        node = p.prefixes.find(node[on].astype(np.int64) << CODE | x.codes[end])
        is_piece = np.flatnonzero(np.where(node >= 0, p.piece[node], -1) >= 0)
        ends.append(end[is_piece])
        ids.append(p.piece[node[is_piece]])
    return replace(x, ends=ends, ids=ids)


class Fold:
    """Takes the edges of lattices; remembers which pairs of pieces stay apart."""

    def __init__(self, p: Pieces):
        self.p = p
        self.keys = np.full(1 << PAIRS, -1, np.int64)
        self.values = np.zeros(1 << PAIRS, bool)

    def _judge(self, last: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Whether no piece across the border merges before its parts are taken: every right
        part of the one is joined with every left part of the other."""
        out = np.ones(len(last), bool)
        right, left = self.p.right, self.p.left
        for at in range(0, len(last), JUDGED):
            a, b = last[at : at + JUDGED], edge[at : at + JUDGED]
            rights, lefts = right.first[a + 1] - right.first[a], left.first[b + 1] - left.first[b]
            n = rights * lefts
            pair = np.repeat(np.arange(len(a)), n)
            i, j = np.divmod(np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n), lefts[pair])
            i += right.first[a][pair]
            j += left.first[b][pair]
            rank = self.p.crossing.find(right.node[i] << 32 | left.node[j])
            merged = (rank >= 0) & (rank < right.rank[i]) & (rank <= left.rank[j])
            out[at + pair[merged]] = False
        return out

    def apart(self, last: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Whether two pieces side by side stay two."""
        key = last.astype(np.int64) * len(self.p.right.first) + edge
        slot = self._slots(key)
        out, missed = self.values[slot], np.flatnonzero(self.keys[slot] != key)
        if len(missed):
            new, back = np.unique(key[missed], return_inverse=True)
            judged = self._judge(*np.divmod(new, len(self.p.right.first)))
            out[missed] = judged[back]
            slot = self._slots(new)
            self.keys[slot], self.values[slot] = new, judged
        return out

    @staticmethod
    def _slots(key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * MIXER) >> np.uint64(64 - PAIRS)).view(np.int64)

    def take(self, x: Lattice) -> tuple[np.ndarray, np.ndarray]:
        """The length (less 1) and the id of the piece that ends each prefix, by its place."""
        size, chosen = np.full(len(x.codes), -1, np.int64), np.zeros(len(x.codes), np.int32)
        if x.ends or len(x.codes) <= BLOCK:
            x = x if x.ends else joined(x, self.p)
            self._walk(x, self._steps(x, size, chosen), size, chosen)
        else:  # one word; a stretch begins with what its first pieces follow
            for low in range(0, len(x.codes), BLOCK):
                begin = max(0, low - 2 * self.p.longest)
                some = slice(begin, low + BLOCK)
                part = x.codes[some]
                self._walk(joined(laid_out(part, np.array([len(part)])), self.p), low - begin, size[some], chosen[some])
        if len(size) and size.min() < 0:
            raise ValueError("a prefix has no last piece: its characters are parts of pieces, but no pieces")
        return size, chosen

    def _steps(self, x: Lattice, size: np.ndarray, chosen: np.ndarray) -> int:
        """All lanes at once, end after end; the first place that has too few lanes."""
        steps = int(np.searchsorted(-x.width, -FEW, "right"))
        cuts = [np.searchsorted(ends, x.off) for ends in x.ends]
        for e in range(steps):
            low, left = x.off[e], x.width[e]
            open_ = np.ones(left, bool)
            for level in range(min(len(cuts) - 1, e), -1, -1):
                some = slice(cuts[level][e], cuts[level][e + 1])
                lane, edge = x.ends[level][some] - low, x.ids[level][some]
                if left < len(open_):
                    on = open_[lane]
                    lane, edge = lane[on], edge[on]
                if not len(lane):
                    continue
                if level < e:
                    on = self.apart(chosen[x.off[e - level - 1] + lane], edge)
                    lane, edge = lane[on], edge[on]
                size[low + lane], chosen[low + lane] = level, edge
                open_[lane] = False
                left -= len(lane)
                if not left:
                    break
        return x.off[steps]

    def _walk(self, x: Lattice, low: int, size: np.ndarray, chosen: np.ndarray) -> None:
        """The same from ``low`` on, place after place; what lies before is done."""
        for at in range(low, len(x.codes), WALKED):
            self._stretch(x, at, min(at + WALKED, len(x.codes)), size, chosen)

    def _stretch(self, x: Lattice, low: int, high: int, size: np.ndarray, chosen: np.ndarray) -> None:
        # edges by their ends, short ones first, from where the first of them can begin
        begin = x.off[max(0, int(np.searchsorted(x.off, low, "right")) - 1 - len(x.ends))]
        some = [slice(*np.searchsorted(ends, (begin, high))) for ends in x.ends]
        end = np.concatenate([ends[s] for ends, s in zip(x.ends, some, strict=True)])
        edge = np.concatenate([ids[s] for ids, s in zip(x.ids, some, strict=True)])
        level = np.repeat(np.arange(len(some)), [s.stop - s.start for s in some])
        by = np.lexsort((level, end))
        end, edge, level = end[by], edge[by], level[by]
        place = np.searchsorted(x.off, end, "right") - 1
        before = np.where(level < place, x.off[place - level - 1] + end - x.off[place], -1)
        first = np.searchsorted(end, np.arange(begin, high + 1))
        mine = np.flatnonzero(end >= low)
        # every edge with every edge that ends where it begins
        at = np.where(before[mine] >= 0, before[mine] - begin, 0)
        n = np.where(before[mine] >= 0, first[at + 1] - first[at], 0)
        start = np.cumsum(n) - n
        other = np.arange(n.sum()) - np.repeat(start - first[at], n)
        apart = self.apart(edge[other], np.repeat(edge[mine], n)).tolist()
        taken = np.full(high - begin, -1, np.int64)  # which of its edges each place took
        done = np.flatnonzero((end < low) & (size[end] == level) & (chosen[end] == edge))
        taken[end[done] - begin] = done - first[end[done] - begin]
        taken, start, before = taken.tolist(), start.tolist(), (before[mine] - begin).tolist()
        cut = (first[low - begin :] - first[low - begin]).tolist()
        for i in range(high - low):
            for k in range(cut[i + 1] - 1, cut[i] - 1, -1):
                if before[k] < 0 or apart[start[k] + taken[before[k]]]:
                    taken[low - begin + i] = k - cut[i]
                    break
        got = np.array(taken[low - begin :], np.int64)
        found = np.flatnonzero(got >= 0)
        which = first[low - begin :][found] + got[found]
        size[low + found], chosen[low + found] = level[which], edge[which]

    def words(self, x: Lattice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, in the words' order, and how many each has."""
        size, chosen = self.take(x)
        lane = np.flatnonzero(x.sizes)
        at = x.sizes[lane] - 1
        none, lanes, tokens = lane[:0], [], []
        while len(lane):
            where = x.off[at] + lane
            lanes.append(lane)
            tokens.append(np.where(chosen[where] == self.p.unknown, -1 - x.codes[where], chosen[where]))
            at = at - size[where] - 1
            on = at >= 0
            lane, at = lane[on], at[on]
        # from behind: a lane's round is its place from the end
        rounds = np.repeat(np.arange(len(lanes)), [len(r) for r in lanes])
        lane, token = np.concatenate([none, *lanes]), np.concatenate([none, *tokens])
        n = np.bincount(lane, minlength=len(x.sizes))[x.lane_of]
        end = np.empty(len(n), np.int64)
        end[x.lane_of] = np.cumsum(n)
        flat = np.empty(len(token), np.int64)
        flat[end[lane] - 1 - rounds] = token
        return self._bytes(flat, n)

    def _bytes(self, flat: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A character that is no piece gives the ids of its bytes."""
        if not len(odd := np.flatnonzero(flat < 0)):
            return flat.astype(np.int32), n
        codes = -1 - flat[odd]
        each = np.ones(len(flat), np.int64)
        each[odd] += (codes >= 0x80).astype(int) + (codes >= 0x800) + (codes >= 0x10000)
        out = np.repeat(flat, each)
        out[np.repeat(flat < 0, each)] = self.p.first_byte + np.frombuffer("".join(map(chr, codes.tolist())).encode(), np.uint8).astype(np.int64)
        ends = np.r_[0, np.cumsum(each)][np.r_[0, np.cumsum(n)]]
        return out.astype(np.int32), np.diff(ends)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the cuts between them."""
    texts = texts.cast(pa.large_binary())
    cuts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
    return data, cuts - cuts[0]


def cut_words(texts: pa.Array, mark: str) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, each with the blanks before it as marks, and how many
    each text has; a text is cut before each run of blanks."""
    texts, (empty, joint) = texts.cast(pa.large_string()), (pa.scalar(x, pa.large_string()) for x in ("", mark))
    marked = pc.if_else(pc.equal(texts, empty), empty, pc.binary_join_element_wise(empty, pc.replace_substring(texts, " ", mark), joint))
    data, cuts = text_bytes(marked)
    a, b, c = mark.encode()
    here = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c)) if len(data) else np.empty(0, np.int64)
    goes_on = np.r_[False, here[1:] - here[:-1] == 3][: len(here)]
    begins = np.zeros(len(data) + 1, bool)
    begins[here[~goes_on]] = True
    begins[cuts[:-1][np.diff(cuts) > 0]] = True
    starts = np.flatnonzero(begins)
    bounds = np.r_[starts, len(data)].astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
    return words, np.diff(np.searchsorted(starts, cuts))


def blocks(words: pa.Array) -> Iterator[tuple[slice, Lattice]]:
    """Words that are folded together, and their layout."""
    data, cuts = text_bytes(words)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    at = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][cuts]
    low = 0
    while low < len(words):
        high = max(low + 1, int(np.searchsorted(at, at[low] + BLOCK, "right")) - 1)
        yield slice(low, high), laid_out(codes[at[low] : at[high]], np.diff(at[low : high + 1]))
        low = high


class Words:
    """Ids of words, for one task: those that it has met are remembered, about ``remembered`` ids."""

    def __init__(self, p: Pieces, remembered: int = REMEMBERED):
        self.p, self.fold, self.remembered = p, Fold(p), remembered
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.flat, self.counts = np.empty(0, np.int32), np.empty(0, np.int64)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words in a row, and how many each has."""
        done = [self.fold.words(block) for _, block in blocks(words)]
        flats, counts = zip(*done, strict=True)
        return np.concatenate(flats), np.concatenate(counts)

    def texts(self, texts: pa.Array, mark: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        if len(self.flat) > self.remembered:
            self._forget()
        words, per_text = cut_words(texts, mark)
        met = words.dictionary_encode()
        place = pc.index_in(met.dictionary, self.known).fill_null(-1).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(place < 0)
        if len(new):
            flat, counts = self.encode(some := met.dictionary.take(pa.array(new)))
            place = place.astype(np.int64)
            place[new] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, some])
            self.flat, self.counts = np.r_[self.flat, flat], np.r_[self.counts, counts]
        word = place[met.indices.to_numpy()]
        n = self.counts[word]
        done = np.cumsum(n)
        ids = self.flat[np.arange(done[-1] if len(done) else 0) + np.repeat((np.cumsum(self.counts) - self.counts)[word] - (done - n), n)]
        return ids, np.diff(np.r_[0, done][np.r_[0, np.cumsum(per_text)]])
