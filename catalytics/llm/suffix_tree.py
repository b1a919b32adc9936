"""Language-model scores by a probabilistic suffix tree (operator 4).

Symbols are lower-cased words and an end of text.  A state is a context of up to two
preceding words.  A context that occurs often enough is retained when its next-symbol
distribution diverges from its suffix's: the summed log-likelihood gain over its own
training occurrences, each left out of its own estimate, must reach MIN_GAIN bits.
Distributions are smoothed towards the suffix's, down to add-half word frequencies.  A
text's score adds up the log10 probability of each symbol after the longest retained
suffix of what precedes it.

Words are counted over all training documents, so each count needs the corpus.  Tasks
cut documents into chunks (hashed words, about FLUSH symbols, one row each).  A round
of ``_asked`` sends each chunk's distinct keys by hash range, sums them per range, and
returns the sums to the chunk; three rounds give word and pair counts, then triple counts
and the pairs' divergence, then the triples' divergence.  A key travels once from a
chunk that holds it, so a pair of words that fills a third of the corpus is one entry
for each chunk, and hash ranges get equal shares.  Chunks and answers lie in the shared
folder; every round can be run again from there.

Words are told apart by 64-bit hashes: with a billion different words, one pair would be
taken for the same word with a chance of about 3 %.

Defined results: a null, empty or blank text is one symbol, its end; a null doc_id
counts as the text "" for the split; repeated rows are trained on and scored once each;
an empty table gives an empty result.  Only id and text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import cut_lineage, mix, pack, parts, small_batches, text_or_empty, unpack, word_hashes

FLUSH = 1_000_000
#: Hash ranges for each shuffle partition.
RANGES = 3
#: Training occurrences a context needs.
MIN_COUNT = 4
#: Bits of left-out gain a context needs.
MIN_GAIN = 3.0
#: Weight of the suffix's distribution, in occurrences.
MU = 2.0
END = 0
FIXED = 2**20
FOLDS, HELD_FOLD = 5, 1

CHUNK = "doc_ids array<long>, lengths array<int>, words binary, places binary"


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_FOLD


def chunks(docs: DataFrame) -> DataFrame:
    """Rows of documents as places in a sorted list of word hashes; ends included."""

    def row(ids, sizes, symbols):
        words, places = np.unique(np.concatenate(symbols), return_inverse=True)
        data = [pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32()))]
        data += [pa.array([pack(x)], pa.binary()) for x in (words, places.astype(np.uint32))]
        return pa.RecordBatch.from_arrays(data, names=["doc_ids", "lengths", "words", "places"])

    def run(batches):
        end = np.array([END], np.uint64)
        ids, sizes, symbols, size = [], [], [], 0
        for batch in small_batches(batches):
            words, counts = word_hashes(batch.column(1))
            for doc, mine in zip(batch.column(0).to_pylist(), np.split(words, np.cumsum(counts)[:-1]), strict=True):
                ids.append(doc)
                sizes.append(len(mine) + 1)
                symbols += [mine, end]
                size += len(mine) + 1
                if size >= FLUSH:
                    yield row(ids, sizes, symbols)
                    ids, sizes, symbols, size = [], [], [], 0
        if ids:
            yield row(ids, sizes, symbols)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, CHUNK).withColumn("chunk", F.monotonically_increasing_id())


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``keys``, and the keys in it.  Their high bits are sorted with their
    places in the low ones; should keys that differ agree in those bits, by whole keys."""
    bits = np.uint64(len(keys).bit_length())
    places = np.sort((keys >> bits << bits) | np.arange(len(keys), dtype=np.uint64))
    order = (places & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys)
        ordered = keys[order]
    return order, ordered


class _Keys:
    """Distinct keys at some places of a chunk, with sums of their values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, where: np.ndarray):
        self.where = where
        self.order, ordered = _sorted(keys)
        self.first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.keys = ordered[self.first]
        self.sums = np.add.reduceat(values[self.order], self.first) if len(keys) else values

    def spread(self, totals: np.ndarray, size: int) -> np.ndarray:
        """Totals of the distinct keys, back at the places; 0 elsewhere."""
        out = np.zeros(size, np.int64)
        if len(self.keys):
            back = np.empty(len(self.order), np.int64)
            back[self.order] = np.repeat(totals, np.diff(np.r_[self.first, len(self.order)]))
            out[self.where] = back
        return out


class _Words(_Keys):
    """The same for the words of a whole chunk, whose distinct hashes are known."""

    def __init__(self, words: np.ndarray, places: np.ndarray, values: np.ndarray):
        self.places = places
        self.order, self.keys = _sorted(words)
        self.sums = np.bincount(places, values, len(words)).astype(np.int64)[self.order]

    def spread(self, totals: np.ndarray, size: int) -> np.ndarray:
        back = np.empty(len(self.order), np.int64)
        back[self.order] = totals
        return back[self.places]


class _Chunk:
    """A chunk's arrays and what the answers so far say about each symbol."""

    def __init__(self, row: dict):
        self.doc_ids, self.lengths = row["doc_ids"], np.asarray(row["lengths"], np.int64)
        self.words, self.places = unpack(row["words"], np.uint64), unpack(row["places"], np.uint32)
        self.w = self.words[self.places]
        self.size = len(self.w)
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]]
        self.held = np.array([held_out(d) for d in self.doc_ids])
        self.train = np.repeat(~self.held, self.lengths)
        place = np.arange(self.size) - np.repeat(self.starts, self.lengths)
        self.has = [np.ones(self.size, bool), place >= 1, place >= 2]
        self.answers = [row[f"answer{i}"] for i in range(1, 4) if f"answer{i}" in row]

    def totals(self, answer: int, level: int) -> np.ndarray:
        found = [unpack(x["totals"][level], np.int64) for x in self.answers[answer] or []]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def grams(self, n: int, where: np.ndarray) -> np.ndarray:
        """Keys of the n symbols that end at each place."""
        at = np.flatnonzero(where)
        h = np.full(len(at), n, np.uint64)
        for back in range(n - 1, -1, -1):
            h = mix(h, self.w[at - back])
        return h

    def contexts(self, n: int, where: np.ndarray) -> np.ndarray:
        """Keys of the n symbols before each place."""
        at = np.flatnonzero(where)
        h = np.full(len(at), 100 + n, np.uint64)
        for back in range(n, 0, -1):
            h = mix(h, self.w[at - back])
        return h

    def counted(self, n: int, where: np.ndarray) -> _Keys:
        return _Keys(self.grams(n, where), self.train[where].astype(np.int64), where)

    def first_round(self) -> list[_Keys]:
        words = _Words(mix(np.uint64(1), self.words), self.places, self.train)
        return [words, self.counted(2, self.has[1])]

    def read_counts(self, n_train: int, n_types: int) -> None:
        one, two = (k.spread(self.totals(0, i), self.size) for i, k in enumerate(self.first_round()))
        self.c1, self.c2 = one, two
        self.p0 = (one + 0.5) / (n_train + 0.5 * (n_types + 1))
        before = lambda x, has: np.where(has, np.r_[0, x[:-1]], 0)
        self.n1, self.n2 = before(one, self.has[1]), before(two, self.has[2])
        self.often = [self.n1 >= MIN_COUNT, self.n2 >= MIN_COUNT]

    @staticmethod
    def smoothed(count, seen, suffix, left_out=0):
        return (np.maximum(count - left_out, 0) + MU * suffix) / (np.maximum(seen - left_out, 0) + MU)

    def gains(self, n: int, mine: np.ndarray, suffix: np.ndarray) -> _Keys:
        """Contexts of n symbols with the fixed-point bits they gain here in training."""
        where = self.often[n - 1]
        bits = np.where(self.train, np.log2(mine / suffix), 0.0)[where]
        return _Keys(self.contexts(n, where), np.rint(bits * FIXED).astype(np.int64), where)

    def second_round(self) -> list[_Keys]:
        return [self.counted(3, self.often[1]), self.gains(1, self.smoothed(self.c2, self.n1, self.p0, 1), self.p0)]

    def read_triples(self) -> None:
        triples, pairs = self.second_round()
        self.c3 = triples.spread(self.totals(1, 0), self.size)
        self.gain1 = pairs.spread(self.totals(1, 1), self.size)

    def third_round(self) -> list[_Keys]:
        one = self.smoothed(self.c2, self.n1, self.p0, 1)
        return [self.gains(2, self.smoothed(self.c3, self.n2, one, 1), one)]

    def scores(self) -> tuple[np.ndarray, np.ndarray]:
        gain2 = self.third_round()[0].spread(self.totals(2, 0), self.size)
        p1 = self.smoothed(self.c2, self.n1, self.p0)
        p2 = self.smoothed(self.c3, self.n2, p1)
        keep1 = self.often[0] & (self.gain1 >= MIN_GAIN * FIXED)
        keep2 = self.often[1] & (gain2 >= MIN_GAIN * FIXED)
        best = np.where(keep2, p2, np.where(keep1, p1, self.p0))
        return np.log10(self.p0), np.log10(best)


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


ANSWER = "chunk long, bucket int, totals array<binary>, types long, tokens long"


def _asked(state: DataFrame, questions, ranges: int) -> DataFrame:
    """Send ``questions(chunk)`` (lists of _Keys) by hash range; ANSWER has, for each
    chunk and range, the corpus's sums of its keys in order."""

    def send(batches):
        for row in _rows(batches):
            levels = questions(_Chunk(row))
            step = np.arange(ranges, dtype=np.uint64) * np.uint64(2**64 // ranges)
            cuts = [np.r_[np.searchsorted(k.keys, step), len(k.keys)] for k in levels]
            for b in range(ranges):
                at = [slice(c[b], c[b + 1]) for c in cuts]
                if any(s.stop > s.start for s in at):
                    keys = [pack(np.diff(k.keys[s], prepend=np.uint64(0))) for k, s in zip(levels, at, strict=True)]
                    values = [pack(k.sums[s]) for k, s in zip(levels, at, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b], pa.int32()), pa.array([row["chunk"]], pa.int64()), *(pa.array([x], pa.list_(pa.binary())) for x in (keys, values))],
                        names=["bucket", "chunk", "keys", "sums"],
                    )

    def add(table: pa.Table) -> pa.Table:
        keys, sums = table.column("keys").to_pylist(), table.column("sums").to_pylist()
        out: list[list[bytes]] = [[] for _ in keys]
        types = tokens = 0
        for level in range(len(keys[0])):
            k = [np.cumsum(unpack(x[level], np.uint64), dtype=np.uint64) for x in keys]
            v = np.concatenate([unpack(x[level], np.int64) for x in sums])
            found = _Keys(np.concatenate(k), v, np.ones(len(v), bool))
            if level == 0:
                types, tokens = int((found.sums > 0).sum()), int(found.sums.sum())
            totals = found.spread(found.sums, len(v))
            ends = np.cumsum([len(x) for x in k])
            for to, part in zip(out, np.split(totals, ends[:-1]), strict=True):
                to.append(pack(part))
        n = len(keys)
        return pa.table(
            [table.column("chunk"), table.column("bucket"), pa.array(out, pa.list_(pa.binary())), pa.array([types] * n), pa.array([tokens] * n)],
            names=["chunk", "bucket", "totals", "types", "tokens"],
        )

    sent = state.mapInArrow(send, "bucket int, chunk long, keys array<binary>, sums array<binary>")
    return cut_lineage(sent.groupBy("bucket").applyInArrow(add, ANSWER), "answers")


def _with(state: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    mine = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "totals"))).alias(name))
    return state.join(mine, "chunk", "left")


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame) -> DataFrame:
    """SCORED for every document."""
    ranges = RANGES * parts(docs.sparkSession)
    state = cut_lineage(chunks(docs), "chunks")
    one = _asked(state, lambda c: c.first_round(), ranges)
    per_range = one.groupBy("bucket").agg(F.first("types").alias("types"), F.first("tokens").alias("tokens"))
    sums = per_range.agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).first()
    n_types, n_train = sums["types"] or 0, sums["tokens"] or 0

    def second(c: _Chunk) -> list[_Keys]:
        c.read_counts(n_train, n_types)
        return c.second_round()

    def third(c: _Chunk) -> list[_Keys]:
        c.read_counts(n_train, n_types)
        c.read_triples()
        return c.third_round()

    def final(batches):
        for row in _rows(batches):
            c = _Chunk(row)
            c.read_counts(n_train, n_types)
            c.read_triples()
            base, best = c.scores()
            per_doc = lambda x: np.add.reduceat(x, c.starts)  # noqa: E731, B023
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(c.doc_ids, pa.int64()),
                    "held_out": pa.array(c.held),
                    "n_tokens": pa.array(c.lengths),
                    "n_known": pa.array(per_doc((c.c1 > 0).astype(np.int64))),
                    "train_tokens": pa.array(np.full(len(c.lengths), n_train, np.int64)),
                    "base_score": pa.array(per_doc(base)),
                    "score": pa.array(per_doc(best)),
                }
            )

    state = _with(state, one, "answer1")
    two = _asked(state, second, ranges)
    state = _with(state, two, "answer2")
    three = _asked(state, third, ranges)
    return _with(state, three, "answer3").mapInArrow(final, SCORED)
