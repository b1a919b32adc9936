"""SentencePiece encoding and decoding over a relational lattice (operator 2).

The vocabulary is a byte-pair model, so the right segmentation is the one its merges
make, not the one with the best sum of scores.  The lattice and its fold stay; what a
path may do changes: a piece may follow another one only if merging the two texts side
by side would leave the pair apart.  For every prefix exactly one last piece satisfies
this, so the Viterbi fold carries it instead of a best score.

A map over the texts: no shuffle, no state; a task does all four steps for a few
megabytes of text at a time, on arrays (``piece_lattice``).

1. Words.  A text is cut where no piece crosses (before a run of blanks); the different
   words of these texts are encoded once, and remembered for the task's next texts.
2. Lattice.  Bounded substrings of each word are equi-joined to the piece table, one
   character longer at a time, so a substring that begins no piece is not made longer;
   each keeps its piece.  Characters that are no piece get their bytes.
3. Fold.  All words' ends are walked together, and of the edges at an end the one is
   picked whose pair with the prefix's last piece stays apart: no piece that crosses the
   border, made of a right part of the one and a left part of the other, may merge before
   those parts are taken by their own pieces.
4. Texts.  Each word occurrence takes its word's ids, in order.

``encoded_words`` does steps 2 and 3 for a table of words, dealt in bounded partitions.

Decoding looks ids up, joins their bytes and takes blanks for the word mark.

Defined results: a null text counts as empty, which has no ids; a text that holds the
word mark itself decodes to blanks there, as in the model; bytes that are no UTF-8 are
encoded as replacement characters; repeated rows are encoded each; an empty table gives
an empty result.  Only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import cut_lineage, parts, text_or_empty
from catalytics.llm.piece_lattice import Fold, Pieces, Words, blocks, joined, pieces_of, text_bytes

MARK = "▁"
SURROGATE = re.compile(rb"\xed[\xa0-\xbf][\x80-\xbf]")
NEVER = 2**31 - 1
#: Words whose lattices one task makes.
WORDS = 16_000
#: Bytes of text whose words are told apart together.
TEXT = 1 << 22
#: Columns of blocks: words; by a piece's length, whole numbers.
LEVELS = pa.list_(pa.string()), pa.list_(pa.list_(pa.int32()))


@dataclass(frozen=True)
class Vocabulary:
    #: piece, id, rank, and for each length of a right or left part the rank of the merge
    #: that takes it (NEVER for the whole piece, -1 for what is no part)
    pieces: list[tuple[str, int, int, list[int], list[int]]]
    first_byte: int
    hex_of: list[str]
    longest: int


def merges(piece: str, rank: dict[str, int]) -> list[tuple[int, int, int, int]]:
    """The merges that byte-pair encoding makes in ``piece`` alone: (start, middle, end, rank)."""
    cuts, out = list(range(len(piece) + 1)), []
    while len(cuts) > 2:
        best = None
        for i in range(len(cuts) - 2):
            r = rank.get(piece[cuts[i] : cuts[i + 2]])
            if r is not None and (best is None or r < best[0]):
                best = (r, i)
        if best is None:
            break
        r, i = best
        out.append((cuts[i], cuts[i + 1], cuts[i + 2], r))
        del cuts[i + 1]
    return out


def load(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    byte = {i: int(model.id_to_piece(i)[3:5], 16) for i in range(n) if model.is_byte(i)}
    first = min(byte, default=-1)
    if byte and any(i - first != b for i, b in byte.items()):
        raise ValueError("byte pieces are expected in order")
    normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    text = {i: model.id_to_piece(i) for i in normal}
    if any(re.search(f"[^{MARK}]{MARK}", t) for t in text.values()):
        raise ValueError("pieces that cross words are not supported")
    rank = {t: min(NEVER - 1, int(-model.get_score(i))) for i, t in text.items()}
    pieces = []
    for i, t in text.items():
        size = len(t)
        right, left = [-1] * size, [-1] * size
        done = merges(t, rank)
        if size > 1 and (not done or done[-1][:3:2] != (0, size)):
            continue  # its own merges never make it
        right[-1] = left[-1] = NEVER
        for start, middle, end, r in done:
            if end == size:
                right[end - middle - 1] = r
            if start == 0:
                left[middle - 1] = r
        pieces.append((t, i, rank[t], right, left))
    hexes = [f"{byte[i]:02X}" if i in byte else text[i].encode().hex().upper() if i in text else "" for i in range(n)]
    return Vocabulary(pieces, first, hexes, max(map(len, rank)))


def _pieces(v: Vocabulary) -> Pieces:
    return pieces_of(v.pieces, len(v.hex_of), v.longest, v.first_byte)


def by_bytes(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in stretches with at most TEXT bytes of text in a column, or one row."""
    _, cuts = text_bytes(batch.column(column))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(cuts, cuts[low] + TEXT, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def readable(texts: pa.Array) -> pa.Array:
    """Bytes that are no UTF-8 become replacement characters."""
    try:
        texts.validate(full=True)
        return texts
    except pa.ArrowInvalid:
        # as the JVM reads them: one for a surrogate's three bytes
        found = [SURROGATE.sub("\ufffd".encode(), t) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array([t.decode("utf-8", "replace") for t in found], pa.large_string())


def with_ids(columns: list[pa.Array], names: list[str], ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows with the ids of each, of which there are ``n``."""
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(ids))
    return pa.RecordBatch.from_arrays([*columns, lists], [*names, "ids"])


def lattice(words: DataFrame, v: Vocabulary) -> DataFrame:
    """(words, ends, ids) for each block of words: the pieces that end at each of their places."""
    pieces = _pieces(v)

    def run(batches):
        for batch in batches:
            some = batch.column(0).cast(pa.large_string())
            for part, block in blocks(some):
                block = joined(block, pieces)
                levels = ([a.astype(np.int32) for a in x] for x in (block.ends, block.ids))
                columns = [pa.array([some[part].cast(pa.string())], LEVELS[0]), *(pa.array([x], LEVELS[1]) for x in levels)]
                yield pa.RecordBatch.from_arrays(columns, ["words", "ends", "ids"])

    return words.select("word").filter("word is not null").mapInArrow(run, "words array<string>, ends array<array<int>>, ids array<array<int>>")


def _fold(lattices: DataFrame, v: Vocabulary) -> DataFrame:
    """(word, ids) from the rows of ``lattice``."""
    pieces = _pieces(v)

    def run(batches):
        fold = Fold(pieces)
        for batch in batches:
            for words, ends, ids in zip(*batch.columns, strict=True):
                ends, ids = ([level.values.to_numpy() for level in x] for x in (ends, ids))
                for _, block in blocks(words.values.cast(pa.large_string())):
                    yield with_ids([words.values], ["word"], *fold.words(replace(block, ends=ends, ids=ids)))

    return lattices.mapInArrow(run, "word string, ids array<int>")


def encoded_words(words: DataFrame, v: Vocabulary) -> DataFrame:
    """(word, ids) for a column ``word`` of different words."""
    words = cut_lineage(words.select("word"), "words")
    dealt = words.repartition(max(parts(words.sparkSession), ceil(words.count() / WORDS)), "word")
    return _fold(lattice(dealt, v), v)


def encode(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """doc_id, text, ids for every row."""
    pieces = _pieces(v)

    def run(batches):
        words = Words(pieces)
        for batch in batches:
            for some in by_bytes(batch, 1):
                yield with_ids(some.columns, ["doc_id", "text"], *words.texts(readable(some.column(1)), MARK))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string, ids array<int>")


def decode(ids: Column, v: Vocabulary) -> Column:
    """The text of an array of ids."""
    table = F.array(*map(F.lit, v.hex_of)) if len(v.hex_of) < 100 else F.split(F.lit(",".join(v.hex_of)), ",")
    text = F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")), "utf-8")
    plain = F.replace(text, F.lit(MARK), F.lit(" "))
    return F.substring(plain, 2, 2**31 - 1)
