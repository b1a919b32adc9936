"""Packing by power-of-two decomposition (operator 3).

Each document's token ids are cut into pieces whose lengths are powers of two:
as many of ``max_len`` as fit, then the binary digits of the rest, long pieces
first.  Equal lengths form a bucket, and a sequence is one piece, so no sequence
crosses documents and no sequence needs padding.

A map over the documents: no shuffle, no state.  Tokenizing is the cost; words
repeat, and the tokenizer works word by word, so each worker process remembers
the ids of about ``REMEMBERED`` words, or of fewer where a job's other stages
need the memory: a worker keeps what it remembers when they use it later.

Defined results: a null or empty text is its end id alone, one piece of length
1; repeated rows are packed once each; an empty table gives no piece.  Only
the id and text columns are read, so clashing extra columns do no harm.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import small_batches

MAX_LEN = 4096
END_ID = 2
REMEMBERED = 250_000


class WordIds:
    """Token ids of whole texts by a word tokenizer whose words never cross white space.

    Chunks between blanks and line ends are looked up.  A new chunk of plain
    Latin-1 characters, which normalising changes by lower case alone, is cut by
    the tokenizer's own pattern and each word given to its merge model; any other
    chunk goes through the whole tokenizer.  Both give the tokenizer's ids.
    """

    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^a-zà-öø-ÿß0-9]+")

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        levels = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = {c for c in map(chr, range(0xC0, 0x100)) if c.isalpha()}
        self.bytes_of = {ord(c): levels.pre_tokenize_str(c)[0][0] for c in letters}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}
        self.plain = self._is_word_cutter()

    def _is_word_cutter(self) -> bool:
        """Whether the short way gives the tokenizer's ids on a probe; else it is not taken."""
        probe = "Don't MIX3d,Éñ!x'll--9a <b>É'É"
        return all(
            self._short(c) == np.asarray(self.tokenizer.encode(c, add_special_tokens=False).ids, "<u4").tobytes()
            for c in probe.split()
        )

    def _short(self, chunk: str) -> bytes:
        words, out = self.words, []
        for w in self.WORDS.findall(chunk.lower()):
            ids = words.get(w)
            if ids is None:
                found = self.model.tokenize(w if w.isascii() else w.translate(self.bytes_of))
                ids = words[w] = struct.pack(f"<{len(found)}I", *[t.id for t in found])
            out.append(ids)
        return b"".join(out)

    def _learn(self, new: list[str], special: bool) -> None:
        rest, plain, chunks, short = [], self.PLAIN.fullmatch, self.chunks, self._short
        for c in new:
            if self.plain and plain(c) and not (special and any(x in c for x in self.special)):
                chunks[c] = short(c)
            else:
                rest.append(c)
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            for c, e in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
                self.chunks[c] = np.asarray(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # Only blanks and line ends are cut at: each is white space to the tokenizer,
        # which drops it; what else it holds for white space stays inside a chunk.
        docs = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.chunks) > self.remembered:
            self.chunks = {"": b""}
        if len(self.words) > self.remembered:
            self.words = {}
        known = self.chunks
        special = any(x in t for t in texts for x in self.special)
        self._learn(list(set().union(*docs).difference(known)), special)
        return [np.frombuffer(b"".join(map(known.__getitem__, doc)), "<u4") for doc in docs]


_LOADED: dict[tuple[str, int], WordIds] = {}


def word_ids(path: str, remembered: int = REMEMBERED) -> WordIds:
    """The tokenizer of this worker process, with what it remembers from earlier tasks."""
    key = path, remembered
    if key not in _LOADED:
        _LOADED[key] = WordIds(path, remembered)
    return _LOADED[key]


def piece_lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Powers of two that sum to ``n``: full pieces, then the binary digits of the rest."""
    full, rest = divmod(n, max_len)
    return [max_len] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def pack(
    docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, with_ids: bool = True, remembered: int = REMEMBERED
) -> DataFrame:
    """One row per sequence: the piece, its document and its bucket (its length).

    ``sequence_id`` follows from the task's number and the row's place in it,
    so a task that is run again after a lost executor gives the same numbers.
    """
    if max_len & (max_len - 1) or max_len < 1:
        raise ValueError("max_len must be a power of two")

    def run(batches):
        words = word_ids(tokenizer_path, remembered)
        for batch in small_batches(batches, 128):
            out: list[list] = [[] for _ in PIECES]
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), words.encode(texts), strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                start = 0
                for n in piece_lengths(len(ids), max_len):
                    piece = ids[start : start + n]
                    row = (doc, start, n, len(ids), zlib.crc32(piece.tobytes()), piece.astype(np.int32) if with_ids else None)
                    for to, value in zip(out, row, strict=True):
                        to.append(value)
                    start += n
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, PIECES, strict=True)], schema=PIECES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids array<int>"
    pieces = rows.mapInArrow(run, kinds).withColumn("sequence_id", F.monotonically_increasing_id())
    return pieces.withColumns({"offset": F.lit(0).cast("long"), "bucket": F.col("length")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder for each length (at most 13 for 4,096)."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)
