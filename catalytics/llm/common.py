"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics.session import settings
from catalytics.sources.io import cut_lineage, drop_stage, read_table, scratch_path

#: The white space of the word definition: [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"

__all__ = [
    "WHITE", "cut_lineage", "drop_stage", "free_name", "mix", "pack", "parts",
    "read_table", "scratch_path", "settings", "small_batches", "text_or_empty", "unpack",
    "word_hashes", "written_in_small_batches",
]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows of an Arrow batch of whole texts: the texts of a batch, and what is made of them, are
#: in a Python worker and in the executor's buffers at once.
TEXTS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}


def written_in_small_batches(df: DataFrame, name: str) -> DataFrame:
    """``df`` written, with few texts of it in Python at a time."""
    with settings(df.sparkSession, TEXTS):
        return cut_lineage(df, name)


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_batches(batches, rows: int = 256):
    """Arrow batches cut to at most ``rows`` rows, so few whole texts are in Python at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def mix(h: np.ndarray, nxt: np.ndarray | int) -> np.ndarray:
    """64-bit hash of the pair (h, nxt); order matters (a splitmix64 finaliser)."""
    z = (h * np.uint64(0x9E3779B97F4A7C15)) + nxt
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


#: Bytes of text that are hashed at once, and of the longest word that is hashed with others.
BLOCK, LONG = 1 << 16, 64
#: Powers of an odd base and of its inverse.
BASE = 0xD6E8FEB86659FD95
POWER, UNPOWER = (np.cumprod(np.r_[np.uint64(1), np.full(BLOCK, x, np.uint64)]) for x in (BASE, pow(BASE, -1, 2**64)))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes, never 0, of the lower-cased words of all texts in a row; words of each text.

    A word's hash is a polynomial of its bytes, cut out of a block's running sum, then
    mixed with its length; a word of more than LONG bytes is hashed by itself.
    """
    texts = texts.cast(pa.large_binary())
    cuts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
    cuts = cuts - cuts[0]
    white = (data == 0x20) | (data - np.uint8(0x09) < 5)
    lower = data | ((data - np.uint8(0x41) < 26) * np.uint8(0x20))
    full = np.flatnonzero(np.diff(cuts))  # texts with a byte: a word ends where its text does
    starts, ends = np.r_[True, white[:-1]][: len(data)], np.r_[white[1:], True][: len(data)]
    starts[cuts[full]] = ends[cuts[full + 1] - 1] = True
    starts, ends = np.flatnonzero(starts & ~white), np.flatnonzero(ends & ~white) + 1
    sizes = ends - starts
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + BLOCK, "right")))
        high = min(ends[to - 1], low + BLOCK)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((lower[low:high] + np.uint64(1)) * POWER[: high - low], out=sums[1:])
        here, there = starts[at:to] - low, np.minimum(ends[at:to] - low, high - low)
        out[at:to] = (sums[there] - sums[here]) * UNPOWER[here]
        at = to
    out = mix(out, sizes.astype(np.uint64))
    for i in np.flatnonzero(sizes > LONG):
        out[i] = xxhash.xxh3_64_intdigest(lower[starts[i] : ends[i]].tobytes())
    return np.maximum(out, np.uint64(1)), np.diff(np.searchsorted(starts, cuts))


def pack(values: np.ndarray) -> bytes:
    """An integer or float array as bytes, byte planes apart and zstd on top."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(len(raw), raw.dtype.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes, dtype) -> np.ndarray:
    size, item = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(item, -1).T).view(dtype).ravel()
