"""Train/test splits.

``split_random`` is MLlib's usual ``randomSplit``; its result depends on how
the input is partitioned.  ``split_by_key`` assigns each row by a hash of a
key, so the same rows land on the same side on any cluster, and rows sharing
a key never straddle the split.  Nothing is dropped: every row is on exactly
one side.  ``split_by_locator`` is a seeded random split of single rows: a hash of
what identifies a row stands in for the random number, so the sides are the same under
any number of partitions, after a retried task and in another engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalytics import fixed

# Multiplicative hash on the low 32 bits of an integer key: small enough that
# the product never overflows a 64-bit integer, and the same in any SQL engine.
_HASH_MULTIPLIER = 40503
_HASH_MODULUS = 65536


def split_random(
    df: DataFrame, weights: Sequence[float] = tuple(fixed.SPLIT_WEIGHTS), seed: int = fixed.SPLIT_SEED
) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def key_slot(df: DataFrame, key: str, salt: int = 0) -> Column:
    """A value in [0, 1) from a key (deterministic on any cluster).

    Integer keys use a multiplicative hash on their low 32 bits, text keys the
    first 16 bits of their MD5 (both the same in any SQL engine); other key
    types use Spark's ``xxhash64``.  A null key gets slot 0, so it still lands
    on exactly one side.
    """
    k = F.col(f"`{key}`")
    if isinstance(df.schema[key].dataType, T.IntegralType):
        low = F.pmod(k.cast("long"), F.lit(4294967296))
        mixed = F.pmod(low * F.lit(_HASH_MULTIPLIER) + F.lit(salt), F.lit(_HASH_MODULUS))
    elif isinstance(df.schema[key].dataType, T.StringType):
        digest = F.md5(F.concat(F.lit(f"{salt}:"), k))
        mixed = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")
    else:
        mixed = F.pmod(F.xxhash64(k, F.lit(salt)), F.lit(_HASH_MODULUS))
    return F.coalesce(mixed / F.lit(float(_HASH_MODULUS)), F.lit(0.0))


def label_split(
    df: DataFrame,
    key: str,
    train_fraction: float = fixed.SPLIT_WEIGHTS[0],
    salt: int = 0,
    name: str = "split",
) -> DataFrame:
    """Add ``name`` = 'train' / 'test' by the key's slot."""
    side = F.when(key_slot(df, key, salt) < F.lit(train_fraction), F.lit("train")).otherwise(
        F.lit("test")
    )
    return df.withColumn(name, side)


def split_by_key(
    df: DataFrame, key: str, train_fraction: float = fixed.SPLIT_WEIGHTS[0], salt: int = 0
) -> tuple[DataFrame, DataFrame]:
    slot = key_slot(df, key, salt)
    return df.where(slot < train_fraction), df.where(slot >= train_fraction)


#: Hex digits of a row's hash that make its number in [0, 1): 52 bits, exact in a double.
_DIGITS = 13


def with_file_locator(df: DataFrame, name: str = "locator") -> DataFrame:
    """Adds a locator to a Parquet scan without a key: the file's name and the row's place in it.

    Both come from the reader, so they don't depend on how files are cut into tasks.
    """
    where = F.concat_ws(":", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.col("_metadata.row_index").cast("string"))
    return df.withColumn(name, where)


def row_number_in_01(locator: Sequence[str], seed: int) -> Column:
    """The row's pseudo-random number in [0, 1), from an MD5 of seed and locator columns.

    A null locator value counts as the empty text, marked apart from it.
    """
    values = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in locator]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *values))
    number = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint")
    return number / F.lit(float(16**_DIGITS))


def split_by_locator(
    df: DataFrame,
    locator: Sequence[str],
    weights: Sequence[float] = tuple(fixed.SPLIT_WEIGHTS),
    seed: int = fixed.SPLIT_SEED,
    name: str = "part",
) -> DataFrame:
    """Adds ``name`` = 0, 1, ...: the part of each row, parts sized by ``weights``.

    ``locator`` names the columns that identify a row.  Rows with equal locators share a
    part.  No shuffle: a projection, so each part is a filter of the input.
    """
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must be non-negative, one at least positive")
    number, below, part = row_number_in_01(locator, seed), 0.0, F.lit(len(weights) - 1)
    bounds = []
    for w in weights[:-1]:
        below += w / sum(weights)
        bounds.append(below)
    for i, bound in reversed(list(enumerate(bounds))):
        part = F.when(number < F.lit(bound), F.lit(i)).otherwise(part)
    return df.withColumn(name, part)


def split_sizes(df: DataFrame, weights: Sequence[float] = tuple(fixed.SPLIT_WEIGHTS), name: str = "part", sigmas: float = 5.0) -> DataFrame:
    """(part, n, expected, within): each part's size against its binomial expectation."""
    counted = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    share = F.array(*[F.lit(w / sum(weights)) for w in weights])[F.col(name)]
    far = F.lit(sigmas) * F.sqrt(F.lit(float(total)) * share * (1 - share))
    return counted.select(F.col(name).alias("part"), "n", (share * total).alias("expected"), (F.abs(F.col("n") - share * total) <= far).alias("within"))
