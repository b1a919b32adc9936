"""Vector code compression by member-resident Lloyd rounds (operator 11).

Vectors become integers (``floor(SCALE * x)``) and are cut into ``PARTS`` equal parts; each
part position has a codebook of at most ``ENTRIES`` entries, first the parts of the
smallest ids.  The parts lie in files by (position, entry, salt), an owner's members:

1. The first assignment deals every part to its owner, the only shuffle of all parts.
2. Owners sum their resident members where they lie; only one row of sums per entry and
   task travels, and the entries (``PARTS * ENTRIES`` rows at most) become the new
   codebooks on the driver.
3. Each owner judges its members by the new codebooks.  Those that stay are written
   where they are read; only parts that change entry go through the next shuffle.

After the last round the parts are judged once more, and 16 small rows per vector meet to
give its code and error.  The salt splits an entry that holds many parts into owners of
at most about ``OWNER`` members, so one value held by a third of all rows is
no large task.  Every round is a written table, so a lost executor costs its own files.

Defined results: a vector that is null, empty or holds a null or non-finite component has
no row; nor has one whose length is no multiple of ``PARTS`` or not that of the first
entry, or with a component beyond ``LARGEST`` in size (squares must be exact in 64 bits).
Null ids come after all others; rows with the same id, also equal rows, are coded once
each and are ordered by their vectors as first entries.  With fewer vectors than
``ENTRIES`` the codebooks are shorter; an empty table gives no rows.  Ties go to the lower
entry.  Only the id, vector and label columns are read, whatever others are called.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalytics.llm.common import cut_lineage, drop_stage
from catalytics.sources.io import staged_path

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
OWNER = 100_000
LARGEST = 2.0**18

MEMBER = "row bigint, position int, entry int, salt int, part array<int>"


def integers(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, parts: int) -> DataFrame:
    """(id, label, v) of the vectors that count, components as integers."""
    v = F.col("v")
    read = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"), F.col(f"`{vector_column}`").cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    return read.filter(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & fine).withColumn(
        "v", F.transform(v, lambda x: F.floor(x * SCALE).cast("int"))
    )


def nearest(part: np.ndarray, position: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each part by its position's codebook; ties to the lower entry."""
    entry, distance = np.empty(len(part), np.int64), np.empty(len(part), np.int64)
    for p in np.unique(position):
        rows = np.flatnonzero(position == p)
        for at in range(0, len(rows), 4096):
            some = rows[at : at + 4096]
            apart = np.zeros((len(some), codebooks.shape[1]), np.int64)
            for k in range(codebooks.shape[2]):
                apart += (part[some, k][:, None] - codebooks[p, :, k][None]) ** 2
            entry[some] = apart.argmin(1)
            distance[some] = apart[np.arange(len(some)), entry[some]]
    return entry, distance


def _parts_of(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch[name].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _members(row, position, entry, salt, part) -> pa.RecordBatch:
    width = part.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(part.ravel(), pa.int32()))
    columns = [pa.array(row, pa.int64()), *(pa.array(x, pa.int32()) for x in (position, entry, salt)), lists]
    return pa.RecordBatch.from_arrays(columns, names=["row", "position", "entry", "salt", "part"])


def _first_owners(codebooks: np.ndarray):
    """Rows of whole vectors -> their parts with their first entries."""
    parts, _, width = codebooks.shape

    def deal(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                part = _parts_of(some, "v", width)
                row = np.repeat(some["row"].to_numpy(), parts)
                position = np.tile(np.arange(parts), some.num_rows)
                yield _members(row, position, nearest(part, position, codebooks)[0], np.zeros(len(row)), part)

    return deal


def _judged(codebooks: np.ndarray, stay: bool):
    """Of the resident members those that stay, or those that go, with their new entries."""
    width = codebooks.shape[2]

    def judge(batches):
        for batch in batches:
            position, entry, part = batch["position"].to_numpy(), batch["entry"].to_numpy(), _parts_of(batch, "part", width)
            new = nearest(part, position, codebooks)[0]
            keep = np.flatnonzero((new == entry) == stay)
            yield _members(batch["row"].to_numpy()[keep], position[keep], new[keep], batch["salt"].to_numpy()[keep], part[keep])

    return judge


def _coded(codebooks: np.ndarray):
    width = codebooks.shape[2]

    def code(batches):
        for batch in batches:
            position = batch["position"].to_numpy()
            entry, distance = nearest(_parts_of(batch, "part", width), position, codebooks)
            yield pa.RecordBatch.from_arrays([batch["row"], batch["position"], pa.array(entry), pa.array(distance)], names=["row", "position", "entry", "apart"])

    return code


def _updated(members: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Each entry becomes the floor of its members' mean; the sums are taken where the members lie."""
    width = codebooks.shape[2]
    sums = members.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("part")[k].cast("bigint")).alias(f"s{k}") for k in range(width)])
    new = codebooks.copy()
    for r in sums.collect():  # one row an entry
        new[r.position, r.entry] = [r[f"s{k}"] // r.n for k in range(width)]
    return new


def fit(rows: DataFrame, first: np.ndarray, rounds: int, owner: int) -> tuple[np.ndarray, DataFrame]:
    """(codebooks, members) after ``rounds`` of assignment and update; rows: (row, v)."""
    dealt = ("position", "entry", "salt")
    codebooks = first
    members = rows.select("row", "v").mapInArrow(_first_owners(codebooks), MEMBER)
    salts = max(1, -(-rows.count() // owner))  # an entry holds one part of a vector at most
    members = members.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    members = cut_lineage(members.repartition(*dealt), "members")
    for k in range(rounds):
        if k:
            stay = members.mapInArrow(_judged(codebooks, True), MEMBER)
            gone = members.mapInArrow(_judged(codebooks, False), MEMBER).repartition(*dealt)
            left, members = staged_path(members), cut_lineage(stay.unionByName(gone), "members")
            if left:
                drop_stage(rows.sparkSession, left)
        codebooks = _updated(members, codebooks)
    return codebooks, members


def compress(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    owner: int = OWNER,
) -> tuple[DataFrame, np.ndarray]:
    """((id, label, code, error), codebooks): a code byte per part in hex, the summed
    squared distances, and the entries by part, entry and place within the part."""
    spark = vectors.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    kept = integers(vectors, id_column, vector_column, label_column, parts)
    # numbered and written once: all later steps speak of the same rows
    rows = cut_lineage(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not seeds:
        empty = rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return empty, np.empty((parts, 0, 0), np.int64)
    size = len(seeds[0].v)
    first = np.array([s.v for s in seeds if len(s.v) == size], np.int64).reshape(-1, parts, size // parts).transpose(1, 0, 2)
    rows = rows.filter(F.size("v") == size)
    codebooks, members = fit(rows, first, rounds, owner)
    coded = members.select("row", "position", "part").mapInArrow(_coded(codebooks), "row bigint, position int, entry bigint, apart bigint")
    words = range(-(-parts // 8))  # eight code bytes to a 64-bit number
    shift = [F.when(F.col("position") == p, F.shiftleft("entry", 8 * (7 - p % 8))) for p in range(parts)]
    whole = coded.groupBy("row").agg(
        *[F.sum(F.coalesce(*shift[8 * w : 8 * w + 8], F.lit(0).cast("bigint"))).alias(f"w{w}") for w in words],
        F.sum("apart").alias("error"),
    )
    hexes = F.concat(*[F.lower(F.lpad(F.hex(f"w{w}"), 16, "0")) for w in words])
    whole = whole.select("row", F.substring(hexes, 1, 2 * parts).alias("code"), "error")
    return rows.select("row", "id", "label").join(whole, "row").select("id", "label", "code", "error"), codebooks


def label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over rows of equal label (nulls together)."""
    coded = cut_lineage(coded, "codes")
    total = cut_lineage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    total = total.withColumnRenamed("label", "of_label")
    return coded.join(total, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
