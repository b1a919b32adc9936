"""Embedding near-duplicates by an exact metric range join (operator 12).

Vectors of one label are linked when their cosine is at least ``threshold``, that is when
their directions lie at most ``r = sqrt(2 - 2 * threshold)`` apart on the unit sphere.

1. Equal vectors of a label become one class with its number of copies.
2. A task is a set of classes whose pairs are open, at first all of a label.  A task
   of more than ``ROOM`` classes is divided: some of its members are pivots, each class
   belongs to the cell of its nearest pivot.  Two classes linked across cells p and q lie
   within r of each other, so by the triangle inequality each is within r of the plane
   between both pivots: ``(d(u,q)^2 - d(u,p)^2) <= 2 * d(p,q) * r``.  Only such classes are
   copied to the task of (p, q), which compares the two sides with each other; the task
   of (p, p) holds the cell.  So each pair is open in one task at most, and cells are
   joined independently.  Tasks that are still too large are divided again; one that its
   pivots hardly divided is dealt by hash instead, which leaves out nothing either.
3. A task of at most ``ROOM`` classes is one matrix product.  It returns sums, not
   pairs: a class's number of linked vectors, and the smallest class of its component within
   the task.  Counts are added up, components are joined over tasks.

Work and memory: a task never has more than ``ROOM`` vectors in Python; dividing goes by
groups of (task, salt) of about ``ROOM`` rows; pivots are at most ``PIVOTS`` rows a task
and meet their task by key.  Where the triangle inequality can't rule out anything
(directions spread evenly in many dimensions) every pair of cells is compared, once.

Defined results: a vector that is null, empty, all zero or holds a null or non-finite
component, and one without a label, links with nothing; nor do vectors of different
lengths.  Copies and repeated rows are other vectors, linked with each other.  A null id
counts as largest: ``component_id`` is null only where all ids are.  A cosine equal to the
threshold links.  An empty table gives no rows.  Only the three named columns are read,
so others may have any name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalytics.llm.common import cut_lineage
from catalytics.llm.components import components

THRESHOLD = 0.93
ROOM = 2048
PIVOTS = 16
#: Added to distances: far above their rounding errors, so no link is lost by them.
SLACK = 1e-6
#: A task with this share of the one that it came from counts as hardly divided.
HARDLY = 0.7

OPEN = "space string, path string, side int, parent bigint, class bigint, copies bigint, v {}"
#: Rows of a task that are compared with all others at a time.
ROWS = 512


def _numbers(vectors: DataFrame, column: str) -> Column:
    """The vectors as they are, if they hold floats or doubles; else as doubles."""
    kind = vectors.schema[column].dataType.simpleString()
    return F.col(f"`{column}`") if kind in ("array<float>", "array<double>") else F.col(f"`{column}`").cast("array<double>")


def classes_of(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows that can link, rows that can't, classes of equal vectors of a label)."""
    read = vectors.select(F.col(f"`{id_column}`").alias("id"), _numbers(vectors, vector_column).alias("v"), F.col(f"`{label_column}`").cast("string").alias("label"))
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    links = F.coalesce(F.col("label").isNotNull() & (F.size(v) > 0) & fine, F.lit(False))
    rows = read.withColumn("space", F.concat_ws(":", F.size(v), "label")).withColumn("links", links)
    able = rows.filter("links").select("id", "space", "v")
    classes = able.groupBy("space", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    classes = cut_lineage(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    return able, rows.filter("NOT links").select("id"), classes


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, each times a power of two so that squares stay finite."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])


def _directions(column: pa.Array) -> np.ndarray:
    rows = _matrix(column)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def cells(directions: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot, which cells' boundary each direction is near to)."""
    squares = np.maximum(0, 2 - 2 * directions @ pivots.T)
    home = squares.argmin(1)
    between = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
    beyond = squares - squares[np.arange(len(home)), home][:, None]
    near = beyond <= 2 * between[home] * (radius + SLACK) + SLACK
    near[np.arange(len(home)), home] = False
    return home, near


def _divide(radius: float):
    """A (task, salt) group and its pivots -> the group's copies in the tasks below."""
    names = [field.split()[0] for field in OPEN.split(", ")]

    def divide(members: pa.Table, pivots: pa.Table) -> pa.Table:
        if not members.num_rows:  # a salt that no class has
            return members.select(names)
        side = members["side"].to_numpy()
        if members["by_hash"][0].as_py():
            k = members["ways"][0].as_py()
            home = members["dealt"].to_numpy() % k
            near = np.ones((len(home), k), bool)
            near[np.arange(len(home)), home] = False
        else:
            home, near = cells(_directions(members["v"]), _directions(pivots["v"]), radius)
            k = near.shape[1]
        stay, (row, other) = np.arange(len(home)), np.nonzero(near)
        # one side: the pair (p, q) with p < q, sides 1 and 2; two sides: (cell of side 1, cell of side 2)
        mine, one = home[row], side[row] == 0
        first = np.where(one, mine < other, side[row] == 1)
        keys = np.concatenate([home * k + home, np.where(first, mine * k + other, other * k + mine)])
        taken = np.concatenate([stay, row])
        sides = np.concatenate([side, np.where(first, 1, 2)])
        out = members.take(pa.array(taken))
        parent = pa.array(np.full(len(taken), members["size"][0].as_py()), pa.int64())
        steps = [f".{key // k}-{key % k}" for key in range(k * k)]
        path = pa.array([a + steps[b] for a, b in zip(out["path"].to_pylist(), keys.tolist(), strict=True)], pa.string())
        return pa.table({"space": out["space"], "path": path, "side": pa.array(sides, pa.int32()), "parent": parent, "class": out["class"], "copies": out["copies"], "v": out["v"]})

    return divide


def _linked(threshold: float):
    """All pairs of one task at once: (class, linked vectors, smallest linked class)."""

    def link(members: pa.Table) -> pa.Table:
        rows, side = _matrix(members["v"]), members["side"].to_numpy()
        names, copies = members["class"].to_numpy(), members["copies"].to_numpy()
        norms = np.linalg.norm(rows, axis=1)
        linked = np.empty((len(rows), len(rows)), bool)
        for at in range(0, len(rows), ROWS):
            some = slice(at, at + ROWS)
            linked[some] = rows[some] @ rows.T / (norms[some, None] * norms[None]) >= threshold
            linked[some] &= (side[some, None] != side[None]) | (side[some, None] == 0)
        np.fill_diagonal(linked, False)
        counts = linked @ copies
        root = np.arange(len(names))
        waiting = counts > 0
        order = np.argsort(names)
        for start in order[waiting[order]]:
            if not waiting[start]:
                continue
            front, reached = np.array([start]), np.zeros(len(names), bool)
            reached[start] = True
            while len(front):
                beyond = linked[front].any(0) & ~reached
                reached |= beyond
                front = np.flatnonzero(beyond)
            root[reached] = start
            waiting &= ~reached
        found = np.flatnonzero(counts)
        return pa.table({"class": names[found], "links": counts[found], "root": names[root[found]]}, schema=pa.schema([("class", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]))

    return link


def range_join(classes: DataFrame, threshold: float = THRESHOLD, room: int = ROOM, pivots: int = PIVOTS) -> DataFrame:
    """(class, links, root) of every task in which a class has links; classes: (space, class, copies, v)."""
    spark = classes.sparkSession
    radius = math.sqrt(max(0.0, 2 - 2 * threshold)) if threshold > -1 else 2.0
    task = ["space", "path"]
    now = classes.select("space", F.lit("").alias("path"), F.lit(0).alias("side"), F.lit(0).cast("bigint").alias("parent"), "class", "copies", "v")
    done = []
    while True:
        # pairs need both sides; a task of two sides with one of them empty is over
        sizes = now.groupBy(*task).agg(F.count(F.lit(1)).alias("size"), F.min("side").alias("one"), F.max("side").alias("two"))
        sizes = cut_lineage(sizes.filter("size > 1 AND (one = 0 OR one < two)").drop("one", "two"), "sizes")
        sized = now.join(sizes, task)
        done.append(sized.filter(F.col("size") <= room).select(*task, "side", "class", "copies", "v"))
        if sizes.filter(F.col("size") > room).isEmpty():
            break
        # so many cells that two of them fill a task, if the pivots divide evenly
        large = sized.filter(F.col("size") > room).withColumns(
            {
                "ways": F.least(F.lit(pivots), F.ceil(2 * F.col("size") / room)).cast("int"),
                "by_hash": (F.col("parent") > 0) & (F.col("size") > HARDLY * F.col("parent")),
                "dealt": F.pmod(F.xxhash64("class", "path"), F.lit(1 << 30)),
                "salts": F.ceil(F.col("size") / room).cast("int"),
            }
        )
        ranked = F.row_number().over(Window.partitionBy(*task).orderBy("dealt", "class"))
        chosen = large.withColumn("nth", ranked).filter(F.col("nth") <= pivots).filter("nth <= ways")
        salted = cut_lineage(chosen.select(*task, "v", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")), "pivots")
        large = large.withColumn("salt", F.pmod(F.xxhash64("path", "class"), F.col("salts")).cast("int"))
        key = [*task, "salt"]
        divided = large.groupBy(*key).cogroup(salted.groupBy(*key)).applyInArrow(_divide(radius), OPEN.format(classes.schema["v"].dataType.simpleString()))
        now = cut_lineage(divided, "open-pairs")
    found = [tasks.groupBy(*task).applyInArrow(_linked(threshold), "class bigint, links bigint, root bigint") for tasks in done]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def link_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = THRESHOLD,
    room: int = ROOM,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``vectors``."""
    able, unable, classes = classes_of(vectors, id_column, vector_column, label_column)
    found = cut_lineage(range_join(classes, threshold, room), "links")
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.filter("class <> root").select(F.col("class").alias("a"), F.col("root").alias("b")))
    placed = classes.join(roots, classes["class"] == roots["node"], "left").select("class", "space", "v", "copies", "least", F.coalesce("root", "class").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    # the copies of a vector differ in nothing else, so their class is found by the vector
    known = placed.join(counts, "class", "left").join(least, "root")
    known = cut_lineage(known.select("space", "v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "classes")
    linked = able.join(known, ["space", "v"]).select("id", "n_links", "component_id")
    alone = unable.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    return out.withColumnRenamed("id", id_column)
