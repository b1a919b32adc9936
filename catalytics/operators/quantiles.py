"""Quantiles: approximate (bounded sketch) and exact (distributed).

Approximate
    ``percentile_approx`` is a partial aggregate over a Greenwald-Khanna
    sketch: per-task sketches of bounded size are merged, so memory does not
    grow with the data.  ``relative_error`` e maps to ``accuracy = 1/e``.

Exact
    ``percentile_disc`` and ``approxQuantile(..., 0.0)`` merge every distinct
    value into one buffer (one task or the driver).  The answer for
    probability p is the smallest value whose cumulative count reaches
    ``max(1, ceil(p * n))`` (the rank rule shared by ``percentile_disc``).
    It is found in two scans of the pruned columns, neither of which moves
    more than a bracket of values:

    1. one aggregation per column: row count and a bounded sketch
       (``percentile_approx``) read at p - d and p + d, giving a value
       bracket [lo, hi] that holds the target rank;
    2. one more scan: per (column, p), rows below lo collapse into a single
       counted row and rows inside [lo, hi] are counted per distinct value;
       a window per (column, p) over these few rows gives running counts, and
       the answer is the value where the running count first reaches the
       target rank.  This also *verifies* the bracket: if the rows below lo
       already reach the rank, or the bracket ends before it, the pair is
       recomputed by the fallback.

    A bracket that may hold more than ``max_bracket_rows`` rows is first
    narrowed by refinement rounds (one scan each: rows below/inside counted,
    inside values sketched on a grid of ``grid`` ranks).  A bracket that
    still fails verification or stays too large falls back to range slices: values counted per
    distinct value (partial aggregation collapses hot values), range-
    partitioned into ordered slices written once under
    ``spark.checkpoint.dir``, slice totals turned into offsets, and only the
    slice holding the target rank sorted.

``quantile_values`` first takes the columns with few different values: all of them are
counted, and the running counts give the answer by the same rank rule.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalytics.sources.io import cut_lineage, drop_stage, staged_path


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, value double) for every non-null, non-NaN value of ``columns``."""
    typed = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    if len(columns) == 1:
        out = typed.select(F.lit(columns[0]).alias("name"), F.col(f"`{columns[0]}`").alias("value"))
    else:
        out = typed.unpivot([], list(columns), "name", "value")
    return out.where(F.col("value").isNotNull() & ~F.isnan("value"))


def approx_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    relative_error: float = 0.01,
) -> DataFrame:
    """Long result (name, p, value) from one bounded-memory aggregation."""
    if relative_error <= 0:
        return exact_quantiles(df, columns, probs)
    accuracy = max(1, int(round(1.0 / relative_error)))
    vals = long_values(df, columns)
    sk = vals.groupBy("name").agg(
        F.percentile_approx("value", list(map(float, probs)), accuracy).alias("qs")
    )
    return sk.select(
        "name",
        F.posexplode("qs").alias("i", "value"),
    ).select(
        "name",
        F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1).alias("p"),
        "value",
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    slices: int | None = None,
    accuracy: int = 100_000,
    max_bracket_rows: int = 5_000_000,
    grid: int = 1000,
    max_rounds: int = 3,
) -> DataFrame:
    """Long result (name, p, value): exact quantiles, no task sees all values."""
    return _exact_quantiles(
        df, columns, probs, slices, accuracy, max_bracket_rows, grid, max_rounds
    )[0]


def _exact_quantiles(
    df,
    columns,
    probs,
    slices=None,
    accuracy=100_000,
    max_bracket_rows=5_000_000,
    grid=1000,
    max_rounds=3,
):
    """(result, staged frames to drop once the result has been collected)."""
    spark = df.sparkSession
    columns, probs = list(columns), [float(p) for p in probs]
    vals = long_values(df, columns)
    margin = 2.0 / accuracy
    lo_p = [max(0.0, p - margin) for p in probs]
    hi_p = [min(1.0, p + margin) for p in probs]
    # pass 1: count and sketch per column (bounded: one row per column)
    sketches = {
        r["name"]: (r["n"], r["qs"])
        for r in vals.groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx("value", lo_p + hi_p, accuracy).alias("qs"),
        )
        .collect()
    }
    pairs, wide, bad = [], [], []  # (name, p, target rank, lo, hi[, estimated rows])
    for c in columns:
        if c not in sketches:
            continue  # no values: no quantile
        n, qs = sketches[c]
        for i, p in enumerate(probs):
            # rows inside [lo, hi] are at most (hi_p - lo_p + 2/accuracy) * n by the sketch's bound
            lo, hi = qs[i], qs[len(probs) + i]
            # a window partition holds the bracket's distinct values: one when lo == hi
            est = 1.0 if lo == hi else (hi_p[i] - lo_p[i] + 2.0 / accuracy) * n
            pair = (c, p, max(1, math.ceil(p * n)), lo, hi)
            (wide if est > max_bracket_rows else pairs).append((*pair, est))
    for _ in range(max_rounds):
        if not wide:
            break
        narrowed, wide = _refine_brackets(vals, wide, accuracy, grid), []
        for pair in narrowed:
            (wide if pair[5] > max_bracket_rows else pairs).append(pair)
    bad += [(c, p) for c, p, *_ in wide]
    pairs = [pair[:5] for pair in pairs]
    found = []
    if pairs:
        picked = {r["k"]: r["bv"] for r in _bracket_pass(vals, pairs).collect()}
        for k, (c, p, r, lo, hi) in enumerate(pairs):
            if picked.get(k) is not None:
                found.append((c, p, float(picked[k])))
            else:  # the bracket missed the rank (started too high or ended too low)
                bad.append((c, p))
    out = spark.createDataFrame(found, "name string, p double, value double")
    staged = []
    if bad:
        fb_cols = sorted({c for c, _ in bad})
        fb_probs = sorted({p for _, p in bad})
        fb, ranged = _range_slice_quantiles(df, fb_cols, fb_probs, slices)
        wanted = F.lit(False)
        for c, p in bad:
            wanted = wanted | ((F.col("name") == F.lit(c)) & (F.col("p") == F.lit(p)))
        out = out.unionByName(fb.where(wanted))
        staged.append(ranged)
    return out, staged


def _refine_brackets(vals: DataFrame, wide, accuracy: int, grid: int):
    """One scan that narrows brackets too large to sort: per pair, the rows
    below and inside the bracket are counted and the inside values sketched
    at ``grid`` evenly spaced ranks; the target's rank inside the bracket
    then picks two grid points (widened by the sketch's error) as the new
    bracket.  Each round shrinks a bracket by about ``grid / 2``."""
    name, value = F.col("name"), F.col("value")
    by_col: dict[str, list] = {}
    for k, (c, p, r, lo, hi, est) in enumerate(wide):
        tag = F.when(
            value < F.lit(lo), F.struct(F.lit(k).alias("k"), F.lit(True).alias("below"))
        ).when(value <= F.lit(hi), F.struct(F.lit(k).alias("k"), F.lit(False).alias("below")))
        by_col.setdefault(c, []).append(tag)
    tags = None
    for c, whens in by_col.items():
        cond = name == F.lit(c)
        tags = F.when(cond, F.array(*whens)) if tags is None else tags.when(cond, F.array(*whens))
    points = [j / grid for j in range(grid + 1)]
    stats = (
        vals.select(F.explode(tags).alias("t"), "value")
        .where(F.col("t").isNotNull())
        .groupBy(F.col("t.k").alias("k"))
        .agg(
            F.count_if(F.col("t.below")).alias("below"),
            F.count_if(~F.col("t.below")).alias("inside"),
            F.percentile_approx(F.when(~F.col("t.below"), F.col("value")), points, accuracy).alias("qs"),
        )
        .collect()
    )
    by_k = {row["k"]: row for row in stats}
    out = []
    for k, (c, p, r, lo, hi, est) in enumerate(wide):
        row = by_k.get(k)
        below, inside, qs = (row["below"], row["inside"], row["qs"]) if row else (0, 0, None)
        if not inside or not qs or not (below < r <= below + inside):
            out.append((c, p, r, lo, hi, float("inf")))  # cannot narrow: leave to the fallback
            continue
        pos = (r - below) / inside  # the target's relative rank inside the bracket
        slack = 1.0 / grid + 2.0 / accuracy
        j_lo = max(0, math.floor((pos - slack) * grid))
        j_hi = min(grid, math.ceil((pos + slack) * grid))
        new_est = (j_hi - j_lo) / grid * inside + 2.0 * inside / accuracy
        if qs[j_lo] == qs[j_hi]:
            new_est = 1.0
        out.append((c, p, r, qs[j_lo], qs[j_hi], new_est))
    return out


def _bracket_pass(vals: DataFrame, pairs) -> DataFrame:
    """Passes 2+3 in one scan.  Per pair k, rows below ``lo`` collapse into one
    row with a null key and rows inside [lo, hi] are counted per value; a
    window per k (null key first) gives running counts, and the row where the
    count first reaches the target rank is the answer.  If that row is the
    null one the bracket started too high; if no row reaches the rank it ended
    too low.  Each window partition holds the bracket's distinct values + 1."""
    name, value = F.col("name"), F.col("value")
    by_col: dict[str, list] = {}
    for k, (c, p, r, lo, hi) in enumerate(pairs):
        tag = F.when(
            value < F.lit(lo), F.struct(F.lit(k).alias("k"), F.lit(True).alias("below"))
        ).when(value <= F.lit(hi), F.struct(F.lit(k).alias("k"), F.lit(False).alias("below")))
        by_col.setdefault(c, []).append(tag)
    tags = None
    for c, whens in by_col.items():
        cond = name == F.lit(c)
        tags = F.when(cond, F.array(*whens)) if tags is None else tags.when(cond, F.array(*whens))
    counted = (
        vals.select(F.explode(tags).alias("t"), "value")
        .where(F.col("t").isNotNull())
        .select(F.col("t.k").alias("k"), F.when(~F.col("t.below"), F.col("value")).alias("bv"))
        .groupBy("k", "bv")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy("k").orderBy(F.col("bv").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    target = F.element_at(F.array(*[F.lit(x[2]) for x in pairs]), F.col("k") + 1)
    cum = counted.withColumn("cum", F.sum("n").over(w))
    return cum.where((F.col("cum") >= target) & (F.col("cum") - F.col("n") < target)).select("k", "bv")


def _range_slice_quantiles(df, columns, probs, slices=None):
    """Fallback: exact quantiles from range slices of the distinct values."""
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = long_values(df, columns).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    ranged = cut_lineage(
        counts.repartitionByRange(slices, "name", "value").withColumn(
            "slice", F.spark_partition_id()
        ),
        "quantile-slices",
    )
    per_slice = ranged.groupBy("name", "slice").agg(F.sum("n").alias("slice_n"))
    w_before = Window.partitionBy("name").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_slice.select(
        "name",
        "slice",
        "slice_n",
        F.coalesce(F.sum("slice_n").over(w_before), F.lit(0)).alias("before"),
        F.sum("slice_n").over(Window.partitionBy("name")).alias("total"),
    )
    # (name, slice, p, target) for the one slice that holds each target rank;
    # at most len(columns) * slices * len(probs) rows, so broadcasting is bounded.
    targets = (
        offsets.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("target", F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("total"))))
        .where((F.col("before") < F.col("target")) & (F.col("target") <= F.col("before") + F.col("slice_n")))
        .select("name", "slice", "p", "target", "before")
    )
    inside = ranged.join(F.broadcast(targets), ["name", "slice"])
    w_cum = Window.partitionBy("name", "slice", "p").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cum = inside.withColumn("cum", F.col("before") + F.sum("n").over(w_cum))
    out = cum.where(
        (F.col("cum") >= F.col("target")) & (F.col("cum") - F.col("n") < F.col("target"))
    ).select("name", "p", "value")
    return out, ranged


#: Columns of at most about this many different values have all of them counted: their
#: counts are sorted by one task a column.
COUNTED_VALUES = 100_000


def _counted_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> tuple[dict, list[str]]:
    """({(column, p): value} of the columns with few different values, the other columns).

    Distinct values are estimated first (one aggregation of bounded memory).  Each value is
    then counted, combined on the map side, so a task sends no more rows than it has
    different values, where sketches grow with the number of tasks.
    """
    typed = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    distinct = typed.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    few = [c for i, c in enumerate(columns) if distinct[f"d{i}"] <= COUNTED_VALUES]
    if not few:
        return {}, list(columns)
    counts = long_values(df, few).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("name")
    upto = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumns({"cum": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    ranked = ranked.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    target = F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("total")))
    picked = ranked.where((F.col("cum") >= target) & (F.col("cum") - F.col("n") < target)).select("name", "p", "value")
    return {(r["name"], r["p"]): r["value"] for r in picked.collect()}, [c for c in columns if c not in few]


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    relative_error: float = 0.0,
) -> DataFrame:
    """Quantiles of many columns in one pass; exact when the error is 0."""
    if relative_error <= 0:
        return exact_quantiles(df, columns, probs)
    return approx_quantiles(df, columns, probs, relative_error)


def quantile_values(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], relative_error: float = 0.0
) -> dict[str, list[float | None]]:
    """Driver-side dict {column: [q per prob]} — a bounded result (one value per
    column and probability); columns with no values get None (an all-null
    column has no quantile)."""
    got = {}
    if relative_error <= 0:
        got, many = _counted_quantiles(df, columns, probs)
        qdf, staged = _exact_quantiles(df, many, probs) if many else (None, [])
        rows = qdf.collect() if many else []
        # the result is on the driver now: fallback slice tables are not needed
        for frame in staged:
            path = staged_path(frame)
            if path:
                drop_stage(df.sparkSession, path)
    else:
        rows = approx_quantiles(df, columns, probs, relative_error).collect()
    got |= {(r["name"], r["p"]): r["value"] for r in rows}
    return {c: [got.get((c, float(p))) for p in probs] for c in columns}


def wide_quantiles(
    qdf: DataFrame, names: dict[tuple[str, float], str], types: dict[str, str] | None = None
) -> DataFrame:
    """Pivot a long quantile result into one row: ``names[(column, p)]`` -> alias."""
    types = types or {}
    aggs = []
    for (col, p), alias in names.items():
        v = F.max(F.when((F.col("name") == col) & (F.col("p") == float(p)), F.col("value")))
        aggs.append(v.cast(types.get(alias, "double")).alias(alias))
    return qdf.agg(*aggs)


def ceil_rank(p: float, n: int) -> int:
    """The 1-based rank rule used above (for tests and brute-force checks)."""
    return max(1, math.ceil(p * n))


def rank_check(
    df: DataFrame, values: Sequence[tuple[str, float, float]], relative_error: float
) -> DataFrame:
    """(column, p, n, within) for approximate quantiles (column, p, value): one
    aggregation counts the rows up to each value; ``within`` says whether its rank
    is no further than ``relative_error * n`` from the one asked for."""
    counts, lines = [], []
    for i, (c, p, value) in enumerate(values):
        v = F.col(f"`{c}`").cast("double")
        known = v.isNotNull() & ~F.isnan(v)
        counts += [
            F.count_if(known).alias(f"n{i}"),
            F.count_if(known & (v < F.lit(float(value)))).alias(f"below{i}"),
            F.count_if(known & (v <= F.lit(float(value)))).alias(f"upto{i}"),
        ]
        n = F.col(f"n{i}")
        low, high = F.floor(n * (p - relative_error)), F.ceil(n * (p + relative_error))
        lines.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(float(p)).alias("p"),
                n.alias("n"),
                ((F.col(f"below{i}") < high) & (F.col(f"upto{i}") >= low)).alias("within"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*lines)))
