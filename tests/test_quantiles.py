"""Exact distributed quantiles vs brute force, including a hot value that
holds a third of all rows, nulls and NaN."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from catalytics.operators.quantiles import approx_quantiles, ceil_rank, exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def brute(values, p):
    vals = sorted(v for v in values if v is not None and not math.isnan(v))
    if not vals:
        return None
    return vals[ceil_rank(p, len(vals)) - 1]


def run_exact(spark, rows, slices=4, **kw):
    df = spark.createDataFrame([(a, b) for a, b in rows], "a double, b double")
    got = {(r["name"], r["p"]): r["value"] for r in exact_quantiles(df, ["a", "b"], PROBS, slices, **kw).collect()}
    return got


def test_hot_value_third_of_rows(spark):
    rng = np.random.default_rng(7)
    n = 3000
    a = rng.normal(100, 30, n).round(2).tolist()
    a[: n // 3] = [42.0] * (n // 3)  # one value holds a third of the rows
    b = [None if i % 11 == 0 else float(i % 97) for i in range(n)]
    b[5] = float("nan")
    for kw in (
        {},  # bracket
        {"accuracy": 20},  # wide bracket
        {"accuracy": 20, "max_bracket_rows": 60, "grid": 10},  # refined brackets
        {"max_bracket_rows": 0, "max_rounds": 0},  # range-slice fallback
    ):
        got = run_exact(spark, list(zip(a, b)), slices=8, **kw)
        for p in PROBS:
            assert got[("a", p)] == brute(a, p), kw
            assert got[("b", p)] == brute(b, p), kw


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-50, 50).map(float)),
            st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_exact_matches_brute_force(spark, rows):
    for kw in ({}, {"accuracy": 10, "max_bracket_rows": 4, "grid": 4}, {"max_bracket_rows": 0, "max_rounds": 0}):
        got = run_exact(spark, rows, slices=3, **kw)
        for col, idx in (("a", 0), ("b", 1)):
            vals = [r[idx] for r in rows]
            for p in PROBS:
                assert got.get((col, p)) == brute(vals, p), kw


def test_approx_is_exact_on_small_input(spark):
    vals = [float(v) for v in range(1, 101)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r["p"]: r["value"] for r in approx_quantiles(df, ["x"], [0.25, 0.5, 0.75], 0.001).collect()}
    assert got == {0.25: 25.0, 0.5: 50.0, 0.75: 75.0}


@pytest.mark.parametrize("n,p,rank", [(4, 0.5, 2), (5, 0.5, 3), (6, 0.75, 5), (10, 0.0, 1), (10, 1.0, 10)])
def test_rank_rule(n, p, rank):
    assert ceil_rank(p, n) == rank


def test_continuous_column_bracket_path_is_exact(spark):
    rng = np.random.default_rng(11)
    x = rng.lognormal(8, 2, 20000).round(3).tolist()
    df = spark.createDataFrame([(v,) for v in x], "x double")
    for kw in ({}, {"accuracy": 50, "max_bracket_rows": 100, "grid": 20}):
        got = {r["p"]: r["value"] for r in exact_quantiles(df, ["x"], [0.25, 0.5, 0.75, 0.99], **kw).collect()}
        assert got == {p: brute(x, p) for p in (0.25, 0.5, 0.75, 0.99)}, kw


def test_eager_median_leaves_no_slice_table(spark):
    import glob

    from catalytics.operators.quantiles import quantile_values
    from catalytics.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{base}/catalytics-quantile-slices-*"))
    df = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    assert quantile_values(df, ["x"], [0.5]) == {"x": [49.0]}
    after = set(glob.glob(f"{base}/catalytics-quantile-slices-*"))
    assert after == before


def test_release_scratch_removes_session_folders(spark):
    import os

    from catalytics.plans.stages import release_session
    from catalytics.sources.io import cut_lineage

    df = cut_lineage(spark.createDataFrame([(1,)], "x int"), "release-check")
    path = df.inputFiles()[0].replace("file:", "").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    assert release_session(spark) >= 1
    assert not os.path.exists(path)
