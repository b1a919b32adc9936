"""E1 on the 17-row raw fixture: expected values from FIXTURES.md §2."""

import pytest
from pyspark.sql import functions as F

from catalytics import fixed
from catalytics.operators.reports import duplicate_key_count, outlier_report
from catalytics.operators.rules import catalogue_rules, rule_report
from catalytics.plans import jobs
from catalytics.sources.io import read_raw_csv


def test_escape_keeps_columns(raw):
    last = raw.where(F.col("App Name").startswith("Say")).first()
    assert last["Category"] == "Tools"
    assert last["App Name"] == 'Say "hi", again'


def test_default_escape_would_shift(spark):
    from tests.conftest import FIXTURE_CSV

    shifted = read_raw_csv(spark, FIXTURE_CSV, fixed.RAW_COLUMNS, escape="\\")
    assert shifted.where(F.col("Category") == "a1").count() == 1


def test_rule_report_counts(raw, ansi):
    rep = {r["rule"]: r for r in rule_report(jobs.type_catalogue(raw), catalogue_rules()).collect()}
    assert [rep[n]["rows_after"] for n, _ in catalogue_rules()] == [16, 14, 11, 10]
    assert rep["installs_at_least_minimum"]["rows_before"] == 17


def test_median_then_identifier_filter(raw, ansi):
    cleaned = jobs.clean_catalogue(raw)
    rows = {(r["App Id"], r["Rating"]): r for r in cleaned.collect()}
    assert len(rows) == 9
    # a3 had "Varies with device": filled with the median of the 10 rows (5120, not 10240)
    assert rows[("a3", 0.0)]["Size_KB"] == 5120.0
    assert rows[("a4", 4.5)]["Size_KB"] == 5120.0
    assert rows[("a16", 5.0)]["Size_KB"] == 1018.0
    assert rows[("a2", 3.0)]["Size_KB"] == 512.0
    assert rows[("a13", 4.9)]["Maximum Installs"] == 12345678
    assert rows[("a2", 3.0)]["Price"] == 4.99
    assert rows[("a2", 3.0)]["Developer Website"] == "Unknown"
    assert rows[("a11", 2.4)]["Currency"] == "USD"
    assert rows[("a12", 1.5)]["Currency"] == "USD"
    assert rows[("a11", 2.4)]["Ad Supported"] is True
    assert rows[("a12", 1.5)]["Ad Supported"] is None
    assert rows[("a2", 3.0)]["Free"] is False
    assert rows[("a3", 0.0)]["Minimum Android"] == "Varies with device"
    assert {k[0] for k in rows} == {"a1", "a2", "a3", "a4", "a11", "a12", "a13", "a16"}


def test_features_on_fixture(raw, ansi):
    from catalytics.operators.features import catalogue_features

    feat = catalogue_features(jobs.reduce_columns(jobs.clean_catalogue(raw)))
    got = {
        (r["Rating"], r["Maximum Installs"]): r
        for r in feat.select(
            "Rating",
            "Maximum Installs",
            "min_android_version",
            "days_since_update",
            "app_age_days",
            "is_weekend_update",
            "ad_supported_num",
            "in_app_purchases_num",
        ).collect()
    }
    expected = [
        (3.5, 90, 4.1, 1888, 1889, 1, 0.0, 0.0),
        (4.4, 7662, 7.1, 1764, 2199, 0, 0.0, 0.0),
        (2.4, 777, 6.0, 732, 734, 1, 1.0, 0.0),
        (1.5, 600, 6.0, 363, 364, 0, None, None),
        (4.9, 12345678, 4.4, 1824, 5112, 1, 1.0, 1.0),
        (5.0, 60, None, 1159, 1160, 1, 0.0, 0.0),
        (3.0, 1200, 4.0, 2615, 2616, 1, 1.0, 0.0),
        (0.0, 15, None, 2024, 2034, 0, 1.0, 1.0),
        (4.5, 1500, 5.0, 2023, 3495, 0, 1.0, 1.0),
    ]
    assert len(got) == 9
    for e in expected:
        r = got[(e[0], e[1])]
        assert tuple(r)[2:] == e[2:], (e, r)


def test_outliers_and_duplicates(raw):
    cleaned = jobs.clean_catalogue(raw)
    rep = {
        r["column"]: r
        for r in outlier_report(cleaned, ["Rating", "Maximum Installs", "Size_KB"], 1.5, 0.01).collect()
    }
    assert (rep["Rating"]["q1"], rep["Rating"]["q3"], rep["Rating"]["n_outliers"]) == (2.4, 4.5, 0)
    mi = rep["Maximum Installs"]
    assert (mi["q1"], mi["q3"], mi["n_outliers"]) == (90, 1500, 2)
    sz = rep["Size_KB"]
    assert (sz["q1"], sz["q3"], sz["n_outliers"]) == (5120, 20480, 0)
    # exact path gives the same quartiles here
    exact = {r["column"]: r for r in outlier_report(cleaned, ["Rating"], 1.5, 0.0).collect()}
    assert (exact["Rating"]["q1"], exact["Rating"]["q3"]) == (2.4, 4.5)
    assert duplicate_key_count(cleaned, "App Id").first()[0] == 1


def test_named_questions_on_fixture(raw):
    from catalytics.operators import groupstats as G
    from catalytics.operators.features import catalogue_features

    feat = catalogue_features(jobs.reduce_columns(jobs.clean_catalogue(raw)))
    totals = {r["Category"]: r["total_installs"] for r in G.top_groups_by_total(feat, "Category", "Maximum Installs", rating="Rating").collect()}
    assert totals == {"Racing": 12347055, "Tools": 9012, "Music": 1515}
    buckets = [tuple(r) for r in G.rating_bucket_stats(feat, "Category", "Rating", "Maximum Installs").collect()]
    assert buckets == [("0-1", 1, 15.0), ("1-2", 1, 600.0), ("2-3", 1, 777.0), ("3-4", 2, 645.0), ("4-5", 4, 3088725.0)]
    bands = {r["app_age_group"]: (r["total_apps"], r["avg_installs"]) for r in G.mean_by_band(feat, "app_age_days", "Maximum Installs").collect()}
    assert bands == {
        "More than 5 years": (6, 2059358.0),
        "1 to 3 years": (1, 777.0),
        "Less than 1 year": (1, 600.0),
        "3 to 5 years": (1, 60.0),
    }


@pytest.mark.parametrize("text,expected", [("5,000+", 5000), ("10,000,000+", 10000000), ("10.0", 10), ("abc", None), ("1.0E7", 10000000)])
def test_parse_count(spark, ansi, text, expected):
    from catalytics.functions.parse import parse_count

    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_count("t")).first()[0] == expected
