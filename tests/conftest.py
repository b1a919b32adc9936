import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURE_CSV = os.path.join(ROOT, "tests", "fixtures", "catalogue_raw.csv")
SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from catalytics.session import get_session

    s = get_session("local[4]", shuffle_partitions=4, driver_memory="4g")
    yield s
    from catalytics.plans.stages import release_session

    release_session(s)
    s.stop()


@pytest.fixture(params=[True, False], ids=["ansi_on", "ansi_off"])
def ansi(spark, request):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(request.param).lower())
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.fixture
def raw(spark):
    from catalytics import fixed
    from catalytics.sources.io import read_raw_csv

    return read_raw_csv(spark, FIXTURE_CSV, fixed.RAW_COLUMNS)
