import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tabspark.session import checkpoint_dir, get_session
    active = SparkSession.getActiveSession()
    # local[4,2]: up to 2 attempts per task, so retried-task tests can run
    s = active or get_session("local[4,2]", app_name="tabspark-tests", shuffle_partitions=4)
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tabspark-test-")


CENSUS_COLS = ["AGEP", "COW", "SCHL", "MAR", "OCCP", "POBP", "RELP", "WKHP", "SEX", "RAC1P", "STATE", "YEAR", "PINCP"]
CENSUS_DDL = ("AGEP double, COW double, SCHL double, MAR double, OCCP double, POBP double, RELP double, "
              "WKHP double, SEX double, RAC1P double, STATE string, YEAR bigint, PINCP double")


def census_row(**over):
    base = dict(AGEP=30.0, COW=1.0, SCHL=16.0, MAR=1.0, OCCP=1000.0, POBP=6.0, RELP=0.0, WKHP=40.0,
                SEX=1.0, RAC1P=1.0, STATE="CA", YEAR=2020, PINCP=60000.0)
    base.update(over)
    conv = {c: (v if v is None or c in ("STATE", "YEAR") else float(v)) for c, v in base.items()}
    return tuple(conv[c] for c in CENSUS_COLS)
