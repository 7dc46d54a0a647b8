from conftest import CENSUS_DDL, SF0001, census_row
from pyspark.sql import functions as F

from tabspark.contract import CENSUS
from tabspark.operators import clean as cl
from tabspark.sources import fixtures as fx


def _waterfall(df):
    return {r["reason"]: r["rows"] for r in cl.removal_waterfall(df, CENSUS).collect()}


def test_null_rows_removed(spark):
    rows = [census_row(SCHL=1.0), census_row(SCHL=2.0), census_row(SCHL=3.0, PINCP=None)]
    df = spark.createDataFrame(rows, CENSUS_DDL)
    assert cl.clean(df, CENSUS).count() == 2
    w = _waterfall(df)
    assert w["null"] == 1 and w["kept"] == 2


def test_duplicates_removed(spark):
    df = spark.createDataFrame([census_row(), census_row()], CENSUS_DDL)
    assert cl.clean(df, CENSUS).count() == 1
    assert _waterfall(df)["duplicate"] == 1


def test_state_normalised_and_invalid_dropped(spark):
    rows = [census_row(STATE="\tny ", SCHL=1.0), census_row(STATE="X1", SCHL=2.0), census_row(STATE="new", SCHL=3.0)]
    out = cl.clean(spark.createDataFrame(rows, CENSUS_DDL), CENSUS).collect()
    assert [r["STATE"] for r in out] == ["NY"]


def test_first_failing_rule_wins(spark):
    rows = [census_row(AGEP=200.0, WKHP=500.0, SCHL=1.0), census_row(WKHP=500.0, YEAR=1999, SCHL=2.0),
            census_row(YEAR=1999, SCHL=3.0), census_row(STATE="1A", AGEP=200.0, SCHL=4.0)]
    w = _waterfall(spark.createDataFrame(rows, CENSUS_DDL))
    assert (w["invalid_age"], w["invalid_hours"], w["invalid_year"], w["invalid_state"]) == (1, 1, 1, 1)


def test_extra_column_keeps_near_duplicates(spark):
    df = spark.createDataFrame([census_row(), census_row()], CENSUS_DDL)
    df = df.withColumn("extra", F.monotonically_increasing_id())
    assert cl.clean(df, CENSUS).count() == 2  # dedup runs before the projection


def test_index_column_dropped(spark):
    df = spark.createDataFrame([census_row()], CENSUS_DDL).withColumn("__index_level_0__", F.lit(7))
    out = cl.clean(df, CENSUS)
    assert tuple(out.columns) == CENSUS.required


def test_waterfall_adds_up_and_matches_observations(spark):
    raw = fx.acs_raw(spark, SF0001)
    w = _waterfall(raw)
    assert sum(w.values()) == raw.count()
    out, before, after = cl.clean_observed(raw, CENSUS.with_passthrough("k"))
    n = out.count()
    m = cl.transform_metrics(CENSUS, before, after)
    assert m["output_rows"] == n == w["kept"]
    assert m["duplicates_removed"] == w["duplicate"]
    assert m["null_rows_removed"] == w["null"]
    assert m["input_rows"] - m["output_rows"] == m["rows_removed"]
    assert n / raw.count() > 0.9  # retention


def test_missing_passthrough_is_skipped(spark):
    df = spark.createDataFrame([census_row()], CENSUS_DDL)
    out = cl.clean(df, CENSUS.with_passthrough("k"))
    assert tuple(out.columns) == CENSUS.required
