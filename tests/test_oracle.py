"""Every registered query on the smallest tables against its SQL."""

import pytest
from oracle import compare, duck

import __spark_entry__ as e

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(e.queries()))
def test_query(spark, con, name):
    result = compare(spark, con, SF, name, e.queries()[name], e.oracle_sql().get(name))
    assert result.startswith(("ok", "rows only")) or result == "EMPTY", result


def test_entry(spark):
    assert e.entry(spark).limit(1).count() == 1


BUCKETED = (
    "operator_experience station_lags busy_units saturation_episodes load_band_share created_while_saturated idle_time "
    "metrics_at_k pr_curve kth_largest trim_iqr concat_text k_search lift_by_code reg_metrics_exp impute_median "
    "change_vs_median_a_week_ago patient_care_of_events compare_to_protocol confusion_by_code"
).split()


@pytest.mark.parametrize("name", BUCKETED)
def test_query_in_buckets(spark, small_buckets, con, name):
    result = compare(spark, con, SF, name, e.queries()[name], e.oracle_sql()[name])
    assert result.startswith("ok") or result == "EMPTY", result
