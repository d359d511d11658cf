"""Every registered query against its checking SQL on the small tables."""

import pytest
from compare import DATA, connect, differences

from __spark_entry__ import entry, oracle_sql, queries

SF = f"{DATA}/sf0.001"
CHECKS = oracle_sql()
# Operators that treat large groups differently.
SKEWED = [
    "plot_stats", "season_stats", "monthly_stats", "agg_median", "agg_mode", "agg_lower_quartile",
    "agg_upper_quartile", "median_composite", "nearest_median_sd", "tolerance_join", "stratify",
    "class_weights", "semi_join", "anti_join", "chunk_key_join", "raster_tile", "bbox_filter", "update_by_key",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, con, name):
    message, *_ = differences(spark, con, name, queries()[name], CHECKS[name], SF)
    assert message is None


@pytest.mark.parametrize("name", SKEWED)
def test_query_with_large_groups(spark, con, every_group_hot, name):
    message, *_ = differences(spark, con, name, queries()[name], CHECKS[name], SF)
    assert message is None


@pytest.mark.parametrize("name", ["agg_median", "agg_lower_quartile", "error_deciles", "row_slice", "stratify", "nearest_median_sd"])
def test_query_with_narrow_sorts(spark, con, every_group_hot, small_sorts, name):
    message, *_ = differences(spark, con, name, queries()[name], CHECKS[name], SF)
    assert message is None


def test_models_beat_the_mean(spark):
    row = queries()["ml_gbt"](spark, SF).first()
    assert row["r2"] > 0.5 and row["n"] > 0
    again = queries()["ml_gbt"](spark, SF).first()
    assert row == again


def test_entry(spark):
    assert entry(spark).count() == 10
