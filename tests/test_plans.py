"""What the optimizer makes of the queries: no plan that fails at scale."""

import re

import pytest

from checks.queries import QUERIES
from checks.storm_view import storm
from tempestry.operators import harm, location, trend
from tempestry.operators.damage import mean_by_type
from tempestry.operators.ranking import top_k

SF_DIR = "/root/testdata/sf0.001"
TRAINED = {
    "rf_predictions", "rf_quality", "feature_importance", "group_importance",
    "top_event_importance", "top_state_importance", "model_storm_vs_location",
    "permutation_importance",
}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINED))
def test_no_python_rows_and_no_pairing_of_everything(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct",
                 "BroadcastNestedLoopJoin", "InPandas"):
        assert node not in plan


@pytest.fixture(scope="module")
def parquet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    storm(spark, SF_DIR).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_columns(plan):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


def test_reports_scan_once_and_read_only_their_columns(parquet):
    harmed = physical(harm.harm_by_state(parquet))
    assert read_columns(harmed) == [
        {"STATE", "INJURIES_DIRECT", "INJURIES_INDIRECT", "DEATHS_DIRECT", "DEATHS_INDIRECT"}
    ]
    means = physical(mean_by_type(parquet))
    assert means.count("FileScan") == 1
    assert re.search(r"PushedFilters: \[[^]]*In\(EVENT_TYPE", means)
    assert physical(trend.magnitude_trend(parquet)).count("FileScan") == 1


def test_groups_are_combined_before_the_shuffle(parquet):
    plan = physical(harm.harm_by_county(parquet))
    shuffle = plan.index("Exchange hashpartitioning")
    assert "partial_sum" in plan[shuffle:]
    assert plan.count("Exchange") == 1


def test_top_k_does_not_sort_everything(parquet):
    plan = physical(top_k(harm.harm_by_state(parquet), "total_harm", ["STATE"]))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_small_lookup_leaves_the_events_unshuffled(parquet):
    plan = physical(location.with_location_count(parquet))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def test_unused_harm_is_not_computed(spark):
    plan = physical(QUERIES["state_event_frequency"](spark, SF_DIR))
    assert "lineitem" not in plan
