"""What the plans look like: pruned scans, no Python, no nested-loop joins."""

from __future__ import annotations

import re
from datetime import date

import pytest

from addrwatch import views
from addrwatch.catalog import QUERIES
from addrwatch.operators import features, lookups
from addrwatch.sources import activity

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dates_prune_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "set")
    rows = [(f"a{i}", 2020, i + 1, 1, 0.5, 2, 0, 3, 10.0, "white") for i in range(5)]
    schema = "address string, year int, day int, length long, weight double, count long, looped long, neighbors long, income double, label string"
    activity.write_activity(spark.createDataFrame(rows, schema), path)
    text = plan(activity.read_activity_since(spark, path, date(2020, 1, 3)).select("income"))
    assert re.search(r"PartitionFilters: \[[^\]]*partition_date", text)
    assert "ReadSchema: struct<income:double>" in text


# Not streamed or trained, so building them starts no long job.
LAZY = sorted(n for n in QUERIES if n[0] in "afjlpruwx" or n in ("m2_term_scores", "m4_predict", "m5_explain_request", "class_profile"))


@pytest.mark.parametrize("name", LAZY)
def test_plan_is_join_safe_and_free_of_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for word in FORBIDDEN:
        assert word not in text, word


def test_scaling_reads_statistics_once(spark, sf):
    text = plan(features.transform(views.labelled(spark, sf)))
    assert len(set(re.findall(r"subquery#(\d+)", text))) == 1


def test_model_is_scored_once(spark, sf):
    text = plan(QUERIES["a11_mean_attribution"](spark, sf))
    assert text.count("income_per_count#") and len(re.findall(r"< 1000\.5", text)) == 1
    text = plan(QUERIES["m5_explain_request"](spark, sf))
    assert len(re.findall(r"< 1000\.5", text)) == 1


def test_latest_rows_need_no_full_sort(spark, sf):
    text = plan(QUERIES["l1_latest_n"](spark, sf))
    assert "TakeOrderedAndProject" in text and "Sort " not in text


def test_counts_are_partly_made_before_the_shuffle(spark, sf):
    for name in ("a12_prediction_counts", "w1_sliding_rate", "a9_roc_curve"):
        assert "partial_" in plan(QUERIES[name](spark, sf))


def test_running_totals_have_no_window_over_everything(spark, sf):
    """One window inside blocks of ranges, one inside ranges, and one shuffle of the rows by range."""
    marked = lookups.explain_lookup(views.lookups(spark, sf), views.pred(spark, sf))
    text = plan(lookups.running_hit_rate(marked))
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert len(windows) == 2
    for line in windows:
        assert re.search(r"\[_block#\d+L?\], \[_range|\[_range#\d+(, _part#\d+)?\], \[_order", line), line
