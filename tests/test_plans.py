"""Plans hold no step that one task does for the whole table, and scans read only what they need."""

import re

import pytest

import tessella.queries as tq

tq.load()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["split_exact", "kfold_assign", "minibatch_assign", "split_per_user", "split_holdout_replacement",
                                  "topn_per_user", "user_activity", "standardize", "rec_item_mean", "segment_project"])
def test_no_single_partition_step(name, spark, sf):
    plan = _plan(tq.QUERIES[name](spark, sf))
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_splits_do_not_shuffle_rows(spark):
    from tessella.operators.splits import fold_exact, split_exact

    df = spark.range(500)
    assert "Exchange" not in _plan(split_exact(df, 0.8)) and "Exchange" not in _plan(fold_exact(df, 5))


def test_top_n_drops_rows_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in _plan(tq.QUERIES["topn_per_user"](spark, sf))


def test_scans_are_pruned(spark, sf):
    from tessella.sources import views

    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", _plan(views.features(spark, sf).select("id", "label")))
    assert sorted(schemas) == ["l_orderkey:bigint,l_quantity:double", "o_orderkey:bigint"]
