"""Plan-shape tests: the distributed operators must not funnel data-sized input into one partition."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cohortlens.plans import reports
from cohortlens.plans.inputs import Bundle
from cohortlens.sources import fixtures as fx


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _plans_of(spark, sf_dir, monkeypatch, name):
    """The plans of every frame a query checkpoints on its way, the first one first, and of its result."""
    frame = type(spark.range(1))
    plans, cut = [], frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda df, eager=True: plans.append(_plan(df)) or cut(df, eager))
    plans.append(_plan(E.queries()[name](spark, sf_dir)))
    return "\n".join(plans)


def test_latest_per_key_uses_window_group_limit(spark, sf_small):
    plan = _plan(E.queries()["latest_per_key"](spark, sf_small))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_single_partition_exchanges_only_carry_aggregates(spark, sf_small):
    """A SinglePartition exchange may only move aggregate output (one-row partials, percentile
    sketches, per-bucket or per-range-partition totals), never data-sized rows."""
    for name in ("mann_whitney_u", "evaluate_orders", "evaluate_by_status", "report_group_precision"):
        df = E.queries()[name](spark, sf_small)
        df.collect()
        lines = _plan(df).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line and "ReusedExchange" not in line:
                # the next operator line (scalar subqueries print AQE "== ... Plan ==" headers in between)
                child = next(x for x in lines[i + 1:] if "==" not in x and x.strip())
                assert re.search(r"(Object)?HashAggregate\(", child), (name, child)


def test_running_sums_partition_by_bucket(spark, sf_small):
    df = E.queries()["mann_whitney_u"](spark, sf_small)
    df.collect()
    plan = _plan(df)
    assert re.search(r"Exchange hashpartitioning\(metric#\d+, _bucket#\d+", plan)


def test_scan_prunes_columns(spark, sf_small):
    plan = _plan(E.queries()["cohort_compare"](spark, sf_small))
    schema = re.search(r"lineitem.parquet.*?ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert "l_orderkey" not in schema and "l_extendedprice" in schema


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["employee_id", "success_v2", "comp_score", "str_score", "psy_score", "disc_bonus"]
    assert df.count() > 0


def test_incremental_load_cuts_reach_the_scan(spark, sf_small):
    """The date cuts of the upsert are Parquet pushed filters, not row filters after the scan."""
    plan = _plan(E.queries()["upsert_by_key"](spark, sf_small))
    assert re.search(r"orders.parquet.*?PushedFilters: \[[^\]]*o_orderdate", plan, re.S)


def test_v1_aligns_its_parts_without_a_full_join(spark, sf_small):
    for name in ("success_score_v1_raw", "parts_full_outer"):
        plan = _plan(E.queries()[name](spark, sf_small))
        assert "FullOuter" not in plan, name


def test_labels_are_joined_without_a_broadcast(spark, sf_small):
    """The exploded scales are far larger than their Parquet columns suggest: no side may go through the driver."""
    plan = _plan(E.queries()["report_cognitive"](spark, sf_small)) + _plan(reports._labelled(Bundle(spark, sf_small), Bundle(spark, sf_small).papi))
    assert "Broadcast" not in plan.split("ShuffledHashJoin")[-1] and "ShuffledHashJoin" in plan


def test_pivot_groups_by_the_key_alone(spark, sf_small):
    plan = _plan(E.queries()["psy_component_v1"](spark, sf_small))
    assert "pivotfirst" not in plan.lower() and not re.search(r"HashAggregate\(keys=\[[^\]]*scale_code", plan)


@pytest.mark.parametrize("name", ["score_v2_parts", "evaluate_success_v2", "report_group_precision", "score_eval_frame"])
def test_v2_scores_pivot_with_a_group_per_key(spark, sf_small, monkeypatch, name):
    """Of every frame the query cuts, and of its result: no partial aggregate holds a group per (employee, scale)."""
    plans = _plans_of(spark, sf_small, monkeypatch, name)
    assert "customer.parquet" in plans and "explode" in plans
    assert "pivotfirst" not in plans.lower() and not re.search(r"HashAggregate\(keys=\[[^\]]*scale_code", plans)


def test_v2_parts_are_joined_without_a_broadcast(spark, sf_small):
    """Psychometric rows, one per employee from few Parquet bytes, go neither through the driver nor into every task."""
    plan = _plan(E.queries()["score_v2_parts"](spark, sf_small))
    assert "SortMergeJoin [employee_id" in plan and "BroadcastHashJoin [employee_id" not in plan


@pytest.mark.parametrize("name", ["evaluate_success_v2", "report_group_precision", "score_eval_frame"])
def test_v2_frames_broadcast_no_psychometric_rows(spark, sf_small, monkeypatch, name):
    """Of the joins by employee, in all frames the query cuts, only those of labels and group names may be broadcast."""
    plans = _plans_of(spark, sf_small, monkeypatch, name)
    assert "SortMergeJoin [employee_id" in plans
    joins = re.findall(r"BroadcastHashJoin \[employee_id#\d+\].*", plans)
    assert len(joins) <= (2 if name == "report_group_precision" else 1), joins


@pytest.mark.parametrize("name", ["evaluate_success_v2", "report_group_precision", "score_eval_frame"])
def test_v2_frames_hash_orders_instead_of_sorting_lineitem(spark, sf_small, monkeypatch, name):
    """With tables too large to broadcast, as at size, no task sorts lineitem for its join with orders."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = _plans_of(spark, sf_small, monkeypatch, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin [l_orderkey" in plans and "SortMergeJoin [l_orderkey" not in plans


def test_scales_are_dealt_out_before_they_multiply(spark, sf_small):
    """150 customers lie in one row group, so in one task; their 20 rows each must not."""
    tasks = fx.fx_papi(spark, sf_small).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 8 and max(r["count"] for r in tasks) <= 20 * 150 / 8


def test_orphans_need_no_distinct(spark, sf_small):
    assert "Aggregate" not in _plan(E.queries()["quality_orphans"](spark, sf_small))
