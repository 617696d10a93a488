"""Plan shape: built-in expressions only, dimension joins broadcast, no
cartesian product, filters and column pruning at the Parquet scan."""

import pytest
from conftest import SF_SMALL

from ledgerloom.plans import registry


def _plan(spark, df):
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", [n for n in sorted(registry.QUERIES) if n.startswith(("m", "q00", "k12", "o01"))])
def test_no_python_udf_or_cartesian(spark, name):
    plan = _plan(spark, registry.QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_dimension_join_is_broadcast_and_scan_pruned(spark):
    df = registry.QUERIES["m13_int_pos_sap_matched"](spark, SF_SMALL)
    plan = _plan(spark, df)
    assert "BroadcastHashJoin" in plan
    assert "PushedFilters" in plan
    # the end-of-day scan reads only the columns the match needs
    eod_scan = [ln for ln in plan.splitlines() if "ReadSchema" in ln and "net_sales" in ln]
    assert eod_scan and all("paynow_total" not in ln for ln in eod_scan)


@pytest.mark.parametrize("name", ["m12_int_sap_sales_by_store_date", "m13_int_pos_sap_matched",
                                  "m19_mart_root_cause_trend"])
def test_hot_path_runs_in_whole_stage_codegen(spark, name):
    from ledgerloom.plans.models import Models
    from ledgerloom.sources.raw import stored_raw
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # the static plan shows the codegen spans
    try:
        m = Models(stored_raw(spark, SF_SMALL, registry.CFG), registry.CFG)   # fresh, unplanned frames
        model = {"m12_int_sap_sales_by_store_date": m.int_sap_sales_by_store_date,
                 "m13_int_pos_sap_matched": m.int_pos_sap_matched,
                 "m19_mart_root_cause_trend": m.mart_root_cause_trend}[name]
        plan = _plan(spark, model)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # scans, filters, projections and aggregates sit inside codegen spans ("*")
    assert "* HashAggregate" in plan and "* Project" in plan and "* ColumnarToRow" in plan


def _scans(plan):
    """Physical scans of the initial plan, by the folder they read."""
    import re
    return re.findall(r"Location: InMemoryFileIndex \[[^\]]*/([^/\]]+)\]", plan)


@pytest.mark.parametrize("name, once", [("m14_int_pay_bank_matched", ["bank_card_settlement"]),
                                        ("m18_mart_exception_log", ["pos_eod_summary", "bank_card_settlement"])])
def test_split_left_join_reads_its_left_side_once(spark, name, once):
    found = _scans(_plan(spark, registry.QUERIES[name](spark, SF_SMALL)))
    for table in once:
        assert found.count(table) == 1, (table, found)


def test_load_audit_counts_from_footers(spark):
    plan = registry.QUERIES["s15_load_audit"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == len(registry.AUDITED)
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert "parquet" in v1  # other reads keep their reader
