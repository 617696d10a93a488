"""Invariants of the full model build on the smallest test folder, and the
expected tier counts of the binding recipe (FIXTURES)."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerloom.plans import registry


@pytest.fixture(scope="module")
def m(spark):
    return registry.models(spark, SF_SMALL)


def _hist(df):
    return {r.match_type: r["count"] for r in df.groupBy("match_type").count().collect()}


def test_pos_sap_tier_counts_match_recipe(m):
    assert _hist(m.int_pos_sap_matched) == {"EXACT": 1034, "TOLERANCE": 7, "REVIEW": 24, "ESCALATE": 37,
                                            "UNMATCHED": 22}


def test_pay_bank_tier_counts_match_recipe(m):
    pb = m.int_pay_bank_matched
    assert _hist(pb) == {"EXACT": 1101, "TOLERANCE": 21, "FEE_VARIANCE": 5, "REVIEW": 8, "UNMATCHED": 5}
    assert pb.filter((F.col("match_type") == "EXACT") & (F.col("root_cause_code") == "RC-010")).count() == 13


def test_row_count_invariants(m):
    active = m.stg_dim_country.select("country_code")
    assert m.int_pos_sap_matched.count() == m.stg_pos_eod_summary.join(active, "country_code").count()
    assert m.mart_recon_summary.count() == m.int_pos_sap_matched.count() + m.int_pay_bank_matched.count()
    exc = m.mart_recon_summary.filter(F.col("match_status") == "EXCEPTION").count()
    assert m.mart_exception_log.count() == exc


def test_documents_balance(m):
    signed = F.when(F.col("shkzg") == "H", F.col("dmbtr")).otherwise(-F.col("dmbtr"))
    unbalanced = (m.raw.get("sap_fi_lineitem").groupBy("belnr", "bukrs", "gjahr")
                  .agg(F.sum(signed).alias("net")).filter(F.col("net") != 0))
    assert unbalanced.count() == 0


def test_revenue_total_is_preserved(m):
    lines = m.stg_sap_fi_lineitem.filter(F.col("hkont").startswith("004"))
    docs = m.stg_sap_fi_document.select("belnr", "bukrs", "gjahr", "pos_txn_id")
    with_store = m.stg_pos_transaction_header.filter(F.col("store_id").isNotNull()).select("pos_txn_id")
    expected = lines.join(docs, ["belnr", "bukrs", "gjahr"]).join(with_store, "pos_txn_id") \
        .agg(F.sum("signed_amount")).collect()[0][0]
    got = m.int_sap_sales_by_store_date.agg(F.sum("sap_posted_revenue")).collect()[0][0]
    assert got == expected


def test_running_pareto_ends_at_100(m):
    last = (m.mart_root_cause_trend.groupBy("country_code", "recon_type")
            .agg(F.max("cumulative_pareto_pct").alias("mx"), F.sum("exception_count").alias("n")).collect())
    for r in last:
        assert (r.n == 0 and r.mx is None) or float(r.mx) == 100.0
