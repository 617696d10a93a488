"""Optional fixes (all off by default): Q1, Q2/Q3, Q9, Q10, J07."""

from dataclasses import replace

from conftest import D, day, make

from ledgerloom.config import with_all_fixes
from ledgerloom.operators import match, staging


def _inputs(spark, cfg):
    c = replace(cfg, countries=("AAA",))
    sett = staging.stg_bank_card_settlement(make(spark, "bank_card_settlement", [
        dict(settlement_id="S1", country_code="AAA", txn_date=day("2001-01-01"), gross_amount=D(100),
             net_settlement=D(100), contracted_rate_pct=D(1), actual_rate_pct=D(1),
             settlement_batch_id="BATCH-ST-007-AMEX-20010101", bank_account="A", tender_code="AMEX")]), c)
    bank = staging.stg_bank_statement_line(make(spark, "bank_statement_line", [
        dict(statement_line_id=f"L{i}", country_code="AAA", bank_account="A", value_date=day(d), amount=D(amt),
             dc_indicator="C", customer_reference="BATCH-ST-007-AMEX-20010101")
        for i, (d, amt) in enumerate([("2001-01-04", "95.00"), ("2001-01-03", "95.00")])]), c)
    ctry = staging.stg_dim_country(make(spark, "dim_country", [dict(
        country_code="AAA", country_code_iso2="AA", variance_threshold_t2=D(20), variance_threshold_t3=D(100),
        settlement_lag_days=1, is_active=True)]))
    tender = staging.stg_dim_tender_type(make(spark, "dim_tender_type", [dict(
        tender_code="AMEX", country_code="BOTH", settlement_lag_days=2, is_active=True)]))
    return sett, bank, ctry, tender


def test_defaults_reproduce_the_model(spark, cfg):
    sett, bank, ctry, tender = _inputs(spark, cfg)
    rows = match.int_pay_bank_matched(sett, bank, ctry, cfg, tender).collect()
    assert len(rows) == 2                                          # fan-out kept (J07)
    assert {r.match_type for r in rows} == {"REVIEW"}              # |v| = 5 > 1.00 (Q9)
    assert {r.store_id for r in rows} == {None}                    # Q2
    assert {r.settlement_lag_days_expected for r in rows} == {1}   # country lag (Q10)


def test_all_fixes(spark, cfg):
    fx = replace(with_all_fixes(cfg), countries=("AAA",))
    sett, bank, ctry, tender = _inputs(spark, fx)
    rows = match.int_pay_bank_matched(sett, bank, ctry, fx, tender).collect()
    assert len(rows) == 1 and rows[0].settlement_lag_days_actual == 2       # earliest credit kept
    r = rows[0]
    assert (r.match_type, r.match_status, r.store_id) == ("TOLERANCE", "MATCHED", "ST-007")
    assert r.settlement_lag_days_expected == 2 and r.threshold_applied == D(20)


def test_fixed_sales_match_id(spark, cfg):
    fx = replace(cfg, countries=("AAA",), fix_match_id=True)
    eod = staging.stg_pos_eod_summary(make(spark, "pos_eod_summary", [dict(
        eod_summary_id="E", country_code="AAA", store_id="ST-012", business_date=day("2001-02-03"),
        net_sales=D(1))]), fx)
    ctry = staging.stg_dim_country(make(spark, "dim_country", [dict(
        country_code="AAA", country_code_iso2="AA", variance_threshold_t2=D(20), variance_threshold_t3=D(100),
        is_active=True)]))
    sap = spark.createDataFrame([], "country_code string, store_id string, sap_profit_centre string, "
                                    "sap_posting_date date, sap_posted_revenue decimal(18,2), "
                                    "sap_document_count bigint, has_dq_issue int")
    assert match.int_pos_sap_matched(eod, sap, ctry, fx).collect()[0].match_id == "MATCH-POS-SAP-AA-20010203-012"
    assert match.int_pos_sap_matched(eod, sap, ctry, replace(fx, fix_match_id=False)).collect()[0].match_id \
        == "MATCH-POS-SAP-AAA-20010203-ST012"
