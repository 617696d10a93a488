"""Hand-written edge rows for the models (FIXTURES edge table)."""

from conftest import D, day, make

from ledgerloom.operators import dims, marts, match, staging
from ledgerloom.sources.reference_dims import dim_root_cause


def _country(spark, code="AAA", t2=20, t3=100, active=True):
    return make(spark, "dim_country", [dict(country_code=code, country_name=code, variance_threshold_t2=D(t2),
                                            variance_threshold_t3=D(t3), variance_threshold_t4=D(500),
                                            settlement_lag_days=1, is_active=active, regulatory_body="R")])


def _eod(spark, rows):
    return make(spark, "pos_eod_summary", [dict(eod_summary_id=f"E{i}", country_code=r.get("country", "AAA"),
                                                 store_id=r.get("store", f"S{i}"), business_date=day("2001-01-01"),
                                                 net_sales=D(r["net"]), _dq_flag="CLEAN") for i, r in enumerate(rows)])


def _sap(spark, rows):
    return spark.createDataFrame(
        [(r.get("country", "AAA"), r["store"], None, day("2001-01-01"), D(r["rev"]), r["docs"], 0) for r in rows],
        "country_code string, store_id string, sap_profit_centre string, sap_posting_date date, "
        "sap_posted_revenue decimal(18,2), sap_document_count bigint, has_dq_issue int")


def test_tier_bounds_are_inclusive(spark, cfg):
    # variance 0, exactly t2, t2+0.01, exactly t3, t3+0.01 (edge row 1)
    nets = [1000, 1020, "1020.01", 1100, "1100.01"]
    eod = staging.stg_pos_eod_summary(_eod(spark, [dict(net=n, store=f"S{i}") for i, n in enumerate(nets)]),
                                      cfg.__class__(countries=("AAA",)))
    sap = _sap(spark, [dict(store=f"S{i}", rev=1000, docs=1) for i in range(5)])
    ctry = staging.stg_dim_country(_country(spark))
    out = {r.store_id: (r.match_type, r.match_status, r.root_cause_code)
           for r in match.int_pos_sap_matched(eod, sap, ctry, cfg).collect()}
    assert out["S0"] == ("EXACT", "MATCHED", None)
    assert out["S1"] == ("TOLERANCE", "MATCHED", "RC-007")
    assert out["S2"] == ("REVIEW", "EXCEPTION", None)
    assert out["S3"] == ("REVIEW", "EXCEPTION", None)
    assert out["S4"] == ("ESCALATE", "EXCEPTION", None)


def test_no_ledger_rows_tier_order(spark, cfg):
    # net 0 / no ledger → EXACT but RC-001 (edge 2); net 15 ≤ t2 → TOLERANCE + RC-001 (edge 3);
    # net 500 → UNMATCHED; a ledger row with no end-of-day row is dropped (edge 4).
    c = cfg.__class__(countries=("AAA",))
    eod = staging.stg_pos_eod_summary(_eod(spark, [dict(net=0, store="A"), dict(net=15, store="B"),
                                                   dict(net=500, store="C")]), c)
    sap = _sap(spark, [dict(store="Z", rev=10, docs=1)])
    out = {r.store_id: (r.match_type, r.match_status, r.root_cause_code)
           for r in match.int_pos_sap_matched(eod, sap, staging.stg_dim_country(_country(spark)), cfg).collect()}
    assert out == {"A": ("EXACT", "MATCHED", "RC-001"), "B": ("TOLERANCE", "MATCHED", "RC-001"),
                   "C": ("UNMATCHED", "EXCEPTION", "RC-001")}


def test_inactive_country_is_dropped(spark, cfg):
    c = cfg.__class__(countries=("AAA",))
    eod = staging.stg_pos_eod_summary(_eod(spark, [dict(net=10)]), c)
    ctry = staging.stg_dim_country(_country(spark, active=False))
    assert match.int_pos_sap_matched(eod, _sap(spark, []), ctry, cfg).count() == 0


def test_staging_country_filter_runs_before_upper(spark, cfg):
    # 'mys' is dropped, not normalised; NULL and unknown codes too (edge 8)
    c = cfg.__class__(countries=("MYS",))
    raw = _eod(spark, [dict(net=1, country="MYS"), dict(net=1, country="mys"), dict(net=1, country="XXX"),
                       dict(net=1, country=None)])
    assert [r.country_code for r in staging.stg_pos_eod_summary(raw, c).collect()] == ["MYS"]


def test_signed_amount_and_active_documents(spark, cfg):
    lines = make(spark, "sap_fi_lineitem", [
        dict(belnr="1", bukrs="C", gjahr=2001, buzei="001", hkont="0040000001", shkzg="H", dmbtr=D("10.00")),
        dict(belnr="1", bukrs="C", gjahr=2001, buzei="002", hkont="0040000001", shkzg="S", dmbtr=D("3.00")),
        dict(belnr="1", bukrs="C", gjahr=2001, buzei="003", hkont="0040000001", shkzg="X", dmbtr=D("5.00"))])
    got = sorted(float(r.signed_amount) for r in staging.stg_sap_fi_lineitem(lines).collect())
    assert got == [-3.0, 0.0, 10.0]
    docs = make(spark, "sap_fi_document", [dict(belnr=b, bukrs="C", gjahr=2001, country_code="AAA", bstat=s)
                                           for b, s in (("1", " "), ("2", None), ("3", "R"))])
    kept = {r.belnr for r in staging.stg_sap_fi_document(docs, cfg.__class__(countries=("AAA",))).collect()}
    assert kept == {"1", "2"}


def test_sales_by_store_date_flags_and_revenue(spark, cfg):
    c = cfg.__class__(countries=("AAA",))
    lines = staging.stg_sap_fi_lineitem(make(spark, "sap_fi_lineitem", [
        dict(belnr="1", bukrs="C", gjahr=2001, buzei="001", hkont="0011", shkzg="S", dmbtr=D(11), _dq_flag=None),
        dict(belnr="1", bukrs="C", gjahr=2001, buzei="002", hkont="0040", shkzg="H", dmbtr=D(10), _dq_flag=None),
        dict(belnr="2", bukrs="C", gjahr=2001, buzei="002", hkont="0040", shkzg="S", dmbtr=D(4), _dq_flag="CLEAN"),
    ]))
    docs = staging.stg_sap_fi_document(make(spark, "sap_fi_document", [
        dict(belnr="1", bukrs="C", gjahr=2001, country_code="AAA", budat=day("2001-01-01"), pos_txn_id="T1"),
        dict(belnr="2", bukrs="C", gjahr=2001, country_code="AAA", budat=day("2001-01-01"), pos_txn_id="T2")]), c)
    hdr = staging.stg_pos_transaction_header(make(spark, "pos_transaction_header", [
        dict(pos_txn_id="T1", country_code="AAA", store_id="S1", txn_status="COMPLETED"),
        dict(pos_txn_id="T2", country_code="AAA", store_id="S1", txn_status="COMPLETED")]), c)
    store = staging.stg_dim_store(make(spark, "dim_store", [dict(store_id="S1", country_code="AAA",
                                                                 sap_profit_center="PC1", is_active=True)]))
    r = match.int_sap_sales_by_store_date(lines, docs, hdr, store, cfg).collect()
    assert len(r) == 1
    # NULL flag counts as no issue (edge 13); revenue only from 004 accounts
    assert (float(r[0].sap_posted_revenue), r[0].sap_document_count, r[0].has_dq_issue) == (6.0, 2, 0)


def _settlement(spark, sid, gross, net, contracted="1.0", actual="1.0", country="AAA"):
    return dict(settlement_id=sid, country_code=country, txn_date=day("2001-01-01"), gross_amount=D(gross),
                net_settlement=D(net), contracted_rate_pct=D(contracted), actual_rate_pct=D(actual),
                settlement_batch_id="B-" + sid, bank_account="ACC", tender_code="VISA")


def test_pay_bank_classification_and_fan_out(spark, cfg):
    c = cfg.__class__(countries=("AAA",))
    sett = staging.stg_bank_card_settlement(make(spark, "bank_card_settlement", [
        _settlement(spark, "none", 100, 100),                       # no line → UNMATCHED RC-014
        _settlement(spark, "exact", 100, 100, actual="1.1"),        # matched, fee var ≠ 0 → EXACT + RC-010
        _settlement(spark, "tol", 100, "101.00"),                   # |v| = 1.00 → TOLERANCE
        _settlement(spark, "fee", 100, "101.01", actual="1.5"),     # |v| > 1, fee var → FEE_VARIANCE
        _settlement(spark, "rev", 100, "101.01"),                   # |v| > 1 → REVIEW
        _settlement(spark, "two", 100, 100)]), c)                   # 2 lines → fan-out
    bank_rows = [dict(statement_line_id=f"L{i}", country_code="AAA", bank_account="ACC", value_date=day("2001-01-03"),
                      amount=D(100), dc_indicator="C", customer_reference="B-" + s)
                 for i, s in enumerate(["exact", "tol", "fee", "rev", "two", "two"])]
    bank_rows.append(dict(statement_line_id="D1", country_code="AAA", bank_account="ACC", amount=D(100),
                          dc_indicator="D", customer_reference="B-none"))   # debit excluded (edge 12)
    bank = staging.stg_bank_statement_line(make(spark, "bank_statement_line", bank_rows), c)
    out = match.int_pay_bank_matched(sett, bank, staging.stg_dim_country(_country(spark)), cfg).collect()
    by = {}
    for r in out:
        by.setdefault(r.match_id.split("-")[-1], []).append((r.match_type, r.match_status, r.root_cause_code))
    assert by["none"] == [("UNMATCHED", "EXCEPTION", "RC-014")]
    assert by["exact"] == [("EXACT", "MATCHED", "RC-010")]
    assert by["tol"] == [("TOLERANCE", "MATCHED", None)]
    assert by["fee"] == [("FEE_VARIANCE", "EXCEPTION", "RC-010")]
    assert by["rev"] == [("REVIEW", "EXCEPTION", None)]
    assert len(by["two"]) == 2
    lag = {r.match_id.split("-")[-1]: r.settlement_lag_days_actual for r in out}
    assert lag["exact"] == 2 and lag["none"] == (cfg.as_of - day("2001-01-01")).days


def test_surrogate_key_uses_raw_country(spark, cfg):
    c = cfg.__class__(countries=("AAA", "BBB"))
    s = staging.stg_bank_card_settlement(make(spark, "bank_card_settlement", [
        _settlement(spark, "X", 1, 1, country="AAA"), _settlement(spark, "X", 1, 1, country="BBB")]), c)
    assert sorted(r.settlement_surrogate_key for r in s.collect()) == ["X|AAA", "X|BBB"]


def test_exception_log_age_buckets(spark, cfg):
    # exception aged -1..5 days (edge 14)
    rows = []
    for age in range(-1, 6):
        d = cfg.as_of.fromordinal(cfg.as_of.toordinal() - age)
        rows.append((f"M{age}", "POS_SAP", "AAA", d, "S1", "X", D(10), D(0), D(10), "ESCALATE", "EXCEPTION", None,
                     "CLEAN"))
    pos = spark.createDataFrame(rows, "match_id string, recon_type string, country_code string, recon_date date, "
                                      "store_id string, currency_code string, pos_amount decimal(18,2), "
                                      "sap_amount decimal(18,2), variance_pos_sap decimal(18,2), match_type string, "
                                      "match_status string, root_cause_code string, _dq_flag string")
    pay = spark.createDataFrame([], pos.schema.add("bank_amount", "decimal(18,2)")
                                .add("variance_sap_bank", "decimal(18,2)"))
    store = staging.stg_dim_store(make(spark, "dim_store", [dict(store_id="S1", is_active=True)]))
    rc = staging.stg_dim_root_cause(dim_root_cause(spark))
    recon = make(spark, "recon_match_result", [dict(match_id="M3", preparer_id="P", reviewer_id="R")])
    out = {r.match_id: (r.exception_age_days, r.sla_status, r.severity, r.review_status)
           for r in marts.mart_exception_log(pos, pay, store, rc, recon, cfg).collect()}
    assert out["M-1"] == (-1, "Within SLA", "NEW", "PENDING REVIEW")
    assert out["M0"] == (0, "Within SLA", "NEW", "PENDING REVIEW")
    assert out["M1"] == (1, "Within SLA", "MEDIUM", "PENDING REVIEW")
    assert out["M2"] == (2, "SLA BREACHED", "MEDIUM", "PENDING REVIEW")
    assert out["M3"] == (3, "SLA BREACHED", "HIGH", "REVIEWED")
    assert out["M4"][2] == "HIGH" and out["M5"][2] == "CRITICAL"


def test_pay_bank_detail_ageing(spark, cfg):
    rows = [(f"M{k}", "PAY_BANK", "AAA", day("2001-01-01"), "X", "VISA", "P", D(1), D(0), D(0), D(1), D(1), D(0),
             1 + k, 1, "EXACT", "MATCHED", None, "CLEAN") for k in range(4)]
    pay = spark.createDataFrame(rows, "match_id string, recon_type string, country_code string, recon_date date, "
                                      "currency_code string, tender_code string, processor_name string, "
                                      "gross_amount decimal(18,2), interchange_fee decimal(18,2), "
                                      "fee_variance_amount decimal(18,2), pos_amount decimal(18,2), "
                                      "bank_amount decimal(18,2), variance_sap_bank decimal(18,2), "
                                      "settlement_lag_days_actual int, settlement_lag_days_expected int, "
                                      "match_type string, match_status string, root_cause_code string, "
                                      "_dq_flag string")
    ctry = staging.stg_dim_country(_country(spark))
    rc = staging.stg_dim_root_cause(dim_root_cause(spark))
    out = {r.match_id: (r.aging_bucket, r.settlement_timing_status, r.days_overdue)
           for r in marts.mart_pay_bank_detail(pay, ctry, rc, cfg).collect()}
    assert out == {"M0": ("Current", "ON TIME", 0), "M1": ("T+1 Overdue", "OVERDUE", 1),
                   "M2": ("T+2 Overdue", "OVERDUE", 2), "M3": (">T+2 Overdue", "OVERDUE", 3)}


def test_variance_pct_zero_base(spark):
    df = spark.createDataFrame([(D(0), D(5)), (None, D(5)), (D(200), D(-1))],
                               "pos_amount decimal(18,2), variance_pos_sap decimal(18,2)")
    got = [r.p for r in df.select(marts.variance_pct("variance_pos_sap", "pos_amount").alias("p")).collect()]
    assert got == [D("0.0000"), D("0.0000"), D("-0.5000")]


def test_store_enriched_health_and_age(spark, cfg):
    c = cfg.__class__(as_of=day("2002-01-01"))
    store = staging.stg_dim_store(make(spark, "dim_store", [
        dict(store_id="S1", country_code="AAA", open_date=day("2001-12-31"), is_active=True),
        dict(store_id="S2", country_code="AAA", open_date=day("2001-12-31"), is_active=True)]))
    summary = spark.createDataFrame(
        [("S1", "POS_SAP", "MATCHED")] * 99 + [("S1", "POS_SAP", "EXCEPTION")] + [(None, "PAY_BANK", "MATCHED")],
        "store_id string, recon_type string, match_status string")
    out = {r.store_id: r for r in dims.dim_store_enriched(store, summary, c).collect()}
    # opened 31 Dec, as-of 1 Jan → 1 calendar year (edge 21); payment rate COALESCEd to 0 (edge 20)
    assert out["S1"].store_age_years == 1
    assert out["S1"].payment_match_rate_pct == D("0.00")
    assert out["S1"].health_score == D("59.40") and out["S1"].health_status == "ESCALATE"
    assert out["S2"].total_recon_records == 0


def test_pareto_tie_break_is_deterministic(spark, cfg):
    # tied exception counts inside one partition (edge 17)
    rows = [("MATCH-1", "AAA", day("2001-01-05"), None, "S1", "EXCEPTION", code, D(1), "POS_SAP")
            for code in ("RC-001", "RC-007") for _ in range(2)]
    pos = spark.createDataFrame(rows, "match_id string, country_code string, recon_date date, "
                                      "fiscal_period_key string, store_id string, match_status string, "
                                      "root_cause_code string, variance_pos_sap decimal(18,2), recon_type string")
    pay = spark.createDataFrame([], pos.schema.add("variance_sap_bank", "decimal(18,2)"))
    rc = staging.stg_dim_root_cause(dim_root_cause(spark))
    out = marts.mart_root_cause_trend(pos, pay.drop("variance_pos_sap"), rc, cfg).collect()
    got = {r.root_cause_code: r.cumulative_pareto_pct for r in out}
    assert got == {"RC-001": D("50.00"), "RC-007": D("100.00")}
