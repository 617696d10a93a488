"""Invariants of the derivation dataflows on the smallest test folder."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.plans import registry


@pytest.fixture(scope="module")
def raw(spark):
    return registry.models(spark, SF_SMALL).raw


def test_statement_lines_numbered_densely_per_country(raw):
    b = raw.get("bank_statement_line").withColumn("n", F.split("statement_line_id", "-")[2].cast("int"))
    agg = b.groupBy("country_code").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("lo"),
                                        F.max("n").alias("hi"), F.countDistinct("n").alias("d")).collect()
    for r in agg:
        assert (r.lo, r.hi, r.d) == (1, r.c, r.c)


def test_settlement_gross_is_sum_of_tenders(raw):
    t = raw.get("pos_tender").groupBy(F.col("settlement_batch").alias("settlement_batch_id"), "country_code") \
        .agg(F.sum("tender_amount").alias("g"))
    s = raw.get("bank_card_settlement").join(t, ["settlement_batch_id", "country_code"])
    assert s.filter(F.col("g") != F.col("gross_amount")).count() == 0
    assert s.count() == raw.get("bank_card_settlement").count()


def test_every_credit_references_a_settlement(raw):
    s = raw.get("bank_card_settlement").select(F.col("settlement_id").alias("_settle_id"), "country_code")
    assert raw.get("bank_statement_line").join(s, ["_settle_id", "country_code"], "left_anti").count() == 0
    missing = raw.get("bank_card_settlement").filter(F.col("_dq_flag") == "MISSING_CREDIT").count()
    assert raw.get("bank_statement_line").count() == raw.get("bank_card_settlement").count() - missing


def test_tickets_unique_and_dense_per_country(raw):
    t = raw.get("recon_match_result").filter(F.col("it_ticket_ref").isNotNull()) \
        .withColumn("n", F.element_at(F.split("it_ticket_ref", "-"), -1).cast("int"))
    base = F.expr("(cast(substring(sap_company_code, 2, 10) as bigint) + 1) * 1000")
    t = t.join(raw.get("dim_country").select("country_code", base.alias("base")), "country_code")
    r = t.groupBy("country_code", "base").agg(F.count("*").alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi"),
                                              F.countDistinct("n").alias("d")).collect()
    for x in r:
        assert (x.lo, x.hi, x.d) == (x.base + 1, x.base + x.c, x.c)


def test_wrong_period_posts_to_prior_28th(raw):
    d = raw.get("sap_fi_document").filter(F.col("_dq_flag") == "WRONG_PERIOD").select("bldat", "budat").collect()
    assert d
    for r in d:
        assert r.budat.day == 28 and (r.bldat.year * 12 + r.bldat.month) - (r.budat.year * 12 + r.budat.month) == 1


def test_no_posting_for_failed_transactions(raw):
    h = raw.get("pos_transaction_header").filter(
        F.col("_dq_flag").isin("SAP_BATCH_FAIL", "DUPLICATE_TXN", "NULL_STORE") | (F.col("txn_type") == "VOID"))
    docs = raw.get("sap_fi_document").select("pos_txn_id")
    assert h.join(docs, "pos_txn_id", "left_semi").count() == 0


def test_ledger_lines_are_cut_without_a_lambda_and_keep_their_rows(spark):
    """The lines of a document as one compiled projection: no zero tax line, none lost."""
    from ledgerloom.operators.derive import sap_lineitems
    rows = [(f"TXN-{i}", f"{i}", net, tax) for i, (net, tax) in enumerate([("10.00", "0.70"), ("-5.00", "-0.35"), ("3.00", "0.00"), ("4.00", None)])]
    h = spark.createDataFrame(rows, "pos_txn_id string, sap_doc_number string, n string, t string").select(
        "pos_txn_id", "sap_doc_number", F.col("n").cast("decimal(18,2)").alias("net_amount"), F.col("n").cast("decimal(18,2)").alias("gross_amount"),
        F.lit(0).cast("decimal(18,2)").alias("discount_amount"), F.col("t").cast("decimal(18,2)").alias("tax_amount_local"),
        F.lit("COMPLETED").alias("txn_status"), F.lit("CLEAN").alias("_dq_flag"), F.lit("C001").alias("sap_company_code"), F.lit("TX1").alias("tax_code"),
        F.lit("AMR").alias("currency_code"), F.lit("ST-001").alias("store_id"), F.lit("2001-01-02").cast("date").alias("business_date"))
    out = sap_lineitems(h)
    assert "lambdafunction" not in out._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.belnr, r.buzei, r.shkzg, None if r.dmbtr is None else str(r.dmbtr)) for r in out.collect())
    assert got == [("0", "001", "S", "10.70"), ("0", "002", "H", "10.00"), ("0", "003", "H", "0.70"),
                   ("1", "001", "H", "5.35"), ("1", "002", "S", "5.00"), ("1", "003", "S", "0.35"),
                   ("2", "001", "S", "3.00"), ("2", "002", "H", "3.00"), ("3", "001", "S", None), ("3", "002", "H", "4.00")]


def test_order_time_is_read_as_utc_in_every_session_zone(spark):
    """The wall-clock order time, to the second, is the UTC time: no text is formatted and parsed for it."""
    from ledgerloom.sources import binding
    geo = [spark.createDataFrame([(1, "N", 1)], "n_nationkey long, n_name string, n_regionkey long"),
           spark.createDataFrame([(1, "R")], "r_regionkey long, r_name string")]
    customer = spark.createDataFrame([(1, 1)], "c_custkey long, c_nationkey long")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "Asia/Kathmandu"):
            spark.conf.set("spark.sql.session.timeZone", z)
            orders = spark.sql("""SELECT 1L AS o_orderkey, 1L AS o_custkey, 10.0D AS o_totalprice, '1-URGENT' AS o_orderpriority,
                                         TIMESTAMP_NTZ'2000-10-29 01:30:07.5' AS o_orderdate""")
            out = binding.pos_transaction_header(orders, customer, *geo)
            assert "date_format(" not in out._jdf.queryExecution().analyzed().toString()
            assert out.select(F.unix_micros("txn_datetime_utc")).first()[0] == 972783007 * 10**6, z
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
