"""Derivation dataflows (D01–D18), re-aimed as Spark jobs.

The reference derives its end-of-day summaries, ledger postings,
settlements, bank credits and reference match result from its transaction
rows in single-threaded scripts. Here each is one lazy DataFrame plan
over the raw tables. Random draws of the scripts are replaced by fixed
integer rules on stable keys (the scripts are not reproducible, Q27), so a
SQL engine can re-derive every row.

Scale notes: every derivation is a map, a keyed aggregate or a keyed join.
Lists the scripts collect per group (references per batch, flags per
company-day) are replaced by bounded aggregates (counts and booleans), so no
group is ever materialised whole. Numbering inside a country (statement
lines, tickets) goes through :func:`number_rows`, which writes sorted ranges
of rows, however many of them one country, day or store has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import ReconConfig
from ledgerloom.functions.exprs import (
    MONEY, RATE, FX, first_match, lookup, not_in_nullsafe, pad_num, prior_month_28th,
    is_truthy, yyyy_mm, yyyymmdd,
)
from ledgerloom.operators.ranges import number_rows

# --- fixed values of the dataflows ------------------------------------------
# Flags that keep a transaction out of the ledger (besides a missing doc number)
NO_POSTING_FLAGS = ("SAP_BATCH_FAIL", "NULL_STORE", "WRONG_COUNTRY", "FUTURE_DATE")
# End-of-day excludes these transactions
EOD_EXCLUDED_FLAGS = ("NULL_STORE", "WRONG_COUNTRY", "FUTURE_DATE")
# Ledger accounts: clearing, revenue (starts with 004), tax payable
GL_CLEARING, GL_REVENUE, GL_TAX = "0011900000", "0040000001", "0021000000"
# Settlement batches skip these tenders
NON_SETTLED_TENDERS = ("CASH", "VOUCHER")
PROCESSOR_BY_TENDER = {"NETS": "NETS_OPERATOR", "PAYNOW": "FAST_NETWORK", "AMEX": "AMEX_DIRECT"}
DEFAULT_PROCESSOR = "MERCHANT_SERVICES"
# Public holidays by (month, day), all countries
HOLIDAYS = [(1, 1, "New Year's Day"), (5, 1, "Labour Day"), (12, 25, "Christmas Day")]
# Reference-result ageing: exceptions before this date are mostly cleared
CLEARING_CUTOFF = "2001-07-01"
# ---------------------------------------------------------------------------


def txn_key(c="pos_txn_id") -> F.Column:
    """Numeric stable key of a transaction id 'TXN-<n>'."""
    return F.substring(F.col(c), 5, 40).cast("bigint")


# ---------------------------------------------------------------- D01 – D03
def date_spine(header: DataFrame, by: list[str]) -> DataFrame:
    """One row per day between the first and last business date
    seen for each ``by`` group (a generator per group, not a cross join)."""
    bounds = header.groupBy(*by).agg(F.min("business_date").alias("__lo"),
                                      F.max("business_date").alias("__hi"))
    return bounds.select(*by, F.explode(F.sequence("__lo", "__hi")).alias("date_key"))


def holidays(spark) -> DataFrame:
    return spark.createDataFrame(HOLIDAYS, "hol_month int, hol_day int, public_holiday_name string")


def fiscal_calendar(header: DataFrame, country: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Calendar per active country over its business-date range."""
    spine = date_spine(header, ["country_code"])
    active = country.filter("is_active").select("country_code")
    spine = spine.join(active, "country_code")
    hol = F.broadcast(holidays(header.sparkSession))
    d = F.col("date_key")
    cal = spine.join(hol, (F.month(d) == F.col("hol_month")) & (F.dayofmonth(d) == F.col("hol_day")), "left")
    return cal.select(
        F.concat_ws("-", "country_code", yyyy_mm(d)).alias("fiscal_period_key"),
        "country_code", d,
        F.year(d).alias("fiscal_year"),
        F.month(d).alias("fiscal_period"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("fiscal_quarter"),
        F.trunc(d, "month").alias("period_start_date"),
        F.last_day(d).alias("period_end_date"),
        (F.trunc(d, "month") >= F.trunc(F.lit(cfg.as_of_str).cast("date"), "month")).alias("is_period_open"),
        (F.month(d) == 12).alias("is_year_end_period"),
        ((F.weekday(d) < 5) & F.col("public_holiday_name").isNull()).alias("working_day_flag"),
        "public_holiday_name",
    )


def fx_rates(header: DataFrame, country: DataFrame) -> DataFrame:
    """Daily rate per base currency, a fixed ±0.3% drift around a base."""
    spine = date_spine(header, ["currency_code"])
    cur = country.select(F.col("base_currency").alias("currency_code"),
                                           "country_name", "sap_company_code")
    j = spine.join(cur, "currency_code")
    num = F.substring("sap_company_code", 2, 10).cast("int")
    day = F.datediff("date_key", F.lit("1990-01-01").cast("date"))
    drift = ((day * 37 + num * 11) % 601 - 300).cast("decimal(10,0)") * F.lit(0.00001).cast("decimal(6,5)")
    base = F.lit(0.20).cast("decimal(6,2)") + num * F.lit(0.05).cast("decimal(4,2)")
    usd = F.round(base * (F.lit(1) + drift), 6).cast(FX)
    return j.select(
        "currency_code",
        F.concat(F.col("country_name"), F.lit(" currency")).alias("currency_name"),
        F.col("currency_code").alias("currency_symbol"),
        F.lit(2).alias("decimal_places"),
        F.col("date_key").alias("rate_date"),
        usd.alias("rate_to_usd"),
        F.round(usd * F.lit(1.35).cast("decimal(3,2)"), 6).cast(FX).alias("rate_to_sgd"),
        F.lit("FIXED-DRIFT").alias("rate_source"),
        F.lit(False).alias("is_group_currency"),
    )


# ---------------------------------------------------------------- D05
def eod_summary(header: DataFrame, tender: DataFrame) -> DataFrame:
    """One end-of-day row per (country, store, day) with 8 totals."""
    h = header.filter((F.col("txn_type") != "VOID") & F.col("store_id").isNotNull()
                      & ~F.col("_dq_flag").isin(*EOD_EXCLUDED_FLAGS))
    # Pre-aggregate tenders per transaction: split payments never fan out net.
    t = tender.groupBy("pos_txn_id").agg(
        F.sum(F.when(F.col("tender_code") == "CASH", F.col("tender_amount"))).alias("__cash"),
        F.sum(F.when(F.col("tender_code") == "PAYNOW", F.col("tender_amount"))).alias("__paynow"),
        F.sum(F.when(F.col("tender_code") == "DUITNOW_MY", F.col("tender_amount"))).alias("__duitnow"),
        F.sum(F.when(F.col("tender_code") == "NETS", F.col("tender_amount"))).alias("__nets"),
    )
    j = h.join(t, "pos_txn_id", "left")
    z = F.lit(0).cast(MONEY)
    # One currency per country: grouping by it keeps the aggregate buffer
    # fixed-width (hash aggregate, no sort).
    g = j.groupBy("country_code", "store_id", "business_date", "currency_code").agg(
        F.sum("net_amount").cast(MONEY).alias("net_sales"),
        F.sum("tax_amount_local").cast(MONEY).alias("tax_collected"),
        F.coalesce(F.sum("__paynow"), z).cast(MONEY).alias("paynow_total"),
        F.coalesce(F.sum("__duitnow"), z).cast(MONEY).alias("duitnow_total"),
        F.coalesce(F.sum("__nets"), z).cast(MONEY).alias("nets_total"),
        F.max((F.col("_dq_flag") == "SAP_BATCH_FAIL").cast("int")).alias("__fail"),
    )
    return g.select(
        F.concat_ws("-", F.lit("EOD"), "store_id", yyyymmdd("business_date")).alias("eod_summary_id"),
        "country_code", "store_id", F.lit("ALL").alias("terminal_id"), "business_date",
        F.concat_ws("-", "country_code", yyyy_mm("business_date")).alias("fiscal_period_key"),
        "currency_code", "net_sales", "tax_collected",
        F.lit(0).cast(MONEY).alias("cash_variance"),
        "paynow_total", "duitnow_total", "nets_total",
        F.when(F.col("__fail") == 1, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("sap_transfer_status"),
        F.concat(F.lit("SUP-"), F.col("store_id")).alias("supervisor_id"),
        # the day carries the batch failure of any of its transactions
        F.when(F.col("__fail") == 1, F.lit("SAP_BATCH_FAIL")).otherwise(F.lit("CLEAN")).alias("_dq_flag"),
    )


# ---------------------------------------------------------------- D06 – D09
def _postable(header: DataFrame) -> DataFrame:
    """Eligible transactions with posting date, amount and tax."""
    h = header.filter((F.col("txn_status") == "COMPLETED") & is_truthy("sap_doc_number")
                      & not_in_nullsafe("_dq_flag", NO_POSTING_FLAGS))
    flag = F.col("_dq_flag")
    promo = (flag == "PROMO_UNMAPPED") & (F.col("discount_amount") > 0)
    manual = flag == "MANUAL_ERROR"
    k = txn_key()
    # Keyed manual error: (k div 25) % 17 - 8 steps of 20.00, replacing the draw
    adjust = ((k.cast("bigint") - k.cast("bigint") % 25) / 25 % 17 - 8).cast("decimal(4,0)") * F.lit(20).cast(MONEY)
    rate_pct = F.substring("tax_code", 3, 5).cast("int") + 5
    return h.select(
        "*",
        F.when(flag == "WRONG_PERIOD", prior_month_28th("business_date"))
         .otherwise(F.col("business_date")).alias("__budat"),
        first_match([(promo, F.col("gross_amount")), (manual, F.col("net_amount") + adjust)],
                    F.col("net_amount")).cast(MONEY).alias("__sap_net"),
        F.when(promo, F.round(F.abs("gross_amount") * F.lit(0.01).cast("decimal(3,2)") * rate_pct, 2))
         .otherwise(F.col("tax_amount_local")).cast(MONEY).alias("__sap_tax"),
        manual.alias("_manual_error"),
    )


def sap_documents(header: DataFrame) -> DataFrame:
    """Ledger document headers, one per eligible transaction."""
    p = _postable(header)
    k = txn_key()
    return p.select(
        F.col("sap_doc_number").alias("belnr"),
        F.col("sap_company_code").alias("bukrs"),
        F.year("business_date").alias("gjahr"),  # the document's year, also where the posting moves to another
        "country_code",
        F.when(F.col("txn_type") == "RETURN", F.lit("RE")).otherwise(F.lit("RV")).alias("blart"),
        F.col("business_date").alias("bldat"),
        F.col("__budat").alias("budat"),
        F.col("currency_code").alias("waers"),
        F.col("receipt_number").alias("xblnr"),
        F.when(F.col("_manual_error"), F.lit("MANUAL_USER")).otherwise(F.lit("BATCH_POS")).alias("usnam"),
        F.when(k % 7 == 0, F.lit(" ")).alias("bstat"),
        F.lit(None).cast("string").alias("stblg"),
        "country_code", "pos_txn_id", "_dq_flag", "_manual_error",
    ).toDF("belnr", "bukrs", "gjahr", "country_code", "blart", "bldat", "budat", "waers", "xblnr",
           "usnam", "bstat", "stblg", "tax_country", "pos_txn_id", "_dq_flag", "_manual_error")


def sap_lineitems(header: DataFrame) -> DataFrame:
    """Double-entry lines, 2 or 3 per document (tax line only if tax ≠ 0).

    Clearing carries |net| + |tax| on one side, revenue and tax the other;
    the sides flip when the posted amount is negative (returns).
    """
    p = _postable(header)
    net, tax = F.col("__sap_net"), F.col("__sap_tax")
    pos = net >= 0
    line = lambda buzei, acct, side, amt, text: F.struct(
        F.lit(buzei).alias("buzei"), F.lit(acct).alias("hkont"), side.alias("shkzg"),
        amt.cast(MONEY).alias("dmbtr"), F.lit(text).alias("sgtxt"))
    s_or_h = F.when(pos, F.lit("S")).otherwise(F.lit("H"))
    h_or_s = F.when(pos, F.lit("H")).otherwise(F.lit("S"))
    lines = F.array(
        line("001", GL_CLEARING, s_or_h, F.abs(net) + F.abs(tax), "POS clearing"),
        line("002", GL_REVENUE, h_or_s, F.abs(net), "Sales revenue"),
        line("003", GL_TAX, h_or_s, F.abs(tax), "Tax payable"),
    )
    # the zero tax line goes after the explode: a lambda over the array is interpreted row by row
    e = p.select("sap_doc_number", "sap_company_code", "business_date", "currency_code", "tax_code",
                 "store_id", "_dq_flag", F.explode(lines).alias("l"))
    e = e.filter((F.col("l.buzei") != "003") | (F.col("l.dmbtr") > 0))
    return e.select(
        F.col("sap_doc_number").alias("belnr"),
        F.col("sap_company_code").alias("bukrs"),
        F.year("business_date").alias("gjahr"),
        F.col("l.buzei").alias("buzei"),
        F.col("l.hkont").alias("hkont"),
        F.col("l.shkzg").alias("shkzg"),
        F.col("l.dmbtr").alias("dmbtr"),
        F.col("currency_code").alias("hwae"),
        F.lit(None).cast("string").alias("augbl"),
        F.lit(None).cast("date").alias("augdt"),
        F.when(F.col("l.buzei") != "001", F.col("tax_code")).alias("mwskz"),
        F.lit(None).cast("string").alias("kostl"),
        F.lit(None).cast("string").alias("prctr"),
        F.col("l.sgtxt").alias("sgtxt"),
        "_dq_flag",
    )


# ---------------------------------------------------------------- D10 – D13
def settlement_batches(tender: DataFrame, country: DataFrame, tender_type: DataFrame) -> DataFrame:
    """Processor settlement per (batch, country, day, tender, currency)."""
    active = country.filter("is_active").select(
        "country_code", "sap_company_code")
    rates = tender_type.select(
        "tender_code", F.col("interchange_rate_pct").alias("__contracted"),
        F.col("settlement_lag_days").alias("__lag"))
    t = tender.filter((F.col("tender_amount") > 0) & not_in_nullsafe("tender_code", NON_SETTLED_TENDERS))
    b = (t.join(active, "country_code")
          .groupBy("settlement_batch", "country_code", "business_date", "tender_code", "currency_code",
                   "sap_company_code")
          .agg(F.sum("tender_amount").cast(MONEY).alias("gross_amount"),
               F.count(F.lit(1)).alias("txn_count"),
               F.min(txn_key()).alias("__k")))
    b = b.join(rates, "tender_code", "left")
    k = F.col("__k")
    flag = first_match([(k % 200 == 4, "MISSING_CREDIT"), (k % 100 == 2, "FEE_DISPUTE"),
                        (k % 100 == 8, "FEE_VARIANCE"), (k % 60 == 5, "ROUNDING_DIFF"),
                        (k % 150 == 6, "SHORT_CREDIT")], "CLEAN")
    actual = F.when(flag.isin("FEE_DISPUTE", "FEE_VARIANCE"),
                    F.col("__contracted") * F.lit(1.1).cast("decimal(2,1)")).otherwise(F.col("__contracted"))
    b = b.withColumn("_dq_flag", flag).withColumn("actual_rate_pct", actual.cast(RATE))
    fee = F.round(F.col("gross_amount") * F.col("actual_rate_pct") * F.lit(0.01).cast("decimal(3,2)"), 2)
    b = b.withColumn("interchange_fee", fee.cast(MONEY))
    store = F.regexp_extract("settlement_batch", r"^BATCH-(ST-[0-9]+|NOSTORE)-", 1)
    tail = F.substring("settlement_batch", 7, 200)
    proc = lookup("tender_code", PROCESSOR_BY_TENDER, F.concat(F.lit(DEFAULT_PROCESSOR + "_"), F.col("country_code")))
    num = F.substring("sap_company_code", 2, 10).cast("int")
    return b.select(
        F.concat(F.lit("STL-"), tail).alias("settlement_id"),
        "country_code",
        proc.alias("processor_name"),
        F.concat(F.lit("MER-"), store).alias("merchant_id"),
        F.concat(F.lit("Merchant "), store).alias("merchant_name"),
        F.col("business_date").alias("txn_date"),
        F.date_add("business_date", F.coalesce(F.col("__lag"), F.lit(1))).alias("settle_date"),
        "currency_code", "tender_code",
        F.col("txn_count").cast("bigint").alias("txn_count"),
        "gross_amount",
        F.lit(0).cast(MONEY).alias("refund_amount"),
        F.lit(0).cast(MONEY).alias("chargeback_amount"),
        "interchange_fee",
        F.col("__contracted").cast(RATE).alias("contracted_rate_pct"),
        "actual_rate_pct",
        (F.col("gross_amount") - F.col("interchange_fee")).cast(MONEY).alias("net_settlement"),
        F.col("settlement_batch").alias("settlement_batch_id"),
        F.concat(F.lit("ACCT-"), pad_num(num, 3)).alias("bank_account"),
        F.concat(F.lit("BANK"), num.cast("string")).alias("bank_code"),
        F.lit("OPEN").alias("sap_clear_status"),
        F.lit(None).cast("string").alias("sap_clear_doc"),
        "_dq_flag",
    )


def bank_statement_lines(settlement: DataFrame, country: DataFrame) -> DataFrame:
    """One credit per settlement except missing ones, numbered per country."""
    rail = country.select("country_code", "bank_transfer_rail")
    s = settlement.filter(F.col("_dq_flag") != "MISSING_CREDIT").join(rail, "country_code", "left")
    flag, net, gross = F.col("_dq_flag"), F.col("net_settlement"), F.col("gross_amount")
    contracted_fee = F.round(gross * F.col("contracted_rate_pct") * F.lit(0.01).cast("decimal(3,2)"), 2)
    amount = first_match([(flag == "FEE_DISPUTE", gross - contracted_fee),
                          (flag == "ROUNDING_DIFF", net - F.lit(0.50).cast(MONEY)),
                          (flag == "SHORT_CREDIT", net - F.lit(25).cast(MONEY))], net)
    s = s.withColumn("value_date", F.col("settle_date")).withColumn("amount", amount.cast(MONEY))
    # merchant_id orders as the settlement id's store part does
    s = number_rows(s, ["country_code"], ["value_date", "merchant_id", "settlement_id"], out_col="__seq")
    return s.select(
        F.concat_ws("-", F.lit("BSL"), "country_code", pad_num(F.col("__seq"), 8)).alias("statement_line_id"),
        "country_code", "bank_code", "bank_account", "currency_code", "value_date", "amount",
        F.lit("C").alias("dc_indicator"),
        F.col("bank_transfer_rail").alias("payment_rail"),
        F.col("settlement_batch_id").alias("customer_reference"),
        F.when(F.col("tender_code") == "PAYNOW", F.concat(F.lit("FAST"), F.col("settlement_id"))).alias("fast_ref"),
        F.concat_ws(" ", "processor_name", F.lit("SETTLEMENT"), "settlement_batch_id").alias("narrative"),
        F.lit("OPEN").alias("sap_clear_status"),
        F.lit(None).cast("string").alias("sap_clear_doc"),
        "_dq_flag",
        F.col("settlement_id").alias("_settle_id"),
    )


# ---------------------------------------------------------------- D14 – D18
def _ledger_by_company_day(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """Signed ledger revenue per company and document date."""
    rev = F.when(F.col("shkzg") == "H", F.col("dmbtr")).otherwise(-F.col("dmbtr"))
    l = (lines.filter(F.col("hkont").startswith("004"))
              .groupBy("belnr", "bukrs", "gjahr").agg(F.sum(rev).alias("__rev")))
    d = documents.select("belnr", "bukrs", "gjahr", "bldat")
    return l.join(d, ["belnr", "bukrs", "gjahr"]).groupBy("bukrs", "bldat").agg(
        F.sum("__rev").cast(MONEY).alias("ledger_total"))


# Fixed values of the reference result: cause of an unmatched sales day by its own flag
CAUSE_BY_FLAG = {"SAP_BATCH_FAIL": "RC-001", "PROMO_UNMAPPED": "RC-003", "ROUNDING_DIFF": "RC-007",
                 "WRONG_PERIOD": "RC-008", "DUPLICATE_TXN": "RC-005"}
DEFAULT_SALES_CAUSE = "RC-003"
EXACT_WITHIN, ROUNDING_BELOW = "0.01", "1.00"
# Tickets of the n-th company count on from 1000 * n
TICKET_BASE = 1000


def _sales_matches(eod: DataFrame, ledger: DataFrame, cfg: DataFrame) -> DataFrame:
    """A store's day against its company's whole ledger day (Q5); the
    row's own flag decides before the amount does."""
    e = eod.join(cfg, "country_code")
    e = e.join(ledger, (e.sap_company_code == ledger.bukrs) & (e.business_date == ledger.bldat), "left")
    sap = F.coalesce(F.col("ledger_total"), F.lit(0)).cast(MONEY)
    e = e.withColumn("sap", sap).withColumn("v", (F.col("net_sales") - sap).cast(MONEY)).withColumn("av", F.abs("v"))
    flag, av, none = F.col("_dq_flag"), F.col("av"), F.lit(None).cast("string")
    within = lambda x: av <= x
    steps = [(flag == "SAP_BATCH_FAIL", "UNMATCHED", "EXCEPTION", F.lit("RC-001")),
             (within(F.lit(EXACT_WITHIN).cast(MONEY)), "EXACT", "MATCHED", none),
             (within(F.col("t2")), "TOLERANCE", "MATCHED", F.when(av < F.lit(ROUNDING_BELOW).cast(MONEY), F.lit("RC-007"))),
             (within(F.col("t3")), "TOLERANCE", "EXCEPTION", F.when(F.contains(flag, F.lit("PROMO")), F.lit("RC-003")).otherwise(F.lit("RC-007")))]
    return _outcome(e, steps, ("UNMATCHED", "EXCEPTION", lookup("_dq_flag", CAUSE_BY_FLAG, F.lit(DEFAULT_SALES_CAUSE)))).select(
        F.concat_ws("-", F.lit("MATCH-POS-SAP"), "country_code_iso2", yyyymmdd("business_date"),
                    F.substring("store_id", -3, 3)).alias("match_id"),
        F.lit("POS_SAP").alias("recon_type"), "country_code",
        F.col("business_date").alias("recon_date"), "fiscal_period_key", "store_id", "currency_code",
        F.col("net_sales").alias("pos_amount"), F.col("sap").alias("sap_amount"), F.lit(0).cast(MONEY).alias("bank_amount"),
        F.col("v").alias("variance_pos_sap"), F.lit(0).cast(MONEY).alias("variance_sap_bank"),
        F.col("t3").alias("threshold_applied"), "match_type", "match_status", "root_cause_code",
        ((F.col("match_status") == "EXCEPTION") & (av >= F.col("t3"))).alias("__ticketed"),
        "regulatory_body", "country_code_iso2", "sap_company_code",
        (F.abs(F.col("net_sales") * 100).cast("bigint") % 100).alias("__draw"),
        F.lit(0).alias("__type_rank"), F.col("store_id").alias("__store"), F.col("store_id").alias("__ord"), "_dq_flag",
    )


def _payment_matches(settlement: DataFrame, bank: DataFrame, cfg: DataFrame) -> DataFrame:
    """A settlement against the one credit looked up by its reference
    (the latest line where several carry it); flags before amounts."""
    credit = bank.groupBy(F.col("customer_reference").alias("settlement_batch_id")).agg(
        F.max_by("amount", F.struct("value_date", "statement_line_id")).alias("__credit"))
    s = settlement.join(cfg, "country_code").join(credit, "settlement_batch_id", "left")
    got = F.coalesce(F.col("__credit"), F.lit(0)).cast(MONEY)
    s = s.withColumn("got", got).withColumn("v", (F.col("net_settlement") - got).cast(MONEY)).withColumn("av", F.abs("v"))
    flag, av, none = F.col("_dq_flag"), F.col("av"), F.lit(None).cast("string")
    steps = [(flag == "MISSING_CREDIT", "UNMATCHED", "EXCEPTION", F.lit("RC-014")),
             (flag == "CHARGEBACK", "UNMATCHED", "EXCEPTION", F.lit("RC-011")),
             (flag.isin("FEE_DISPUTE", "FEE_VARIANCE"), "TOLERANCE", "EXCEPTION", F.lit("RC-010")),
             (av <= F.lit(EXACT_WITHIN).cast(MONEY), "EXACT", "MATCHED", none),
             (av <= F.col("t2"), "TOLERANCE", "MATCHED", none)]
    store = F.regexp_extract("settlement_batch_id", r"^BATCH-(ST-[0-9]+|NOSTORE)-", 1)
    return _outcome(s, steps, ("UNMATCHED", "EXCEPTION", F.lit("RC-009"))).select(
        F.concat_ws("-", F.lit("MATCH-PAY-BANK"), "country_code_iso2", yyyymmdd("settle_date"),
                    F.substring("settlement_batch_id", -6, 6)).alias("match_id"),
        F.lit("PAY_BANK").alias("recon_type"), "country_code",
        F.col("settle_date").alias("recon_date"),
        F.concat_ws("-", "country_code", yyyy_mm("settle_date")).alias("fiscal_period_key"),
        F.when(store != "NOSTORE", store).alias("store_id"), "currency_code",
        F.lit(0).cast(MONEY).alias("pos_amount"), F.col("net_settlement").alias("sap_amount"), F.col("got").alias("bank_amount"),
        F.lit(0).cast(MONEY).alias("variance_pos_sap"), F.col("v").alias("variance_sap_bank"),
        F.col("t3").alias("threshold_applied"), "match_type", "match_status", "root_cause_code",
        (F.col("match_status") == "EXCEPTION").alias("__ticketed"),
        "regulatory_body", "country_code_iso2", "sap_company_code",
        (F.abs(F.col("gross_amount") * 100).cast("bigint") % 100).alias("__draw"),
        F.lit(1).alias("__type_rank"), F.col("merchant_id").alias("__store"), F.col("settlement_id").alias("__ord"), "_dq_flag",
    )


def _outcome(df: DataFrame, steps: list[tuple], last: tuple) -> DataFrame:
    """match_type, match_status and root_cause_code of the first step that holds."""
    out = F.struct(F.lit(last[0]).alias("match_type"), F.lit(last[1]).alias("match_status"), last[2].alias("root_cause_code"))
    for holds, kind, status, cause in reversed(steps):
        out = F.when(holds, F.struct(F.lit(kind).alias("match_type"), F.lit(status).alias("match_status"),
                                     cause.alias("root_cause_code"))).otherwise(out)
    return df.withColumn("__o", out).select("*", "__o.*").drop("__o")


def reference_match_result(eod: DataFrame, documents: DataFrame, lines: DataFrame,
                           settlement: DataFrame, bank: DataFrame, country: DataFrame) -> DataFrame:
    """The pre-computed reference result the exception log reads.

    Ids use the short format (country prefix, store suffix) that never meets
    the models' ids (Q1); payment ids keep only the batch tail (Q4).
    """
    cfg = country.filter("is_active").select(
        "country_code", "country_code_iso2", "sap_company_code", "regulatory_body",
        F.col("variance_threshold_t2").alias("t2"), F.col("variance_threshold_t3").alias("t3"))
    allr = _sales_matches(eod, _ledger_by_company_day(documents, lines), cfg).unionByName(
        _payment_matches(settlement, bank, cfg))
    # Tickets for exceptions (sales only from t3 on), numbered per country
    # across both types before clearing; the flag is part of the group, so the
    # rows are evaluated once and tickets count ticketed rows only.
    allr = number_rows(allr, ["country_code", "__ticketed"],
                       ["__type_rank", "recon_date", "__store", "__ord", "match_id"], out_col="__tseq")
    base = (F.substring("sap_company_code", 2, 10).cast("bigint") + 1) * TICKET_BASE
    ticket = F.concat_ws("-", F.lit("INC"), "country_code_iso2", F.year("recon_date").cast("string"),
                         pad_num(base + F.col("__tseq"), 4))
    allr = allr.withColumn("it_ticket_ref", F.when(F.col("__ticketed"), ticket))
    # Old exceptions mostly cleared by hand (85% sales, 80% payments)
    share = F.when(F.col("__type_rank") == 0, F.lit(85)).otherwise(F.lit(80))
    cleared = ((F.col("match_status") == "EXCEPTION") & (F.col("recon_date") < F.lit(CLEARING_CUTOFF).cast("date"))
               & (F.col("__draw") < share))
    allr = (allr.withColumn("__cleared", cleared)
                .withColumn("match_type", F.when(F.col("__cleared"), F.lit("MANUAL")).otherwise(F.col("match_type")))
                .withColumn("match_status", F.when(F.col("__cleared"), F.lit("MATCHED")).otherwise(F.col("match_status"))))
    # Maker and checker; checker and time only when matched, the regulator's reference only on open rows
    matched = F.col("match_status") == "MATCHED"
    return allr.select(
        "match_id", "recon_type", "country_code", "recon_date", "fiscal_period_key", "store_id",
        "currency_code", "pos_amount", "sap_amount", "bank_amount", "variance_pos_sap",
        "variance_sap_bank", "threshold_applied", "match_type", "match_status", "root_cause_code",
        F.when(~matched, F.col("regulatory_body")).alias("regulatory_ref"), "it_ticket_ref",
        F.concat(F.lit("EMP-"), F.col("country_code_iso2"), F.lit("-2014"),
                 (F.col("__draw") % 3 + 5).cast("string")).alias("preparer_id"),
        F.when(matched, F.concat(F.lit("EMP-"), F.col("country_code_iso2"), F.lit("-1002"),
                                 (F.col("__draw") % 2 + 3).cast("string"))).alias("reviewer_id"),
        F.when(matched, F.concat(F.col("recon_date").cast("string"), F.lit(" 17:30:00+08:00"))
               .cast("timestamp")).alias("reviewed_at"),
        "_dq_flag",
    )
