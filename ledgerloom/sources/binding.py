"""Binding of the test warehouse (TPC-H-style tables) to the raw tables.

The reconciliation reads sixteen raw tables; the test warehouse has orders,
customers, nations and regions. This module maps them, by fixed integer
rules on the order key (integer modulo only, so any SQL engine reproduces
them), onto the dimensions and the two POS fact tables. Everything else
(end-of-day, ledger, settlements, bank lines, reference result) is derived
from those by :mod:`ledgerloom.operators.derive`, exactly as the reference's
dataflows derive them from its transactions.

Mapping: country = region name (region key 4 inactive); store = nation;
one POS transaction per order, store = customer's nation; one tender per
non-void transaction, tender chosen by the order priority.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import TESTDATA_INACTIVE_REGIONKEY
from ledgerloom.functions.exprs import MONEY, RATE, first_match, lookup, pad_num, yyyymmdd

# --- fixed values of the binding -------------------------------------------
# Break flags injected by order key (first match wins): (modulus, remainder, flag)
BREAK_RULES = [
    (97, 5, "SAP_BATCH_FAIL"),
    (33, 4, "PROMO_UNMAPPED"),
    (125, 6, "DUPLICATE_TXN"),
    (500, 8, "WRONG_PERIOD"),
    (1000, 9, "NULL_STORE"),
    (25, 7, "MANUAL_ERROR"),
]
BREAK_DESCRIPTIONS = {
    "SAP_BATCH_FAIL": "SAP batch posting job failed",
    "PROMO_UNMAPPED": "Promotion not mapped in SAP pricing",
    "DUPLICATE_TXN": "Transaction transmitted twice",
    "WRONG_PERIOD": "Posted to prior fiscal period",
    "NULL_STORE": "Store id missing on transaction",
    "MANUAL_ERROR": "Manual posting with wrong amount",
}
# Transaction type by order key: VOID when k % 50 = 1, RETURN when k % 20 = 3.
# Tender by the first digit of o_orderpriority (1..5).
TENDER_BY_PRIORITY = {1: "VISA", 2: "MASTERCARD", 3: "AMEX", 4: "NETS", 5: "PAYNOW"}
TENDER_CATEGORY = {"VISA": "CARD", "MASTERCARD": "CARD", "AMEX": "CARD", "NETS": "CARD", "PAYNOW": "EWALLET"}
TENDER_LAG_DAYS = {"VISA": 1, "MASTERCARD": 1, "AMEX": 2, "NETS": 1, "PAYNOW": 0}
TENDER_NAME = {"VISA": "Visa Credit / Debit", "MASTERCARD": "Mastercard Credit / Debit",
               "AMEX": "American Express", "NETS": "NETS Debit", "PAYNOW": "PayNow / FAST"}
STORE_OPEN_BASE = "1990-01-01"   # open_date = base + 100 days x nation key
PROMO_DISCOUNT = "0.10"
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def geography(nation: DataFrame, region: DataFrame) -> DataFrame:
    """nation ⋈ region: 25 x 5 rows at every scale factor."""
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_regionkey", "r_name")


def dim_country(region: DataFrame) -> DataFrame:
    rk = F.col("r_regionkey")
    return region.select(
        F.col("r_name").alias("country_code"),
        F.substring("r_name", 1, 2).alias("country_code_iso2"),
        F.col("r_name").alias("country_name"),
        F.concat(F.lit("C"), pad_num(rk, 3)).alias("sap_company_code"),
        F.substring("r_name", 1, 3).alias("base_currency"),
        F.lit("USD").alias("group_currency"),
        F.lit("VAT").alias("tax_system"),
        (rk + 5).cast(RATE).alias("tax_rate_standard"),
        F.lit(12).alias("fiscal_year_end_month"),
        F.lit("UTC").alias("timezone"),
        F.lit(1).alias("settlement_lag_days"),
        (F.lit(20) + rk * 10).cast(MONEY).alias("variance_threshold_t2"),
        (F.lit(100) + rk * 50).cast(MONEY).alias("variance_threshold_t3"),
        (F.lit(500) + rk * 250).cast(MONEY).alias("variance_threshold_t4"),
        F.concat(F.lit("REG-"), rk.cast("string")).alias("regulatory_body"),
        F.concat(F.lit("DPL-"), rk.cast("string")).alias("data_privacy_law"),
        F.lit("PAYNOW, NETS").alias("dominant_ewallet"),
        F.concat(F.lit("RAIL-"), rk.cast("string")).alias("bank_transfer_rail"),
        (rk != F.lit(TESTDATA_INACTIVE_REGIONKEY)).alias("is_active"),
    )


def _bank_account(rk):
    return F.concat(F.lit("ACCT-"), pad_num(rk, 3))


def dim_store(nation: DataFrame, region: DataFrame) -> DataFrame:
    nk, rk = F.col("n_nationkey"), F.col("r_regionkey")
    sid = F.concat(F.lit("ST-"), pad_num(nk, 3))
    return geography(nation, region).select(
        sid.alias("store_id"),
        F.col("r_name").alias("country_code"),
        F.concat(F.lit("Store "), F.col("n_name")).alias("store_name"),
        F.concat(F.col("n_name"), F.lit(" Mall")).alias("mall_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.when(nk < 5, F.lit("FLAGSHIP")).otherwise(F.lit("STANDARD")).alias("store_type"),
        F.concat(F.lit("PC-"), pad_num(nk, 3)).alias("sap_profit_center"),
        F.concat(F.lit("CC-"), pad_num(nk, 3)).alias("sap_cost_center"),
        _bank_account(rk).alias("bank_account"),
        F.concat(F.lit("BANK"), rk.cast("string")).alias("bank_code"),
        F.concat(F.lit("MID-"), pad_num(nk, 3)).alias("mas_merchant_id"),
        F.concat(F.lit("TAX-"), pad_num(nk, 3)).alias("tax_registration"),
        F.concat(F.lit("MGR-"), pad_num(nk, 3)).alias("store_manager"),
        F.date_add(F.lit(STORE_OPEN_BASE).cast("date"), (nk * 100).cast("int")).alias("open_date"),
        F.lit(True).alias("is_active"),
        (F.lit(2000) + nk * 100).cast("int").alias("floor_area_sqft"),
        (F.lit(2) + nk % 5).cast("int").alias("num_terminals"),
    )


def dim_tender_type(orders: DataFrame) -> DataFrame:
    """Tender types actually used: one per distinct order priority."""
    t = F.substring("o_orderpriority", 1, 1).cast("int")
    pri = orders.select(t.alias("t")).distinct()
    code = lookup("t", TENDER_BY_PRIORITY)
    return pri.select(
        code.alias("tender_code"),
        F.lit("BOTH").alias("country_code"),
        lookup(code, TENDER_NAME).alias("tender_name"),
        lookup(code, TENDER_CATEGORY).alias("tender_category"),
        F.concat(F.lit("00111000"), pad_num(F.col("t"), 2)).alias("sap_gl_account"),
        lookup(code, TENDER_LAG_DAYS).cast("int").alias("settlement_lag_days"),
        (lookup(code, TENDER_CATEGORY) == F.lit("CARD")).alias("is_card"),
        (lookup(code, TENDER_CATEGORY) == F.lit("EWALLET")).alias("is_ewallet"),
        (F.col("t") * F.lit(0.5)).cast(RATE).alias("interchange_rate_pct"),
        F.lit(True).alias("is_active"),
        F.concat(F.lit("Priority "), F.col("t").cast("string")).alias("notes"),
    )


def break_flag(k) -> F.Column:
    return first_match([((k % m) == r, flag) for m, r, flag in BREAK_RULES], "CLEAN")


def txn_type(k) -> F.Column:
    return first_match([((k % 50) == 1, "VOID"), ((k % 20) == 3, "RETURN")], "SALE")


def pos_transaction_header(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                           region: DataFrame) -> DataFrame:
    """One POS transaction per order (D04 re-aimed on the test warehouse)."""
    geo = geography(nation, region)
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_nationkey")
    base = (o.join(c, o.o_custkey == c.c_custkey)
             .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    k = F.col("o_orderkey")
    g = F.col("o_totalprice").cast(MONEY)
    flag, typ = F.col("_dq_flag"), F.col("txn_type")
    promo_sale = (flag == "PROMO_UNMAPPED") & (typ == "SALE")
    posts = (typ != "VOID") & ~flag.isin("SAP_BATCH_FAIL", "DUPLICATE_TXN", "NULL_STORE")
    h = base.select(
        k, g.alias("g"), "r_regionkey", "r_name", "c_nationkey", "o_orderdate",
        txn_type(k).alias("txn_type"), break_flag(k).alias("_dq_flag"))
    h = h.withColumn("gross_amount", F.when(typ == "RETURN", -F.col("g")).otherwise(F.col("g")).cast(MONEY))
    h = h.withColumn("discount_amount", F.when(promo_sale, F.round(F.col("g") * F.lit(PROMO_DISCOUNT).cast("decimal(3,2)"), 2))
                     .otherwise(F.lit(0)).cast(MONEY))
    h = h.withColumn("net_amount", (F.col("gross_amount") - F.col("discount_amount")).cast(MONEY))
    store = F.concat(F.lit("ST-"), pad_num(F.col("c_nationkey"), 3))
    rk = F.col("r_regionkey")
    return h.select(
        F.concat(F.lit("TXN-"), k.cast("string")).alias("pos_txn_id"),
        F.col("r_name").alias("country_code"),
        F.when(flag == "NULL_STORE", F.lit(None).cast("string")).otherwise(store).alias("store_id"),
        F.concat(store, F.lit("-T"), (k % 4 + 1).cast("string")).alias("terminal_id"),
        F.concat(F.lit("CSH-"), pad_num(k % 50, 3)).alias("cashier_id"),
        F.col("o_orderdate").cast("date").alias("business_date"),
        # the order time is a wall-clock value; read it as UTC whatever the session zone
        F.from_utc_timestamp(F.date_trunc("second", "o_orderdate"), F.current_timezone()).alias("txn_datetime_utc"),
        typ,
        F.lit("COMPLETED").alias("txn_status"),
        "gross_amount", "discount_amount", "net_amount",
        F.concat(F.lit("TX"), rk.cast("string")).alias("tax_code"),
        # tax = net x (5 + region key) %, by exact decimal multiplication
        F.round(F.col("net_amount") * F.lit(0.01).cast("decimal(3,2)") * (rk + 5), 2).cast(MONEY)
         .alias("tax_amount_local"),
        F.substring("r_name", 1, 3).alias("currency_code"),
        F.col("net_amount").alias("total_tendered"),
        F.when(promo_sale, F.concat(F.lit("PROMO-"), (k % 10).cast("string"))).alias("promo_code"),
        F.concat(F.lit("RCPT-"), k.cast("string")).alias("receipt_number"),
        F.concat(F.lit("C"), pad_num(rk, 3)).alias("sap_company_code"),
        F.when(posts, k.cast("string")).alias("sap_doc_number"),
        F.when(posts, F.lit("POSTED")).otherwise(F.lit("FAILED")).alias("sap_post_status"),
        flag,
        lookup(flag, BREAK_DESCRIPTIONS).alias("_dq_description"),
    )


def pos_tender(header: DataFrame, orders: DataFrame) -> DataFrame:
    """One tender per non-void transaction; amount is absolute, as the
    reference stores it (so returns enter gross settlement)."""
    # join on the numeric order key (cheaper to hash than the text id)
    pri = orders.select(F.col("o_orderkey").alias("__k"),
                        F.substring("o_orderpriority", 1, 1).cast("int").alias("__t"))
    h = header.filter(F.col("txn_type") != "VOID").withColumn(
        "__hk", F.substring("pos_txn_id", 5, 40).cast("bigint"))
    # the codes are columns of their own, so that their CASEs are not repeated inside one another
    j = (h.join(pri, F.col("__hk") == F.col("__k")).withColumn("__code", lookup("__t", TENDER_BY_PRIORITY))
          .withColumn("__category", lookup("__code", TENDER_CATEGORY)))
    code, category = F.col("__code"), F.col("__category")
    k = F.col("__hk")
    return j.select(
        F.concat(F.lit("TND-"), k.cast("string")).alias("pos_tender_id"),
        "pos_txn_id", "country_code",
        code.alias("tender_code"),
        F.abs("gross_amount").cast(MONEY).alias("tender_amount"),
        "currency_code",
        F.when(code == "PAYNOW", F.lit("PAYNOW")).alias("ewallet_provider"),
        F.when(code == "PAYNOW", F.concat(F.lit("PN"), k.cast("string"))).alias("paynow_ref"),
        F.lit(None).cast("string").alias("duitnow_ref"),
        F.when(code == "NETS", F.concat(F.lit("NT"), k.cast("string"))).alias("nets_ref"),
        F.when(category == "CARD", pad_num(k % 10000, 4)).alias("card_last4"),
        F.when(category == "CARD", code).alias("card_type"),
        F.concat(F.lit("AP"), pad_num(k % 1000000, 6)).alias("approval_code"),
        F.concat(F.lit("RRN"), k.cast("string")).alias("rrn"),
        F.concat_ws("-", F.lit("BATCH"), F.coalesce(F.col("store_id"), F.lit("NOSTORE")), code,
                    yyyymmdd("business_date")).alias("settlement_batch"),
        "business_date",
        "_dq_flag",
    )


# --- fixed values: ledger lines from lineitem (scale variant) ---------------
# account by l_returnflag (A, R revenue; N clearing), side by l_linestatus
LINE_ACCOUNT_BY_RETURNFLAG = {"A": "0040000001", "R": "0040000009", "N": "0011900000"}
LINE_SIDE_BY_LINESTATUS = {"O": "H", "F": "S"}
# -----------------------------------------------------------------------------


def sap_lineitems_from_lineitem(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                                nation: DataFrame, region: DataFrame) -> DataFrame:
    """Ledger lines at the volume of the largest test table: one line per
    lineitem, keyed to its order's document (belnr = order key, company of the
    customer's region, year of the order date). Account from l_returnflag,
    debit/credit from l_linestatus, amount = l_extendedprice as money.
    (l_orderkey, l_linenumber) repeats in the test data, so buzei does too."""
    geo = geography(nation, region)
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = customer.select("c_custkey", "c_nationkey")
    l = lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus")
    j = (l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
          .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    return j.select(
        F.col("l_orderkey").cast("string").alias("belnr"),
        F.concat(F.lit("C"), pad_num(F.col("r_regionkey"), 3)).alias("bukrs"),
        F.year("o_orderdate").cast("int").alias("gjahr"),
        pad_num(F.col("l_linenumber"), 3).alias("buzei"),
        lookup("l_returnflag", LINE_ACCOUNT_BY_RETURNFLAG, "0011900000").alias("hkont"),
        lookup("l_linestatus", LINE_SIDE_BY_LINESTATUS, "S").alias("shkzg"),
        F.col("l_extendedprice").cast(MONEY).alias("dmbtr"),
        F.substring("r_name", 1, 3).alias("hwae"),
        F.lit(None).cast("string").alias("augbl"),
        F.lit(None).cast("date").alias("augdt"),
        F.lit(None).cast("string").alias("mwskz"),
        F.lit(None).cast("string").alias("kostl"),
        F.lit(None).cast("string").alias("prctr"),
        F.concat(F.lit("LINE "), F.col("l_linenumber").cast("string")).alias("sgtxt"),
        F.lit("CLEAN").alias("_dq_flag"),
    )
