"""Joins and sequences that no model isolates: J14, J16, J19, J21, W07.

Each is written to stay an equi join or a per-group generator at scale:
the tender wildcard (country equal OR 'BOTH') becomes an equi join after
expanding 'BOTH' over the configured countries; spines are generated per
store from that store's own date range, never by a cross product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import ReconConfig
from ledgerloom.operators.derive import _postable, date_spine, holidays
from ledgerloom.operators.ranges import number_rows


def tender_with_country_wildcard(tender: DataFrame, tender_type: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Tender ⋈ tender type on code AND (country equal OR type country 'BOTH')."""
    countries = F.array(*[F.lit(c) for c in cfg.countries])
    dim = tender_type.select(
        "tender_code", "tender_name", "tender_category", "settlement_lag_days",
        F.explode(F.when(F.col("country_code") == "BOTH", countries)
                  .otherwise(F.array(F.col("country_code")))).alias("country_code"))
    j = tender.join(dim, ["tender_code", "country_code"])
    return j.select("pos_tender_id", "tender_code", "country_code", "tender_name", "tender_category",
                    "settlement_lag_days", "business_date",
                    F.date_add("business_date", F.col("settlement_lag_days")).alias("expected_settle_date"))


def eod_without_ledger(stg_eod: DataFrame, sap_by_store: DataFrame) -> DataFrame:
    """Store-days with sales but no ledger posting (anti join on the
    reconciliation keys)."""
    s = sap_by_store.select("store_id", "country_code", F.col("sap_posting_date").alias("business_date"))
    return stg_eod.join(s, ["store_id", "country_code", "business_date"], "left_anti").select(
        "eod_summary_id", "country_code", "store_id", "business_date", "net_sales", "sap_transfer_status")


def store_date_spine(stg_eod: DataFrame) -> DataFrame:
    """Every day of each store's trading range, with its sales if any."""
    spine = date_spine(stg_eod, ["store_id"])
    e = stg_eod.select("store_id", F.col("business_date").alias("date_key"), "net_sales")
    j = spine.join(e, ["store_id", "date_key"], "left")
    return j.select("store_id", "date_key", F.col("net_sales").isNotNull().alias("has_sales"),
                    F.coalesce(F.col("net_sales"), F.lit(0).cast("decimal(18,2)")).alias("net_sales"))


def holiday_transactions(stg_header: DataFrame) -> DataFrame:
    """Transactions on public holidays, per country and holiday."""
    hol = F.broadcast(holidays(stg_header.sparkSession))
    d = F.col("business_date")
    j = stg_header.join(hol, (F.month(d) == F.col("hol_month")) & (F.dayofmonth(d) == F.col("hol_day")))
    return j.groupBy("country_code", "public_holiday_name").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("net_amount").cast("decimal(18,2)").alias("net_amount"))


def document_sequence(header: DataFrame) -> DataFrame:
    """Ledger document numbers, sequential per company in arrival
    order (day, store, transaction), numbered over sorted ranges so neither a
    company nor one of its days or stores lands in a single task."""
    p = _postable(header).select("pos_txn_id", "sap_company_code", "business_date", "store_id")
    s = number_rows(p, ["sap_company_code"], ["business_date", "store_id", "pos_txn_id"], out_col="doc_seq")
    base = (F.substring("sap_company_code", 2, 10).cast("bigint") + 1) * F.lit(1_000_000_000)
    return s.select("pos_txn_id", "sap_company_code", "business_date", "doc_seq",
                    (base + F.col("doc_seq")).cast("string").alias("doc_number"))
