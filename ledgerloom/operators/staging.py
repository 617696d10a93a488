"""Staging models M01–M11: type, clean and filter one raw table each.

Filters run on the raw country code before UPPER (Q14), so lower-case codes
are dropped, not normalised. Every filter is a plain predicate on a column
the scan produces, so Catalyst pushes it to the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import ReconConfig
from ledgerloom.functions.exprs import MONEY, round_money


def _countries(cfg: ReconConfig):
    return F.col("country_code").isin(list(cfg.countries))


def _upper_country(cfg: ReconConfig):
    """UPPER(country_code) after the raw-code filter. When every configured
    code is upper-case, the filter leaves only upper-case codes, so UPPER is
    the identity and the column passes through unchanged (which keeps a
    bucketed layout on it usable by later joins)."""
    if all(c == c.upper() for c in cfg.countries):
        return F.col("country_code").alias("country_code")
    return F.upper("country_code").alias("country_code")


def stg_pos_transaction_header(raw: DataFrame, cfg: ReconConfig) -> DataFrame:
    """23 columns, UPPER codes, DATE/timestamp casts, money rounded."""
    return raw.filter(_countries(cfg) & (F.col("txn_status") == "COMPLETED")).select(
        "pos_txn_id",
        _upper_country(cfg),
        "store_id", "terminal_id", "cashier_id",
        F.col("business_date").cast("date").alias("business_date"),
        F.col("txn_datetime_utc").cast("timestamp").alias("txn_datetime_utc"),
        "txn_type", "txn_status",
        round_money("gross_amount").alias("gross_amount"),
        round_money("discount_amount").alias("discount_amount"),
        round_money("net_amount").alias("net_amount"),
        "tax_code",
        round_money("tax_amount_local").alias("tax_amount_local"),
        F.upper("currency_code").alias("currency_code"),
        round_money("total_tendered").alias("total_tendered"),
        "promo_code", "receipt_number", "sap_company_code", "sap_doc_number", "sap_post_status",
        "_dq_flag", "_dq_description",
    )


def stg_pos_tender(raw: DataFrame, stg_header: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Tenders whose parent transaction survived staging.

    The model inner-joins to the parent keys; a semi join gives the same rows
    for unique parent keys and cannot fan out if a key repeats.
    """
    t = raw.filter(_countries(cfg) & (F.col("tender_amount") >= 0))
    t = t.join(stg_header.select("pos_txn_id"), "pos_txn_id", "left_semi")
    return t.select(
        "pos_tender_id", "pos_txn_id",
        _upper_country(cfg),
        F.upper("tender_code").alias("tender_code"),
        round_money("tender_amount").alias("tender_amount"),
        F.upper("currency_code").alias("currency_code"),
        "ewallet_provider", "paynow_ref", "duitnow_ref", "nets_ref", "card_last4", "card_type",
        "approval_code", "rrn", "settlement_batch",
        F.col("business_date").cast("date").alias("business_date"),
        "_dq_flag",
    )


def stg_pos_eod_summary(raw: DataFrame, cfg: ReconConfig) -> DataFrame:
    """The POS side of the sales reconciliation."""
    return raw.filter(F.col("business_date").isNotNull() & F.col("store_id").isNotNull()
                      & _countries(cfg)).select(
        "eod_summary_id",
        _upper_country(cfg),
        "store_id", "terminal_id",
        F.col("business_date").cast("date").alias("business_date"),
        "fiscal_period_key",
        F.upper("currency_code").alias("currency_code"),
        *[round_money(c).alias(c) for c in ("net_sales", "tax_collected", "cash_variance",
                                             "paynow_total", "duitnow_total", "nets_total")],
        "sap_transfer_status", "supervisor_id", "_dq_flag",
    )


def stg_sap_fi_document(raw: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Active ledger documents (bstat blank or NULL), renamed."""
    active = (F.col("bstat") == " ") | F.col("bstat").isNull()
    return raw.filter(_countries(cfg) & active).select(
        "belnr", "bukrs", "gjahr",
        _upper_country(cfg),
        "blart",
        F.col("bldat").cast("date").alias("document_date"),
        F.col("budat").cast("date").alias("posting_date"),
        F.col("waers").alias("currency_code"),
        "xblnr", "usnam", "bstat", "stblg", "tax_country", "pos_txn_id", "_dq_flag",
    )


def signed_amount(shkzg="shkzg", dmbtr="dmbtr"):
    """H → +amount, S → −amount, anything else → 0."""
    amt = round_money(dmbtr)
    return (F.when(F.col(shkzg) == "H", amt).when(F.col(shkzg) == "S", -amt)
             .otherwise(F.lit(0)).cast(MONEY))


def stg_sap_fi_lineitem(raw: DataFrame) -> DataFrame:
    """Signed amount and renames; no filter."""
    return raw.select(
        "belnr", "bukrs", "gjahr", "buzei", "hkont", "shkzg",
        signed_amount().alias("signed_amount"),
        round_money("dmbtr").alias("dmbtr"),
        F.col("hwae").alias("currency_code"),
        "augbl",
        F.col("augdt").cast("date").alias("clearing_date"),
        F.col("mwskz").alias("tax_code"),
        F.col("kostl").alias("cost_centre"),
        F.col("prctr").alias("profit_centre"),
        F.col("sgtxt").alias("line_text"),
        "_dq_flag",
    )


def stg_bank_card_settlement(raw: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Surrogate key id|country (raw code) and the fee variance,
    computed on the unrounded gross."""
    fee_var = F.round((F.col("actual_rate_pct") - F.col("contracted_rate_pct")) / F.lit(100)
                      * F.col("gross_amount"), 2).cast(MONEY)
    return raw.filter(_countries(cfg)).select(
        F.concat(F.col("settlement_id"), F.lit("|"), F.col("country_code")).alias("settlement_surrogate_key"),
        "settlement_id",
        _upper_country(cfg),
        "processor_name", "merchant_id", "merchant_name",
        F.col("txn_date").cast("date").alias("txn_date"),
        F.col("settle_date").cast("date").alias("settle_date"),
        F.upper("currency_code").alias("currency_code"),
        F.upper("tender_code").alias("tender_code"),
        "txn_count",
        round_money("gross_amount").alias("gross_amount"),
        round_money("refund_amount").alias("refund_amount"),
        round_money("chargeback_amount").alias("chargeback_amount"),
        round_money("interchange_fee").alias("interchange_fee"),
        "contracted_rate_pct", "actual_rate_pct",
        round_money("net_settlement").alias("net_settlement"),
        "settlement_batch_id", "bank_account", "bank_code", "sap_clear_status", "sap_clear_doc",
        fee_var.alias("fee_variance_amount"),
        "_dq_flag",
    )


def stg_bank_statement_line(raw: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Credits only."""
    return raw.filter(_countries(cfg) & (F.col("dc_indicator") == "C")).select(
        "statement_line_id",
        _upper_country(cfg),
        "bank_code", "bank_account",
        F.upper("currency_code").alias("currency_code"),
        F.col("value_date").cast("date").alias("value_date"),
        round_money("amount").alias("amount"),
        "dc_indicator", "payment_rail", "customer_reference", "fast_ref", "narrative",
        "sap_clear_status", "sap_clear_doc", "_dq_flag", "_settle_id",
    )


def stg_dim_country(raw: DataFrame) -> DataFrame:
    """16 of 19 columns, active countries."""
    return raw.filter(F.col("is_active")).select(
        "country_code", "country_code_iso2", "country_name", "sap_company_code", "base_currency",
        "tax_system", "tax_rate_standard", "fiscal_year_end_month", "timezone", "settlement_lag_days",
        "variance_threshold_t2", "variance_threshold_t3", "variance_threshold_t4",
        "regulatory_body", "bank_transfer_rail", "is_active",
    )


def stg_dim_store(raw: DataFrame) -> DataFrame:
    """17 of 18 columns (merchant id dropped), active stores."""
    return raw.filter(F.col("is_active")).select(
        "store_id", "country_code", "store_name", "mall_name", "city", "state", "store_type",
        "sap_profit_center", "sap_cost_center", "bank_account", "bank_code", "tax_registration",
        "store_manager", F.col("open_date").cast("date").alias("open_date"), "is_active",
        "floor_area_sqft", "num_terminals",
    )


def stg_dim_root_cause(raw: DataFrame) -> DataFrame:
    """7 of 8 columns, no filter."""
    return raw.select("root_cause_code", "category", "subcategory", "description",
                      "responsible_team", "typical_resolution_hrs", "is_systemic")


def stg_dim_tender_type(raw: DataFrame) -> DataFrame:
    """Typed casts, active tenders (rate as float, like the model)."""
    return raw.filter(F.col("is_active")).select(
        "tender_code", "country_code", "tender_name", "tender_category", "sap_gl_account",
        F.col("settlement_lag_days").cast("int").alias("settlement_lag_days"),
        F.col("is_card").cast("boolean").alias("is_card"),
        F.col("is_ewallet").cast("boolean").alias("is_ewallet"),
        F.col("interchange_rate_pct").cast("double").alias("interchange_rate_pct"),
        "is_active", "notes",
    )
