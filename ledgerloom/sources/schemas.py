"""Declared schemas of the 16 raw tables (S06), their keys and defaults.

NOT NULL and key rules can be enforced on write (:mod:`ledgerloom.sources.load`);
the reference enforces none of the keys, so each is also a check (K10/K11).
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "str": T.StringType(), "date": T.DateType(), "ts": T.TimestampType(),
    "ntz": T.TimestampNTZType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "bool": T.BooleanType(), "double": T.DoubleType(),
    "money": T.DecimalType(18, 2), "rate": T.DecimalType(8, 4), "fx": T.DecimalType(18, 6),
}


def _struct(spec: str) -> T.StructType:
    fields = []
    for item in spec.split(","):
        name, typ = item.split()
        nullable = not typ.endswith("!")
        fields.append(T.StructField(name, _TYPES[typ.rstrip("!")], nullable))
    return T.StructType(fields)


RAW_SCHEMAS: dict[str, T.StructType] = {
    "dim_country": _struct(
        "country_code str!, country_code_iso2 str, country_name str, sap_company_code str, base_currency str,"
        " group_currency str, tax_system str, tax_rate_standard rate, fiscal_year_end_month int, timezone str,"
        " settlement_lag_days int, variance_threshold_t2 money, variance_threshold_t3 money,"
        " variance_threshold_t4 money, regulatory_body str, data_privacy_law str, dominant_ewallet str,"
        " bank_transfer_rail str, is_active bool"),
    "dim_store": _struct(
        "store_id str!, country_code str!, store_name str, mall_name str, city str, state str, store_type str,"
        " sap_profit_center str, sap_cost_center str, bank_account str, bank_code str, mas_merchant_id str,"
        " tax_registration str, store_manager str, open_date date, is_active bool, floor_area_sqft int,"
        " num_terminals int"),
    "dim_tender_type": _struct(
        "tender_code str!, country_code str!, tender_name str, tender_category str, sap_gl_account str,"
        " settlement_lag_days int, is_card bool, is_ewallet bool, interchange_rate_pct rate, is_active bool,"
        " notes str"),
    "dim_bank": _struct(
        "bank_code str!, country_code str!, bank_name str, bank_short_name str, swift_bic str,"
        " bank_account_no str, account_type str, sap_house_bank str, sap_account_id str,"
        " statement_format str, transfer_rail str, settlement_cut_off str, contact_name str, is_active bool"),
    "dim_tax_code": _struct(
        "tax_code_key str!, country_code str!, tax_code str, tax_type str, tax_description str,"
        " tax_rate_pct rate, effective_date date, end_date date, sap_tax_code str, is_exempt bool,"
        " gl_account_tax str, filing_frequency str, tax_authority str"),
    "dim_currency": _struct(
        "currency_code str!, currency_name str, currency_symbol str, decimal_places int, rate_date date!,"
        " rate_to_usd fx, rate_to_sgd fx, rate_source str, is_group_currency bool"),
    "dim_fiscal_calendar": _struct(
        "fiscal_period_key str!, country_code str!, date_key date!, fiscal_year int, fiscal_period int,"
        " fiscal_quarter str, period_start_date date, period_end_date date, is_period_open bool,"
        " is_year_end_period bool, working_day_flag bool, public_holiday_name str"),
    "dim_root_cause": _struct(
        "root_cause_code str!, category str, subcategory str, description str, responsible_team str,"
        " typical_resolution_hrs int, is_systemic bool, occurrence_count bigint"),
    "pos_transaction_header": _struct(
        "pos_txn_id str!, country_code str!, store_id str, terminal_id str, cashier_id str, business_date date,"
        " txn_datetime_utc ts, txn_type str, txn_status str, gross_amount money, discount_amount money,"
        " net_amount money, tax_code str, tax_amount_local money, currency_code str, total_tendered money,"
        " promo_code str, receipt_number str, sap_company_code str, sap_doc_number str, sap_post_status str,"
        " _dq_flag str, _dq_description str"),
    "pos_tender": _struct(
        "pos_tender_id str!, pos_txn_id str!, country_code str!, tender_code str, tender_amount money,"
        " currency_code str, ewallet_provider str, paynow_ref str, duitnow_ref str, nets_ref str,"
        " card_last4 str, card_type str, approval_code str, rrn str, settlement_batch str,"
        " business_date date, _dq_flag str"),
    "pos_eod_summary": _struct(
        "eod_summary_id str!, country_code str!, store_id str, terminal_id str, business_date date,"
        " fiscal_period_key str, currency_code str, net_sales money, tax_collected money,"
        " cash_variance money, paynow_total money, duitnow_total money, nets_total money,"
        " sap_transfer_status str, supervisor_id str, _dq_flag str"),
    "sap_fi_document": _struct(
        "belnr str!, bukrs str!, gjahr int!, country_code str!, blart str, bldat date, budat date, waers str,"
        " xblnr str, usnam str, bstat str, stblg str, tax_country str, pos_txn_id str, _dq_flag str,"
        " _manual_error bool"),
    "sap_fi_lineitem": _struct(
        "belnr str!, bukrs str!, gjahr int!, buzei str!, hkont str, shkzg str, dmbtr money, hwae str,"
        " augbl str, augdt date, mwskz str, kostl str, prctr str, sgtxt str, _dq_flag str"),
    "bank_card_settlement": _struct(
        "settlement_id str!, country_code str!, processor_name str, merchant_id str, merchant_name str,"
        " txn_date date, settle_date date, currency_code str, tender_code str, txn_count bigint,"
        " gross_amount money, refund_amount money, chargeback_amount money, interchange_fee money,"
        " contracted_rate_pct rate, actual_rate_pct rate, net_settlement money, settlement_batch_id str,"
        " bank_account str, bank_code str, sap_clear_status str, sap_clear_doc str, _dq_flag str"),
    "bank_statement_line": _struct(
        "statement_line_id str!, country_code str!, bank_code str, bank_account str, currency_code str,"
        " value_date date, amount money, dc_indicator str, payment_rail str, customer_reference str,"
        " fast_ref str, narrative str, sap_clear_status str, sap_clear_doc str, _dq_flag str, _settle_id str"),
    "recon_match_result": _struct(
        "match_id str!, recon_type str!, country_code str!, recon_date date!, fiscal_period_key str,"
        " store_id str, currency_code str, pos_amount money, sap_amount money, bank_amount money,"
        " variance_pos_sap money, variance_sap_bank money, threshold_applied money, match_type str,"
        " match_status str, root_cause_code str, regulatory_ref str, it_ticket_ref str, preparer_id str,"
        " reviewer_id str, reviewed_at ts, _dq_flag str"),
}

# Declared defaults (fixed values): what a load without the column fills in.
DEFAULTS: dict[str, dict[str, bool]] = {
    "dim_country": {"is_active": True},
    "dim_store": {"is_active": True},
    "dim_tender_type": {"is_card": False, "is_ewallet": False, "is_active": True},
    "dim_bank": {"is_active": True},
    "dim_tax_code": {"is_exempt": False},
    "dim_currency": {"is_group_currency": False},
    "dim_fiscal_calendar": {"is_period_open": True, "is_year_end_period": False, "working_day_flag": True},
    "dim_root_cause": {"is_systemic": False},
    "sap_fi_document": {"_manual_error": False},
}

# Declared keys (primary) and foreign keys, checked by K10 / K11.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_country": ("country_code",),
    "dim_store": ("store_id",),
    "dim_tender_type": ("tender_code", "country_code"),
    "dim_bank": ("bank_code", "country_code"),
    "dim_tax_code": ("tax_code_key",),
    "dim_currency": ("currency_code", "rate_date"),
    "dim_fiscal_calendar": ("fiscal_period_key", "date_key"),
    "dim_root_cause": ("root_cause_code",),
    "pos_transaction_header": ("pos_txn_id",),
    "pos_tender": ("pos_tender_id",),
    "pos_eod_summary": ("eod_summary_id",),
    "sap_fi_document": ("belnr", "bukrs", "gjahr"),
    "sap_fi_lineitem": ("belnr", "bukrs", "gjahr", "buzei"),
    "bank_card_settlement": ("settlement_id",),
    "bank_statement_line": ("statement_line_id",),
    "recon_match_result": ("match_id",),
}

FOREIGN_KEYS: list[tuple[str, tuple[str, ...], str, tuple[str, ...]]] = [
    ("dim_store", ("country_code",), "dim_country", ("country_code",)),
    ("pos_tender", ("pos_txn_id",), "pos_transaction_header", ("pos_txn_id",)),
    ("sap_fi_lineitem", ("belnr", "bukrs", "gjahr"), "sap_fi_document", ("belnr", "bukrs", "gjahr")),
    ("recon_match_result", ("country_code",), "dim_country", ("country_code",)),
    ("recon_match_result", ("store_id",), "dim_store", ("store_id",)),
    ("recon_match_result", ("root_cause_code",), "dim_root_cause", ("root_cause_code",)),
]

# Load order: dimensions, facts, derived.
LOAD_ORDER = [
    "dim_country", "dim_store", "dim_tender_type", "dim_bank", "dim_tax_code", "dim_currency",
    "dim_fiscal_calendar", "dim_root_cause",
    "pos_transaction_header", "pos_tender", "pos_eod_summary", "sap_fi_document", "sap_fi_lineitem",
    "bank_card_settlement", "bank_statement_line",
    "recon_match_result",
]
