"""The model DAG: 23 models as lazily built DataFrames over :class:`RawTables`.

``ref(model)`` of the reference becomes attribute access here; each model
is built once per :class:`Models` instance, so a model read by several
downstream models is one sub-plan (written as a table by the full build when
it is evaluated more than once).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from ledgerloom.config import ReconConfig
from ledgerloom.operators import dims, marts, match, staging
from ledgerloom.sources.raw import RawTables

MODEL_NAMES = [
    "stg_pos_transaction_header", "stg_pos_tender", "stg_pos_eod_summary", "stg_sap_fi_document",
    "stg_sap_fi_lineitem", "stg_bank_card_settlement", "stg_bank_statement_line", "stg_dim_country",
    "stg_dim_store", "stg_dim_root_cause", "stg_dim_tender_type",
    "int_sap_sales_by_store_date", "int_pos_sap_matched", "int_pay_bank_matched",
    "mart_recon_summary", "mart_pos_sap_detail", "mart_pay_bank_detail", "mart_exception_log",
    "mart_root_cause_trend",
    "dim_store_enriched", "dim_country_enriched", "dim_root_cause_enriched", "dim_tender_type_enriched",
]


class Models:
    def __init__(self, raw: RawTables, cfg: ReconConfig | None = None):
        self.raw = raw
        self.cfg = cfg or raw.cfg

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    # staging
    @cached_property
    def stg_pos_transaction_header(self):
        return staging.stg_pos_transaction_header(self.raw.pos_transaction_header, self.cfg)

    @cached_property
    def stg_pos_tender(self):
        return staging.stg_pos_tender(self.raw.pos_tender, self.stg_pos_transaction_header, self.cfg)

    @cached_property
    def stg_pos_eod_summary(self):
        return staging.stg_pos_eod_summary(self.raw.pos_eod_summary, self.cfg)

    @cached_property
    def stg_sap_fi_document(self):
        return staging.stg_sap_fi_document(self.raw.sap_fi_document, self.cfg)

    @cached_property
    def stg_sap_fi_lineitem(self):
        return staging.stg_sap_fi_lineitem(self.raw.sap_fi_lineitem)

    @cached_property
    def stg_bank_card_settlement(self):
        return staging.stg_bank_card_settlement(self.raw.bank_card_settlement, self.cfg)

    @cached_property
    def stg_bank_statement_line(self):
        return staging.stg_bank_statement_line(self.raw.bank_statement_line, self.cfg)

    @cached_property
    def stg_dim_country(self):
        return staging.stg_dim_country(self.raw.dim_country)

    @cached_property
    def stg_dim_store(self):
        return staging.stg_dim_store(self.raw.dim_store)

    @cached_property
    def stg_dim_root_cause(self):
        return staging.stg_dim_root_cause(self.raw.dim_root_cause)

    @cached_property
    def stg_dim_tender_type(self):
        return staging.stg_dim_tender_type(self.raw.dim_tender_type)

    # intermediate
    @cached_property
    def int_sap_sales_by_store_date(self):
        return match.int_sap_sales_by_store_date(
            self.stg_sap_fi_lineitem, self.stg_sap_fi_document, self.stg_pos_transaction_header,
            self.stg_dim_store, self.cfg)

    @cached_property
    def int_pos_sap_matched(self):
        return match.int_pos_sap_matched(self.stg_pos_eod_summary, self.int_sap_sales_by_store_date,
                                         self.stg_dim_country, self.cfg)

    @cached_property
    def int_pay_bank_matched(self):
        return match.int_pay_bank_matched(self.stg_bank_card_settlement, self.stg_bank_statement_line,
                                          self.stg_dim_country, self.cfg, self.stg_dim_tender_type)

    # marts
    @cached_property
    def mart_recon_summary(self):
        return marts.mart_recon_summary(self.int_pos_sap_matched, self.int_pay_bank_matched,
                                        self.stg_dim_store, self.cfg)

    @cached_property
    def mart_pos_sap_detail(self):
        return marts.mart_pos_sap_detail(self.int_pos_sap_matched, self.stg_dim_store, self.stg_dim_country,
                                         self.stg_dim_root_cause, self.cfg)

    @cached_property
    def mart_pay_bank_detail(self):
        return marts.mart_pay_bank_detail(self.int_pay_bank_matched, self.stg_dim_country,
                                          self.stg_dim_root_cause, self.cfg)

    @cached_property
    def mart_exception_log(self):
        return marts.mart_exception_log(self.int_pos_sap_matched, self.int_pay_bank_matched,
                                        self.stg_dim_store, self.stg_dim_root_cause,
                                        self.raw.recon_match_result, self.cfg)

    @cached_property
    def mart_root_cause_trend(self):
        return marts.mart_root_cause_trend(self.int_pos_sap_matched, self.int_pay_bank_matched,
                                           self.stg_dim_root_cause, self.cfg)

    # dimensions
    @cached_property
    def dim_store_enriched(self):
        return dims.dim_store_enriched(self.stg_dim_store, self.mart_recon_summary, self.cfg)

    @cached_property
    def dim_country_enriched(self):
        return dims.dim_country_enriched(self.stg_dim_country, self.mart_recon_summary, self.cfg)

    @cached_property
    def dim_root_cause_enriched(self):
        return dims.dim_root_cause_enriched(self.stg_dim_root_cause, self.mart_root_cause_trend, self.cfg)

    @cached_property
    def dim_tender_type_enriched(self):
        return dims.dim_tender_type_enriched(self.stg_dim_tender_type)
