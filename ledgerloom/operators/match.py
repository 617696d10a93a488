"""Intermediate models M12–M14: the two reconciliations.

Plan shape (checked with ``explain``):

* M12 collapses ledger lines to one row per document *before* any join
  (partial + final hash aggregate), so the document and transaction joins
  see ~1/3 of the rows. Documents without a transaction can never reach a
  store and are dropped before the shuffle, which also keeps NULL keys
  (manual postings) from piling into one reducer.
* M13/M14 join two store-day (or batch) grained inputs on their full keys;
  the country configuration is joined on its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import ReconConfig
from ledgerloom.functions.exprs import MONEY, first_match, flag01, typed_null, yyyymmdd
from ledgerloom.operators.joins import left_join_split


def int_sap_sales_by_store_date(stg_lines: DataFrame, stg_docs: DataFrame, stg_header: DataFrame,
                                stg_store: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Ledger revenue, document count and issue flag per store and
    posting date (line ⋈ document ⟕ transaction ⟕ store, store not NULL)."""
    doc_key = ["belnr", "bukrs", "gjahr"]
    per_doc = stg_lines.groupBy(*doc_key).agg(
        F.sum(F.when(F.col("hkont").like("004%"), F.col("signed_amount")).otherwise(F.lit(0)))
         .alias("doc_revenue"),
        F.max(flag01(F.col("_dq_flag") != "CLEAN")).alias("doc_issue"),
    )
    docs = stg_docs.filter(F.col("pos_txn_id").isNotNull()).select(
        *doc_key, "country_code", "posting_date", "pos_txn_id")
    # LEFT JOIN transaction + WHERE store_id IS NOT NULL == inner join to
    # transactions that have a store.
    bridge = stg_header.filter(F.col("store_id").isNotNull()).select("pos_txn_id", "store_id")
    store = stg_store.select("store_id", "sap_profit_center")
    j = (per_doc.join(docs, doc_key)
               .join(bridge, "pos_txn_id")
               .join(store, "store_id", "left"))
    return j.groupBy("country_code", "store_id", "sap_profit_center", "posting_date").agg(
        F.sum("doc_revenue").cast(MONEY).alias("sap_posted_revenue"),
        F.countDistinct("belnr").alias("sap_document_count"),
        F.max("doc_issue").alias("has_dq_issue"),
    ).select(
        "country_code", "store_id",
        F.col("sap_profit_center").alias("sap_profit_centre"),
        F.col("posting_date").alias("sap_posting_date"),
        "sap_posted_revenue", "sap_document_count", "has_dq_issue",
    )


def pos_sap_match_id(country, date, store) -> F.Column:
    """MATCH-POS-SAP-{country}-{yyyymmdd}-{store without dashes}; NULL if any part is."""
    return F.concat(F.lit("MATCH-POS-SAP-"), F.col(country), F.lit("-"), yyyymmdd(date), F.lit("-"),
                    F.replace(F.col(store), F.lit("-"), F.lit("")))


def int_pos_sap_matched(stg_eod: DataFrame, sap_by_store: DataFrame, stg_country: DataFrame,
                        cfg: ReconConfig) -> DataFrame:
    """End-of-day sales vs ledger revenue, classified by the country's
    thresholds (first matching tier wins, Q6/Q7)."""
    cfgc = stg_country.select(
        "country_code", "country_code_iso2",
        F.col("variance_threshold_t2").alias("threshold_tolerance"),
        F.col("variance_threshold_t3").alias("threshold_review"),
        F.col("variance_threshold_t4").alias("threshold_escalate"))
    p = stg_eod.select("country_code", "store_id", "business_date", "fiscal_period_key", "currency_code",
                       "net_sales", "sap_transfer_status", "_dq_flag")
    s = sap_by_store.select(
        "country_code", "store_id", F.col("sap_posting_date").alias("business_date"),
        "sap_posted_revenue", "sap_document_count", "sap_profit_centre", "has_dq_issue")
    j = (p.join(s, ["store_id", "country_code", "business_date"], "left")
          .join(cfgc, "country_code"))
    sap_amount = F.coalesce(F.col("sap_posted_revenue"), F.lit(0)).cast(MONEY)
    j = (j.withColumn("sap_amount", sap_amount)
          .withColumn("variance_pos_sap", (F.col("net_sales") - sap_amount).cast(MONEY)))
    av = F.abs(F.col("variance_pos_sap"))
    no_docs = F.col("sap_document_count").isNull() | (F.col("sap_document_count") == 0)
    match_type = first_match([
        (av == 0, "EXACT"),
        (av <= F.col("threshold_tolerance"), "TOLERANCE"),
        (no_docs, "UNMATCHED"),
        (av <= F.col("threshold_review"), "REVIEW"),
        (av > F.col("threshold_review"), "ESCALATE"),
    ], "UNMATCHED")
    match_status = F.when(av <= F.col("threshold_tolerance"), F.lit("MATCHED")).otherwise(F.lit("EXCEPTION"))
    cause = first_match([
        (no_docs, F.lit("RC-001")),
        ((av > 0) & (av <= F.col("threshold_tolerance")), F.lit("RC-007")),
    ], typed_null("string"))
    if cfg.fix_match_id:   # Q1: the reference result's id format
        match_id = F.concat(F.lit("MATCH-POS-SAP-"), F.col("country_code_iso2"), F.lit("-"),
                            yyyymmdd("business_date"), F.lit("-"), F.substring("store_id", -3, 3))
    else:
        match_id = pos_sap_match_id("country_code", "business_date", "store_id")
    return j.select(
        match_id.alias("match_id"),
        F.lit("POS_SAP").alias("recon_type"),
        "country_code",
        F.col("business_date").alias("recon_date"),
        "fiscal_period_key", "store_id", "currency_code",
        F.col("net_sales").alias("pos_amount"),
        "sap_amount", "variance_pos_sap",
        F.col("threshold_tolerance").alias("threshold_applied"),
        match_type.alias("match_type"),
        match_status.alias("match_status"),
        cause.alias("root_cause_code"),
        "sap_document_count", "sap_profit_centre",
        F.col("_dq_flag").alias("_dq_flag"),
    )


def int_pay_bank_matched(stg_settlement: DataFrame, stg_bank: DataFrame, stg_country: DataFrame,
                         cfg: ReconConfig, stg_tender: DataFrame | None = None) -> DataFrame:
    """Settlement vs bank credit on (country, account, batch reference).

    A settlement with several credits fans out (J07), as in the model,
    unless ``cfg.dedupe_bank_lines`` keeps the earliest credit per reference.
    """
    cfgc = stg_country.select("country_code", "settlement_lag_days",
                                                F.col("variance_threshold_t2").alias("__t2"))
    tol = F.col("__t2") if cfg.tolerance_from_country else F.lit(cfg.pay_bank_tolerance).cast(MONEY)
    if cfg.dedupe_bank_lines:
        # earliest credit per reference as a min over (date, id, amount): a
        # partial aggregate, so one hot reference is combined map-side
        # instead of sorted whole in one window task
        keys = ["country_code", "bank_account", "customer_reference"]
        stg_bank = (stg_bank.groupBy(*keys)
                    .agg(F.min(F.struct("value_date", "statement_line_id", "amount")).alias("__w"))
                    .select(*keys, "__w.value_date", "__w.statement_line_id", "__w.amount"))
    b = stg_bank.select(
        "country_code", "bank_account", F.col("customer_reference").alias("settlement_batch_id"), "statement_line_id",
        F.col("value_date").alias("bank_credit_date"), F.col("amount").alias("actual_bank_credit"))
    # a reference may hold many credits (J07): exact, and split where it is hot
    j = left_join_split(stg_settlement, b, ["country_code", "bank_account", "settlement_batch_id"])
    j = j.join(cfgc, "country_code")
    expected_lag = F.col("settlement_lag_days")
    if cfg.lag_from_tender and stg_tender is not None:
        # Q10: the tender's own lag; 'BOTH' tenders apply to every country
        countries = F.array(*[F.lit(c) for c in cfg.countries])
        tl = stg_tender.select(
            "tender_code", F.col("settlement_lag_days").alias("__tender_lag"),
            F.explode(F.when(F.col("country_code") == "BOTH", countries)
                      .otherwise(F.array(F.col("country_code")))).alias("country_code"))
        j = j.join(tl, ["tender_code", "country_code"], "left")
        expected_lag = F.coalesce(F.col("__tender_lag"), F.col("settlement_lag_days"))
    variance = (F.col("net_settlement") - F.coalesce(F.col("actual_bank_credit"), F.lit(0))).cast(MONEY)
    lag = F.datediff(F.coalesce(F.col("bank_credit_date"), F.lit(cfg.as_of_str).cast("date")), F.col("txn_date"))
    j = j.withColumn("variance_sap_bank", variance)
    av = F.abs(F.col("variance_sap_bank"))
    found = F.col("statement_line_id").isNotNull()
    fee_diff = F.abs(F.col("fee_variance_amount")) > 0
    match_type = first_match([
        ((av == 0) & found, "EXACT"),
        ((av <= tol) & found, "TOLERANCE"),
        (found & fee_diff, "FEE_VARIANCE"),
        (~found, "UNMATCHED"),
    ], "REVIEW")
    match_status = F.when(found & (av <= tol), F.lit("MATCHED")).otherwise(F.lit("EXCEPTION"))
    cause = first_match([(~found, F.lit("RC-014")), (fee_diff, F.lit("RC-010"))], typed_null("string"))
    match_id = F.concat(F.lit("MATCH-PAY-BANK-"), F.col("country_code"), F.lit("-"), yyyymmdd("txn_date"),
                        F.lit("-"), F.col("settlement_id"))
    return j.select(
        match_id.alias("match_id"),
        F.lit("PAY_BANK").alias("recon_type"),
        "country_code",
        F.col("txn_date").alias("recon_date"),
        typed_null("string").alias("fiscal_period_key"),
        (F.nullif(F.regexp_extract("settlement_batch_id", cfg.payment_store_pattern, 1), F.lit(""))
         if cfg.payment_store_from_batch else typed_null("string")).alias("store_id"),
        "currency_code",
        F.col("net_settlement").alias("pos_amount"),
        typed_null(MONEY).alias("sap_amount"),
        F.coalesce(F.col("actual_bank_credit"), F.lit(0)).cast(MONEY).alias("bank_amount"),
        F.lit(0).cast(MONEY).alias("variance_pos_sap"),
        "variance_sap_bank",
        tol.cast(MONEY).alias("threshold_applied"),
        match_type.alias("match_type"),
        match_status.alias("match_status"),
        cause.alias("root_cause_code"),
        "tender_code", "processor_name", "gross_amount", "interchange_fee", "fee_variance_amount",
        lag.cast("int").alias("settlement_lag_days_actual"),
        expected_lag.cast("int").alias("settlement_lag_days_expected"),
        "_dq_flag",
    )
