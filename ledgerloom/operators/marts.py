"""Mart models M15–M19: reporting shapes over the two reconciliations.

Unions pad with typed values (money as decimal(18,2), never decimal(38,0)),
branches are filtered before the union, and every dimension join is a
join with a small dimension, so a mart adds no shuffle of the facts except its
own aggregate or sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.config import ReconConfig
from ledgerloom.functions.exprs import (
    MONEY, count_when, first_match, flag01, greatest_strict, mon_yy, pct_ratio, typed_null, yyyy_mm,
)
from ledgerloom.operators.joins import left_join_split

SUMMARY_COLS = ["match_id", "recon_type", "country_code", "recon_date", "fiscal_period_key", "store_id",
                "currency_code", "pos_amount", "sap_amount", "bank_amount", "variance_pos_sap",
                "variance_sap_bank", "match_type", "match_status", "root_cause_code", "_dq_flag"]


def _dim(df: DataFrame, cfg: ReconConfig) -> DataFrame:
    return df


def mart_recon_summary(pos_sap: DataFrame, pay_bank: DataFrame, stg_store: DataFrame,
                       cfg: ReconConfig) -> DataFrame:
    """Both reconciliations in one table (U01), with store attributes."""
    a = pos_sap.select(
        "match_id", "recon_type", "country_code", "recon_date", "fiscal_period_key", "store_id",
        "currency_code", "pos_amount", "sap_amount",
        F.lit(0).cast(MONEY).alias("bank_amount"),
        "variance_pos_sap",
        F.lit(0).cast(MONEY).alias("variance_sap_bank"),
        "match_type", "match_status", "root_cause_code", "_dq_flag")
    b = pay_bank.select(
        "match_id", "recon_type", "country_code", "recon_date",
        typed_null("string").alias("fiscal_period_key"),
        "store_id", "currency_code", "pos_amount", "sap_amount", "bank_amount", "variance_pos_sap",
        "variance_sap_bank", "match_type", "match_status", "root_cause_code", "_dq_flag")
    combined = a.unionByName(b)
    store = _dim(stg_store.select("store_id", "store_name", "store_type", "city"), cfg)
    j = combined.join(store, "store_id", "left")
    return j.select(
        "match_id", "recon_type", "country_code", "recon_date", "fiscal_period_key", "store_id",
        "store_name", "store_type", "city", "currency_code", "pos_amount", "sap_amount", "bank_amount",
        "variance_pos_sap", "variance_sap_bank", "match_type", "match_status", "root_cause_code", "_dq_flag",
        flag01(F.col("match_status") == "MATCHED").alias("is_matched"),
        flag01(F.col("match_status") == "EXCEPTION").alias("is_exception"),
    )


def variance_pct(variance, base, digits: int = 4) -> F.Column:
    """ROUND(v / base * 100, 4), 0 when base is 0 or NULL (ratio in double,
    rounded through decimal(18,6))."""
    ratio = F.col(variance).cast("double") / F.col(base).cast("double") * F.lit(100.0)
    rounded = F.round(ratio.cast("decimal(18,6)"), digits).cast("decimal(18,4)")
    return F.when(F.col(base) != 0, rounded).otherwise(F.lit(0).cast("decimal(18,4)"))


def mart_pos_sap_detail(pos_sap: DataFrame, stg_store: DataFrame, stg_country: DataFrame,
                        stg_root_cause: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Sales reconciliation with store, country and cause details."""
    store = _dim(stg_store.select("store_id", "store_name", "store_type", "city", "sap_profit_center"), cfg)
    country = _dim(stg_country.select("country_code", "regulatory_body", "bank_transfer_rail"), cfg)
    rc = _dim(stg_root_cause.select("root_cause_code", F.col("description").alias("root_cause_description"),
                                    "responsible_team", "typical_resolution_hrs", "is_systemic"), cfg)
    j = (pos_sap.join(store, "store_id", "left").join(country, "country_code", "left")
                .join(rc, "root_cause_code", "left"))
    return j.select(
        "match_id", "recon_type", "country_code", "recon_date", "fiscal_period_key",
        "store_id", "store_name", "store_type", "city", "sap_profit_center",
        "currency_code", "pos_amount", "sap_amount", "variance_pos_sap",
        variance_pct("variance_pos_sap", "pos_amount").alias("variance_pct"),
        F.abs("variance_pos_sap").cast(MONEY).alias("abs_variance"),
        "threshold_applied", "match_type", "match_status",
        "root_cause_code", "root_cause_description", "responsible_team", "typical_resolution_hrs", "is_systemic",
        "regulatory_body", "bank_transfer_rail", "sap_document_count", "_dq_flag",
    )


def mart_pay_bank_detail(pay_bank: DataFrame, stg_country: DataFrame, stg_root_cause: DataFrame,
                         cfg: ReconConfig) -> DataFrame:
    """Payment reconciliation with timing status and ageing bucket."""
    country = _dim(stg_country.select("country_code", "regulatory_body"), cfg)
    rc = _dim(stg_root_cause.select("root_cause_code", F.col("description").alias("root_cause_description"),
                                    "responsible_team"), cfg)
    j = pay_bank.join(country, "country_code", "left").join(rc, "root_cause_code", "left")
    act, exp = F.col("settlement_lag_days_actual"), F.col("settlement_lag_days_expected")
    bucket = first_match([(act <= exp, "Current"), (act <= exp + 1, "T+1 Overdue"),
                          (act <= exp + 2, "T+2 Overdue")], ">T+2 Overdue")
    return j.select(
        "match_id", "recon_type", "country_code", "recon_date", "currency_code",
        "tender_code", "processor_name", "gross_amount", "interchange_fee", "fee_variance_amount",
        F.col("pos_amount").alias("expected_bank_credit"),
        F.col("bank_amount").alias("actual_bank_credit"),
        "variance_sap_bank", "settlement_lag_days_actual", "settlement_lag_days_expected",
        F.when(act > exp, F.lit("OVERDUE")).otherwise(F.lit("ON TIME")).alias("settlement_timing_status"),
        greatest_strict(act - exp, F.lit(0)).cast("int").alias("days_overdue"),
        "match_type", "match_status", "root_cause_code", "root_cause_description", "responsible_team",
        bucket.alias("aging_bucket"),
        "regulatory_body", "_dq_flag",
    )


def mart_exception_log(pos_sap: DataFrame, pay_bank: DataFrame, stg_store: DataFrame,
                       stg_root_cause: DataFrame, raw_recon: DataFrame, cfg: ReconConfig,
                       ordered: bool = True) -> DataFrame:
    """Open exceptions of both types with age, SLA, severity and the
    maker-checker evidence of the reference result (U02, J11, O01)."""
    a = pos_sap.filter(F.col("match_status") == "EXCEPTION").select(
        "match_id", F.lit("POS_SAP").alias("recon_type"), "country_code", "recon_date", "store_id",
        "currency_code", "pos_amount", "sap_amount", F.lit(None).cast(MONEY).alias("bank_amount"),
        F.col("variance_pos_sap").alias("primary_variance"),
        "match_type", "match_status", "root_cause_code", "_dq_flag")
    b = pay_bank.filter(F.col("match_status") == "EXCEPTION").select(
        "match_id", F.lit("PAY_BANK").alias("recon_type"), "country_code", "recon_date",
        "store_id", "currency_code", "pos_amount",  # null unless the option recovers it from the batch
        F.lit(None).cast(MONEY).alias("sap_amount"), "bank_amount",
        F.col("variance_sap_bank").alias("primary_variance"),
        "match_type", "match_status", "root_cause_code", "_dq_flag")
    e = a.unionByName(b)
    store = _dim(stg_store.select("store_id", "store_name", "city"), cfg)
    rc = _dim(stg_root_cause.select("root_cause_code", F.col("description").alias("root_cause_description"),
                                    "responsible_team", "typical_resolution_hrs"), cfg)
    rr = raw_recon.select("match_id", "preparer_id", "reviewer_id", "reviewed_at", "it_ticket_ref")
    # The reference result repeats ids (Q4): both sides of a hot id can be split.
    j = left_join_split(e.join(store, "store_id", "left").join(rc, "root_cause_code", "left"),
                                  rr, ["match_id"])
    age = F.datediff(F.lit(cfg.as_of_str).cast("date"), F.col("recon_date"))
    j = j.withColumn("exception_age_days", age.cast("int"))  # computed once, read by 3 CASEs
    a_ = F.col("exception_age_days")
    out = j.select(
        "match_id", "recon_type", "country_code", "recon_date", "exception_age_days",
        F.when(a_ > 1, F.lit("SLA BREACHED")).otherwise(F.lit("Within SLA")).alias("sla_status"),
        first_match([(a_ >= 5, "CRITICAL"), (a_ >= 3, "HIGH"), (a_ >= 1, "MEDIUM")], "NEW").alias("severity"),
        "store_id", "store_name", "city", "currency_code", "pos_amount", "sap_amount", "bank_amount",
        "primary_variance", F.abs("primary_variance").cast(MONEY).alias("abs_variance"),
        "match_type", "match_status", "root_cause_code", "root_cause_description", "responsible_team",
        "typical_resolution_hrs", "preparer_id", "reviewer_id", "reviewed_at", "it_ticket_ref",
        F.when(F.col("reviewer_id").isNotNull(), F.lit("REVIEWED")).otherwise(F.lit("PENDING REVIEW"))
         .alias("review_status"),
        "_dq_flag",
    )
    if ordered:
        out = out.orderBy(F.col("recon_date").desc(), F.col("abs_variance").desc())
    return out


def trend_rows(pos_sap: DataFrame, pay_bank: DataFrame) -> DataFrame:
    """Both reconciliations with absolute variance per branch."""
    a = pos_sap.select("match_id", "country_code", "recon_date", "fiscal_period_key", "store_id",
                       "match_status", "root_cause_code",
                       F.abs("variance_pos_sap").cast(MONEY).alias("abs_variance"), "recon_type")
    b = pay_bank.select("match_id", "country_code", "recon_date", typed_null("string").alias("fiscal_period_key"),
                        "store_id", "match_status", "root_cause_code",
                        F.abs("variance_sap_bank").cast(MONEY).alias("abs_variance"), "recon_type")
    return a.unionByName(b)


def avg_money6(c) -> F.Column:
    """AVG of a money column as decimal(18,6) (exact decimal average)."""
    return F.avg(F.col(c)).cast("decimal(18,6)")


def mart_root_cause_trend(pos_sap: DataFrame, pay_bank: DataFrame, stg_root_cause: DataFrame,
                          cfg: ReconConfig, ordered: bool = True) -> DataFrame:
    """Counts, amounts and Pareto shares per country, type, month and cause.

    The Pareto windows partition by (country, type) over the *aggregated*
    rows (months x causes), never over the facts. The running share needs a
    total order: ties on the count are broken by period and cause (Q24).
    """
    r = trend_rows(pos_sap, pay_bank)
    d = F.col("recon_date")
    p = r.select(
        "country_code", "recon_type", "store_id",
        F.coalesce(F.col("fiscal_period_key"),
                   F.concat(F.col("country_code"), F.lit("-"), yyyy_mm(F.trunc(d, "month")))).alias("period_key"),
        F.year(d).alias("recon_year"), F.month(d).alias("recon_month"), mon_yy(d).alias("month_label"),
        "match_status",
        F.coalesce(F.col("root_cause_code"), F.lit("UNCLASSIFIED")).alias("root_cause_code"),
        "abs_variance")
    exc = F.col("match_status") == "EXCEPTION"
    agg = p.groupBy("country_code", "recon_type", "period_key", "recon_year", "recon_month", "month_label",
                    "root_cause_code").agg(
        F.count(F.lit(1)).alias("total_records"),
        count_when(exc).alias("exception_count"),
        count_when(F.col("match_status") == "MATCHED").alias("matched_count"),
        F.sum("abs_variance").cast(MONEY).alias("total_variance_amount"),
        F.avg(F.when(exc, F.col("abs_variance"))).cast("decimal(18,6)").alias("avg_exception_variance"),
    )
    rc = _dim(stg_root_cause.select("root_cause_code", F.col("description").alias("root_cause_description"),
                                    F.col("category").alias("root_cause_category"), "responsible_team",
                                    "is_systemic"), cfg)
    j = agg.join(rc, "root_cause_code", "left")
    part = Window.partitionBy("country_code", "recon_type")
    running = part.orderBy(F.col("exception_count").desc(), F.col("period_key"), F.col("root_cause_code")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = (j.withColumn("__total_exc", F.sum("exception_count").over(part))
          .withColumn("__run_exc", F.sum("exception_count").over(running)))
    out = j.select(
        "country_code", "recon_type", "period_key", "recon_year", "recon_month", "month_label",
        "root_cause_code", "root_cause_description", "root_cause_category", "responsible_team", "is_systemic",
        "total_records", "exception_count", "matched_count", "total_variance_amount", "avg_exception_variance",
        pct_ratio("matched_count", "total_records").alias("match_rate_pct"),
        pct_ratio("exception_count", "total_records").alias("exception_rate_pct"),
        pct_ratio("exception_count", "__total_exc").alias("pareto_pct_of_all_exceptions"),
        pct_ratio("__run_exc", "__total_exc").alias("cumulative_pareto_pct"),
    )
    if ordered:
        out = out.orderBy("country_code", "recon_year", "recon_month", F.col("exception_count").desc())
    return out
