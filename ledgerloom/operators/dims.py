"""Enriched dimension models M20–M23: dimensions joined to their own
statistics (aggregated first, then a left join + COALESCE to 0)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.config import ReconConfig
from ledgerloom.functions.exprs import calendar_year_diff, count_when, first_match, pct_ratio

# --- fixed values: slicer labels for the two country codes the models know ---
COUNTRY_LABELS = {"MYS": "\U0001F1F2\U0001F1FE Malaysia (MYR)", "SGP": "\U0001F1F8\U0001F1EC Singapore (SGD)"}
# -----------------------------------------------------------------------------


def dim_store_enriched(stg_store: DataFrame, summary: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Store with record counts, match rates, health score and status.

    Statistics group the summary by store_id; PAY_BANK rows have a NULL
    store (Q2), a group the partial aggregate folds before any shuffle."""
    matched = F.col("match_status") == "MATCHED"
    pos = F.col("recon_type") == "POS_SAP"
    pay = F.col("recon_type") == "PAY_BANK"
    stats = summary.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("total_records"),
        count_when(F.col("match_status") == "EXCEPTION").alias("total_exceptions"),
        count_when(matched).alias("total_matched"),
        count_when(matched & pos).alias("__pos_m"), count_when(pos).alias("__pos_n"),
        count_when(matched & pay).alias("__pay_m"), count_when(pay).alias("__pay_n"),
    ).select("store_id", "total_records", "total_exceptions", "total_matched",
             pct_ratio("__pos_m", "__pos_n").alias("sales_match_rate_pct"),
             pct_ratio("__pay_m", "__pay_n").alias("payment_match_rate_pct"))
    j = stg_store.join(stats, "store_id", "left")
    z = F.lit(0)
    sales = F.coalesce(F.col("sales_match_rate_pct"), z.cast("decimal(18,2)"))
    payr = F.coalesce(F.col("payment_match_rate_pct"), z.cast("decimal(18,2)"))
    score = sales * F.lit(0.6).cast("decimal(2,1)") + payr * F.lit(0.4).cast("decimal(2,1)")
    return j.select(
        "store_id", "country_code", "store_name", "mall_name", "city", "state", "store_type",
        "sap_profit_center", "sap_cost_center", "bank_account", "bank_code", "open_date",
        "floor_area_sqft", "num_terminals",
        calendar_year_diff("open_date", F.lit(cfg.as_of_str).cast("date")).alias("store_age_years"),
        F.coalesce(F.col("total_records"), z.cast("bigint")).alias("total_recon_records"),
        F.coalesce(F.col("total_exceptions"), z.cast("bigint")).alias("total_exceptions"),
        F.coalesce(F.col("total_matched"), z.cast("bigint")).alias("total_matched"),
        sales.alias("sales_match_rate_pct"),
        payr.alias("payment_match_rate_pct"),
        F.round(score, 2).cast("decimal(18,2)").alias("health_score"),
        first_match([(score >= 99, "CLEAR"), (score >= 97, "MONITOR")], "ESCALATE").alias("health_status"),
    )


def dim_country_enriched(stg_country: DataFrame, summary: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Country with record count, exception count and match rate."""
    stats = summary.groupBy("country_code").agg(
        F.count(F.lit(1)).alias("total_recon_records"),
        count_when(F.col("match_status") == "EXCEPTION").alias("total_exceptions"),
        count_when(F.col("match_status") == "MATCHED").alias("__m"),
    ).select("country_code", "total_recon_records", "total_exceptions",
             pct_ratio("__m", "total_recon_records").alias("overall_match_rate_pct"))
    j = stg_country.join(stats, "country_code", "left")
    label = first_match([(F.col("country_code") == k, v) for k, v in COUNTRY_LABELS.items()],
                        F.col("country_name"))
    return j.select(
        "country_code", "country_code_iso2", "country_name", "sap_company_code", "base_currency",
        "tax_system", "tax_rate_standard", "fiscal_year_end_month", "settlement_lag_days",
        "variance_threshold_t2", "variance_threshold_t3", "variance_threshold_t4",
        "regulatory_body", "bank_transfer_rail",
        F.coalesce(F.col("total_recon_records"), F.lit(0).cast("bigint")).alias("total_recon_records"),
        F.coalesce(F.col("total_exceptions"), F.lit(0).cast("bigint")).alias("total_exceptions"),
        F.coalesce(F.col("overall_match_rate_pct"), F.lit(0).cast("decimal(18,2)")).alias("overall_match_rate_pct"),
        label.alias("country_display_label"),
    )


def dim_root_cause_enriched(stg_root_cause: DataFrame, trend: DataFrame, cfg: ReconConfig,
                            ordered: bool = True) -> DataFrame:
    """Exceptions per cause over the whole trend, with Pareto share,
    running share and rank; all catalogue causes kept.

    The windows have no partition: they run over one row per catalogue cause
    (fifteen), never over facts. The running share breaks count ties by code.
    """
    counts = trend.filter(F.col("root_cause_code") != "UNCLASSIFIED").groupBy("root_cause_code").agg(
        F.sum("exception_count").cast("bigint").alias("__exc"))
    whole = Window.partitionBy()
    counts = counts.select("root_cause_code", "__exc",
                           pct_ratio("__exc", F.sum("__exc").over(whole)).alias("__pct"))
    j = stg_root_cause.join(counts, "root_cause_code", "left")
    n = F.coalesce(F.col("__exc"), F.lit(0).cast("bigint"))
    j = j.withColumn("total_exceptions_6m", n)
    run = Window.orderBy(F.col("total_exceptions_6m").desc(), F.col("root_cause_code")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = j.select(
        "root_cause_code", "category", "subcategory", "description", "responsible_team",
        "typical_resolution_hrs", "is_systemic", "total_exceptions_6m",
        F.coalesce(F.col("__pct"), F.lit(0).cast("decimal(18,2)")).alias("pareto_pct"),
        pct_ratio(F.sum("total_exceptions_6m").over(run), F.sum("total_exceptions_6m").over(whole))
         .alias("cumulative_pareto_pct"),
        F.rank().over(Window.orderBy(F.col("total_exceptions_6m").desc())).cast("int").alias("pareto_rank"),
    )
    if ordered:
        out = out.orderBy("pareto_rank", "root_cause_code")
    return out


def dim_tender_type_enriched(stg_tender: DataFrame) -> DataFrame:
    """Tender types without is_active, plus is_instant_settlement."""
    return stg_tender.select(
        "tender_code", "country_code", "tender_name", "tender_category", "sap_gl_account",
        "settlement_lag_days", "is_card", "is_ewallet", "interchange_rate_pct", "notes",
        F.when(F.col("settlement_lag_days") == 0, F.lit(True)).otherwise(F.lit(False))
         .alias("is_instant_settlement"),
    )
