"""Scalar-function coverage queries (F01–F37) over the staged tables, and
their oracle SQL. Each query projects one row per input row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import ReconConfig
from ledgerloom.functions.exprs import (
    calendar_year_diff, greatest_strict, is_truthy, mon_yy, pad_num, prior_month_28th, yyyy_mm, yyyymmdd,
)


def f_dates(stg_eod: DataFrame, cfg: ReconConfig) -> DataFrame:
    d = F.col("business_date")
    as_of = F.lit(cfg.as_of_str).cast("date")
    return stg_eod.select(
        "eod_summary_id", d,
        yyyymmdd(d).alias("f04_yyyymmdd"),
        yyyy_mm(F.trunc(d, "month")).alias("f05_yyyy_mm"),
        mon_yy(d).alias("f06_mon_yy"),
        F.trunc(d, "month").alias("f07_month_start"),
        F.year(d).alias("f08_year"), F.month(d).alias("f08_month"),
        F.datediff(as_of, d).alias("f09_age_days"),
        calendar_year_diff(d, as_of).alias("f10_year_diff"),
        F.date_add(d, 2).alias("f26_plus_two"),
        F.last_day(d).alias("f27_month_end"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("f28_quarter"),
        F.weekday(d).alias("f29_weekday"),
        prior_month_28th(d).alias("f30_prior_28th"),
    )


F_DATES_SQL = """
SELECT eod_summary_id, business_date,
       strftime(business_date, '%Y%m%d') AS f04_yyyymmdd,
       strftime(CAST(date_trunc('month', business_date) AS DATE), '%Y-%m') AS f05_yyyy_mm,
       strftime(business_date, '%b %y') AS f06_mon_yy,
       CAST(date_trunc('month', business_date) AS DATE) AS f07_month_start,
       CAST(year(business_date) AS INTEGER) AS f08_year, CAST(month(business_date) AS INTEGER) AS f08_month,
       CAST(date_diff('day', business_date, DATE '2001-12-31') AS INTEGER) AS f09_age_days,
       CAST(year(DATE '2001-12-31') - year(business_date) AS INTEGER) AS f10_year_diff,
       CAST(business_date + 2 AS DATE) AS f26_plus_two,
       last_day(business_date) AS f27_month_end,
       'Q' || CAST(quarter(business_date) AS VARCHAR) AS f28_quarter,
       CAST(isodow(business_date) - 1 AS INTEGER) AS f29_weekday,
       CAST(CAST(date_trunc('month', business_date - INTERVAL 1 MONTH) AS DATE) + 27 AS DATE) AS f30_prior_28th
FROM stg_pos_eod_summary"""


def f_strings(stg_tender: DataFrame) -> DataFrame:
    t = F.col("tender_code")
    return stg_tender.select(
        "pos_tender_id",
        F.upper(F.lower(t)).alias("f01_upper"),
        F.regexp_replace("settlement_batch", "-", "").alias("f02_no_dashes"),
        F.concat(F.col("card_type"), F.lit("/"), F.col("card_last4")).alias("f03_concat_nullable"),
        F.substring("settlement_batch", 7, 6).alias("f25_store_part"),
        F.substring("pos_txn_id", -3, 3).alias("f25_last3"),
        pad_num(F.length("settlement_batch"), 4).alias("f31_padded"),
        F.format_string("%05d", F.length("pos_tender_id")).alias("f31_format"),
        F.col("settlement_batch").contains("NOSTORE").alias("f37_contains"),
        is_truthy("paynow_ref").alias("p14_truthy"),
    )


F_STRINGS_SQL = """
SELECT pos_tender_id,
       upper(lower(tender_code)) AS f01_upper,
       replace(settlement_batch, '-', '') AS f02_no_dashes,
       card_type || '/' || card_last4 AS f03_concat_nullable,
       substr(settlement_batch, 7, 6) AS f25_store_part,
       right(pos_txn_id, 3) AS f25_last3,
       CASE WHEN length(CAST(length(settlement_batch) AS VARCHAR)) >= 4 THEN CAST(length(settlement_batch) AS VARCHAR)
            ELSE lpad(CAST(length(settlement_batch) AS VARCHAR), 4, '0') END AS f31_padded,
       printf('%05d', length(pos_tender_id)) AS f31_format,
       contains(settlement_batch, 'NOSTORE') AS f37_contains,
       paynow_ref IS NOT NULL AND paynow_ref <> '' AS p14_truthy
FROM stg_pos_tender"""


def f_numeric(stg_header: DataFrame) -> DataFrame:
    net, tax = F.col("net_amount"), F.col("tax_amount_local")
    return stg_header.select(
        "pos_txn_id",
        F.round(net * F.lit("0.333").cast("decimal(4,3)"), 2).cast("decimal(18,2)").alias("f12_round2"),
        F.abs(net).alias("f13_abs"), (-net).cast("decimal(18,2)").alias("f13_neg"),
        greatest_strict(net, F.lit(0).cast("decimal(18,2)")).alias("f14_greatest"),
        F.coalesce(F.col("promo_code"), F.lit("NONE")).alias("f15_coalesce"),
        F.nullif(F.col("discount_amount"), F.lit(0).cast("decimal(18,2)")).alias("f16_nullif"),
        F.round(net * F.lit("1.5").cast("decimal(2,1)") * F.lit("0.01").cast("decimal(3,2)"), 2)
         .cast("decimal(18,2)").alias("f23_fee"),
        F.round(net * F.lit("0.06").cast("decimal(3,2)"), 2).cast("decimal(18,2)").alias("f32_tax_6pct"),
        F.least(F.greatest(tax, F.lit(0).cast("decimal(18,2)")), F.lit(1000).cast("decimal(18,2)"))
         .alias("f34_clamped"),
    )


F_NUMERIC_SQL = """
SELECT pos_txn_id,
       CAST(round(net_amount * 0.333, 2) AS DECIMAL(18,2)) AS f12_round2,
       abs(net_amount) AS f13_abs, CAST(-net_amount AS DECIMAL(18,2)) AS f13_neg,
       CASE WHEN net_amount IS NULL THEN NULL ELSE greatest(net_amount, CAST(0 AS DECIMAL(18,2))) END AS f14_greatest,
       coalesce(promo_code, 'NONE') AS f15_coalesce,
       nullif(discount_amount, CAST(0 AS DECIMAL(18,2))) AS f16_nullif,
       CAST(round(net_amount * 1.5 * 0.01, 2) AS DECIMAL(18,2)) AS f23_fee,
       CAST(round(net_amount * 0.06, 2) AS DECIMAL(18,2)) AS f32_tax_6pct,
       least(greatest(tax_amount_local, CAST(0 AS DECIMAL(18,2))), CAST(1000 AS DECIMAL(18,2))) AS f34_clamped
FROM stg_pos_transaction_header"""


def f_casts(stg_settlement: DataFrame) -> DataFrame:
    return stg_settlement.select(
        "settlement_surrogate_key",
        F.date_format("txn_date", "yyyy-MM-dd").cast("date").alias("f19_date"),
        F.concat(F.date_format("txn_date", "yyyy-MM-dd"), F.lit("T10:30:00+08:00")).cast("timestamp")
         .alias("f20_timestamp_utc"),
        F.col("txn_count").cast("int").alias("f21_int"),
        F.when(F.col("_dq_flag") == "CLEAN", F.lit("Y")).otherwise(F.lit("N")).cast("boolean").alias("f21_bool"),
        F.col("actual_rate_pct").cast("double").alias("f21_float"),
        F.round((F.col("interchange_fee").cast("double") / F.nullif(F.col("gross_amount").cast("double"), F.lit(0.0))
                 * F.lit(100.0)).cast("decimal(18,6)"), 4).cast("decimal(18,4)").alias("f22_fee_pct"),
        F.when(F.datediff("settle_date", "txn_date") == 0, F.lit(True)).otherwise(F.lit(False))
         .alias("f24_same_day"),
    )


F_CASTS_SQL = """
SELECT settlement_surrogate_key,
       CAST(strftime(txn_date, '%Y-%m-%d') AS DATE) AS f19_date,
       CAST(CAST(strftime(txn_date, '%Y-%m-%d') || 'T10:30:00+08:00' AS TIMESTAMPTZ) AS TIMESTAMP) AS f20_timestamp_utc,
       CAST(txn_count AS INTEGER) AS f21_int,
       CAST(CASE WHEN _dq_flag = 'CLEAN' THEN 'Y' ELSE 'N' END AS BOOLEAN) AS f21_bool,
       CAST(actual_rate_pct AS DOUBLE) AS f21_float,
       CAST(round(CAST(CAST(interchange_fee AS DOUBLE) / nullif(CAST(gross_amount AS DOUBLE), 0) * 100.0
                       AS DECIMAL(18,6)), 4) AS DECIMAL(18,4)) AS f22_fee_pct,
       CASE WHEN date_diff('day', txn_date, settle_date) = 0 THEN TRUE ELSE FALSE END AS f24_same_day
FROM stg_bank_card_settlement"""
