"""Load profiles and spot checks.

Each is one small aggregate over a raw table; the audit of stored tables
reads row counts off the Parquet footers, without opening a data page.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.exprs import first_match, pct_ratio


def family_rank(name_col="table_name") -> F.Column:
    n = F.col(name_col)
    return first_match([(n.startswith("dim_"), 1), (n.startswith("pos_"), 2), (n.startswith("sap_"), 3),
                        (n.startswith("bank_"), 4), (n == "recon_match_result", 5)], None)


def load_audit(tables: dict[str, DataFrame], ordered: bool = True) -> DataFrame:
    """Row count per raw table, ordered by table family then count.

    All tables feed one stream of table names and one grouped count (a
    single shuffle); the scans read no columns."""
    stream = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("table_name"))
                                            for name, df in tables.items()])
    out = (stream.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
                 .withColumn("family_rank", family_rank().cast("int")))
    if ordered:
        out = out.orderBy("family_rank", F.col("row_count").desc(), "table_name")
    return out


def footer_audit(spark: SparkSession, paths: dict[str, str], ordered: bool = True) -> DataFrame:
    """S15/O04 over stored tables (name -> Parquet folder): like
    :func:`load_audit`, from the files' footers alone. COUNT(*) is pushed into
    the scan, which returns one number per file instead of rows; the reader
    that can do that is Spark's second one, chosen for these scans only.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")  # read when the plan is made; other scans don't use it
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        counts = [spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
                  for name, path in paths.items()]
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", before)
    out = reduce(DataFrame.unionByName, counts).withColumn("family_rank", family_rank().cast("int"))
    return out.orderBy("family_rank", F.col("row_count").desc(), "table_name") if ordered else out


def country_mix(header: DataFrame) -> DataFrame:
    """Transactions per country, largest first."""
    return header.groupBy("country_code").agg(F.count(F.lit(1)).alias("txn_count")) \
        .orderBy(F.col("txn_count").desc(), "country_code")


def break_histogram(df: DataFrame) -> DataFrame:
    """Injected break flags (CLEAN excluded), most frequent first."""
    return (df.filter(F.col("_dq_flag") != "CLEAN").groupBy("_dq_flag")
              .agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("cnt").desc(), "_dq_flag"))


def break_histogram_by_table(tables: dict[str, DataFrame]) -> DataFrame:
    """A16 over every table that carries a break flag (union of per-table counts)."""
    parts = [df.filter(F.col("_dq_flag") != "CLEAN").select(F.lit(name).alias("table_name"), "_dq_flag")
             for name, df in tables.items() if "_dq_flag" in df.columns]
    return reduce(DataFrame.unionByName, parts).groupBy("table_name", "_dq_flag").agg(
        F.count(F.lit(1)).alias("cnt"))


def type_status_counts(recon: DataFrame) -> DataFrame:
    """Reference result rows by reconciliation type and status."""
    return recon.groupBy("recon_type", "match_status").agg(F.count(F.lit(1)).alias("cnt")) \
        .orderBy("recon_type", "match_status")


def maker_checker_spot_check(recon: DataFrame) -> DataFrame:
    """Counts with CASE-without-ELSE over exceptions."""
    exc = recon.filter(F.col("match_status") == "EXCEPTION")
    p, r = F.col("preparer_id"), F.col("reviewer_id")
    return exc.agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.count(F.when(p == r, 1)).alias("same_person_violations"),
        F.count(F.when((p != r) | r.isNull(), 1)).alias("correctly_segregated"),
    )


def variance_distribution(recon: DataFrame) -> DataFrame:
    """Count, average and maximum |variance| by country and match type
    for the sales reconciliation (average through an exact decimal(18,6))."""
    s = recon.filter(F.col("recon_type") == "POS_SAP").withColumn("__a", F.abs("variance_pos_sap"))
    return s.groupBy("country_code", "match_type").agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg("__a").cast("decimal(18,6)"), 2).cast("decimal(18,2)").alias("avg_abs_variance"),
        F.round(F.max("__a"), 2).cast("decimal(18,2)").alias("max_abs_variance"),
    ).orderBy("country_code", F.col("count").desc())


def exception_rates(recon: DataFrame) -> DataFrame:
    """Exceptions and exception rate per type, plus the global row."""
    exc = F.col("match_status") == "EXCEPTION"
    per_type = recon.groupBy("recon_type").agg(F.count(F.lit(1)).alias("total"),
                                                F.count(F.when(exc, 1)).alias("exceptions"))
    overall = recon.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(exc, 1)).alias("exceptions")) \
        .select(F.lit("ALL").alias("recon_type"), "total", "exceptions")
    return per_type.unionByName(overall).withColumn("exception_rate_pct", pct_ratio("exceptions", "total"))
