"""Small literal dimensions whose values must equal the reference's.

dim_root_cause is the reference's fixed list of fifteen codes. dim_bank and
dim_tax_code have one row per configured country, built from dim_country.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.exprs import RATE

# --- fixed values: root-cause catalogue --------------------------------------
# (code, category, subcategory, description, responsible_team,
#  typical_resolution_hrs, is_systemic, occurrence_count)
ROOT_CAUSES = [
    ("RC-001", "SYSTEM", "Batch Job", "SAP batch posting job failed or timed out", "IT-SAP", 4, False, 0),
    ("RC-002", "SYSTEM", "Integration", "POS-SAP integration feed not received (middleware timeout)", "IT-Middleware", 6, False, 0),
    ("RC-003", "CONFIG", "Promo Mapping", "Promotion code not configured in SAP pricing conditions", "IT-SAP", 8, True, 0),
    ("RC-004", "PROCESS", "Manual Entry", "Manual SAP posting entered with incorrect amount", "Finance", 2, False, 0),
    ("RC-005", "DATA", "Duplicate", "Duplicate POS transaction transmitted to SAP", "IT-POS", 3, False, 0),
    ("RC-006", "PROCESS", "Return", "POS return not correctly reversed in SAP", "Finance", 2, False, 0),
    ("RC-007", "DATA", "Rounding", "Rounding difference between POS (2dp) and SAP (2dp) due to tax calc", "IT-SAP", 1, True, 0),
    ("RC-008", "PROCESS", "Period", "SAP posting in wrong fiscal period (prior period close issue)", "Finance", 4, False, 0),
    ("RC-009", "PAYMENT", "Settlement Lag", "Card/e-wallet settlement received in bank later than expected", "Treasury", 24, False, 0),
    ("RC-010", "PAYMENT", "Interchange", "Interchange fee deducted differs from contracted rate", "Treasury", 48, True, 0),
    ("RC-011", "PAYMENT", "Chargeback", "Customer chargeback deducted from settlement batch", "Finance", 72, False, 0),
    ("RC-012", "DATA", "Data Quality", "Source data quality issue — null, invalid or out-of-range value", "IT-POS", 4, False, 0),
    ("RC-013", "CONFIG", "Tax Code", "Wrong tax code applied — SST/GST rate mismatch", "IT-SAP", 4, True, 0),
    ("RC-014", "PAYMENT", "Missing Credit", "Bank statement credit not received — bank cut-off or processing delay", "Treasury", 48, False, 0),
    ("RC-015", "SYSTEM", "FX Conversion", "Cross-border card FX conversion error (tourist spend in SG)", "IT-SAP", 8, False, 0),
]
# -----------------------------------------------------------------------------

ROOT_CAUSE_SCHEMA = ("root_cause_code string, category string, subcategory string, description string, "
                     "responsible_team string, typical_resolution_hrs int, is_systemic boolean, "
                     "occurrence_count bigint")


def dim_root_cause(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROOT_CAUSES, ROOT_CAUSE_SCHEMA)


def dim_bank(country: DataFrame) -> DataFrame:
    num = F.substring("sap_company_code", 2, 10).cast("int").cast("string")
    return country.select(
        F.concat(F.lit("BANK"), num).alias("bank_code"), "country_code",
        F.concat(F.lit("Bank of "), F.col("country_name")).alias("bank_name"),
        F.concat(F.lit("B"), num).alias("bank_short_name"),
        F.concat(F.lit("BNK"), num, F.lit("XXX")).alias("swift_bic"),
        F.concat(F.lit("ACCT-"), F.lpad(num, 3, "0")).alias("bank_account_no"),
        F.lit("CURRENT").alias("account_type"),
        F.concat(F.lit("HB"), num).alias("sap_house_bank"),
        F.concat(F.lit("AC"), num).alias("sap_account_id"),
        F.lit("MT940").alias("statement_format"),
        F.col("bank_transfer_rail").alias("transfer_rail"),
        F.lit("16:00").alias("settlement_cut_off"),
        F.lit(None).cast("string").alias("contact_name"),
        "is_active",
    )


def dim_tax_code(country: DataFrame) -> DataFrame:
    num = F.substring("sap_company_code", 2, 10).cast("int").cast("string")
    return country.select(
        F.concat(F.col("country_code"), F.lit("-TX"), num).alias("tax_code_key"), "country_code",
        F.concat(F.lit("TX"), num).alias("tax_code"),
        F.col("tax_system").alias("tax_type"),
        F.concat(F.col("tax_system"), F.lit(" standard rate")).alias("tax_description"),
        F.col("tax_rate_standard").cast(RATE).alias("tax_rate_pct"),
        F.lit("1990-01-01").cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.concat(F.lit("S"), num).alias("sap_tax_code"),
        F.lit(False).alias("is_exempt"),
        F.lit("0021000000").alias("gl_account_tax"),
        F.lit("MONTHLY").alias("filing_frequency"),
        F.concat(F.lit("AUTH-"), num).alias("tax_authority"),
    )
