"""Query registry: one callable (spark, sf_dir) -> DataFrame per operator
group of the survey, each paired with its DuckDB oracle SQL.

Model queries read the raw tables loaded once per session
(:func:`stored_raw`); derivation queries (dNN) run the binding and
derivation plans end to end from the test-warehouse tables.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import ReconConfig, with_all_fixes
from ledgerloom.operators import checks, derive, dims, lookups, marts, profile
from ledgerloom.operators.ranges import read_sorted, save_sorted, work_folder
from ledgerloom.plans import oracle, scalar_queries
from ledgerloom.plans.build import ORDERS, built_models
from ledgerloom.plans.models import MODEL_NAMES, Models
from ledgerloom.session import session_key
from ledgerloom.sources.io import write_csv
from ledgerloom.sources.load import load_warehouse
from ledgerloom.sources.raw import BUILDERS, RawTables, stored_raw
from ledgerloom.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, RAW_SCHEMAS
from ledgerloom.sources.tables import written_once

CFG = ReconConfig()
CFG_FIXED = with_all_fixes(CFG)
_MODELS: dict[tuple, Models] = {}


def models(spark: SparkSession, sf_dir: str, cfg: ReconConfig = CFG) -> Models:
    raw = stored_raw(spark, sf_dir, cfg)
    key = (session_key(spark), raw.root, cfg)  # the root names the input files: rewritten ones are loaded anew
    if key not in _MODELS:
        _MODELS[key] = Models(raw, cfg)
    return _MODELS[key]


def lazy(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(spark, sf_dir, CFG)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def reg(name: str, fn: Callable[[SparkSession, str], DataFrame], sql: str | None) -> None:
    QUERIES[name] = fn
    if sql is not None:
        ORACLES[name] = sql


# ---------------------------------------------------------------- flagship
def tier_histogram(m: Models) -> DataFrame:
    """Sales reconciliation outcome by country and tier (entry query)."""
    return m.int_pos_sap_matched.groupBy("country_code", "match_type", "match_status").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("pos_amount").cast("decimal(18,2)").alias("pos_amount"),
        F.sum("sap_amount").cast("decimal(18,2)").alias("sap_amount"),
        F.sum(F.abs("variance_pos_sap")).cast("decimal(18,2)").alias("abs_variance"))


TIER_HISTOGRAM_SQL = oracle.with_ctes("""
SELECT country_code, match_type, match_status, count(*) AS records,
       CAST(sum(pos_amount) AS DECIMAL(18,2)) AS pos_amount, CAST(sum(sap_amount) AS DECIMAL(18,2)) AS sap_amount,
       CAST(sum(abs(variance_pos_sap)) AS DECIMAL(18,2)) AS abs_variance
FROM int_pos_sap_matched GROUP BY 1, 2, 3""")

reg("q00_pos_sap_tier_histogram", lambda s, d: tier_histogram(models(s, d)), TIER_HISTOGRAM_SQL)

# ---------------------------------------------------------------- models M01–M23
for i, name in enumerate(MODEL_NAMES, start=1):
    if name == "stg_dim_root_cause":
        continue  # reads only the fixed cause catalogue; covered inside M16–M19, M22
    reg(f"m{i:02d}_{name}", (lambda n: lambda s, d: models(s, d).model(n))(name), oracle.select_all(name))

# ---------------------------------------------------------------- derivations
RAW_DERIVED = {
    "s14_dim_country": "dim_country", "s14_dim_store": "dim_store", "s14_dim_tender_type": "dim_tender_type",
    "s14_dim_bank": "dim_bank", "s14_dim_tax_code": "dim_tax_code",
    "d02_fiscal_calendar": "dim_fiscal_calendar", "d03_fx_rates": "dim_currency",
    "d04_pos_transaction_header": "pos_transaction_header", "d04_pos_tender": "pos_tender",
    "d05_pos_eod_summary": "pos_eod_summary", "d06_sap_fi_document": "sap_fi_document",
    "d09_sap_fi_lineitem": "sap_fi_lineitem", "d10_bank_card_settlement": "bank_card_settlement",
    "d13_bank_statement_line": "bank_statement_line", "d14_recon_match_result": "recon_match_result",
}
#: Derived from the loaded tables they read, as the reference's scripts do, not from orders again.
FROM_STORED = ("bank_statement_line", "recon_match_result")
for qname, table in RAW_DERIVED.items():
    reg(qname, (lambda t: lambda s, d: BUILDERS[t](stored_raw(s, d, CFG)) if t in FROM_STORED else lazy(s, d).get(t))(table),
        oracle.select_all(f"raw_{table}"))

reg("d01_date_spine",
    lambda s, d: derive.date_spine(lazy(s, d).get("pos_transaction_header"), ["country_code"]),
    oracle.select_all("spine_country"))

# ---------------------------------------------------------------- joins
reg("j14_tender_country_wildcard",
    lambda s, d: lookups.tender_with_country_wildcard(models(s, d).stg_pos_tender,
                                                      models(s, d).stg_dim_tender_type, CFG),
    oracle.with_ctes("""
SELECT t.pos_tender_id, t.tender_code, t.country_code, d.tender_name, d.tender_category, d.settlement_lag_days,
       t.business_date, CAST(t.business_date + d.settlement_lag_days AS DATE) AS expected_settle_date
FROM stg_pos_tender t JOIN stg_dim_tender_type d
  ON t.tender_code = d.tender_code AND (t.country_code = d.country_code OR d.country_code = 'BOTH')"""))

reg("j16_eod_without_ledger",
    lambda s, d: lookups.eod_without_ledger(models(s, d).stg_pos_eod_summary,
                                            models(s, d).int_sap_sales_by_store_date),
    oracle.with_ctes("""
SELECT e.eod_summary_id, e.country_code, e.store_id, e.business_date, e.net_sales, e.sap_transfer_status
FROM stg_pos_eod_summary e
WHERE NOT EXISTS (SELECT 1 FROM int_sap_sales_by_store_date s WHERE s.store_id = e.store_id
                  AND s.country_code = e.country_code AND s.sap_posting_date = e.business_date)"""))

reg("j19_store_date_spine",
    lambda s, d: lookups.store_date_spine(models(s, d).stg_pos_eod_summary),
    oracle.with_ctes("""
SELECT sp.store_id, sp.date_key, e.net_sales IS NOT NULL AS has_sales,
       coalesce(e.net_sales, CAST(0 AS DECIMAL(18,2))) AS net_sales
FROM (SELECT store_id, CAST(unnest(generate_series(min(business_date), max(business_date), INTERVAL 1 DAY)) AS DATE)
             AS date_key FROM stg_pos_eod_summary GROUP BY store_id) sp
LEFT JOIN stg_pos_eod_summary e ON sp.store_id = e.store_id AND sp.date_key = e.business_date"""))

reg("j21_holiday_transactions",
    lambda s, d: lookups.holiday_transactions(models(s, d).stg_pos_transaction_header),
    oracle.with_ctes("""
SELECT h.country_code, hol.name AS public_holiday_name, count(*) AS txn_count,
       CAST(sum(h.net_amount) AS DECIMAL(18,2)) AS net_amount
FROM stg_pos_transaction_header h
JOIN (VALUES (1, 1, 'New Year''s Day'), (5, 1, 'Labour Day'), (12, 25, 'Christmas Day')) AS hol(m, d, name)
  ON month(h.business_date) = hol.m AND day(h.business_date) = hol.d
GROUP BY 1, 2"""))

# ---------------------------------------------------------------- windows / unions / order
reg("w07_document_sequence",
    lambda s, d: lookups.document_sequence(lazy(s, d).get("pos_transaction_header")),
    oracle.with_ctes("""
SELECT pos_txn_id, sap_company_code, business_date,
       row_number() OVER (PARTITION BY sap_company_code ORDER BY business_date, store_id, pos_txn_id) AS doc_seq,
       CAST((CAST(substr(sap_company_code, 2) AS BIGINT) + 1) * 1000000000
            + row_number() OVER (PARTITION BY sap_company_code ORDER BY business_date, store_id, pos_txn_id)
            AS VARCHAR) AS doc_number
FROM postable"""))

reg("u03_trend_rows",
    lambda s, d: marts.trend_rows(models(s, d).int_pos_sap_matched, models(s, d).int_pay_bank_matched),
    oracle.select_all("trend_rows"))


def positions(df: DataFrame, order: list, columns: list[str]) -> DataFrame:
    """O01-O05 made testable: the table is saved in its order, and each row's
    place is read off the saved files (:func:`save_sorted`)."""
    path = save_sorted(df.select(*columns), work_folder(df.sparkSession), order)
    return read_sorted(df.sparkSession, path)


def exception_log(m: Models) -> DataFrame:
    return marts.mart_exception_log(m.int_pos_sap_matched, m.int_pay_bank_matched, m.stg_dim_store,
                                    m.stg_dim_root_cause, m.raw.get("recon_match_result"), CFG, ordered=False)


def root_cause_trend(m: Models) -> DataFrame:
    return marts.mart_root_cause_trend(m.int_pos_sap_matched, m.int_pay_bank_matched, m.stg_dim_root_cause, CFG, ordered=False)


reg("o01_exception_log_order",
    lambda s, d: positions(exception_log(models(s, d)), ORDERS["mart_exception_log"], ["match_id", "recon_date", "abs_variance"])
    .withColumnRenamed("position", "display_rank"), oracle.with_ctes("""
SELECT match_id, recon_date, abs_variance,
       row_number() OVER (ORDER BY recon_date DESC, abs_variance DESC, match_id) AS display_rank
FROM mart_exception_log"""))

reg("o02_root_cause_trend_order",
    lambda s, d: positions(root_cause_trend(models(s, d)), ORDERS["mart_root_cause_trend"],
                           ["country_code", "recon_type", "period_key", "recon_year", "recon_month", "root_cause_code", "exception_count"]),
    oracle.with_ctes("""
SELECT country_code, recon_type, period_key, recon_year, recon_month, root_cause_code, exception_count,
       row_number() OVER (ORDER BY country_code, recon_year, recon_month, exception_count DESC, recon_type, period_key,
                                   root_cause_code) AS position
FROM mart_root_cause_trend"""))

reg("o03_root_cause_order",
    lambda s, d: positions(dims.dim_root_cause_enriched(models(s, d).stg_dim_root_cause, root_cause_trend(models(s, d)), CFG, ordered=False),
                           ORDERS["dim_root_cause_enriched"], ["root_cause_code", "total_exceptions_6m", "pareto_rank"]),
    oracle.with_ctes("""
SELECT root_cause_code, total_exceptions_6m, pareto_rank,
       row_number() OVER (ORDER BY total_exceptions_6m DESC, root_cause_code) AS position
FROM dim_root_cause_enriched"""))

# ---------------------------------------------------------------- scalar functions
reg("f_dates", lambda s, d: scalar_queries.f_dates(models(s, d).stg_pos_eod_summary, CFG),
    oracle.with_ctes(scalar_queries.F_DATES_SQL))
reg("f_strings", lambda s, d: scalar_queries.f_strings(models(s, d).stg_pos_tender),
    oracle.with_ctes(scalar_queries.F_STRINGS_SQL))
reg("f_numeric", lambda s, d: scalar_queries.f_numeric(models(s, d).stg_pos_transaction_header),
    oracle.with_ctes(scalar_queries.F_NUMERIC_SQL))
reg("f_casts", lambda s, d: scalar_queries.f_casts(models(s, d).stg_bank_card_settlement),
    oracle.with_ctes(scalar_queries.F_CASTS_SQL))

# ---------------------------------------------------------------- profiles
reg("a13_a18_maker_checker_spot_check",
    lambda s, d: profile.maker_checker_spot_check(models(s, d).raw.get("recon_match_result")),
    oracle.with_ctes("""
SELECT count(*) AS total_exceptions,
       count(CASE WHEN preparer_id = reviewer_id THEN 1 END) AS same_person_violations,
       count(CASE WHEN preparer_id <> reviewer_id OR reviewer_id IS NULL THEN 1 END) AS correctly_segregated
FROM raw_recon_match_result WHERE match_status = 'EXCEPTION'"""))

reg("a14_variance_distribution",
    lambda s, d: profile.variance_distribution(models(s, d).raw.get("recon_match_result")),
    oracle.with_ctes(f"""
SELECT country_code, match_type, count(*) AS count,
       CAST(round({oracle.oracle_models.avg6('abs(variance_pos_sap)')}, 2) AS DECIMAL(18,2)) AS avg_abs_variance,
       CAST(max(abs(variance_pos_sap)) AS DECIMAL(18,2)) AS max_abs_variance
FROM raw_recon_match_result WHERE recon_type = 'POS_SAP' GROUP BY country_code, match_type"""))

reg("a15_country_mix", lambda s, d: profile.country_mix(models(s, d).raw.get("pos_transaction_header")),
    oracle.with_ctes("""SELECT country_code, count(*) AS txn_count FROM raw_pos_transaction_header GROUP BY 1"""))

reg("o05_break_histogram_order",
    lambda s, d: positions(profile.break_histogram(models(s, d).raw.get("pos_transaction_header")),
                           ["cnt desc", "_dq_flag"], ["_dq_flag", "cnt"]),
    oracle.with_ctes("""SELECT _dq_flag, cnt, row_number() OVER (ORDER BY cnt DESC, _dq_flag) AS position
FROM (SELECT _dq_flag, count(*) AS cnt FROM raw_pos_transaction_header WHERE _dq_flag <> 'CLEAN' GROUP BY 1) x"""))

reg("a16_break_histogram", lambda s, d: profile.break_histogram(models(s, d).raw.get("pos_transaction_header")),
    oracle.with_ctes("""SELECT _dq_flag, count(*) AS cnt FROM raw_pos_transaction_header
WHERE _dq_flag <> 'CLEAN' GROUP BY 1"""))

FLAGGED = ["pos_transaction_header", "pos_tender", "pos_eod_summary", "sap_fi_document", "sap_fi_lineitem",
           "bank_card_settlement", "bank_statement_line", "recon_match_result"]
reg("a16_break_histogram_by_table",
    lambda s, d: profile.break_histogram_by_table({t: models(s, d).raw.get(t) for t in FLAGGED}),
    oracle.with_ctes("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, _dq_flag, count(*) AS cnt FROM raw_{t} WHERE _dq_flag <> 'CLEAN' GROUP BY 2"
        for t in FLAGGED)))

reg("a17_type_status_counts", lambda s, d: profile.type_status_counts(models(s, d).raw.get("recon_match_result")),
    oracle.with_ctes("""SELECT recon_type, match_status, count(*) AS cnt FROM raw_recon_match_result GROUP BY 1, 2"""))

reg("a23_exception_rates", lambda s, d: profile.exception_rates(models(s, d).raw.get("recon_match_result")),
    oracle.with_ctes(f"""
SELECT recon_type, total, exceptions, {oracle.oracle_models.pct('exceptions', 'total')} AS exception_rate_pct
FROM (SELECT recon_type, count(*) AS total, count(CASE WHEN match_status = 'EXCEPTION' THEN 1 END) AS exceptions
      FROM raw_recon_match_result GROUP BY 1
      UNION ALL
      SELECT 'ALL', count(*), count(CASE WHEN match_status = 'EXCEPTION' THEN 1 END) FROM raw_recon_match_result) x"""))

AUDITED = ["dim_country", "dim_store", "dim_tender_type", "dim_bank", "dim_tax_code", "dim_currency",
           "dim_fiscal_calendar", "dim_root_cause", "pos_transaction_header", "pos_tender", "pos_eod_summary", "sap_fi_document",
           "sap_fi_lineitem", "bank_card_settlement", "bank_statement_line", "recon_match_result"]


def stored_paths(s: SparkSession, d: str) -> dict[str, str]:
    """Folders of the loaded tables, loading what isn't there yet."""
    raw = stored_raw(s, d, CFG)
    for t in AUDITED:
        raw.get(t)
    return {t: raw.path(t) for t in AUDITED}


reg("s15_load_audit", lambda s, d: profile.footer_audit(s, stored_paths(s, d)),
    oracle.with_ctes("SELECT table_name, row_count, CAST(CASE WHEN table_name LIKE 'dim_%' THEN 1 "
                     "WHEN table_name LIKE 'pos_%' THEN 2 WHEN table_name LIKE 'sap_%' THEN 3 "
                     "WHEN table_name LIKE 'bank_%' THEN 4 WHEN table_name = 'recon_match_result' THEN 5 END "
                     "AS INTEGER) AS family_rank FROM (\n" + "\nUNION ALL\n".join(
                         f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t}" for t in AUDITED)
                     + ") x"))

reg("o04_load_audit_order",
    lambda s, d: positions(profile.footer_audit(s, stored_paths(s, d), ordered=False),
                           ["family_rank", "row_count desc", "table_name"], ["table_name", "row_count", "family_rank"]),
    f"""SELECT *, row_number() OVER (ORDER BY family_rank, row_count DESC, table_name) AS position
FROM ({ORACLES["s15_load_audit"]}) audit""")


# ---------------------------------------------------------------- CSV load
_LOADING = threading.Lock()


def csv_warehouse(s: SparkSession, d: str) -> dict[str, DataFrame]:
    """The raw tables written as compressed CSV, then loaded, checked and published from it
    (once for each set of input files, also when several queries ask at the same time)."""
    raw = stored_raw(s, d, CFG)
    files, root = f"{raw.root}-csv", f"{raw.root}-loaded"
    with _LOADING:
        for t, schema in RAW_SCHEMAS.items():
            written_once(s, f"{files}/{t}.csv", lambda folder, t=t, schema=schema: write_csv(raw.get(t), folder, schema.fieldNames(), "gzip"))
        return load_warehouse(s, files, root)


def csv_load_audit(s: SparkSession, d: str) -> DataFrame:
    """Rows, filled fields, text lengths and sums of every column of the sixteen
    loaded tables: each table is aggregated to one row, then turned into a row per column."""
    parts = []
    for t, df in csv_warehouse(s, d).items():
        n = F.count(F.lit(1))
        facts = []
        for f in RAW_SCHEMAS[t].fields:
            text, number = f.dataType.typeName() == "string", f.dataType.typeName() in ("integer", "long") or f.dataType.typeName().startswith("decimal")
            facts.append(F.struct(
                F.lit(t).alias("table_name"), F.lit(f.name).alias("column_name"), n.alias("n_rows"), F.count(f.name).alias("n_filled"),
                (F.sum(F.length(f.name)) if text else F.lit(None)).cast("bigint").alias("text_length"),
                (F.sum(F.col(f.name).cast("decimal(28,6)")) if number else F.lit(None)).cast("decimal(38,6)").alias("total")))
        parts.append(df.agg(F.array(*facts).alias("facts")).select(F.inline("facts")))
    return functools.reduce(DataFrame.unionByName, parts)


def loaded_sql(t: str) -> str:
    """A raw table as a CSV load leaves it: text trimmed, blank text NULL (Q28)."""
    cols = [f"nullif(trim({f.name}), '') AS {f.name}" if f.dataType.typeName() == "string" else f.name for f in RAW_SCHEMAS[t].fields]
    return f"SELECT {', '.join(cols)} FROM raw_{t}"


def csv_load_audit_sql() -> str:
    parts = []
    for t, schema in RAW_SCHEMAS.items():
        for f in schema.fields:
            kind = f.dataType.typeName()
            text = f"CAST(sum(length({f.name})) AS BIGINT)" if kind == "string" else "CAST(NULL AS BIGINT)"
            total = (f"CAST(sum(CAST({f.name} AS DECIMAL(28,6))) AS DECIMAL(38,6))"
                     if kind in ("integer", "long") or kind.startswith("decimal") else "CAST(NULL AS DECIMAL(38,6))")
            parts.append(f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, count(*) AS n_rows, count({f.name}) AS n_filled, "
                         f"{text} AS text_length, {total} AS total FROM loaded_{t}")
    loaded = ",\n".join(f"loaded_{t} AS ({loaded_sql(t)})" for t in RAW_SCHEMAS)
    return oracle.with_ctes(f"SELECT * FROM (WITH {loaded}\n" + "\nUNION ALL\n".join(parts) + ") audit")


reg("s03_csv_load_audit", csv_load_audit, csv_load_audit_sql())
for t in ("dim_store", "pos_transaction_header", "sap_fi_document", "bank_statement_line", "recon_match_result"):
    reg(f"s01_csv_{t}", (lambda t: lambda s, d: csv_warehouse(s, d)[t])(t), oracle.with_ctes(loaded_sql(t)))

# ---------------------------------------------------------------- checks
def _check_sql(c: checks.Check) -> str:
    m, col = c.model, c.column
    if c.kind == "not_null":
        cnt = f"(SELECT count(*) FROM {m} WHERE {col} IS NULL)"
    elif c.kind == "accepted_values":
        vals = ", ".join("'" + v.replace("'", "''") + "'" for v in c.values)
        cnt = f"(SELECT count(*) FROM {m} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))"
    elif c.kind == "unique":
        cnt = f"(SELECT count(*) FROM (SELECT {col} FROM {m} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) u)"
    else:
        pm, pc = c.parent
        cnt = (f"(SELECT count(*) FROM {m} ch WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
               f"(SELECT 1 FROM {pm} p WHERE p.{pc} = ch.{col}))")
    tags = ",".join(c.tags)
    if m not in MODEL_NAMES:
        return (f"SELECT '{c.check_id}' AS check_id, '{m}' AS model, '{col}' AS column_name, '{c.kind}' AS kind, "
                f"'{c.severity}' AS severity, '{tags}' AS tags, CAST(NULL AS BIGINT) AS failures, 'SKIPPED' AS status")
    return (f"SELECT '{c.check_id}' AS check_id, '{m}' AS model, '{col}' AS column_name, '{c.kind}' AS kind, "
            f"'{c.severity}' AS severity, '{tags}' AS tags, {cnt} AS failures, "
            f"CASE WHEN {cnt} = 0 THEN 'PASS' WHEN '{c.severity}' = 'warn' THEN 'WARN' ELSE 'ERROR' END AS status")


def check_report(s: SparkSession, d: str, kinds: tuple[str, ...] | None = None, severity: str | None = None):
    """Declared checks over the built models (the ``dbt test`` after a run)."""
    cks = [c for c in checks.catalogue(CFG) if (kinds is None or c.kind in kinds)
           and (severity is None or c.severity == severity)]
    return checks.run_checks(cks, built_models(s, d, CFG), attached=set(MODEL_NAMES))


def check_report_sql(kinds: tuple[str, ...] | None = None, severity: str | None = None) -> str:
    cks = [c for c in checks.catalogue(CFG) if (kinds is None or c.kind in kinds)
           and (severity is None or c.severity == severity)]
    return oracle.with_ctes("\nUNION ALL\n".join(_check_sql(c) for c in cks))


reg("k01_not_null_report", lambda s, d: check_report(s, d, ("not_null",)), check_report_sql(("not_null",)))
reg("k02_unique_report", lambda s, d: check_report(s, d, ("unique",)), check_report_sql(("unique",)))
reg("k03_accepted_values_report", lambda s, d: check_report(s, d, ("accepted_values",)),
    check_report_sql(("accepted_values",)))
reg("k04_relationships_report", lambda s, d: check_report(s, d, ("relationships",)),
    check_report_sql(("relationships",)))
reg("k05_warn_severity_report", lambda s, d: check_report(s, d, severity="warn"), check_report_sql(severity="warn"))
reg("k12_check_report", lambda s, d: check_report(s, d), check_report_sql())

def check_summary_sql() -> str:
    cks = checks.catalogue(CFG)
    body = "\nUNION ALL\n".join(_check_sql(c) for c in cks)
    return oracle.with_ctes(f"SELECT status, count(*) AS n_checks FROM (\n{body}\n) r GROUP BY status")


reg("k12_check_summary", lambda s, d: checks.summarize(check_report(s, d)), check_summary_sql())

reg("k02_lineitem_duplicate_keys",
    lambda s, d: checks.unique_violations(s.read.parquet(f"{d}/lineitem.parquet"), ["l_orderkey", "l_linenumber"]),
    """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")

reg("k06_sox_maker_checker", lambda s, d: checks.sox_maker_checker(models(s, d).raw.get("recon_match_result")),
    oracle.with_ctes("""SELECT match_id, preparer_id, reviewer_id, recon_date, country_code
FROM raw_recon_match_result WHERE preparer_id = reviewer_id"""))

reg("k07_no_future_dated_transactions",
    lambda s, d: checks.no_future_dated_transactions(models(s, d).stg_pos_transaction_header, CFG),
    oracle.with_ctes("""SELECT pos_txn_id, business_date, country_code, store_id, _dq_flag
FROM stg_pos_transaction_header WHERE business_date > DATE '2001-12-31'"""))

reg("k08_variance_within_bounds",
    lambda s, d: checks.variance_within_bounds(models(s, d).int_pos_sap_matched, models(s, d).stg_dim_country, CFG),
    oracle.with_ctes("""SELECT match_id, country_code, match_type, variance_pos_sap, threshold_applied, variance_threshold_t3
FROM int_pos_sap_matched JOIN stg_dim_country USING (country_code)
WHERE match_type = 'ESCALATE' AND abs(variance_pos_sap) <= variance_threshold_t3"""))

reg("k09_post_staging_checks",
    lambda s, d: checks.singular_report(models(s, d), models(s, d).raw, CFG, checks.select_singular(tag="post_staging")),
    oracle.with_ctes("""SELECT 'test_variance_within_bounds' AS check_id, 'intermediate,post_staging' AS tags,
       count(*) AS failures, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'ERROR' END AS status
FROM int_pos_sap_matched JOIN stg_dim_country USING (country_code)
WHERE match_type = 'ESCALATE' AND abs(variance_pos_sap) <= variance_threshold_t3"""))


def declared_key_report(s: SparkSession, d: str) -> DataFrame:
    """Duplicate declared keys per raw table, all tables in one shuffle."""
    raw = models(s, d).raw
    dup = checks.key_failures([(raw.get(t), [checks.KeyUse(i, keys, "unique")]) for i, (t, keys) in enumerate(PRIMARY_KEYS.items())])
    meta = s.createDataFrame([(i, t, ",".join(k)) for i, (t, k) in enumerate(PRIMARY_KEYS.items())],
                             "idx int, table_name string, key_columns string")
    return (meta.join(F.broadcast(dup), "idx", "left")
                .select("table_name", "key_columns", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("duplicate_keys")))


def declared_key_sql() -> str:
    sel = []
    for t, keys in PRIMARY_KEYS.items():
        k = ", ".join(keys)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
        sel.append(f"SELECT '{t}' AS table_name, '{','.join(keys)}' AS key_columns, "
                   f"(SELECT count(*) FROM (SELECT {k} FROM raw_{t} WHERE {nn} GROUP BY {k} HAVING count(*) > 1) x)"
                   f" AS duplicate_keys")
    return oracle.with_ctes("\nUNION ALL\n".join(sel))


reg("k10_declared_keys", declared_key_report, declared_key_sql())


def declared_fk_report(s: SparkSession, d: str) -> DataFrame:
    """Rows without a parent per declared foreign key, all in one shuffle; every table is scanned once."""
    raw, uses = models(s, d).raw, {}
    for i, (child, cols, parent, pcols) in enumerate(FOREIGN_KEYS):
        uses.setdefault(child, []).append(checks.KeyUse(i, cols, "child"))
        uses.setdefault(parent, []).append(checks.KeyUse(i, pcols, "parent"))
    lost = checks.key_failures([(raw.get(t), u) for t, u in uses.items()])
    meta = s.createDataFrame([(i, c, ",".join(cols), p) for i, (c, cols, p, _) in enumerate(FOREIGN_KEYS)],
                             "idx int, child_table string, child_columns string, parent_table string")
    return (meta.join(F.broadcast(lost), "idx", "left")
                .select("child_table", "child_columns", "parent_table", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("orphans")))


def declared_fk_sql() -> str:
    sel = []
    for child, cols, parent, pcols in FOREIGN_KEYS:
        nn = " AND ".join(f"c.{x} IS NOT NULL" for x in cols)
        eq = " AND ".join(f"p.{pc} = c.{x}" for x, pc in zip(cols, pcols))
        sel.append(f"SELECT '{child}' AS child_table, '{','.join(cols)}' AS child_columns, '{parent}' AS parent_table, "
                   f"(SELECT count(*) FROM raw_{child} c WHERE {nn} AND NOT EXISTS "
                   f"(SELECT 1 FROM raw_{parent} p WHERE {eq})) AS orphans")
    return oracle.with_ctes("\nUNION ALL\n".join(sel))


reg("k11_declared_foreign_keys", declared_fk_report, declared_fk_sql())

reg("k13_maker_checker_tally", lambda s, d: checks.maker_checker_tally(models(s, d).raw.get("recon_match_result")),
    oracle.with_ctes("""SELECT *, same_person = 0 AS assertion_passed
FROM (SELECT count(*) AS total_exceptions, count(preparer_id) AS with_preparer, count(reviewer_id) AS with_reviewer,
             count(*) FILTER (preparer_id = reviewer_id) AS same_person
      FROM raw_recon_match_result WHERE match_status = 'EXCEPTION')"""))


# ---------------------------------------------------------------- optional fixes
reg("x15_recon_summary_all_fixes", lambda s, d: models(s, d, CFG_FIXED).mart_recon_summary,
    oracle.select_all("mart_recon_summary_fx"))
reg("x18_exception_log_all_fixes", lambda s, d: models(s, d, CFG_FIXED).mart_exception_log,
    oracle.select_all("mart_exception_log_fx"))
reg("x20_store_enriched_all_fixes", lambda s, d: models(s, d, CFG_FIXED).dim_store_enriched,
    oracle.select_all("dim_store_enriched_fx"))


# ---------------------------------------------------------------- scale variant (lineitem-sized ledger)
def sales_by_store_date_lineitem_ledger(s: SparkSession, d: str) -> DataFrame:
    """M12 over ledger lines built from lineitem (FIXTURES scale variant)."""
    from ledgerloom.operators import match, staging
    m = models(s, d)
    lines = staging.stg_sap_fi_lineitem(m.raw.get("sap_fi_lineitem_from_lineitem"))
    return match.int_sap_sales_by_store_date(lines, m.stg_sap_fi_document, m.stg_pos_transaction_header,
                                             m.stg_dim_store, CFG)


reg("m12_sales_by_store_date_lineitem_ledger", sales_by_store_date_lineitem_ledger,
    oracle.select_all("int_sap_sales_by_store_date_scale"))
reg("d09_sap_fi_lineitem_from_lineitem", lambda s, d: lazy(s, d).get("sap_fi_lineitem_from_lineitem"),
    oracle.select_all("raw_sap_fi_lineitem_from_lineitem"))


# ---------------------------------------------------------------- Spark SQL over model views
CAUSE_SHARE_SQL = """
SELECT root_cause_code,
       CAST(SUM(exception_count) AS BIGINT) AS total_exceptions,
       CAST(ROUND(CAST(CAST(SUM(exception_count) AS DOUBLE)
                       / NULLIF(CAST(SUM(SUM(exception_count)) OVER () AS DOUBLE), 0) * 100.0 AS DECIMAL(18,6)), 2)
            AS DECIMAL(18,2)) AS pareto_pct
FROM mart_root_cause_trend
WHERE root_cause_code <> 'UNCLASSIFIED'
GROUP BY root_cause_code"""


def cause_share_sql(s: SparkSession, d: str) -> DataFrame:
    """W05 in SQL form: an aggregate inside a window, over the trend mart
    registered as a view (S09)."""
    from ledgerloom.plans.build import register_views
    register_views(models(s, d), ["mart_root_cause_trend"])
    return s.sql(CAUSE_SHARE_SQL)


reg("w05_cause_share_sql_view", cause_share_sql, oracle.with_ctes(CAUSE_SHARE_SQL))
