"""Data-quality checks K01–K13.

A check is a query for violating rows; zero rows passes. Generic checks
(not_null, unique, accepted_values, relationships) are declared per model
column in :data:`CATALOGUE`; singular checks are functions returning the
violating rows. :func:`run_checks` evaluates many checks with one aggregate
pass for the row-wise kinds and one for all keys (unique and relationships),
and returns one result table (K12): check id, model, column, kind, severity,
tags, failures, status.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.config import ReconConfig

COUNTRIES = "$COUNTRIES"   # replaced by cfg.countries
COMPANIES = "$COMPANIES"   # replaced by cfg.company_codes

# --- fixed values: the declared column checks, per model --------------------
# "column:kind[:values | :parent_model.parent_column][:warn]"
CATALOGUE: dict[str, list[str]] = {
    "stg_pos_eod_summary": [
        "eod_summary_id:unique", "eod_summary_id:not_null", "country_code:not_null",
        f"country_code:accepted_values:{COUNTRIES}", "store_id:not_null", "business_date:not_null",
        "net_sales:not_null"],
    "stg_pos_transaction_header": [
        "pos_txn_id:unique", "pos_txn_id:not_null", "country_code:not_null",
        f"country_code:accepted_values:{COUNTRIES}", "store_id:not_null::warn",
        "store_id:relationships:stg_dim_store.store_id", "txn_type:accepted_values:SALE,RETURN,VOID",
        "total_tendered:not_null"],
    "stg_pos_tender": [
        "pos_tender_id:unique::warn", "pos_tender_id:not_null", "pos_txn_id:not_null",
        "pos_txn_id:relationships:stg_pos_transaction_header.pos_txn_id", "tender_code:not_null",
        "tender_amount:not_null"],
    "stg_sap_fi_document": [
        "belnr:not_null", "bukrs:not_null", f"bukrs:accepted_values:{COMPANIES}", "posting_date:not_null",
        "country_code:not_null", f"country_code:accepted_values:{COUNTRIES}"],
    "stg_sap_fi_lineitem": [
        "belnr:not_null", "shkzg:not_null", "shkzg:accepted_values:S,H", "dmbtr:not_null"],
    "stg_bank_card_settlement": [
        "settlement_id:not_null", "country_code:not_null", f"country_code:accepted_values:{COUNTRIES}",
        "gross_amount:not_null", "net_settlement:not_null"],
    "stg_bank_statement_line": [
        "statement_line_id:unique", "statement_line_id:not_null", "country_code:not_null",
        f"country_code:accepted_values:{COUNTRIES}", "amount:not_null"],
    "stg_dim_country": [
        "country_code:unique", "country_code:not_null", f"country_code:accepted_values:{COUNTRIES}",
        "variance_threshold_t2:not_null", "variance_threshold_t3:not_null"],
    "stg_dim_store": [
        "store_id:unique", "store_id:not_null", "country_code:not_null",
        f"country_code:accepted_values:{COUNTRIES}"],
    "stg_dim_root_cause": ["root_cause_code:unique", "root_cause_code:not_null"],
    "stg_dim_tender_type": [
        "tender_code:unique", "tender_code:not_null", "country_code:not_null",
        f"country_code:accepted_values:{COUNTRIES},BOTH", "tender_category:not_null",
        "tender_category:accepted_values:CASH,CARD,EWALLET,VOUCHER,BNPL", "settlement_lag_days:not_null",
        "interchange_rate_pct:not_null"],
    "int_sap_sales_by_store_date": [
        "country_code:not_null", f"country_code:accepted_values:{COUNTRIES}", "sap_profit_centre:not_null",
        "sap_posting_date:not_null", "sap_posted_revenue:not_null"],
    "int_pos_sap_matched": [
        "match_id:unique", "match_id:not_null", "recon_type:not_null", "recon_type:accepted_values:POS_SAP",
        "country_code:not_null", f"country_code:accepted_values:{COUNTRIES}",
        "match_type:accepted_values:EXACT,TOLERANCE,REVIEW,ESCALATE,UNMATCHED", "match_type:not_null",
        "match_status:not_null", "match_status:accepted_values:MATCHED,EXCEPTION", "pos_amount:not_null",
        "variance_pos_sap:not_null"],
    "int_pay_bank_matched": [
        "match_id:unique", "match_id:not_null", "recon_type:not_null", "recon_type:accepted_values:PAY_BANK",
        "match_type:not_null", "match_type:accepted_values:EXACT,TOLERANCE,FEE_VARIANCE,UNMATCHED,REVIEW",
        "match_status:not_null", "match_status:accepted_values:MATCHED,EXCEPTION"],
    "mart_recon_summary": [
        "match_id:unique", "match_id:not_null", "recon_type:not_null",
        "recon_type:accepted_values:POS_SAP,PAY_BANK", "country_code:not_null", "recon_date:not_null",
        "match_status:not_null", "match_status:accepted_values:MATCHED,EXCEPTION", "match_type:not_null",
        "match_type:accepted_values:EXACT,TOLERANCE,REVIEW,ESCALATE,UNMATCHED,FEE_VARIANCE"],
    "mart_pos_sap_detail": [
        "match_id:unique", "match_id:not_null", "store_id:not_null", "pos_amount:not_null",
        "match_status:not_null", "match_status:accepted_values:MATCHED,EXCEPTION"],
    "mart_pay_bank_detail": [
        "match_id:unique", "match_id:not_null", "aging_bucket:not_null",
        "aging_bucket:accepted_values:Current,T+1 Overdue,T+2 Overdue,>T+2 Overdue",
        "settlement_timing_status:accepted_values:ON TIME,OVERDUE"],
    "mart_exception_log": [
        "match_id:unique", "match_id:not_null", "severity:not_null",
        "severity:accepted_values:NEW,MEDIUM,HIGH,CRITICAL", "sla_status:not_null",
        "sla_status:accepted_values:Within SLA,SLA BREACHED", "review_status:not_null",
        "review_status:accepted_values:REVIEWED,PENDING REVIEW"],
    "mart_root_cause_trend": [
        "country_code:not_null", "period_key:not_null", "root_cause_code:not_null", "exception_count:not_null",
        "match_rate_pct:not_null"],
    "dim_store_enriched": [
        "store_id:unique", "store_id:not_null", "health_status:not_null",
        "health_status:accepted_values:CLEAR,MONITOR,ESCALATE", "health_score:not_null"],
    "dim_country_enriched": ["country_code:unique", "country_code:not_null"],
    "dim_root_cause_enriched": ["root_cause_code:unique", "root_cause_code:not_null", "pareto_rank:not_null"],
    # declared on a model name that does not exist: attached to nothing (Q23)
    "dim_tender_type": [
        "tender_code:unique", "tender_code:not_null", "country_code:not_null",
        f"country_code:accepted_values:{COUNTRIES},BOTH", "tender_category:not_null",
        "tender_category:accepted_values:CASH,CARD,EWALLET,VOUCHER,BNPL", "settlement_lag_days:not_null",
        "is_instant_settlement:not_null"],
}
# -----------------------------------------------------------------------------

LAYER_TAG = {"stg": "staging", "int": "intermediate", "mar": "marts", "dim": "dimensions"}


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str                      # not_null | unique | accepted_values | relationships
    values: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    severity: str = "error"
    tags: tuple[str, ...] = field(default_factory=tuple)

    @property
    def check_id(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.parent[0]}_{self.parent[1]}"
        return f"{self.kind}_{self.model}_{self.column}"


def catalogue(cfg: ReconConfig, models: list[str] | None = None) -> list[Check]:
    """The declared checks with the configured country / company lists."""
    out = []
    for model, specs in CATALOGUE.items():
        if models is not None and model not in models:
            continue
        for spec in specs:
            parts = spec.split(":")
            col, kind = parts[0], parts[1]
            arg = parts[2] if len(parts) > 2 else ""
            sev = parts[3] if len(parts) > 3 and parts[3] else "error"
            values, parent = (), None
            if kind == "accepted_values":
                arg = arg.replace(COUNTRIES, ",".join(cfg.countries)).replace(COMPANIES, ",".join(cfg.company_codes))
                values = tuple(arg.split(","))
            elif kind == "relationships":
                pm, pc = arg.split(".")
                parent = (pm, pc)
            out.append(Check(model, col, kind, values, parent, sev, (LAYER_TAG.get(model[:3], "other"),)))
    return out


def violation_condition(check: Check) -> Column:
    """Row predicate for the row-wise kinds (NULLs pass accepted_values)."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(check.values))
    raise ValueError(check.kind)


def violation_sql(check: Check) -> str:
    """The same predicate as SQL text."""
    if check.kind == "not_null":
        return f"`{check.column}` IS NULL"
    values = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in check.values)
    return f"`{check.column}` IS NOT NULL AND `{check.column}` NOT IN ({values})"


def violations(check: Check, df: DataFrame, parent_df: DataFrame | None = None) -> DataFrame:
    """The violating rows (or duplicated keys) of one check."""
    if check.kind in ("not_null", "accepted_values"):
        return df.filter(violation_condition(check))
    if check.kind == "unique":
        return unique_violations(df, [check.column])
    if check.kind == "relationships":
        return relationship_violations(df, [check.column], parent_df, [check.parent[1]])
    raise ValueError(check.kind)


def unique_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keys (all non-NULL) that occur more than once, with counts."""
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (df.filter(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def relationship_violations(child: DataFrame, cols: list[str], parent: DataFrame, pcols: list[str]) -> DataFrame:
    """Child rows whose non-NULL key has no parent (anti join).

    The parent keys are not size-checked up front (that would be a second
    full pass over a possibly large parent); AQE broadcasts them at runtime
    when they turn out small and keeps the shuffle join otherwise."""
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    keys = parent.select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(pcols)])
    cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__p{i}") for i, c in enumerate(cols)])
    return child.filter(nn).join(keys, cond, "left_anti")


def _status(failures: Column, severity: Column) -> Column:
    return (F.when(failures == 0, F.lit("PASS"))
             .when(severity == "warn", F.lit("WARN")).otherwise(F.lit("ERROR")))


RESULT_SCHEMA = ("check_id string, model string, column_name string, kind string, severity string, "
                 "tags string, failures bigint, status string")


@dataclass(frozen=True)
class KeyUse:
    """Columns of a table that take part in key check ``idx``: as its ``unique``
    key, as the ``child`` columns of a relationship or as their ``parent``."""
    idx: int
    columns: tuple[str, ...]
    role: str


def key_failures(tables: list[tuple[DataFrame, list[KeyUse]]]) -> DataFrame:
    """All unique and relationship checks in one shuffle, as (idx, n) rows.

    Every table is scanned once, whatever its parts in the checks: each row
    emits (check, key, in the parent?) for every use of its columns whose key
    has no NULL. Grouped by check and key, a unique key that occurs more than
    once counts one violation, and a child key without a parent row counts all
    its child rows; the counts are combined before the exchange, so a hot key
    is one row a task. Keys keep their types: the uses of one key type form one
    stream of the union, in which the other types' columns are empty.
    """
    kinds: dict[tuple, str] = {}
    uses_by_kind = []
    for df, uses in tables:
        alike = [(use, _common(tuple(df.schema[c].dataType for c in use.columns))) for use in uses]
        uses_by_kind.append((df, alike))
        for _, kind in alike:
            kinds.setdefault(kind, f"k{len(kinds)}")
    shape = {name: f"struct<{','.join(f'c{i}:{t.simpleString()}' for i, t in enumerate(kind))}>" for kind, name in kinds.items()}
    rows = []
    # written as SQL text: a plan of hundreds of columns is built in a few calls
    for df, alike in uses_by_kind:
        made = []
        for use, kind in alike:
            whole = " AND ".join(f"`{c}` IS NOT NULL" for c in use.columns)
            key = ", ".join(f"'c{i}', CAST(`{c}` AS {t.simpleString()})" for i, (c, t) in enumerate(zip(use.columns, kind)))
            keys = ", ".join(f"'{name}', " + (f"named_struct({key})" if name == kinds[kind] else f"CAST(NULL AS {t})") for name, t in shape.items())
            made.append(f"CASE WHEN {whole} THEN named_struct('idx', {use.idx}, 'alone', {use.role == 'unique'}, "
                        f"'known', {use.role == 'parent'}, {keys}) END")
        each = f"explode(array({', '.join(made)}))" if len(made) > 1 else made[0]
        rows.append(df.selectExpr(f"{each} AS e").where("e IS NOT NULL").select("e.*"))
    grouped = reduce(DataFrame.unionByName, rows).groupBy("idx", "alone", *shape).agg(
        F.max("known").alias("known"), F.sum(F.when(F.col("known"), F.lit(0)).otherwise(F.lit(1))).alias("n"))
    wrong = grouped.where(F.when(F.col("alone"), F.col("n") > 1).otherwise(~F.col("known")))
    return wrong.groupBy("idx").agg(F.sum(F.when(F.col("alone"), F.lit(1)).otherwise(F.col("n"))).cast("bigint").alias("n"))


def _common(kind: tuple) -> tuple:
    """Key types that meet: whole numbers of any width are compared as bigint."""
    return tuple(T.LongType() if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)) else t for t in kind)


def _rowwise_counts(per_model: list[tuple[DataFrame, list[tuple[int, Check]]]]) -> DataFrame:
    """All not_null / accepted_values checks of all models in one shuffle: a
    row becomes its model's number and one 0/1 flag a check, side by side, and
    the flags are summed per model. The sums are combined map-side, so the
    exchange carries one row per model and task; they are turned into a row per
    check only after that."""
    width = max(len(cks) for _, cks in per_model)
    streams = []
    # written as SQL text: a plan of hundreds of columns is built in a few calls
    for m, (df, cks) in enumerate(per_model):
        flags = [f"CASE WHEN {violation_sql(c)} THEN 1 ELSE 0 END" for _, c in cks] + ["0"] * (width - len(cks))
        streams.append(df.selectExpr(f"{m} AS model", *[f"{flag} AS f{i}" for i, flag in enumerate(flags)]))
    sums = reduce(DataFrame.unionByName, streams).groupBy("model").agg(
        F.expr(f"array({', '.join(f'sum(f{i})' for i in range(width))})").alias("sums"))
    # the check's number by (model, place); -1 pads models with fewer checks
    numbers = [f"array({', '.join(map(str, [i for i, _ in cks] + [-1] * (width - len(cks))))})" for _, cks in per_model]
    return (sums.selectExpr(f"inline(arrays_zip(element_at(array({', '.join(numbers)}), model + 1), sums))")
                .toDF("idx", "n").where("idx >= 0"))


def run_checks(checks: list[Check], model_df, attached: set[str] | None = None) -> DataFrame:
    """Evaluate ``checks`` and return the K12 result table.

    The whole suite is two shuffles of rows, whatever the number of models:
    one for every not_null / accepted_values check (each model scanned once)
    and one for every unique and relationship check (each model scanned once
    more, see :func:`key_failures`). Models are best given as built tables (see
    :func:`ledgerloom.plans.build.built_models`), so each scan reads only
    the checked columns. ``model_df(name)`` returns a model's DataFrame;
    checks on names outside ``attached`` are reported SKIPPED, as a
    declaration on a missing model runs nothing.
    """
    runnable = [(i, c) for i, c in enumerate(checks) if attached is None or c.model in attached]
    models: dict[str, DataFrame] = {}
    for _, c in runnable:
        if c.model not in models:
            models[c.model] = model_df(c.model)
    spark = next(iter(models.values())).sparkSession if models else None

    def by_model(kinds):
        groups: dict[str, list[tuple[int, Check]]] = {}
        for i, c in runnable:
            if c.kind in kinds:
                groups.setdefault(c.model, []).append((i, c))
        return [(models[m], cks) for m, cks in groups.items()]

    counts = []
    rowwise = by_model(("not_null", "accepted_values"))
    if rowwise:
        counts.append(_rowwise_counts(rowwise))
    uses: dict[str, list[KeyUse]] = {}
    for i, c in runnable:
        if c.kind == "unique":
            uses.setdefault(c.model, []).append(KeyUse(i, (c.column,), "unique"))
        elif c.kind == "relationships":
            uses.setdefault(c.model, []).append(KeyUse(i, (c.column,), "child"))
            uses.setdefault(c.parent[0], []).append(KeyUse(i, (c.parent[1],), "parent"))
    if uses:
        counts.append(key_failures([(models.get(m) if m in models else model_df(m), u) for m, u in uses.items()]))
    # one metadata row per declared check (bounded by the catalogue, not the data)
    runnable_idx = {i for i, _ in runnable}
    meta = [(i, c.check_id, c.model, c.column, c.kind, c.severity, ",".join(c.tags), i in runnable_idx)
            for i, c in enumerate(checks)]
    if spark is None:
        raise ValueError("no attached model to check")
    meta_df = spark.createDataFrame(meta, "idx int, check_id string, model string, column_name string, "
                                          "kind string, severity string, tags string, runs boolean")
    found = reduce(DataFrame.unionByName, counts) if counts else None
    out = meta_df.join(F.broadcast(found), "idx", "left") if found is not None else meta_df.withColumn("n", F.lit(None))
    failures = F.when(F.col("runs"), F.coalesce(F.col("n"), F.lit(0))).cast("bigint")
    status = F.when(~F.col("runs"), F.lit("SKIPPED")).otherwise(_status(failures, F.col("severity")))
    return out.select("check_id", "model", "column_name", "kind", "severity", "tags",
                      failures.alias("failures"), status.alias("status"))


def summarize(report: DataFrame) -> DataFrame:
    """K12 totals: PASS / WARN / ERROR / SKIPPED counts."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))


# ------------------------------------------------------------ singular checks
def sox_maker_checker(recon_result: DataFrame) -> DataFrame:
    """Preparer and reviewer are the same person."""
    return recon_result.filter(F.col("preparer_id").isNotNull() & F.col("reviewer_id").isNotNull()
                               & (F.col("preparer_id") == F.col("reviewer_id"))).select(
        "match_id", "preparer_id", "reviewer_id", "recon_date", "country_code")


def no_future_dated_transactions(stg_header: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Business dates after the as-of date."""
    return stg_header.filter(F.col("business_date") > F.lit(cfg.as_of_str).cast("date")).select(
        "pos_txn_id", "business_date", "country_code", "store_id", "_dq_flag")


def variance_within_bounds(pos_sap: DataFrame, stg_country: DataFrame, cfg: ReconConfig) -> DataFrame:
    """ESCALATE rows whose |variance| does not exceed t3."""
    c = stg_country.select("country_code", "variance_threshold_t3")
    return (pos_sap.filter(F.col("match_type") == "ESCALATE").join(c, "country_code")
                   .filter(F.abs("variance_pos_sap") <= F.col("variance_threshold_t3"))
                   .select("match_id", "country_code", "match_type", "variance_pos_sap", "threshold_applied",
                           "variance_threshold_t3"))


# Singular checks carry tags and an enable flag; selection by tag.
SINGULAR = {
    "test_sox_maker_checker": {"tags": ("singular",), "enabled": True},
    "test_no_future_dated_transactions": {"tags": ("singular", "staging"), "enabled": True},
    "test_variance_within_bounds": {"tags": ("intermediate", "post_staging"), "enabled": True},
}


def select_singular(tag: str | None = None, exclude: str | None = None) -> list[str]:
    names = []
    for name, meta in SINGULAR.items():
        if not meta["enabled"]:
            continue
        if tag and tag not in meta["tags"]:
            continue
        if exclude and exclude in meta["tags"]:
            continue
        names.append(name)
    return names


def singular_report(models, raw, cfg: ReconConfig, names: list[str]) -> DataFrame:
    """Failures of the selected singular checks as result rows."""
    builders = {
        "test_sox_maker_checker": lambda: sox_maker_checker(raw.get("recon_match_result")),
        "test_no_future_dated_transactions": lambda: no_future_dated_transactions(
            models.stg_pos_transaction_header, cfg),
        "test_variance_within_bounds": lambda: variance_within_bounds(
            models.int_pos_sap_matched, models.stg_dim_country, cfg),
    }
    parts = []
    for n in names:
        v = builders[n]().agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
        parts.append(v.select(F.lit(n).alias("check_id"), F.lit(",".join(SINGULAR[n]["tags"])).alias("tags"),
                              "failures", _status(F.col("failures"), F.lit("error")).alias("status")))
    return reduce(DataFrame.unionByName, parts)


def maker_checker_tally(recon_result: DataFrame) -> DataFrame:
    """Maker-checker tally over exceptions, with the zero-violation
    assertion as a column (same_person must be 0)."""
    exc = recon_result.filter(F.col("match_status") == "EXCEPTION")
    return exc.agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.count(F.when(F.col("preparer_id").isNotNull(), 1)).alias("with_preparer"),
        F.count(F.when(F.col("reviewer_id").isNotNull(), 1)).alias("with_reviewer"),
        F.count(F.when(F.col("preparer_id") == F.col("reviewer_id"), 1)).alias("same_person"),
    ).withColumn("assertion_passed", F.col("same_person") == 0)
