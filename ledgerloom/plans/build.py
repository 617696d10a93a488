"""Full build of the 23 models (the equivalent of a ``dbt run``).

Layer order: staging (lazy views) → intermediate → marts → dimensions.
The two intermediate reconciliations are each read by four downstream
models, so they are written once as tables in the output folder and read
back (lineage cut, nothing recomputed, and a lost executor only re-runs
tasks of the current stage). Every model is published as a new version of
the table ``<out>/<layer>/<model>`` (see :mod:`ledgerloom.sources.tables`),
so readers see a whole old or a whole new table; models that don't read one
another are built at the same time.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.config import ReconConfig
from ledgerloom.operators import dims, marts, match
from ledgerloom.plans.models import MODEL_NAMES, Models
from ledgerloom.sources.io import save_table
from ledgerloom.sources.raw import stored_raw
from ledgerloom.sources.tables import current_version, publish

LAYERS = {
    "intermediate": ["int_sap_sales_by_store_date", "int_pos_sap_matched", "int_pay_bank_matched"],
    "marts": ["mart_recon_summary", "mart_pos_sap_detail", "mart_pay_bank_detail", "mart_exception_log",
              "mart_root_cause_trend"],
    "dimensions": ["dim_store_enriched", "dim_country_enriched", "dim_root_cause_enriched",
                   "dim_tender_type_enriched"],
}

#: Models whose rows are kept in order (O01-O03), with ties broken by their own columns.
ORDERS = {
    "mart_exception_log": ["recon_date desc", "abs_variance desc", "match_id"],
    "mart_root_cause_trend": ["country_code", "recon_year", "recon_month", "exception_count desc",
                              "recon_type", "period_key", "root_cause_code"],
    "dim_root_cause_enriched": ["pareto_rank", "root_cause_code"],
}


def run_models(spark: SparkSession, sf_dir: str, out_root: str, cfg: ReconConfig | None = None,
               timings: dict | None = None, parallel: int = 4) -> dict[str, str]:
    """Build and publish every model; returns ``name -> folder of its version``.

    A model starts as soon as the tables it reads are published, up to
    ``parallel`` at a time; with the FAIR scheduler each has a pool of its own.
    When one fails, those that read it are not built, and the error is raised
    after the others have ended; every table keeps its last complete version.
    """
    cfg = cfg or ReconConfig()
    m = Models(stored_raw(spark, sf_dir, cfg), cfg)
    for name in ("recon_match_result", "dim_country", "dim_store", "dim_root_cause", "dim_tender_type"):
        m.raw.get(name)  # loaded here, not by several models at once
    read = spark.read.parquet
    # name -> (layer, tables it reads, its plan over them)
    steps = {
        "int_sap_sales_by_store_date": ("intermediate", [], lambda: m.int_sap_sales_by_store_date),
        "int_pay_bank_matched": ("intermediate", [], lambda: m.int_pay_bank_matched),
        "dim_tender_type_enriched": ("dimensions", [], lambda: dims.dim_tender_type_enriched(m.stg_dim_tender_type)),
        "int_pos_sap_matched": ("intermediate", ["int_sap_sales_by_store_date"], lambda sales: match.int_pos_sap_matched(
            m.stg_pos_eod_summary, sales, m.stg_dim_country, cfg)),
        "mart_pay_bank_detail": ("marts", ["int_pay_bank_matched"], lambda pay: marts.mart_pay_bank_detail(
            pay, m.stg_dim_country, m.stg_dim_root_cause, cfg)),
        "mart_recon_summary": ("marts", ["int_pos_sap_matched", "int_pay_bank_matched"], lambda pos, pay: marts.mart_recon_summary(
            pos, pay, m.stg_dim_store, cfg)),
        "mart_pos_sap_detail": ("marts", ["int_pos_sap_matched"], lambda pos: marts.mart_pos_sap_detail(
            pos, m.stg_dim_store, m.stg_dim_country, m.stg_dim_root_cause, cfg)),
        "mart_exception_log": ("marts", ["int_pos_sap_matched", "int_pay_bank_matched"], lambda pos, pay: marts.mart_exception_log(
            pos, pay, m.stg_dim_store, m.stg_dim_root_cause, m.raw.get("recon_match_result"), cfg, ordered=False)),
        "mart_root_cause_trend": ("marts", ["int_pos_sap_matched", "int_pay_bank_matched"], lambda pos, pay: marts.mart_root_cause_trend(
            pos, pay, m.stg_dim_root_cause, cfg, ordered=False)),
        "dim_store_enriched": ("dimensions", ["mart_recon_summary"], lambda s: dims.dim_store_enriched(m.stg_dim_store, s, cfg)),
        "dim_country_enriched": ("dimensions", ["mart_recon_summary"], lambda s: dims.dim_country_enriched(m.stg_dim_country, s, cfg)),
        "dim_root_cause_enriched": ("dimensions", ["mart_root_cause_trend"], lambda t: dims.dim_root_cause_enriched(
            m.stg_dim_root_cause, t, cfg, ordered=False)),
    }
    running: dict[str, Future] = {}

    def build(name: str) -> str:
        layer, reads, plan = steps[name]
        inputs = [read(running[r].result()) for r in reads]
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        t = time.time()
        path = publish(plan(*inputs), out_root, layer, name, ORDERS.get(name))
        if timings is not None:
            timings[name] = time.time() - t
        return path

    # steps stand in dependency order, so a model waits only for ones submitted before it
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        running.update((name, Future()) for name in steps)
        for name in steps:
            pool.submit(_settle, running[name], build, name)
    return {name: running[name].result() for name in steps}


def _settle(future: Future, work: Callable[[str], str], name: str) -> None:
    try:
        future.set_result(work(name))
    except BaseException as error:  # noqa: BLE001 - handed to whoever waits
        future.set_exception(error)


_BUILT: dict[tuple, dict[str, str]] = {}
_READ: dict[tuple, dict[str, DataFrame]] = {}


def built_models(spark: SparkSession, sf_dir: str, cfg: ReconConfig | None = None):
    """Models as a check suite sees them after a build: intermediate, mart
    and dimension models read from their written tables (built once per
    session into the shared checkpoint folder), staging models as views over
    the stored raw tables. Returns ``name -> DataFrame``."""
    import hashlib

    from ledgerloom.session import ensure_checkpoint_dir, session_key
    from ledgerloom.sources.raw import _code_digest, store_root
    cfg = cfg or ReconConfig()
    ensure_checkpoint_dir(spark)
    root = store_root(spark, sf_dir.rstrip("/"), cfg)  # names the input files: rewritten inputs are built anew
    key = (session_key(spark), root, cfg)
    if key not in _BUILT:
        code = _code_digest(("operators/staging.py", "operators/match.py", "operators/marts.py",
                             "operators/dims.py", "operators/joins.py", "plans/models.py", "plans/build.py",
                             "sources/tables.py"))
        opts = hashlib.sha1((repr(cfg) + code).encode()).hexdigest()[:12]
        out = f"{root}-models-{opts}"
        built = {n: current_version(spark, out, layer, n) for layer, names in LAYERS.items() for n in names}
        if all(built.values()):
            _BUILT[key] = built             # built by an earlier session with the same code
        else:
            _BUILT[key] = run_models(spark, sf_dir, out, cfg)
    if key not in _READ:
        m = Models(stored_raw(spark, sf_dir, cfg), cfg)
        _READ[key] = {n: spark.read.parquet(p) for n, p in _BUILT[key].items()} | {n: m.model(n) for n in MODEL_NAMES if n not in _BUILT[key]}
    return _READ[key].__getitem__


def register_views(models: Models, names: list[str] | None = None) -> list[str]:
    """Expose models as session views (``ref`` by name from Spark SQL)."""
    names = names or MODEL_NAMES
    for n in names:
        models.model(n).createOrReplaceTempView(n)
    return names


def build_and_test(spark: SparkSession, sf_dir: str, out_root: str, cfg: ReconConfig | None = None) -> dict:
    """Load, build every model and run the declared check suite (the
    ``dbt build`` equivalent); the check report is written as a table too."""
    from ledgerloom.operators import checks
    cfg = cfg or ReconConfig()
    t = time.time()
    stored_raw(spark, sf_dir, cfg).load_all()
    load = time.time() - t
    timings: dict = {}
    paths = run_models(spark, sf_dir, out_root, cfg, timings)
    m = Models(stored_raw(spark, sf_dir, cfg), cfg)

    def get(name: str) -> DataFrame:
        return spark.read.parquet(paths[name]) if name in paths else m.model(name)
    report = checks.run_checks(checks.catalogue(cfg), get, attached=set(MODEL_NAMES))
    report_path = save_table(report, out_root, "checks", "check_results")
    summary = {r.status: r.n_checks for r in checks.summarize(spark.read.parquet(report_path)).collect()}
    return {"load_sec": round(load, 2), "models": {k: round(v, 2) for k, v in timings.items()},
            "checks": summary, "out": out_root}


if __name__ == "__main__":
    import argparse
    import json

    from ledgerloom.session import build_session
    ap = argparse.ArgumentParser(description="Build the reconciliation models and run the checks.")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--master", default=None)
    a = ap.parse_args()
    print(json.dumps(build_and_test(build_session(a.master), a.sf_dir, a.out)))
