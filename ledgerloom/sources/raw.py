"""The sixteen raw tables as DataFrames.

:class:`RawTables` binds them lazily from a test-warehouse folder (Parquet
tables ``orders``, ``customer``, ``nation``, ``region``): every table is a
plan over the inputs. :class:`StoredRawTables` is the load step of the
reference (bulk load of the raw schema): each table is built once from the
*stored* tables it depends on, written as Parquet into the cluster's shared
checkpoint folder and read back, so models scan files with pushed-down
filters and pruned columns and the binding lineage is cut.
"""

from __future__ import annotations

import hashlib
import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.config import ReconConfig
from ledgerloom.operators import derive
from ledgerloom.sources import binding
from ledgerloom.sources.reference_dims import dim_bank, dim_root_cause, dim_tax_code

BINDING_VERSION = "3"
INPUTS = ("orders", "customer", "nation", "region", "lineitem")

# name -> builder(raw) over other tables of the same RawTables
BUILDERS: dict[str, Callable] = {
    "dim_country": lambda r: binding.dim_country(r.get("region")),
    "dim_store": lambda r: binding.dim_store(r.get("nation"), r.get("region")),
    "dim_tender_type": lambda r: binding.dim_tender_type(r.get("orders")),
    "dim_root_cause": lambda r: dim_root_cause(r.spark),
    "dim_bank": lambda r: dim_bank(r.get("dim_country")),
    "dim_tax_code": lambda r: dim_tax_code(r.get("dim_country")),
    "pos_transaction_header": lambda r: binding.pos_transaction_header(
        r.get("orders"), r.get("customer"), r.get("nation"), r.get("region")),
    "pos_tender": lambda r: binding.pos_tender(r.get("pos_transaction_header"), r.get("orders")),
    "dim_currency": lambda r: derive.fx_rates(r.get("pos_transaction_header"), r.get("dim_country")),
    "dim_fiscal_calendar": lambda r: derive.fiscal_calendar(
        r.get("pos_transaction_header"), r.get("dim_country"), r.cfg),
    "pos_eod_summary": lambda r: derive.eod_summary(r.get("pos_transaction_header"), r.get("pos_tender")),
    "sap_fi_document": lambda r: derive.sap_documents(r.get("pos_transaction_header")),
    "sap_fi_lineitem": lambda r: derive.sap_lineitems(r.get("pos_transaction_header")),
    "bank_card_settlement": lambda r: derive.settlement_batches(
        r.get("pos_tender"), r.get("dim_country"), r.get("dim_tender_type")),
    "bank_statement_line": lambda r: derive.bank_statement_lines(
        r.get("bank_card_settlement"), r.get("dim_country")),
    "sap_fi_lineitem_from_lineitem": lambda r: binding.sap_lineitems_from_lineitem(
        r.get("lineitem"), r.get("orders"), r.get("customer"), r.get("nation"), r.get("region")),
    "recon_match_result": lambda r: derive.reference_match_result(
        r.get("pos_eod_summary"), r.get("sap_fi_document"), r.get("sap_fi_lineitem"),
        r.get("bank_card_settlement"), r.get("bank_statement_line"), r.get("dim_country")),
}
# dependency order (S05: dimensions, facts, derived)
TABLE_ORDER = list(BUILDERS)
DEPENDS: dict[str, set[str]] = {
    "dim_country": set(), "dim_store": set(), "dim_tender_type": set(), "dim_root_cause": set(),
    "pos_transaction_header": set(),
    "dim_bank": {"dim_country"}, "dim_tax_code": {"dim_country"},
    "pos_tender": {"pos_transaction_header"},
    "dim_currency": {"pos_transaction_header", "dim_country"},
    "dim_fiscal_calendar": {"pos_transaction_header", "dim_country"},
    "sap_fi_document": {"pos_transaction_header"}, "sap_fi_lineitem": {"pos_transaction_header"},
    "sap_fi_lineitem_from_lineitem": set(),
    "pos_eod_summary": {"pos_transaction_header", "pos_tender"},
    "bank_card_settlement": {"pos_tender", "dim_country", "dim_tender_type"},
    "bank_statement_line": {"bank_card_settlement", "dim_country"},
    "recon_match_result": {"pos_eod_summary", "sap_fi_document", "sap_fi_lineitem", "bank_card_settlement",
                           "bank_statement_line", "dim_country"},
}


class RawTables:
    """Lazily bound raw tables (each a plan over the test-warehouse inputs)."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: ReconConfig | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.cfg = cfg or ReconConfig()
        self._cache: dict[str, DataFrame] = {}

    def get(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._build(name)
        return self._cache[name]

    table = get

    def _build(self, name: str) -> DataFrame:
        if name in INPUTS:
            return binding.read_table(self.spark, self.sf_dir, name)
        return BUILDERS[name](self)

    def __getattr__(self, name: str) -> DataFrame:
        if name in BUILDERS or name in INPUTS:
            return self.get(name)
        raise AttributeError(name)


def _code_digest(extra: tuple[str, ...] = ()) -> str:
    """Hash of the code that builds the raw tables (and ``extra`` files,
    relative to the package): a change re-loads them."""
    here = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(here)
    files = [os.path.join(here, "binding.py"), os.path.join(here, "reference_dims.py"),
             os.path.join(here, "raw.py"), os.path.join(here, "..", "operators", "derive.py"),
             os.path.join(here, "..", "operators", "ranges.py"), os.path.join(here, "..", "functions", "exprs.py")]
    files += [os.path.join(root, f) for f in extra]
    h = hashlib.sha1()
    for f in files:
        with open(f, "rb") as fh:
            h.update(fh.read())
    return h.hexdigest()[:12]


# Join keys of the big raw tables: with ``bucket_count`` set, both sides of
# each join are stored bucketed on them (same count), so the join and the
# per-document aggregate read co-located buckets instead of shuffling.
BUCKET_KEYS: dict[str, tuple[str, ...]] = {
    "sap_fi_lineitem": ("belnr", "bukrs", "gjahr"),
    "sap_fi_document": ("belnr", "bukrs", "gjahr"),
    "pos_transaction_header": ("pos_txn_id",),
    "pos_tender": ("pos_txn_id",),
    "bank_card_settlement": ("country_code", "bank_account", "settlement_batch_id"),
    "bank_statement_line": ("country_code", "bank_account", "customer_reference"),
}


def store_root(spark: SparkSession, sf_dir: str, cfg: ReconConfig | None = None) -> str:
    """Folder for the loaded raw tables: inside the cluster's shared
    checkpoint folder, keyed by the input files (path, length and
    modification time, from their own file system), the code that builds the
    tables and every setting."""
    from ledgerloom.session import ensure_checkpoint_dir, list_files
    base = ensure_checkpoint_dir(spark)
    cfg = cfg or ReconConfig()
    sig = [sf_dir, BINDING_VERSION, _code_digest(), repr(cfg)]
    for name in INPUTS:
        sig += [f"{path}:{length}:{modified}" for path, length, modified in list_files(spark, f"{sf_dir}/{name}.parquet")]
    digest = hashlib.sha1("|".join(sig).encode()).hexdigest()[:16]
    return f"{base.rstrip('/')}/raw-{digest}"


class StoredRawTables(RawTables):
    """Raw tables built once from stored upstream tables and kept as Parquet.

    A table is written only when its folder lacks ``_SUCCESS``; a rerun (or a
    retried job after a lost executor) reuses complete folders. Threads that
    need one table wait for the first of them; other sessions at the same time
    write their own, of which one is kept.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: ReconConfig | None = None,
                 root: str | None = None):
        super().__init__(spark, sf_dir, cfg)
        self.root = root or store_root(spark, self.sf_dir, self.cfg)
        self.buckets = self.cfg.bucket_count
        self._busy = {name: threading.Lock() for name in [*BUILDERS, *INPUTS]}

    def get(self, name: str) -> DataFrame:
        with self._busy[name]:  # a table's builder takes only those of tables before it
            return super().get(name)

    table = get

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _build(self, name: str) -> DataFrame:
        if name in INPUTS:
            return super()._build(name)
        from ledgerloom.session import path_exists
        from ledgerloom.sources.tables import written_once
        p = self.path(name)
        if self.buckets > 0 and name in BUCKET_KEYS:
            return self._bucketed(name, p, path_exists(self.spark, f"{p}/_SUCCESS"))
        return self.spark.read.parquet(written_once(self.spark, p, lambda folder: BUILDERS[name](self).write.parquet(folder)))

    def _bucketed(self, name: str, path: str, exists: bool) -> DataFrame:
        """A bucketed table at ``path``, registered in the session catalog
        (bucketing is catalog metadata): written once, re-registered over the
        existing files in a later session."""
        n, keys = self.buckets, list(BUCKET_KEYS[name])
        table = f"ll_{os.path.basename(self.root).replace('-', '_')}_{name}"
        if not self.spark.catalog.tableExists(table):
            if exists:
                schema = self.spark.read.parquet(path).schema.toDDL()
                cols = ", ".join(keys)
                self.spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet "
                               f"CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {n} BUCKETS LOCATION '{path}'")
            else:
                # one task per bucket writes one file per bucket
                (BUILDERS[name](self).repartition(n, *keys).write.mode("overwrite")
                 .bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table))
        return self.spark.table(table)

    def load_all(self, parallel: int = 4) -> dict[str, DataFrame]:
        """Load every table; tables of one dependency level are written by
        concurrent jobs (small tables alone cannot fill the cluster)."""
        from concurrent.futures import ThreadPoolExecutor
        done: set[str] = set()
        while len(done) < len(TABLE_ORDER):
            level = [t for t in TABLE_ORDER if t not in done and DEPENDS[t] <= done]
            with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
                list(pool.map(self.get, level))
            done.update(level)
        return {name: self.get(name) for name in TABLE_ORDER}


_STORES: dict[tuple, StoredRawTables] = {}


def stored_raw(spark: SparkSession, sf_dir: str, cfg: ReconConfig | None = None) -> StoredRawTables:
    """One loaded raw store per (session, input files, config): rewritten inputs are loaded anew."""
    from ledgerloom.session import session_key
    cfg = cfg or ReconConfig()
    root = store_root(spark, sf_dir.rstrip("/"), cfg)
    key = (session_key(spark), root, cfg)
    if key not in _STORES:
        _STORES.setdefault(key, StoredRawTables(spark, sf_dir, cfg, root))
    return _STORES[key]
