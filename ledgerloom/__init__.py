"""ledgerloom: retail finance reconciliation on Spark DataFrames.

Layers (each a plain function from DataFrames to a lazy DataFrame):

* ``sources``   raw table schemas, CSV / Parquet I/O, binding of the test
                warehouse tables to the raw reconciliation tables.
* ``operators`` staging, matching, marts, enriched dimensions, data-quality
                checks, load profiles and the derivation dataflows.
* ``functions`` reusable column expressions (rounding, ratios, formats).
* ``plans``     the model DAG, the query registry and the DuckDB oracles.
"""

from ledgerloom.config import ReconConfig

__all__ = ["ReconConfig"]
