"""Bucketed raw layout: same results, fewer shuffles on the big joins."""

import contextlib
import io
from dataclasses import replace

from conftest import SF_SMALL

from ledgerloom.plans.models import Models
from ledgerloom.plans.verify import norm
from ledgerloom.sources.raw import StoredRawTables


def _rows(df):
    return sorted(tuple(norm(v) for v in r) for r in df.collect())


def _exchanges(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().count("Exchange hashpartitioning")


def test_bucketed_layout_same_results_fewer_shuffles(spark, cfg):
    cfg = replace(cfg, bucket_count=0)
    plain = Models(StoredRawTables(spark, SF_SMALL, cfg), cfg)
    bcfg = replace(cfg, bucket_count=4)
    bucketed = Models(StoredRawTables(spark, SF_SMALL, bcfg), bcfg)
    for name in ("int_sap_sales_by_store_date", "int_pos_sap_matched", "int_pay_bank_matched", "stg_pos_tender"):
        assert _rows(plain.model(name)) == _rows(bucketed.model(name)), name
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # show the shuffle joins
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # fresh plans under the new settings
        plain = Models(StoredRawTables(spark, SF_SMALL, cfg), cfg)
        bucketed = Models(StoredRawTables(spark, SF_SMALL, bcfg), bcfg)
        for name in ("int_sap_sales_by_store_date", "stg_pos_tender"):
            assert _exchanges(bucketed.model(name)) < _exchanges(plain.model(name)), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_layout_is_the_same_at_every_size(spark, cfg):
    assert cfg.bucket_count == 0
    assert StoredRawTables(spark, SF_SMALL, cfg).buckets == 0


def test_rewritten_input_of_equal_size_is_loaded_anew(spark, cfg, tmp_path):
    import os
    import shutil

    from ledgerloom.sources.raw import INPUTS, stored_raw, store_root
    for name in INPUTS:
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    first, store = store_root(spark, str(tmp_path), cfg), stored_raw(spark, str(tmp_path), cfg)
    assert stored_raw(spark, str(tmp_path), cfg) is store
    path = tmp_path / "orders.parquet"
    size = path.stat().st_size
    os.utime(path, (1, 1))
    assert path.stat().st_size == size and store_root(spark, str(tmp_path), cfg) != first
    assert stored_raw(spark, str(tmp_path), cfg) is not store
    assert store_root(spark, str(tmp_path), replace(cfg, pay_bank_tolerance="2.00")) != store_root(spark, str(tmp_path), cfg)
