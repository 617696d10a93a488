"""Sources and sinks: CSV load edge cases (FIXTURES edge 22), writes."""

import os
import tempfile

import pytest

from ledgerloom.sources import io


def _write(text):
    d = tempfile.mkdtemp(dir="/tmp")
    p = os.path.join(d, "dim_store.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


HEADER = ("store_id,country_code,store_name,mall_name,city,state,store_type,sap_profit_center,sap_cost_center,"
          "bank_account,bank_code,mas_merchant_id,tax_registration,store_manager,open_date,is_active,"
          "floor_area_sqft,num_terminals\n")


def test_csv_blank_quoted_and_boolean(spark):
    p = _write(HEADER + 'S1,MYS,"Store, One",,  ,X,STANDARD,PC,CC,A,B,,T,M,2020-01-02,Y,100,2\n'
                        "S2,SGP,Two,,,,,,,,,,,,2021-03-04,N,,\n")
    rows = {r.store_id: r for r in io.read_csv_table(spark, p, "dim_store").collect()}
    assert rows["S1"].store_name == "Store, One"          # quoted comma
    assert rows["S1"].mall_name is None                   # empty → NULL
    assert rows["S1"].city is None                        # blanks only → NULL
    assert rows["S1"].is_active is True and rows["S2"].is_active is False
    assert str(rows["S2"].open_date) == "2021-03-04" and rows["S2"].floor_area_sqft is None


def test_csv_failfast_on_bad_number(spark):
    p = _write(HEADER + "S1,MYS,One,,,,,,,,,,,,2020-01-02,Y,notanumber,2\n")
    with pytest.raises(Exception):
        io.read_csv_table(spark, p, "dim_store").collect()


def test_load_by_column_list_and_audit(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    p = os.path.join(d, "dim_root_cause.csv")
    with open(p, "w") as f:
        f.write("root_cause_code,description\nRC-001,Batch\n")
    df = io.read_csv_table(spark, p, "dim_root_cause", columns=["root_cause_code", "description"], with_audit=True)
    r = df.collect()[0]
    assert r.root_cause_code == "RC-001" and r.category is None and r.created_at is not None
    assert r.loaded_by


def test_save_and_csv_round_trip(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    path = io.save_table(df, d, "marts", "t")
    assert path.endswith("/marts/t") and spark.read.parquet(path).count() == 2
    io.save_table(df.limit(1), d, "marts", "t")           # full rebuild
    assert spark.read.parquet(path).count() == 1
    out = io.write_csv(df, os.path.join(d, "csv"), ["k"])
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["k"] and back.count() == 2


def test_load_folder_in_order(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    for t, text in (("dim_root_cause", "root_cause_code\nRC-001\n"), ("dim_country", "country_code\nMYS\n")):
        with open(os.path.join(d, t + ".csv"), "w") as f:
            f.write(text)
    tabs = io.load_folder(spark, d, tables=["dim_root_cause", "dim_country"])
    assert list(tabs) == ["dim_country", "dim_root_cause"]
    assert list(io.load_folder(spark, f"file://{d}", tables=["dim_country"])) == ["dim_country"]
    with pytest.raises(FileNotFoundError, match="dim_store"):  # a missing table is no silent gap
        io.load_folder(spark, d)


def test_every_raw_table_round_trips_through_csv(spark):
    """S12 then S01: each bound raw table written as CSV and loaded back by
    its declared schema equals the original."""
    from conftest import SF_SMALL
    from ledgerloom.plans import registry
    from ledgerloom.sources.schemas import RAW_SCHEMAS
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    raw = registry.models(spark, SF_SMALL).raw
    d = tempfile.mkdtemp(dir="/tmp")
    for table in RAW_SCHEMAS:
        df = raw.get(table).select(*RAW_SCHEMAS[table].fieldNames())
        path = io.write_csv(df, os.path.join(d, table))
        # the load trims text and turns blank fields into NULL (bstat ' ' → NULL, Q28)
        df = df.select(*[F.when(F.trim(f.name) == "", F.lit(None)).otherwise(F.trim(f.name)).alias(f.name)
                         if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])
        back = io.read_csv_table(spark, path, table)
        assert df.exceptAll(back).count() == 0 and back.exceptAll(df).count() == 0, table
