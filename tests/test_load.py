"""Checked CSV loads and writes that enforce a table's rules."""

import os

import pytest
from conftest import make

from ledgerloom.sources.load import BadRows, enforced, load_csv, load_warehouse
from ledgerloom.sources.schemas import LOAD_ORDER, RAW_SCHEMAS
from ledgerloom.sources.tables import current_version, publish, read_table


def _csv(folder, name, header, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join([header, *lines]) + "\n")


def _stores(folder):
    """Two files with three bad rows: a bad number, a bad boolean, a field too many."""
    cols = RAW_SCHEMAS["dim_store"].fieldNames()
    row = lambda **v: ",".join(str(v.get(c, "")) for c in cols)
    _csv(folder, "a.csv", ",".join(cols), [
        row(store_id="S1", country_code="MYS", is_active="Y", floor_area_sqft=10),
        row(store_id="S2", country_code="MYS", is_active="Y", floor_area_sqft="notanumber"),
        row(store_id="S3", country_code="MYS", is_active="maybe")])
    _csv(folder, "b.csv", ",".join(cols), [row(store_id="S4", country_code="SGP", is_active="0"), row(store_id="S5", country_code="SGP") + ",x"])
    return folder


def test_every_bad_row_is_reported_with_its_file(spark, tmp_path):
    folder = _stores(str(tmp_path / "in"))
    with pytest.raises(BadRows) as got:
        load_csv(spark, folder, "dim_store")
    assert got.value.count == 3
    found = sorted((os.path.basename(r.file), r.record.split(",")[0][-4:], r.errors[0][:22]) for r in got.value.rejects.collect())
    assert [f for f, _, _ in found] == ["a.csv", "a.csv", "b.csv"]
    text = str(got.value)
    for part in ("notanumber", "is_active is no boolean: maybe", "S5", "a.csv", "b.csv"):
        assert part in text


def test_bad_rows_can_be_routed(spark, tmp_path):
    got = load_csv(spark, _stores(str(tmp_path / "in")), "dim_store", on_bad="route")
    assert got.n_rejected == 3 and got.rejects.count() == 3
    rows = {r.store_id: r for r in got.rows.collect()}
    assert sorted(rows) == ["S1", "S4"] and rows["S1"].floor_area_sqft == 10 and rows["S4"].is_active is False
    with pytest.raises(ValueError):
        load_csv(spark, str(tmp_path / "in"), "dim_store", on_bad="ignore")


def test_blank_required_field_is_a_bad_row(spark, tmp_path):
    cols = RAW_SCHEMAS["dim_root_cause"].fieldNames()
    _csv(str(tmp_path), "x.csv", ",".join(cols), ["RC-1" + "," * (len(cols) - 1), "  " + "," * (len(cols) - 1)])
    got = load_csv(spark, str(tmp_path / "x.csv"), "dim_root_cause", on_bad="route")
    assert [r.root_cause_code for r in got.rows.collect()] == ["RC-1"]
    assert [r.errors for r in got.rejects.collect()] == [["root_cause_code is blank"]]


def test_column_list_fills_declared_defaults(spark, tmp_path):
    _csv(str(tmp_path), "x.csv", "root_cause_code,description", ["RC-1,late"])
    row = load_csv(spark, str(tmp_path / "x.csv"), "dim_root_cause", columns=["root_cause_code", "description"]).rows.first()
    assert row.is_systemic is False and row.category is None and row.description == "late"


def test_empty_file(spark, tmp_path):
    _csv(str(tmp_path), "x.csv", ",".join(RAW_SCHEMAS["dim_bank"].fieldNames()), [])
    got = load_csv(spark, str(tmp_path / "x.csv"), "dim_bank")
    assert got.rows.count() == 0 and got.n_rejected == 0 and got.rows.schema.fieldNames() == RAW_SCHEMAS["dim_bank"].fieldNames()


def _causes(spark, rows):
    return make(spark, "dim_root_cause", rows)


def test_a_write_that_breaks_a_rule_publishes_nothing(spark, tmp_path):
    root = str(tmp_path)
    good = publish(enforced(_causes(spark, [{"root_cause_code": f"RC-{i}"} for i in range(30)]), "dim_root_cause"), root, "raw", "dim_root_cause")
    twice = _causes(spark, [{"root_cause_code": f"RC-{i % 29}"} for i in range(30)])
    with pytest.raises(Exception, match="key .root_cause_code. occurs again: RC-0"):
        publish(enforced(twice, "dim_root_cause"), root, "raw", "dim_root_cause")
    nulls = _causes(spark, [{"root_cause_code": None}])
    with pytest.raises(Exception, match="dim_root_cause.root_cause_code is NULL"):
        publish(enforced(nulls, "dim_root_cause"), root, "raw", "dim_root_cause")
    assert current_version(spark, root, "raw", "dim_root_cause") == good
    assert [n for n in os.listdir(f"{root}/raw/dim_root_cause") if n.startswith("v-")] == [os.path.basename(good)]
    assert enforced(twice, "dim_root_cause", ()).count() == 30  # keys may be left unchecked


def test_enforced_columns_types_and_one_shuffle(spark):
    df = spark.createDataFrame([("RC-1", "7", "x")], "root_cause_code string, typical_resolution_hrs string, more string")
    out = enforced(df, "dim_root_cause")
    assert out.schema.fieldNames() == RAW_SCHEMAS["dim_root_cause"].fieldNames()
    row = out.first()
    assert row.typical_resolution_hrs == 7 and row.is_systemic is False and row.category is None
    lines = make(spark, "sap_fi_lineitem", [{"belnr": "1", "bukrs": "C", "gjahr": 2001, "buzei": str(i)} for i in range(9)])
    plan = enforced(lines, "sap_fi_lineitem")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and enforced(lines, "sap_fi_lineitem").count() == 9


def test_warehouse_load_lists_missing_files_and_routes(spark, tmp_path):
    files, root = str(tmp_path / "in"), str(tmp_path / "out")
    for t in LOAD_ORDER[:-1]:
        _csv(files, f"{t}.csv", ",".join(RAW_SCHEMAS[t].fieldNames()), [])
    with pytest.raises(FileNotFoundError, match="recon_match_result"):
        load_warehouse(spark, files, root)
    assert not os.path.exists(root)
    cols = RAW_SCHEMAS["recon_match_result"].fieldNames()
    _csv(files, "recon_match_result.csv", ",".join(cols), [
        "M1,POS_SAP,MYS,2001-01-01" + "," * (len(cols) - 4), "M1,POS_SAP,MYS,2001-01-02" + "," * (len(cols) - 4),
        "M2,POS_SAP,MYS,not a day" + "," * (len(cols) - 4)])
    with pytest.raises(BadRows):
        load_warehouse(spark, files, root)
    got = load_warehouse(spark, files, root, on_bad="route")
    assert list(got) == LOAD_ORDER and got["recon_match_result"].count() == 2
    assert read_table(spark, root, "rejects", "recon_match_result").count() == 1


def test_warehouse_load_takes_one_settlement_id_per_country(spark, tmp_path):
    """Batches without a store have one name, and so one settlement id, in all countries."""
    files = str(tmp_path / "in")
    for t in LOAD_ORDER:
        _csv(files, f"{t}.csv", ",".join(RAW_SCHEMAS[t].fieldNames()), [])
    cols = RAW_SCHEMAS["bank_card_settlement"].fieldNames()
    required = {f.name for f in RAW_SCHEMAS["bank_card_settlement"].fields if not f.nullable}
    line = lambda country: ",".join({"settlement_id": "STL-NOSTORE-VISA-20010101", "country_code": country}.get(c, "1" if c in required else "") for c in cols)
    _csv(files, "bank_card_settlement.csv", ",".join(cols), [line("ASIA"), line("EUROPE")])
    got = load_warehouse(spark, files, str(tmp_path / "out"))["bank_card_settlement"]
    assert sorted(r.country_code for r in got.collect()) == ["ASIA", "EUROPE"]
    _csv(files, "bank_card_settlement.csv", ",".join(cols), [line("ASIA"), line("ASIA")])
    with pytest.raises(Exception, match="bank_card_settlement key .settlement_id, country_code. occurs again"):
        load_warehouse(spark, files, str(tmp_path / "again"))


def test_warehouse_load_leaves_no_working_tables_and_reads_compressed_files(spark, tmp_path, monkeypatch):
    from ledgerloom.sources import load
    from ledgerloom.sources.io import write_csv
    files, made = str(tmp_path / "in"), []
    monkeypatch.setattr(load, "work_folder", lambda s: made.append(str(tmp_path / f"work-{len(made)}")) or made[-1])
    for t in LOAD_ORDER:
        _csv(files, f"{t}.csv", ",".join(RAW_SCHEMAS[t].fieldNames()), [])
    os.remove(f"{files}/dim_root_cause.csv")
    causes = make(spark, "dim_root_cause", [{"root_cause_code": f"RC-{i}"} for i in range(9)])
    write_csv(causes, f"{files}/dim_root_cause.csv", compression="gzip")
    assert any(n.endswith(".csv.gz") for n in os.listdir(f"{files}/dim_root_cause.csv"))
    got = load_warehouse(spark, files, str(tmp_path / "out"))
    assert sorted(r.root_cause_code for r in got["dim_root_cause"].collect()) == [f"RC-{i}" for i in range(9)]
    assert made and not [n for n in os.listdir(tmp_path) if n.startswith("work-")]
