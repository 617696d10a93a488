"""Checks K01–K13: a passing and a failing case for each kind."""

from conftest import D, day, make

from ledgerloom.operators import checks


def _df(spark):
    return spark.createDataFrame([("a", "X", 1), ("a", "Y", 2), ("b", None, 3), (None, "Z", 4)],
                                 "k string, v string, n int")


def test_row_kinds(spark):
    df = _df(spark)
    nn = checks.Check("m", "k", "not_null")
    av = checks.Check("m", "v", "accepted_values", values=("X", "Y"))
    assert checks.violations(nn, df).count() == 1
    assert checks.violations(av, df).count() == 1          # NULL passes, Z fails
    assert checks.violations(checks.Check("m", "n", "not_null"), df).count() == 0


def test_unique_ignores_nulls(spark):
    df = _df(spark)
    got = checks.unique_violations(df, ["k"]).collect()
    assert [(r.k, r.n_records) for r in got] == [("a", 2)]
    assert checks.unique_violations(df, ["n"]).count() == 0


def test_relationships_null_child_passes(spark):
    child = spark.createDataFrame([("p1",), ("p9",), (None,)], "fk string")
    parent = spark.createDataFrame([("p1",)], "pk string")
    v = checks.relationship_violations(child, ["fk"], parent, ["pk"]).collect()
    assert [r.fk for r in v] == ["p9"]


def test_run_checks_report_and_severity(spark, cfg):
    df = _df(spark)
    tables = {"m": df, "parent": spark.createDataFrame([("a",)], "k string")}
    cks = [checks.Check("m", "k", "not_null"), checks.Check("m", "k", "unique", severity="warn"),
           checks.Check("m", "n", "not_null"), checks.Check("m", "v", "accepted_values", values=("X", "Y", "Z")),
           checks.Check("m", "k", "relationships", parent=("parent", "k")),
           checks.Check("ghost", "k", "not_null")]
    rep = {r.check_id: (r.failures, r.status) for r in
           checks.run_checks(cks, tables.__getitem__, attached={"m", "parent"}).collect()}
    assert rep["not_null_m_k"] == (1, "ERROR")
    assert rep["unique_m_k"] == (1, "WARN")
    assert rep["not_null_m_n"] == (0, "PASS")
    assert rep["accepted_values_m_v"] == (0, "PASS")
    assert rep["relationships_m_k__parent_k"] == (1, "ERROR")
    assert rep["not_null_ghost_k"] == (None, "SKIPPED")


def test_catalogue_matches_declarations(cfg):
    cat = checks.catalogue(cfg)
    assert len(cat) == 137
    assert sum(1 for c in cat if c.model == "dim_tender_type") == 8
    warn = {c.check_id for c in cat if c.severity == "warn"}
    assert warn == {"not_null_stg_pos_transaction_header_store_id", "unique_stg_pos_tender_pos_tender_id"}


def test_singular_checks(spark, cfg):
    recon = make(spark, "recon_match_result", [
        dict(match_id="1", preparer_id="A", reviewer_id="A", match_status="EXCEPTION"),
        dict(match_id="2", preparer_id="A", reviewer_id="B", match_status="EXCEPTION"),
        dict(match_id="3", preparer_id="A", reviewer_id=None, match_status="EXCEPTION")])
    assert [r.match_id for r in checks.sox_maker_checker(recon).collect()] == ["1"]
    t = checks.maker_checker_tally(recon).collect()[0]
    assert (t.total_exceptions, t.same_person, t.assertion_passed) == (3, 1, False)
    hdr = spark.createDataFrame([("T1", day("2001-12-31"), "A", "S", "CLEAN"), ("T2", day("2002-01-01"), "A", "S", "CLEAN")],
                                "pos_txn_id string, business_date date, country_code string, store_id string, "
                                "_dq_flag string")
    assert [r.pos_txn_id for r in checks.no_future_dated_transactions(hdr, cfg).collect()] == ["T2"]
    pos = spark.createDataFrame([("M1", "A", "ESCALATE", D(100), D(20)), ("M2", "A", "ESCALATE", D("100.01"), D(20))],
                                "match_id string, country_code string, match_type string, "
                                "variance_pos_sap decimal(18,2), threshold_applied decimal(18,2)")
    ctry = spark.createDataFrame([("A", D(100))], "country_code string, variance_threshold_t3 decimal(18,2)")
    assert [r.match_id for r in checks.variance_within_bounds(pos, ctry, cfg).collect()] == ["M1"]


def test_tag_selection():
    assert checks.select_singular(tag="post_staging") == ["test_variance_within_bounds"]
    assert "test_variance_within_bounds" not in checks.select_singular(exclude="intermediate")


def test_all_keys_in_one_pass(spark):
    """Unique and relationship checks of several tables and key types against their plain forms."""
    from ledgerloom.operators.checks import KeyUse, key_failures, relationship_violations, unique_violations
    store = spark.createDataFrame([("S1", 1), ("S2", 2), ("S2", 3), (None, 4)], "store_id string, n int")
    # a hot orphan, NULL keys, a bigint child of an int parent, a composite key
    sale = spark.createDataFrame([("S1", 1, "a")] * 3 + [("S9", 2, "b")] * 200 + [(None, 3, "c"), ("S2", 99, None)], "store string, num long, k string")
    pair = spark.createDataFrame([("S1", "a"), ("S9", None)], "x string, y string")
    uses = [(store, [KeyUse(0, ("store_id",), "unique"), KeyUse(1, ("store_id",), "parent"), KeyUse(2, ("n",), "parent"), KeyUse(5, ("n",), "unique")]),
            (sale, [KeyUse(1, ("store",), "child"), KeyUse(2, ("num",), "child"), KeyUse(3, ("store", "k"), "child"), KeyUse(4, ("store", "num"), "unique")]),
            (pair, [KeyUse(3, ("x", "y"), "parent")])]
    out = key_failures(uses)
    want = {0: unique_violations(store, ["store_id"]).count(), 1: relationship_violations(sale, ["store"], store, ["store_id"]).count(),
            2: relationship_violations(sale, ["num"], store, ["n"]).count(), 3: relationship_violations(sale, ["store", "k"], pair, ["x", "y"]).count(),
            4: unique_violations(sale, ["store", "num"]).count()}
    assert {r.idx: r.n for r in out.collect()} == {k: v for k, v in want.items() if v}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Union") == 1


def test_relationships_scan_each_model_once(spark):
    from conftest import SF_SMALL
    from ledgerloom.plans import registry
    from ledgerloom.plans.build import built_models
    report = registry.QUERIES["k04_relationships_report"](spark, SF_SMALL)
    plan = report._jdf.queryExecution().executedPlan().toString()
    got = built_models(spark, SF_SMALL, registry.CFG)
    checks_ = [c for c in registry.checks.catalogue(registry.CFG) if c.kind == "relationships" and c.model in registry.MODEL_NAMES]
    tables = {c.model for c in checks_} | {c.parent[0] for c in checks_}
    assert len(checks_) >= 2
    scans = plan.split("== Initial Plan ==")[-1].count("FileScan")
    own = sum(got(t)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("FileScan") for t in tables)
    assert scans == own  # a scan for every one the models themselves have, none per relationship
