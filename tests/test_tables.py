"""Tables replaced whole: readers during and after a failed rebuild see the old rows."""

import os
import threading

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerloom.plans import build
from ledgerloom.sources.tables import current_version, publish, read_first, read_in_order, read_table, table_folder


def test_failed_rebuild_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path)
    old = publish(spark.range(100).toDF("n"), root, "marts", "t")
    # some tasks write their rows before one fails
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 990, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint").alias("n"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, root, "marts", "t")
    assert current_version(spark, root, "marts", "t") == old
    assert read_table(spark, root, "marts", "t").count() == 100
    left = [n for n in os.listdir(table_folder(root, "marts", "t")) if n.startswith("v-")]
    assert left == [os.path.basename(old)]  # the half-written version is gone


def test_readers_during_a_rebuild_see_one_version(spark, tmp_path):
    root = str(tmp_path)
    publish(spark.range(50).toDF("n"), root, "marts", "t")
    before = read_table(spark, root, "marts", "t")
    slow = spark.range(0, 40, 1, 4).select((F.col("id") + F.when(F.expr("java_method('java.lang.Thread', 'sleep', 50L) IS NULL"), 0).otherwise(0)).alias("n"))
    work = threading.Thread(target=publish, args=(slow, root, "marts", "t"))
    work.start()
    seen = set()
    while work.is_alive():
        seen.add(read_table(spark, root, "marts", "t").count())
    work.join()
    assert seen <= {50, 40} and 50 in seen
    assert read_table(spark, root, "marts", "t").count() == 40
    assert before.count() == 50  # resolved before the switch: still the version it was


def test_old_versions_are_dropped_but_the_last(spark, tmp_path):
    root = str(tmp_path)
    made = [publish(spark.range(k + 1).toDF("n"), root, "marts", "t") for k in range(4)]
    left = sorted(n for n in os.listdir(table_folder(root, "marts", "t")) if n.startswith("v-"))
    assert left == [os.path.basename(v) for v in made[-2:]]
    assert os.path.exists(f"{table_folder(root, 'marts', 't')}/_SUCCESS")


def test_ordered_and_partitioned_tables(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(i % 3, (i * 7) % 50) for i in range(50)], "g int, v int")
    publish(df, root, "marts", "o", order=["g", F.desc("v")])
    want = [tuple(r) for r in df.orderBy("g", F.desc("v")).collect()]
    assert [(r.g, r.v) for r in read_in_order(spark, root, "marts", "o").orderBy("position").collect()] == want
    assert [(r.g, r.v) for r in read_first(spark, root, "marts", "o", 4).orderBy("position").collect()] == want[:4]
    path = publish(df, root, "marts", "p", partition_by=["g"])
    assert {n for n in os.listdir(path) if n.startswith("g=")} == {"g=0", "g=1", "g=2"}
    with pytest.raises(ValueError):
        publish(df, root, "marts", "p", order=["v"], partition_by=["g"])
    with pytest.raises(FileNotFoundError):
        read_table(spark, root, "marts", "never")


def test_build_keeps_declared_order_and_survives_a_failed_model(spark, cfg, tmp_path, monkeypatch):
    root = str(tmp_path)
    paths = build.run_models(spark, SF_SMALL, root, cfg)
    assert sorted(paths) == sorted(n for names in build.LAYERS.values() for n in names)
    log = read_in_order(spark, root, "marts", "mart_exception_log").orderBy("position").select("recon_date", "abs_variance", "match_id").collect()
    assert len(log) > 10 and [tuple(r) for r in log] == sorted((tuple(r) for r in log), key=lambda r: (-r[0].toordinal(), -r[1], r[2]))
    # one model fails: it and its readers keep their versions, the others are rebuilt
    def fail(*a, **k):
        raise RuntimeError("no summary today")
    monkeypatch.setattr(build.marts, "mart_recon_summary", fail)
    with pytest.raises(RuntimeError, match="no summary"):
        build.run_models(spark, SF_SMALL, root, cfg)
    for name in ("mart_recon_summary", "dim_store_enriched"):
        layer = next(x for x, names in build.LAYERS.items() if name in names)
        assert current_version(spark, root, layer, name) == paths[name]
    assert current_version(spark, root, "marts", "mart_exception_log") != paths["mart_exception_log"]


def test_a_folder_that_another_session_wrote_meanwhile_is_kept(spark, tmp_path, monkeypatch):
    """Two sessions load a raw table at once: the rows of the first stay readable and come once."""
    from ledgerloom.sources import raw
    mine, theirs = (raw.StoredRawTables(spark, SF_SMALL, root=str(tmp_path / "raw")) for _ in range(2))
    build_one, met = raw.BUILDERS["dim_bank"], []

    def slow(r):
        if r is mine:
            met.append(theirs.get("dim_bank"))  # complete before the write of `mine` begins
        return build_one(r)

    monkeypatch.setitem(raw.BUILDERS, "dim_bank", slow)
    n = mine.get("dim_bank").count()
    assert n == met[0].count() == len(met[0].collect()) > 0
    assert not [f for f in os.listdir(tmp_path / "raw") if f.startswith("dim_bank-")]  # nothing left beside it


def test_written_once_by_threads_holds_one_set_of_files(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from ledgerloom.sources.tables import written_once
    path, at_once = str(tmp_path / "t"), threading.Barrier(3)

    def write(folder):
        at_once.wait(60)
        spark.range(0, 10, 1, 2).write.parquet(folder)

    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(lambda _: written_once(spark, path, write), range(3))) == [path] * 3
    assert spark.read.parquet(path).count() == 10 and os.listdir(tmp_path) == ["t"]


def test_a_version_in_force_is_kept_without_over(spark, tmp_path):
    root = str(tmp_path)
    first = publish(spark.range(3).toDF("n"), root, "raw", "t", over=False)
    assert publish(spark.range(5).toDF("n"), root, "raw", "t", over=False) == first
    assert read_table(spark, root, "raw", "t").count() == 3
    assert [n for n in os.listdir(table_folder(root, "raw", "t")) if n.startswith(("v-", "_next"))] == [os.path.basename(first)]


def test_written_once_replaces_a_folder_that_a_killed_writer_left(spark, tmp_path):
    from ledgerloom.sources.tables import written_once
    path, write = str(tmp_path / "t"), lambda folder: spark.range(0, 10, 1, 2).write.parquet(folder)
    spark.range(3).write.parquet(path)
    os.remove(f"{path}/_SUCCESS")
    assert spark.read.parquet(written_once(spark, path, write)).count() == 10
    assert os.path.exists(f"{path}/_SUCCESS") and os.listdir(tmp_path) == ["t"]
    spark.range(5).write.mode("overwrite").parquet(path)  # a complete one stays
    assert spark.read.parquet(written_once(spark, path, write)).count() == 5


def test_a_reader_waits_for_a_pointer_that_is_being_replaced(spark, tmp_path):
    root = str(tmp_path)
    publish(spark.range(7).toDF("n"), root, "raw", "t")
    folder = table_folder(root, "raw", "t")
    name = open(f"{folder}/_current").read()
    for f in ("_current", "._current.crc"):  # as between the deletion and the rename
        os.remove(f"{folder}/{f}")

    def put_back():
        with open(f"{tmp_path}/next", "w") as f:
            f.write(name)
        os.rename(f"{tmp_path}/next", f"{folder}/_current")

    later = threading.Timer(0.5, put_back)
    later.start()
    assert read_table(spark, root, "raw", "t").count() == 7
    later.join()
    with pytest.raises(FileNotFoundError, match="no version in force"):
        read_table(spark, root, "raw", "never")
