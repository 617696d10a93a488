"""Range-partitioned numbering and sorted tables equal the plain window and order."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.ranges import first_rows, manifest, number_rows, read_sorted, save_sorted


def test_numbering_equals_row_number(spark):
    # one cell (HOT, day 1) holds most rows; NULL groups and days number too
    rows = [("HOT" if i % 4 else ("COLD" if i % 8 else None), 1 if i % 5 else (i % 13 if i % 3 else None), f"k{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, day int, k string")
    got = {r.k: r.seq for r in number_rows(df, ["g"], ["day", "k"]).collect()}
    ref = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("day", "k")))
    assert got == {r.k: r.seq for r in ref.collect()} and len(got) == 3000


def test_a_cell_of_a_third_of_all_rows_is_spread(spark, tmp_path):
    df = spark.range(30000).select((F.col("id") % 3 == 0).alias("hot"), F.col("id").alias("k"))
    df = df.select(F.when(F.col("hot"), F.lit(-1)).otherwise(F.col("k") % 50).alias("g"), "k")
    with_conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = number_rows(df, ["g"], ["k"], folder=str(tmp_path / "r"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_conf)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "r")).groupBy("_metadata.file_name").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 30000 / 8  # shuffle partitions of the test session
    hot = out.where("g = -1").agg(F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.countDistinct("seq").alias("d")).first()
    assert tuple(hot) == (10000, 1, 10000, 10000)


def test_numbering_without_groups_descending_and_empty(spark):
    df = spark.createDataFrame([(i % 5, i) for i in range(50)], "day int, v int")
    got = [r.v for r in number_rows(df, [], [F.col("day").desc(), "v"]).orderBy("seq").collect()]
    assert got == [i for _, i in sorted((-(i % 5), i) for i in range(50))]
    assert number_rows(df.limit(0), ["day"], ["v"]).columns == ["day", "v", "seq"]
    assert number_rows(df.limit(0), ["day"], ["v"]).count() == 0


def test_numbering_repeated_rows(spark):
    df = spark.createDataFrame([("a", 1)] * 40 + [("a", 0)], "g string, v int")
    got = sorted((r.seq, r.v) for r in number_rows(df, ["g"], ["v"]).collect())
    assert got == [(1, 0)] + [(i, 1) for i in range(2, 42)]


def test_sorted_table_keeps_its_sequence(spark, tmp_path):
    path = str(tmp_path / "sorted")
    rows = [(i % 7 if i % 11 else None, (i * 37) % 100 / 10, f"m{i:04d}") for i in range(1500)]
    df = spark.createDataFrame(rows, "day int, amount double, id string")
    order = [F.col("day").desc(), F.col("amount").desc(), "id"]
    save_sorted(df, path, order)
    want = [tuple(r) for r in df.orderBy(*order).collect()]
    files = manifest(spark, path).orderBy("file_number").collect()
    got, at = [], 0
    for f in files:  # file by file, in manifest order
        part = [tuple(r) for r in spark.read.parquet(f"{path}/{f.file_name}").orderBy("_metadata.row_index").collect()]
        assert (len(part), at) == (f.n_rows, f.rows_before)
        day, amount, name = part[0]
        first = {k: v for k, v in (("day", day), ("amount", amount), ("id", name)) if v is not None}
        assert json.loads(f.first_key) == first
        got, at = got + part, at + len(part)
    assert got == want
    assert [(r.position, r.id) for r in read_sorted(spark, path).orderBy("position").collect()] == [(i + 1, w[2]) for i, w in enumerate(want)]
    head = first_rows(spark, path, 10)
    assert [r.id for r in head.orderBy("position").collect()] == [w[2] for w in want[:10]]
    assert len(head.inputFiles()) < len(files) + 2


def test_sorted_table_without_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    save_sorted(spark.createDataFrame([], "a int, b string"), path, ["a"])
    assert read_sorted(spark, path).count() == 0 and first_rows(spark, path, 5).columns == ["a", "b", "position"]
