"""Scale helpers give the same answers as the plain forms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.joins import left_join_split
from ledgerloom.operators.ranges import number_rows


def test_number_rows_equals_row_number(spark):
    # one hot group holding most rows, NULL partition key, several day cells
    rows = [("HOT" if i % 4 else ("COLD" if i % 8 else None), i % 13, f"k{i:04d}") for i in range(600)]
    df = spark.createDataFrame(rows, "g string, day int, k string")
    got = {(r.g, r.k): r.seq for r in number_rows(df, ["g"], ["day", "k"]).collect()}
    ref = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("day", "k")))
    assert got == {(r.g, r.k): r.seq for r in ref.collect()}


def test_number_rows_global(spark):
    df = spark.createDataFrame([(i % 5, i) for i in range(50)], "day int, v int")
    got = sorted((r.day, r.v, r.seq) for r in number_rows(df, [], ["day", "v"]).collect())
    assert [s for _, _, s in got] == list(range(1, 51))


def test_number_rows_named_cells(spark):
    # one hot day: a second named column splits it into cells
    rows = [("C", 1 if i % 10 else 2, chr(65 + i % 7), f"{chr(65 + i % 7)}-{i:05d}") for i in range(700)]
    df = spark.createDataFrame(rows, "g string, day int, store string, k string")
    got = {r.k: r.seq for r in number_rows(df, ["g"], ["day", "store", "k"]).collect()}
    ref = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("day", "k")))
    assert got == {r.k: r.seq for r in ref.collect()}


def test_split_left_join_is_exact(spark):
    # key 'H' holds most right rows; left has matched, unmatched, duplicated and NULL keys
    right = spark.createDataFrame([("H", i) for i in range(4000)] + [("c", 100), ("c", 101), ("d", 102)],
                                  "k string, rv int")
    left = spark.createDataFrame([("H", 1), ("H", 2), ("c", 3), ("x", 4), (None, 5)], "k string, lv int")
    joined = left_join_split(left, right, ["k"])
    got = sorted((r.k or "", r.lv, r.rv if r.rv is not None else -1) for r in joined.collect())
    ref = sorted((r.k or "", r.lv, r.rv if r.rv is not None else -1)
                 for r in left.join(right, ["k"], "left").collect())
    assert got == ref and len(got) == 2 * 4000 + 2 + 1 + 1
    assert joined.columns == left.join(right, ["k"], "left").columns
