"""Property checks of the numbering and rounding helpers on generated data."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions.exprs import pct_ratio
from ledgerloom.operators.joins import sequence_within

ROWS = st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.integers(0, 3),
                          st.text(alphabet="xyz", min_size=1, max_size=3)),
                min_size=1, max_size=60, unique_by=lambda r: (r[0], r[2]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_sequence_within_is_row_number(spark, rows):
    df = spark.createDataFrame(rows, "g string, day int, k string")
    got = {(r.g, r.k): r.seq for r in sequence_within(df, ["g"], ["day"], ["k"]).collect()}
    ref = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("day", "k")))
    assert got == {(r.g, r.k): r.seq for r in ref.collect()}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 5000)), min_size=1, max_size=40))
def test_pct_ratio_matches_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "num int, den int")
    got = [r.p for r in df.select(pct_ratio("num", "den").alias("p")).collect()]
    for (n, d), p in zip(pairs, got):
        if d == 0:
            assert p is None
        else:
            exact = (Decimal(n) / Decimal(d) * 100).quantize(Decimal("0.000001"), ROUND_HALF_UP)
            assert p == exact.quantize(Decimal("0.01"), ROUND_HALF_UP)
