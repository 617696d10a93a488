"""A left join that stays safe at scale.

:func:`left_join_split` is an exact left join whose hot keys Spark can split on
both sides, because it runs as an inner join: adaptive skew handling applies to
either input of an inner join, but only to the left one of a left join.

Which side of a join is broadcast is left to Spark's size threshold and to
adaptive execution; only literal tables are hinted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ranges import number_rows

#: Rows standing for "no partner", over which left rows without one are spread.
NOBODY = 256


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def left_join_split(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Exact ``left.join(right, keys, "left")`` for a right side whose keys repeat.

    ``left`` is evaluated once. A left join with the distinct right keys (which
    no hot key makes large) marks the rows that have partners. The others,
    NULL keys included, are sent to one of :data:`NOBODY` rows added to the
    right side, so every left row has a partner and the join proper is an inner
    one. Of the right side, the marking reads the key columns only.
    """
    spark = left.sparkSession
    named = [f"__k{i}" for i in range(len(keys))]
    known = right.select(*[F.col(k).alias(n) for k, n in zip(keys, named)]).distinct().withColumn("__known", F.lit(True))
    marked = left.join(known, _all([F.col(k) == F.col(n) for k, n in zip(keys, named)]), "left").drop(*named)
    has = F.col("__known").isNotNull()
    marked = marked.select(
        *left.columns, *[F.when(has, F.col(k)).alias(f"__l{i}") for i, k in enumerate(keys)],
        F.when(has, F.lit(0)).otherwise(F.pmod(F.xxhash64(*left.columns), F.lit(NOBODY)) + 1).cast("int").alias("__at"))
    rest = [c for c in right.columns if c not in keys]
    partners = right.select(*[F.col(k).alias(n) for k, n in zip(keys, named)], *rest, F.lit(0).alias("__slot")).where(
        _all([F.col(n).isNotNull() for n in named]))
    types = {f.name: f.dataType for f in partners.schema.fields}
    nobody = spark.range(1, NOBODY + 1).select(
        *[F.lit(None).cast(types[c]).alias(c) for c in [*named, *rest]], F.col("id").cast("int").alias("__slot"))
    partners = partners.unionByName(nobody)
    same = _all([F.col(f"__l{i}").eqNullSafe(F.col(n)) for i, n in enumerate(named)]) & (F.col("__at") == F.col("__slot"))
    return marked.join(partners, same).select(*keys, *[c for c in left.columns if c not in keys], *rest)


def sequence_within(df: DataFrame, partition_cols: list[str], bucket_cols: list[str],
                    order_cols: list[Column | str], out_col: str = "seq") -> DataFrame:
    """Dense 1..n numbering per ``partition_cols`` ordered by (``bucket_cols``, ``order_cols``)."""
    return number_rows(df, partition_cols, [*bucket_cols, *order_cols], out_col)
