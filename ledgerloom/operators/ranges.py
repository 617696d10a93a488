"""Work on range-partitioned, sorted files: exact numbering and ordered tables.

A total order over many rows needs no single task. Rows are written as sorted
files, each holding one range of the order (``repartitionByRange`` samples the
order, so a hot group is spread over as many files as its rows fill). After
that, a row's place is known from the file it stands in and its index there,
both of which the Parquet reader supplies as ``_metadata`` columns:

* :func:`number_rows` numbers rows 1..n inside groups: a count per (file,
  group) is summed over the files before it and added to the row's own index.
* :func:`save_sorted` writes a table that keeps its order, with a manifest of
  rows and first and last key per file; :func:`read_sorted` gives every row its
  position, :func:`first_rows` opens only the files that hold the first ones.

The files are written tables in the shared checkpoint folder (or where the
caller says), so ranges are sampled once and a lost executor re-reads them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "_manifest"


def _order(cols: list[Column | str]) -> list[Column]:
    """Sort expressions; a name may end in `` desc``."""
    return [c if not isinstance(c, str) else F.col(c[:-5]).desc() if c.endswith(" desc") else F.col(c) for c in cols]


def _write_ranges(df: DataFrame, order: list[Column], path: str) -> None:
    """Sorted files of ``df``: files ascend by their part number, rows by their index."""
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
       .write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(path))


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of sorted files with the file (``__file``, its part number) and the index in it (``__at``)."""
    rows, name = spark.read.parquet(path), F.col("_metadata.file_name")
    part = F.regexp_extract(name, r"^part-(\d+)", 1).cast("int")
    return rows.select("*", part.alias("__file"), name.alias("__name"), F.col("_metadata.row_index").alias("__at"))


def work_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder."""
    from ledgerloom.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ranges-{uuid.uuid4().hex}"


def number_rows(df: DataFrame, partition_cols: list[str], order_cols: list[Column | str],
                out_col: str = "seq", folder: str | None = None) -> DataFrame:
    """``df`` and a dense 1..n numbering (bigint) per ``partition_cols`` in ``order_cols``.

    The same rows as ``row_number() OVER (PARTITION BY … ORDER BY …)``, but no
    task holds more than one range of the order, whatever share of the rows a
    group or a cell of it has. ``order_cols`` should be a total order inside a
    group; the order of full ties is whichever way the files were written, and
    stays so. NULL groups are numbered too; an empty input gives no rows.
    The input is evaluated and written when this is called.
    """
    spark = df.sparkSession
    path = folder or work_folder(spark)
    _write_ranges(df, [*_order(partition_cols), *_order(order_cols)], path)
    placed = _placed(spark, path)
    # a group's rows in one file are consecutive: the first index and their number say all
    cells = placed.groupBy(*partition_cols, "__file").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*partition_cols).orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift")
    named = [F.col(c).alias(f"__g{i}") for i, c in enumerate(partition_cols)]
    cells = cells.select(*named, F.col("__file").alias("__f"), shift)
    same = placed["__file"] == cells["__f"]
    for i, c in enumerate(partition_cols):
        same = same & placed[c].eqNullSafe(cells[f"__g{i}"])
    return placed.join(cells, same).select(*[placed[c] for c in df.columns],
                                           (F.col("__at") + F.col("__shift")).cast("bigint").alias(out_col))


def save_sorted(df: DataFrame, path: str, order_cols: list[Column | str]) -> str:
    """Write ``df`` in the given order and, beside it, the manifest of its files
    in that order: number, name, rows, rows before it, first and last row's
    values of the plainly named order columns. The manifest is one row a file."""
    order = _order(order_cols)
    _write_ranges(df, order, path)
    spark = df.sparkSession
    named = {_named(o) for o in order_cols}
    keys = [c for c in df.columns if c in named]
    rows = _placed(spark, path)
    key = F.to_json(F.struct(*keys)) if keys else F.lit(None).cast("string")
    files = rows.groupBy("__file", "__name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min_by(key, "__at").alias("first_key"), F.max_by(key, "__at").alias("last_key"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)  # over files, not rows
    (files.select(F.col("__file").alias("file_number"), F.col("__name").alias("file_name"), "n_rows",
                  F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("rows_before"), "first_key", "last_key")
          .orderBy("file_number").coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}"))
    return path


def _named(order: Column | str) -> str:
    """The column an order expression names: 'a', 'a desc', F.col('a').desc() and the like."""
    text = order if isinstance(order, str) else str(order).removeprefix("Column<'").removesuffix("'>")
    return text.split(" ")[0].strip("`")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of a table written by :func:`save_sorted`."""
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_sorted(spark: SparkSession, path: str, out_col: str = "position") -> DataFrame:
    """The rows of a sorted table, each with its 1-based position in it."""
    placed = _placed(spark, path)
    at = manifest(spark, path).select(F.col("file_number").alias("__f"), "rows_before")
    columns = [c for c in placed.columns if c not in ("__file", "__name", "__at")]
    return placed.join(at, placed["__file"] == at["__f"]).select(
        *columns, (F.col("rows_before") + F.col("__at") + 1).cast("bigint").alias(out_col))


def first_rows(spark: SparkSession, path: str, n: int, out_col: str = "position") -> DataFrame:
    """The first ``n`` rows; only the files the manifest names for them are opened."""
    files = manifest(spark, path).where(F.col("rows_before") < n)
    names = [r.file_name for r in files.select("file_name").collect()]
    schema = spark.read.parquet(path).schema
    if not names:
        return spark.createDataFrame([], schema).withColumn(out_col, F.lit(None).cast("bigint"))
    rows = spark.read.schema(schema).parquet(*[f"{path}/{name}" for name in names])
    rows = rows.select("*", F.col("_metadata.file_name").alias("__name"), F.col("_metadata.row_index").alias("__at"))
    placed = rows.join(files.select(F.col("file_name").alias("__name"), "rows_before"), "__name")
    return placed.select(*schema.fieldNames(), (F.col("rows_before") + F.col("__at") + 1).cast("bigint").alias(out_col)).where(
        F.col(out_col) <= n)
