"""Sources and sinks: typed CSV load (S01–S05), table writes.

CSV follows the reference's load format: one header row, optional double
quotes, blank fields NULL, surrounding blanks trimmed, ISO dates, and the
whole load aborts on a malformed row (FAILFAST). Boolean columns arrive as
Y/N or 0/1, which Spark's CSV reader would turn into NULL under a boolean
schema, so they are read as text and cast.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.schemas import DEFAULTS, LOAD_ORDER, RAW_SCHEMAS

AUDIT_COLUMNS = ("created_at", "updated_at", "loaded_by")


def _text_schema(schema: T.StructType) -> T.StructType:
    """Booleans as strings for the reader; everything else as declared."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BooleanType)
                                       else f.dataType, True) for f in schema.fields])


def file_schema(table: str, file_cols: list[str]) -> T.StructType:
    """The fields of a file with these columns; undeclared ones are text."""
    by_name = {f.name: f for f in _text_schema(RAW_SCHEMAS[table]).fields}
    return T.StructType([by_name.get(c, T.StructField(c, T.StringType(), True)) for c in file_cols])


def csv_reader(spark: SparkSession, schema: T.StructType) -> DataFrameReader:
    """The reference's load format (see above) under a schema."""
    return (spark.read.schema(schema)
            .option("header", True).option("quote", '"').option("escape", '"')
            .option("nullValue", "").option("emptyValue", None)
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            .option("dateFormat", "yyyy-MM-dd"))


def read_csv_table(spark: SparkSession, path: str, table: str, columns: list[str] | None = None,
                   mode: str = "FAILFAST", with_audit: bool = False) -> DataFrame:
    """Load one raw table from CSV (plain or .gz) by schema.

    ``columns`` is the file's explicit column list (load by name); declared
    columns missing from it get their declared default, else NULL. ``with_audit`` adds the load audit
    columns the warehouse fills by default.
    """
    schema = RAW_SCHEMAS[table]
    file_cols = columns or schema.fieldNames()
    df = csv_reader(spark, file_schema(table, file_cols)).option("mode", mode).csv(path)
    out = []
    for f in schema.fields:
        if f.name not in file_cols:
            out.append(F.lit(DEFAULTS.get(table, {}).get(f.name)).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.BooleanType):
            out.append(F.col(f.name).cast("boolean").alias(f.name))
        else:
            out.append(F.col(f.name))
    df = df.select(*out)
    if with_audit:
        df = df.select("*", F.current_timestamp().cast("timestamp_ntz").alias("created_at"),
                       F.current_timestamp().cast("timestamp_ntz").alias("updated_at"),
                       F.current_user().alias("loaded_by"))
    return df


def load_folder(spark: SparkSession, folder: str, suffix: str = ".csv",
                tables: list[str] | None = None) -> dict[str, DataFrame]:
    """The raw tables of ``folder`` (``<table>.csv`` or ``.csv.gz``), all
    sixteen unless ``tables`` names fewer, in load order: dimensions, facts,
    derived. The folder may be on any file system Spark reads; a missing table
    is an error."""
    from ledgerloom.session import path_exists
    found, missing = {}, []
    for t in (x for x in LOAD_ORDER if tables is None or x in tables):
        path = next((p for ext in (suffix, suffix + ".gz") if path_exists(spark, p := f"{folder.rstrip('/')}/{t}{ext}")), None)
        if path is None:
            missing.append(t)
        else:
            found[t] = read_csv_table(spark, path, t)
    if missing:
        raise FileNotFoundError(f"{folder} lacks {', '.join(missing)}")
    return found


def save_table(df: DataFrame, root: str, schema_name: str, table: str, fmt: str = "parquet",
               partition_by: list[str] | None = None) -> str:
    """Full rebuild of a table under ``root/<schema>/<table>``.

    Overwrite makes a retried job (lost executor, rerun) idempotent."""
    path = f"{root.rstrip('/')}/{schema_name}/{table}"
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, compression: str = "none") -> str:
    """CSV sink with header and a column projection; ``compression="gzip"`` for compressed files."""
    (df.select(*(columns or df.columns)).write.mode("overwrite")
       .option("header", True).option("quote", '"').option("escape", '"').option("compression", compression).csv(path))
    return path
