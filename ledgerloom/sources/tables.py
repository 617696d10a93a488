"""Tables that are replaced whole or not at all.

A rebuild writes a new version folder and, when that is complete, switches one
small pointer file by a rename. A reader resolves the pointer once and
then reads one version, so during a rebuild, or after one that failed, it sees
the rows of the last complete version. Layout::

    <root>/<schema>/<table>/_current          name of the version in force
    <root>/<schema>/<table>/v-<time>-<id>/    Parquet files, _SUCCESS
    <root>/<schema>/<table>/_SUCCESS          set once a version is in force

A table with a declared order is written as sorted files with their manifest
(see :mod:`ledgerloom.operators.ranges`).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from ledgerloom.operators.ranges import first_rows, read_sorted, save_sorted
from ledgerloom.session import _file_system, path_exists

POINTER = "_current"
#: How often, and how long each time, a reader waits for a pointer that is being replaced.
SWITCH_WAITS, SWITCH_WAIT_SEC = 100, 0.05


def table_folder(root: str, schema_name: str, table: str) -> str:
    return f"{root.rstrip('/')}/{schema_name}/{table}"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _read_text(spark: SparkSession, path: str) -> str | None:
    hpath, fs = _file_system(spark, path)
    try:
        stream = fs.open(hpath)
    except Exception:
        if fs.exists(hpath):
            raise
        return None
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    hpath, fs = _file_system(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _rename(spark: SparkSession, source: str, target: str, over: bool) -> None:
    """Rename in one step of the file system: ``over`` an existing file, or failing when the target exists."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    options, kinds = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 1), getattr(hadoop, "Options$Rename")
    options[0] = kinds.OVERWRITE if over else kinds.NONE
    conf = sc._jsc.hadoopConfiguration()
    src, dst = _path(spark, source), _path(spark, target)
    where = src.getFileSystem(conf).makeQualified(src).toUri()
    hadoop.FileContext.getFileContext(where, conf).rename(src, dst, options)


def _first(spark: SparkSession, source: str, target: str) -> bool:
    """Rename to a target that does not exist yet; False, with the source deleted, when another writer was first."""
    try:
        _rename(spark, source, target, over=False)
    except Exception:
        if not path_exists(spark, target):
            raise
        _delete(spark, source)
        return False
    return True


def written_once(spark: SparkSession, path: str, write: Callable[[str], object]) -> str:
    """``path``, complete: ``write`` fills a folder beside it, which takes the name by one rename.

    Sessions that need the same folder at the same time each write their own;
    the first one is kept, so a reader never meets a half-written folder or one
    that holds two writers' files. A folder left without ``_SUCCESS`` (a killed
    writer's) is replaced; one that took its name whole has it."""
    if path_exists(spark, f"{path}/_SUCCESS"):
        return path
    aside = f"{path}-{uuid.uuid4().hex}"
    try:
        write(aside)
    except Exception:
        _delete(spark, aside)
        raise
    if path_exists(spark, f"{aside}/_SUCCESS") and not path_exists(spark, f"{path}/_SUCCESS"):
        _delete(spark, path)
    _first(spark, aside, path)
    return path


def current_version(spark: SparkSession, root: str, schema_name: str, table: str) -> str | None:
    """Folder of the version in force, None before the first one."""
    folder = table_folder(root, schema_name, table)
    name = _read_text(spark, f"{folder}/{POINTER}")
    return f"{folder}/{name}" if name else None


def publish(df: DataFrame, root: str, schema_name: str, table: str, order: list[Column | str] | None = None,
            partition_by: list[str] | None = None, keep: int = 1, over: bool = True) -> str:
    """Write ``df`` as a new version of a table and put it in force; returns its folder.

    ``order`` keeps the rows in that order (sorted files and their manifest).
    ``keep`` earlier versions stay for readers that resolved them; older ones
    are deleted. When the write fails, its folder goes, and the version in
    force before stays in force. Without ``over``, a version that another writer
    put in force meanwhile stays, and this one goes.
    """
    if order and partition_by:
        raise ValueError("a table is either ordered or partitioned")
    spark, folder = df.sparkSession, table_folder(root, schema_name, table)
    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    version = f"{folder}/{name}"
    try:
        if order:
            save_sorted(df, version, order)
        else:
            writer = df.write
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(version)
    except Exception:
        _delete(spark, version)
        raise
    pointer = f"{folder}/_next-{uuid.uuid4().hex}"
    _write_text(spark, pointer, name)
    if over:
        _rename(spark, pointer, f"{folder}/{POINTER}", over=True)
    elif not _first(spark, pointer, f"{folder}/{POINTER}"):
        _delete(spark, version)
        return _in_force(spark, root, schema_name, table)
    _write_text(spark, f"{folder}/_SUCCESS", "")
    _forget(spark, folder, name, keep)
    return version


def _delete(spark: SparkSession, path: str) -> None:
    hpath, fs = _file_system(spark, path)
    fs.delete(hpath, True)


def _forget(spark: SparkSession, folder: str, current: str, keep: int) -> None:
    """Delete complete versions before ``current`` but the last ``keep``; a version still being written has no _SUCCESS."""
    hpath, fs = _file_system(spark, folder)
    names = sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory())
    before = [n for n in names if n.startswith("v-") and n < current and fs.exists(_path(spark, f"{folder}/{n}/_SUCCESS"))]
    for n in before[: len(before) - keep] if keep else before:
        _delete(spark, f"{folder}/{n}")


def _in_force(spark: SparkSession, root: str, schema_name: str, table: str) -> str:
    """The version in force; local file systems replace the pointer by a deletion and a rename, between which it is waited for."""
    folder = table_folder(root, schema_name, table)
    for _ in range(SWITCH_WAITS):
        version = current_version(spark, root, schema_name, table)
        if version is not None:
            return version
        if not path_exists(spark, f"{folder}/_SUCCESS"):
            break  # there was never one
        time.sleep(SWITCH_WAIT_SEC)
    raise FileNotFoundError(f"{folder} has no version in force")


def read_table(spark: SparkSession, root: str, schema_name: str, table: str) -> DataFrame:
    """The rows of the version in force when this is called."""
    return spark.read.parquet(_in_force(spark, root, schema_name, table))


def read_in_order(spark: SparkSession, root: str, schema_name: str, table: str, out_col: str = "position") -> DataFrame:
    """The rows of an ordered table, each with its 1-based position."""
    return read_sorted(spark, _in_force(spark, root, schema_name, table), out_col)


def read_first(spark: SparkSession, root: str, schema_name: str, table: str, n: int, out_col: str = "position") -> DataFrame:
    """The first ``n`` rows of an ordered table, from the files that hold them."""
    return first_rows(spark, _in_force(spark, root, schema_name, table), n, out_col)
