"""Writers: replace a run or a slice, append what is new, small extracts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from costweave.schemas import LINEAGE, RUN


def partition_folder(column: str, value: object) -> str:
    """``column=value`` with the characters that a folder name cannot hold escaped."""
    special = re.compile(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]")
    return f"{column}={special.sub(lambda m: f'%{ord(m[0]):02X}', str(value))}"


def replace_run(df: DataFrame, path: str, run: int) -> None:
    """Make ``run``'s partition of the table hold exactly ``df``, as ``replace_slice`` does.

    A run that now has no rows leaves an empty partition, which a dynamic partition
    overwrite would not.
    """
    replace_slice(df, path, {RUN: run})


class ForeignRows(ValueError):
    """Rows were given to a slice that they do not belong to; the slice is as it was."""


def replace_slice(df: DataFrame, path: str, slice_: Mapping[str, object]) -> None:
    """Make one partition (run, or run and rule, ...) hold exactly ``df``, or change nothing.

    The rows are written beside the table, under a folder that readers of the table skip,
    and those that belong elsewhere are counted on the way. Only a complete write
    without such rows is published, by renaming folders: the old slice moves aside, the
    new one takes its place, the old one goes. A failed or refused write leaves the old
    slice where it was. A driver lost between the two renames leaves the old slice
    aside, and the next replacement of the slice, or ``settle``, puts it back. The renames
    are single steps on file systems that have them; an object store copies instead.

    ``df`` may read the slice that it replaces.
    """
    fs, folder, aside = _slice_paths(df.sparkSession, path, slice_)
    settle(df.sparkSession, path, slice_)
    beside = f"{path}/{_BESIDE}/{uuid.uuid4().hex}"
    inside = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in slice_.items()])
    seen = Observation()
    watched = df.observe(seen, F.count(F.when(~inside, 1)).alias("foreign"))
    try:
        watched.drop(*slice_).write.parquet(beside)
        if foreign := seen.get["foreign"]:
            raise ForeignRows(f"{foreign} rows do not belong to {dict(slice_)}; nothing was replaced")
        if fs.exists(folder):
            _rename(fs, folder, aside)
        _rename(fs, fs.path(beside), folder)
    except BaseException:
        fs.delete(fs.path(beside))
        settle(df.sparkSession, path, slice_)
        raise
    fs.delete(aside)


def settle(spark: SparkSession, path: str, slice_: Mapping[str, object]) -> None:
    """Put a slice back that an interrupted replacement has left aside; drop it if the new one is there."""
    fs, folder, aside = _slice_paths(spark, path, slice_)
    if fs.exists(aside):
        if fs.exists(folder):
            fs.delete(aside)
        else:
            _rename(fs, aside, folder)


#: Folders of a table that readers skip, as they skip every name with an underscore.
_BESIDE, _ASIDE = "_beside", "_aside"


class _Files:
    """Renames and deletions on the file system of a table."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._path(name)

    def exists(self, path) -> bool:
        return self._fs.exists(path)

    def delete(self, path) -> None:
        self._fs.delete(path, True)

    def rename(self, old, new) -> bool:
        self._fs.mkdirs(new.getParent())
        return self._fs.rename(old, new)


def _rename(files: _Files, old, new) -> None:
    if not files.rename(old, new):
        raise OSError(f"could not rename {old} to {new}")


def _slice_paths(spark: SparkSession, path: str, slice_: Mapping[str, object]):
    files = _Files(spark, path)
    name = "/".join(partition_folder(c, v) for c, v in slice_.items())
    return files, files.path(f"{path}/{name}"), files.path(f"{path}/{_ASIDE}/{name}")


def append_new(
    df: DataFrame, path: str, existing: DataFrame | None, key: list[str] = LINEAGE
) -> None:
    """Append rows whose source row is not in the table yet."""
    fresh = df if existing is None else df.join(existing.select(*key), key, "left_anti")
    fresh.write.mode("append").partitionBy(RUN).parquet(path)


def write_control_csv(df: DataFrame, path: str) -> None:
    """A monthly control total: a handful of rows in one file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_check_report(df: DataFrame, path: str) -> None:
    """Check results as JSON lines."""
    df.write.mode("overwrite").json(path)
