"""Shared storage: staged tables and committed table versions."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

log = logging.getLogger(__name__)

_local_folders: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, as in tests, falls back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="bazaar-")
    return _local_folders[app]


def _stage_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/bazaar-stage/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    This cuts the lineage: a later pass sees the very rows of this one, also after the loss of
    an executor, and the planner knows the table's real size. Rows lie in folders of the values of
    ``by``, of which a filter on these columns reads only those it wants.
    """
    spark = df.sparkSession
    path = f"{_stage_folder(spark)}/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    write = df.write.partitionBy(*by) if by else df.write
    write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    return rows.select(df.columns) if by else rows  # folders' columns are read last


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends, also by an error."""
    staged: list[str] = []
    token = _scope.set(staged)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in staged:
            _file_system(spark, path).delete(_path(spark, path), True)


def drop_staged(spark: SparkSession) -> None:
    """Delete all that this application has staged; frames that read it are void afterwards."""
    path = _stage_folder(spark)
    _file_system(spark, path).delete(_path(spark, path), True)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def has_match(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder has a name of this pattern."""
    return bool(_file_system(spark, pattern).globStatus(_path(spark, pattern)))


class VersionedTable:
    """Parquet snapshots of one table, ``<root>/version=<n>``.

    A snapshot counts only once Spark has put its success marker there, after all tasks have
    committed; a failed or lost write leaves the previous snapshot current.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None):
        self.spark, self.root, self.schema = spark, root, schema

    def path(self, version: int) -> str:
        return f"{self.root}/version={version:09d}"

    def versions(self) -> list[int]:
        files = _file_system(self.spark, self.root)
        found = files.globStatus(_path(self.spark, f"{self.root}/version=*/_SUCCESS"))
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

    def read(self, below: int | None = None) -> DataFrame | None:
        """The current snapshot, or the last one below a version; None if there is none."""
        versions = [v for v in self.versions() if below is None or v < below]
        if not versions:
            return None
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(self.path(versions[-1]))

    def read_all(self) -> DataFrame | None:
        """The rows of all versions, for tables whose versions add to one another."""
        paths = [self.path(v) for v in self.versions()]
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else None

    def write(self, df: DataFrame, version: int | None = None) -> str:
        """Commit the frame as a version, by default the next one, and return its folder."""
        return self.write_as_dealt(df.hint("rebalance"), version)

    def write_as_dealt(self, df: DataFrame, version: int | None = None) -> str:
        """``write`` without a shuffle of its own, for a frame whose last one deals rows evenly."""
        if version is None:
            version = max(self.versions(), default=0) + 1
        path = self.path(version)
        df.write.mode("overwrite").parquet(path)
        return path

    def expire(self, keep: int = 2) -> None:
        """Delete all but the newest versions."""
        files = _file_system(self.spark, self.root)
        for version in self.versions()[: -max(keep, 1)]:
            files.delete(_path(self.spark, self.path(version)), True)


class PartitionedTable:
    """Snapshots of a table in folders of one column's values, of which a load rewrites some.

    A load writes the folders it touches to a place of its own, ``<root>/data=<load>``, and then
    commits a list of all current folders as a version of ``<root>/folders``. Readers follow the
    newest list, so a load that fails anywhere before that leaves the table as it was.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, column: str):
        self.spark, self.root, self.schema, self.column = spark, root, schema, column
        self._lists = VersionedTable(spark, f"{root}/folders")

    def folders(self) -> dict[int, str]:
        """The current folder of each value; the list is as long as there are values."""
        listed = self._lists.read()
        return {} if listed is None else {row.value: row.folder for row in listed.collect()}

    def read(self, folders: Mapping[int, str] | None = None) -> DataFrame | None:
        """The current rows, or those of some values, given with the folders to read."""
        folders = self.folders() if folders is None else folders
        if not folders:
            return None
        paths = [f"{self.root}/{folder}" for folder in sorted(folders.values())]
        rows = self.spark.read.schema(self.schema).option("basePath", self.root).parquet(*paths)
        return rows.select(*self.schema.names)

    def write(self, df: DataFrame) -> None:
        """Replace the folders of all values in ``df``, which holds their rows in full."""
        self.commit(self.put(df))

    def write_as_dealt(self, df: DataFrame) -> None:
        """``write`` by ``put_as_dealt``."""
        self.commit(self.put_as_dealt(df))

    def put(self, df: DataFrame) -> dict[int, str]:
        """Write the values' folders, which count only once they are committed.

        Rebalancing gives each value files of a good size, also one with very many rows.
        """
        return self.put_as_dealt(df.hint("rebalance", self.column))

    def put_as_dealt(self, df: DataFrame) -> dict[int, str]:
        """``put`` without a shuffle of its own, for a frame whose last one deals rows evenly.

        Each task writes a file for each value it has: more and smaller files, but the rows of a
        table are not moved a second time.
        """
        data = f"data={uuid.uuid4().hex}"
        df.write.partitionBy(self.column).parquet(f"{self.root}/{data}")
        files = _file_system(self.spark, self.root)
        written = files.globStatus(_path(self.spark, f"{self.root}/{data}/{self.column}=*"))
        names = [status.getPath().getName() for status in written or []]
        return {int(name.split("=")[1]): f"{data}/{name}" for name in names}

    def commit(self, put: Mapping[int, str]) -> None:
        """Make folders that were put the current ones of their values."""
        folders = self.folders() | put
        if folders:
            listed = self.spark.createDataFrame([*folders.items()], "value int, folder string")
            self._lists.write(listed)

    def expire(self, keep: int = 2) -> None:
        """Delete what only older lists than the newest ``keep`` name."""
        self._lists.expire(keep)
        named = set()
        for version in self._lists.versions():
            listed = self.spark.read.parquet(self._lists.path(version))
            named |= {row.folder.split("/")[0] for row in listed.select("folder").collect()}
        files = _file_system(self.spark, self.root)
        for status in files.globStatus(_path(self.spark, f"{self.root}/data=*")) or []:
            if status.getPath().getName() not in named:
                files.delete(status.getPath(), True)
