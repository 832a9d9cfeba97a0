"""Versioned Parquet tables: a new version is written whole, then a pointer names it.

Readers resolve the pointer once and read an immutable folder, so a rebuild never
blocks or changes what they see.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def current_version(spark: SparkSession, root: str) -> int:
    """The published version; 0 before the first."""
    try:
        return spark.read.schema("version int").json(f"{root}/_published").agg(F.max("version")).first()[0] or 0
    except AnalysisException:
        return 0


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """SRC23: one immutable version."""
    return spark.read.parquet(f"{root}/v={version or current_version(spark, root)}")


def publish(df: DataFrame, root: str, *, partition_by: list[str] | None = None, dry_run: bool = False) -> dict:
    """SNK7, SNK11: write df as the next version and publish it; a dry run counts and writes nothing."""
    spark = df.sparkSession
    version = current_version(spark, root) + 1
    if dry_run:
        return {"version": version, "rows": df.count(), "written": False}
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root}/v={version}")
    spark.range(1).select(F.lit(version).alias("version")).coalesce(1).write.mode("append").json(f"{root}/_published")
    return {"version": version, "rows": spark.read.parquet(f"{root}/v={version}").count(), "written": True}


def touched(target: DataFrame, changes: DataFrame, partition_by: list[str]) -> DataFrame:
    """The rows of target in the partitions that changes touches, null being a partition too."""
    return _null_safe_semi(target, changes.select(*partition_by).distinct(), partition_by)


class PartitionedTable:
    """SNK6, ST2: a table whose versions share the files of partitions that did not change.

    Each version has a manifest, a row for each partition with its values and its folder. A
    publish writes the folders of the touched partitions and the manifest under a name of its own, and
    last creates the file of the version, which says that name and which only one writer can
    create. Until then nobody sees any of it, a writer that lost has changed nothing, and
    readers of a version keep its folders. Folders are named by a hash of the values, which stand in the files themselves, so that any value, null too, is safe.
    """

    def __init__(self, spark: SparkSession, root: str, partition_by: list[str]):
        self.spark, self.root, self.partition_by = spark, root.rstrip("/"), partition_by
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001

    def _versions(self) -> list[int]:
        folder = self._path(f"{self.root}/_versions")
        return sorted(int(f.getPath().getName()) for f in self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def version(self) -> int:
        """The published version; 0 before the first."""
        return max(self._versions(), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """The partition columns and _folder of each partition."""
        attempt = self.spark.read.text(f"{self.root}/_versions/{version or self.version()}").first()[0]
        return self.spark.read.parquet(f"{self.root}/_manifests/{attempt}")

    def read(self, version: int | None = None, partitions: DataFrame | None = None) -> DataFrame:
        """One version, or of it only the partitions that a DataFrame names; their folders come from the manifest, so others are not listed."""
        found = self.manifest(version)
        if partitions is not None:
            found = _null_safe_semi(found, partitions.select(*self.partition_by).distinct(), self.partition_by)
        folders = [f"{self.root}/{r[0]}" for r in found.select("_folder").collect()]  # one for each partition
        schema = self.spark.read.parquet(f"{self.root}/_schema").schema
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def publish(self, changes: DataFrame, gone: DataFrame | None = None) -> int:
        """The next version: ``changes`` has all rows of each partition that it touches, ``gone`` names partitions without rows left."""
        old = self.version()
        new = old + 1
        attempt = f"v{new}-{uuid.uuid4().hex}"
        name = F.sha2(F.to_json(F.struct(*self.partition_by), {"ignoreNullFields": "false"}), 256)
        changes.withColumn("_folder", name).write.partitionBy("_folder").parquet(f"{self.root}/data/{attempt}")
        if old == 0:
            changes.limit(0).write.mode("overwrite").parquet(f"{self.root}/_schema")
        written = self.spark.read.schema(changes.schema).option("recursiveFileLookup", "true").parquet(f"{self.root}/data/{attempt}")
        touched_now = written.select(*self.partition_by).distinct().withColumn("_folder", F.concat(F.lit(f"data/{attempt}/_folder="), name))
        entries = touched_now
        if old:
            leaving = touched_now.select(*self.partition_by)
            leaving = leaving if gone is None else leaving.unionByName(gone.select(*self.partition_by)).distinct()
            entries = _null_safe_semi(self.manifest(old), leaving, self.partition_by, "left_anti").unionByName(touched_now)
        entries.coalesce(1).write.parquet(f"{self.root}/_manifests/{attempt}")
        pointer = self._fs.create(self._path(f"{self.root}/_versions/{new}"), False)  # fails if another writer was first
        pointer.write(attempt.encode())
        pointer.close()
        return new

    def vacuum(self, keep: int = 2) -> int:
        """Remove what no manifest of the last ``keep`` versions names; returns how many folders went."""
        kept = self._versions()[-keep:]
        named = {r[0] for v in kept for r in self.manifest(v).select("_folder").collect()}
        removed = 0
        data = self._path(f"{self.root}/data")
        for version in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if int(version.getPath().getName()[1:].split("-")[0]) > kept[-1]:
                continue  # a publish may be under way
            for folder in self._fs.listStatus(version.getPath()):
                relative = f"data/{version.getPath().getName()}/{folder.getPath().getName()}"
                if folder.isDirectory() and relative not in named:
                    removed += int(self._fs.delete(folder.getPath(), True))
        return removed


def _null_safe_semi(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    a, b = rows.alias("a"), keys.alias("b")
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, same, how)


def log_status(ledger: DataFrame, entries: DataFrame) -> DataFrame:
    """SNK9: the ledger of files with new statuses merged in."""
    from ..operators.delta import upsert

    return upsert(ledger, entries, ["file_name"], default="keep_if_null")
