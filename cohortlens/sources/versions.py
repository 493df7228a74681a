"""Parquet tables whose writes either happen whole or not at all.

A table is a folder. Every write puts its files into a batch folder of its own and then names, in a small version
file, all files that make up the table; readers take the file list of the newest version. A write that breaks
leaves no version file, so readers keep the rows they had. The version file is put in place by a rename that fails
if another writer was first. What the newest versions do not name is removed by :meth:`VersionedTable.vacuum`.

    <table>/_versions/00000003          one line per file, relative to the table
    <table>/batch=b5c1…/part-….parquet  (or batch=…/year=2023/part-….parquet)

A merge rewrites only the files that hold a key of the batch; the others are named again as they are. The names of
files go through the driver, as they do whenever Spark lists a folder; rows never do.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortlens.operators.clean import dedup_row_number
from cohortlens.session import cut_lineage

VERSIONS = "_versions"
BATCH = "batch"


class VersionConflict(RuntimeError):
    """Another writer finished first; read again and repeat the write."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.schema, self.partition_by = spark, path.rstrip("/"), schema, list(partition_by)
        self._fs_class = spark._jvm.org.apache.hadoop.fs

    # ---- files -----------------------------------------------------------------------------------
    def _path(self, name: str = ""):
        return self._fs_class.Path(f"{self.path}/{name}" if name else self.path)

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the finished versions, in order."""
        folder, fs = self._path(VERSIONS), self._fs()
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def files(self, version: int | None = None) -> list[str]:
        """Files of a version (the newest by default), relative to the table; none if nothing was written."""
        known = self.versions()
        if version is None and not known:
            return []
        version = known[-1] if version is None else version
        if version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        lines = self.spark._jvm.org.apache.commons.io.IOUtils.toString(
            self._fs().open(self._path(f"{VERSIONS}/{version:08d}")), "UTF-8")
        return [x for x in lines.split("\n") if x]

    def _list(self, folder: str) -> list[str]:
        """Parquet files below a folder of the table, relative to the table."""
        found = self._fs().listFiles(self._path(folder), True)
        root = self._fs().makeQualified(self._path()).toUri()
        out = []
        while found.hasNext():
            uri = root.relativize(found.next().getPath().toUri()).getPath()
            if uri.endswith(".parquet"):
                out.append(uri)
        return out

    # ---- reading ---------------------------------------------------------------------------------
    def read(self, version: int | None = None, files: Sequence[str] | None = None, with_file: bool = False) -> DataFrame:
        """The rows of a version (the newest by default), or of some of its files; ``with_file`` adds ``_file``."""
        files = self.files(version) if files is None else files
        names = self.schema.fieldNames()
        if not files:
            empty = self.spark.createDataFrame([], self.schema)
            return empty.withColumn("_file", F.lit(None).cast("string")) if with_file else empty
        df = self.spark.read.schema(StructType(list(self.schema.fields)).add(BATCH, "string")) \
            .option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in files])
        own = [F.substring_index(F.col("_metadata.file_path"), f"/{BATCH}=", -1).alias("_file")] if with_file else []
        return df.select(*names, *own)

    # ---- writing ---------------------------------------------------------------------------------
    def _write(self, df: DataFrame) -> list[str]:
        """Write ``df`` into a batch folder, which shows under its name only when it is complete."""
        name = f"b{uuid.uuid4().hex}"
        w = df.select(*self.schema.fieldNames()).write
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(f"{self.path}/_staged-{name}")
        if not self._fs().rename(self._path(f"_staged-{name}"), self._path(f"{BATCH}={name}")):
            raise OSError(f"could not move the new files of {self.path}")
        return self._list(f"{BATCH}={name}")

    def _commit(self, files: Sequence[str], after: int) -> int:
        """Make ``files`` the table, as the version next to ``after``."""
        fs, version = self._fs(), after + 1
        draft = self._path(f"{VERSIONS}/_draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray("\n".join(files).encode()))
        finally:
            out.close()
        context = self._fs_class.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        # a rename without overwriting: of two writers one finds the version taken
        if fs.exists(self._path(f"{VERSIONS}/{version:08d}")):
            fs.delete(draft, False)
            raise VersionConflict(f"{self.path}: version {version} exists")
        no_options = self.spark._sc._gateway.new_array(getattr(self._fs_class, "Options$Rename"), 0)
        context.rename(draft, self._path(f"{VERSIONS}/{version:08d}"), no_options)
        return version

    def _newest(self) -> int:
        known = self.versions()
        return known[-1] if known else 0

    def overwrite(self, df: DataFrame) -> int:
        """Replace all rows; returns the version. ``df`` may read the table itself."""
        after = self._newest()
        return self._commit(self._write(df), after)

    def upsert(self, incoming: DataFrame, keys: Sequence[str]) -> int:
        """Rows of ``incoming`` (one per key) replace those of equal key; returns the version.

        Only files that hold a key of the batch are read whole and rewritten. Which ones they are comes from a
        semi join of the narrow keys with the table's keys and Spark's file name of each row.
        """
        keys, after = list(keys), self._newest()
        incoming = cut_lineage(dedup_row_number(incoming.select(*self.schema.fieldNames()), keys))  # read three times
        batch_keys = incoming.select(*keys)
        old = self.files(after) if after else []
        held = self.read(files=old, with_file=True).select(*keys, "_file")
        touched = {f"{BATCH}={r[0]}" for r in held.join(batch_keys, keys, "left_semi").select("_file").distinct().collect()}
        unknown = touched - set(old)
        if unknown:
            raise RuntimeError(f"{self.path}: files outside the version: {sorted(unknown)[:3]}")
        merged = incoming
        if touched:
            rest = self.read(files=[f for f in old if f in touched]).join(batch_keys, keys, "left_anti")
            merged = rest.unionByName(incoming)
        return self._commit([f for f in old if f not in touched] + self._write(merged), after)

    def vacuum(self, keep: int = 1) -> int:
        """Remove version files but the newest ``keep``, and data that none of those names; returns files removed."""
        known, fs = self.versions(), self._fs()
        if not known:
            return 0
        used = {f for v in known[-max(1, keep):] for f in self.files(v)}
        gone = 0
        for f in self._list(""):
            if f not in used:
                fs.delete(self._path(f), False)
                gone += 1
        for v in known[:-max(1, keep)]:
            fs.delete(self._path(f"{VERSIONS}/{v:08d}"), False)
        for s in fs.listStatus(self._path()):
            name = s.getPath().getName()
            if name.startswith("_staged-") or name.startswith(f"{BATCH}=") and not any(f.startswith(f"{name}/") for f in used):
                fs.delete(s.getPath(), True)
        return gone


def read_current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table by whatever was written there: the newest version, plain Parquet files, or an empty frame."""
    table = VersionedTable(spark, path, schema)
    if table.versions():
        return table.read()
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
