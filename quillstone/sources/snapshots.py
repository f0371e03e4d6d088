"""A versioned table of immutable Parquet files: a log file a version lists the live files, and is created atomically.

A commit writes new files for the partitions it touches, then creates the next log file; creation fails if another writer has
taken that version. Readers take the files of one version, so they see a commit whole or not at all. All file access goes
through Hadoop's FileSystem, so any store that Spark reads will do.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.session import freed_shuffles

_ENTRIES: dict[str, dict] = {}


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _log(self, version: int) -> str:
        return f"{self.path}/_log/{version:08d}.json"

    def version(self) -> int:
        """The last version; -1 for a table without one."""
        folder = self._path(f"{self.path}/_log")
        if not self._fs.exists(folder):
            return -1
        return max([int(s.getPath().getName()[:8]) for s in self._fs.listStatus(folder) if s.getPath().getName().endswith(".json")], default=-1)

    def _entry(self, version: int) -> dict:
        """A version's log; log files never change, so each is read once."""
        path = self._log(version)
        if path not in _ENTRIES:
            stream = self._fs.open(self._path(path))
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if len(_ENTRIES) >= 256:
                _ENTRIES.clear()
            _ENTRIES[path] = json.loads(text)
        return _ENTRIES[path]

    def files(self, version: int | None = None) -> dict[str, list[str]]:
        """Live files of a version by partition."""
        version = self.version() if version is None else version
        return self._entry(version)["files"] if version >= 0 else {}

    def rows(self, version: int | None = None) -> int | None:
        """Number of rows of a version, if its commit has counted them."""
        return self._entry(self.version() if version is None else version).get("rows")

    def chosen(self, version: int | None = None, partitions: list[str] | None = None, within: dict[str, list] | None = None) -> tuple[list[str], int]:
        """The files that can hold rows of the partitions whose columns have one of the values in within, and the number of all files."""
        entry = self._entry(self.version() if version is None else version)
        every = [(p, f) for p, group in entry["files"].items() for f in group]
        ranges = entry.get("ranges", {})

        def may_hold(file: str) -> bool:
            known = ranges.get(file, {})
            return all(c not in known or any(known[c][0] <= str(v) <= known[c][1] for v in values) for c, values in (within or {}).items())

        return [f for p, f in every if (partitions is None or p in partitions) and may_hold(f)], len(every)

    def read(self, version: int | None = None, partitions: list[str] | None = None, within: dict[str, list] | None = None) -> DataFrame:
        """The rows of a version (the last), or only of the files that chosen() names: others are not opened. within prunes files, it filters no rows."""
        version = self.version() if version is None else version
        if version < 0:
            raise ValueError(f"{self.path} has no version")
        entry = self._entry(version)
        if partitions is None and not within and entry.get("whole"):
            return self.spark.read.schema(entry["schema"]).option("recursiveFileLookup", "true").parquet(entry["whole"])
        files, _ = self.chosen(version, partitions, within)
        return self.spark.read.schema(entry["schema"]).parquet(*files) if files else self.spark.createDataFrame([], entry["schema"])

    def _log_entry(self, version: int, shown: DataFrame, files: dict[str, list[str]], info: dict | None, **more) -> int:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shown.schema.fields)
        self._create(self._log(version), json.dumps({"version": version, "schema": schema, "files": files, "info": info or {}, **more}))
        return version

    def commit_table(self, rows: DataFrame, by: str, sort: str, info: dict | None = None) -> int:
        """A new version that holds just rows: a partition a value of by (text), files in ranges of (by, sort), and for each file its range of sort (text).

        Ranges split a partition of many rows over tasks; a reader that asks for values of sort opens only files whose range holds one.
        """
        now, folder = self.version(), f"{self.path}/data/{uuid.uuid4().hex}"
        ranged = rows.withColumn("_part", F.col(by)).repartitionByRange(by, sort).sortWithinPartitions(by, sort)
        with freed_shuffles(self.spark):
            ranged.write.partitionBy("_part").option("compression", "zstd").parquet(folder)
        place = lambda path: F.regexp_extract(path, "_part=([^/]*)/([^/]+)$", 0)
        held = self.spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(folder)
        stats = held.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.min(F.col(sort).cast("string")).alias("low"), F.max(F.col(sort).cast("string")).alias("high"))
        files: dict[str, list[str]] = {}
        ranges: dict[str, dict[str, list[str]]] = {}
        total = 0
        for r in stats.select(place("file").alias("place"), "n", "low", "high").collect():  # a row a file
            path = f"{folder}/{unquote(r['place'])}"
            files.setdefault(unquote(unquote(r["place"]).split("/")[0].removeprefix("_part=")), []).append(path)
            total += r["n"]
            if r["low"] is not None:
                ranges[path] = {sort: [r["low"], r["high"]]}
        return self._log_entry(now + 1, rows, files, info, ranges=ranges, whole=folder, rows=total)

    def commit(self, partition: str, rows: DataFrame, replace: bool = True, info: dict | None = None, keep: list[str] | None = None) -> int:
        """A new version in which partition holds rows, beside its old files unless replace, or beside those of them in keep."""
        now = self.version()
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(folder)
        new = [s.getPath().toString() for s in self._fs.listStatus(self._path(folder)) if s.getPath().getName().endswith(".parquet")]
        files = dict(self.files(now))
        files[partition] = [*([] if replace else files.get(partition, []) if keep is None else keep), *new]
        ranges = {f: r for f, r in (self._entry(now).get("ranges", {}) if now >= 0 else {}).items() if any(f in group for group in files.values())}
        return self._log_entry(now + 1, rows, files, info, ranges=ranges)

    def _create(self, path: str, text: str) -> None:
        """Write a file that must not exist yet: it appears whole, by a rename, or not at all."""
        temporary = self._path(f"{self.path}/_log/.{uuid.uuid4().hex}")
        out = self._fs.create(temporary, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self._fs.exists(self._path(path)) or not self._fs.rename(temporary, self._path(path)):
            self._fs.delete(temporary, False)
            raise FileExistsError(f"{path} was committed by another writer")

    def compact(self, partition: str, files: int = 1, *sort: str) -> int:
        """Rewrite a partition in few files, in ranges of the columns sort, so that their statistics prune."""
        rows = self.read(partitions=[partition])
        rows = rows.repartitionByRange(files, *sort).sortWithinPartitions(*sort) if sort else rows.coalesce(files)
        return self.commit(partition, rows, info={"operation": "compact"})
