"""Partitioned Parquet tables whose changes become visible all at once.

Layout: ``<path>/<partition>/pfv=<version>/part-*`` holds rows, ``_schema`` the
columns, and ``_manifest/<number>.json`` names the live folder of every partition.
A change writes new folders first and a new manifest last, by a rename that fails
if the number is taken.  Readers follow the highest manifest, so they see the
table before or after a change, never in between; folders that no manifest names
(of a change that died) are never read.  Old versions are dropped by
:meth:`VersionedTable.vacuum`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.ingest import path_exists

#: Name of the folder level that tells a partition's versions apart.
VERSION = "pfv"


class CommitConflict(RuntimeError):
    """Another writer committed since the manifest was read."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partition_col: str | None = None):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col

    # --- files ------------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _read_text(self, path: str) -> str:
        p, fs = self._fs(path)
        stream = fs.open(p)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_new(self, path: str, text: str) -> None:
        """Create a file with all of its text, or fail if it exists."""
        jvm = self.spark.sparkContext._jvm
        tmp, fs = self._fs(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
        stream = fs.create(tmp, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        final, _ = self._fs(path)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(tmp), fs.makeQualified(final), no_options)
        except Exception as e:
            fs.delete(tmp, False)
            raise CommitConflict(f"{path} exists") from e

    # --- manifests ----------------------------------------------------------
    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(f"{self.path}/_manifest") if n.endswith(".json"))

    def manifest(self, number: int | None = None) -> dict:
        """``version``, ``parts`` (partition folder -> live version folder) and
        ``sources`` (what the writer noted); version 0 is an empty table."""
        if number is None:
            number = max(self._numbers(), default=0)
        if number == 0:
            return {"version": 0, "parts": {}, "sources": {}}
        return json.loads(self._read_text(f"{self.path}/_manifest/{number:012d}.json"))

    # --- table --------------------------------------------------------------
    def create(self, like: DataFrame) -> bool:
        """Record the columns unless the table exists; True when created."""
        if self.exists():
            return False
        like.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_schema")
        return True

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/_schema/_SUCCESS")

    def schema(self) -> T.StructType:
        return self.spark.read.parquet(f"{self.path}/_schema").schema

    def read(self, parts: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of the live version, or of the named partition folders only."""
        live = self.manifest(version)["parts"]
        paths = [f"{self.path}/{p}/{v}" for p, v in live.items() if parts is None or p in parts]
        schema = self.schema()
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).select(*schema.names)

    def folder(self, value) -> str:
        """Name of the folder of a partition value."""
        jvm = self.spark.sparkContext._jvm
        return jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(
            self.partition_col, None if value is None else str(value))

    def replace(self, rows: DataFrame, drop: Sequence[str] = (), sources: dict | None = None,
                check: Callable[[DataFrame], None] | None = None) -> dict:
        """Commit ``rows`` as the new content of the partitions that they are in,
        and of the folders ``drop``; all others stay.  ``check`` gets the table as
        it would be and may raise: then nothing has changed."""
        before = self.manifest()
        version = f"{VERSION}={before['version'] + 1:08d}-{uuid.uuid4().hex[:8]}"
        (rows.withColumn(VERSION, F.lit(version.split("=")[1])).write.mode("append")
         .partitionBy(self.partition_col, VERSION).parquet(self.path))
        p, fs = self._fs(f"{self.path}/*/{version}")
        written = [s.getPath().getParent().getName() for s in fs.globStatus(p)]
        parts = {k: v for k, v in before["parts"].items() if k not in set(drop)}
        parts |= {w: version for w in written}
        after = {"version": before["version"] + 1, "parts": dict(sorted(parts.items())),
                 "sources": before["sources"] if sources is None else sources}
        if check is not None:
            paths = [f"{self.path}/{k}/{v}" for k, v in parts.items()]
            schema = self.schema()
            check(self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).select(*schema.names)
                  if paths else self.spark.createDataFrame([], schema))
        self._write_new(f"{self.path}/_manifest/{after['version']:012d}.json", json.dumps(after))
        return after

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the newest ``keep`` manifests names, and older
        manifests.  Frames read from older versions become unreadable, so keep as
        many as readers may lag behind.  Run by the one writer, between changes."""
        numbers = self._numbers()
        named = set()
        for n in numbers[-keep:]:
            named |= {f"{p}/{v}" for p, v in self.manifest(n)["parts"].items()}
        gone = []
        for part in self._names(self.path):
            if "=" not in part:
                continue
            for v in self._names(f"{self.path}/{part}"):
                if v.startswith(f"{VERSION}=") and f"{part}/{v}" not in named:
                    gone.append(f"{part}/{v}")
        for name in gone:
            p, fs = self._fs(f"{self.path}/{name}")
            fs.delete(p, True)
        for n in numbers[:-keep]:
            p, fs = self._fs(f"{self.path}/_manifest/{n:012d}.json")
            fs.delete(p, False)
        return gone
