"""Tables whose content is named by a manifest: loads that happen once, upserts that rewrite only what they touch.

A table is a folder. ``data`` holds immutable folders, one per load and group; ``manifests``
holds one small file per version: the live folders, the loads that are in it, the schema. A
load writes new folders first and creates the next manifest last, in one step that fails if
that version exists. A crash before that leaves the old table as it was, and two loads at a
time cannot both win. Readers take the newest manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD, GROUP = "_load", "_bucket"
#: Rows that one task writes of a bucket at most, about; a bucket that a load fills more is spread over several.
ROWS_PER_TASK = 1_000_000


class ConcurrentLoad(RuntimeError):
    """Another load created the version that this one was to create."""


@dataclass(frozen=True)
class Manifest:
    """One version of a table."""

    version: int = 0
    #: Column names and types, partition columns included.
    schema: dict | None = None
    #: Live folders under ``data``: by bucket for keyed tables, by load for appended ones.
    live: dict[str, list[str]] = field(default_factory=dict)
    loads: list[str] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "schema": self.schema, "live": self.live, "loads": self.loads})


class VersionedTable:
    """A table in the folder ``path``, which every executor can reach.

    ``key`` makes it a keyed table of ``buckets`` hash buckets, for ``upsert``; without one
    rows are appended by ``append_once``, in folders by ``partition_by``.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | None = None, buckets: int = 64, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.key, self.buckets, self.partition_by = spark, path.rstrip("/"), key, buckets, tuple(partition_by)
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- manifests ----------------------------------------------------------------------

    def _manifest_path(self, version: int):
        return self._at(f"{self.path}/manifests/{version:012d}.json")

    def manifest(self) -> Manifest:
        """The newest version; version 0 is the empty table."""
        folder = self._at(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return Manifest()
        names = sorted(n for n in (s.getPath().getName() for s in self._fs.listStatus(folder)) if n.endswith(".json"))
        if not names:
            return Manifest()
        stream = self._fs.open(self._at(folder, names[-1]))
        try:
            return Manifest(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _commit(self, new: Manifest) -> Manifest:
        """Makes ``new`` the table in one step: a complete file gets its name, unless the name is taken."""
        target = self._manifest_path(new.version)
        temporary = self._at(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        stream = self._fs.create(temporary, False)
        try:
            stream.write(bytearray(new.to_json().encode("utf-8")))
        finally:
            stream.close()
        if self._fs.exists(target) or not self._fs.rename(temporary, target):
            self._fs.delete(temporary, False)
            raise ConcurrentLoad(f"version {new.version} of {self.path} exists")
        return new

    # ---- reading ------------------------------------------------------------------------

    def _schema(self, manifest: Manifest) -> T.StructType:
        return T.StructType.fromJson(manifest.schema)

    def _read(self, manifest: Manifest, folders: Sequence[str]) -> DataFrame:
        schema = self._schema(manifest)
        if not folders:
            return self.spark.createDataFrame([], schema)
        names = [f.name for f in schema.fields]
        hidden = T.StructType(schema.fields + [T.StructField(LOAD, T.StringType())] + ([T.StructField(GROUP, T.IntegerType())] if self.key else []))
        rows = self.spark.read.schema(hidden).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/{f}" for f in folders])
        return rows.select(*names)

    def read(self) -> DataFrame:
        """The rows of the newest version. A table that never had a load is an error."""
        manifest = self.manifest()
        if manifest.schema is None:
            raise ValueError(f"{self.path} has no version yet")
        return self._read(manifest, [f for folders in manifest.live.values() for f in folders])

    def _checked(self, df: DataFrame, manifest: Manifest) -> DataFrame:
        """``df`` with the columns of the table, by name and type."""
        if manifest.schema is None:
            return df
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self._schema(manifest).fields])

    # ---- loads --------------------------------------------------------------------------

    def append_once(self, df: DataFrame, load_id: str) -> bool:
        """Appends ``df`` unless a load of that name is in the table already; whether it did.

        The name is committed with the rows, so a load that is repeated after a crash at any
        point adds its rows exactly once.
        """
        manifest = self.manifest()
        if load_id in manifest.loads:
            return False
        df = self._checked(df, manifest)
        folder = f"{LOAD}={manifest.version + 1}-{uuid.uuid4().hex[:12]}"
        writer = (df.hint("rebalance", *self.partition_by) if self.partition_by else df).write
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(f"{self.path}/data/{folder}")
        schema = manifest.schema or df.schema.jsonValue()
        self._commit(replace(manifest, version=manifest.version + 1, schema=schema, live=manifest.live | {load_id: [folder]}, loads=[*manifest.loads, load_id]))
        return True

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def upsert(self, df: DataFrame, order: Sequence[str] = (), load_id: str | None = None) -> list[int]:
        """Rows of ``df`` replace those of the table with their key; returns the buckets that were written.

        Of several rows of one key in the load the last by ``order`` counts (then by the other
        columns). Only the buckets that the load has keys of are read and written again; the
        folders of all others stay as they are. NULL is a key like others. With ``load_id`` a
        load that is in the table already changes nothing.
        """
        manifest = self.manifest()
        if load_id is not None and load_id in manifest.loads:
            return []
        df = self._checked(df, manifest)
        names = df.columns
        first = [n for n in order if n != self.key]
        rest = [n for n in names if n != self.key and n not in first]
        # one row a key, and hot keys collapse before the shuffle
        latest = df.groupBy(self.key).agg(F.max(F.struct(*first, *rest)).alias("_row")) if first or rest else df.select(self.key).distinct()
        latest = latest.select(*[F.col(n) if n == self.key else F.col(f"_row.{n}") for n in names])
        folder = f"{LOAD}={manifest.version + 1}-{uuid.uuid4().hex[:12]}"
        staged = f"{self.path}/staged/{folder}"
        latest.withColumn(GROUP, self.bucket_of(F.col(self.key))).write.parquet(staged)
        new = self.spark.read.schema(T.StructType(df.schema.fields + [T.StructField(GROUP, T.IntegerType())])).parquet(staged)
        counts = {r[GROUP]: r.n for r in new.groupBy(GROUP).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per bucket
        if not counts:
            return []
        old_folders = [f for b in counts for f in manifest.live.get(str(b), [])]
        rows = new
        if old_folders:
            kept = self._read(manifest, old_folders).alias("old").join(
                new.select(F.col(self.key).alias("_key")), F.col(f"old.{self.key}").eqNullSafe(F.col("_key")), "left_anti")
            rows = new.unionByName(kept.withColumn(GROUP, self.bucket_of(F.col(self.key))))
        rows.hint("rebalance", GROUP).write.option("maxRecordsPerFile", ROWS_PER_TASK).partitionBy(GROUP).parquet(f"{self.path}/data/{folder}")
        self._fs.delete(self._at(staged), True)
        live = manifest.live | {str(b): [f"{folder}/{GROUP}={b}"] for b in counts}
        loads = [*manifest.loads, load_id] if load_id is not None else manifest.loads
        self._commit(Manifest(manifest.version + 1, manifest.schema or df.schema.jsonValue(), live, loads))
        return sorted(counts)

    def vacuum(self) -> list[str]:
        """Deletes the folders that the newest version does not name, and returns them. Not while a load or an old reader runs."""
        live = {f for folders in self.manifest().live.values() for f in folders}
        data = self._at(f"{self.path}/data")
        if not self._fs.exists(data):
            return []
        gone = []
        for status in self._fs.listStatus(data):
            name = status.getPath().getName()
            inner = [f"{name}/{s.getPath().getName()}" for s in self._fs.listStatus(status.getPath()) if s.isDirectory()] if self.key else []
            if not any(f == name or f.startswith(f"{name}/") for f in live):
                gone.append(name)
            else:
                gone += [f for f in inner if f.split("/")[1].startswith(f"{GROUP}=") and f not in live]
        for f in gone:
            self._fs.delete(self._at(f"{self.path}/data/{f}"), True)
        return gone

    def as_view(self, name: str) -> None:
        """The newest version under a temporary name, for SQL."""
        self.read().createOrReplaceTempView(name)
