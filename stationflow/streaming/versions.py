"""Partitioned Parquet tables as atomic versions.

Layout under the table's root:

- ``data/<write>/_slot=<n>/``: data files; a write's slot holds one partition whole;
- ``manifests/<write>/``: the live partitions of a version (partition value, folder, rows);
- ``commits/<version>``: the version's marker, naming its manifest and the schema.

A version is there when its marker is there. The marker is written aside and
renamed to its number without overwriting, so of two writers that build on one
version one gets the number and the other starts again from the newer state. A
reader resolves the newest marker once and then reads only folders that no
later write touches: it never sees a half-done change, and older versions stay
readable until :meth:`VersionedTable.vacuum`. A writer that dies leaves a folder
that no manifest names.

The manifest has one row for each partition and is the only part that the
driver reads whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.session import materialize
from stationflow.streaming.incremental import incremental_upsert


class VersionConflict(RuntimeError):
    """Other writers took every version number that this one tried for."""


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p), fs


def _write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole under a name that must be free; False if it is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    aside, fs = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    to, _ = _path(spark, path)
    files = hadoop.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(aside, to, no_options)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, F.Column]:
    """``right`` with its columns renamed, and the condition that both agree in them (null agrees with null)."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") for c in columns], *[c for c in right.columns if c not in columns])
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(F.col(f"_r_{c}"))
    return renamed, condition


def only(rows: DataFrame, some: DataFrame, columns: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose values of the columns are (``left_anti``: are not) among ``some``, nulls included."""
    other, condition = _same(rows, some.select(*columns), columns)
    return rows.join(other, condition, how)


class VersionedTable:
    """A table at ``root``, partitioned by one column (which the files hold, too)."""

    def __init__(self, spark: SparkSession, root: str, partition_col: str):
        self.spark, self.root, self.partition_col = spark, root.rstrip("/"), partition_col

    # ---- reading
    def versions(self) -> list[int]:
        path, fs = _path(self.spark, f"{self.root}/commits")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n) for n in names if n.isdigit())

    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        return max(self.versions(), default=0)

    def _marker(self, version: int) -> dict:
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{self.root}/commits/{version:010d}").collect()))

    def meta(self, version: int | None = None) -> dict:
        """What the version's writer noted."""
        version = self.version() if version is None else version
        return self._marker(version)["meta"] if version else {}

    def manifest(self, version: int | None = None) -> DataFrame | None:
        """(partition value, folder, rows) of the version's live partitions."""
        version = self.version() if version is None else version
        return self.spark.read.parquet(f"{self.root}/manifests/{self._marker(version)['write']}") if version else None

    def read(self, version: int | None = None, partitions: DataFrame | None = None) -> DataFrame | None:
        """The table as of a version; with ``partitions`` (rows with the partition column) only those. None before the first commit."""
        version = self.version() if version is None else version
        if not version:
            return None
        marker = self._marker(version)
        live = self.spark.read.parquet(f"{self.root}/manifests/{marker['write']}")
        if partitions is not None:
            live = only(live, partitions, [self.partition_col])
        folders = [f"{self.root}/{r[0]}" for r in live.select("folder").collect()]
        schema = T.StructType.fromJson(marker["schema"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def changed(self, since: int, until: int | None = None) -> DataFrame:
        """Partition values whose content a commit between the two versions replaced, added or removed."""
        p = self.partition_col
        new = self.manifest(until)
        if not since:
            return new.select(p)
        old, condition = _same(new, self.manifest(since).withColumnRenamed("folder", "_f").drop("rows"), [p])
        both = new.join(old, condition, "full_outer")
        return both.filter(~F.col("folder").eqNullSafe(F.col("_f"))).select(F.when(F.col("folder").isNull(), F.col(f"_r_{p}")).otherwise(F.col(p)).alias(p))

    # ---- writing
    def commit(self, rows: DataFrame, touched: DataFrame, based_on: int, meta: dict | None = None) -> int:
        """Replace the ``touched`` partitions by ``rows`` on top of version ``based_on``.

        Returns the new version, or 0 if another writer has taken its number.
        Every row's partition must be among the touched ones; a touched
        partition without rows goes.
        """
        spark, p = self.spark, self.partition_col
        write = f"{based_on + 1:010d}-{uuid.uuid4().hex[:12]}"
        place = F.row_number().over(Window.orderBy(F.col(p).asc_nulls_first())) - 1  # one row for each partition
        slots = materialize(touched.select(p).distinct().withColumn("_slot", place), "slots")
        other, condition = _same(rows, slots, [p])
        dealt = rows.join(other, condition).select(*rows.columns, "_slot")
        # ranges of (partition, value): a busy partition is split over several files
        dealt.repartitionByRange("_slot", F.xxhash64(*rows.columns)).write.partitionBy("_slot").parquet(f"{self.root}/data/{write}")
        back = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_slot", T.IntegerType())])).parquet(f"{self.root}/data/{write}")
        folder = F.concat(F.lit(f"data/{write}/_slot="), F.col("_slot").cast("string"))
        live = back.groupBy("_slot").agg(F.count(F.lit(1)).alias("rows")).join(slots, "_slot").select(p, folder.alias("folder"), "rows")
        old = self.manifest(based_on)
        if old is not None:
            live = live.unionByName(only(old, slots, [p], "left_anti"))
        live.write.parquet(f"{self.root}/manifests/{write}")
        text = json.dumps({"write": write, "schema": json.loads(rows.schema.json()), "meta": meta or {}})
        return based_on + 1 if _write_once(spark, f"{self.root}/commits/{based_on + 1:010d}", text) else 0

    def upsert(self, batch: DataFrame, key: Sequence[str], order: Sequence[str] = (), attempts: int = 5, meta: dict | None = None) -> int:
        """Merge a batch by key as one new version: batch rows win, the newest ``order`` first.

        The touched partitions are those of the batch and, unless the key
        holds the partition column, those where a row of a key of the batch
        is now, so a row whose key moves leaves its old partition.
        """
        p = self.partition_col
        fresh = materialize(batch, "version-batch")
        for _ in range(attempts):
            base = self.version()
            touched = fresh.select(p)
            current = self.read(base)
            if current is not None and p not in key:
                touched = touched.unionByName(only(current.select(*key, p), fresh, key).select(p))
            touched = materialize(touched.distinct(), "touched")
            held = fresh.drop(*order).limit(0) if current is None else self.read(base, touched)
            merged = incremental_upsert(held, fresh, key, order).select(*held.columns)
            version = self.commit(merged, touched, base, meta)
            if version:
                return version
        raise VersionConflict(f"{self.root}: {attempts} attempts")

    def vacuum(self, keep: int = 1) -> int:
        """Delete versions older than the ``keep`` newest ones, and the files that no kept version names; returns the folders deleted."""
        spark = self.spark
        versions = self.versions()
        kept, gone = versions[-keep:], versions[:-keep]
        writes = {self._marker(v)["write"] for v in kept}
        named = set()
        for v in kept:
            named |= {r[0] for r in self.manifest(v).select("folder").collect()}
        for v in gone:  # markers first: a reader that resolves now finds a kept version
            path, fs = _path(spark, f"{self.root}/commits/{v:010d}")
            fs.delete(path, False)
        deleted = 0
        newest = max(versions, default=0)
        for kind in ("data", "manifests"):
            path, fs = _path(spark, f"{self.root}/{kind}")
            for write in fs.listStatus(path) if fs.exists(path) else ():
                name = write.getPath().getName()
                if int(name.split("-")[0]) > newest:
                    continue  # a writer may be at work on the next version
                slots = [s.getPath() for s in fs.listStatus(write.getPath()) if s.isDirectory()] if kind == "data" else []
                live = [s for s in slots if f"data/{name}/{s.getName()}" in named]
                for old in [s for s in slots if s not in live] if live else [write.getPath()] if kind == "data" or name not in writes else []:
                    fs.delete(old, True)
                    deleted += 1
        return deleted
