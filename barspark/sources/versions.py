"""Partitioned Parquet folders whose loads are one transaction.

A load writes its partitions into a new folder ``data/version=<n>-<id>`` and
then switches with one small file, ``manifests/<n>.json``: which version each
live partition is in, and which stream epochs have been applied.  The
switch is a rename, so a reader sees the rows before a load or after it,
a load that dies on the way changes nothing, and a repeated epoch is known
and left out.  Readers list only the live partition folders that they ask for.

The manifest has one entry per partition (not per file or row); it is the
only thing that the driver holds.  One writer at a time: a second one that
began from the same manifest is refused at its switch.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LoadConflict(RuntimeError):
    """Another load switched first."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partitions: list[str]):
        self.spark, self.path, self.partitions = spark, path.rstrip("/"), partitions
        self._path = lambda *p: spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *p]))
        self._fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ manifest

    def _names(self, *folder: str) -> list[str]:
        at = self._path(*folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def manifest(self) -> dict:
        """The newest one: number ``n`` (0: no load yet), ``live`` partition folder -> version, ``epochs`` stream -> last one, ``schema``."""
        names = sorted(x for x in self._names("manifests") if x.endswith(".json"))
        if not names:
            return {"n": 0, "live": {}, "epochs": {}, "schema": None}
        stream = self._fs.open(self._path("manifests", names[-1]))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def switch(self, manifest: dict) -> None:
        """Make ``manifest`` the newest one; the moment a load becomes visible."""
        name = f"{manifest['n']:010d}.json"
        draft, target = self._path("manifests", f".{name}-{uuid.uuid4().hex[:8]}"), self._path("manifests", name)
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise LoadConflict(f"{self.path}: load {manifest['n']} exists")

    # ------------------------------------------------------------ reading

    def _read(self, manifest: dict, folders) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/data/version={manifest['live'][f]}/{f}" for f in sorted(folders)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
        return self.spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*paths).select(*schema.names)

    def read(self, **values) -> DataFrame:
        """The live rows; ``values`` name partition values to which the listing itself is held."""
        m = self.manifest()
        if m["schema"] is None:
            raise FileNotFoundError(f"{self.path} has no load")
        asked = {f"{k}={_escape(self.spark, v)}" for k, v in values.items()}
        return self._read(m, [f for f in m["live"] if asked <= set(f.split("/"))])

    # ------------------------------------------------------------ loads

    def _write(self, df: DataFrame, n: int) -> tuple[str, list[str]]:
        version = f"{n}-{uuid.uuid4().hex[:10]}"
        df.write.mode("errorifexists").partitionBy(*self.partitions).parquet(f"{self.path}/data/version={version}")
        folders = [""]
        for _ in self.partitions:
            folders = [f"{f}/{x}".lstrip("/") for f in folders for x in self._names("data", f"version={version}", *f.split("/")) if "=" in x]
        return version, folders

    def _load(self, df: DataFrame, manifest: dict, epoch: tuple[str, int] | None) -> None:
        n = manifest["n"] + 1
        version, folders = self._write(df, n)
        epochs = dict(manifest["epochs"]) | ({epoch[0]: epoch[1]} if epoch else {})
        self.switch({"n": n, "live": manifest["live"] | dict.fromkeys(folders, version), "epochs": epochs,
                     "schema": manifest["schema"] or json.loads(df.schema.json())})

    def _done(self, manifest: dict, epoch: tuple[str, int] | None) -> bool:
        return epoch is not None and manifest["epochs"].get(epoch[0], -1) >= epoch[1]

    def replace(self, df: DataFrame, epoch: tuple[str, int] | None = None) -> None:
        """The partitions that ``df`` has rows of hold those rows afterwards; all others stay."""
        m = self.manifest()
        if not self._done(m, epoch):
            self._load(df, m, epoch)

    def merge(self, df: DataFrame, keys: list[str], order: list[str] | None = None, epoch: tuple[str, int] | None = None) -> None:
        """Of each key one row stays: the one of ``df`` with the largest ``order`` (by default its other columns, left to
        right), else the table's.  Only touched partitions are read and written anew."""
        m = self.manifest()
        if self._done(m, epoch):
            return
        rest = order or [c for c in df.columns if c not in keys]
        own = F.struct(*[F.col(c) for c in df.columns])
        newest = df.groupBy(*[F.col(c).alias(f"_key_{c}") for c in keys]).agg(F.max_by(own, F.struct(*rest)).alias("_row")).select("_row.*")
        if m["live"]:
            touched = [_folder(self.spark, r, self.partitions) for r in df.select(*self.partitions).distinct().collect()]  # folders, not rows
            have = self._read(m, [f for f in touched if f in m["live"]]).select(*df.columns)
            newest = newest.unionByName(have.join(df.select(*keys).distinct(), keys, "left_anti"))
        self._load(newest, m, epoch)

    def vacuum(self) -> int:
        """Remove version folders that the newest manifest does not name, and older manifests; how many versions went.

        Readers that began before may still want them: run it when none does."""
        m = self.manifest()
        keep = {f"version={v}" for v in m["live"].values()}
        gone = [x for x in self._names("data") if x.startswith("version=") and x not in keep]
        for x in gone:
            self._fs.delete(self._path("data", x), True)
        for x in self._names("manifests"):
            if x.endswith(".json") and int(x[:-5]) < m["n"]:
                self._fs.delete(self._path("manifests", x), False)
        return len(gone)


def _escape(spark: SparkSession, value) -> str:
    """A partition value as Spark writes it into a folder name."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


def _folder(spark: SparkSession, row, partitions: list[str]) -> str:
    return "/".join(f"{p}={_escape(spark, row[p])}" for p in partitions)


def month_of(ts: Column) -> Column:
    """``yyyy-MM`` of a time, a partition value that keeps files of small bars large."""
    return F.date_format(ts, "yyyy-MM")
