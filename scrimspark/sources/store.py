"""A keyed copy-on-write store of tables.

A table's rows are in buckets by a hash of its key. A version is one small file that names a folder for each bucket that
has rows, and each table's largest number so far. A commit writes new folders for the buckets that it replaces and then
adds the next version's file; the others keep their folders. The file is put in place by a rename that fails where it
exists, so of two writers that started from one version the second gets Conflict, and a writer that dies leaves the old
version. Its size is bounded by the number of tables times buckets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column of stored rows that tells their key where the table itself doesn't hold it.
KEY = "_key"


class Conflict(Exception):
    """Another writer has committed the version that this one was about to write."""


@dataclass(frozen=True)
class Layout:
    """A table's columns and the column that deals its rows to buckets: None puts all of a small table into one."""

    schema: T.StructType
    key: str | None = None
    number: str | None = None

    @property
    def stored(self) -> T.StructType:
        if self.key in (None, *self.schema.fieldNames()):
            return self.schema
        return T.StructType([*self.schema.fields, T.StructField(self.key, T.LongType())])


@dataclass(frozen=True)
class Version:
    number: int
    buckets: int
    folders: dict[str, dict[int, str]] = field(default_factory=dict)
    largest: dict[str, int] = field(default_factory=dict)


def bucket_of(key: Column, buckets: int) -> Column:
    """Numbers and texts alike: the hash is that of the key's text."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


class Store:
    def __init__(self, spark: SparkSession, root: str, layouts: dict[str, Layout]):
        self.spark, self.root, self.layouts = spark, root.rstrip("/"), layouts
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._top = self._fs.Path(self.root)
        self._files = self._top.getFileSystem(self._conf)

    # versions ------------------------------------------------------------------------------------------------------

    def _version_path(self, number: int):
        return self._fs.Path(f"{self.root}/versions/{number:012d}.json")

    def version_numbers(self) -> list[int]:
        folder = self._fs.Path(f"{self.root}/versions")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def read_version(self, number: int | None = None) -> Version:
        """The newest version, or that of a number; an empty one with number 0 where there is none."""
        number = number or max(self.version_numbers(), default=0)
        if not number:
            return Version(0, 0)
        path = self._version_path(number)
        stream = self._files.open(path)
        try:
            raw = bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        data = json.loads(raw)
        folders = {t: {int(b): f for b, f in of.items()} for t, of in data["folders"].items()}
        return Version(number, data["buckets"], folders, data["largest"])

    def _put_version(self, version: Version) -> None:
        data = json.dumps({"buckets": version.buckets, "folders": version.folders, "largest": version.largest}).encode()
        path = self._version_path(version.number)
        draft = self._fs.Path(f"{self.root}/versions/.{version.number}-{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        context = self._fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        fail = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._files.makeQualified(draft), self._files.makeQualified(path), fail)
        except Exception as e:
            self._files.delete(draft, False)
            if self._files.exists(path):
                raise Conflict(f"version {version.number} is there already") from e
            raise

    # reading -------------------------------------------------------------------------------------------------------

    def table(self, version: Version, name: str, buckets: Iterable[int] | None = None, stored: bool = False) -> DataFrame:
        """A table of a version, or only its given buckets. stored: with the key column that the table doesn't have."""
        layout = self.layouts[name]
        of = version.folders.get(name, {})
        wanted = of if buckets is None else {b: of[b] for b in buckets if b in of}
        paths = [f"{self.root}/{wanted[b]}" for b in sorted(wanted)]
        df = self.spark.read.schema(layout.stored).parquet(*paths) if paths else self.spark.createDataFrame([], layout.stored)
        return df if stored else df.select(*layout.schema.fieldNames())

    def tables(self, version: Version | None = None) -> dict[str, DataFrame]:
        version = version or self.read_version()
        return {n: self.table(version, n) for n in self.layouts}

    # writing -------------------------------------------------------------------------------------------------------

    def write(self, version: Version, tables: dict[str, DataFrame], touched: dict[str, set[int] | None], buckets: int | None = None) -> Version:
        """Writes the rows of the touched buckets (None: all of them) and returns the next version, which isn't there yet
        for readers. Columns that a table lacks are null. A bucket of any size is dealt to as many tasks as its size asks for."""
        n = version.buckets or buckets or 1
        folders, largest, data = {t: dict(f) for t, f in version.folders.items()}, dict(version.largest), f"data/{uuid.uuid4().hex}"
        for name, df in tables.items():
            layout = self.layouts[name]
            rows = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in layout.stored])
            bucket = bucket_of(F.col(layout.key), n) if layout.key else F.lit(0)
            path = f"{data}/{name}"
            rows.withColumn("bucket", bucket).hint("rebalance", "bucket").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{self.root}/{path}")
            there = self._files.listStatus(self._fs.Path(f"{self.root}/{path}"))
            new = {int(f.removeprefix("bucket=")): f"{path}/{f}" for f in (s.getPath().getName() for s in there) if f.startswith("bucket=")}
            gone = touched.get(name)
            old = folders.get(name, {})
            folders[name] = ({} if gone is None else {b: f for b, f in old.items() if b not in gone}) | new
            if layout.number and new:
                written = self.spark.read.schema(layout.stored).parquet(*[f"{self.root}/{f}" for f in new.values()])
                largest[name] = max(largest.get(name, 0), written.agg(F.max(layout.number)).first()[0] or 0)
        return Version(version.number + 1, n, folders, largest)

    def commit(self, version: Version) -> Version:
        self._put_version(version)
        return version

    def replace(self, tables: dict[str, DataFrame], buckets: int = 64) -> Version:
        """A version in which these tables hold just these rows."""
        return self.commit(self.write(self.read_version(), tables, {}, buckets))

    def drop_old_versions(self, keep: int = 2) -> None:
        """Deletes all but the ``keep`` newest versions, and the folders that these don't name, those of writers that
        died too. Readers of older versions, and other writers, have to be done."""
        numbers = self.version_numbers()
        named = {f for n in numbers[-keep:] for of in self.read_version(n).folders.values() for f in of.values()}
        for n in numbers[:-keep]:
            self._files.delete(self._version_path(n), False)
        data = self._fs.Path(f"{self.root}/data")
        if not self._files.exists(data):
            return
        for batch in (s.getPath() for s in self._files.listStatus(data)):
            tables = [s.getPath() for s in self._files.listStatus(batch)]
            kept = False
            for table in tables:
                for bucket in (s.getPath() for s in self._files.listStatus(table)):
                    if f"data/{batch.getName()}/{table.getName()}/{bucket.getName()}" in named:
                        kept = True
                    elif bucket.getName().startswith("bucket="):
                        self._files.delete(bucket, True)
            if not kept:
                self._files.delete(batch, True)
