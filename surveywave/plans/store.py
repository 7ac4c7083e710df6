"""Published tables: immutable version folders and one small pointer.

    <table>/_versions/00000007.json      what version 7 is made of
    <table>/_v=00000007-<id>/…           data that version 7 wrote

A version is a list of folders.  Data is written first, into a folder no reader
knows; the pointer of the next version is written last, by a rename that fails
if it is there already.  So

* a reader that has opened a version goes on reading whole files of it, whatever
  is published meanwhile, and a new reader sees the old or the new version;
* of two writers that started from the same version one wins, and the other gets
  ``Conflict`` and leaves nothing that a reader could see.

A table may be cut into buckets by a key.  ``replace_buckets`` writes new folders
for some of them, and the next version names the old folders for the others:
their files are not touched.  Folders that no recent version names are removed by
``vacuum``.

The rename is atomic where the file system's is (HDFS).  On an object store
without one, let a single job publish a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET, VERSION = "_bucket", "_v"


class Conflict(RuntimeError):
    """Another writer published the version first."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: StructType
    folders: dict[int, list[str]]   # bucket (-1: not cut into buckets) → folders below the table's
    keys: list[str]                 # what buckets are made of
    buckets: int
    info: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "schema": self.schema.jsonValue(), "folders": {str(k): v for k, v in self.folders.items()},
                           "keys": self.keys, "buckets": self.buckets, "info": self.info})

    @staticmethod
    def from_json(text: str) -> Version:
        d = json.loads(text)
        return Version(d["number"], StructType.fromJson(d["schema"]), {int(k): v for k, v in d["folders"].items()}, d["keys"], d["buckets"], d["info"])


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row; NULL keys have one too."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class TableStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs_classes = spark._jvm.org.apache.hadoop.fs

    # -- pointer ------------------------------------------------------------
    def _path(self, *parts: str):
        return self._fs_classes.Path("/".join([self.path, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder = self._path("_versions")
        if not self._fs().exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int | None = None) -> Version | None:
        """A published version, the latest if none is named; None without any."""
        numbers = self.versions()
        if not numbers:
            return None
        stream = self._fs().open(self._path("_versions", f"{numbers[-1] if number is None else number:08d}.json"))
        try:
            return Version.from_json(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: Version) -> Version:
        jvm = self.spark._jvm
        context = self._fs_classes.FileContext.getFileContext(self._path().toUri(), self.spark._jsc.hadoopConfiguration())
        made = self._path("_versions", f".{uuid.uuid4().hex}.tmp")
        self._fs().mkdirs(self._path("_versions"))
        out = self._fs().create(made, False)
        out.write(bytearray(version.to_json().encode()))
        out.close()
        no_options = self.spark.sparkContext._gateway.new_array(getattr(self._fs_classes, "Options$Rename"), 0)
        try:
            context.rename(made, self._path("_versions", f"{version.number:08d}.json"), no_options)
        except Exception as error:
            self._fs().delete(made, False)
            self._drop([f for fs in version.folders.values() for f in fs if f.startswith(f"{VERSION}={version.number:08d}-")])
            if "exist" in str(error).lower():
                raise Conflict(f"{self.path}: version {version.number} was published by another writer") from error
            raise
        return version

    def _drop(self, folders: Iterable[str]) -> None:
        for top in {f.split("/")[0] for f in folders}:
            self._fs().delete(self._path(top), True)

    # -- reading --------------------------------------------------------------
    def read(self, number: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """A version as a DataFrame; only some of its buckets if they are named."""
        version = self.version(number)
        if version is None:
            raise FileNotFoundError(f"{self.path}: nothing is published")
        chosen = version.folders if buckets is None else {b: version.folders.get(b, []) for b in buckets}
        paths = [f"{self.path}/{f}" for fs in chosen.values() for f in fs]
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        return (self.spark.read.schema(version.schema).option("basePath", self.path).parquet(*paths)
                .select(*[F.col(f"`{c}`") for c in version.schema.names]))

    # -- writing --------------------------------------------------------------
    def _write(self, df: DataFrame, number: int, keys: Sequence[str], buckets: int, by: Sequence[str], sort: Sequence[str],
               options: dict[str, str] | None) -> dict[int, list[str]]:
        top = f"{VERSION}={number:08d}-{uuid.uuid4().hex}"
        parts = list(by)
        if keys:
            # rows of a bucket meet, but a bucket that is too large is split again (AQE)
            df = df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET)
            parts = [BUCKET, *parts]
        elif parts:
            df = df.hint("rebalance", *parts)
        if parts or sort:
            df = df.sortWithinPartitions(*parts, *sort)
        writer = df.write.options(**(options or {}))
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{self.path}/{top}")
        if not keys:
            return {-1: [top]}
        names = [s.getPath().getName() for s in self._fs().listStatus(self._path(top))]
        return {int(n.split("=")[1]): [f"{top}/{n}"] for n in names if n.startswith(f"{BUCKET}=")}

    def replace(self, df: DataFrame, expected: int | None = None, keys: Sequence[str] = (), buckets: int = 0, by: Sequence[str] = (),
                sort: Sequence[str] = (), info: dict | None = None, options: dict[str, str] | None = None) -> Version:
        """Publish df as the next version.  ``expected`` is the version it was
        made from (0: none); the present one if not given."""
        expected = (self.versions() or [0])[-1] if expected is None else expected
        folders = self._write(df, expected + 1, keys, buckets, by, sort, options)
        return self._publish(Version(expected + 1, df.schema, folders, list(keys), buckets, info or {}))

    def replace_buckets(self, df: DataFrame, touched: Iterable[int], expected: int, sort: Sequence[str] = (), info: dict | None = None) -> Version:
        """Publish version ``expected`` with the rows of the touched buckets
        replaced by df, which has rows of those buckets only."""
        old = self.version(expected)
        written = self._write(df, expected + 1, old.keys, old.buckets, [], sort, None)
        gone = set(touched)
        if not set(written) <= gone:
            self._drop(f for fs in written.values() for f in fs)
            raise ValueError(f"rows outside the touched buckets: {sorted(set(written) - gone)}")
        folders = {b: f for b, f in old.folders.items() if b not in gone} | written
        return self._publish(Version(expected + 1, old.schema, folders, old.keys, old.buckets, old.info if info is None else info))

    def vacuum(self, keep: int = 2) -> None:
        """Forget all but the latest versions and remove data that none of the
        others names.  A reader of a version that is forgotten fails; a writer at
        work is safe, as its folder is named for a version yet to come."""
        numbers = self.versions()
        kept, gone = numbers[-keep:], numbers[:-keep]
        named = {f for n in kept for fs in self.version(n).folders.values() for f in fs}
        dropped = {f for n in gone for fs in self.version(n).folders.values() for f in fs} - named
        for n in gone:
            self._fs().delete(self._path("_versions", f"{n:08d}.json"), False)
        for f in dropped:
            self._fs().delete(self._path(f), True)
