"""Tables in versions: written aside, then published by a manifest that appears at once.

``root/data`` holds one folder per write, ``root/manifests`` one file per version with the
folder and the schema. A reader takes the last manifest, so a write that fails, or has not
ended, is never seen. Two writers after the same version: the file system lets one of them
name its manifest, the other gets ``VersionConflict`` and may start from the new version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gradeloom.operators.compare import upsert_metrics
from gradeloom.session import sparing

SUFFIX = ".json"
DIGITS = 20


class VersionConflict(RuntimeError):
    """Another writer has published the version that was to be published."""


class _Folder:
    """The manifest folder on whatever file system holds it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/manifests")
        self.fs = self.path.getFileSystem(conf)
        self.path = self.fs.makeQualified(self.path)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path.toUri(), conf)

    def _file(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def versions(self) -> list[int]:
        if not self.fs.exists(self.path):
            return []
        names = [status.getPath().getName() for status in self.fs.listStatus(self.path)]
        return sorted(int(n.removesuffix(SUFFIX)) for n in names if n.endswith(SUFFIX) and n.removesuffix(SUFFIX).isdigit())

    def read(self, version: int) -> dict:
        text = self.spark.read.text(self._file(f"{version:0{DIGITS}}{SUFFIX}").toString(), wholetext=True).first()[0]
        return json.loads(text)

    def add(self, version: int, content: dict) -> None:
        """The file is filled under another name; the rename fails where the version exists."""
        aside = self._file(f"_{uuid.uuid4().hex}")
        out = self.fs.create(aside, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self.context.rename(aside, self._file(f"{version:0{DIGITS}}{SUFFIX}"), options)
        except Exception:
            self.fs.delete(aside, False)
            if version in self.versions():
                raise VersionConflict(f"version {version} of {self.path} is published already") from None
            raise


def last_version(spark: SparkSession, root: str) -> int | None:
    """Number of the last published version, none where nothing is."""
    found = _Folder(spark, root).versions()
    return found[-1] if found else None


def publish(df: DataFrame, root: str, after: int | None = None) -> int:
    """Write ``df`` as the version after ``after`` (the last one, none: the first) and return its number.

    Nothing is published when the write fails, or when another version came in between.
    """
    folder = _Folder(df.sparkSession, root)
    version = (after or 0) + 1
    data = f"data/{version:0{DIGITS}}-{uuid.uuid4().hex}"
    with sparing(df.sparkSession):
        df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{data}")
    folder.add(version, {"version": version, "data": data, "schema": df.schema.jsonValue()})
    return version


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A published version, the last one by default; later writes do not change what it reads."""
    folder = _Folder(spark, root)
    version = version if version is not None else last_version(spark, root)
    if version is None:
        raise ValueError(f"nothing is published in {root}")
    manifest = folder.read(version)
    schema = T.StructType.fromJson(manifest["schema"])
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{manifest['data']}")


def change(spark: SparkSession, root: str, made: Callable[[DataFrame | None], DataFrame], attempts: int = 5) -> int:
    """Publish ``made(last version)``; after a conflict again, from the version that came in between."""
    for attempt in range(attempts):
        after = last_version(spark, root)
        current = None if after is None else read_version(spark, root, after)
        try:
            return publish(made(current), root, after)
        except VersionConflict:
            if attempt == attempts - 1:
                raise
    raise ValueError("attempts must be 1 at least")


def upsert_version(update: DataFrame, root: str, key: Sequence[str], attempts: int = 5) -> int:
    """Publish the last version with the rows of ``update`` put in by ``key``; the first one is ``update`` itself."""
    return change(
        update.sparkSession, root, lambda current: update if current is None else upsert_metrics(current, update, key), attempts
    )
