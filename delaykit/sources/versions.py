"""Versioned stages: every write is a fresh folder, and a numbered manifest says which folders count.

``path/_versions/<number>`` lists the folders of a version and its columns, ``path/_data/<folder>`` holds rows. A write
puts its rows into a folder of its own and then publishes the next manifest by a rename that fails
if the number is taken. So a write that dies half way leaves the last version as it was, a reader sees one
whole version, and of two writers at once the second takes the other's version into account. Manifests are
read and renamed through Hadoop's file system, so a stage may lie in any store that Spark reaches.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Change = Callable[[list[str]], list[str]]


class Store:
    """The files of one stage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, jvm = spark, spark._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.jvm, self.fs_package = jvm, jvm.org.apache.hadoop.fs
        root = self.fs_package.Path(path)
        self.fs = root.getFileSystem(conf)
        self.root = self.fs.makeQualified(root).toString()
        self.context = self.fs_package.FileContext.getFileContext(self.fs.getUri(), conf)

    def at(self, *names: str):
        return self.fs_package.Path("/".join([self.root, *names]))

    def listed(self, *names: str):
        place = self.at(*names)
        return list(self.fs.listStatus(place)) if self.fs.exists(place) else []

    def numbers(self) -> list[int]:
        names = [f.getPath().getName() for f in self.listed("_versions")]
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self, number: int) -> dict:
        stream = self.fs.open(self.at("_versions", f"{number:012d}"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def folders(self, number: int) -> list[str]:
        return self.manifest(number)["folders"]

    def latest(self) -> tuple[int, list[str]]:
        """(number, folders) of the last version; number 0 and nothing if there is none."""
        numbers = self.numbers()
        return (numbers[-1], self.folders(numbers[-1])) if numbers else (0, [])

    def publish(self, number: int, folders: list[str], columns: dict | None = None) -> bool:
        """Make ``folders`` the version with this number; False if somebody else has taken it."""
        draft = self.at("_versions", f".{uuid.uuid4().hex}")
        stream = self.fs.create(draft, True)
        try:
            stream.write(json.dumps({"folders": folders, "columns": columns}).encode())
        finally:
            stream.close()
        plain = self.spark.sparkContext._gateway.new_array(self.fs_package.Options.Rename, 0)
        try:
            self.context.rename(draft, self.at("_versions", f"{number:012d}"), plain)
            return True
        except Py4JJavaError as error:
            self.fs.delete(draft, False)
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False

    def commit(self, change: Change, columns: dict | None = None) -> int:
        while True:
            number, folders = self.latest()
            if self.publish(number + 1, change(folders), columns):
                return number + 1

    def write(self, df: DataFrame, partition_by: tuple[str, ...]) -> str:
        folder = f"v-{uuid.uuid4().hex}"
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(self.at("_data", folder).toString())
        return folder


def overwrite(df: DataFrame, path: str, *partition_by: str) -> int:
    """Replace the rows of a stage; returns the number of the new version."""
    store = Store(df.sparkSession, path)
    folder = store.write(df, partition_by)
    return store.commit(lambda _: [folder], df.schema.jsonValue())


def append(df: DataFrame, path: str, *partition_by: str) -> int:
    """Add rows to a stage."""
    store = Store(df.sparkSession, path)
    folder = store.write(df, partition_by)
    return store.commit(lambda folders: [*folders, folder], df.schema.jsonValue())


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A version of a stage, the last one unless told otherwise, with the columns of its last write."""
    store = Store(spark, path)
    number = store.latest()[0] if number is None else number
    if not number:
        raise FileNotFoundError(f"{path} has no version")
    found = store.manifest(number)
    schema = StructType.fromJson(found["columns"])
    names = [f"`{c}`" for c in schema.names]
    # each folder is the root of its own partition values, so folders are read one by one
    parts = [spark.read.schema(schema).parquet(store.at("_data", f).toString()).select(*names) for f in found["folders"]]
    return reduce(DataFrame.union, parts)


def start_anew(spark: SparkSession, path: str, first: DataFrame, backup: str) -> int:
    """Copy the last version to the stage ``backup`` and go on with the rows of ``first``. Rows that are
    appended meanwhile are in the copy: the copy is made again until nothing came between."""
    store = Store(spark, path)
    folder = store.write(first, ())
    while True:
        number, _ = store.latest()
        if number:
            overwrite(read(spark, path, number), backup)
        if store.publish(number + 1, [folder], first.schema.jsonValue()):
            return number + 1


def clear(spark: SparkSession, path: str, keep: int = 1, older_than: float = 86400.0) -> list[str]:
    """Remove manifests before the last ``keep`` and the folders that no kept one lists, if they were last
    touched ``older_than`` seconds ago: a younger one may belong to a write under way."""
    store = Store(spark, path)
    numbers = store.numbers()
    for number in numbers[: max(0, len(numbers) - keep)]:
        store.fs.delete(store.at("_versions", f"{number:012d}"), False)
    used = {f for n in numbers[-keep:] for f in store.folders(n)}
    limit, gone = (time.time() - older_than) * 1000, []
    for status in store.listed("_data"):
        name = status.getPath().getName()
        if name not in used and status.getModificationTime() <= limit:
            store.fs.delete(status.getPath(), True)
            gone.append(name)
    return gone
