"""All tables of a warehouse at once: staged folders, and a numbered manifest that readers follow.

A load writes its tables below new names, and then one small file that names them all.  Until that is there, readers
see the load before; whoever fails on the way leaves nothing that is read.  The number of the
file is one more than that of the load it is based on, and the file is only made if there is none of that number, so
of two loads with one base the second is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "_manifest"


class Superseded(RuntimeError):
    """Another load was published since this one began."""


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _name(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{version:010d}.json"


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _files(spark, f"{root.rstrip('/')}/{FOLDER}")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:10].isdigit())


def _content(spark: SparkSession, root: str, version: int) -> dict | None:
    """What a manifest says; None where its writer has not got to the end."""
    fs, path = _files(spark, _name(root, version))
    size = fs.getFileStatus(path).getLen()
    stream = fs.open(path)
    try:
        text = bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()
    return json.loads(text) if text.endswith("\n") else None


def current(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """The last published manifest, or the one of a version; None if there is none."""
    for v in reversed(_versions(spark, root)):
        if version is None or v == version:
            found = _content(spark, root, v)
            if found is not None:
                return found
    return None


def last_number(spark: SparkSession, root: str) -> int:
    """The highest number that was taken, published or not; 0 before the first."""
    return max(_versions(spark, root), default=0)


def publish(spark: SparkSession, root: str, number: int, content: dict) -> dict:
    """Make ``content`` the manifest of that number, unless there is one."""
    fs, path = _files(spark, _name(root, number))
    fs.mkdirs(path.getParent())
    try:
        stream = fs.create(path, False)
    except Exception as e:  # noqa: BLE001
        if fs.exists(path):
            raise Superseded(f"load {number} of {root} is there already") from e
        raise
    content = {**content, "version": number}
    try:
        stream.write((json.dumps(content) + "\n").encode())
    finally:
        stream.close()
    return content


def stage(df: DataFrame, root: str, table: str) -> str:
    """Write a table below a new name, which nobody reads before it is published."""
    path = f"{root.rstrip('/')}/{table}/load={uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def read_table(spark: SparkSession, manifest: dict, table: str) -> DataFrame | None:
    """A table of a published load; the parts of several loads are one table."""
    paths = manifest["tables"].get(table)
    return spark.read.parquet(*paths) if paths else None
