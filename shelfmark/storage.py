"""Small file-system calls: in the driver through Hadoop, in tasks through Arrow."""

from __future__ import annotations

import re
from urllib.parse import urlsplit

import pyarrow.fs as pafs
from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def literal(path: str) -> str:
    """A path as a pattern that matches only itself."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Directory entries that match; lists only the levels the pattern names."""
    fs, hadoop_path = _open(spark, pattern)
    found = fs.globStatus(hadoop_path)
    return [status.getPath().toString() for status in found] if found is not None else []


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete when it appears under its name: written beside it first."""
    fs, hadoop_path = _open(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f".{hadoop_path.getName()}.part")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(hadoop_path, False)
    if not fs.rename(beside, hadoop_path):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _open(spark, path)
    opened = fs.open(hadoop_path)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.-]+):")


def scheme_of(path: str) -> str:
    found = _SCHEME.match(path)
    return found[1].lower() if found else "file"


def task_settings(spark: SparkSession, root: str) -> dict[str, str] | None:
    """What tasks need to reach ``root`` by Arrow; None where Arrow has no way.

    Paths without a scheme belong to the cluster's default file system. Keys come
    from the Hadoop settings and travel with the tasks, as Hadoop's own do.
    """
    conf = spark._jsc.hadoopConfiguration()
    fs, hadoop_path = _open(spark, root)
    uri = fs.makeQualified(hadoop_path).toString()
    scheme, place = scheme_of(uri), urlsplit(uri)
    found = {"scheme": scheme}
    if scheme in ("s3", "s3a", "s3n"):
        for name, key in (("access_key", "access.key"), ("secret_key", "secret.key"), ("region", "endpoint.region"), ("endpoint_override", "endpoint")):
            value = conf.get(f"fs.s3a.bucket.{place.netloc}.{key}") or conf.get(f"fs.s3a.{key}")
            found |= {name: value} if value else {}
    elif scheme in ("abfs", "abfss"):
        host = place.netloc.rpartition("@")[2]
        key = conf.get(f"fs.azure.account.key.{host}")
        found |= {"account_name": host.partition(".")[0]} | ({"account_key": key} if key else {})
    elif scheme == "hdfs":
        found |= {"host": place.netloc.partition(":")[0], "port": place.netloc.partition(":")[2] or "8020"}
    elif scheme != "file":
        return None
    return found


def task_store(settings: dict[str, str]) -> pafs.FileSystem:
    """The file system that :func:`task_settings` describes."""
    options = {name: value for name, value in settings.items() if name != "scheme"}
    if settings["scheme"] == "file":
        return pafs.LocalFileSystem()
    if settings["scheme"] == "hdfs":
        return pafs.HadoopFileSystem(options["host"], int(options["port"]))
    if settings["scheme"].startswith("abfs"):
        return pafs.AzureFileSystem(**options)
    return pafs.S3FileSystem(**options)


def task_path(spark: SparkSession, root: str) -> str:
    """``root`` as a path within the file system of :func:`task_store`."""
    fs, hadoop_path = _open(spark, root)
    uri = fs.makeQualified(hadoop_path)
    path, scheme = uri.toUri().getPath(), scheme_of(uri.toString())
    netloc = uri.toUri().getAuthority() or ""
    if scheme in ("s3", "s3a", "s3n"):
        return netloc + path
    if scheme.startswith("abfs"):
        return netloc.partition("@")[0] + path
    return path
