"""Files of executors and driver in a shared folder, by path or URI (local, HDFS, S3, ...).

A folder's name is qualified once, on the driver, by Spark's own rules, so that workers write their files to the file
system that Spark writes its Parquet to, also where ``fs.defaultFS`` is not the local one.
"""

from __future__ import annotations

import numpy as np
from pyarrow import fs
from pyspark.sql import SparkSession

#: Schemes of Hadoop's connectors and what the workers' file systems call them.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfss": "abfss", "abfs": "abfs"}


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's readers and writers take it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def located(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    scheme, found, rest = uri.partition("://")
    if not found:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")


def write_array(uri: str, values: np.ndarray) -> None:
    system, path = located(uri)
    with system.open_output_stream(path) as out:
        out.write(values.tobytes())


def read_array(uri: str, dtype: np.dtype | str) -> np.ndarray:
    """The file's numbers: memory-mapped where the file is local, else read."""
    system, path = located(uri)
    if system.get_file_info(path).size == 0:
        return np.zeros(0, dtype=dtype)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)
