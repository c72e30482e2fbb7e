"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.session import checkpoint_dir

#: ASCII white space: what separates words in the contracts of the text operators.
WHITE_SPACE = b" \t\n\x0b\x0c\r"


def let_workers_import(spark: SparkSession) -> None:
    """Adds the folder that holds this library to the workers' import path.

    Needed where the driver found the library through its own working folder; on a cluster that ships
    the library with the job (``--py-files``) the extra entry does nothing.
    """
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(p for p in (home, env.get("PYTHONPATH", "")) if p)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def appending(df: DataFrame, fields: Sequence[T.StructField],
              compute: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list[pa.Array]]]]) -> DataFrame:
    """``df`` with computed columns behind its own; an input column of a computed column's name is replaced.

    ``compute`` yields each record batch with one array per field.
    """
    names = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    keep = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, arrays in compute(batches):
            columns = [batch.column(i) for i in keep]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], [f.name for f in (*kept, *fields)])

    return df.mapInArrow(run, T.StructType([*kept, *fields]))


_kept: list = [None, None]


def kept_by_worker(key: tuple, make: Callable[[], object] = lambda: None) -> object:
    """What a Python worker keeps from task to task: ``make()`` of the last ``key`` only.

    Spark reuses workers for tasks of any operator; with one place for tables and caches, a worker never holds those of
    an operator that has ended beside those of the one that runs.
    """
    if _kept[0] != key:
        _kept[:] = [None, None]
        _kept[:] = [key, make()]
    return _kept[1]


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [b if b is not None else b"" for b in column.cast(pa.large_binary()).to_pylist()]


def runs_of(lengths: Sequence[int], limit: int) -> Iterator[slice]:
    """Consecutive slices whose lengths add up to about ``limit`` at most; a longer item is alone."""
    begin, total = 0, 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > limit:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield slice(begin, len(lengths))


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Exclusive prefix sums."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
