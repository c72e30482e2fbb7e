"""Token files: flat unsigned integers with 64-bit document offsets, for memory-mapped reading.

A corpus is a folder of shards.  Shard s has three little-endian files:
``.tokens`` (token ids, uint16 if the vocabulary fits, else uint32), ``.offsets``
(int64: for each document the number of tokens of the whole corpus before it,
and at the end that behind the last) and ``.ids`` (int64 document ids).  Shards
follow each other in ascending document order, and a Parquet manifest lists them
with their base: the prefix sum of the shards' tokens.

Writing takes two jobs.  The first deals documents out by ranges of their id,
encodes them and writes each partition's tokens with its own lengths; the second
adds the bases, which are known then, to the offsets.  File names are new for
each attempt and only those in the manifest count, so a lost executor or a
repeated task leaves no wrong data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickframe.llm._common import runs_of, starts_of
from tickframe.llm._files import located, qualified, read_array, write_array
from tickframe.llm._tokens import default_tokenizer, encoder

END_ID = 2
BATCH_BYTES = 8_000_000
TOKENS_AT_ONCE = 4_000_000
#: Stands for a null document id in the ids file.
NO_ID = -(2**63)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes ``docs`` (doc_id, text) as token files to the folder ``path``; returns the manifest (also at ``path/manifest``).

    Documents ascend by doc_id (null first; equal ids by a hash of the text), each followed by ``end_id``.  A null text is
    empty.  Repeated rows are kept.  Manifest: shard, name, n_docs, n_tokens, base, dtype.
    """
    spark = docs.sparkSession
    path, tokenizer = qualified(spark, path), tokenizer or default_tokenizer()
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    system, folder = located(path)
    system.create_dir(folder, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        enc, ids, lengths = encoder(tokenizer), [], []
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        system, _ = located(path)
        stem = f"{path}/{shard:06d}-{name}"
        with system.open_output_stream(located(f"{stem}.tokens")[1]) as out:
            for batch in batches:
                texts = batch.column("text").fill_null("")
                ids.append(batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy())
                for part in runs_of(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                    raw = enc.encode(texts.slice(part.start, part.stop - part.start))
                    out.write(b"".join(x for r in raw for x in (r, end)))
                    lengths.append(np.array([len(r) // enc.dtype.itemsize + 1 for r in raw], dtype="<i8"))
        own = np.concatenate([np.zeros(0, "<i8"), *lengths])
        write_array(f"{stem}.ids", np.concatenate([np.zeros(0, "<i8"), *ids]))
        write_array(f"{stem}.lengths", own)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "name": [f"{shard:06d}-{name}"],
                                          "n_docs": [len(own)], "n_tokens": [int(own.sum())], "dtype": [enc.dtype.str]})

    shards = (docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(run, "shard int, name string, n_docs bigint, n_tokens bigint, dtype string"))
    shards.write.parquet(f"{path}/shards")
    shards = spark.read.parquet(f"{path}/shards")
    before = F.sum("n_tokens").over(W.orderBy("shard")) - F.col("n_tokens")  # a row per shard
    based = shards.withColumn("base", before)

    def rebase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist(), strict=True):
                write_array(f"{path}/{name}.offsets", starts_of(np.asarray(read_array(f"{path}/{name}.lengths", "<i8"))) + base)
            yield batch

    based.repartition(max(1, shards.count()), "shard").mapInArrow(rebase, based.schema).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, tokens) of every document in a folder of token files.

    tokens are the ids (end id included) as little-endian unsigned 32-bit integers.
    """
    path = qualified(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, dtype, base in zip(*(batch.column(c).to_pylist() for c in ("name", "dtype", "base")), strict=True):
                tokens, offsets = read_array(f"{path}/{name}.tokens", dtype), read_array(f"{path}/{name}.offsets", "<i8")
                ids = read_array(f"{path}/{name}.ids", "<i8")
                lengths = np.diff(offsets)
                for part in runs_of((lengths + 50).tolist(), TOKENS_AT_ONCE):
                    at = offsets[part.start:part.stop + 1] - base
                    raw = [tokens[i:j].astype("<u4").tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
                    own = np.array(ids[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(offsets[part], pa.int64()),
                         pa.array(lengths[part], pa.int64()), pa.array(raw, pa.binary())],
                        ["doc_id", "start", "n_tokens", "tokens"])

    manifest = spark.read.parquet(f"{path}/manifest")
    return (manifest.select("name", "dtype", "base").repartition(max(1, manifest.count()), "name")  # a task per shard or so
            .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, tokens binary"))

