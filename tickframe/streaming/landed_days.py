"""Daily bar load as a Structured Streaming job over landed payload files.

The daily mode of the batch job (fetch one day, clean it, replace the day)
becomes a file stream: each micro-batch holds the objects landed since the
last one, grouped by their ``market_date=`` folder.  ``foreachBatch`` merges
them with the bars already stored for the same dates, keeps the
highest-volume object per (date, ticker) and replaces exactly those dates.
An object that is delivered again with a lower volume thus loses against the
stored one; to replace a day as landed, use the batch load of one date.
A replayed batch rewrites the same dates with the same rows, so a restart
from the checkpoint is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import BARS, PAYLOAD
from ..sources import ingest, sink


def _merge_batch(spark: SparkSession, bars_path: str):
    def run(batch: DataFrame, epoch_id: int) -> None:
        objects = batch.select("market_date", *PAYLOAD.fieldNames()).persist()  # read twice
        stored = sink.stored_table(spark, bars_path, BARS)
        if stored is not None:
            days = objects.select("market_date").distinct()
            stored = stored.join(days, "market_date", "left_semi").select("market_date", *PAYLOAD.fieldNames())
        merged = objects if stored is None else objects.unionByName(stored)
        sink.replace_days(ingest.clean_payload(merged), bars_path, BARS)
        objects.unpersist()
    return run


def start(spark: SparkSession, landing_path: str, bars_path: str, checkpoint_path: str,
          fmt: str = "json", available_now: bool = True,
          processing_time: str | None = None) -> StreamingQuery:
    """Start the loader; ``available_now`` drains what has landed and stops."""
    schema = T.StructType(PAYLOAD.fields + [T.StructField("market_date", T.DateType())])
    stream = spark.readStream.schema(schema).format(fmt).load(landing_path)
    writer = (stream.writeStream.foreachBatch(_merge_batch(spark, bars_path))
              .option("checkpointLocation", checkpoint_path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def land(payload: DataFrame, landing_path: str, fmt: str = "json") -> None:
    """Write payload objects as the feed would land them: one folder per date, its files compressed by gzip.

    The objects repeat the names of their fields, so files without it are several times as large.
    """
    payload.write.mode("append").option("compression", "gzip").partitionBy("market_date").format(fmt).save(landing_path)
