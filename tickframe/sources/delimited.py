"""Bulk load and export of delimited text: ``\\N`` for NULL, explicit types, bad lines kept aside.

Rows are parsed against a schema, nothing is inferred.  A line that doesn't fit
(wrong number of fields, a field of another type) or lacks a key goes to a table
of rejects with its text and reason; it neither stops the load nor gets lost.
Files hold a bounded number of rows, so loads split into tasks of bounded size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_MARK = "\\N"
ROWS_PER_FILE = 100_000  # fixed value: rows of a chunk of the bulk load
BAD_LINE = "_bad_line"


def write_csv(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """I-7: delimited export, without a header; an empty string is quoted and so differs from NULL."""
    (df.write.mode("overwrite").option("header", "false").option("nullValue", NULL_MARK)
     .option("maxRecordsPerFile", rows_per_file).csv(path))


def parse_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every line of the files: the columns of ``schema`` and, for a line that doesn't fit, its text in ``_bad_line``."""
    fields = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields] + [T.StructField(BAD_LINE, T.StringType())])
    # line by line, since a file scan would not parse the columns that a query doesn't ask for, and their faults would pass
    options = {"nullValue": NULL_MARK, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    row = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.fields), options)
    return spark.read.text(path).select(row.alias("row")).select("row.*")


def load_csv(spark: SparkSession, path: str, schema: T.StructType, key: list[str], rejects_path: str | None = None) -> DataFrame:
    """I-7: rows of the files that fit ``schema`` and have all of ``key``; the others are written to ``rejects_path``.

    Rejects are Parquet rows (line, reason); an export's text of a row without key is its JSON.
    """
    lines = parse_csv(spark, path, schema)
    no_key = F.lit(False)
    for c in key:
        no_key = no_key | F.col(c).isNull()
    bad = F.col(BAD_LINE).isNotNull()
    if rejects_path is not None:
        names = schema.fieldNames()
        (lines.where(bad | no_key)
         .select(F.coalesce(BAD_LINE, F.to_json(F.struct(*names))).alias("line"), F.when(bad, "malformed").otherwise("no key").alias("reason"))
         .write.mode("append").parquet(rejects_path))
    return lines.where(~bad & ~no_key).drop(BAD_LINE)
