"""Reading event logs and writing result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_COLUMN = "_corrupt_record"


def read_events(spark: SparkSession, path: str, schema: StructType | None = None, keep_corrupt: bool = False) -> DataFrame:
    """Scan a JSON-lines log.

    With a schema there is one pass over the files; without one Spark first infers the
    types. ``keep_corrupt`` keeps unreadable lines in ``_corrupt_record``.
    """
    if schema is None:
        return spark.read.json(path)
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType())])
        return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(path)
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, compression: str | None = None, single_file: bool = False) -> None:
    """Overwrite a Parquet table.

    ``single_file`` is for small results: the result is computed in parallel and only its
    finished rows move to one writer.
    """
    out = df.repartition(1) if single_file else df
    writer = out.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write the long metrics table as JSON lines."""
    metrics.write.mode("overwrite").json(path)
