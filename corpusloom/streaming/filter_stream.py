"""The filter job on files as they arrive: stateless rules, so that any trigger and restart give the batch job's rows."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.filters import clean


def filter_stream(spark: SparkSession, source: str, schema: T.StructType | str, out: str, checkpoint: str, file_type: str = "parquet", **rules) -> StreamingQuery:
    """Files under ``source`` to Parquet under ``out``, all that are there and then an end."""
    rows = spark.readStream.schema(schema).format(file_type).load(source)
    return clean(rows, **rules).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
