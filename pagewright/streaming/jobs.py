"""Streams that keep a table: Spark's state store has the state, each batch writes the rows that it changed.

A batch's changes are a folder named after it, so a batch that is run again after a failure writes the same folder
again; the table is the last change of each key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 4) -> DataFrame:
    """A Parquet file or folder as a stream of its files."""
    # as a pattern the path may be a file as well
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path[:-1]}[{path[-1]}]")


def run_to_table(aggregated: DataFrame, keys: list[str]) -> DataFrame:
    """Run a streaming aggregation by ``keys`` over what is there and give its table; batches without rows change nothing."""
    spark = aggregated.sparkSession
    base = shared_folder(spark)
    values = [c for c in aggregated.columns if c not in keys]

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/changes/batch={batch_id}")

    query = aggregated.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.lastProgress is None:
        return spark.createDataFrame([], aggregated.schema)
    changes = spark.read.schema(T.StructType([*aggregated.schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{base}/changes")
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch")).alias("__last")).select(*keys, "__last.*")


def latest_by_key(stream: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """The row of least ``rank`` of each key over all batches: a keyed upsert that late rows can't undo."""
    values = [c for c in stream.columns if c not in keys]
    best = stream.groupBy(*keys).agg(F.min_by(F.struct(*values), rank).alias("__best"))
    return run_to_table(best, keys).select(*keys, "__best.*")


def window_counts(stream: DataFrame, ts: str, kind: str, width: str) -> DataFrame:
    """Rows by window and kind over all batches; without a watermark no row comes too late, and the state is one row a window and kind."""
    counted = stream.groupBy(F.window(ts, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"))
    return run_to_table(counted, ["w", kind]).select(F.col("w.start").alias("start"), kind, "n")
