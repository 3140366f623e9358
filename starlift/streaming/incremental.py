"""Incremental, idempotent loading of newly arriving raw files.

The source project loads static files; its load is idempotent ("insert if
absent" on a natural key). This module runs that same load continuously:
``readStream`` picks up new CSV files with the contract's schema, and each
micro-batch (``foreachBatch``)

1. keeps the first row per natural key inside the batch,
2. drops keys already present in the target table (left-anti join),
3. writes the survivors to ``<target>/batch_id=<N>`` with overwrite.

Step 3 makes a replayed micro-batch (after a failure, Spark re-runs the same
batch id from the checkpoint) rewrite exactly its own folder, so the output
is exactly-once. The checkpoint location must be on shared storage.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starlift import functions as SF
from starlift.operators.warehouse import read_if_written
from starlift.sources.contracts import Contract


def _existing_keys(spark: SparkSession, target: str, natural_key: Sequence[str], batch_id: int) -> DataFrame | None:
    """Keys loaded by earlier batches; this batch's own folder is excluded so a replay rewrites it."""
    loaded = read_if_written(spark, target)
    return None if loaded is None else loaded.where(F.col("batch_id") != batch_id).select(*natural_key)


def incremental_load(spark: SparkSession, source_dir: str, contract: Contract, natural_key: Sequence[str],
                     target: str, checkpoint_location: str, available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    string_schema = ", ".join(f"`{c}` string" for c in contract.columns)
    raw = (spark.readStream.schema(string_schema).option("header", True).option("quote", '"')
           .option("escape", '"').option("multiLine", True).csv(source_dir))
    typed = raw.select(*[(SF.null_tokens_to_null(F.col(f"`{f.name}`")).try_cast(f.dataType)
                          if f.dataType.typeName() != "string" else SF.null_tokens_to_null(F.col(f"`{f.name}`")))
                         .alias(f.name) for f in contract.schema.fields])
    typed = typed.withColumn("_file", F.input_file_name())

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        order = F.struct(F.col("_file"), F.monotonically_increasing_id())
        first = (batch.withColumn("__o", order).groupBy(*natural_key)
                 .agg(F.min(F.struct("__o", *[c for c in contract.columns if c not in natural_key])).alias("__m")))
        rows = first.select(*natural_key, *[F.col(f"__m.{c}").alias(c) for c in contract.columns
                                            if c not in natural_key])
        have = _existing_keys(batch.sparkSession, target, natural_key, batch_id)
        if have is not None:
            rows = rows.join(have, list(natural_key), "left_anti")
        rows.select(*contract.columns).write.mode("overwrite").parquet(os.path.join(target, f"batch_id={batch_id}"))

    w = typed.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
