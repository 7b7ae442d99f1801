"""Loading files as they arrive, with the batch operators unchanged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from cadastra.operators.loads import append_new
from cadastra.operators.stored import BUCKETS, bucket_of
from cadastra.sources.readers import _filesystem


def append_arrivals(
    arrivals: DataFrame, table: str, keys: Sequence[str], checkpoint: str, buckets: int = BUCKETS
) -> DataStreamWriter:
    """Append the new rows of each micro-batch of a file stream to a Parquet table.

    Every batch writes its own folder, named by batch id and overwritten if the batch runs again,
    so a restart neither loses nor doubles rows. Rows lie in hash buckets of their key; of earlier batches
    only the keys in the buckets that a batch meets are read. ``buckets`` holds for the life of a table.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        place = bucket_of(keys, buckets)
        # The batch is read for its buckets, for heavy keys and for the load itself.
        batch.persist()
        met = [r[0] for r in batch.select(place).distinct().collect()]
        fs, root = _filesystem(spark, table)
        known = T.StructType([*batch.select(*keys).schema.fields, *(T.StructField(n, T.IntegerType()) for n in ("batch", "_bucket"))])
        if fs.exists(root):
            stored = spark.read.schema(known).parquet(table)
        else:  # the table starts with the first batch
            stored = spark.createDataFrame([], known)
        existing = stored.filter((F.col("batch") != number) & F.col("_bucket").isin(met))
        new = append_new(existing.select(*keys), batch, keys, F.current_timestamp())
        dealt = new.withColumn("_bucket", place).hint("rebalance", "_bucket")
        dealt.write.mode("overwrite").partitionBy("_bucket").parquet(f"{table}/batch={number}")
        batch.unpersist()

    return arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
