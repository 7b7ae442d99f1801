"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.session import pin

# A side of a join is broadcast only if it was counted and has at most this many narrow rows;
# beyond that the same join is shuffled.
BROADCAST_ROWS = 200_000
# Texts are handled in slices of about this many bytes inside a task.
SLICE_BYTES = 2 << 20
# Rows of one Arrow batch between Spark and Python.
BATCH_ROWS = 512


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def bucket_of(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the decimal text of an id modulo ``modulus``; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def hex16(value: Column) -> Column:
    """A long as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def bounded(df: DataFrame) -> DataFrame:
    """``df``, after the session was told to send Python no more than ``BATCH_ROWS`` rows at once,
    so that what waits in a worker stays small whatever the default is."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(setting)) <= BATCH_ROWS:
        df.sparkSession.conf.set(setting, str(BATCH_ROWS))
    return df


KEY = "__llm_key"


def keep_marked(docs: DataFrame, key: Column, found: DataFrame, longest: bool = False) -> DataFrame:
    """The rows of ``docs`` that ``found`` keeps (all columns).

    found: one row per row of docs with doc_id, KEY (the value of ``key``) and ``kept``. Only what
    goes is joined with the documents. Of rows that share id and key one stays if one is kept, with
    ``longest`` one of the longest texts.
    """
    by_key = found.groupBy("doc_id", KEY).agg(F.count("*").alias("rows"), F.max("kept").alias("any"))
    gone = pin(by_key.filter("not any or rows > 1").toDF("__llm_id", "__llm_gone", "rows", "any"))
    count = gone.count()
    if count == 0:
        return docs
    same = F.col("doc_id").eqNullSafe(F.col("__llm_id")) & F.col(KEY).eqNullSafe(F.col("__llm_gone"))
    marked = docs.withColumn(KEY, key)
    rest = marked.join(sized(gone, count), same, "left_anti").drop(KEY)
    several = gone.filter("any")
    if several.isEmpty():
        return rest
    twins = marked.join(sized(several, count), same, "left_semi")
    size = F.coalesce(F.length("text"), F.lit(0)) if longest else F.lit(0)
    names = docs.columns
    one = twins.groupBy("doc_id", KEY).agg(F.max_by(F.struct(*names), size).alias("__llm_row"))
    return rest.unionByName(one.select(*[F.col("__llm_row")[c].alias(c) for c in names]))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes (one row at least)."""
    rows, start = batch.num_rows, 0
    if rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    ends = lengths.cumsum()
    while start < rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(ends.searchsorted(done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_slices(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str = "text"
) -> DataFrame:
    """``mapInArrow`` with a function of one bounded slice of rows."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, column):
                yield function(part)

    return bounded(df).mapInArrow(run, schema)
