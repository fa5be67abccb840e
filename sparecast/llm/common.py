"""What several operators share: the folder for intermediate tables, batches of texts, running totals."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparecast.session import checkpoint_dir

#: Bytes of an Arrow batch, about.
BATCH_BYTES = "2m"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; only a local session without that setting gets a private one."""
    base = checkpoint_dir(spark)
    if base is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sparecast-work-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/sparecast-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read back: a lost executor costs no recomputation past this point."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a work folder that nothing reads any more (none there is fine)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def utf8_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session in bytes, not in rows alone: a batch is held several times over, by the JVM and by Python.

    A bound that the session sets itself, in rows or bytes, holds.  The setting stays, since rows are computed after a query has returned.
    """
    if not {"spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"} & set(spark.conf.getAll):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def per_batch(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply a function to each Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def offsets(df: DataFrame, part: str, value: str, out: str) -> DataFrame:
    """One row per part: the sum of ``value`` in all lower parts.

    ``part`` numbers a few thousand file or range partitions at most (one row
    each), so the single ordered window over them stays small at any input.
    """
    from pyspark.sql import Window

    totals = df.groupBy(part).agg(F.sum(value).alias("total"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum("total").over(before), F.lit(0)).alias(out))


def only_rows(docs: DataFrame, kept: DataFrame, id_col: str, key: Column) -> DataFrame:
    """One row of ``docs``, all columns as they were, for every ``id`` (null matches null) and text ``key`` in ``kept``."""
    from pyspark.sql import Window

    wanted = kept.select(F.col("id").alias("kept_id"), F.col("key").alias("kept_key")).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("row"), F.col(f"`{id_col}`").alias("row_id"), key.alias("row_key"))
    copies = Window.partitionBy("kept_id", "kept_key").orderBy(F.lit(0))
    met = rows.join(wanted, F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_key") == F.col("kept_key")))
    return met.withColumn("copy", F.row_number().over(copies)).filter("copy = 1").select("row.*")
