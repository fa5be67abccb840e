"""Recommended session settings and lineage cuts.

Library code never creates its own session; it uses the one it is given.
"""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are tuned for.  On a cluster these belong in the job submission.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Plans name their filters in full, whatever the length of the column ids.
    "spark.sql.maxMetadataStringLength": "2000",
    # Call-site capture for error messages costs several JVM round trips per
    # DataFrame API call; a forecast plan is built from hundreds of calls.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Remove checkpoint files once nothing references them any more, so the
    # shared checkpoint folder does not grow run after run.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def _has_checkpoint_dir(spark: SparkSession) -> bool:
    if checkpoint_dir(spark) is not None:
        return True
    warnings.warn("spark.checkpoint.dir is not set: intermediate results are computed again wherever they are read",
                  RuntimeWarning, stacklevel=3)
    return False


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared checkpoint folder.

    Used for small intermediate results (one row per part, a manual upload)
    that later stages read several times; recomputing them would rescan the
    fact tables.  The checkpoint is reliable storage, so a lost executor does
    not force a recomputation.  Without a checkpoint folder the plan stays lazy
    (Spark then recomputes the input where it is referenced: correct, slower)
    and a warning says so.
    """
    return df.checkpoint(eager=True) if _has_checkpoint_dir(df.sparkSession) else df


def materialize_files(df: DataFrame) -> tuple[DataFrame, str | None]:
    """:func:`materialize` for large results: Parquet in the checkpoint folder, and that folder's path.

    A checkpoint keeps whole rows, uncompressed; columns take a fraction of it, and a reader of some
    of them reads only those.  Nothing removes the files by itself: whoever ends their use calls
    :func:`remove_files`.  Without a checkpoint folder the plan stays lazy and the path is None.
    """
    if not _has_checkpoint_dir(df.sparkSession):
        return df, None
    path = f"{str(checkpoint_dir(df.sparkSession)).rstrip('/')}/sparecast-rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_files(spark: SparkSession, path: str | None) -> None:
    """Delete what :func:`materialize_files` wrote (None: nothing)."""
    if path is not None:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize_observed(df: DataFrame, aggregates: list) -> tuple[DataFrame, dict]:
    """:func:`materialize` plus aggregates computed during the same job.

    Returns ``(frame, {alias: value})``.  The metrics only steer physical
    choices (bucket cut points), never results, so a retried task that feeds
    its rows into them twice does no harm.
    """
    from pyspark.sql import Observation

    if not _has_checkpoint_dir(df.sparkSession):
        row = df.agg(*aggregates).first()
        return df, (row.asDict() if row is not None else {})
    obs = Observation("materialize")
    out = df.observe(obs, *aggregates).checkpoint(eager=True)
    return out, dict(obs.get)
