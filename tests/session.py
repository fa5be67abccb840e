"""The local session of the tests and the benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from sparecast.session import RECOMMENDED_CONF, checkpoint_dir


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sparecast",
                  extra: dict | None = None) -> SparkSession:
    """A local session; without a checkpoint folder it gets a private one."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(spark) is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sparecast-ckpt-"))
    return spark
