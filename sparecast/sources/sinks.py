"""Table writers: overwrite, append with backup, swap, dynamic partition replace, and their recovery.

Tables are Parquet tables in the session catalog (no transactional table format
is assumed).  Every change of an existing table is staged in a table beside it
first.  Once the staged copy is complete it is given an intent, a table property
that says what is to be done with it, and from then on the change is bound to
happen: :func:`recover`, which every writer calls first, finishes it.  A staged
copy without an intent was never complete and goes.

* A swap writes ``<name>__new`` and then renames: the table to
  ``<name>__replaced``, the new one to the table's name, the replaced one to the
  backup (or it is dropped).  The property moves with the new table and goes last.
* A partition replace writes ``<name>__stage`` and overwrites the partitions it
  holds; doing it again gives the same table.
* An append writes ``<name>__append`` (see ``operators.publish``), with the row
  count of the partitions it will touch.

At every step each complete table exists under some name.  A table that is
missing while a copy of it exists is never created anew, and a copy that
nothing accounts for is never dropped: both raise :class:`LostTable`.

Partitioned writes are first rebalanced on the partition columns: each
partition is written by as few tasks as its size allows, and a large one by
several.  A table may name columns that its files are sorted by (``sort_by``, kept as a
table property): every later writer keeps to them.  A table may also be bucketed
(:class:`Buckets`, kept by the catalog): a join on the bucket columns then reads it without a shuffle.
"""

from __future__ import annotations

import json
import re
import threading
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS`` (a missing table is not an error)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rename_table(spark: SparkSession, name: str, new: str) -> None:
    """Rename a table.  The in-memory catalog (sessions without a metastore) moves
    the files of a managed table but leaves its partitions where they were; they
    are pointed to the new folder here, one metadata call per partition."""
    spark.sql(f"ALTER TABLE {name} RENAME TO {new}")
    if spark.conf.get("spark.sql.catalogImplementation") != "in-memory" or not partition_columns(spark, new):
        return
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {new}").where("col_name = 'Location'").first()["data_type"]
    for row in spark.sql(f"SHOW PARTITIONS {new}").toLocalIterator():
        pairs = (part.split("=", 1) for part in row[0].split("/"))
        spec = ", ".join(f"`{unquote(c)}` = {_partition_value(unquote(v))}" for c, v in pairs)
        spark.sql(f"ALTER TABLE {new} PARTITION ({spec}) SET LOCATION '{place}/{row[0]}'")
    spark.catalog.refreshTable(new)


def _partition_value(text: str) -> str:
    return "NULL" if text == "__HIVE_DEFAULT_PARTITION__" else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """The partition columns of a table, in order (empty: not partitioned)."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _names(columns: str | list[str] | None) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns or [])


def clustered(df: DataFrame, columns: str | list[str] | None) -> DataFrame:
    """``df`` rebalanced on the partition columns it is about to be written by."""
    names = _names(columns)
    return df.hint("rebalance", *[F.col(f"`{c}`") for c in names]) if names else df


SORT = "sparecast.sort_by"


def sort_columns(spark: SparkSession, name: str) -> list[str]:
    """The columns that the table's files are sorted by (empty: none)."""
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == SORT).first()
    return json.loads(found["value"]) if found else []


def set_sort(spark: SparkSession, name: str, sort_by: str | list[str]) -> None:
    """Have later writes sort by these columns; what the table holds stays as it is."""
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{SORT}' = '{json.dumps(_names(sort_by))}')")


@dataclass(frozen=True)
class Buckets:
    """The bucket columns of a table, in the order they are hashed, and their number of buckets."""

    count: int
    columns: tuple[str, ...]


#: Rows that one bucket of a table may hold over all its partitions: a join in place reads a bucket in one task.
ROWS_PER_BUCKET = 2_000_000


def bucket_count(rows: int, least: int = 4) -> int:
    """How many buckets a table of so many rows needs."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


def buckets_of(spark: SparkSession, name: str) -> Buckets | None:
    """The buckets of a table (None: it has none)."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name").isin("Num Buckets", "Bucket Columns"))
    told = {row["col_name"]: row["data_type"] for row in found.toLocalIterator()}
    if "Num Buckets" not in told:
        return None
    return Buckets(int(told["Num Buckets"]), tuple(re.findall(r"`([^`]+)`", told["Bucket Columns"])))


_BUCKET = "__bucket_of_row"


def _bucketed(df: DataFrame, partition_by: str | list[str] | None, buckets: Buckets) -> DataFrame:
    """``df`` rebalanced on partition and bucket, so that a bucket of a partition is written by as few tasks as its size allows."""
    number = F.pmod(F.hash(*[F.col(f"`{c}`") for c in buckets.columns]), F.lit(buckets.count))
    return clustered(df.withColumn(_BUCKET, number), _names(partition_by) + [_BUCKET]).drop(_BUCKET)


def arranged(df: DataFrame, partition_by: str | list[str] | None, sort_by: str | list[str] | None,
             buckets: Buckets | None = None) -> DataFrame:
    """``df`` as it is written: rebalanced on the partition columns, then sorted inside each task.

    Sorted files have row groups and pages with narrow ranges of the sort columns, so a
    filter on them skips the rest.  No shuffle is added.  Rows of a bucketed table are rebalanced on their
    bucket too; the writer itself sorts them, by the sort columns that the bucketing names.
    """
    if buckets:
        return _bucketed(df, partition_by, buckets)
    rows = clustered(df, partition_by)
    return rows.sortWithinPartitions(*[F.col(f"`{c}`") for c in _names(partition_by) + _names(sort_by)]) if sort_by else rows


def write_table(df: DataFrame, name: str, partition_by: str | list[str] | None = None,
                mode: str = "overwrite", sort_by: str | list[str] | None = None, buckets: Buckets | None = None) -> None:
    """Overwrite (or append to) a Parquet table, optionally partitioned, bucketed, and sorted inside its files."""
    writer = arranged(df, partition_by, sort_by, buckets).write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*_names(partition_by))
    if buckets:
        writer = writer.bucketBy(buckets.count, *buckets.columns)
        writer = writer.sortBy(*_names(sort_by)) if sort_by else writer
    writer.saveAsTable(name)
    if sort_by:
        set_sort(df.sparkSession, name, sort_by)


def create_empty_table(spark: SparkSession, name: str, schema: T.StructType,
                       partition_by: str | list[str] | None = None, sort_by: str | list[str] | None = None,
                       buckets: Buckets | None = None) -> None:
    """Create a table with a declared schema and no rows (if it does not exist)."""
    if table_exists(spark, name):
        return
    write_table(spark.createDataFrame([], schema), name, partition_by, mode="overwrite", sort_by=sort_by, buckets=buckets)


# ---------------------------------------------------------------------------
# Intents and recovery
# ---------------------------------------------------------------------------

INTENT = "sparecast.intent"
NEW, REPLACED, BACKUP, STAGE, RUN, APPEND = "__new", "__replaced", "__backup", "__stage", "__run", "__append"


class LostTable(RuntimeError):
    """A table and its copies are in a state that no writer leaves; a person has to say which one holds."""


def set_intent(spark: SparkSession, name: str, **intent) -> None:
    """Mark a staged table as complete, with what is to be done with it."""
    text = json.dumps(intent, default=str).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{INTENT}' = '{text}')")


def intent_of(spark: SparkSession, name: str) -> dict | None:
    """The intent of a table (None: there is no such table, or it has none)."""
    if not table_exists(spark, name):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == INTENT).first()
    return json.loads(found["value"]) if found else None


def clear_intent(spark: SparkSession, name: str) -> None:
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{INTENT}')")


def _finish_swap(spark: SparkSession, target: str) -> None:
    """Bring a swap to its end from wherever it stands."""
    staged, aside = target + NEW, target + REPLACED
    intent = intent_of(spark, staged)
    if intent is None:
        intent = intent_of(spark, target)
    else:
        if table_exists(spark, target):
            if table_exists(spark, aside):
                raise LostTable(f"{target}, {staged} and {aside} all exist: compare {target} with {aside} and drop one of them")
            rename_table(spark, target, aside)
        rename_table(spark, staged, target)
    if table_exists(spark, aside):
        if old := intent["old"]:
            drop_table(spark, old)
            rename_table(spark, aside, old)
        else:
            drop_table(spark, aside)
    clear_intent(spark, target)


def _finish_partitions(spark: SparkSession, target: str, intent: dict) -> None:
    replace_partitions(spark.table(target + STAGE), target, intent["by"])
    drop_table(spark, target + STAGE)
    drop_table(spark, target + RUN)


def recover(spark: SparkSession, target: str, backup: str | None = None) -> list[str]:
    """Finish or take back what an interrupted writer left of ``target``; returns what was done.

    After it, ``target`` holds the rows of before the interrupted change or
    of after it, and no staged copy is left but that of an append (which
    ``operators.publish`` finishes).  Raises :class:`LostTable` where the table is
    missing and only a backup (``<target>__backup``, ``backup``) could replace it.
    """
    staged, aside = target + NEW, target + REPLACED
    done = []
    if intent_of(spark, staged) or intent_of(spark, target):
        _finish_swap(spark, target)
        done.append("finished a swap")
    if table_exists(spark, aside):
        if table_exists(spark, target):
            raise LostTable(f"{aside} is beside {target} and no swap is under way: compare them and drop one")
        rename_table(spark, aside, target)
        done.append("took the replaced table back")
    if not table_exists(spark, target):
        for copy in {target + BACKUP, backup} - {None}:
            if table_exists(spark, copy):
                raise LostTable(f"{target} is missing but {copy} exists: rename or copy it to {target}, or drop it")
    if table_exists(spark, staged):
        drop_table(spark, staged)
        done.append("dropped an incomplete copy")
    if intent := intent_of(spark, target + STAGE):
        _finish_partitions(spark, target, intent)
        done.append("finished a partition replace")
    for stage in (STAGE, RUN):
        drop_table(spark, target + stage)
    return done


def swap_table(spark: SparkSession, df: DataFrame, target: str,
               partition_by: str | list[str] | None = None, keep_backup: bool = True) -> None:
    """Replace ``target`` by ``df`` (which may read ``target``), keeping the old one as ``<target>__backup`` if wanted.

    A writer whose ``df`` reads ``target`` calls :func:`recover` before it builds ``df``.
    """
    recover(spark, target)
    _swap(spark, df, target, partition_by, target + BACKUP if keep_backup else None, target)


def _swap(spark: SparkSession, df: DataFrame, target: str, partition_by: str | list[str] | None, old: str | None, like: str) -> None:
    """Swap ``df`` in, sorted and bucketed as the table ``like`` is (if there is one)."""
    drop_table(spark, target + NEW)
    known = table_exists(spark, like)
    write_table(df, target + NEW, partition_by, sort_by=sort_columns(spark, like) if known else None,
                buckets=buckets_of(spark, like) if known else None)
    set_intent(spark, target + NEW, do="swap", old=old)
    _finish_swap(spark, target)


def snapshot(spark: SparkSession, source: str, backup: str) -> int:
    """Copy ``source`` to ``backup`` with the same partitioning; returns the copied row count.

    The copy is swapped in: a failed write leaves the previous backup as it was.
    """
    recover(spark, backup)
    _swap(spark, spark.table(source), backup, partition_columns(spark, source), None, source)
    return spark.table(backup).count()


def finish_stage(spark: SparkSession, target: str, partition_by: str) -> None:
    """Overwrite the partitions of ``target`` that the complete staged copy ``<target>__stage`` holds."""
    intent = {"do": "partitions", "by": partition_by}
    set_intent(spark, target + STAGE, **intent)
    _finish_partitions(spark, target, intent)


def rebuild_table(spark: SparkSession, df: DataFrame, target: str) -> None:
    """Swap in ``df``, which reads the recovered ``target``, with the target's own partitioning; keeps ``<target>__backup``."""
    _swap(spark, df, target, partition_columns(spark, target), target + BACKUP, target)


# ---------------------------------------------------------------------------
# Backup of what a change touches
# ---------------------------------------------------------------------------

MANIFEST = "sparecast.manifest"


def partition_values(spark: SparkSession, name: str) -> list[str]:
    """The values of a table's one partition column, as text, from the catalog (no data is read)."""
    return sorted(unquote(row[0].split("=", 1)[1]) for row in spark.sql(f"SHOW PARTITIONS {name}").toLocalIterator())


def _only(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(F.col(column).isin([F.lit(v).cast(df.schema[column].dataType) for v in values]) if values else F.lit(False))


def backup_partitions(spark: SparkSession, source: str, backup: str, partition_by: str, values: list[str]) -> int:
    """Copy the named partitions of ``source`` to ``backup``, with a manifest of what they were; returns the copied rows.

    The manifest (a property of ``backup``) names every partition that is about to
    change; one that ``source`` doesn't have yet is named too, and goes at a restore.
    """
    recover(spark, backup)
    staged = backup + NEW
    drop_table(spark, staged)
    write_table(_only(spark.table(source), partition_by, values), staged, partition_by)
    text = json.dumps({"source": source, "by": partition_by, "values": values})
    spark.sql(f"ALTER TABLE {staged} SET TBLPROPERTIES ('{MANIFEST}' = '{text}')")
    set_intent(spark, staged, do="swap", old=None)
    _finish_swap(spark, backup)
    return spark.table(backup).count()


def manifest_of(spark: SparkSession, backup: str) -> dict | None:
    """``source, by, values`` of a backup of partitions (None for a whole copy)."""
    found = spark.sql(f"SHOW TBLPROPERTIES {backup}").where(F.col("key") == MANIFEST).first()
    return json.loads(found["value"]) if found else None


def restore(spark: SparkSession, backup: str) -> None:
    """Give a table the rows it had when ``backup`` was taken by :func:`backup_partitions`.

    The partitions of the manifest are overwritten from the backup, those that
    did not exist then are dropped; other partitions are not read.  Doing it again
    changes nothing, so an interrupted restore is simply run again.
    """
    manifest = manifest_of(spark, backup)
    if manifest is None:
        raise ValueError(f"{backup} has no manifest: it is no backup of partitions")
    target, by = manifest["source"], manifest["by"]
    held = partition_values(spark, backup)
    if held:
        replace_partitions(spark.table(backup), target, by)
    for value in sorted(set(manifest["values"]) - set(held)):
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (`{by}` = {_partition_value(value)})")
    spark.catalog.refreshTable(target)


@dataclass(frozen=True)
class WriteReport:
    """Row counts around a write: ``after == before + inserted - replaced`` holds.

    ``rejected`` rows could not be published (no date, or a dealer or quantity
    that is no number) and were left out.
    """

    target: str
    before: int
    inserted: int
    after: int
    backup_rows: int | None = None
    replaced: int = 0
    rejected: int = 0


def observed(seen: Observation) -> dict:
    """The values of an observation; none where Spark knew the input to be empty and planned it away."""
    try:
        return dict(seen.get)
    except Py4JJavaError as e:
        if "assertion failed" not in str(e.java_exception):
            raise
        return {}


#: ``insertInto`` takes the overwrite mode from the session only; writers of one driver take turns with it.
_OVERWRITE_MODE = threading.RLock()


def append_by_name(df: DataFrame, target: str) -> int:
    """Append ``df`` to ``target`` matching columns by name; returns the rows written.

    The count comes from an observation on the written rows, so no second pass
    over ``df`` is needed.
    """
    spark = df.sparkSession
    columns = spark.table(target).columns
    obs = Observation("append")
    rows = df.select(*[F.col(f"`{c}`") for c in columns]).observe(obs, F.count(F.lit(1)).alias("rows"))
    arranged(rows, partition_columns(spark, target), sort_columns(spark, target), buckets_of(spark, target)).write.insertInto(target)
    return int(observed(obs).get("rows", 0))


def replace_partitions(df: DataFrame, target: str, partition_by: str) -> None:
    """Overwrite only the partitions of ``target`` that ``df`` has rows for.

    ``target`` must be partitioned by exactly ``partition_by``: on any other
    table a dynamic overwrite would also remove rows that ``df`` never read.
    ``df`` must not read ``target`` itself (stage it first).
    """
    spark = df.sparkSession
    found = partition_columns(spark, target)
    if found != [partition_by]:
        raise ValueError(f"{target} is partitioned by {found}, not by [{partition_by!r}]")
    columns = spark.table(target).columns
    rows = arranged(df.select(*[F.col(f"`{c}`") for c in columns]), partition_by, sort_columns(spark, target), buckets_of(spark, target))
    with _OVERWRITE_MODE:
        previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            rows.write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)
