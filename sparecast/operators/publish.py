"""Publish layout, type conformance, append with backup, replace by key.

Three layouts exist for one record:

* dealer forecast (job output): ``order_date DATE, dealer_id, country,
  part_id, order_qty DOUBLE, type, Material_Description, industry, ABC_FMS,
  run_date STRING``
* staging (conformed text/double types, same order)
* published: ``order_date DATE, dealer_id BIGINT, country, part_id,
  order_qty BIGINT, Material_Description, industry, ABC_FMS, run_date DATE,
  type`` (``type`` last)

Writes match columns by name, never by position.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import FORECAST_TYPE, UPLOAD_DEFAULT_CLASS, class_code
from ..functions.periods import run_date as run_date_of
from ..session import materialize, materialize_files, remove_files
from ..sources import csv as csv_src
from ..sources import sinks
from .forecast import active_parts

LAYOUT_COLUMNS = ("order_date", "dealer_id", "country", "part_id", "order_qty", "type",
                  "Material_Description", "industry", "ABC_FMS", "run_date")

STAGING_SCHEMA = T.StructType([
    T.StructField("order_date", T.StringType()),
    T.StructField("dealer_id", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("part_id", T.StringType()),
    T.StructField("order_qty", T.DoubleType()),
    T.StructField("type", T.StringType()),
    T.StructField("Material_Description", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("ABC_FMS", T.StringType()),
    T.StructField("run_date", T.StringType()),
])

PUBLISHED_SCHEMA = T.StructType([
    T.StructField("order_date", T.DateType()),
    T.StructField("dealer_id", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("part_id", T.StringType()),
    T.StructField("order_qty", T.LongType()),
    T.StructField("Material_Description", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("ABC_FMS", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("type", T.StringType()),
])
PUBLISHED_COLUMNS = tuple(f.name for f in PUBLISHED_SCHEMA.fields)
#: The order inside the published files: readers ask for a segment or some parts of a month.
PUBLISHED_SORT = ["industry", "part_id"]
PUBLISH_KEYS = ("order_date", "dealer_id", "country", "part_id", "type")
#: Keys by how well they tell rows apart.  A join sorts by its first key's prefix and compares whole rows where
#: that is equal: behind a month, which thousands of rows share, it would compare nearly all of them.
SORT_FIRST = ("part_id", "dealer_id", "order_date", "country", "type")
#: The keys that a published table can be bucketed by (its partition column cannot be one of them).
BUCKET_KEYS = ("part_id", "dealer_id", "country", "type")
#: Order dates of an upload that are named one by one in the scan of the target; more are met by a semi join.
MAX_NAMED_DATES = 500


def format_publish(apportioned: DataFrame, master: DataFrame, as_of, segment: str | Sequence[str],
                   dedup_master: bool = False) -> DataFrame:
    """Dealer forecast in the publish layout.

    Class pair ``AF`` becomes ``A_F``; ``type`` is ``Forecast``; ``run_date`` is
    the 3rd of the month of ``as_of`` as ``YYYY-MM-DD``; the description comes
    from the master (inner join: parts missing from it are dropped, parts listed
    twice are published twice unless ``dedup_master``, which keeps the smallest
    description of a part).
    """
    if isinstance(segment, str):
        desc, keys = active_parts(master, segment, exclude_text=None, with_description=True), ["Part_Id"]
    else:   # several segments in one pass: each segment's id column, tagged with the segment
        keys = ["industry", "Part_Id"]
        desc = None
        for seg in segment:
            part = active_parts(master, seg, exclude_text=None, with_description=True).withColumn(
                "industry", F.lit(seg))
            desc = part if desc is None else desc.unionByName(part)
    if dedup_master:
        desc = desc.groupBy(*keys).agg(F.min("Part_Description").alias("Part_Description"))
    return (
        apportioned.join(desc, keys)
        .select(
            F.col("Forecast_month").alias("order_date"),
            F.col("DealerID").alias("dealer_id"),
            F.col("country"),
            F.col("Part_Id").alias("part_id"),
            F.col("Forecast_Qty").alias("order_qty"),
            F.lit(FORECAST_TYPE).alias("type"),
            F.col("Part_Description").alias("Material_Description"),
            F.col("industry"),
            class_code("ABC_FMS").alias("ABC_FMS"),
            F.lit(run_date_of(as_of).isoformat()).alias("run_date"),
        )
    )


def _number(df: DataFrame, column: str, kind: str) -> F.Column:
    """A number column, or the number in a text (``1,234.5`` too); NULL where there is none."""
    text = isinstance(df.schema[column].dataType, T.StringType)
    value = f"replace(trim(`{column}`), ',', '')" if text else f"`{column}`"
    return F.expr(f"try_cast({value} AS {kind})")


def conform_staging(df: DataFrame) -> DataFrame:
    """The ten layout columns in staging types (text dates, double numbers).

    A dealer or quantity that is no number becomes NULL; :func:`checked` tells
    such rows apart.
    """
    return df.select(*[
        (_number(df, f.name, "DOUBLE") if isinstance(f.dataType, T.DoubleType)
         else F.col(f"`{f.name}`").cast(f.dataType)).alias(f.name) for f in STAGING_SCHEMA.fields])


def _published_columns(date_pattern: str | None) -> list[F.Column]:
    def date_of(c: str):
        return F.try_to_date(F.col(c), date_pattern) if date_pattern else F.expr(f"try_cast({c} AS DATE)")

    def trunc_bigint(c: str):
        return F.expr(f"try_cast({c} AS BIGINT)")

    made = {"order_date": date_of("order_date"), "dealer_id": trunc_bigint("dealer_id"),
            "order_qty": trunc_bigint("order_qty"), "run_date": date_of("run_date")}
    return [made.get(c, F.col(c)).alias(c) for c in PUBLISHED_COLUMNS]


def to_published(staged: DataFrame, date_pattern: str | None = None) -> DataFrame:
    """Staging rows -> published types and column order.

    Dates are parsed as ISO text, or with ``date_pattern`` (e.g. ``yy/MM/dd``);
    an unparsable date becomes NULL instead of failing the job.  Doubles are
    truncated to BIGINT.
    """
    return staged.select(*_published_columns(date_pattern))


REJECT = "_reject"
#: Column in which a file reader says what is wrong with a line (NULL: nothing).
BAD_LINE = csv_src.BAD_LINE


def checked(rows: DataFrame, date_pattern: str | None = None) -> DataFrame:
    """Layout rows in published types with ``_reject``: NULL for rows that can be
    published, else what is wrong with them.

    A row is rejected when it has no order date or an unreadable one, when
    its dealer, quantity or run date is there but cannot be read, or when its
    reader marked the line as broken (``BAD_LINE``).  A missing dealer, quantity or run
    date stays NULL.
    """
    raw = rows.select(*[F.col(f"`{f.name}`") for f in STAGING_SCHEMA.fields],
                      (F.col(BAD_LINE) if BAD_LINE in rows.columns else F.lit(None)).cast("string").alias(BAD_LINE))
    given = [F.col(f"`{c}`").cast("string").alias(f"_given_{c}") for c in ("dealer_id", "order_qty", "run_date")]
    staged = raw.select(
        *[(_number(raw, f.name, "DOUBLE") if isinstance(f.dataType, T.DoubleType)
           else F.col(f"`{f.name}`").cast(f.dataType)).alias(f.name) for f in STAGING_SCHEMA.fields], BAD_LINE, *given)
    typed = staged.select(*_published_columns(date_pattern), BAD_LINE, *[f"_given_{c}" for c in ("dealer_id", "order_qty", "run_date")])
    reasons = [F.when(F.col(BAD_LINE).isNotNull(), F.lit("line")), F.when(F.col("order_date").isNull(), F.lit("order_date"))]
    reasons += [F.when(F.col(c).isNull() & (F.trim(f"_given_{c}") != ""), F.lit(c)) for c in ("dealer_id", "order_qty", "run_date")]
    return typed.withColumn(REJECT, F.nullif(F.concat_ws(",", *reasons), F.lit(""))).select(*PUBLISHED_COLUMNS, REJECT)


def rejects(rows: DataFrame, date_pattern: str | None = None) -> DataFrame:
    """The layout rows that cannot be published, with ``_reject``."""
    return checked(rows, date_pattern).where(F.col(REJECT).isNotNull())


def _upload_layout(upload: DataFrame, default_class: str) -> DataFrame:
    renamed = upload.withColumnRenamed("Material Description", "Material_Description")
    if "ABC_FMS" not in renamed.columns:
        return renamed.withColumn("ABC_FMS", F.lit(default_class))
    return renamed.withColumn("ABC_FMS", F.coalesce(F.col("ABC_FMS"), F.lit(default_class)))


def conform_upload(upload: DataFrame, default_class: str = UPLOAD_DEFAULT_CLASS) -> DataFrame:
    """An upload file in staging types: ``Material Description`` renamed and a
    missing class filled with ``default_class``."""
    return conform_staging(_upload_layout(upload, default_class))


def typed_upload(upload: DataFrame, date_pattern: str = "yy/MM/dd",
                 default_class: str = UPLOAD_DEFAULT_CLASS) -> DataFrame:
    """The rows of an upload file that can be published, in published types, written once to the checkpoint folder.

    Replacing by key reads the uploads twice (keys for the anti join, rows for
    the union); writing them once keeps both reads identical.
    """
    return checked_upload(upload, date_pattern, default_class).where(F.col(REJECT).isNull()).drop(REJECT)


def checked_upload(upload: DataFrame, date_pattern: str = "yy/MM/dd",
                   default_class: str = UPLOAD_DEFAULT_CLASS) -> DataFrame:
    """:func:`checked` rows of an upload file, written once to the checkpoint folder (and left there)."""
    return _stored_upload(upload, date_pattern, default_class)[0]


def _stored_upload(upload: DataFrame, date_pattern: str, default_class: str = UPLOAD_DEFAULT_CLASS) -> tuple[DataFrame, str | None]:
    """:func:`checked_upload` and the folder of its files."""
    return materialize_files(checked(_upload_layout(upload, default_class), date_pattern))


def rows_not_in(target: DataFrame, source: DataFrame, keys: Sequence[str] = PUBLISH_KEYS) -> DataFrame:
    """Target rows without a key match in ``source`` (NULL keys never match).

    Both sides are aliased, so the condition stays unambiguous when the source
    is derived from the target itself.
    """
    cond = [F.col(f"_t.{k}") == F.col(f"_s.{k}") for k in sorted(keys, key=(*SORT_FIRST, *keys).index)]
    return target.alias("_t").join(source.select(*keys).alias("_s"), cond, "left_anti").select(
        *[F.col(f"_t.`{c}`").alias(c) for c in target.columns])


def rows_not_in_bucketed(target: DataFrame, source: DataFrame, keys: Sequence[str], buckets: sinks.Buckets) -> DataFrame:
    """:func:`rows_not_in` by an equi join on the bucket columns of ``target`` alone, so ``target`` isn't shuffled.

    Spark joins a bucketed table in place where the equi keys are the bucket columns and the other side
    has as many partitions.  The other keys (the order date) travel as a set in the one source row per
    bucket key; such a set holds the distinct order dates of one dealer, part, country and type at most,
    since repeated source keys are combined before the shuffle.  NULL keys never match.  The bucket columns are a part of ``keys``.
    """
    rest = [k for k in keys if k not in buckets.columns]
    once = source.select(*keys).dropna().distinct().repartition(buckets.count, *buckets.columns)
    met = once.groupBy(*buckets.columns).agg(F.collect_set(F.struct(*rest) if rest else F.lit(True)).alias("_met"))
    cond = [F.col(f"_t.{k}") == F.col(f"_s.{k}") for k in buckets.columns]
    if rest:
        cond.append(F.array_contains(F.col("_s._met"), F.struct(*[F.col(f"_t.{k}").alias(k) for k in rest])))
    return target.alias("_t").join(met.alias("_s"), cond, "left_anti").select(*[F.col(f"_t.`{c}`").alias(c) for c in target.columns])


def replace_by_key(target: DataFrame, upload_rows: DataFrame,
                   keys: Sequence[str] = PUBLISH_KEYS, buckets: sinks.Buckets | None = None) -> DataFrame:
    """Target rows whose key is not uploaded, plus every uploaded row (no dedup).

    Both inputs in published types.  ``buckets`` are those of the table that the target is
    read from, if any; where their columns are keys, the target is joined in place.
    """
    uploads, rows = upload_rows.select(*PUBLISHED_COLUMNS), target.select(*PUBLISHED_COLUMNS)
    in_place = buckets is not None and set(buckets.columns) <= set(keys)
    kept = rows_not_in_bucketed(rows, uploads, keys, buckets) if in_place else rows_not_in(rows, uploads, keys)
    return kept.unionByName(uploads)


# ---------------------------------------------------------------------------
# Table operations
# ---------------------------------------------------------------------------


def create_publish_table(spark: SparkSession, name: str, backup: str | None = None, buckets: int | None = None) -> list[str]:
    """Recover the published table, or create it (partitioned by ``order_date``) if there never was one.

    ``buckets`` gives a new table that many buckets by :data:`BUCKET_KEYS`; uploads are then matched
    without a shuffle of the table (:func:`rows_not_in_bucketed`).  One task matches a bucket of all months, so
    their number follows the table's rows (``sinks.bucket_count``).  An existing table stays as it is.

    Returns what the recovery did; the publishing of an interrupted run ends as :func:`_finish_append`.
    """
    done = sinks.recover(spark, name, backup)
    done += _finish_append(spark, name)
    sinks.create_empty_table(spark, name, PUBLISHED_SCHEMA, partition_by="order_date", sort_by=PUBLISHED_SORT,
                             buckets=sinks.Buckets(buckets, BUCKET_KEYS) if buckets else None)
    return done


def ledger_name(target: str) -> str:
    return f"{target}__ledger"


def _run_rows(staged: DataFrame, publish_id: str) -> DataFrame:
    """The ledger's rows of a publish: per run date and segment the rows and their hash (of no order)."""
    content = F.sum(F.xxhash64(*PUBLISHED_COLUMNS).cast("decimal(38,0)")).cast("string")
    return staged.groupBy("run_date", F.col("industry").alias("segment")).agg(
        F.count(F.lit(1)).alias("rows"), content.alias("input_hash")).select(
        F.lit(publish_id).alias("publish_id"), "run_date", "segment", "rows", "input_hash")


def _write_ledger(spark: SparkSession, target: str, staged: DataFrame, publish_id: str) -> None:
    """Add a publish to the ledger, once."""
    rows, name = _run_rows(staged, publish_id), ledger_name(target)
    if sinks.table_exists(spark, name):
        if spark.table(name).where(F.col("publish_id") == publish_id).limit(1).count():
            return
        rows.coalesce(1).write.insertInto(name)
    else:
        sinks.write_table(rows.coalesce(1), name)


def _published_before(spark: SparkSession, target: str, staged: DataFrame, publish_id: str | None = None) -> DataFrame:
    """``run_date, industry`` of the staged runs that the ledger holds with the same rows (of one publish if given)."""
    known = spark.table(ledger_name(target))
    if publish_id is not None:
        known = known.where(F.col("publish_id") == publish_id)
    new = _run_rows(staged, "").alias("n")
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("run_date", "segment", "rows", "input_hash")]
    return new.join(known.alias("k"), same, "left_semi").select("run_date", F.col("segment").alias("industry"))


def _touched_rows(spark: SparkSession, target: str) -> int:
    """The rows of ``target`` in the partitions of its staged append (all rows where it isn't partitioned by date)."""
    rows = spark.table(target)
    if _partitioned_by_date(spark, target):
        dates = sinks.partition_values(spark, target + sinks.APPEND)
        rows = rows.where(F.col("order_date").isin([F.lit(d).cast("date") for d in dates]) if dates else F.lit(False))
    return rows.count()


def _finish_append(spark: SparkSession, target: str) -> list[str]:
    """Bring an interrupted append to its end; returns its publish id in a line that says so.

    The partitions it touches hold as many rows as before it (nothing was
    committed: append now), or all of the staged ones more (done), or they are
    restored from its backup first.
    """
    staged_name = target + sinks.APPEND
    intent = sinks.intent_of(spark, staged_name)
    if intent is None:
        sinks.drop_table(spark, staged_name)
        return []
    staged = spark.table(staged_name)
    if _partitioned_by_date(spark, target):
        spark.catalog.recoverPartitions(target)
    spark.catalog.refreshTable(target)
    held = _touched_rows(spark, target)
    if held != intent["before"] + intent["rows"]:
        if held != intent["before"]:
            if not intent["restore"]:
                raise sinks.LostTable(f"an append to {target} was cut in the middle and has no backup of its months: "
                                      f"{held} rows, {intent['before']} before it, {intent['rows']} to add ({staged_name})")
            sinks.restore(spark, intent["restore"])
        sinks.append_by_name(staged, target)
    _write_ledger(spark, target, staged, intent["publish_id"])
    sinks.drop_table(spark, staged_name)
    return [f"finished append {intent['publish_id']}"]


def publish(layout_rows: DataFrame, target: str, backup: str | None = None, mode: str = "append",
            segments: Sequence[str] | None = None, run_date=None, backup_scope: str = "all") -> sinks.WriteReport:
    """Conform, back up the target, write, and report the counts.

    ``mode="append"`` (default): appending the same run twice publishes it
    twice, as the original jobs do.  ``mode="append_once"``: a run date and
    segment that the ledger (``<target>__ledger``) holds with the same rows isn't published again.
    ``mode="replace_run"``: the rows of the same run (see :func:`replace_run`) go,
    whatever their month.  Rows that cannot be published are counted and left
    out (:func:`rejects` has them).

    The input is evaluated once, when it is staged.  An interrupted append is
    finished by the next writer; where that is a call with the same rows, it is taken
    as the repeated call and adds nothing more.

    ``backup_scope="touched"`` backs up the order dates that the new rows fall
    into, with a manifest for ``sinks.restore``, instead of the whole table
    (targets partitioned by ``order_date``; appends).
    """
    spark = layout_rows.sparkSession
    if mode not in ("append", "append_once", "replace_run"):
        raise ValueError(f"unknown publish mode {mode!r}")
    if backup_scope not in ("all", "touched"):
        raise ValueError(f"unknown backup scope {backup_scope!r}")
    done = create_publish_table(spark, target, backup)
    if mode == "replace_run":
        backup_rows = sinks.snapshot(spark, target, backup) if backup else None
        before = spark.table(target).count()
        inserted, rejected = replace_run(layout_rows, target, segments, run_date)
        after = spark.table(target).count()
        return sinks.WriteReport(target, before, inserted, after, backup_rows, before + inserted - after, rejected)
    staged, rows, rejected = _stage_publishable(layout_rows, target + sinks.APPEND)
    before = spark.table(target).count()
    finished = next((d.rsplit(" ", 1)[1] for d in done if d.startswith("finished append")), None)
    if (mode == "append_once" or finished) and sinks.table_exists(spark, ledger_name(target)):
        known = _published_before(spark, target, staged, None if mode == "append_once" else finished)
        fresh = staged.alias("s").join(known.alias("k"), [F.col(f"s.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("run_date", "industry")],
                                       "left_anti")
        n = fresh.count()
        if n != rows:
            _stage(fresh.select(*PUBLISHED_COLUMNS), target + sinks.RUN)
            sinks.drop_table(spark, target + sinks.APPEND)
            sinks.rename_table(spark, target + sinks.RUN, target + sinks.APPEND)
            staged, rows = spark.table(target + sinks.APPEND), n
    by_date = _partitioned_by_date(spark, target)
    backup_rows = None
    touched = backup is not None and backup_scope == "touched" and by_date
    if touched:
        dates = sinks.partition_values(spark, target + sinks.APPEND)
        backup_rows = sinks.backup_partitions(spark, target, backup, "order_date", dates)
    elif backup:
        backup_rows = sinks.snapshot(spark, target, backup)
    if rows:
        publish_id = uuid.uuid4().hex
        sinks.set_intent(spark, target + sinks.APPEND, do="append", publish_id=publish_id, rows=rows,
                         before=_touched_rows(spark, target), restore=backup if touched else None)
        sinks.append_by_name(staged, target)
        _write_ledger(spark, target, staged, publish_id)
    sinks.drop_table(spark, target + sinks.APPEND)
    after = spark.table(target).count()
    return sinks.WriteReport(target, before, rows, after, backup_rows, 0, rejected)


def _stage_publishable(layout_rows: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """The publishable rows in a table of their own, their number, and the number of rejected ones, in one pass."""
    seen = Observation("publishable")
    rows = checked(layout_rows).observe(seen, F.count(F.lit(1)).alias("rows"), F.count(REJECT).alias("rejected"))
    staged = _stage(rows.where(F.col(REJECT).isNull()).select(*PUBLISHED_COLUMNS), name)
    counts = sinks.observed(seen)
    good, rejected = staged.count(), counts.get("rejected", 0)
    if good + rejected != counts.get("rows", 0):
        raise RuntimeError(f"{name} holds {good} rows, but {counts} were seen")
    return staged, good, rejected


def _rows_of_months(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The target rows in the order dates of ``rows``.

    Up to :data:`MAX_NAMED_DATES` dates are named in the filter, so the scan lists
    their partitions only and no join is needed.  Of more, the first and last
    prune the partitions statically and a semi join leaves the dates that do occur.
    """
    span = rows.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"),
                    F.count_distinct("order_date").alias("dates")).first()
    if span is None or span["lo"] is None:
        return target.where(F.lit(False))
    near = target.where((F.col("order_date") >= F.lit(span["lo"])) & (F.col("order_date") <= F.lit(span["hi"])))
    if span["dates"] <= MAX_NAMED_DATES:
        named = rows.agg(F.sort_array(F.collect_set("order_date")).alias("dates")).first()["dates"]
        return near.where(F.col("order_date").isin([F.lit(d) for d in named]))
    return near.join(rows.select("order_date").distinct(), "order_date", "left_semi").select(*target.columns)


def _stage(df: DataFrame, name: str, partition_by: str | None = "order_date") -> DataFrame:
    """``df`` written to a table of its own.

    A copy that only feeds a partition replace needs no partitions (None): the replace deals
    its rows by partition, so dealing them here too would shuffle every row once more.
    """
    spark = df.sparkSession
    sinks.drop_table(spark, name)
    sinks.write_table(df, name, partition_by=partition_by)
    return spark.table(name)


def _partitioned_by_date(spark: SparkSession, target: str) -> bool:
    return sinks.partition_columns(spark, target) == ["order_date"]


def replace_run(layout_rows: DataFrame, target: str, segments: Sequence[str] | None = None, run_date=None) -> tuple[int, int]:
    """Publish a run idempotently: all target rows of the run go, the new rows come, everything else is kept.

    The run is every pair of a run date (those of the rows, and ``run_date``)
    and a segment (``segments``, or those of the rows), in all months: months
    and named segments that the new rows no longer have are removed too.  The
    months of the new and the old rows are rewritten by partition where the
    target is partitioned by ``order_date`` alone and no month becomes empty,
    else the table is rebuilt and swapped in.  Returns the rows written and rejected.
    """
    spark = layout_rows.sparkSession
    create_publish_table(spark, target)
    new, inserted, rejected = _stage_publishable(layout_rows, target + sinks.RUN)
    run = new.select("run_date", "industry").distinct()
    if segments is not None:
        names = F.explode(F.array(*[F.lit(s) for s in segments])).alias("industry")
        run = new.select("run_date").distinct().select("run_date", names)
        if run_date is not None:
            run = run.union(spark.range(1).select(F.lit(run_date).cast("date"), names)).distinct()
    elif run_date is not None:
        run = run.union(new.select(F.lit(run_date).cast("date"), "industry")).distinct()
    current = spark.table(target).select(*PUBLISHED_COLUMNS)

    def in_run(rows: DataFrame, how: str) -> DataFrame:
        """Rows of the run (a missing run date or segment is one of its own), or the others."""
        same = [F.col(f"_t.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in ("run_date", "industry")]
        return rows.alias("_t").join(run.alias("_r"), same, how).select(*[F.col(f"_t.{c}") for c in PUBLISHED_COLUMNS])

    old = in_run(current, "left_semi").select("order_date").distinct()
    new_dates = new.select("order_date").distinct()
    if _partitioned_by_date(spark, target):
        touched = materialize(old.union(new_dates).distinct())
        kept = in_run(_rows_of_months(current, touched), "left_anti")
        staged = _stage(kept.unionByName(new.select(*PUBLISHED_COLUMNS)), target + sinks.STAGE, None)
        emptied = touched.join(staged.select("order_date").distinct(), [touched.order_date.eqNullSafe(staged.order_date)], "left_anti")
        if not emptied.limit(1).count():
            sinks.finish_stage(spark, target, "order_date")
            return inserted, rejected
    rebuilt = in_run(current, "left_anti").unionByName(new.select(*PUBLISHED_COLUMNS))
    sinks.rebuild_table(spark, rebuilt, target)
    for stage in (sinks.RUN, sinks.STAGE):
        sinks.drop_table(spark, target + stage)
    return inserted, rejected


def replace_by_key_table(upload: DataFrame, target: str, date_pattern: str = "yy/MM/dd",
                         keys: Sequence[str] = PUBLISH_KEYS, swap: bool = False) -> sinks.WriteReport:
    """Apply a manual upload to the published table and report the counts.

    Where the target is partitioned by ``order_date`` alone, only the
    partitions the upload touches are read and rewritten (dynamic partition
    overwrite from a staged copy); a target bucketed by keys is matched without
    a shuffle of its rows, unless table or upload has outgrown its buckets (``sinks.ROWS_PER_BUCKET``, twice).  Any other target, or ``swap=True``, is
    rebuilt in whole, with its own partitioning, and swapped in, keeping
    ``<target>__backup``.  Uploads that cannot be published are left out and
    counted; target rows without a date match no key and stay.
    """
    spark = upload.sparkSession
    create_publish_table(spark, target)
    rows, files = _stored_upload(upload, date_pattern)
    try:
        counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count(REJECT).alias("rejected")).first()
        uploads = rows.where(F.col(REJECT).isNull()).drop(REJECT)
        current = spark.table(target)
        before = current.count()
        buckets = sinks.buckets_of(spark, target)
        if buckets and max(before, counts["rows"]) > 2 * buckets.count * sinks.ROWS_PER_BUCKET:
            buckets = None  # a bucket is too much for one task: shuffled into as many as the rows need
        if swap or not _partitioned_by_date(spark, target):
            sinks.rebuild_table(spark, replace_by_key(current, uploads, keys, buckets), target)
        else:
            _stage(replace_by_key(_rows_of_months(current, uploads), uploads, keys, buckets), target + sinks.STAGE, None)
            sinks.finish_stage(spark, target, "order_date")
    finally:
        remove_files(spark, files)
    inserted = counts["rows"] - counts["rejected"]
    after = spark.table(target).count()
    return sinks.WriteReport(target, before, inserted, after, None, before + inserted - after, counts["rejected"])
