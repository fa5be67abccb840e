"""Table operations: publish with backup and counts, replace by key, swap, CSV inputs."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sparecast.operators import publish as pb
from sparecast.sources import csv as csv_src
from sparecast.sources import sinks
from sparecast.sources import testdata as td

from .conftest import SF_SMALL


def _layout(spark, n=3, run="2025-04-03", industry="2W"):
    rows = [(dt.date(2025, 5 + (i % 2), 1), float(100 + i), "IN", f"P{i}", float(i + 1), "Forecast",
             "desc", industry, "A_F", run) for i in range(n)]
    schema = ("order_date date, dealer_id double, country string, part_id string, order_qty double, "
              "type string, Material_Description string, industry string, ABC_FMS string, run_date string")
    return spark.createDataFrame(rows, schema)


def test_publish_append_count_law_and_backup(spark):
    target, backup = "pub_append_t", "pub_append_b"
    sinks.drop_table(spark, target)
    r1 = pb.publish(_layout(spark, 3), target, backup)
    assert (r1.before, r1.inserted, r1.after, r1.backup_rows) == (0, 3, 3, 0)
    r2 = pb.publish(_layout(spark, 4), target, backup)
    assert r2.after == r2.before + r2.inserted == 7
    assert r2.backup_rows == 3 and spark.table(backup).count() == 3
    row = spark.table(target).where("part_id = 'P0'").first()
    assert row.dealer_id == 100 and row.run_date == dt.date(2025, 4, 3) and row.order_qty == 1


def _same(got, expected):
    got, expected = got.select(*pb.PUBLISHED_COLUMNS), expected.select(*pb.PUBLISHED_COLUMNS)
    return got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


# How a published table may have come to be laid out.
LAYOUTS = {"by date": "order_date", "none": None, "by segment": "industry", "by two": ["industry", "order_date"]}


def _fresh(spark, name, rows, partition_by):
    for t in (name, f"{name}__backup", f"{name}__new"):
        sinks.drop_table(spark, t)
    sinks.write_table(rows, name, partition_by=partition_by)
    return name


def _typed(spark, rows):
    return spark.createDataFrame([(*r[:8], r[8], r[9]) for r in rows], pb.PUBLISHED_SCHEMA)


def _row(month, part="P", run=3, industry="2W", qty=1, dealer=1, country="IN"):
    date = dt.date(2025, month, 1) if month else None
    return (date, dealer, country, part, qty, "desc", industry, "A_F", dt.date(2025, 4, run), "Forecast")


@pytest.mark.parametrize("layout", LAYOUTS)
def test_replace_run_is_idempotent(spark, layout):
    target = _fresh(spark, "pub_rerun_t", spark.createDataFrame([], pb.PUBLISHED_SCHEMA), LAYOUTS[layout])
    pb.publish(_layout(spark, 4, industry="3W"), target)
    r1 = pb.publish(_layout(spark, 4), target, mode="replace_run")
    r2 = pb.publish(_layout(spark, 4), target, mode="replace_run")
    t = spark.table(target)
    assert t.count() == 8
    assert t.where("industry = '2W'").count() == 4
    assert (r1.before, r1.inserted, r1.after, r1.replaced) == (4, 4, 8, 0)
    assert (r2.before, r2.inserted, r2.after, r2.replaced) == (8, 4, 8, 4)
    assert sinks.partition_columns(spark, target) == ([LAYOUTS[layout]] if isinstance(LAYOUTS[layout], str) else LAYOUTS[layout] or [])


@pytest.mark.parametrize("layout", LAYOUTS)
def test_shrinking_rerun_leaves_no_stale_rows(spark, layout):
    """Months and segments that the new run no longer has go; other runs, and rows without a date, stay."""
    others = [_row(5, "other run", run=4), _row(7, "other run", run=4), _row(None, "no date", run=4), _row(6, "third", industry="XX")]
    before = [*others, _row(5, "old"), _row(6, "old"), _row(6, "old", industry="3W"), _row(None, "old")]
    target = _fresh(spark, "pub_shrink_t", _typed(spark, before), LAYOUTS[layout])
    new = _layout(spark, 1)   # one row of 2W in May
    report = pb.publish(new, target, mode="replace_run", segments=("2W", "3W"))
    expected = _typed(spark, others).unionByName(pb.to_published(pb.conform_staging(new)))
    assert _same(spark.table(target), expected)
    assert (report.before, report.inserted, report.replaced, report.after) == (8, 1, 4, 5)
    report = pb.publish(new.limit(0), target, mode="replace_run", segments=("2W",), run_date="2025-04-03")
    assert _same(spark.table(target), _typed(spark, others)) and report.replaced == 1


@pytest.mark.parametrize("layout", LAYOUTS)
def test_replace_by_key_table_matches_frame(spark, layout):
    published = td.published(spark, SF_SMALL)
    target = _fresh(spark, "pub_replace_t", published, LAYOUTS[layout])
    upload = td.upload(spark, SF_SMALL)
    expected = pb.replace_by_key(published, pb.typed_upload(upload, td.UPLOAD_DATE_PATTERN))
    report = pb.replace_by_key_table(upload, target, date_pattern=td.UPLOAD_DATE_PATTERN)
    assert _same(spark.table(target), expected)
    assert report.after == expected.count() == report.before + report.inserted - report.replaced
    assert sinks.partition_columns(spark, target) == ([LAYOUTS[layout]] if isinstance(LAYOUTS[layout], str) else LAYOUTS[layout] or [])


def _upload(spark, rows):
    columns = "order_date string, dealer_id string, country string, part_id string, order_qty string, type string, " \
              "`Material Description` string, industry string, ABC_FMS string, run_date string"
    return spark.createDataFrame(rows, columns)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_upload_touches_only_its_keys_and_reports_rejects(spark, layout):
    target_rows = [_row(m, f"P{m}") for m in (5, 6, 7)] + [_row(None, "P5"), _row(5, "P5", country=None)]
    target = _fresh(spark, "pub_upload_t", _typed(spark, target_rows), LAYOUTS[layout])
    up = _upload(spark, [
        ("25/05/01", "1", "IN", "P5", "1,200", "Forecast", "desc", "2W", None, "25/04/05"),
        ("25/05/01", " 1 ", "IN", "P5", "7", "Forecast", "desc", "2W", "B_M", "25/04/05"),
        ("nonsense", "1", "IN", "P6", "9", "Forecast", "desc", "2W", None, "25/04/05"),
        (None, "1", "IN", "P6", "9", "Forecast", "desc", "2W", None, "25/04/05"),
        ("25/06/01", "D17", "IN", "P6", "9", "Forecast", "desc", "2W", None, "25/04/05"),
        ("25/06/01", "1", "IN", "P6", "many", "Forecast", "desc", "2W", None, "25/04/05"),
        ("25/09/01", None, "IN", "P9", "9", "Forecast", "desc", "2W", None, "25/04/05"),
    ])
    report = pb.replace_by_key_table(up, target)
    uploaded = [(dt.date(2025, 5, 1), 1, "IN", "P5", 1200, "desc", "2W", "A_F", dt.date(2025, 4, 5), "Forecast"),
                (dt.date(2025, 5, 1), 1, "IN", "P5", 7, "desc", "2W", "B_M", dt.date(2025, 4, 5), "Forecast"),
                (dt.date(2025, 9, 1), None, "IN", "P9", 9, "desc", "2W", "A_F", dt.date(2025, 4, 5), "Forecast")]
    assert _same(spark.table(target), _typed(spark, target_rows[1:] + uploaded))
    assert (report.before, report.inserted, report.replaced, report.rejected, report.after) == (5, 3, 1, 4, 7)
    reasons = sorted(r[0] for r in pb.checked_upload(up).where("_reject is not null").select("_reject").collect())
    assert reasons == ["dealer_id", "order_date", "order_date", "order_qty"]


def test_text_dealers_are_counted_not_fatal(spark):
    target = _fresh(spark, "pub_text_t", spark.createDataFrame([], pb.PUBLISHED_SCHEMA), "order_date")
    rows = _layout(spark, 3).withColumn("dealer_id", F.when(F.col("part_id") == "P1", "D17").otherwise(F.col("dealer_id").cast("string")))
    assert [r.dealer_id for r in pb.conform_staging(rows).orderBy("part_id").collect()] == [100.0, None, 102.0]
    for mode in ("append", "replace_run"):
        report = pb.publish(rows, target, mode=mode)
        assert (report.inserted, report.rejected) == (2, 1)
    assert spark.table(target).count() == 2
    assert [r.part_id for r in pb.rejects(rows).collect()] == ["P1"]


def test_dynamic_overwrite_only_on_tables_partitioned_by_date(spark):
    for layout, columns in LAYOUTS.items():
        target = _fresh(spark, "pub_dynamic_t", _typed(spark, [_row(5), _row(6)]), columns)
        staged = _typed(spark, [_row(5, "new")])
        if layout == "by date":
            sinks.replace_partitions(staged, target, "order_date")
            assert spark.table(target).count() == 2
        else:
            with pytest.raises(ValueError, match="partitioned by"):
                sinks.replace_partitions(staged, target, "order_date")
            assert spark.table(target).count() == 2


def test_swap_table_keeps_backup(spark):
    target = "swap_t"
    for t in (target, f"{target}__backup"):
        sinks.drop_table(spark, t)
    sinks.write_table(spark.range(5), target)
    sinks.swap_table(spark, spark.table(target).where("id < 2"), target)
    assert spark.table(target).count() == 2
    assert spark.table(f"{target}__backup").count() == 5
    sinks.swap_table(spark, spark.table(target).where("id < 1"), target)
    assert (spark.table(target).count(), spark.table(f"{target}__backup").count()) == (1, 2)
    assert not any(sinks.table_exists(spark, t) for t in (f"{target}__replaced", f"{target}__backup__replaced", f"{target}__new"))


def test_backup_survives_a_failed_write_and_keeps_the_partitioning(spark, monkeypatch):
    source, backup = _fresh(spark, "snap_t", _typed(spark, [_row(5), _row(6)]), "order_date"), "snap_b"
    sinks.drop_table(spark, backup)
    assert sinks.snapshot(spark, source, backup) == 2
    assert sinks.partition_columns(spark, backup) == ["order_date"]

    def fail(*_a, **_k):
        raise RuntimeError("disk full")

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_table", fail)
        with pytest.raises(RuntimeError):
            sinks.snapshot(spark, source, backup)
        with pytest.raises(RuntimeError):
            sinks.swap_table(spark, spark.table(source), source, "order_date")
    assert spark.table(backup).count() == 2 and spark.table(source).count() == 2
    real = sinks.rename_table

    def fail_on_new(s, name, new):
        if name.endswith("__new"):
            raise RuntimeError("lost the metastore")
        real(s, name, new)

    with monkeypatch.context() as m:
        m.setattr(sinks, "rename_table", fail_on_new)
        with pytest.raises(RuntimeError):
            sinks.snapshot(spark, source, backup)
    assert spark.table(f"{backup}__replaced").count() == 2   # the old copy, under its other name
    assert spark.table(f"{backup}__new").count() == 2


def _file(name, text, encoding="ISO-8859-1"):
    path = os.path.join(tempfile.mkdtemp(prefix="sparecast-csv-"), name)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_csv_columns_are_found_by_header(spark):
    path = _file("master.csv", "Part_Description,extra, 3W_Part_Id ,2W_Part_Id,Alternate_Part_Id\n"
                               "Ölfilter BATTERY,1,,A1,X\ngear,2,,A2,\nNA,3,B1,,\n")
    m = csv_src.read_parts_master(spark, path).collect()
    assert [(r["2W_Part_Id"], r["3W_Part_Id"]) for r in m] == [("A1", None), ("A2", None), (None, "B1")]
    assert m[0]["Part_Description"].startswith("Ölfilter") and m[2]["Part_Description"] == "NA"
    with pytest.raises(ValueError, match="no column Alternate_Part_Id, Part_Description"):
        csv_src.read_parts_master(spark, _file("bad.csv", "2W_Part_Id,3W_Part_Id,Description\nA1,,x\n"))


def test_plan_numbers_and_rejects(spark):
    good = 'Plan,Month,Type\n"1,234.5",Nov-24,2W\n 100 ,Dec-24,3W\n'
    rows = csv_src.read_plan(spark, _file("plan.csv", good, "utf-8-sig")).collect()
    assert [(r.Month, r.Type, r.Plan) for r in rows] == [("Nov-24", "2W", 1234.5), ("Dec-24", "3W", 100.0)]
    bad = _file("plan2.csv", good + "abc,Jan-25,2W\n5,January,2W\n5,Feb-25,\n,Mar-25,2W\n")
    with pytest.raises(ValueError, match="4 plan rows"):
        csv_src.read_plan(spark, bad)
    assert csv_src.read_plan(spark, bad, allow_rejects=True).count() == 2
    reasons = {r.Month: r.reject for r in csv_src.check_plan(spark, bad).rejects.collect()}
    assert reasons == {"Jan-25": "Plan", "January": "Month", "Feb-25": "Type", "Mar-25": "Plan"}


def test_csv_fields_are_those_of_pandas(spark):
    """Doubled quotes, commas and line breaks in fields, short lines; a line with more fields is a reject."""
    import pandas as pd

    lines = ['2W_Part_Id,3W_Part_Id,Alternate_Part_Id,Part_Description', 'A1,,X,"BOLT 1/2"" HEX, ZINC"', 'A2,,,"LINE\nBREAK, ""two"""',
             'A3,B3', '"A4",,"","back\\slash"', 'A5,,,"ends in \\"', 'A6,,Y, spaced ', '"A""7",,,x']
    path = _file("quotes.csv", "\n".join(lines) + "\n")
    want = pd.read_csv(path, dtype=str, encoding="ISO-8859-1", keep_default_na=False, na_values=[""])
    want = [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]
    assert [tuple(r) for r in csv_src.read_parts_master(spark, path).collect()] == want
    long = _file("long.csv", "\n".join([*lines, "A8,,,x,surplus", "A9,,,x,"]) + "\n")
    with pytest.raises(ValueError, match="1 master rows"):
        csv_src.read_parts_master(spark, long)
    read = csv_src.check_parts_master(spark, long)
    assert [tuple(r) for r in read.rows.collect()] == [*want, ("A9", None, None, "x")]
    assert [(r["2W_Part_Id"], r.reject) for r in read.rejects.collect()] == [("A8", "line")]
    up = _file("up.csv", "run_date,dealer_id,country,part_id,order_qty,type,Material Description,industry,order_date\n"
                         '25/04/03,12,IN,P1,1,Forecast,"a ""b"", c",2W,25/05/01\n25/04/03,12,IN,P2,1,Forecast,a,b,2W,25/05/01\n')
    rows = pb.checked_upload(csv_src.read_upload(spark, up)).orderBy("part_id").collect()
    assert [(r.part_id, r.Material_Description) for r in rows][0] == ("P1", 'a "b", c')
    assert rows[0]._reject is None and rows[1]._reject.split(",")[0] == "line"


def test_upload_file_round_trip(spark):
    path = _file("upload.csv", "run_date,dealer_id,country,part_id,order_qty,type,Material Description,industry,order_date,note\n"
                               '25/04/03,12,NA,P1,"1,003",Forecast,desc,2W,25/05/01,x\n')
    upload = csv_src.read_upload(spark, path)   # without the optional class column
    u = pb.to_published(pb.conform_upload(upload), "yy/MM/dd").first()
    assert u.country == "NA" and u.ABC_FMS == "A_F" and u.order_date == dt.date(2025, 5, 1) and u.order_qty == 1003


def test_upload_reads_only_the_touched_partitions(spark):
    target = _fresh(spark, "pub_prune_t", td.published(spark, SF_SMALL), "order_date")
    up = pb.typed_upload(td.upload(spark, SF_SMALL).where("order_date like '2000/0%'"), td.UPLOAD_DATE_PATTERN)
    affected = pb._rows_of_months(spark.table(target), up)
    assert {r.order_date for r in affected.select("order_date").distinct().collect()} == {
        r.order_date for r in up.select("order_date").distinct().collect()}
    plan = affected._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and target in line)
    filters = scan.split("PartitionFilters: [", 1)[1]
    assert ">= 2000-01-01" in filters and "<= 2000-09-01" in filters


def test_partitioned_writes_are_clustered(spark):
    """A month that every task holds rows of is written by few tasks, not by all of them."""
    rows = spark.range(0, 4000, 1, 16).selectExpr("id", "date_add(date'2025-01-01', cast(id % 12 as int) * 31) as order_date")
    sinks.drop_table(spark, "clustered_t")
    sinks.write_table(rows, "clustered_t", partition_by="order_date")
    files = spark.table("clustered_t").select(F.input_file_name()).distinct().count()
    assert files <= 24


def test_source_columns_are_mapped_by_name(spark):
    from sparecast.sources.tables import BILLING_COLUMNS, read_billing

    own = td.billing(spark, SF_SMALL).withColumnRenamed("BilledValue", "net value")
    assert read_billing(spark, own, {"BilledValue": "net value"}).columns == list(BILLING_COLUMNS)
    with pytest.raises(ValueError, match="not canonical"):
        read_billing(spark, own, {"Value": "net value"})


def _files(spark, name):
    import pyarrow.parquet as pq

    paths = sorted({r.f for r in spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()})
    return [pq.ParquetFile(p.removeprefix("file://")) for p in paths]


def _rows_read(spark, name, condition):
    """Rows that the executed scan takes out of the files (those of skipped row groups and pages aren't among them)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = spark.table(name).where(condition)._jdf.queryExecution().executedPlan()
        plan.executeCollect()
        return plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("partition_by", ["order_date", None])
def test_published_files_are_sorted_and_scans_skip(spark, partition_by):
    """Every writer keeps the order of the files; a scan of one segment or part reads a small share of the rows."""
    target = f"pub_sorted_{'date' if partition_by else 'plain'}"
    for t in (target, f"{target}__backup", f"{target}_b"):
        sinks.drop_table(spark, t)
    rows = spark.range(20_000).select(
        F.lit(dt.date(2025, 5, 1)).alias("order_date"), (F.col("id") % 7).cast("double").alias("dealer_id"), F.lit("IN").alias("country"),
        F.format_string("P%05d", F.pmod(F.xxhash64("id"), F.lit(5000))).alias("part_id"), F.lit(1.0).alias("order_qty"),
        F.lit("Forecast").alias("type"), F.lit("d").alias("Material_Description"),
        F.when(F.col("id") % 2 == 0, "2W").otherwise("3W").alias("industry"), F.lit("A_F").alias("ABC_FMS"), F.lit("2025-04-03").alias("run_date"))
    upload = rows.where("part_id < 'P00100'").withColumn("order_qty", F.lit(5.0)).withColumn("order_date", F.lit("2025/05/01"))
    spark.conf.set("parquet.block.size", "16384")
    try:
        if partition_by is None:
            sinks.create_empty_table(spark, target, pb.PUBLISHED_SCHEMA, None, pb.PUBLISHED_SORT)
        for write in (lambda: pb.publish(rows, target, f"{target}_b"),
                      lambda: pb.publish(rows, target, mode="replace_run", segments=("2W", "3W"), run_date=dt.date(2025, 4, 3)),
                      lambda: pb.replace_by_key_table(upload, target, "yyyy/MM/dd")):
            write()
            held = spark.table(target).count()
            assert held == 20_000 and sinks.sort_columns(spark, target) == ["industry", "part_id"]
            groups = 0
            for f in _files(spark, target):
                keys = [(r["industry"], r["part_id"]) for r in f.read(["industry", "part_id"]).to_pylist()]
                assert keys == sorted(keys)
                groups += f.num_row_groups
            assert groups > 8
            assert _rows_read(spark, target, "industry = '2W'") < 0.75 * held
            assert _rows_read(spark, target, "industry = '2W' and part_id = 'P01234'") < 0.2 * held
        assert sinks.sort_columns(spark, f"{target}_b") == ["industry", "part_id"]
    finally:
        spark.conf.unset("parquet.block.size")
    sinks.set_sort(spark, target, "part_id")
    assert sinks.sort_columns(spark, target) == ["part_id"]
