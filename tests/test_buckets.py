"""Bucketed published tables: matched in place by an upload, and kept bucketed by every writer."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from sparecast.operators import publish as pb
from sparecast.sources import sinks

BUCKETS = sinks.Buckets(4, pb.BUCKET_KEYS)


def _rows(spark, rows):
    """Published rows ``(month, dealer, country, part, qty, type)``; a month of None has no order date."""
    made = [(dt.date(2025, m, 1) if m else None, d, c, p, q, "desc", "2W", "A_F", dt.date(2025, 4, 3), t) for m, d, c, p, q, t in rows]
    return spark.createDataFrame(made, pb.PUBLISHED_SCHEMA)


def _target(spark):
    """A hot key with a third of the rows, the same key in other months, and NULLs in every key."""
    rows = [(5, 1, "IN", "HOT", i, "Forecast") for i in range(40)] + [(m, 1, "IN", "HOT", m, "Forecast") for m in (6, 7, 8)]
    rows += [(5 + i % 3, i % 7, "IN" if i % 2 else "LK", f"P{i % 11}", i, "Forecast") for i in range(70)]
    rows += [(None, 1, "IN", "HOT", 90, "Forecast"), (5, None, "IN", "HOT", 91, "Forecast"), (5, 1, None, "HOT", 92, "Forecast"),
             (5, 1, "IN", None, 93, "Forecast"), (5, 1, "IN", "HOT", 94, None)]
    return _rows(spark, rows)


def _upload(spark):
    return _rows(spark, [(5, 1, "IN", "HOT", 500, "Forecast"), (5, 1, "IN", "HOT", 501, "Forecast"), (7, 1, "IN", "HOT", 502, "Forecast"),
                         (6, 1, "LK", "P1", 503, "Forecast"), (5, 0, "LK", "P0", 504, "Forecast"), (5, 1, None, "HOT", 505, "Forecast"),
                         (7, 9, "IN", "NEW", 506, "Forecast")])


def _bag(df):
    return sorted(map(repr, df.select(*pb.PUBLISHED_COLUMNS).collect()))


def _bucketed(spark, name, rows):
    for t in (name, f"{name}__backup", f"{name}__new", f"{name}__stage"):
        sinks.drop_table(spark, t)
    pb.create_publish_table(spark, name, buckets=BUCKETS.count)
    sinks.append_by_name(rows, name)
    return name


def _as_file(rows):
    return rows.selectExpr("date_format(order_date, 'yy/MM/dd') order_date", "CAST(dealer_id AS STRING) dealer_id", "country", "part_id",
                           "CAST(order_qty AS STRING) order_qty", "type", "Material_Description", "industry", "ABC_FMS",
                           "date_format(run_date, 'yy/MM/dd') run_date")


@pytest.mark.parametrize("keys", [pb.PUBLISH_KEYS, pb.BUCKET_KEYS])
def test_in_place_match_equals_the_plain_one(spark, keys):
    target, upload = _target(spark), _upload(spark)
    plain = _bag(pb.rows_not_in(target, upload, keys))
    assert _bag(pb.rows_not_in_bucketed(target, upload, keys, BUCKETS)) == plain
    assert _bag(pb.rows_not_in_bucketed(target, upload.limit(0), keys, BUCKETS)) == _bag(target)
    assert _bag(pb.rows_not_in_bucketed(target.limit(0), upload, keys, BUCKETS)) == []


@pytest.mark.parametrize("swap", [False, True])
def test_upload_to_a_bucketed_table(spark, swap):
    name = _bucketed(spark, "bucket_upload", _target(spark))
    expected = _bag(pb.replace_by_key(_target(spark), _upload(spark)))
    report = pb.replace_by_key_table(_as_file(_upload(spark)), name, swap=swap)
    assert _bag(spark.table(name)) == expected
    assert report.after == report.before + report.inserted - report.replaced
    assert sinks.buckets_of(spark, name) == BUCKETS


def test_writers_keep_the_buckets(spark):
    name = _bucketed(spark, "bucket_writers", _target(spark))
    layout = _upload(spark).where("order_date IS NOT NULL").selectExpr(
        "order_date", "CAST(dealer_id AS DOUBLE) dealer_id", "country", "part_id", "CAST(order_qty AS DOUBLE) order_qty", "type",
        "Material_Description", "industry", "ABC_FMS", "'2025-04-03' run_date")
    before = spark.table(name).count()
    assert pb.publish(layout, name, "bucket_backup").after == before + 7
    assert sinks.buckets_of(spark, "bucket_backup") == BUCKETS
    pb.publish(layout, name, mode="replace_run")
    assert sinks.buckets_of(spark, name) == BUCKETS
    assert _bag(spark.table(name)) == _bag(pb.to_published(layout))
    assert sinks.sort_columns(spark, name) == pb.PUBLISHED_SORT
    plain = "bucket_none"
    sinks.write_table(_target(spark), plain)
    assert sinks.buckets_of(spark, plain) is None


def test_every_file_holds_one_bucket(spark):
    name = _bucketed(spark, "bucket_files", _target(spark))
    number = f"pmod(hash({', '.join(BUCKETS.columns)}), {BUCKETS.count})"
    files = spark.table(name).selectExpr("_metadata.file_name AS f", f"{number} AS b").distinct().collect()
    assert files and all(int(re.search(r"_(\d{5})\.", r.f).group(1)) == r.b for r in files)
    assert len(files) == len({r.f for r in files})


def _before_the_target_is_joined(plan):
    """The operators between the anti join and the target's scan (its left child comes first)."""
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line and "LeftAnti" in line)
    scan = next(i for i in range(join, len(lines)) if "FileScan" in lines[i])
    return lines[join:scan + 1]


def test_the_target_is_not_shuffled(spark):
    name = _bucketed(spark, "bucket_plan", _target(spark))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        current, upload = spark.table(name), _upload(spark)
        in_place = pb.rows_not_in_bucketed(pb._rows_of_months(current, upload), upload, pb.PUBLISH_KEYS, BUCKETS)
        plain = pb.rows_not_in(pb._rows_of_months(current, upload), upload)
        branch = _before_the_target_is_joined(in_place._jdf.queryExecution().executedPlan().toString())
        assert "SortMergeJoin" in branch[0]
        assert not any("Exchange" in line for line in branch), branch
        assert "Bucketed: true" in branch[-1]
        assert any("Exchange" in line for line in _before_the_target_is_joined(plain._jdf.queryExecution().executedPlan().toString()))
        assert _bag(in_place) == _bag(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_many_dates_are_met_by_a_join(spark, monkeypatch):
    name = _bucketed(spark, "bucket_dates", _target(spark))
    named = _bag(pb._rows_of_months(spark.table(name), _upload(spark)))
    monkeypatch.setattr(pb, "MAX_NAMED_DATES", 1)
    assert _bag(pb._rows_of_months(spark.table(name), _upload(spark))) == named
