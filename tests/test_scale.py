"""What the table jobs move and hold: bytes written, shuffles, rows in a task."""

from __future__ import annotations

import pathlib

from sparecast.operators import months
from sparecast.operators import publish as pb
from sparecast.plans import queries
from sparecast.session import checkpoint_dir
from sparecast.sources import sinks

from .test_buckets import _as_file, _bag, _target, _upload


def _table(spark, name, partition_by="order_date"):
    for suffix in ("", "__backup", "__new", "__stage"):
        sinks.drop_table(spark, name + suffix)
    sinks.write_table(_target(spark), name, partition_by=partition_by)
    return name


def _folders(spark):
    return set(pathlib.Path(checkpoint_dir(spark).removeprefix("file:")).iterdir())


def test_an_upload_is_kept_as_columns_and_removed(spark, monkeypatch):
    name, before, seen = _table(spark, "scale_upload"), _folders(spark), []
    finish = sinks.finish_stage

    def watched(spark, target, by):
        seen.append((sinks.partition_columns(spark, target + sinks.STAGE), [p.name for p in _folders(spark) - before]))
        finish(spark, target, by)

    monkeypatch.setattr(sinks, "finish_stage", watched)
    expected = _bag(pb.replace_by_key(_target(spark), _upload(spark)))
    before = _folders(spark)  # the rows of the line above stay
    pb.replace_by_key_table(_as_file(_upload(spark)), name)
    (stage, made), = seen
    assert stage == []  # dealt by date once, by the replace
    assert len(made) == 1 and made[0].startswith("sparecast-rows-")
    assert _folders(spark) == before
    assert _bag(spark.table(name)) == expected


def test_the_match_sorts_by_telling_keys_first(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = pb.rows_not_in(_target(spark), _upload(spark))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        join = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
        assert join.split("SortMergeJoin [", 1)[1].startswith("part_id#")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_buckets_follow_the_rows(spark, monkeypatch):
    assert [sinks.bucket_count(n) for n in (0, 8_000_000, 8_000_001, 216_000_000)] == [4, 4, 5, 108]
    made = []
    create = pb.create_publish_table
    monkeypatch.setattr(sinks, "ROWS_PER_BUCKET", 1000)
    monkeypatch.setattr(pb, "create_publish_table", lambda *a, **k: made.append(k.get("buckets")) or create(*a, **k))
    rows = queries.q_replace_by_key_bucketed(spark, "/root/testdata/sf0.001")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert rows.count() and made[0] == -(-lines // 1000) > 4


def test_an_outgrown_bucketed_table_is_matched_by_a_shuffle(spark, monkeypatch):
    name, used = "scale_outgrown", []
    for suffix in ("", "__backup", "__new", "__stage"):
        sinks.drop_table(spark, name + suffix)
    pb.create_publish_table(spark, name, buckets=4)
    sinks.append_by_name(_target(spark), name)
    expected = _bag(pb.replace_by_key(_target(spark), _upload(spark)))
    plain = pb.rows_not_in
    monkeypatch.setattr(pb, "rows_not_in", lambda *a: used.append(a) or plain(*a))
    monkeypatch.setattr(sinks, "ROWS_PER_BUCKET", 5)
    pb.replace_by_key_table(_as_file(_upload(spark)), name)
    assert used and _bag(spark.table(name)) == expected
    assert sinks.buckets_of(spark, name).count == 4


def test_the_upload_file_is_written_compressed(spark, monkeypatch):
    seen = []
    upload = queries.jobs.upload

    def watched(spark, tables, path, pattern):
        seen.extend(p.name for p in pathlib.Path(path.removeprefix("file:")).glob("part-*"))
        return upload(spark, tables, path, pattern)

    monkeypatch.setattr(queries.jobs, "upload", watched)
    folder = "/root/testdata/sf0.001"
    assert _bag(queries.q_upload_file_table(spark, folder)) == _bag(queries.q_replace_by_key(spark, folder))
    assert seen and all(name.endswith(".csv.gz") for name in seen)


def test_months_are_dealt_once(spark, monkeypatch):
    name, stages = "scale_months", []
    for suffix in ("", "__stage", "__new"):
        sinks.drop_table(spark, name + suffix)
    finish = sinks.finish_stage
    monkeypatch.setattr(sinks, "finish_stage", lambda s, t, by: (stages.append(sinks.partition_columns(s, t + sinks.STAGE)), finish(s, t, by)))
    rows = spark.sql("SELECT '2W' industry, id Part_Id, add_months(DATE'2000-01-01', int(id % 3)) month FROM range(30)")
    months._replace_months(spark, rows, name, "month", set())
    months._replace_months(spark, rows.where("month(month) = 1 AND Part_Id > 9"), name, "month", {"2000-01-01", "2000-02-01"})
    assert stages == [[], []]
    assert sinks.partition_values(spark, name) == ["2000-01-01", "2000-03-01"]
    assert {r.Part_Id for r in spark.table(name).collect()} == {k for k in range(30) if k % 3 == 2 or k % 3 == 0 and k > 9}
