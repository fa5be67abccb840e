"""Writers that end after any single step: recovered and run again, the tables are those of an uninterrupted run."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparecast.operators import publish as pb
from sparecast.sources import sinks

from .test_tables import _layout, _row, _same, _typed, _upload

STEPS = ("rename_table", "drop_table", "write_table", "set_intent", "clear_intent", "append_by_name", "replace_partitions")


class Stopped(Exception):
    pass


def _stop_after(monkeypatch, n):
    """The writers end after their ``n``-th step (never, if None); returns the names of the steps taken."""
    taken = []

    def stepping(name, real):
        def step(*a, **k):
            if n is not None and len(taken) >= n:
                raise Stopped
            out = real(*a, **k)
            taken.append(name)
            if n is not None and len(taken) >= n:
                raise Stopped
            return out

        return step

    for name in STEPS:
        monkeypatch.setattr(sinks, name, stepping(name, getattr(sinks, name)))
    return taken


SUFFIXES = ("", "__new", "__replaced", "__backup", "__backup__new", "__backup__replaced", "__stage", "__run", "__append", "__ledger")


def _fresh(spark, name, rows, partition_by):
    for t in SUFFIXES:
        sinks.drop_table(spark, name + t)
    sinks.write_table(rows, name, partition_by=partition_by)
    return name


def _left_over(spark, name):
    return [t for t in SUFFIXES[1:] if t not in ("__backup", "__ledger") and sinks.table_exists(spark, name + t)]


OLD = [_row(5, "a"), _row(6, "b"), _row(6, "c", run=4), _row(7, "d", run=4), _row(None, "e", run=4)]


def _upload_job(swap):
    def job(spark, target):
        up = _upload(spark, [("25/05/01", "1", "IN", "a", "9", "Forecast", "desc", "2W", None, "25/04/05"),
                             ("25/08/01", "1", "IN", "z", "9", "Forecast", "desc", "2W", None, "25/04/05")])
        pb.replace_by_key_table(up, target, swap=swap)
    return job


JOBS = {
    "upload by partition": (_upload_job(False), "order_date"),
    "upload by swap": (_upload_job(True), "order_date"),
    "rerun by rebuild": (lambda s, t: pb.publish(_layout(s, 1), t, mode="replace_run", segments=("2W",)), "order_date"),
    "append with backup of months": (lambda s, t: pb.publish(_layout(s, 3), t, t + "__backup", backup_scope="touched"), "order_date"),
    "append once": (lambda s, t: pb.publish(_layout(s, 3), t, mode="append_once"), None),
}


@pytest.mark.parametrize("job", JOBS)
def test_a_writer_that_ends_after_any_step(spark, monkeypatch, job):
    """Ended before its first intent and after each step from there on."""
    run, layout = JOBS[job]
    name = "rec_" + job.replace(" ", "_")
    _fresh(spark, name, _typed(spark, OLD), layout)
    with monkeypatch.context() as m:
        steps = _stop_after(m, None)
        run(spark, name)
    want = spark.createDataFrame(spark.table(name).select(*pb.PUBLISHED_COLUMNS).collect(), pb.PUBLISHED_SCHEMA)
    for n in range(steps.index("set_intent"), len(steps)):
        _fresh(spark, name, _typed(spark, OLD), layout)
        with monkeypatch.context() as m, pytest.raises(Stopped):
            _stop_after(m, n)
            run(spark, name)
        run(spark, name)
        assert _same(spark.table(name), want), f"{job}: ended after step {n}, {steps[n - 1]}"
        assert not _left_over(spark, name), f"{job}: ended after step {n}, {steps[n - 1]}"
        assert sinks.partition_columns(spark, name) == ([layout] if layout else [])


def test_an_append_cut_in_the_middle_of_its_files(spark, monkeypatch):
    """Some files of the append are there, others not: its months come back from the backup, then all is appended once."""
    target = _fresh(spark, "rec_cut", _typed(spark, OLD), "order_date")
    real = sinks.append_by_name

    def cut(df, name):
        real(df.limit(1), name)
        raise Stopped

    for backed in (True, False):
        _fresh(spark, target, _typed(spark, OLD), "order_date")
        job = lambda: pb.publish(_layout(spark, 3), target, target + "__backup" if backed else None, backup_scope="touched")  # noqa: E731,B023
        with monkeypatch.context() as m:
            m.setattr(sinks, "append_by_name", cut)
            with pytest.raises(Stopped):
                job()
        if not backed:
            with pytest.raises(sinks.LostTable, match="no backup of its months"):
                job()
            continue
        assert job().inserted == 0
        assert _same(spark.table(target), _typed(spark, OLD).unionByName(pb.to_published(pb.conform_staging(_layout(spark, 3)))))


def test_a_lost_target_is_never_recreated(spark):
    target = _fresh(spark, "rec_lost", _typed(spark, OLD), "order_date")
    sinks.rename_table(spark, target, target + "__backup")
    for job in (_upload_job(False), _upload_job(True), lambda s, t: pb.publish(_layout(s), t), lambda s, t: pb.create_publish_table(s, t)):
        with pytest.raises(sinks.LostTable, match="is missing but"):
            job(spark, target)
        assert not sinks.table_exists(spark, target) and spark.table(target + "__backup").count() == len(OLD)
    sinks.rename_table(spark, target + "__backup", target)
    sinks.write_table(_typed(spark, OLD[:1]), target + "__replaced")
    with pytest.raises(sinks.LostTable, match="compare them"):
        sinks.recover(spark, target)
    sinks.drop_table(spark, target + "__replaced")
    assert sinks.recover(spark, target) == []


def test_append_once_reads_the_ledger(spark):
    target = _fresh(spark, "rec_once", _typed(spark, OLD), "order_date")
    both = _layout(spark, 3).unionByName(_layout(spark, 2, industry="3W"))
    assert pb.publish(_layout(spark, 3), target, mode="append_once").inserted == 3
    r = pb.publish(both, target, mode="append_once")       # 2W is there already, 3W isn't
    assert (r.before, r.inserted, r.after) == (len(OLD) + 3, 2, len(OLD) + 5)
    assert pb.publish(both, target, mode="append_once").inserted == 0
    assert pb.publish(_layout(spark, 4), target, mode="append_once").inserted == 4   # other rows of the same run
    assert pb.publish(_layout(spark, 4), target).inserted == 4                       # on request, twice
    ledger = spark.table(pb.ledger_name(target))
    assert [(r.segment, r.rows) for r in ledger.orderBy("segment", "rows").collect()] == [("2W", 3), ("2W", 4), ("2W", 4), ("3W", 2)]


def test_backup_of_touched_months_and_restore(spark):
    target = _fresh(spark, "rec_months", _typed(spark, OLD), "order_date")
    new = _layout(spark, 3).withColumn("order_date", F.expr("case when part_id = 'P2' then date'2026-01-01' else order_date end"))
    r = pb.publish(new, target, target + "__backup", backup_scope="touched")
    assert (r.backup_rows, r.inserted, r.after) == (3, 3, len(OLD) + 3)
    assert sinks.manifest_of(spark, target + "__backup") == {
        "source": target, "by": "order_date", "values": ["2025-05-01", "2025-06-01", "2026-01-01"]}
    for _ in range(2):
        sinks.restore(spark, target + "__backup")
        assert _same(spark.table(target), _typed(spark, OLD))
        assert "2026-01-01" not in sinks.partition_values(spark, target)
    sinks.snapshot(spark, target, target + "__backup")
    with pytest.raises(ValueError, match="no manifest"):
        sinks.restore(spark, target + "__backup")


def test_publish_evaluates_its_input_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        calls.add(1)
        return x

    for mode in ("append", "append_once", "replace_run"):
        target = _fresh(spark, "rec_eval", _typed(spark, OLD), "order_date")
        start = calls.value
        pb.publish(_layout(spark, 6).repartition(2).withColumn("part_id", seen.asNondeterministic()("part_id")), target, mode=mode)
        assert calls.value - start == 6, mode


def test_unreadable_run_dates_are_rejected(spark):
    target = _fresh(spark, "rec_run_date", _typed(spark, OLD), "order_date")
    bad = _layout(spark, 2, run="03.04.2025").unionByName(_layout(spark, 3)).unionByName(_layout(spark, 1, run=None, industry="3W"))
    for _ in range(2):
        r = pb.publish(bad, target, mode="replace_run")
        assert (r.inserted, r.rejected) == (4, 2)
    # a missing run date is a run of its own: replaced, not doubled
    assert spark.table(target).where("run_date is null").count() == 1
    assert {x._reject for x in pb.rejects(bad).collect()} == {"run_date"}
    up = _upload(spark, [("25/05/01", "1", "IN", "a", "9", "Forecast", "desc", "2W", None, "5th of April")])
    r = pb.replace_by_key_table(up, target)
    assert (r.inserted, r.rejected) == (0, 1)


def test_intents_survive_odd_names(spark):
    target = _fresh(spark, "rec_intent", _typed(spark, OLD), None)
    sinks.set_intent(spark, target, do="it's \"so\" \\ here", when=dt.date(2025, 1, 1))
    assert sinks.intent_of(spark, target) == {"do": "it's \"so\" \\ here", "when": "2025-01-01"}
    sinks.clear_intent(spark, target)
    assert sinks.intent_of(spark, target) is None and sinks.intent_of(spark, "no_such_table") is None
