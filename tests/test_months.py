"""Monthly partial aggregates: equal to the lines, one month read per new month, late lines reopen theirs."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from sparecast.operators import accuracy as acc
from sparecast.operators import demand as dm
from sparecast.operators import months as mo
from sparecast.sources import sinks

D = dt.date


def _lines(spark, rows):
    full = [(p, d, c, day, q, v, ind, t) for p, d, c, day, q, v, ind, t in rows]
    return spark.createDataFrame(full, "MaterialNumber string, DealerID long, country string, BillingDate timestamp, "
                                       "BilledQuantity double, BilledValue decimal(18,2), industry string, Type string")


def _line(part, day, qty=2.9, value="9.00", dealer=1, country="IN", industry="2W", kind="Parts"):
    from decimal import Decimal

    return (part, dealer, country, dt.datetime(*day, 23, 59), float(qty), Decimal(value), industry, kind)


ROWS = [
    _line("P", (2000, 5, 1)), _line("P", (2000, 5, 1)), _line("P", (2000, 5, 1), dealer=2), _line("P", (2000, 5, 31), qty=3),
    _line("P", (2000, 6, 30)), _line("P", (2000, 8, 1), country=""), _line("P", (2000, 8, 1), dealer=None), _line("P", (2000, 8, 2), country=None),
    _line("Q", (2000, 6, 1), industry="3W"), _line("P", (2000, 6, 1), industry="3W", qty=-4), _line("Q", (2000, 6, 1), kind="Accessories"),
    _line("R", (2000, 9, 1)), _line(None, (2000, 7, 1)),
]


def _tables(spark, name):
    t = mo.MonthTables(name)
    for table in (t.parts, t.dealers, t.segments):
        for suffix in ("", sinks.STAGE, sinks.NEW):
            sinks.drop_table(spark, table + suffix)
    return t


def _same(a, b):
    assert a.columns == b.columns and [f.dataType for f in a.schema] == [f.dataType for f in b.schema]
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def _check_index(spark, lines, tables):
    states = mo.month_states(spark, tables, lines=lines)
    every = lines.where("Type = 'Parts' and BillingDate is not null").select(
        "industry", F.col("MaterialNumber").alias("Part_Id"), F.trunc("BillingDate", "MM").alias("first_month"))
    closed = every.where(F.col("first_month").isin([D.fromisoformat(d) for d in sinks.partition_values(spark, tables.parts)]))
    first = closed.groupBy("industry", "Part_Id").agg(F.min("first_month").alias("first_month"))
    assert _same(spark.table(tables.segments), first)
    wanted = spark.createDataFrame([(p,) for p in ("P", "Q", "R", "Z", "none", None)], "Part_Id string")
    for segment in ("2W", "3W"):
        assert _same(acc.segment_parts(states, segment, wanted), acc.segment_parts(lines, segment, wanted))
    return states


def _check(spark, lines, tables, as_of):
    states = _check_index(spark, lines, tables)
    for n, m in ((13, 1), (4, 2)):
        for segment, by in (("2W", ("Part_Id",)), (("2W", "3W"), ("industry", "Part_Id"))):
            assert _same(dm.segment_demand(states, as_of, n, m, segment, by), dm.segment_demand(lines, as_of, n, m, segment, by))
            if n > 4:
                assert _same(dm.active_month_demand(states, as_of, n, m, segment, by), dm.active_month_demand(lines, as_of, n, m, segment, by))
        assert _same(dm.monthly_demand(states, as_of, n, m, "2W"), dm.monthly_demand(lines, as_of, n, m, "2W"))
        assert _same(dm.dealer_demand(states, as_of, n, m, "2W"), dm.dealer_demand(lines, as_of, n, m, "2W"))


def test_windows_from_months_equal_those_from_lines(spark):
    lines, tables = _lines(spark, ROWS), _tables(spark, "mo_equal")
    assert mo.close_months(spark, lines, tables, "2000-09-15") == [D(2000, k, 1) for k in (5, 6, 7, 8)]
    _check(spark, lines, tables, "2000-09-15")
    states = mo.month_states(spark, tables)
    with pytest.raises(ValueError, match="other rules"):
        dm.segment_demand(states, "2000-09-15", 3, 1, "2W", dedup=False)
    with pytest.raises(ValueError, match="one segment"):
        dm.segment_demand(states, "2000-09-15", 3, 1, ("2W", "3W"))
    with pytest.raises(ValueError, match="dealer and a country"):
        dm.segment_demand(states, "2000-09-15", 3, 1, "2W", by=("Part_Id", "DealerID"))


def test_new_and_late_and_emptied_months(spark):
    tables = _tables(spark, "mo_late")
    assert mo.close_months(spark, _lines(spark, ROWS), tables, "2000-07-15") == [D(2000, 5, 1), D(2000, 6, 1)]
    assert mo.close_months(spark, _lines(spark, ROWS), tables, "2000-07-20", "2000-05-01") == []
    assert mo.close_months(spark, _lines(spark, ROWS), tables, "2000-10-01", "2000-05-01") == [D(2000, k, 1) for k in (7, 8, 9)]
    late = [_line("P", (2000, 5, 2)), _line("Z", (2000, 6, 9))]
    every = _lines(spark, ROWS + late)
    assert D(2000, 5, 1) in mo.close_months(spark, every, tables, "2000-10-01", "2000-05-01", _lines(spark, late))
    _check(spark, every, tables, "2000-10-01")
    gone = every.where("BillingDate < '2000-06-01' or BillingDate >= '2000-07-01'")
    mo.refresh(spark, gone, tables, [D(2000, 6, 1)])
    assert D(2000, 6, 1) not in mo.held_months(spark, tables)
    _check(spark, gone, tables, "2000-10-01")
    assert mo.close_months(spark, _lines(spark, []), _tables(spark, "mo_none"), "2000-10-01") == []


def test_a_new_month_reads_one_month(spark, tmp_path):
    """The lines of other months are pruned: by partition where the lines have one, by pushed ranges anyhow."""
    path = str(tmp_path / "lines")
    _lines(spark, ROWS).withColumn("day", F.to_date("BillingDate")).write.parquet(path)
    rows = mo.month_demand(spark.read.parquet(path), [D(2000, 6, 1)], mo.PART_KEYS)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "GreaterThanOrEqual(BillingDate,2000-06-01" in pushed and "LessThan(BillingDate,2000-07-01" in pushed
    condition = mo.in_months("d", [D(2000, 1, 9), D(1999, 12, 1), D(2000, 3, 1)])
    days = spark.sql("select explode(sequence(date'1999-11-01', date'2000-05-01')) as d").where(condition)
    assert {str(r.d)[:7] for r in days.collect()} == {"1999-12", "2000-01", "2000-03"}


def test_an_interrupted_refresh_is_finished(spark, monkeypatch):
    lines, tables = _lines(spark, ROWS), _tables(spark, "mo_stop")
    mo.close_months(spark, lines, tables, "2000-07-15")
    for step in ("replace_partitions", "set_intent"):
        with monkeypatch.context() as m:
            m.setattr(sinks, step, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                mo.close_months(spark, lines, tables, "2000-10-01", "2000-05-01")
        mo.close_months(spark, lines, tables, "2000-10-01", "2000-05-01")
        _check(spark, lines, tables, "2000-10-01")
        for table, column in ((tables.parts, "month"), (tables.dealers, "month"), (tables.segments, "first_month")):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = DATE'2000-08-01')")


def test_the_index_of_parts_reads_what_may_change(spark, tmp_path):
    """A closed month reads its own month rows and the older entries; lines are read for open months only."""
    lines, tables = _lines(spark, [*ROWS, _line("N", (2000, 10, 3)), _line("N", (2000, 4, 30))]), _tables(spark, "mo_index")
    mo.close_months(spark, lines, tables, "2000-09-15", "2000-05-01")
    _check_index(spark, lines, tables)  # N was billed before the first held month and after the last one only
    rows = mo.first_months(spark.table(tables.parts), spark.table(tables.segments), D(2000, 8, 1))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*?)\], Pushed", plan)
    assert len(filters) == 2 and any(">= 2000-08-01" in f for f in filters) and any("< 2000-08-01" in f for f in filters)
    lines.write.parquet(str(tmp_path / "lines"))
    states = mo.month_states(spark, tables, lines=spark.read.parquet(str(tmp_path / "lines")))
    wanted = spark.createDataFrame([("P",)], "Part_Id string")
    plan = acc.segment_parts(states, "2W", wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("mo_index_part_segments") == 1 and "mo_index_part_months" not in plan
    lines_read = [line for line in plan.splitlines() if "Filter" in line and "BillingDate" in line]
    # August has no line with a dealer and a country, so it isn't held
    assert len(lines_read) == 1 and "2000-05-01" in lines_read[0] and "2000-08-01" in lines_read[0], plan
