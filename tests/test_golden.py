"""Golden edge cases G1-G6 (FIXTURES.md §4), computed by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from sparecast.operators import apportion as ap
from sparecast.operators import classify as cl
from sparecast.operators import demand as dm
from sparecast.operators import forecast as fc
from sparecast.operators import publish as pb

from . import fixtures as fx

DEMAND_SCHEMA = T.StructType([
    T.StructField("Part_Id", T.StringType()),
    T.StructField("qty", T.LongType()),
    T.StructField("value", T.DecimalType(28, 2)),
])


def classes(spark, values, buckets=8):
    rows = [(f"P{i + 1}", int(v), Decimal(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, DEMAND_SCHEMA)
    out = cl.pareto_classes(df, buckets=buckets).collect()
    by = {r.Part_no: r for r in out}
    return ([by[f"P{i + 1}"].value_contribution_pct_category for i in range(len(values))],
            [by[f"P{i + 1}"].qty_contribution_pct_category for i in range(len(values))],
            by)


# G1 -------------------------------------------------------------------------

@pytest.mark.parametrize("values, letters", [
    ([50, 30, 10, 4, 4, 2], "AABCCC"),
    ([85, 15], "BC"),
    ([100], "C"),
    ([90, 30, -20], "BCC"),
])
def test_g1_pareto(spark, values, letters):
    value_cls, qty_cls, _ = classes(spark, values)
    assert "".join(value_cls) == letters
    assert "".join(qty_cls) == letters.replace("A", "F").replace("B", "M").replace("C", "S")


def test_g1_ties_share_one_running_share(spark):
    _, _, by = classes(spark, [50, 30, 10, 4, 4, 2])
    assert by["P4"].value_contribution_cumsum == pytest.approx(98.0)
    assert by["P5"].value_contribution_cumsum == pytest.approx(98.0)
    assert by["P2"].value_contribution_cumsum == pytest.approx(80.0)


def test_g1_categories(spark):
    _, _, by = classes(spark, [50, 30, 10, 4, 4, 2])
    assert by["P1"].categorisation == "Runner"        # A F
    assert by["P3"].categorisation == "Repeater"      # B M
    assert by["P6"].categorisation == "Stranger"      # C S


# G2 -------------------------------------------------------------------------

def test_g2_coverage_cut(spark):
    rows = []
    parts = {
        "A": [60, 30, 10],
        "B": [60, 20, 20],
        "C": [800, 195, 5],
        "D": [7],
        "E": [5, 5, 5],
    }
    for p, qs in parts.items():
        for k, q in enumerate(qs):
            rows.append(fx.line(p, "2000-09-10", q, 10 * q, dealer=f"D{k + 1}", country="NATION_1"))
    ratios = ap.dealer_ratios(fx.billing(spark, rows), fx.AS_OF, "2W").collect()
    got = {(r.Part_Id, r.DealerID): r.contribution_ratio for r in ratios}
    assert set(got) == {("A", "D1"), ("A", "D2"), ("B", "D1"), ("C", "D1"), ("C", "D2")}
    assert got[("A", "D1")] == pytest.approx(2 / 3)
    assert got[("A", "D2")] == pytest.approx(1 / 3)
    assert got[("B", "D1")] == pytest.approx(1.0)
    assert got[("C", "D1")] == pytest.approx(0.8040201005)
    assert got[("C", "D2")] == pytest.approx(0.1959798995)
    # the country keeps its underscore (two columns, no text key)
    assert {r.country for r in ratios} == {"NATION_1"}


def test_g2_keep_crossing(spark):
    rows = []
    parts = {"A": [60, 30, 10], "B": [60, 20, 20], "D": [7], "E": [5, 5, 5]}
    for p, qs in parts.items():
        for k, q in enumerate(qs):
            rows.append(fx.line(p, "2000-09-10", q, 10 * q, dealer=f"D{k + 1}", country="NATION_1"))
    ratios = ap.dealer_ratios(fx.billing(spark, rows), fx.AS_OF, "2W", keep_crossing=True).collect()
    got = {(r.Part_Id, r.DealerID): r.contribution_ratio for r in ratios}
    assert got[("A", "D3")] == pytest.approx(0.1)
    assert got[("B", "D2")] == pytest.approx(0.2) and got[("B", "D3")] == pytest.approx(0.2)
    assert got[("D", "D1")] == pytest.approx(1.0)
    assert [got[("E", f"D{k}")] for k in (1, 2, 3)] == pytest.approx([1 / 3] * 3)


# G3 / G4 --------------------------------------------------------------------

def _g3_inputs(spark):
    rows = []
    for month, q in zip(("2000-06-05", "2000-07-05", "2000-08-05"), (100, 140, 121)):
        rows.append(fx.line("P1", month, q, q * 10))
    for month, q in zip(("2000-06-05", "2000-07-05"), (7, 8)):
        rows.append(fx.line("P2", month, q, q * 50))
    rows.append(fx.line("P3", "2000-09-05", 3, 30))
    billing = fx.billing(spark, rows)
    master = fx.master(spark, [("P1", None, None, "gear"), ("P2", None, None, "bolt"),
                               ("P3", None, None, "ring"), ("P9", None, None, "old battery")])
    cls = fx.class_table(spark, [("P1", "A", "F", 10.0), ("P2", "C", "S", 50.0), ("P3", "C", "S", None)])
    return billing, master, cls


def test_g3_base_demand(spark):
    billing, master, cls = _g3_inputs(spark)
    base = fc.base_demand(billing, master, cls, fx.AS_OF, "2W").collect()
    got = {r.Part_Id: (r.Total_qty, r.qty, r.OrderValue, r.ABC_FMS_Ratio) for r in base}
    assert got["P1"] == (361, 121.0, 1210.0, 4)
    assert got["P2"] == (15, 8.0, 400.0, 1)
    assert got["P3"][:2] == (3, 3.0) and got["P3"][2] is None


def test_g3_master_fan_out(spark):
    billing, master, cls = _g3_inputs(spark)
    twice = master.unionByName(master.where("`2W_Part_Id` = 'P1'"))
    fan = {r.Part_Id: r.Total_qty for r in fc.base_demand(billing, twice, cls, fx.AS_OF, "2W").collect()}
    assert fan["P1"] == 722 and fan["P2"] == 15
    guarded = {r.Part_Id: r.Total_qty
               for r in fc.base_demand(billing, twice, cls, fx.AS_OF, "2W", dedup_master=True).collect()}
    assert guarded["P1"] == 361


def test_g4_forecast(spark):
    billing, master, cls = _g3_inputs(spark)
    base = fc.base_demand(billing, master, cls, fx.AS_OF, "2W")
    plan = fx.plan(spark, [("Jan-01", "2W", 2000.0), ("Feb-01", "2W", 600.0), ("Feb-01", "2W", 400.0),
                           ("Jan-01", "3W", 99999.0)])
    frame = fc.forecast_frame(base, plan, fx.AS_OF, "2W").collect()
    got = {(r.Part_Id, r.Forecast_month.month): r for r in frame}
    assert len(frame) == 3 * 12
    jan = {p: got[(p, 1)] for p in ("P1", "P2", "P3")}
    assert jan["P1"].Weighted_Ratio == pytest.approx(2.895778364)
    assert jan["P1"].plan_and_order_adjusted == pytest.approx(0.564676781)
    assert jan["P1"].Updated_Qty == pytest.approx(189.325890501)
    assert [jan[p].Rounded_Qty for p in ("P1", "P2", "P3")] == [190.0, 10.0, 4.0]
    assert [jan[p].forecast_value for p in ("P1", "P2", "P3")] == [1900.0, 500.0, 0.0]
    feb = {p: got[(p, 2)] for p in ("P1", "P2", "P3")}      # two plan rows add up to 1000
    assert [feb[p].Rounded_Qty for p in ("P1", "P2", "P3")] == [0.0, 5.0, 2.0]
    assert [feb[p].Updated_Qty for p in ("P1", "P2", "P3")][0] == 0.0
    assert [feb[p].forecast_value for p in ("P1", "P2", "P3")] == [0.0, 250.0, 0.0]
    mar = {p: got[(p, 3)] for p in ("P1", "P2", "P3")}      # no plan row: adj 0
    assert [mar[p].Rounded_Qty for p in ("P1", "P2", "P3")] == [121.0, 8.0, 3.0]
    assert [mar[p].forecast_value for p in ("P1", "P2", "P3")] == [1210.0, 400.0, 0.0]
    assert {r.Forecast_month for r in frame} == {dt.date(2001, m, 1) for m in range(1, 13)}


# G5 -------------------------------------------------------------------------

def test_g5_replace_by_key(spark):
    def row(key, country, qty):
        return (dt.date(2025, 5, 1), key, country, "P", qty, "d", "2W", "A_F", dt.date(2025, 4, 3), "Forecast")
    target = spark.createDataFrame(
        [row(1, "IN", 10), row(2, "IN", 20), row(3, None, 30)], pb.PUBLISHED_SCHEMA)
    upload = spark.createDataFrame(
        [row(2, "IN", 21), row(2, "IN", 22), row(4, "IN", 40)], pb.PUBLISHED_SCHEMA)
    out = sorted((r.dealer_id, r.order_qty) for r in pb.replace_by_key(target, upload).collect())
    assert out == [(1, 10), (2, 21), (2, 22), (3, 30), (4, 40)]


def test_g5_upload_text_dates_and_default_class(spark):
    from sparecast.sources.csv import UPLOAD_COLUMNS

    schema = T.StructType([T.StructField(c, T.DoubleType() if c in ("dealer_id", "order_qty") else T.StringType())
                           for c in UPLOAD_COLUMNS])
    upload = spark.createDataFrame(
        [("25/05/01", 7.0, "IN", "P", 5.7, "Forecast", "desc", "2W", None, "25/04/03"),
         ("25/05/01", None, "IN", "Q", 1.0, "Forecast", "desc", "2W", "B_M", "bad")], schema)
    rows = sorted(pb.to_published(pb.conform_upload(upload), "yy/MM/dd").collect(), key=lambda r: r.part_id)
    assert rows[0].order_date == dt.date(2025, 5, 1)
    assert rows[0].dealer_id == 7 and rows[0].order_qty == 5          # truncated
    assert rows[0].ABC_FMS == "A_F" and rows[0].run_date == dt.date(2025, 4, 3)
    assert rows[1].dealer_id is None and rows[1].run_date is None       # NULL, not an error


# G6 -------------------------------------------------------------------------

def test_g6_dedup(spark):
    rows = [fx.line("P", "2000-05-01", 2, "9.00"), fx.line("P", "2000-05-01", 2, "9.00"),
            fx.line("P", "2000-05-01", 3, "9.00")]
    b = fx.billing(spark, rows)
    r = dm.segment_demand(b, fx.AS_OF, 13, 1, "2W").collect()[0]
    assert (r.qty, r.value) == (5, Decimal("18.00"))
    r = dm.segment_demand(b, fx.AS_OF, 13, 1, "2W", dedup=False).collect()[0]
    assert (r.qty, r.value) == (7, Decimal("27.00"))


def test_g6_truncate_before_dedup(spark):
    rows = [fx.line("P", "2000-05-01", 2.9, "9.00"), fx.line("P", "2000-05-01", 2.1, "9.00")]
    r = dm.segment_demand(fx.billing(spark, rows), fx.AS_OF, 13, 1, "2W").collect()[0]
    assert r.qty == 2


def test_window_bounds_and_segment_filter(spark):
    rows = [fx.line("P", "1999-11-30", 1, 1), fx.line("P", "1999-12-01", 2, 2),
            fx.line("P", "2000-11-30", 4, 4), fx.line("P", "2000-12-01", 8, 8),
            fx.line("P", "2000-06-01", 16, 16, segment="3W"),
            fx.line("P", "2000-06-01", 32, 32, kind="Accessories")]
    r = dm.segment_demand(fx.billing(spark, rows), fx.AS_OF, 13, 1, "2W").collect()[0]
    assert r.qty == 6


def test_g5_replace_by_key_with_shared_lineage(spark):
    """An upload derived from the target itself (same lineage) still matches by value."""
    def row(key, qty):
        return (dt.date(2025, 5, 1), key, "IN", "P", qty, "d", "2W", "A_F", dt.date(2025, 4, 3), "Forecast")
    target = spark.createDataFrame([row(1, 10), row(2, 20), row(3, 30)], pb.PUBLISHED_SCHEMA)
    upload = target.where("dealer_id = 2").withColumn("order_qty", target["order_qty"] + 1)
    out = sorted((r.dealer_id, r.order_qty) for r in pb.replace_by_key(target, upload).collect())
    assert out == [(1, 10), (2, 21), (3, 30)]
    kept = sorted(r.dealer_id for r in pb.rows_not_in(target, target.where("dealer_id <> 2")).collect())
    assert kept == [2]


def test_negative_net_quantity_is_priced(spark):
    """More returned than sent: the price of the net, rounded half away from zero."""
    import datetime as dt
    from decimal import Decimal

    from sparecast.operators.pricing import unit_price

    schema = "MaterialNumber string, Country string, DealerCode string, LeoDate date, DispatchQuantity bigint, DispatchValue decimal(18,2)"
    day = dt.date(2000, 8, 1)
    rows = [("P1", "C", "D", day, 2, Decimal("5.00")), ("P1", "C", "D", day, -10, Decimal("-27.00")),
            ("P2", "C", "D", day, -2, Decimal("0.01")), ("P3", "C", "D", day, 3, Decimal("9.00")), ("P3", "C", "D", day, -3, Decimal("-1.00"))]
    got = {r.Part_Id: r.NDP for r in unit_price(spark.createDataFrame(rows, schema), fx.AS_OF, 7, 2).collect()}
    assert got == {"P1": 2.75, "P2": -0.01, "P3": None}


def test_unknown_segments_raise(spark):
    with pytest.raises(KeyError):
        cl.classify_segments(fx.billing(spark, []), fx.billing(spark, []), fx.AS_OF, ("2W", "4W"))


def test_plan_labels_do_not_follow_the_locale():
    from sparecast.functions.periods import month_label_of

    assert [month_label_of(f"2024-{m:02d}-15") for m in (1, 5, 12)] == ["Jan-24", "May-24", "Dec-24"]
