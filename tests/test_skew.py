"""Hot keys: one part with a third of all lines, one value shared by many parts.

Results are checked against brute force on the small fixture; the plan is
checked for partial aggregation before every shuffle of invoice lines.
"""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparecast.operators import classify as cl
from sparecast.operators import demand as dm

from . import fixtures as fx


def _hot_rows(n: int = 3000, seed: int = 7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        part = "HOT" if i % 3 == 0 else f"P{rnd.randint(1, 400)}"
        day = f"2000-{rnd.randint(1, 11):02d}-{rnd.randint(1, 28):02d}"
        qty = rnd.choice([1, 1, 1, 2, 3])
        price = rnd.choice(["10.00", "12.50", "99.99"])
        rows.append(fx.line(part, day, qty, Decimal(price) * qty,
                            dealer=f"D{rnd.randint(1, 30)}", country=f"C{rnd.randint(1, 3)}"))
    return rows


def test_hot_part_demand_matches_brute_force(spark):
    rows = _hot_rows()
    got = {r.Part_Id: (r.qty, r.value)
           for r in dm.segment_demand(fx.billing(spark, rows), fx.AS_OF, 13, 1, "2W").collect()}
    distinct_lines = {(r[0], r[3], int(r[4]), r[5]) for r in rows}
    expect = defaultdict(lambda: [0, Decimal(0)])
    for part, _, qty, value in distinct_lines:
        expect[part][0] += qty
        expect[part][1] += value
    assert got == {k: (q, v) for k, (q, v) in expect.items()}
    assert got["HOT"][0] > 5 * max(q for k, (q, _) in got.items() if k != "HOT")


def test_hot_part_lines_are_combined_before_the_shuffle(spark):
    df = dm.segment_demand(fx.billing(spark, _hot_rows(300)), fx.AS_OF, 13, 1, "2W")
    plan = df._jdf.queryExecution().executedPlan().toString()
    df.collect()
    assert "partial_sum" in plan
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    # every shuffle on Part_Id alone is fed by a partial aggregate
    found = 0
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(Part_Id" in line and "LeoDate" not in line:
            below = next(x for x in lines[i + 1:] if x.strip(" :+-"))
            assert "partial_sum" in below, below
            found += 1
    assert found >= 1


def test_classes_with_many_tied_parts_match_single_task_window(spark):
    demand = dm.segment_demand(fx.billing(spark, _hot_rows()), fx.AS_OF, 13, 1, "2W")
    got = {r.Part_no: (r.value_contribution_pct_category, r.qty_contribution_pct_category,
                       r.qty_contribution_cumsum)
           for r in cl.pareto_classes(demand, buckets=8).collect()}
    totals = demand.agg(F.sum("value").alias("tv"), F.sum("qty").alias("tq")).first()
    ref = (demand
           .withColumn("cv", F.sum("value").over(Window.orderBy(F.desc("value"))))
           .withColumn("cq", F.sum("qty").over(Window.orderBy(F.desc("qty"))))
           .collect())

    def letter(cum, total, letters):
        if cum >= 0 and cum * 100 <= total * 80:
            return letters[0]
        if cum * 100 <= total * 95:
            return letters[1]
        return letters[2]

    ties = defaultdict(int)
    for r in ref:
        ties[r.qty] += 1
    assert max(ties.values()) > len(ref) / 10          # many parts share one quantity
    for r in ref:
        v, q, cum_q = got[r.Part_Id]
        assert v == letter(r.cv, totals.tv, "ABC")
        assert q == letter(r.cq, totals.tq, "FMS")
        assert cum_q == float(r.cq) / float(totals.tq) * 100.0
