"""Reference SQL (DuckDB dialect) for every registered query.

Each statement is self-contained: a common prelude binds the canonical inputs
(billing, dispatch, master, plan, published, upload) to the shared test tables
exactly as ``sparecast.sources.testdata`` does, then the query states the
planning semantics directly in SQL (global windows, plain joins), independent
of the Spark operators it checks.

Numeric conventions shared with the Spark side:
* quantities are BIGINT, money sums are exact DECIMAL cast to DOUBLE;
* percentages are ``x::DOUBLE / total::DOUBLE * 100``;
* class cuts compare exact totals (``cum * 100 <= 80 * total``);
* two-digit rounding of a price is integer half-up on cents.
"""

from __future__ import annotations

from ..functions.periods import horizon_months, month_window, run_date

AS_OF = "2000-12-15"


def _d(d) -> str:
    return f"DATE '{d.isoformat()}'"


def window_pred(col: str, n: int, m: int, as_of: str = AS_OF) -> str:
    start, end = month_window(as_of, n, m)
    return f"({col} >= {_d(start)} AND {col} < {_d(end)})"


PRELUDE = r"""
WITH
seg_part AS (
  SELECT p_partkey, p_name, p_size,
         CASE WHEN split_part(p_type, ' ', 1) IN ('ECONOMY', 'SMALL', 'STANDARD') THEN '2W' ELSE '3W' END AS segment
  FROM part),
sup_country AS (
  SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
billed AS (
  SELECT l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_returnflag,
         l.l_shipdate, sp.p_name, sp.segment, sc.n_name,
         CASE WHEN l.l_returnflag = 'R' THEN 'Accessories' ELSE 'Parts' END AS line_type
  FROM lineitem l JOIN seg_part sp ON l.l_partkey = sp.p_partkey
                  JOIN sup_country sc ON l.l_suppkey = sc.s_suppkey),
billing AS (
  SELECT l_partkey AS MaterialNumber, l_suppkey AS DealerID, n_name AS country,
         l_shipdate AS BillingDate, CAST(l_quantity AS INTEGER) AS BilledQuantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS BilledValue,
         segment AS industry, line_type AS Type
  FROM billed
  UNION ALL
  SELECT l_partkey, l_suppkey, n_name, l_shipdate, CAST(l_quantity AS INTEGER),
         CAST(l_extendedprice AS DECIMAL(18,2)), segment, line_type
  FROM billed WHERE l_linenumber = 7),
dispatch AS (
  SELECT l.l_partkey AS MaterialNumber, sc.n_name AS Country, l.l_suppkey AS DealerCode,
         o.o_orderdate AS LeoDate, CAST(l.l_quantity AS BIGINT) AS DispatchQuantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DispatchValue
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN sup_country sc ON l.l_suppkey = sc.s_suppkey),
master AS (
  SELECT CASE WHEN p_size <= 40 AND segment = '2W' THEN p_partkey END AS "2W_Part_Id",
         CASE WHEN p_size <= 40 AND segment = '3W' THEN p_partkey END AS "3W_Part_Id",
         CAST(NULL AS BIGINT) AS Alternate_Part_Id,
         p_name AS Part_Description
  FROM seg_part),
plan AS (
  SELECT strftime(date_trunc('month', o.o_orderdate), '%b-%y') AS Month, sp.segment AS Type,
         CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) * CAST(2.5 AS DECIMAL(2,1)) AS DOUBLE) AS Plan
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN seg_part sp ON l.l_partkey = sp.p_partkey
  GROUP BY date_trunc('month', o.o_orderdate), sp.segment),
pub_rows AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS order_month,
         CAST(date_trunc('month', l_shipdate) AS DATE) - INTERVAL 1 MONTH + INTERVAL 2 DAY AS run_day,
         l_suppkey, n_name, l_partkey, l_quantity, l_linenumber, p_name, segment, line_type
  FROM billed),
published AS (
  SELECT order_month AS order_date, l_suppkey AS dealer_id, n_name AS country,
         CAST(l_partkey AS VARCHAR) AS part_id, CAST(l_quantity AS BIGINT) AS order_qty,
         p_name AS Material_Description, segment AS industry, 'A_F' AS ABC_FMS,
         CAST(run_day AS DATE) AS run_date, line_type AS type
  FROM pub_rows),
upload AS (
  SELECT strftime(order_month, '%Y/%m/%d') AS order_date, CAST(l_suppkey AS DOUBLE) AS dealer_id,
         n_name AS country,
         CASE WHEN (l_partkey + l_suppkey) % 3 = 0 THEN '' ELSE 'N' END || CAST(l_partkey AS VARCHAR) AS part_id,
         l_quantity + 1.0 AS order_qty,
         line_type AS type, p_name AS "Material Description", segment AS industry,
         CASE WHEN l_linenumber <> 6 THEN 'B_M' END AS ABC_FMS,
         strftime(run_day, '%Y/%m/%d') AS run_date
  FROM pub_rows)
"""


def demand_cte(name: str, n: int, m: int, segment: str, monthly: bool = False) -> str:
    """Deduplicated demand per part (and month) of a segment."""
    month_key = ", CAST(date_trunc('month', LeoDate) AS DATE) AS start_of_month" if monthly else ""
    month_group = ", start_of_month" if monthly else ""
    return f"""{name} AS (
  SELECT Part_Id{month_key}, CAST(SUM(qty) AS BIGINT) AS qty, SUM(value) AS value
  FROM (SELECT DISTINCT MaterialNumber AS Part_Id, CAST(BillingDate AS DATE) AS LeoDate,
               BilledQuantity AS qty, BilledValue AS value
        FROM billing
        WHERE {window_pred('BillingDate', n, m)} AND industry = '{segment}' AND Type = 'Parts')
  GROUP BY Part_Id{month_group})"""


def price_cte(name: str, n: int, m: int, by_dealer: bool = False) -> str:
    """Unit price with integer half-up rounding of cents."""
    dealer = "DealerCode, " if by_dealer else ""
    return f"""{name} AS (
  SELECT Part_Id,
         CASE WHEN q <> 0 THEN sign(cents) * sign(q)
              * CAST((2 * abs(cents) + abs(q)) // (2 * abs(q)) AS DOUBLE) / 100.0 END AS NDP
  FROM (SELECT {dealer}MaterialNumber AS Part_Id, SUM(DispatchQuantity) AS q,
               CAST(SUM(DispatchValue) * 100 AS HUGEINT) AS cents
        FROM dispatch WHERE {window_pred('LeoDate', n, m)}
        GROUP BY {dealer}MaterialNumber))"""


def class_ctes(segment: str, suffix: str = "") -> str:
    """Class table of a segment as CTEs ``cls{suffix}`` (needs PRELUDE)."""
    pn, pm = (7, 2) if segment == "2W" else (5, 2)
    s = suffix
    return f""",
{demand_cte('cdem' + s, 13, 1, segment)},
ctot{s} AS (SELECT SUM(value) AS tv, SUM(qty) AS tq FROM cdem{s}),
crun{s} AS (
  SELECT d.Part_Id, d.qty, d.value, t.tv, t.tq,
         SUM(d.value) OVER (ORDER BY d.value DESC) AS cv,
         SUM(d.qty) OVER (ORDER BY d.qty DESC) AS cq
  FROM cdem{s} d CROSS JOIN ctot{s} t),
{price_cte('cprice' + s, pn, pm)},
cls{s} AS (
  SELECT r.Part_Id AS Part_no,
         CAST(r.value AS DOUBLE) / CAST(r.tv AS DOUBLE) * 100.0 AS value_contribution_pct,
         CAST(r.qty AS DOUBLE) / CAST(r.tq AS DOUBLE) * 100.0 AS qty_contribution_pct,
         CAST(r.cv AS DOUBLE) / CAST(r.tv AS DOUBLE) * 100.0 AS value_contribution_cumsum,
         CAST(r.cq AS DOUBLE) / CAST(r.tq AS DOUBLE) * 100.0 AS qty_contribution_cumsum,
         CASE WHEN r.cv >= 0 AND r.cv * 100 <= r.tv * 80 THEN 'A'
              WHEN r.cv * 100 > r.tv * 80 AND r.cv * 100 <= r.tv * 95 THEN 'B' ELSE 'C' END
           AS value_contribution_pct_category,
         CASE WHEN r.cq >= 0 AND r.cq * 100 <= r.tq * 80 THEN 'F'
              WHEN r.cq * 100 > r.tq * 80 AND r.cq * 100 <= r.tq * 95 THEN 'M' ELSE 'S' END
           AS qty_contribution_pct_category,
         p.NDP
  FROM crun{s} r LEFT JOIN cprice{s} p ON r.Part_Id = p.Part_Id),
clsx{s} AS (
  SELECT *, CASE value_contribution_pct_category || qty_contribution_pct_category
              WHEN 'AF' THEN 'Runner' WHEN 'AM' THEN 'Runner' WHEN 'BF' THEN 'Runner'
              WHEN 'BM' THEN 'Repeater' WHEN 'CF' THEN 'Repeater' ELSE 'Stranger' END AS categorisation
  FROM cls{s})"""


CLASS_COLS = ("Part_no, value_contribution_pct, qty_contribution_pct, value_contribution_cumsum, "
              "qty_contribution_cumsum, value_contribution_pct_category, qty_contribution_pct_category, "
              "categorisation, NDP")


def _q(body: str, ctes: str = "") -> str:
    return PRELUDE.rstrip() + ctes + "\n" + body


def dealer_ctes(segment: str = "2W", s: str = "") -> str:
    """Dealer shares, coverage cut and ratios of a segment (needs PRELUDE)."""
    return f""",
dd{s} AS (
  SELECT Part_Id, DealerID, country, CAST(SUM(qty) AS BIGINT) AS qty, SUM(value) AS value
  FROM (SELECT DISTINCT MaterialNumber AS Part_Id, DealerID, country, CAST(BillingDate AS DATE) AS LeoDate,
               BilledQuantity AS qty, BilledValue AS value
        FROM billing
        WHERE {window_pred('BillingDate', 7, 1)} AND industry = '{segment}' AND Type = 'Parts'
          AND country <> '' AND DealerID IS NOT NULL)
  GROUP BY Part_Id, DealerID, country),
sh{s} AS (SELECT *, CAST(SUM(qty) OVER (PARTITION BY Part_Id) AS BIGINT) AS total_qty FROM dd{s}),
sh2{s} AS (
  SELECT *, CAST(SUM(qty) OVER (PARTITION BY Part_Id ORDER BY qty DESC) AS BIGINT) AS cumulative_qty,
         CAST(qty AS DOUBLE) / CAST(total_qty AS DOUBLE) * 100.0 AS contribution_percentage,
         ROW_NUMBER() OVER (PARTITION BY Part_Id ORDER BY qty DESC, DealerID, country) AS "rank"
  FROM sh{s} WHERE total_qty > 0),
kept{s} AS (SELECT * FROM sh2{s} WHERE cumulative_qty * 1000 <= total_qty * 995),
ratios{s} AS (
  SELECT Part_Id, CAST(qty AS DOUBLE) / CAST(SUM(qty) OVER (PARTITION BY Part_Id) AS DOUBLE) AS contribution_ratio,
         DealerID, country
  FROM kept{s})"""


def active_cte(name: str, segment: str) -> str:
    return f"""{name} AS (
  SELECT "{segment}_Part_Id" AS Part_Id FROM master
  WHERE "{segment}_Part_Id" IS NOT NULL AND NOT coalesce(Part_Description ILIKE '%widget%', false))"""


def weight_case(expr: str, weights: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items())
    return f"CASE {expr} {whens} ELSE 0 END"


# Class weights of the forecast and of the back-test.
FORECAST_W = {"AF": 4, "AM": 4, "BF": 2, "BM": 2, "CF": 1, "AS": 1, "BS": 1, "CM": 1, "CS": 1}
BACKTEST_W = {"AF": 20, "AM": 20, "BF": 10, "BM": 5, "CF": 3, "AS": 2, "BS": 1, "CM": 1, "CS": 1}


def forecast_ctes(segment: str, s: str = "", window: tuple[int, int] | None = None,
                  weights: dict | None = None, months: list | None = None,
                  cls_suffix: str | None = None) -> str:
    """Base demand ``base{s}`` and forecast frame ``ff{s}`` (needs class_ctes(segment, s))."""
    cs = s if cls_suffix is None else cls_suffix
    n, m = window or ((10, 1) if segment == "2W" else (9, 1))
    months = months or horizon_months(AS_OF, 12, 1)
    month_rows = ", ".join(f"({_d(d)})" for d in months)
    return f""",
{demand_cte('mdem' + s, n, m, segment, monthly=True)},
{active_cte('act' + s, segment)},
permonth{s} AS (
  SELECT d.Part_Id, d.start_of_month, SUM(d.qty) AS qty
  FROM mdem{s} d JOIN act{s} a ON d.Part_Id = a.Part_Id GROUP BY d.Part_Id, d.start_of_month),
avgm{s} AS (
  SELECT Part_Id, CAST(SUM(qty) AS BIGINT) AS Total_qty, COUNT(*) AS Months_Count,
         ceil(CAST(SUM(qty) AS BIGINT) / COUNT(*)) AS qty
  FROM permonth{s} GROUP BY Part_Id),
pairs{s} AS (
  SELECT DISTINCT Part_no AS Part_Id, value_contribution_pct_category AS ABC_class,
         qty_contribution_pct_category AS Fsn_class, NDP FROM clsx{cs}),
base{s} AS (
  SELECT a.Part_Id, a.Total_qty, a.Months_Count, a.qty, c.ABC_class, c.Fsn_class, c.NDP,
         a.qty * c.NDP AS OrderValue, c.ABC_class || c.Fsn_class AS ABC_FMS,
         {weight_case('c.ABC_class || c.Fsn_class', weights or FORECAST_W)} AS ABC_FMS_Ratio
  FROM avgm{s} a JOIN pairs{s} c ON a.Part_Id = c.Part_Id),
months{s} AS (SELECT * FROM (VALUES {month_rows}) t(Forecast_month)),
mplan{s} AS (SELECT Month, SUM(Plan) AS Plan FROM plan WHERE Type = '{segment}' GROUP BY Month),
tot{s} AS (
  SELECT CAST(SUM(Total_qty) AS BIGINT) AS stq,
         CAST(SUM(CAST(qty AS DECIMAL(20,0)) * CAST(NDP AS DECIMAL(18,2))) AS DOUBLE) AS sov
  FROM base{s}),
ff0{s} AS (
  SELECT b.*, mo.Forecast_month, coalesce(p.Plan, CAST(0 AS DOUBLE)) AS Plan, t.stq, t.sov
  FROM base{s} b CROSS JOIN months{s} mo
  LEFT JOIN mplan{s} p ON p.Month = strftime(mo.Forecast_month, '%b-%y')
  CROSS JOIN tot{s} t),
ff1{s} AS (
  SELECT *, ABC_FMS_Ratio * CAST(0.7 AS DOUBLE) + qty / stq * CAST(0.3 AS DOUBLE) AS Weighted_Ratio FROM ff0{s}),
ff2{s} AS (
  SELECT *, CASE WHEN Plan <> 0 THEN (Plan - sov) / Plan * Weighted_Ratio ELSE CAST(0 AS DOUBLE) END
           AS plan_and_order_adjusted FROM ff1{s}),
ff3{s} AS (SELECT *, qty * (CAST(1 AS DOUBLE) + plan_and_order_adjusted) AS upd FROM ff2{s}),
ff{s} AS (
  SELECT *, CASE WHEN upd > 0 THEN upd ELSE CAST(0 AS DOUBLE) END AS Updated_Qty,
         ceil(upd) AS rraw,
         CASE WHEN ceil(upd) > 0 THEN ceil(upd) ELSE CAST(0 AS DOUBLE) END AS Rounded_Qty,
         coalesce(CASE WHEN CAST(CAST(ceil(upd) AS DECIMAL(20,0)) * CAST(NDP AS DECIMAL(18,2)) AS DOUBLE) > 0
                       THEN CAST(CAST(ceil(upd) AS DECIMAL(20,0)) * CAST(NDP AS DECIMAL(18,2)) AS DOUBLE) END,
                  CAST(0 AS DOUBLE)) AS forecast_value,
         '{segment}' AS industry
  FROM ff3{s})"""


def class_code(column: str) -> str:
    """A pair of class letters with an underscore between them; anything else as it is."""
    return (f"CASE WHEN regexp_full_match({column}, '[ABC][FMS]') "
            f"THEN {column}[1:1] || '_' || {column}[2:2] ELSE {column} END")


def layout_ctes(segment: str, s: str = "") -> str:
    """Apportioned forecast ``ap{s}`` and publish layout ``lay{s}`` (needs forecast and dealer ctes)."""
    rd = run_date(AS_OF).isoformat()
    return f""",
ap{s} AS (
  SELECT f.Forecast_month, r.DealerID, r.country, f.industry, f.ABC_FMS, f.Part_Id,
         round(f.Rounded_Qty * r.contribution_ratio, 0) AS Forecast_Qty, f.Rounded_Qty
  FROM ff{s} f JOIN ratios{s} r ON f.Part_Id = r.Part_Id
  WHERE r.country IS NOT NULL),
lay{s} AS (
  SELECT a.Forecast_month AS order_date, a.DealerID AS dealer_id, a.country, a.Part_Id AS part_id,
         a.Forecast_Qty AS order_qty, 'Forecast' AS type, m.Part_Description AS Material_Description,
         a.industry, {class_code('a.ABC_FMS')} AS ABC_FMS, '{rd}' AS run_date
  FROM ap{s} a JOIN master m ON a.Part_Id = m."{segment}_Part_Id"),
stg{s} AS (
  SELECT CAST(order_date AS VARCHAR) AS order_date, CAST(dealer_id AS DOUBLE) AS dealer_id, country,
         CAST(part_id AS VARCHAR) AS part_id, CAST(order_qty AS DOUBLE) AS order_qty, type,
         Material_Description, industry, ABC_FMS, run_date
  FROM lay{s}),
pubnew{s} AS (
  SELECT TRY_CAST(order_date AS DATE) AS order_date, TRY_CAST(trunc(dealer_id) AS BIGINT) AS dealer_id,
         country, part_id, TRY_CAST(trunc(order_qty) AS BIGINT) AS order_qty, Material_Description,
         industry, ABC_FMS, TRY_CAST(run_date AS DATE) AS run_date, type
  FROM stg{s})"""


TYPED_UPLOAD = r""",
tu AS (
  SELECT CAST(strptime(order_date, '%Y/%m/%d') AS DATE) AS order_date,
         TRY_CAST(trunc(dealer_id) AS BIGINT) AS dealer_id, country, part_id,
         TRY_CAST(trunc(order_qty) AS BIGINT) AS order_qty, "Material Description" AS Material_Description,
         industry, coalesce(ABC_FMS, 'A_F') AS ABC_FMS,
         CAST(strptime(run_date, '%Y/%m/%d') AS DATE) AS run_date, type
  FROM upload),
kept_target AS (
  SELECT * FROM published p
  WHERE NOT EXISTS (SELECT 1 FROM tu
                    WHERE p.order_date = tu.order_date AND p.dealer_id = tu.dealer_id
                      AND p.country = tu.country AND p.part_id = tu.part_id AND p.type = tu.type))"""

PUB_COLS = ("order_date, dealer_id, country, part_id, order_qty, Material_Description, industry, "
            "ABC_FMS, run_date, type")


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    seg = {"2w": "2W", "3w": "3W"}

    for k, sgm in seg.items():
        q[f"segment_demand_{k}"] = _q("SELECT Part_Id, qty, CAST(value AS DOUBLE) AS value FROM d",
                                      ",\n" + demand_cte("d", 13, 1, sgm))
    q["monthly_demand"] = _q("SELECT Part_Id, start_of_month, qty, CAST(value AS DOUBLE) AS value FROM d",
                             ",\n" + demand_cte("d", 10, 1, "2W", monthly=True))
    q["dealer_demand"] = _q("SELECT Part_Id, DealerID, country, qty, CAST(value AS DOUBLE) AS value FROM dd",
                            dealer_ctes("2W"))
    q["share_of_total"] = _q(
        "SELECT Part_no, value_contribution_pct, qty_contribution_pct FROM clsx", class_ctes("2W"))
    q["value_running_share"] = _q(
        "SELECT Part_Id AS Part_no, CAST(value AS DOUBLE) AS value, CAST(cv AS DOUBLE) AS cum_value, "
        "CAST(cv AS DOUBLE) / CAST(tv AS DOUBLE) * 100.0 AS value_contribution_cumsum FROM crun",
        class_ctes("2W"))
    q["qty_running_share"] = _q(
        "SELECT Part_Id AS Part_no, qty, CAST(cq AS BIGINT) AS cum_qty, "
        "CAST(cq AS DOUBLE) / CAST(tq AS DOUBLE) * 100.0 AS qty_contribution_cumsum FROM crun",
        class_ctes("2W"))
    for k, sgm in seg.items():
        q[f"class_table_{k}"] = _q(f"SELECT {CLASS_COLS} FROM clsx", class_ctes(sgm))
    q["category_counts"] = _q("SELECT categorisation, COUNT(*) AS count FROM clsx GROUP BY categorisation",
                              class_ctes("2W"))
    q["unit_price_part"] = _q("SELECT Part_Id, NDP FROM p", ",\n" + price_cte("p", 7, 2))
    q["unit_price_dealer_part"] = _q("SELECT Part_Id, NDP FROM p", ",\n" + price_cte("p", 5, 2, by_dealer=True))
    q["active_parts"] = _q("SELECT Part_Id FROM a", ",\n" + active_cte("a", "2W"))

    f2 = class_ctes("2W") + forecast_ctes("2W")
    q["avg_active_month"] = _q("SELECT Part_Id, Total_qty, Months_Count, qty FROM avgm", f2)
    q["base_demand"] = _q(
        "SELECT Part_Id, Total_qty, Months_Count, qty, ABC_class, Fsn_class, NDP, OrderValue, ABC_FMS, "
        "ABC_FMS_Ratio FROM base", f2)
    q["plan_horizon"] = _q("SELECT Part_Id, Forecast_month, Plan FROM ff", f2)
    for k, sgm in seg.items():
        q[f"plan_forecast_{k}"] = _q(
            "SELECT Part_Id, Forecast_month, Rounded_Qty, ABC_FMS, industry FROM ff",
            class_ctes(sgm) + forecast_ctes(sgm))
    q["forecast_detail"] = _q(
        "SELECT Part_Id, Forecast_month, Plan, Weighted_Ratio, plan_and_order_adjusted, Updated_Qty, "
        "Rounded_Qty, forecast_value FROM ff", f2)
    q["forecast_summary"] = _q(
        "SELECT *, format('{:,.2f}', total_value) AS total_value_text FROM ("
        "SELECT Forecast_month, SUM(Rounded_Qty) AS total_qty, "
        "CAST(SUM(CASE WHEN CAST(rraw AS DECIMAL(20,0)) * CAST(NDP AS DECIMAL(18,2)) > 0 "
        "THEN CAST(rraw AS DECIMAL(20,0)) * CAST(NDP AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS total_value, "
        "COUNT(*) AS parts FROM ff GROUP BY Forecast_month)",
        class_ctes("3W") + forecast_ctes("3W"))

    d2 = dealer_ctes("2W")
    q["dealer_rank"] = _q(
        'SELECT Part_Id, DealerID, country, qty, total_qty, contribution_percentage, "rank" FROM sh2', d2)
    q["coverage_cut"] = _q("SELECT Part_Id, DealerID, country, qty, cumulative_qty, total_qty FROM kept", d2)
    q["dealer_ratios"] = _q("SELECT Part_Id, contribution_ratio, DealerID, country FROM ratios", d2)

    full2 = f2 + d2 + layout_ctes("2W")
    q["apportioned_forecast"] = _q(
        "SELECT Forecast_month, DealerID, country, industry, ABC_FMS, Part_Id, Forecast_Qty, Rounded_Qty FROM ap",
        full2)
    q["publish_layout"] = _q(
        "SELECT order_date, dealer_id, country, part_id, order_qty, type, Material_Description, industry, "
        "ABC_FMS, run_date FROM lay", full2)
    full3 = class_ctes("3W", "_3") + forecast_ctes("3W", "_3") + dealer_ctes("3W", "_3") + layout_ctes("3W", "_3")
    q["conform_types"] = _q(
        "SELECT order_date, dealer_id, country, part_id, order_qty, type, Material_Description, industry, "
        "ABC_FMS, run_date FROM stg_3", full3)
    q["publish_append"] = _q(
        f"SELECT {PUB_COLS} FROM published UNION ALL SELECT {PUB_COLS} FROM pubnew "
        f"UNION ALL SELECT {PUB_COLS} FROM pubnew_3", full2 + full3)

    q["publish_append_table"] = q["publish_append"]
    # The run replaces whatever was published under its run date and segments.
    q["publish_rerun_table"] = _q(
        f"SELECT {PUB_COLS} FROM published WHERE run_date IS DISTINCT FROM {_d(run_date(AS_OF))} "
        f"UNION ALL SELECT {PUB_COLS} FROM pubnew UNION ALL SELECT {PUB_COLS} FROM pubnew_3", full2 + full3)

    q["rows_not_in_upload"] = _q(f"SELECT {PUB_COLS} FROM kept_target", TYPED_UPLOAD)
    q["replace_by_key"] = _q(f"SELECT {PUB_COLS} FROM kept_target UNION ALL SELECT {PUB_COLS} FROM tu",
                             TYPED_UPLOAD)

    q["replace_by_key_table"] = q["replace_by_key_swap"] = q["replace_by_key_bucketed"] = q["replace_by_key"]

    sent = f"""
  SELECT Country, MaterialNumber AS Part_Id, DealerCode, CAST(LeoDate AS DATE) AS LeoDate,
         DispatchQuantity AS qty, DispatchValue AS value
  FROM dispatch d
  WHERE {window_pred('LeoDate', 2, 1)} AND EXISTS (
    FROM billing b WHERE b.MaterialNumber = d.MaterialNumber AND b.industry = '2W' AND b.Type = 'Parts')"""
    q["parts_in_segment"] = _q(
        f"SELECT Country, Part_Id, DealerCode, LeoDate, CAST(SUM(qty) AS BIGINT) AS qty, "
        f"CAST(SUM(value) AS DOUBLE) AS value FROM ({sent}) GROUP BY ALL")
    q["monthly_actuals"] = _q(
        f"SELECT Part_Id, CAST(date_trunc('month', LeoDate) AS DATE) AS start_of_month, "
        f"CAST(SUM(qty) AS BIGINT) AS qty, CAST(SUM(value) AS DOUBLE) AS value FROM ({sent}) "
        f"GROUP BY Part_Id, CAST(date_trunc('month', LeoDate) AS DATE)")
    q["published_demand"] = _q(
        "SELECT order_date, part_id AS Part_Id, country AS Country, CAST(SUM(order_qty) AS BIGINT) AS forecast_qty "
        "FROM published WHERE run_date = DATE '2000-10-03' AND order_date = DATE '2000-11-01' "
        "GROUP BY order_date, part_id, country")

    bt = (class_ctes("2W") + forecast_ctes("2W", "_b", window=(10, 2), weights=BACKTEST_W,
                                           months=horizon_months(AS_OF, 1, -1), cls_suffix="")
          + ",\n" + demand_cte("actd", 2, 1, "2W", monthly=True) + ",\n" + active_cte("acta", "2W") + """,
btr AS (
  SELECT d.Part_Id, d.start_of_month, d.qty, f.Forecast_month, f.Rounded_Qty,
         abs(CAST(d.qty AS DOUBLE) - f.Rounded_Qty) AS Absolute_error
  FROM actd d JOIN acta a ON d.Part_Id = a.Part_Id JOIN ff_b f ON d.Part_Id = f.Part_Id)""")
    q["backtest_rows"] = _q(
        "SELECT Part_Id, start_of_month, qty, Forecast_month, Rounded_Qty, Absolute_error FROM btr", bt)
    q["backtest_accuracy"] = _q(
        "SELECT SUM(Absolute_error) AS sum_abs_error, CAST(SUM(qty) AS BIGINT) AS sum_actual, "
        "SUM(Rounded_Qty) AS sum_forecast, "
        "CAST(1 AS DOUBLE) - SUM(Absolute_error) / CAST(SUM(qty) AS DOUBLE) AS accuracy, "
        "COUNT(DISTINCT Part_Id) AS parts FROM btr", bt)

    q["reconciliation"] = _q(
        """SELECT c.*, f.*, d.*, f.forecast_rows = f.forecast_parts * f.forecast_months AS forecast_complete
FROM (SELECT round(SUM(value_contribution_pct), 6) AS value_pct_sum, round(SUM(qty_contribution_pct), 6) AS qty_pct_sum,
             COUNT(*) AS class_rows, COUNT(DISTINCT Part_no) AS class_parts FROM clsx) c
CROSS JOIN (SELECT COUNT(*) AS forecast_rows, COUNT(DISTINCT Forecast_month) AS forecast_months,
                   COUNT(DISTINCT Part_Id) AS forecast_parts FROM ff) f
CROSS JOIN (SELECT COUNT(DISTINCT Part_Id) AS demand_parts, MAX(start_of_month) AS latest_month FROM mdem) d""",
        f2)
    q["dealer_key_split"] = _q(
        "SELECT Part_Id, CAST(DealerID AS VARCHAR) || '_' || country AS DealerID_country, "
        "split_part(CAST(DealerID AS VARCHAR) || '_' || country, '_', 1) AS dealer_piece, "
        "split_part(CAST(DealerID AS VARCHAR) || '_' || country, '_', 2) AS country_piece, qty FROM dd", d2)
    both = class_ctes("2W") + class_ctes("3W", "_3")
    q["class_table_all"] = _q(
        f"SELECT {CLASS_COLS}, '2W' AS industry FROM clsx UNION ALL "
        f"SELECT {CLASS_COLS}, '3W' AS industry FROM clsx_3", both)
    q["plan_forecast_all"] = _q(
        "SELECT Part_Id, Forecast_month, Rounded_Qty, ABC_FMS, industry FROM ff UNION ALL "
        "SELECT Part_Id, Forecast_month, Rounded_Qty, ABC_FMS, industry FROM ff_3",
        class_ctes("2W") + forecast_ctes("2W") + class_ctes("3W", "_3") + forecast_ctes("3W", "_3"))
    q["dealer_ratios_all"] = _q(
        "SELECT '2W' AS industry, Part_Id, contribution_ratio, DealerID, country FROM ratios UNION ALL "
        "SELECT '3W' AS industry, Part_Id, contribution_ratio, DealerID, country FROM ratios_3",
        dealer_ctes("2W") + dealer_ctes("3W", "_3"))
    lay_cols = ("order_date, dealer_id, country, part_id, order_qty, type, Material_Description, industry, "
                "ABC_FMS, run_date")
    q["publish_layout_all"] = _q(f"SELECT {lay_cols} FROM lay UNION ALL SELECT {lay_cols} FROM lay_3",
                                 full2 + full3)
    # The same results by other ways: month tables, the jobs over files and tables, publishing once.
    q["class_table_months"], q["base_demand_months"] = q["class_table_all"], q["base_demand"]
    q["monthly_actuals_index"], q["parts_in_segment_index"] = q["monthly_actuals"], q["parts_in_segment"]
    q["dealer_ratios_months"], q["jobs_layout"] = q["dealer_ratios_all"], q["publish_layout_all"]
    q["upload_file_table"], q["publish_once_table"] = q["replace_by_key"], q["publish_append"]
    q["preview"] = _q(
        f"SELECT {PUB_COLS} FROM published ORDER BY order_date, dealer_id, country, part_id, type, order_qty, "
        "Material_Description, industry, ABC_FMS, run_date LIMIT 10")
    return q
