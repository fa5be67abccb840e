"""Named queries over the shared test tables (one per operator group).

Each query takes ``(spark, sf_dir)``, binds the canonical inputs to the test
tables (``sparecast.sources.testdata``) and returns a lazy DataFrame.  The
matching DuckDB statements are in ``sparecast.plans.oracle``; column names and
types agree one to one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import month_start, run_date
from ..operators import accuracy as acc
from ..operators import apportion as ap
from ..operators import checks
from ..operators import classify as cl
from ..operators import demand as dm
from ..operators import forecast as fc
from ..operators import months
from ..operators import publish as pb
from ..operators.pricing import unit_price
from ..operators.running import materialize_for_running_totals, running_totals_desc
from ..session import checkpoint_dir, materialize
from ..sources import sinks
from ..sources import testdata as td
from . import jobs
from .oracle import AS_OF

PREVIEW_ROWS = 10


class Inputs:
    """Canonical inputs bound to one test-data folder (built lazily, once)."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF,
                 exclude_text: str = td.EXCLUDED_TEST_TEXT):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self.exclude_text = exclude_text

    @cached_property
    def billing(self) -> DataFrame:
        return td.billing(self.spark, self.sf_dir)

    @cached_property
    def dispatch(self) -> DataFrame:
        return td.dispatch(self.spark, self.sf_dir)

    @cached_property
    def master(self) -> DataFrame:
        return td.parts_master(self.spark, self.sf_dir)

    @cached_property
    def plan(self) -> DataFrame:
        return td.plan(self.spark, self.sf_dir)

    @cached_property
    def published(self) -> DataFrame:
        return td.published(self.spark, self.sf_dir)

    @cached_property
    def upload(self) -> DataFrame:
        return td.upload(self.spark, self.sf_dir)

    def class_table(self, segment: str) -> DataFrame:
        """Built once per query (an ``Inputs`` lives for one query)."""
        cache = self.__dict__.setdefault("_classes", {})
        if segment not in cache:
            cache[segment] = cl.classify_parts(self.billing, self.dispatch, self.as_of, segment)
        return cache[segment]

    def base(self, segment: str) -> DataFrame:
        return fc.base_demand(self.billing, self.master, self.class_table(segment), self.as_of, segment,
                              exclude_text=self.exclude_text)

    def forecast_frame(self, segment: str) -> DataFrame:
        return fc.forecast_frame(self.base(segment), self.plan, self.as_of, segment)

    def part_forecast(self, segment: str) -> DataFrame:
        return fc.plan_forecast(self.base(segment), self.plan, self.as_of, segment)

    def ratios(self, segment: str) -> DataFrame:
        return ap.dealer_ratios(self.billing, self.as_of, segment)

    def apportioned(self, segment: str) -> DataFrame:
        return ap.apportion(self.part_forecast(segment), self.ratios(segment))

    def layout(self, segment: str) -> DataFrame:
        return pb.format_publish(self.apportioned(segment), self.master, self.as_of, segment)

    def typed_upload(self) -> DataFrame:
        return pb.typed_upload(self.upload, td.UPLOAD_DATE_PATTERN)


def _money(df: DataFrame, *cols: str) -> DataFrame:
    """Report exact money sums as DOUBLE."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------


def q_segment_demand(segment: str):
    def q(spark, sf_dir):
        i = Inputs(spark, sf_dir)
        n, m = cl.CLASS_WINDOW
        return _money(dm.segment_demand(i.billing, i.as_of, n, m, segment), "value")
    return q


def q_monthly_demand(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    n, m = fc.BASE_WINDOW["2W"]
    return _money(dm.monthly_demand(i.billing, i.as_of, n, m, "2W"), "value")


def q_dealer_demand(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    n, m = ap.RATIO_WINDOW
    return _money(dm.dealer_demand(i.billing, i.as_of, n, m, "2W"), "value")


def _class_demand(i: Inputs, segment: str = "2W") -> DataFrame:
    n, m = cl.CLASS_WINDOW
    return dm.segment_demand(i.billing, i.as_of, n, m, segment)


def q_share_of_total(spark, sf_dir):
    return cl.share_of_total(_class_demand(Inputs(spark, sf_dir)))


def q_running_share(kind: str):
    def q(spark, sf_dir):
        i = Inputs(spark, sf_dir)
        total = "_total_value" if kind == "value" else "_total_qty"
        base, cuts = materialize_for_running_totals(_class_demand(i), [kind])
        d = cl.with_totals(running_totals_desc(base, {kind: f"cum_{kind}"}, cuts=cuts), cl.grand_totals(base))
        return d.select(
            F.col("Part_Id").alias("Part_no"),
            F.col(kind).cast("double" if kind == "value" else "bigint").alias(kind),
            F.col(f"cum_{kind}").cast("double" if kind == "value" else "bigint").alias(f"cum_{kind}"),
            cl.pct(f"cum_{kind}", total).alias(f"{kind}_contribution_cumsum"),
        )
    return q


def q_class_table(segment: str):
    def q(spark, sf_dir):
        return Inputs(spark, sf_dir).class_table(segment)
    return q


def q_category_counts(spark, sf_dir):
    return cl.category_counts(Inputs(spark, sf_dir).class_table("2W"))


def q_unit_price_part(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    n, m = cl.PRICE_WINDOW["2W"]
    return unit_price(i.dispatch, i.as_of, n, m)


def q_unit_price_dealer_part(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return acc.dealer_unit_price(i.dispatch, i.as_of)


def q_active_parts(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return fc.active_parts(i.master, "2W", i.exclude_text)


def q_avg_active_month(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    n, m = fc.BASE_WINDOW["2W"]
    return fc.avg_active_month(dm.active_month_demand(i.billing, i.as_of, n, m, "2W"), i.master, "2W",
                               i.exclude_text)


def q_base_demand(spark, sf_dir):
    return Inputs(spark, sf_dir).base("2W")


def q_plan_horizon(spark, sf_dir):
    return Inputs(spark, sf_dir).forecast_frame("2W").select("Part_Id", "Forecast_month", "Plan")


def q_plan_forecast(segment: str):
    def q(spark, sf_dir):
        return Inputs(spark, sf_dir).part_forecast(segment)
    return q


def q_forecast_detail(spark, sf_dir):
    return Inputs(spark, sf_dir).forecast_frame("2W").select(
        "Part_Id", "Forecast_month", "Plan", "Weighted_Ratio", "plan_and_order_adjusted",
        "Updated_Qty", "Rounded_Qty", "forecast_value")


def q_forecast_summary(spark, sf_dir):
    return fc.forecast_summary(Inputs(spark, sf_dir).forecast_frame("3W"))


def q_dealer_rank(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return ap.dealer_shares(i.billing, i.as_of, "2W").select(
        "Part_Id", "DealerID", "country", "qty", "total_qty", "contribution_percentage",
        F.col("rank").cast("bigint").alias("rank"))


def q_coverage_cut(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return ap.coverage_cut(ap.dealer_shares(i.billing, i.as_of, "2W")).select(
        "Part_Id", "DealerID", "country", "qty", "cumulative_qty", "total_qty")


def q_dealer_ratios(spark, sf_dir):
    return Inputs(spark, sf_dir).ratios("2W")


def q_apportioned_forecast(spark, sf_dir):
    return Inputs(spark, sf_dir).apportioned("2W")


def q_publish_layout(spark, sf_dir):
    return Inputs(spark, sf_dir).layout("2W")


def q_conform_types(spark, sf_dir):
    return pb.conform_staging(Inputs(spark, sf_dir).layout("3W"))


def q_publish_append(spark, sf_dir):
    """The published table after appending both segments' new run (one pass)."""
    i = Inputs(spark, sf_dir)
    new = pb.to_published(pb.conform_staging(_layout_all(i)))
    return i.published.select(*pb.PUBLISHED_COLUMNS).unionByName(new)


def q_rows_not_in_upload(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return pb.rows_not_in(i.published, i.typed_upload())


def q_replace_by_key(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return pb.replace_by_key(i.published, i.typed_upload())


def _own_table(spark: SparkSession, what: str) -> str:
    """A table name no other run has; the table stays in the session's warehouse for the returned frame."""
    return f"sparecast_{what}_{uuid.uuid4().hex}"


def q_publish_append_table(spark, sf_dir):
    """``publish_append`` through the catalog: backup, append by name, counts."""
    i, name = Inputs(spark, sf_dir), _own_table(spark, "append")
    sinks.write_table(i.published, name, partition_by="order_date")
    report = pb.publish(_layout_all(i), name, f"{name}_backup")
    assert report.after == report.before + report.inserted and report.backup_rows == report.before
    return spark.table(name).select(*pb.PUBLISHED_COLUMNS)


def q_publish_rerun_table(spark, sf_dir):
    """The same run published by ``append`` and again by ``replace_run``: the rows of one run."""
    i, name = Inputs(spark, sf_dir), _own_table(spark, "rerun")
    sinks.write_table(i.published, name, partition_by="order_date")
    dealer = materialize(_layout_all(i))
    pb.publish(dealer, name)
    report = pb.publish(dealer, name, mode="replace_run", segments=SEGMENTS, run_date=run_date(i.as_of))
    assert report.replaced >= report.inserted
    return spark.table(name).select(*pb.PUBLISHED_COLUMNS)


def q_replace_by_key_table(spark, sf_dir):
    """``replace_by_key`` on a table partitioned by order date (dynamic overwrite of the touched months)."""
    i, name = Inputs(spark, sf_dir), _own_table(spark, "upload")
    sinks.write_table(i.published, name, partition_by="order_date")
    pb.replace_by_key_table(i.upload, name, td.UPLOAD_DATE_PATTERN)
    return spark.table(name).select(*pb.PUBLISHED_COLUMNS)


def q_replace_by_key_bucketed(spark, sf_dir):
    """``replace_by_key`` on a table by order date whose rows are bucketed by the other keys (the table isn't shuffled)."""
    i, name = Inputs(spark, sf_dir), _own_table(spark, "bucketed")
    pb.create_publish_table(spark, name, buckets=sinks.bucket_count(td.published_at_most(spark, sf_dir)))
    sinks.append_by_name(i.published, name)
    pb.replace_by_key_table(i.upload, name, td.UPLOAD_DATE_PATTERN)
    return spark.table(name).select(*pb.PUBLISHED_COLUMNS)


def q_replace_by_key_swap(spark, sf_dir):
    """``replace_by_key`` on a table without partitions (whole rebuild and swap, backup kept)."""
    i, name = Inputs(spark, sf_dir), _own_table(spark, "swap")
    sinks.write_table(i.published, name)
    pb.replace_by_key_table(i.upload, name, td.UPLOAD_DATE_PATTERN)
    return spark.table(name).select(*pb.PUBLISHED_COLUMNS)


def _month_states(i: Inputs) -> dm.MonthStates:
    """The month tables of all closed months, built in two steps: up to a year before, then the rest with a late month again."""
    tables = months.MonthTables(_own_table(i.spark, "months"))
    early = month_start(i.as_of, -12)
    first = months.close_months(i.spark, i.billing.where(F.col("BillingDate") < F.lit(early)), tables, early)
    late = i.billing.where((F.col("BillingDate") >= F.lit(month_start(i.as_of, -14))) & (F.col("BillingDate") < F.lit(month_start(i.as_of, -13))))
    done = months.close_months(i.spark, i.billing, tables, i.as_of, first[0] if first else early, late)
    assert len(done) == (13 if first else 12)
    return months.month_states(i.spark, tables, lines=i.billing)


def q_class_table_months(spark, sf_dir):
    """``class_table_all`` from the month tables."""
    i = Inputs(spark, sf_dir)
    return cl.classify_segments(_month_states(i), i.dispatch, i.as_of)


def q_base_demand_months(spark, sf_dir):
    """``base_demand`` from the month tables."""
    i = Inputs(spark, sf_dir)
    return fc.base_demand(_month_states(i), i.master, i.class_table("2W"), i.as_of, "2W", exclude_text=i.exclude_text)


def q_dealer_ratios_months(spark, sf_dir):
    """``dealer_ratios_all`` from the month tables."""
    i = Inputs(spark, sf_dir)
    return ap.dealer_ratios(_month_states(i), i.as_of, SEGMENTS)


def q_monthly_actuals_index(spark, sf_dir):
    """``monthly_actuals`` from the index of parts, and the lines of months that aren't closed."""
    i = Inputs(spark, sf_dir)
    return _money(acc.monthly_actuals(i.dispatch, _month_states(i), i.as_of, "2W"), "value")


def q_parts_in_segment_index(spark, sf_dir):
    """``parts_in_segment`` from the index of parts."""
    i = Inputs(spark, sf_dir)
    return _money(acc.dispatch_in_segment(i.dispatch, _month_states(i), i.as_of, "2W"), "value")


def _shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share, for the files a query makes."""
    return checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")


def _sources(i: Inputs) -> jobs.Sources:
    """The canonical inputs as a user has them: two tables (one under other column names), two CSV files."""
    own, folder = _own_table(i.spark, "sources"), _shared_folder(i.spark)
    sinks.write_table(i.billing.withColumnRenamed("BilledValue", "net value"), f"{own}_billing")
    sinks.write_table(i.dispatch, f"{own}_dispatch")
    files = {}
    for name, frame, encoding in (("master", i.master, "ISO-8859-1"), ("plan", i.plan, "UTF-8")):
        files[name] = f"{folder}/{own}_{name}.csv"
        frame.write.options(header=True, escape='"', encoding=encoding).csv(files[name])
    return jobs.Sources(f"{own}_billing", f"{own}_dispatch", files["master"], files["plan"], i.exclude_text, {"BilledValue": "net value"})


def q_jobs_layout(spark, sf_dir):
    """``publish_layout_all`` by the monthly jobs, over catalog tables and CSV files, through the readers."""
    i = Inputs(spark, sf_dir)
    src, tables = _sources(i), jobs.Tables(prefix=_own_table(spark, "jobs"))
    jobs.classify(spark, src, tables, i.as_of)
    jobs.forecast(spark, src, tables, i.as_of)
    jobs.apportion(spark, src, tables, i.as_of)
    return spark.table(tables.dealer_forecast).select(*pb.LAYOUT_COLUMNS)


def q_upload_file_table(spark, sf_dir):
    """``replace_by_key`` by the upload job, from a CSV file."""
    i, name = Inputs(spark, sf_dir), _own_table(spark, "upload")
    sinks.write_table(i.published, name, partition_by="order_date")
    path = f"{_shared_folder(spark)}/{name}.csv"
    i.upload.write.options(header=True, escape='"', encoding="ISO-8859-1", compression="gzip").csv(path)
    jobs.upload(spark, jobs.Tables(published=name), path, td.UPLOAD_DATE_PATTERN)
    return spark.table(name).select(*pb.PUBLISHED_COLUMNS)


def q_publish_once_table(spark, sf_dir):
    """``publish_append`` published twice by ``append_once``, with a backup of the touched months, restored and published again."""
    i, name = Inputs(spark, sf_dir), _own_table(spark, "once")
    sinks.write_table(i.published, name, partition_by="order_date")
    dealer = materialize(_layout_all(i))
    first = pb.publish(dealer, name, f"{name}_backup", mode="append_once", backup_scope="touched")
    assert pb.publish(dealer, name, mode="append_once").inserted == 0
    sinks.restore(spark, f"{name}_backup")
    assert spark.table(name).count() == first.before
    again = pb.publish(dealer, name, f"{name}_backup", backup_scope="touched")
    assert again.after == first.after and again.backup_rows == first.backup_rows <= first.before
    return spark.table(name).select(*pb.PUBLISHED_COLUMNS)


def q_parts_in_segment(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return _money(acc.dispatch_in_segment(i.dispatch, i.billing, i.as_of, "2W"), "value")


def q_monthly_actuals(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return _money(acc.monthly_actuals(i.dispatch, i.billing, i.as_of, "2W"), "value")


def q_published_demand(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    order_month = month_start(i.as_of, -1)
    return acc.published_demand(i.published, run_date(month_start(order_month, -1)), order_month)


def _backtest(i: Inputs) -> DataFrame:
    return acc.backtest_rows(i.billing, i.master, i.class_table("2W"), i.plan, i.as_of, "2W",
                             exclude_text=i.exclude_text)


def q_backtest_rows(spark, sf_dir):
    return _backtest(Inputs(spark, sf_dir))


def q_backtest_accuracy(spark, sf_dir):
    return acc.accuracy(_backtest(Inputs(spark, sf_dir)))


def q_reconciliation(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    n, m = fc.BASE_WINDOW["2W"]
    return checks.reconcile(i.class_table("2W"), i.part_forecast("2W"),
                            dm.monthly_demand(i.billing, i.as_of, n, m, "2W"))


def q_dealer_key_split(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    n, m = ap.RATIO_WINDOW
    keyed = dm.dealer_demand(i.billing, i.as_of, n, m, "2W").withColumn("DealerID_country", dm.dealer_key())
    dealer_piece, country_piece = dm.split_dealer_key()
    return keyed.select("Part_Id", "DealerID_country", dealer_piece.alias("dealer_piece"),
                        country_piece.alias("country_piece"), "qty")


SEGMENTS = ("2W", "3W")


def q_class_table_all(spark, sf_dir):
    """Both segments' class tables from one pass (``industry`` as a key)."""
    i = Inputs(spark, sf_dir)
    return cl.classify_segments(i.billing, i.dispatch, i.as_of, SEGMENTS)


def _forecast_all(i: Inputs) -> DataFrame:
    classes = cl.classify_segments(i.billing, i.dispatch, i.as_of, SEGMENTS)
    base = fc.base_demand_segments(i.billing, i.master, classes, i.as_of, SEGMENTS, exclude_text=i.exclude_text)
    return fc.plan_forecast(base, i.plan, i.as_of, SEGMENTS)


def _layout_all(i: Inputs) -> DataFrame:
    dealer = ap.apportion(_forecast_all(i), ap.dealer_ratios(i.billing, i.as_of, SEGMENTS))
    return pb.format_publish(dealer, i.master, i.as_of, SEGMENTS)


def q_plan_forecast_all(spark, sf_dir):
    """Both segments' 12-month forecasts from one scan of the invoice lines."""
    return _forecast_all(Inputs(spark, sf_dir))


def q_dealer_ratios_all(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return ap.dealer_ratios(i.billing, i.as_of, SEGMENTS)


def q_publish_layout_all(spark, sf_dir):
    """Both segments' publish rows: every step in one pass."""
    return _layout_all(Inputs(spark, sf_dir))


def q_preview(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    order = [F.col(c) for c in ("order_date", "dealer_id", "country", "part_id", "type", "order_qty",
                                "Material_Description", "industry", "ABC_FMS", "run_date")]
    return i.published.select(*pb.PUBLISHED_COLUMNS).orderBy(*order).limit(PREVIEW_ROWS)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "segment_demand_2w": q_segment_demand("2W"),
        "segment_demand_3w": q_segment_demand("3W"),
        "monthly_demand": q_monthly_demand,
        "dealer_demand": q_dealer_demand,
        "share_of_total": q_share_of_total,
        "value_running_share": q_running_share("value"),
        "qty_running_share": q_running_share("qty"),
        "class_table_2w": q_class_table("2W"),
        "class_table_3w": q_class_table("3W"),
        "category_counts": q_category_counts,
        "unit_price_part": q_unit_price_part,
        "unit_price_dealer_part": q_unit_price_dealer_part,
        "active_parts": q_active_parts,
        "avg_active_month": q_avg_active_month,
        "base_demand": q_base_demand,
        "plan_horizon": q_plan_horizon,
        "plan_forecast_2w": q_plan_forecast("2W"),
        "plan_forecast_3w": q_plan_forecast("3W"),
        "forecast_detail": q_forecast_detail,
        "forecast_summary": q_forecast_summary,
        "dealer_rank": q_dealer_rank,
        "coverage_cut": q_coverage_cut,
        "dealer_ratios": q_dealer_ratios,
        "apportioned_forecast": q_apportioned_forecast,
        "publish_layout": q_publish_layout,
        "conform_types": q_conform_types,
        "publish_append": q_publish_append,
        "publish_append_table": q_publish_append_table,
        "publish_rerun_table": q_publish_rerun_table,
        "replace_by_key_table": q_replace_by_key_table,
        "replace_by_key_swap": q_replace_by_key_swap,
        "replace_by_key_bucketed": q_replace_by_key_bucketed,
        "rows_not_in_upload": q_rows_not_in_upload,
        "replace_by_key": q_replace_by_key,
        "parts_in_segment": q_parts_in_segment,
        "monthly_actuals": q_monthly_actuals,
        "published_demand": q_published_demand,
        "backtest_rows": q_backtest_rows,
        "backtest_accuracy": q_backtest_accuracy,
        "reconciliation": q_reconciliation,
        "dealer_key_split": q_dealer_key_split,
        "preview": q_preview,
        "class_table_all": q_class_table_all,
        "plan_forecast_all": q_plan_forecast_all,
        "dealer_ratios_all": q_dealer_ratios_all,
        "publish_layout_all": q_publish_layout_all,
        "class_table_months": q_class_table_months,
        "base_demand_months": q_base_demand_months,
        "dealer_ratios_months": q_dealer_ratios_months,
        "monthly_actuals_index": q_monthly_actuals_index,
        "parts_in_segment_index": q_parts_in_segment_index,
        "jobs_layout": q_jobs_layout,
        "upload_file_table": q_upload_file_table,
        "publish_once_table": q_publish_once_table,
    }
