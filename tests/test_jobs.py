"""The monthly jobs end to end over catalog tables (sf0.001)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparecast.plans import jobs
from sparecast.plans.queries import registry
from sparecast.sources import sinks
from sparecast.sources import testdata as td

from .conftest import SF_SMALL

AS_OF = "2000-12-15"


def test_run_month_then_upload_then_accuracy(spark):
    src = jobs.Sources(
        billing=td.billing(spark, SF_SMALL), dispatch=td.dispatch(spark, SF_SMALL),
        master=td.parts_master(spark, SF_SMALL), plan=td.plan(spark, SF_SMALL),
        exclude_text=td.EXCLUDED_TEST_TEXT)
    tables = jobs.Tables(prefix="e2e", published="e2e_published", backup="e2e_published_backup")
    for name in ("e2e_published", "e2e_published_backup"):
        sinks.drop_table(spark, name)

    report = jobs.run_month(spark, src, tables, AS_OF)
    assert report.before == 0 and report.after == report.inserted > 0

    # the tables hold what the lazy per-segment queries compute
    reg = registry()
    layout_2w = reg["publish_layout"](spark, SF_SMALL)
    dealer = spark.table(tables.dealer_forecast)
    assert dealer.where(F.col("industry") == "2W").count() == layout_2w.count()
    assert dealer.where(F.col("industry") == "2W").select(*layout_2w.columns).exceptAll(layout_2w).count() == 0
    fc_3w = tables.part_forecast(spark, "3W").select(*reg["plan_forecast_3w"](spark, SF_SMALL).columns)
    assert fc_3w.exceptAll(reg["plan_forecast_3w"](spark, SF_SMALL)).count() == 0
    assert fc_3w.count() == reg["plan_forecast_3w"](spark, SF_SMALL).count()
    cls_3w = tables.class_table(spark, "3W")
    assert cls_3w.exceptAll(reg["class_table_3w"](spark, SF_SMALL)).count() == 0
    published = spark.table(tables.published)
    assert published.count() == report.after
    assert published.where(F.col("run_date") == "2000-12-03").count() == report.after

    # an upload replaces rows by key in the touched months only
    up = td.upload(spark, SF_SMALL).where(F.col("industry") == "2W")
    before = published.count()
    uploaded = jobs.upload(spark, tables, up, date_pattern=td.UPLOAD_DATE_PATTERN)
    assert uploaded.before == before and uploaded.after == spark.table(tables.published).count()
    assert uploaded.inserted == up.count() and uploaded.rejected == 0

    acc = jobs.backtest(spark, src, tables, AS_OF).first()
    assert acc.parts > 0 and acc.accuracy <= 1.0
    plan_value = src.plan.where("Type = '2W' AND Month = 'Nov-00'").agg(F.sum("Plan")).first()[0]
    again = jobs.backtest(spark, src, tables, AS_OF, plan_value=plan_value).first()
    assert again == acc
    assert jobs.backtest(spark, src, tables, AS_OF, plan_value=plan_value / 3).first() != acc
    inputs = jobs.monthly_inputs(spark, src, tables, AS_OF, "2000-12-03", "2001-01-01")
    assert inputs["published_demand"].count() > 0
    assert inputs["monthly_actuals"].count() > 0


def test_command_line_over_catalog_tables(spark, capsys):
    import json

    from sparecast.plans import cli

    for name, df in (("cli_billing", td.billing(spark, SF_SMALL)), ("cli_dispatch", td.dispatch(spark, SF_SMALL)),
                     ("cli_master", td.parts_master(spark, SF_SMALL)), ("cli_plan", td.plan(spark, SF_SMALL))):
        sinks.write_table(df, name)
    sinks.drop_table(spark, "cli_published")
    common = ["--as-of", AS_OF, "--segments", "2W,3W", "--billing", "cli_billing", "--dispatch", "cli_dispatch",
              "--master", "cli_master", "--plan", "cli_plan", "--exclude-text", td.EXCLUDED_TEST_TEXT,
              "--prefix", "cli", "--published", "cli_published", "--backup", "cli_published_backup"]
    assert cli.main(["month", *common]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["after"] == report["inserted"] == registry()["publish_layout_all"](spark, SF_SMALL).count()
    assert cli.main(["month", *common, "--mode", "replace_run"]) == 0      # idempotent rerun
    assert spark.table("cli_published").count() == report["after"]
    assert cli.main(["backtest", *common]) == 0
    accuracy = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(accuracy) == {"2W", "3W"} and all(a["parts"] > 0 for a in accuracy.values())
    assert cli.main(["monthly_inputs", *common, "--run-date", "2000-12-03", "--order-date", "2001-01-01"]) == 0
    written = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert spark.table(written["published_demand"]).count() > 0
    segments = {r.industry for r in spark.table(written["monthly_actuals"]).select("industry").distinct().collect()}
    assert segments == {"2W", "3W"}
