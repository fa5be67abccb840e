"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: ``{"metric", "value", "unit", "queries", "sf", ...}``.
``value`` is the sum of the per-query wall times.  Each query is run to
completion through the no-op sink (no rows travel to the driver).  Method:
every headline query first runs once on the smallest test folder to warm the
JVM (``BENCH_WARMUP=0`` skips it), then each query runs ``BENCH_REPS`` times
(default 2) at the target scale and the best wall time is reported; all runs
include building the plan and every eager step (checkpoints, cut points).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "segment_demand_2w",
    "class_table_2w",
    "class_table_3w",
    "unit_price_part",
    "base_demand",
    "plan_forecast_2w",
    "plan_forecast_3w",
    "dealer_ratios",
    "apportioned_forecast",
    "publish_layout",
    "publish_append",
    "replace_by_key",
    "publish_append_table",
    "publish_rerun_table",
    "replace_by_key_table",
    "monthly_actuals",
    "backtest_accuracy",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warmup = os.environ.get("BENCH_WARMUP", "1") != "0"
    reps = max(1, int(os.environ.get("BENCH_REPS", "2")))
    warm_dir = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from sparecast.plans.queries import registry
    from tests.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          app="sparecast-bench",
                          extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sparecast-bench-")})
    reg = registry()

    def run(name: str, folder: str) -> float:
        t = time.perf_counter()
        reg[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    errors: dict[str, str] = {}

    def best(name: str) -> float | None:
        try:
            return round(min(run(name, sf_dir) for _ in range(reps)), 3)
        except Exception as e:  # noqa: BLE001 - report and go on with the other queries
            errors[name] = repr(e)[:300]
            return None

    if warmup and os.path.isdir(warm_dir):
        for n in names:
            try:
                run(n, warm_dir)
            except Exception:  # noqa: BLE001 - the timed run reports it
                pass
    times = {n: best(n) for n in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "method": f"best of {reps} after warm-up" if warmup else f"best of {reps}",
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
