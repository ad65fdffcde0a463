"""Time the headline jobs and print one JSON line.

Every job runs twice over the whole tables and its second, warm run is reported. Results
go to a sink that computes all columns of all rows and keeps none, except for the jobs
that write tables.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from headway import schemas as S
from headway.functions import feature_columns
from headway.operators import analytics, backtest, gold, live, ops, quality, silver
from headway.plans import queries
from headway.plans.warehouse import MIN_CELL, Warehouse
from headway.session import build_session, scratch_path, stage
from headway.sinks.tables import write_partitions

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def jobs(w: Warehouse) -> dict[str, Callable[[], None]]:
    spark = w.spark
    feed = silver.valid_updates(w.trip_updates())
    silver_table, gold_table = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    last_day = w.silver().agg({"service_date": "max"}).first()[0]

    with_leads = stage(silver.build_silver(w.trip_updates(), **w.dims(), leads=True), "leads")

    def registered(name: str) -> Callable[[], None]:
        return lambda: consume(queries.queries()[name](spark, SF_DIR))

    def gold_day() -> DataFrame:
        return gold.build_features(w.silver(), last_day, w.weather(), min_count=MIN_CELL)

    def both_feeds() -> DataFrame:
        return w.trip_updates().unionByName(w.vehicle_positions(), allowMissingColumns=True)

    daily_cost = lambda: ops.cost_daily(w.cost_items())
    return {
        "silver_collapse": lambda: consume(silver.collapse(feed)),
        "silver_build": lambda: consume(w.fresh_silver()),
        "silver_upsert_rerun": lambda: silver.upsert_silver(spark, silver_table, with_leads),
        "dq_rules_all_days": lambda: consume(quality.dq_rules(w.silver(), by=["service_date"])),
        "gold_priors_one_day": lambda: consume(
            gold.historical_priors(w.silver(), last_day, min_count=MIN_CELL)),
        "gold_one_day": lambda: write_partitions(gold_day(), gold_table, ["service_date"]),
        "gold_all_days": lambda: consume(w.fresh_gold()),
        "feature_vectors": lambda: consume(feature_columns(w.gold(), S.SILVER_KEY)),
        "baselines": lambda: consume(analytics.silver_baselines(w.silver())),
        "hour_profile": lambda: consume(analytics.hour_profile(w.silver())),
        "backtest_daily": lambda: consume(
            backtest.backtest(w.predictions(), w.silver(), by=["service_date"])),
        "live_stop_state": lambda: consume(live.stop_state(w.trip_updates())),
        "live_route_state": lambda: consume(live.route_state_batch(both_feeds())),
        "hourly_landing": lambda: consume(quality.hourly_landing(w.trip_updates())),
        **{name: registered(name) for name in (
            "gold_route_strict", "feature_mismatches", "evaluation_report", "stream_landing",
            "stream_silver", "stream_stop_state",
        )},
        "cost_verdict": lambda: consume(ops.cost_verdict(ops.cost_run_rate(daily_cost()))),
    }


def main() -> None:
    spark = build_session(
        "headway-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name, job in jobs(Warehouse(spark, SF_DIR)).items():
        job()
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
