from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from headway.operators import analytics as A
from headway.operators import ops as O

D = lambda n: date(2024, 1, n)


def test_degradation_needs_two_days_and_unknown_stays_unknown(spark):
    rows = [(D(1), 1.2), (D(2), 1.1), (D(3), 0.9), (D(4), 1.3), (D(6), 1.4), (D(7), None), (D(8), 1.5)]
    df = spark.createDataFrame(rows, "service_date date, mae_ratio_vs_persistence double")
    got = {r["day"].day: r["status"] for r in O.degraded(df).collect()}
    assert got == {1: "unknown", 2: "degraded", 3: "ok", 4: "ok", 6: "unknown", 7: "unknown", 8: "unknown"}


def test_empty_windows_are_stalled(spark):
    base = int(datetime(2024, 1, 1, tzinfo=UTC).timestamp())
    df = spark.createDataFrame([(base + 10,)] * 5 + [(base + 1900,)], "ingest_ts bigint")
    got = O.ingest_windows(df, datetime(2024, 1, 1, 0, 5, tzinfo=UTC),
                           datetime(2024, 1, 1, 1, 0, tzinfo=UTC), min_rows=2)
    rows = [(r["window_start"] - base, r["rows"], r["stalled"]) for r in got.orderBy("window_start").collect()]
    assert rows == [(0, 5, False), (900, 0, True), (1800, 1, True), (2700, 0, True)]


def items(spark, totals):
    rows = [(D(i + 1), "svc", "Usage", None, float(t)) for i, t in enumerate(totals)]
    return spark.createDataFrame(rows, "day date, service string, record_type string, project string, amount double")


def verdict(spark, totals):
    rate = O.cost_run_rate(O.cost_daily(items(spark, totals)))
    return O.cost_verdict(rate).orderBy(F.col("day").desc()).first()


def test_cost_verdicts(spark):
    assert verdict(spark, [1, 1, 1])["daily_status"] == "ok"
    now = verdict(spark, [1, 1, 2])
    assert (now["daily_status"], now["breached"]) == ("breached", True)
    past = verdict(spark, [1, 9, 1])
    assert (past["daily_status"], past["breached"], past["one_day_dominates"]) == ("resolved", False, True)
    stale = verdict(spark, [9, 9, 1])
    assert (stale["month_status"], stale["breached"]) == ("stale_window", False)
    trend = verdict(spark, [1.48, 1.48, 1.48])
    assert (trend["daily_status"], trend["month_status"], trend["breached"]) == ("ok", "breached", True)


def test_cost_ignores_credits_small_lines_today_and_other_projects(spark):
    rows = [(D(1), "a", "Usage", "p", 1.0), (D(1), "a", "Credit", "p", -1.0), (D(1), "b", "Usage", None, 0.004),
            (D(2), "a", "Usage", None, 2.0), (D(3), "a", "Usage", "p", 5.0)]
    df = spark.createDataFrame(rows, "day date, service string, record_type string, project string, amount double")
    assert sorted(map(tuple, O.cost_daily(df, as_of=D(3), days=2).collect())) == [
        (D(1), "a", 1.0), (D(2), "a", 2.0)]
    assert O.cost_daily(df, project="p").count() == 2
    assert [tuple(r) for r in O.credits(df).collect()] == [(D(1), 1.0)]


def test_services_absent_on_one_side_move_from_or_to_zero(spark):
    daily = spark.createDataFrame(
        [(D(1), "gone", 1.0), (D(1), "same", 2.0), (D(2), "same", 2.1), (D(2), "new", 3.0), (D(4), "x", 1.0)],
        "day date, service string, amount double")
    got = {(r["day"].day, r["service"]): (r["before"], r["now"], r["moved"]) for r in O.cost_delta(daily).collect()}
    assert got == {(2, "gone"): (1.0, 0.0, True), (2, "same"): (2.0, 2.1, False), (2, "new"): (0.0, 3.0, True)}


def test_absent_points_are_not_zeros(spark):
    df = spark.createDataFrame([(D(1), "m", None), (D(2), "m", 3.0), (D(9), "m", 8.0)], "day date, metric string, value double")
    row = O.metric_summary(df, D(1), D(3)).first()
    assert (row["points"], row["total"], row["lowest"]) == (1, 3.0, 3.0)


def test_missing_runs(spark):
    runs = spark.createDataFrame([(D(1), "SUCCEEDED"), (D(3), "FAILED")], "day date, status string")
    runs = runs.withColumns({"started": F.lit(None).cast("timestamp"), "ended": F.lit(None).cast("timestamp")})
    assert [r["day"] for r in O.missing_runs(runs, D(1), D(4)).orderBy("day").collect()] == [D(2), D(4)]
    got = {r["day"].day: r["verdict"] for r in O.run_status(runs, D(1), D(4)).collect()}
    assert got == {1: "ok", 2: "missing", 3: "failed", 4: "missing"}


def test_buckets_add_up_to_the_labelled_rows(spark):
    df = spark.range(-2000, 2000).select(
        F.when(F.col("id") % 7 != 0, F.col("id").cast("int")).alias("observed_delay_sec"))
    shares = A.distribution_share(df).collect()
    assert sum(r["n"] for r in shares) == df.where("observed_delay_sec IS NOT NULL").count()
    assert abs(sum(r["pct"] for r in shares) - 100) < 1e-9
    assert abs(shares[0]["early_pct"] + shares[0]["late_pct"] + shares[2]["pct"] - 100) < 1e-9
