from __future__ import annotations

from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from headway import schemas as S
from headway.models import regressor as M
from headway.operators import live as L
from headway.operators.backtest import backtest, evaluation_report, metric_points
from headway.sinks.tables import write_backtest, write_predictions
from headway.sources.tables import read_predictions
from headway.streaming.streams import read_state, write_priors


@pytest.fixture(scope="module")
def rows(spark):
    """Delay is the snapshot plus a shift that depends on the hour."""
    return spark.range(400).select(
        F.col("id"),
        (F.col("id") % 24).cast("int").alias("hour_of_day"),
        ((F.col("id") * 37) % 600).cast("int").alias("delay_t_minus_15"),
        F.lit(None).cast("int").alias("hist_median_delay"),
        (((F.col("id") * 37) % 600) + F.when(F.col("id") % 24 > 12, 120).otherwise(0))
        .cast("int").alias(S.TARGET),
    )


def test_model_learns_and_keeps_inputs(spark, rows):
    model = M.train(rows, M.TrainParams(max_depth=4, eta=0.3, rounds=12))
    scored = M.predict(rows, model)
    assert scored.columns == [*rows.columns, "predicted_delay_sec"]
    assert scored.where("hist_median_delay IS NOT NULL").count() == 0
    report = evaluation_report(scored).first()
    assert report["mae"] < report["schedule_mae"]
    assert report["n_test"] == 400


def test_scoring_joins_state_and_priors(spark, rows, tmp_path):
    model = M.train(rows, M.TrainParams(max_depth=2, rounds=2))
    now = datetime(2024, 1, 6, 17, 30, tzinfo=UTC)
    requests = spark.createDataFrame([("R", "a"), ("R", "zzz")], "route_id string, stop_id string")
    stops = spark.createDataFrame([("R", "a", 60.0, "T", 3), ("R", "b", 30.0, "T", 2)],
                                  "route_id string, stop_id string, current_delay double, trip_id string, stop_sequence int")
    routes = spark.createDataFrame([("R", 12.5, 4)], "route_id string, mean_route_delay_15m double, vehicles_active_on_route bigint")
    priors = L.prior_state(spark.createDataFrame(
        [("R", "a", 1, 17, 90, 200, 9.0, 30)],
        "route_id string, stop_id string, is_weekend int, hour_of_day int, hist_median_delay int, "
        "hist_p90_delay int, hist_std_delay double, hist_n bigint"))
    assert priors.first()["sk"] == "STATS#1#17" and priors.first()["pk"] == "ROUTE#R#STOP#a"
    scored = {r["stop_id"]: r for r in M.score(
        requests, L.with_upstream_state(stops), routes, priors, model, now).collect()}
    a, unknown = scored["a"], scored["zzz"]
    assert (a["hour_of_day"], a["day_of_week"], a["is_peak"], a["minutes_since_service_start"]) == (17, 7, 1, 1050)
    assert (a["delay_t_minus_15"], a["prev_stop_delay"], a["upstream_delay_same_trip"]) == (60.0, 30.0, 30.0)
    assert (a["hist_median_delay"], a["mean_route_delay_15m"]) == (90, 12.5)
    assert unknown["delay_t_minus_15"] is None and unknown["predicted_delay_sec"] is not None
    assert a["feature_fill_rate"] > unknown["feature_fill_rate"]
    write_predictions(M.score(requests, stops, routes, priors, model, now), str(tmp_path), "m", "2024-01-06")
    back = {r["stop_id"]: r for r in read_predictions(spark, str(tmp_path), "2024-01-06").collect()}
    assert (back["a"]["trip_id"], back["a"]["service_date"]) == ("T", date(2024, 1, 6))
    assert back["a"]["delay_t_minus_15"] == 60.0
    assert back["a"]["predicted_delay_sec"] == pytest.approx(a["predicted_delay_sec"], abs=200)
    silver = spark.createDataFrame([(date(2024, 1, 6), "T", "a", 75)],
                                   "service_date date, trip_id string, stop_id string, observed_delay_sec int")
    metrics = backtest(read_predictions(spark, str(tmp_path), "2024-01-06"), silver)
    assert (metrics.first()["n"], metrics.first()["persistence_mae"]) == (1, 15.0)
    write_backtest(metrics, str(tmp_path / "metrics"), "2024-01-06")
    assert spark.read.json(str(tmp_path / "metrics")).first()["run_date"] == "2024-01-06"
    points = {r["metric"]: r["value"] for r in metric_points(metrics).collect()}
    assert points["PredictionsScored"] == 1.0 and points["PersistenceMae"] == 15.0


def test_exported_priors_carry_the_stops_geometry(spark, tmp_path):
    cell = "route_id string, stop_id string, is_weekend int, hour_of_day int, hist_median_delay int"
    silver = spark.createDataFrame(
        [(date(2024, 1, d), "T", "R", "a", d, 10 - d, 1.5, 0, 3) for d in (1, 2)] +
        [(date(2024, 1, 3), "T", None, "a", 9, 9, 9.0, 9, 9)],
        "service_date date, trip_id string, route_id string, stop_id string, last_seen_ts bigint, "
        "stops_remaining int, shape_dist_traveled double, is_terminus int, route_type int")
    geometry = L.stop_geometry(silver)
    for at, median in ((1, 50), (2, 60), (1, 70)):
        priors = spark.createDataFrame([("R", "a", 0, 8, median), (None, "a", 0, 8, 1)], cell)
        write_priors(priors, str(tmp_path), at, geometry)
    (row,) = read_state(spark, str(tmp_path), "priors").collect()
    assert (row["sk"], row["hist_median_delay"], row["stops_remaining"]) == ("STATS#0#08", 60, 8)
    requests = spark.createDataFrame([("R", "a")], "route_id string, stop_id string")
    stops = spark.createDataFrame([], "route_id string, stop_id string, trip_id string, current_delay double, stop_sequence int")
    routes = spark.createDataFrame([], "route_id string, mean_route_delay_15m double")
    seen = L.request_features(requests, stops, routes, read_state(spark, str(tmp_path), "priors"),
                              datetime(2024, 1, 3, 8, 5, tzinfo=UTC)).first()
    assert (seen["hist_median_delay"], seen["stops_remaining"], seen["route_type"]) == (60, 8, 3)
