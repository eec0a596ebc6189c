import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockpulse.functions.columns import bias, wape
from stockpulse.operators import forecast as fc
from stockpulse.operators import risk as rk
from stockpulse.params import Params


def test_wape_bias_zero_actuals(spark):
    df = spark.createDataFrame([(0.0, 2.0), (0.0, 4.0)], "a double, f double")
    r = df.agg(wape("a", "f").alias("w"), bias("a", "f").alias("b")).first()
    assert r["w"] == 3.0 and r["b"] == 0.0


def _weeks(spark, histories):
    last = dt.date(2024, 6, 3)
    rows = [(sku, last - dt.timedelta(weeks=len(h) - 1 - i), float(v)) for sku, h in histories.items() for i, v in enumerate(h)]
    return fc.prepare(spark.createDataFrame(rows, "sku_id string, week_start date, units_sold double"))


def test_rollout_of_a_three_week_history(spark):
    # by hand: 3, 6, 12 -> mean 7; then 6, 12, 7 with 3 -> mean 7; then 6, 12, 7, 7 -> mean 8
    got = fc.future_frame(_weeks(spark, {"a": [3, 6, 12]}), 3).orderBy("horizon_week").collect()
    assert [r["rolling_4_mean"] for r in got] == [7.0, 7.0, 8.0]
    assert [(r["lag_1"], r["lag_2"]) for r in got] == [(12.0, 6.0), (7.0, 12.0), (7.0, 7.0)]
    assert [r["lag_4"] for r in got] == [7.0, 3.0, 6.0]           # the mean of three, then the fourth from the end
    assert [r["lag_52"] for r in got] == [7.0, 3.0, 6.0]          # no such week: lag 4
    assert abs(got[0]["rolling_13_std"] - 14 ** 0.5) < 1e-12      # deviations -4, -1, 5 around 7


def test_rollout_of_a_sixty_week_history(spark):
    # week i sold i: 60 is the last, 9 stands 52 weeks before the first forecast week
    got = fc.future_frame(_weeks(spark, {"a": range(1, 61)}), 2).orderBy("horizon_week").collect()
    assert [r["lag_52"] for r in got] == [9.0, 10.0]
    assert [r["lag_13"] for r in got] == [48.0, 49.0] and [r["lag_26"] for r in got] == [35.0, 36.0]
    assert [r["rolling_4_mean"] for r in got] == [58.5, 58.875]   # 57..60; then 58, 59, 60 and 58.5
    assert [r["lag_1"] for r in got] == [60.0, 58.5]


def test_rollout_follows_the_lags_asked_for(spark):
    weeks = _weeks(spark, {"long": range(1, 121), "short": range(1, 11)})
    got = {(r["sku_id"], r["horizon_week"]): r for r in fc.future_frame(weeks, 3, (1, 4, 5, 104)).collect()}
    assert [got["long", h]["lag_104"] for h in (1, 2, 3)] == [17.0, 18.0, 19.0]
    assert [got["long", h]["lag_5"] for h in (1, 2, 3)] == [116.0, 117.0, 118.0]
    assert got["short", 1]["lag_104"] == got["short", 1]["lag_4"] == 7.0   # the history is shorter than the lag


def test_seasonal_lag_must_be_rolled_out(spark):
    with pytest.raises(ValueError, match="104"):
        fc.baseline_run(_weeks(spark, {"a": [1, 2, 3]}), Params(seasonal_lag_weeks=104))


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    n = 60
    x1, x2 = rng.normal(size=n), rng.normal(size=n) * 3
    cat = np.where(rng.random(n) < 0.5, "a", "b").astype("<U8")
    cat[:3] = "rare"
    y = 2 + 1.5 * x1 - 0.5 * x2 + (cat == "a") * 1.0 + rng.normal(size=n) * 0.1
    df = spark.createDataFrame([(float(a), float(b), str(c), float(t)) for a, b, c, t in zip(x1, x2, cat, y)],
                               "x1 double, x2 double, c string, units_sold double")
    m = fc.RidgeModel(["x1", "x2"], ["c"], alpha=2.5, min_frequency=5).fit(df)
    b0, coef = m.coefficients()
    # closed form: population-scaled numerics, one-hot (alphabetical: a, b, infrequent), centred ridge
    z = np.column_stack([(x1 - x1.mean()) / x1.std(), (x2 - x2.mean()) / x2.std(),
                         (cat == "a"), (cat == "b"), (cat == "rare")]).astype(float)
    zc, yc = z - z.mean(0), y - y.mean()
    w = np.linalg.solve(zc.T @ zc + 2.5 * np.eye(z.shape[1]), zc.T @ yc)
    order = m.labels("c")
    idx = {"a": 2, "b": 3, "__infrequent__": 4}
    expect = [w[0], w[1]] + [w[idx[label]] for label in order]
    # the indexer's own "unknown" slot is an all-zero training column: ridge gives it exactly 0,
    # so unseen categories contribute nothing, as an all-zero one-hot would
    assert len(coef) in (len(expect), len(expect) + 1)
    assert np.allclose(coef[:len(expect)], expect, atol=1e-6)
    assert all(abs(c) < 1e-9 for c in coef[len(expect):])
    assert abs(b0 - (y.mean() - z.mean(0) @ w)) < 1e-6
    # unseen category -> all-zero one-hot, prediction = intercept + numeric part
    new = spark.createDataFrame([(0.0, 0.0, "zzz", 0.0)], df.schema)
    p = m.predict(new).first()["prediction"]
    assert abs(p - max(b0 + (0 - x1.mean()) / x1.std() * w[0] + (0 - x2.mean()) / x2.std() * w[1], 0)) < 1e-6


def _fc_rows(spark, cases, horizon=8):
    rows = []
    for sku, fc_units, on_hand, on_order, lt, rp in cases:
        for h in range(1, horizon + 1):
            rows.append((sku, sku, "Cat", "Sub", h, float(fc_units), float(on_hand), float(on_order), float(lt),
                         float(rp), 0.0, 0.0, 100.0, 60.0))
    return spark.createDataFrame(rows, "sku_id string, sku_name string, category string, subcategory string, "
                                       "horizon_week int, forecast_units double, on_hand_units double, "
                                       "on_order_units double, lead_time_days double, reorder_point double, "
                                       "damaged_units double, reserved_units double, list_price double, "
                                       "unit_cost double")


def test_risk_actions_and_clamps(spark):
    cases = [("reorder", 20, 0, 0, 14, 10),      # big demand, nothing on hand
             ("markdown", 1, 500, 0, 7, 1),       # tiny demand, big stock
             ("healthy", 10, 60, 10, 7, 5),
             ("lt0", 5, 10, 0, 0, 1),             # lead time 0 -> 1 week
             ("lt60", 5, 10, 0, 60, 1)]           # 60 days -> clamped to the 8-week horizon
    r = {x["sku_id"]: x for x in rk.score_risk(_fc_rows(spark, cases), Params()).collect()}
    assert r["reorder"]["recommended_action"] == "Reorder now"
    assert r["markdown"]["recommended_action"] == "Markdown / clear"
    assert r["healthy"]["recommended_action"] == "Healthy"
    assert r["lt0"]["forecast_leadtime_units"] == 5.0
    assert r["lt60"]["forecast_leadtime_units"] == 40.0
    for x in r.values():
        for k in ("stockout_risk", "overstock_risk", "volatility_risk"):
            assert 0.0 <= x[k] <= 1.0
        if x["stockout_risk"] == 0:
            assert x["recommended_order_qty"] == 0
    # both signals at once -> watch
    watch = rk.score_risk(_fc_rows(spark, [("w", 2, 200, 0, 56, 400)]), Params()).first()
    assert watch["recommended_action"] == "Watch / volatile"


def test_volatility_null_with_one_horizon_week(spark):
    r = rk.score_risk(_fc_rows(spark, [("one", 5, 10, 0, 7, 1)], horizon=1), Params()).first()
    assert r["volatility_risk"] is None


def test_baseline_interval_order(spark):
    df = spark.createDataFrame([(1.0, 0.5)], "lag_52 double, rolling_4_mean double")
    out = fc.forecast_table(
        df.withColumns({"lag_4": F.lit(1.0), "horizon_week": F.lit(1), **{c: F.lit(None).cast("string")
                        for c in ("sku_id", "sku_name", "category", "subcategory", "lifecycle_stage")},
                        "week_start": F.lit(None).cast("date"),
                        **{c: F.lit(0.0) for c in ("avg_unit_price", "unit_cost", "list_price", "on_hand_units",
                                                   "on_order_units", "lead_time_days", "reorder_point",
                                                   "damaged_units", "reserved_units")}}),
        fc.baseline_forecast(), F.lit(2.0)).first()
    assert out["forecast_lower_80"] <= out["forecast_units"] <= out["forecast_upper_80"]
    assert out["forecast_lower_80"] == 0.0


def test_strict_thresholds_reach_all_four_actions(spark):
    from conftest import SF0001
    from stockpulse.plans.catalogue import run
    from stockpulse.plans.q_checks import STRICT

    assert STRICT.stockout_threshold < 0.55
    for sf in (SF0001, SF0001.replace("0.001", "0.01")):
        got = {r[0] for r in run("risk_scores_strict", spark, sf).select("recommended_action").distinct().collect()}
        assert got == {rk.ACTION_REORDER, rk.ACTION_MARKDOWN, rk.ACTION_WATCH, rk.ACTION_HEALTHY}
