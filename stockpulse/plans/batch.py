"""The end-to-end batch run: every stage output written once.

Clean -> weekly features -> customer segments -> forecast (ridge, plus the
baseline) -> risk scores -> summaries, each written as Parquet (one-row
summaries as JSON) under ``out_dir``.  Later analytic views read these
tables back with ``sources.io.read_table``.  An output folder that exists is
an error.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from stockpulse.operators import forecast as fc
from stockpulse.operators import risk as rk
from stockpulse.operators import views
from stockpulse.params import Params
from stockpulse.plans.context import Context
from stockpulse.session import materialize
from stockpulse.sources import io

OUTPUTS = ("weekly_features", "customer_segments", "backtest_predictions", "model_metrics", "sku_forecasts",
           "risk_scores")


def run_batch(spark: SparkSession, sf_dir: str, out_dir: str, params: Params = Params(),
              model: str = "ridge") -> dict[str, str]:
    ctx = Context(spark, sf_dir, params)
    paths = {name: f"{out_dir.rstrip('/')}/{name}" for name in OUTPUTS}
    io.write_table(ctx.weekly, paths["weekly_features"], partition_by=["category"])
    io.write_table(ctx.customers, paths["customer_segments"])
    run = fc.ridge_run(ctx.weekly, params) if model == "ridge" else fc.baseline_run(ctx.weekly, params)
    run["backtest"] = materialize(run["backtest"], "batch-backtest")   # the metrics and the forecast's band read it too
    io.write_table(run["backtest"], paths["backtest_predictions"])
    io.write_table(run["metrics"], paths["model_metrics"])
    io.write_table(run["forecasts"], paths["sku_forecasts"])
    forecasts = io.read_table(spark, paths["sku_forecasts"])
    io.write_table(rk.score_risk(forecasts, params), paths["risk_scores"])
    risk = io.read_table(spark, paths["risk_scores"])
    metrics = io.read_table(spark, paths["model_metrics"])
    customers = io.read_table(spark, paths["customer_segments"])
    paths["risk_summary"] = io.write_summary_json(rk.risk_summary(risk), f"{out_dir}/risk_summary")
    paths["executive_summary"] = io.write_summary_json(views.executive_summary(metrics, risk, customers),
                                                       f"{out_dir}/executive_summary")
    return paths
