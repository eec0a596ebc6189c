"""Plan context: every stage of the batch run as a DataFrame.

Properties build logical plans over the driver tables in ``sf_dir``.  Three
small intermediate tables are materialized with a reliable checkpoint the
first time they are needed, because several later plans read them and the
lineage behind them is the expensive part (joins and aggregates over the
raw sales):

* the weekly sales aggregate (SKUs x weeks rows, plus per-group date
  bounds from which the calendar and snapshot date ranges are read, so the
  sales join is scanned once instead of once per bound);
* the weekly feature table (see ``features.build_weekly_features``);
* the customer segment table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.operators import clean, features
from stockpulse.params import Params
from stockpulse.session import ensure_checkpoint_dir, materialize
from stockpulse.sources import adapters


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = Params()):
        self.spark = spark
        self.sf_dir = sf_dir
        self.params = params
        ensure_checkpoint_dir(spark)

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return adapters.read_tables(self.spark, self.sf_dir)

    @cached_property
    def sales_raw(self) -> DataFrame:
        """Lazy: every view reads the columns it needs straight off the join."""
        return adapters.sales_daily(self.tables, self.params.grain)

    @cached_property
    def sales_clean(self) -> DataFrame:
        return clean.clean_sales(self.sales_raw)

    @cached_property
    def weekly_sales_bounded(self) -> DataFrame:
        """Checkpointed (sku, week) sales aggregate with ``_dmin`` / ``_dmax``."""
        return materialize(features.weekly_sales(self.sales_clean, with_date_bounds=True), "weekly-sales")

    @cached_property
    def date_bounds(self):
        ws = self.weekly_sales_bounded
        b = ws.select(F.struct(F.min("_dmin").alias("lo"), F.max("_dmax").alias("hi"))).scalar()
        return b["lo"], b["hi"]

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        t, g = self.tables, self.params.grain
        lo, hi = self.date_bounds
        return {
            "sales_daily": self.sales_raw,
            "sku_master": adapters.sku_master(t, g, keep_sku_no=True).withColumnRenamed("sku_no", "_ord"),
            "calendar": adapters.calendar(bounds=(lo, hi), spark=self.spark).withColumn("_ord", F.datediff("date", F.lit("1970-01-01"))),
            "inventory_snapshots": adapters.inventory_snapshots(t, grain=g, last_date=hi),
        }

    @cached_property
    def cleaned(self) -> dict[str, DataFrame]:
        r = self.raw
        return {
            "sales_daily": self.sales_clean,
            "sku_master": clean.clean_sku(r["sku_master"]),
            "calendar": clean.clean_calendar(r["calendar"]),
            "inventory_snapshots": clean.clean_inventory(r["inventory_snapshots"]),
        }

    @cached_property
    def weekly_sales(self) -> DataFrame:
        return self.weekly_sales_bounded.drop("_dmin", "_dmax")

    @cached_property
    def pre_fill(self) -> DataFrame:
        return features.pre_fill_features(self.cleaned, self.params, self.weekly_sales)

    @cached_property
    def weekly(self) -> DataFrame:
        return features.build_weekly_features(self.cleaned, self.params, ws=self.weekly_sales)

    @cached_property
    def customers(self) -> DataFrame:
        from stockpulse.operators.customers import customer_segments
        return materialize(customer_segments(self.sales_clean), "customers")

    # dirty variants for the cleaning checks
    @cached_property
    def dirty_sales(self) -> DataFrame:
        return adapters.dirty_sales_daily(self.tables, self.params.grain)

    @cached_property
    def dirty_sku(self) -> DataFrame:
        return adapters.dirty_sku_master(self.tables, self.params.grain)

    @cached_property
    def dirty_inventory(self) -> DataFrame:
        return adapters.dirty_inventory_snapshots(self.tables, grain=self.params.grain, last_date=self.date_bounds[1])
