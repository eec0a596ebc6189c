"""Dense weekly SKU feature table.

Plan shape: sales and snapshots are reduced to (sku, week) with partial
aggregation before any shuffle, so a hot SKU is split across map tasks.
The dense spine is generated per SKU row with ``explode(sequence(...))``
(no join).  All per-SKU windows (fills, lags, rolling statistics, median
fills) share one ``partitionBy("sku_id")`` clustering, so they cost one
exchange of the already-aggregated sku x week table, whose per-SKU size is
bounded by the number of weeks in the date range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockpulse.functions.columns import clip, safe_div, week_floor
from stockpulse.functions.ranking import exact_median, keep_best
from stockpulse.params import Params
from stockpulse.session import materialize as materialize_table
from stockpulse.sources.store import read_manifest, read_stored, write_stored

MAX_WEEKS = 52 * 100   # a longer range means a broken date, which would multiply the spine
# The measures that are zero in weeks without sales, the snapshot columns, the rolling statistics.
SALES_MEASURES_ZERO_FILL = ["units_sold", "revenue", "promo_days", "avg_discount", "ad_spend", "page_views",
                            "return_units", "stockout_days", "unique_customers"]
INVENTORY_COLS = ["on_hand_units", "on_order_units", "lead_time_days", "reorder_point", "damaged_units",
                  "reserved_units"]
ROLLING_COLS = ["rolling_4_mean", "rolling_8_mean", "rolling_13_std"]


def by_sku():
    return Window.partitionBy("sku_id").orderBy("week_start")


def weekly_sales(sales: DataFrame, with_date_bounds: bool = False) -> DataFrame:
    """Hash aggregate by (sku, week); flag sums count rows.

    ``with_date_bounds`` adds the first and last sale date of each group, so
    global date bounds can later be read from this (small) table.
    """
    extra = {"_dmin": (F.min, F.col("date")), "_dmax": (F.max, F.col("date"))} if with_date_bounds else {}
    cents = F.round(F.col("revenue") * 100).cast("bigint")   # whole cents
    measures = extra | {
        "units_sold": (F.sum, F.col("units_sold")), "_cents": (F.sum, cents),
        "_prices": (F.sum, F.col("unit_price").cast("double")), "_priced": (F.sum, F.col("unit_price").isNotNull().cast("int")),
        "promo_days": (F.sum, F.col("promo_flag").cast("int")),
        "_discounts": (F.sum, F.col("discount_pct").cast("double")), "_discounted": (F.sum, F.col("discount_pct").isNotNull().cast("int")),
        "ad_spend": (F.sum, F.col("ad_spend")), "page_views": (F.sum, F.col("page_views")),
        "return_units": (F.sum, F.col("return_units")), "stockout_days": (F.sum, F.col("stockout_flag").cast("int"))}
    # Customers are counted on rows of their own: the measures, which combine to a row a
    # group before the shuffle, don't travel once for every customer.
    each = sales.select("sku_id", week_floor("date").alias("week_start"), "customer_id",
                        *[c.alias(name) for name, (_, c) in measures.items()], F.explode(F.array(F.lit(False), F.lit(True))).alias("_who"))
    by_customer = each.groupBy("sku_id", "week_start", "_who", F.when(F.col("_who"), F.col("customer_id")).alias("customer_id")).agg(
        *[total(F.when(~F.col("_who"), F.col(name))).alias(name) for name, (total, _) in measures.items()])
    mean = lambda total, n: F.sum(total) / F.nullif(F.sum(n), F.lit(0))
    derived = {"_cents": (F.sum("_cents") / 100).alias("revenue"), "_prices": mean("_prices", "_priced").alias("avg_unit_price"),
               "_discounts": mean("_discounts", "_discounted").alias("avg_discount")}
    return by_customer.groupBy("sku_id", "week_start").agg(
        *[derived.get(name, total(name).alias(name)) for name, (total, _) in measures.items() if name not in ("_priced", "_discounted")],
        F.count(F.when(F.col("_who"), F.col("customer_id"))).alias("unique_customers"))


def weekly_calendar(cal: DataFrame) -> DataFrame:
    """Calendar by week."""
    return (cal.withColumn("week_start", week_floor("date"))
               .groupBy("week_start")
               .agg(F.max("month").alias("month"),
                    F.max("week").alias("week"),
                    F.avg("campaign_intensity").alias("campaign_intensity"),
                    F.sum(F.col("is_holiday").cast("int")).alias("holiday_days"),
                    F.sum(F.col("is_weekend").cast("int")).alias("weekend_days")))


def latest_snapshot(inv: DataFrame) -> DataFrame:
    """Latest snapshot per (sku, week); a cleaned SKU has one snapshot a day."""
    cols = INVENTORY_COLS + ["warehouse_zone"]
    latest = keep_best(inv.select("sku_id", week_floor("date").alias("week_start"), "date", *cols), ["sku_id", "week_start"], "date")
    return latest.select("sku_id", "week_start", *cols)


def week_bounds(ws: DataFrame):
    """(first, last) sales week as one scalar subquery read twice."""
    b = ws.select(F.struct(F.min("week_start").alias("lo"), F.max("week_start").alias("hi"))).scalar()
    return b["lo"], b["hi"]


def dense_spine(sku: DataFrame, ws: DataFrame, bounds: tuple | None = None) -> DataFrame:
    """W5-W6 (+W9): every master SKU x every week from the first to the last sales week.

    The SKU attributes ride along, which is the left join with the master
    (sku ids are unique after cleaning).  ``bounds`` (two columns) spares the
    look at the sales where the weeks are known.
    """
    lo, hi = bounds or week_bounds(ws)
    weeks = F.datediff(hi, lo) / 7
    message = F.concat(F.lit(f"the sales span more than {MAX_WEEKS} weeks: "), lo.cast("string"), F.lit(" to "), hi.cast("string"))
    last = F.when(weeks <= MAX_WEEKS, hi).otherwise(F.raise_error(message).cast("date"))
    return sku.withColumn("week_start", F.explode(F.sequence(lo, last, F.expr("INTERVAL 7 DAYS"))))


def reindexed(spine: DataFrame, ws: DataFrame) -> DataFrame:
    """Left join sales to the spine, zero-fill the additive measures."""
    return spine.join(ws, ["sku_id", "week_start"], "left").fillna(0, subset=SALES_MEASURES_ZERO_FILL)


def joined_week(cleaned: dict[str, DataFrame], ws: DataFrame | None = None) -> DataFrame:
    """Spine with sales, SKU attributes, calendar and latest snapshot.

    ``ws`` may be a precomputed (e.g. checkpointed) weekly sales aggregate.
    """
    ws = ws if ws is not None else weekly_sales(cleaned["sales_daily"])
    wc = weekly_calendar(cleaned["calendar"])
    wi = latest_snapshot(cleaned["inventory_snapshots"])
    return assemble(cleaned["sku_master"], ws, wc, wi)


def assemble(sku: DataFrame, ws: DataFrame, wc: DataFrame, wi: DataFrame, bounds: tuple | None = None) -> DataFrame:
    """W5-W11 over the weekly tables."""
    df = reindexed(dense_spine(sku, ws, bounds), ws)
    # one row per week of a checked date range (MAX_WEEKS): a bounded broadcast
    df = df.join(F.broadcast(wc), "week_start", "left")
    return df.join(wi, ["sku_id", "week_start"], "left")


# ---------------------------------------------------------------- over stored tables
def store_weekly(cleaned: dict[str, DataFrame], folder: str, buckets: int, ws: DataFrame | None = None) -> dict[str, str]:
    """The SKU master, weekly sales and latest snapshots kept by SKU, the weekly calendar beside them."""
    ws = ws if ws is not None else weekly_sales(cleaned["sales_daily"])
    tables = {"sku_master": (cleaned["sku_master"], ["sku_id"], {}),
              "weekly_sales": (ws, ["sku_id", "week_start"], {"first_week": F.min("week_start"), "last_week": F.max("week_start")}),
              "weekly_stock": (latest_snapshot(cleaned["inventory_snapshots"]), ["sku_id", "week_start"], {})}
    paths = {name: write_stored(df, f"{folder.rstrip('/')}/{name}", by_sku=buckets, sort_by=order, facts=facts) for name, (df, order, facts) in tables.items()}
    return paths | {"weekly_calendar": write_stored(weekly_calendar(cleaned["calendar"]), f"{folder.rstrip('/')}/weekly_calendar")}


def features_from_store(spark: SparkSession, paths: dict[str, str], params: Params = Params()) -> DataFrame:
    """W5-W20 over ``store_weekly``'s tables.

    Joins and windows find the rows of a SKU in its bucket; plan it inside
    ``store.in_place_joins`` to have no exchange of rows at all.
    """
    t = {name: read_stored(spark, path) for name, path in paths.items()}
    facts = read_manifest(spark, paths["weekly_sales"])["facts"]
    bounds = tuple(F.lit(facts[n]).cast("date") for n in ("first_week", "last_week"))
    df = assemble(t["sku_master"], t["weekly_sales"], t["weekly_calendar"], t["weekly_stock"], bounds)
    return with_history(df, params)


def fill_inventory(df: DataFrame, fill_scope: str = "sku") -> DataFrame:
    """Forward fill then back fill of the snapshot columns per SKU."""
    # Both fills are running frames (O(n) per SKU): the back fill is a
    # forward fill over the reversed week order.  A CURRENT ROW ..
    # UNBOUNDED FOLLOWING frame would re-aggregate the whole tail per row.
    past = by_sku().rowsBetween(Window.unboundedPreceding, 0)
    past_reversed = (Window.partitionBy("sku_id").orderBy(F.desc("week_start"))
                           .rowsBetween(Window.unboundedPreceding, 0))
    cols = INVENTORY_COLS + ["warehouse_zone"]
    df = df.withColumns({f"_bf_{c}": F.last(c, ignorenulls=True).over(past_reversed) for c in cols})
    df = df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(past), F.col(f"_bf_{c}")) for c in cols})
    df = df.drop(*[f"_bf_{c}" for c in cols])
    if fill_scope == "global":
        df = _borrow_next_sku(df, cols)
    return df.withColumn("warehouse_zone", F.coalesce("warehouse_zone", F.lit("Unknown")))


def _borrow_next_sku(df: DataFrame, cols: list[str]) -> DataFrame:
    """Literal un-grouped back fill: a SKU with no snapshot at all takes the
    first snapshot of the next SKU (in sku_id order) that has one.

    SKUs are range-partitioned by id.  Inside a partition a running scan over
    the reversed order carries the next first snapshot down; what a partition
    ends with comes from the nearest later partition that has any, a table
    with one row per partition.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    has = F.col("on_hand_units").isNotNull() | F.col("warehouse_zone").isNotNull()
    skus = (df.groupBy("sku_id").agg(F.min_by(F.when(has, F.struct(*cols)), F.when(has, F.col("week_start"))).alias("_f"))
              .repartitionByRange(n, "sku_id").withColumn("_pid", F.spark_partition_id()))
    skus = materialize_table(skus, "first-snapshots")
    later = Window.orderBy(F.desc("_pid")).rowsBetween(Window.unboundedPreceding, -1)
    carry = skus.groupBy("_pid").agg(F.min_by("_f", F.when(F.col("_f").isNotNull(), F.col("sku_id"))).alias("_p"))
    carry = carry.select("_pid", F.last("_p", ignorenulls=True).over(later).alias("_c"))  # one row per partition
    inside = Window.partitionBy("_pid").orderBy(F.desc("sku_id")).rowsBetween(Window.unboundedPreceding, 0)
    borrowed = (skus.join(F.broadcast(carry), "_pid")
                    .select("sku_id", F.coalesce(F.last("_f", ignorenulls=True).over(inside), "_c").alias("_b")))
    out = df.join(borrowed, "sku_id", "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col("_b")[c]) for c in cols})
    return out.drop("_b")


def price_margin(df: DataFrame) -> DataFrame:
    """Missing price -> list price; gross margin clipped to [-1, 1]."""
    df = df.withColumn("avg_unit_price", F.coalesce("avg_unit_price", "list_price"))
    gm = safe_div(F.col("avg_unit_price") - F.col("unit_cost"), "avg_unit_price")
    return df.withColumn("gross_margin", clip(F.coalesce(gm, F.lit(0.0)), -1.0, 1.0))


def add_lags(df: DataFrame, lags=(1, 2, 4, 8, 13, 26, 52)) -> DataFrame:
    """W18."""
    w = by_sku()
    return df.withColumns({f"lag_{k}": F.lag("units_sold", k).over(w) for k in lags})


def add_rolling(df: DataFrame) -> DataFrame:
    """Statistics of the previous k weeks, NULL unless all k exist."""
    w = by_sku()

    def guarded(agg, k):
        frame = w.rowsBetween(-k, -1)
        return F.when(F.count("units_sold").over(frame) == k, agg.over(frame))

    return df.withColumns({
        "rolling_4_mean": guarded(F.avg("units_sold"), 4),
        "rolling_8_mean": guarded(F.avg("units_sold"), 8),
        "rolling_13_std": guarded(F.stddev_samp("units_sold"), 13),
    })


def sell_through_cover(df: DataFrame, mean_units) -> DataFrame:
    """W21-W22 (cover uses the raw rolling mean, before W23 fills it)."""
    u = F.col("units_sold")
    return df.withColumns({
        "sell_through_proxy": u / (u + F.coalesce("on_hand_units", F.lit(0.0)) + 1),
        "inventory_cover_weeks": F.col("on_hand_units")
        / (F.coalesce(F.col("rolling_4_mean"), mean_units) + 1),
    })


def median_fill(df: DataFrame, cols: list[str], global_median) -> DataFrame:
    """Per-SKU median of each column, then the global median of units.

    The rows are dealt by SKU once.  One aggregate folds a SKU's columns into
    an array a week (bounded by ``MAX_WEEKS``) and reads the medians off the
    sorted columns; they meet the rows again in place, by a hash join.
    """
    dealt = df.repartition(F.col("sku_id"))
    folded = dealt.groupBy(F.col("sku_id").alias("_sku")).agg(F.collect_list(F.struct(*cols)).alias("_all"))

    def median(c: str):
        known = F.sort_array(F.filter(F.transform("_all", lambda w: w[c].cast("double")), lambda x: x.isNotNull()))
        at = lambda i: F.get(known, i.cast("int"))
        n = F.size(known)
        return F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2)

    medians = folded.select("_sku", *[median(c).alias(f"_m_{c}") for c in cols])
    met = dealt.join(medians.hint("shuffle_hash"), F.col("sku_id") == F.col("_sku"), "left")
    return met.select(*[F.coalesce(F.col(c), F.col(f"_m_{c}"), global_median).alias(c) if c in cols else F.col(c) for c in df.columns])


def calendar_fallbacks(df: DataFrame) -> DataFrame:
    """W25-W26."""
    return df.withColumns({
        "month": F.coalesce(F.col("month"), F.month("week_start")).cast("int"),
        "week": F.coalesce(F.col("week"), F.weekofyear("week_start")).cast("int"),
        "campaign_intensity": F.coalesce(F.col("campaign_intensity").cast("double"), F.lit(0.0)),
        "holiday_days": F.coalesce(F.col("holiday_days").cast("double"), F.lit(0.0)),
        "weekend_days": F.coalesce(F.col("weekend_days").cast("double"), F.lit(2.0)),
    })


def pre_fill_features(cleaned: dict[str, DataFrame], params: Params = Params(),
                      ws: DataFrame | None = None) -> DataFrame:
    """Everything up to and including the raw lags and rolling statistics."""
    return with_history(joined_week(cleaned, ws), params)


def with_history(df: DataFrame, params: Params = Params()) -> DataFrame:
    """W13-W20."""
    df = fill_inventory(df, params.fill_scope)
    df = price_margin(df)
    df = add_lags(df, params.lags)
    return add_rolling(df)


def build_weekly_features(cleaned: dict[str, DataFrame], params: Params = Params(),
                          materialize: bool = True, ws: DataFrame | None = None) -> DataFrame:
    """The full weekly feature table.

    With ``materialize`` the sku x week table is checkpointed (reliable
    checkpoint, ``spark.checkpoint.dir``) before the global statistics and
    again at the end: its size is SKUs x weeks whatever the sales volume, the
    lineage behind it (joins and aggregates over the raw tables) is not, and
    every later stage reads it several times.
    """
    df = pre_fill_features(cleaned, params, ws)
    if materialize:
        df = materialize_table(df, "weekly-pre-fill")
    # Global scalars over the dense table (mean and median of weekly units)
    # as scalar subqueries over the materialized table.
    mean_units = df.select(F.avg("units_sold")).scalar()
    median_units = exact_median(df, "units_sold")
    df = sell_through_cover(df, mean_units)
    fill_cols = [f"lag_{k}" for k in params.lags] + ROLLING_COLS
    df = calendar_fallbacks(median_fill(df, fill_cols, median_units))
    return materialize_table(df, "weekly-features") if materialize else df
