"""Driver tables -> the four logical retail extracts.

The driver ships a TPC-H-like star schema.  These adapters express the
retail extracts (sales, SKU master, calendar, inventory snapshots) as lazy
joins and projections over it, so every downstream stage grows with the
input tables.  Money is computed in integer cents so that every engine
rounds it identically.

No join here is hinted: AQE broadcasts a side only after measuring it
against ``spark.sql.autoBroadcastJoinThreshold``.  The join by order is dealt
to a number of tasks that follows the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values for the synthetic retail view of the driver tables.
SNAPSHOT_START = "1995-01-02"
SNAPSHOT_EVERY_DAYS = 4
LAUNCH_DATE = "1995-01-01"
PROMO_EVERY_MONTHS = 5   # months whose number this divides hold a promotion
ZONES = "ABCD"
LINES_PER_TASK = 500_000   # lines that one task joins with their orders and rids of duplicates


def read_tables(spark: SparkSession, sf_dir: str, names=("region", "nation", "customer", "part",
                                                        "orders", "lineitem")) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def sku_id_col(grain: str):
    if grain == "part":
        return F.col("p_partkey").cast("string")
    return F.concat_ws("|", F.col("p_brand"), F.col("p_type"))


def _sales_base(t: dict[str, DataFrame], grain: str) -> DataFrame:
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                              "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    part = t["part"].select("p_partkey", sku_id_col(grain).alias("sku_id"))
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority")
    cust = t["customer"].select("c_custkey", "c_nationkey")
    nation = t["nation"].select("n_nationkey", "n_regionkey")
    region = t["region"].select("r_regionkey", "r_name")
    # Join order is explicit (no cost-based reordering without statistics):
    # orders get their customer region first, an orders-sized join, so the
    # lineitem-sized rows are shuffled only for their own two join keys
    # (part, order) and never again by customer.
    geo = cust.join(nation, cust.c_nationkey == nation.n_nationkey).join(
        region, F.col("n_regionkey") == F.col("r_regionkey"))
    order_geo = orders.join(geo, orders.o_custkey == geo.c_custkey).select("o_orderkey", "o_custkey",
                                                                         "o_orderpriority", "r_name")
    lines = li.join(part, li.l_partkey == part.p_partkey)
    # The order-key partitioning also serves the duplicate removal and the
    # first aggregates, so a task holds several copies of its lines.  Few lines
    # are left to AQE (a task for each core); more get tasks by their number,
    # where AQE would coalesce partitions to a size of compressed bytes.
    tasks = order_tasks(t["lineitem"])
    if tasks > li.sparkSession.sparkContext.defaultParallelism:
        lines, order_geo = lines.repartition(tasks, "l_orderkey"), order_geo.repartition(tasks, "o_orderkey")
    return lines.join(order_geo, F.col("l_orderkey") == F.col("o_orderkey"))


def order_tasks(lineitem: DataFrame) -> int:
    """Tasks of the join by order at ``LINES_PER_TASK`` lines each (counting reads no more than Parquet footers)."""
    return -(-lineitem.count() // LINES_PER_TASK)


def _revenue_cents_expr():
    # extended price in cents x (100 - discount in percent) = 1e-4 units; round half up to cents.
    return F.expr(
        "cast((cast(round(l_extendedprice * 100) as bigint)"
        " * (100 - cast(round(l_discount * 100) as bigint)) * 2 + 100) div 200 as double) / 100")


def sales_daily(t: dict[str, DataFrame], grain: str = "brand_type") -> DataFrame:
    b = _sales_base(t, grain)
    return b.select(
        F.to_date("l_shipdate").alias("date"),
        "sku_id",
        F.col("l_quantity").alias("units_sold"),
        _revenue_cents_expr().alias("revenue"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_discount") >= 0.05).alias("promo_flag"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("sales_channel"),
        F.col("r_name").alias("region"),
        F.col("l_discount").alias("discount_pct"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0)).alias("return_units"),
        (F.col("l_linestatus") == "O").alias("stockout_flag"),
    )


def dirty_sales_daily(t: dict[str, DataFrame], grain: str = "brand_type") -> DataFrame:
    """Sales with injected dirt, as raw text columns.

    1 % of the lines appear twice, some dates do not parse, some units are
    negative and some prices are zero (the rules are in FIXTURES.md).  The
    repeated lines come from a generator in the same pass (no second join).
    """
    b = _sales_base(t, grain)
    k = F.col("l_orderkey")
    copies = F.when(k % 100 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return b.select(
        F.when(k % 97 == 0, F.lit("unknown")).otherwise(F.to_date("l_shipdate").cast("string")).alias("date"),
        "sku_id",
        F.when(k % 89 == 0, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("string").alias("units_sold"),
        _revenue_cents_expr().alias("revenue"),
        F.when(k % 83 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_discount") >= 0.05).alias("promo_flag"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("sales_channel"),
        F.col("r_name").alias("region"),
        F.col("l_discount").alias("discount_pct"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0)).alias("return_units"),
        (F.col("l_linestatus") == "O").alias("stockout_flag"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def sku_keys(t: dict[str, DataFrame], grain: str = "brand_type") -> DataFrame:
    """One row per SKU with ``sku_no``, a unique integer helper."""
    return t["part"].groupBy(sku_id_col(grain).alias("sku_id")).agg(F.min("p_partkey").alias("sku_no"))


def sku_master(t: dict[str, DataFrame], grain: str = "brand_type", keep_sku_no: bool = False) -> DataFrame:
    p = t["part"]
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    # brand and type are constant within a SKU of either grain, so they can be keys
    g = p.groupBy(sku_id_col(grain).alias("sku_id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("ptype")).agg(
        F.sum(cents).alias("_cents"),
        F.count(F.lit(1)).alias("_n"),
        F.min("p_partkey").alias("sku_no"),
    )
    out = g.select(
        "sku_id",
        F.concat_ws(" ", "brand", "ptype").alias("sku_name"),
        F.col("ptype").alias("category"),
        F.col("brand").alias("subcategory"),
        F.col("brand").alias("brand"),
        F.lit(LAUNCH_DATE).cast("date").alias("launch_date"),
        # half-up rounding of 0.6 x mean and of the mean, in integer cents
        F.expr("cast((_cents * 12 + _n * 10) div (_n * 20) as double) / 100").alias("unit_cost"),
        F.expr("cast((_cents * 2 + _n) div (_n * 2) as double) / 100").alias("list_price"),
        "sku_no",
    )
    return out if keep_sku_no else out.drop("sku_no")


def dirty_sku_master(t: dict[str, DataFrame], grain: str = "brand_type") -> DataFrame:
    """SKU master as text with a later, broken second row for every 7th SKU.

    The later row must win the keyed deduplication; its cost is missing and
    its list price does not parse, so both are imputed with global medians.
    ``_ord`` carries the file order.
    """
    m = sku_master(t, grain, keep_sku_no=True)
    base = m.select("sku_id", "sku_name", "category", "subcategory", "brand",
                    F.col("launch_date").cast("string").alias("launch_date"),
                    F.col("unit_cost").cast("string").alias("unit_cost"),
                    F.col("list_price").cast("string").alias("list_price"),
                    F.col("sku_no").alias("_ord"))
    later = (m.where(F.col("sku_no") % 7 == 0)
              .select("sku_id", "sku_name", "category", "subcategory", "brand",
                      F.col("launch_date").cast("string").alias("launch_date"),
                      F.lit(None).cast("string").alias("unit_cost"),
                      F.lit("n/a").alias("list_price"),
                      (F.col("sku_no") + F.lit(10_000_000_000)).alias("_ord")))
    return base.unionByName(later)


def date_bounds(sales: DataFrame):
    """(first, last) sale date as one scalar subquery read twice."""
    b = sales.select(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    return b["lo"], b["hi"]


def calendar(sales: DataFrame | None = None, bounds=None, spark: SparkSession | None = None) -> DataFrame:
    """One row per day between the first and last sale.

    ``campaign_intensity`` and ``is_weekend`` are left out on purpose so the
    cleaning stage derives them.  ``bounds`` may be given as two scalar
    columns instead of scanning ``sales``.
    """
    lo, hi = bounds if bounds is not None else date_bounds(sales)
    spark = spark or sales.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(lo, hi)).alias("date"))
    m = F.month("date")
    season = F.concat(F.lit("Q"), F.quarter("date").cast("string"))
    promo = F.when(m % PROMO_EVERY_MONTHS == 0, F.concat(F.lit("Promotion "), m.cast("string"))).otherwise(F.lit("None"))
    holiday = (m % 3 == 1) & (F.dayofmonth("date") == 1)   # the first day of each quarter
    return days.select(
        "date",
        F.weekofyear("date").alias("week"),
        m.alias("month"),
        season.alias("season"),
        holiday.alias("is_holiday"),
        promo.alias("promo_event"),
    )


def inventory_snapshots(t: dict[str, DataFrame], sales: DataFrame | None = None, grain: str = "brand_type",
                        last_date=None) -> DataFrame:
    """Synthetic snapshots: every 4th day per SKU with gaps; every 11th SKU has none."""
    hi = last_date if last_date is not None else date_bounds(sales)[1]
    start = F.lit(SNAPSHOT_START).cast("date")
    keys = sku_keys(t, grain).where(F.col("sku_no") % 11 != 0)
    snaps = keys.select(
        "sku_id", "sku_no",
        F.explode(F.sequence(F.lit(0), F.datediff(hi, start), F.lit(SNAPSHOT_EVERY_DAYS))).alias("day_no"))
    s, d = F.col("sku_no"), F.col("day_no")
    return (snaps.where((s + d) % 5 != 0)
                 .select(
                     F.date_add(start, d).alias("date"),
                     "sku_id",
                     (F.lit(20) + (s * 7 + d * 13) % 180).cast("double").alias("on_hand_units"),
                     ((s * 3 + d * 5) % 60).cast("double").alias("on_order_units"),
                     (F.lit(7) + s % 22).cast("double").alias("lead_time_days"),
                     (F.lit(15) + s % 50).cast("double").alias("reorder_point"),
                     (s % 3).cast("double").alias("damaged_units"),
                     (s % 5).cast("double").alias("reserved_units"),
                     F.substring(F.lit(ZONES), (s % 4 + 1).cast("int"), 1).alias("warehouse_zone"),
                     (s * 10_000 + d).alias("_ord"),
                 ))


def dirty_inventory_snapshots(t: dict[str, DataFrame], sales: DataFrame | None = None, grain: str = "brand_type",
                              last_date=None) -> DataFrame:
    """Snapshots as text with a later duplicate for every 7th (sku, day).

    The duplicate holds a negative on-hand count, an unparsable on-order
    value and a zero lead time; it must win the keep-last deduplication.
    """
    inv = inventory_snapshots(t, sales, grain, last_date)
    text = [F.col(c).cast("string").alias(c) for c in
            ("date", "sku_id", "on_hand_units", "on_order_units", "lead_time_days", "reorder_point",
             "damaged_units", "reserved_units", "warehouse_zone")]
    base = inv.select(*text, "_ord")
    dup = (inv.where(F.col("_ord") % 7 == 0)
              .select(F.col("date").cast("string").alias("date"), "sku_id",
                      (-F.col("on_hand_units")).cast("string").alias("on_hand_units"),
                      F.lit("x").alias("on_order_units"),
                      F.lit("0").alias("lead_time_days"),
                      F.col("reorder_point").cast("string").alias("reorder_point"),
                      F.col("damaged_units").cast("string").alias("damaged_units"),
                      F.col("reserved_units").cast("string").alias("reserved_units"),
                      "warehouse_zone",
                      (F.col("_ord") + F.lit(10_000_000_000)).alias("_ord")))
    return base.unionByName(dup)
