"""DuckDB SQL for the adapters, the cleaning stage and the weekly features.

These CTEs are an independent formulation of the same logical tables in
plain SQL (window functions, ``generate_series``, correlated scalars); the
oracle queries select from them.  Tables ``lineitem part orders customer
nation region`` are the driver's pre-registered views.
"""

from __future__ import annotations

_INV_COLS = ["on_hand_units", "on_order_units", "lead_time_days", "reorder_point", "damaged_units",
             "reserved_units"]
_LAGS = (1, 2, 4, 8, 13, 26, 52)

_SALES_SELECT = """
  SELECT {date} AS date,
         p.p_brand || '|' || p.p_type AS sku_id,
         {units} AS units_sold,
         CAST((CAST(ROUND(l.l_extendedprice * 100) AS BIGINT)
               * (100 - CAST(ROUND(l.l_discount * 100) AS BIGINT)) * 2 + 100) // 200 AS DOUBLE) / 100 AS revenue,
         {price} AS unit_price,
         l.l_discount >= 0.05 AS promo_flag,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         l.l_orderkey AS order_id,
         o.o_orderpriority AS sales_channel,
         r.r_name AS region,
         l.l_discount AS discount_pct,
         CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0.0 END AS return_units,
         l.l_linestatus = 'O' AS stockout_flag{extra}
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey"""

SALES0 = _SALES_SELECT.format(date="CAST(l.l_shipdate AS DATE)", units="l.l_quantity",
                              price="l.l_extendedprice / l.l_quantity", extra="")

SALES0_DIRTY_ROWS = _SALES_SELECT.format(
    date="CASE WHEN l.l_orderkey % 97 = 0 THEN 'unknown' ELSE CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) END",
    units="CAST(CASE WHEN l.l_orderkey % 89 = 0 THEN -l.l_quantity ELSE l.l_quantity END AS VARCHAR)",
    price="CASE WHEN l.l_orderkey % 83 = 0 THEN 0.0 ELSE l.l_extendedprice / l.l_quantity END",
    extra=",\n         l.l_orderkey AS _k")

SKU0 = """
  SELECT p_brand || '|' || p_type AS sku_id,
         p_brand || ' ' || p_type AS sku_name,
         p_type AS category,
         p_brand AS subcategory,
         p_brand AS brand,
         DATE '1995-01-01' AS launch_date,
         CAST((SUM(CAST(ROUND(p_retailprice * 100) AS BIGINT)) * 12 + COUNT(*) * 10) // (COUNT(*) * 20) AS DOUBLE) / 100
           AS unit_cost,
         CAST((SUM(CAST(ROUND(p_retailprice * 100) AS BIGINT)) * 2 + COUNT(*)) // (COUNT(*) * 2) AS DOUBLE) / 100
           AS list_price,
         MIN(p_partkey) AS sku_no
  FROM part GROUP BY p_brand, p_type"""

CAL0 = """
  SELECT CAST(d AS DATE) AS date,
         CAST(weekofyear(d) AS INTEGER) AS week,
         CAST(month(d) AS INTEGER) AS month,
         'Q' || CAST(quarter(d) AS VARCHAR) AS season,
         month(d) % 3 = 1 AND day(d) = 1 AS is_holiday,
         CASE WHEN month(d) % 5 = 0 THEN 'Promotion ' || CAST(month(d) AS VARCHAR) ELSE 'None' END AS promo_event
  FROM (SELECT unnest(generate_series(CAST((SELECT MIN(date) FROM sales0) AS TIMESTAMP),
                                      CAST((SELECT MAX(date) FROM sales0) AS TIMESTAMP), INTERVAL 1 DAY)) AS d)"""

INV0 = """
  SELECT DATE '1995-01-02' + CAST(d AS INTEGER) AS date,
         k.sku_id,
         CAST(20 + (sku_no * 7 + d * 13) % 180 AS DOUBLE) AS on_hand_units,
         CAST((sku_no * 3 + d * 5) % 60 AS DOUBLE) AS on_order_units,
         CAST(7 + sku_no % 22 AS DOUBLE) AS lead_time_days,
         CAST(15 + sku_no % 50 AS DOUBLE) AS reorder_point,
         CAST(sku_no % 3 AS DOUBLE) AS damaged_units,
         CAST(sku_no % 5 AS DOUBLE) AS reserved_units,
         substr('ABCD', CAST(1 + sku_no % 4 AS INTEGER), 1) AS warehouse_zone,
         sku_no * 10000 + d AS _ord
  FROM (SELECT sku_id, sku_no FROM sku0 WHERE sku_no % 11 <> 0) k,
       (SELECT unnest(generate_series(0, (SELECT MAX(date) FROM sales0) - DATE '1995-01-02', 4)) AS d) dd
  WHERE (sku_no + d) % 5 <> 0"""

_TEXT_INV = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _INV_COLS)
INV0_DIRTY = f"""
  SELECT CAST(date AS VARCHAR) AS date, sku_id, {_TEXT_INV}, warehouse_zone, _ord FROM inv0
  UNION ALL
  SELECT CAST(date AS VARCHAR), sku_id, CAST(-on_hand_units AS VARCHAR), 'x', '0',
         CAST(reorder_point AS VARCHAR), CAST(damaged_units AS VARCHAR), CAST(reserved_units AS VARCHAR),
         warehouse_zone, _ord + 10000000000
  FROM inv0 WHERE _ord % 7 = 0"""

SKU0_DIRTY = """
  SELECT sku_id, sku_name, category, subcategory, brand, CAST(launch_date AS VARCHAR) AS launch_date,
         CAST(unit_cost AS VARCHAR) AS unit_cost, CAST(list_price AS VARCHAR) AS list_price, sku_no AS _ord FROM sku0
  UNION ALL
  SELECT sku_id, sku_name, category, subcategory, brand, CAST(launch_date AS VARCHAR), NULL, 'n/a',
         sku_no + 10000000000 FROM sku0 WHERE sku_no % 7 = 0"""


def clean_sales_sql(src: str) -> str:
    return f"""
  SELECT date, sku_id,
         GREATEST(COALESCE(TRY_CAST(units_sold AS DOUBLE), 0), 0) AS units_sold,
         GREATEST(COALESCE(TRY_CAST(revenue AS DOUBLE), 0), 0) AS revenue,
         NULLIF(COALESCE(TRY_CAST(unit_price AS DOUBLE), 0), 0) AS unit_price,
         promo_flag, customer_id, order_id, sales_channel, region,
         COALESCE(TRY_CAST(discount_pct AS DOUBLE), 0) AS discount_pct,
         0.0 AS ad_spend, 0.0 AS page_views,
         COALESCE(TRY_CAST(return_units AS DOUBLE), 0) AS return_units,
         stockout_flag
  FROM (SELECT DISTINCT * FROM (SELECT * REPLACE (TRY_CAST(date AS DATE) AS date) FROM {src})
        WHERE date IS NOT NULL AND sku_id IS NOT NULL)"""


def clean_sku_sql(src: str) -> str:
    return f"""
  SELECT * REPLACE (COALESCE(unit_cost, (SELECT MEDIAN(TRY_CAST(unit_cost AS DOUBLE)) FROM {src}_last)) AS unit_cost,
                    COALESCE(list_price, (SELECT MEDIAN(TRY_CAST(list_price AS DOUBLE)) FROM {src}_last))
                      AS list_price)
  FROM (SELECT sku_id, sku_name, category, subcategory, brand, TRY_CAST(launch_date AS DATE) AS launch_date,
               TRY_CAST(unit_cost AS DOUBLE) AS unit_cost, TRY_CAST(list_price AS DOUBLE) AS list_price
        FROM {src}_last)"""


def keep_last_sql(src: str, keys: str, where: str) -> str:
    return f"""
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY _ord DESC) AS _rn FROM {src} WHERE {where})
  WHERE _rn = 1"""


def clean_inventory_sql(src: str) -> str:
    cols = ",\n         ".join(
        (f"GREATEST(COALESCE(TRY_CAST({c} AS DOUBLE), 0), 1) AS {c}" if c == "lead_time_days"
         else f"GREATEST(COALESCE(TRY_CAST({c} AS DOUBLE), 0), 0) AS {c}") for c in _INV_COLS)
    return f"""
  SELECT date, sku_id,
         {cols},
         warehouse_zone
  FROM {src}_last"""


def _inv_last(src: str) -> str:
    return keep_last_sql(f"(SELECT * REPLACE (TRY_CAST(date AS DATE) AS date) FROM {src})", "date, sku_id",
                         "date IS NOT NULL AND sku_id IS NOT NULL")


CAL1 = """
  SELECT * EXCLUDE (_rn),
         CASE WHEN COALESCE(promo_event, 'None') <> 'None' THEN 2 ELSE 0 END AS campaign_intensity,
         isodow(date) >= 6 AS is_weekend
  FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY date) AS _rn FROM cal0 WHERE date IS NOT NULL)
  WHERE _rn = 1"""

WS = """
  SELECT sku_id, CAST(date_trunc('week', date) AS DATE) AS week_start,
         SUM(units_sold) AS units_sold, CAST(SUM(CAST(ROUND(revenue * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue,
         AVG(unit_price) AS avg_unit_price,
         CAST(SUM(CAST(promo_flag AS INTEGER)) AS BIGINT) AS promo_days, AVG(discount_pct) AS avg_discount,
         SUM(ad_spend) AS ad_spend, SUM(page_views) AS page_views, SUM(return_units) AS return_units,
         CAST(SUM(CAST(stockout_flag AS INTEGER)) AS BIGINT) AS stockout_days,
         COUNT(DISTINCT customer_id) AS unique_customers
  FROM sales1 GROUP BY 1, 2"""

WC = """
  SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, MAX(month) AS month, MAX(week) AS week,
         AVG(campaign_intensity) AS campaign_intensity,
         CAST(SUM(CAST(is_holiday AS INTEGER)) AS BIGINT) AS holiday_days,
         CAST(SUM(CAST(is_weekend AS INTEGER)) AS BIGINT) AS weekend_days
  FROM cal1 GROUP BY 1"""

WI = """
  SELECT sku_id, week_start, on_hand_units, on_order_units, lead_time_days, reorder_point, damaged_units,
         reserved_units, warehouse_zone
  FROM (SELECT *, CAST(date_trunc('week', date) AS DATE) AS week_start,
               row_number() OVER (PARTITION BY sku_id, CAST(date_trunc('week', date) AS DATE) ORDER BY date DESC) AS _rn
        FROM inv1)
  WHERE _rn = 1"""

SPINE = """
  SELECT s.*, CAST(w AS DATE) AS week_start
  FROM sku1 s,
       (SELECT unnest(generate_series(CAST((SELECT MIN(week_start) FROM ws) AS TIMESTAMP),
                                      CAST((SELECT MAX(week_start) FROM ws) AS TIMESTAMP), INTERVAL 7 DAY)) AS w)"""

WJ = """
  SELECT sp.*,
         COALESCE(ws.units_sold, 0) AS units_sold, COALESCE(ws.revenue, 0) AS revenue, ws.avg_unit_price,
         COALESCE(ws.promo_days, 0) AS promo_days, COALESCE(ws.avg_discount, 0) AS avg_discount,
         COALESCE(ws.ad_spend, 0) AS ad_spend, COALESCE(ws.page_views, 0) AS page_views,
         COALESCE(ws.return_units, 0) AS return_units, COALESCE(ws.stockout_days, 0) AS stockout_days,
         COALESCE(ws.unique_customers, 0) AS unique_customers,
         wc.month, wc.week, wc.campaign_intensity, wc.holiday_days, wc.weekend_days,
         wi.on_hand_units, wi.on_order_units, wi.lead_time_days, wi.reorder_point, wi.damaged_units,
         wi.reserved_units, wi.warehouse_zone
  FROM spine sp
  LEFT JOIN ws ON ws.sku_id = sp.sku_id AND ws.week_start = sp.week_start
  LEFT JOIN wc ON wc.week_start = sp.week_start
  LEFT JOIN wi ON wi.sku_id = sp.sku_id AND wi.week_start = sp.week_start"""

_W = "PARTITION BY sku_id ORDER BY week_start"


def _fill(c: str) -> str:
    return (f"COALESCE(LAST_VALUE({c} IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"FIRST_VALUE({c} IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")


WF = ("\n  SELECT * REPLACE (" + ",\n    ".join(f"{_fill(c)} AS {c}" for c in _INV_COLS)
      + f",\n    COALESCE({_fill('warehouse_zone')}, 'Unknown') AS warehouse_zone"
      + ",\n    COALESCE(avg_unit_price, list_price) AS avg_unit_price)\n  FROM wj")


def _rolling(stat: str, k: int) -> str:
    frame = f"OVER ({_W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN COUNT(units_sold) {frame} = {k} THEN {stat}(units_sold) {frame} END"


WL = ("\n  SELECT *,\n    LEAST(GREATEST(COALESCE((avg_unit_price - unit_cost) / NULLIF(avg_unit_price, 0), 0), -1), 1)"
      " AS gross_margin,\n    "
      + ",\n    ".join(f"LAG(units_sold, {k}) OVER ({_W}) AS lag_{k}" for k in _LAGS)
      + f",\n    {_rolling('AVG', 4)} AS rolling_4_mean"
      + f",\n    {_rolling('AVG', 8)} AS rolling_8_mean"
      + f",\n    {_rolling('STDDEV_SAMP', 13)} AS rolling_13_std\n  FROM wf")

WSC = """
  SELECT *,
         units_sold / (units_sold + COALESCE(on_hand_units, 0) + 1) AS sell_through_proxy,
         on_hand_units / (COALESCE(rolling_4_mean, (SELECT AVG(units_sold) FROM wl)) + 1) AS inventory_cover_weeks
  FROM wl"""

_MED_COLS = [f"lag_{k}" for k in _LAGS] + ["rolling_4_mean", "rolling_8_mean", "rolling_13_std"]
WM = ("\n  SELECT * REPLACE (" + ",\n    ".join(
    f"COALESCE({c}, MEDIAN({c}) OVER (PARTITION BY sku_id), (SELECT MEDIAN(units_sold) FROM wl)) AS {c}"
    for c in _MED_COLS) + ")\n  FROM wsc")

WEEKLY = """
  SELECT * REPLACE (CAST(COALESCE(month, month(week_start)) AS INTEGER) AS month,
                    CAST(COALESCE(week, weekofyear(week_start)) AS INTEGER) AS week,
                    COALESCE(CAST(campaign_intensity AS DOUBLE), 0) AS campaign_intensity,
                    COALESCE(CAST(holiday_days AS DOUBLE), 0) AS holiday_days,
                    COALESCE(CAST(weekend_days AS DOUBLE), 2) AS weekend_days)
  FROM wm"""

BASE_CTES: list[tuple[str, str]] = [
    ("sales0", SALES0),
    ("sales0_dirty", "\n  SELECT * EXCLUDE (_k) FROM (" + SALES0_DIRTY_ROWS + ")\n  UNION ALL\n  SELECT * EXCLUDE (_k) FROM ("
     + SALES0_DIRTY_ROWS + ") WHERE _k % 100 = 0"),
    ("sku0", SKU0),
    ("sku0_dirty", SKU0_DIRTY),
    ("cal0", CAL0),
    ("inv0", INV0),
    ("inv0_dirty", INV0_DIRTY),
    ("sales1", clean_sales_sql("sales0")),
    ("sales1_dirty", clean_sales_sql("sales0_dirty")),
    ("sku0_last", keep_last_sql("(SELECT * EXCLUDE (sku_no), sku_no AS _ord FROM sku0)", "sku_id",
                                "sku_id IS NOT NULL AND category IS NOT NULL")),
    ("sku1", clean_sku_sql("sku0")),
    ("sku0_dirty_last", keep_last_sql("sku0_dirty", "sku_id", "sku_id IS NOT NULL AND category IS NOT NULL")),
    ("sku1_dirty", clean_sku_sql("sku0_dirty")),
    ("cal1", CAL1),
    ("inv0_last", _inv_last("inv0")),
    ("inv1", clean_inventory_sql("inv0")),
    ("inv0_dirty_last", _inv_last("inv0_dirty")),
    ("inv1_dirty", clean_inventory_sql("inv0_dirty")),
    ("ws", WS),
    ("wc", WC),
    ("wi", WI),
    ("spine", SPINE),
    ("wj", WJ),
    ("wf", WF),
    ("wl", WL),
    ("wsc", WSC),
    ("wm", WM),
    ("weekly", WEEKLY),
]
