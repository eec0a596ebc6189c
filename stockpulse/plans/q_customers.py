"""Customer RFM queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpulse.operators import customers
from stockpulse.plans.catalogue import register

CTES = [
    ("rfm0", """
  SELECT customer_id, MAX(date) AS last_purchase, COUNT(DISTINCT order_id) AS frequency, CAST(SUM(CAST(ROUND(revenue * 100) AS BIGINT)) AS DOUBLE) / 100 AS monetary,
         SUM(units_sold) AS units, AVG(discount_pct) AS avg_discount, SUM(return_units) AS return_units,
         CAST((SELECT MAX(date) FROM sales1) + 1 - MAX(date) AS INTEGER) AS recency_days
  FROM sales1
  WHERE customer_id IS NOT NULL AND (SELECT COUNT(DISTINCT customer_id) FROM sales1) > 1
  GROUP BY customer_id"""),
    ("rfm1", """
  SELECT *, COUNT(*) OVER () AS _n,
         row_number() OVER (ORDER BY recency_days, customer_id) AS _rr,
         row_number() OVER (ORDER BY frequency, customer_id) AS _rf,
         row_number() OVER (ORDER BY monetary, customer_id) AS _rm
  FROM rfm0"""),
    ("rfm2", """
  SELECT * EXCLUDE (_n, _rr, _rf, _rm),
         CAST(6 - GREATEST(1, ((_rr - 1) * 5 + _n - 2) // (_n - 1)) AS INTEGER) AS r_score,
         CAST(GREATEST(1, ((_rf - 1) * 5 + _n - 2) // (_n - 1)) AS INTEGER) AS f_score,
         CAST(GREATEST(1, ((_rm - 1) * 5 + _n - 2) // (_n - 1)) AS INTEGER) AS m_score
  FROM rfm1"""),
    ("rfm3", """
  SELECT *, CAST(r_score * 100 + f_score * 10 + m_score AS INTEGER) AS rfm_score,
         CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
              WHEN r_score >= 3 AND f_score >= 4 THEN 'Loyal Customers'
              WHEN r_score >= 4 AND f_score <= 3 THEN 'Potential Loyalists'
              WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
              WHEN r_score <= 2 AND f_score <= 2 THEN 'Hibernating'
              ELSE 'Need Attention' END AS segment,
         return_units / (units + return_units + 1) AS return_rate
  FROM rfm2"""),
    ("cust", """
  SELECT customer_id, recency_days, frequency, monetary, units, rfm_score, segment,
         LEAST(GREATEST(
           0.58 * COALESCE(recency_days / NULLIF((SELECT MAX(recency_days) FROM rfm3), 0), 0)
           + 0.22 * COALESCE(1 - frequency / NULLIF((SELECT MAX(frequency) FROM rfm3), 0), 0)
           + 0.12 * COALESCE(avg_discount, 0)
           + 0.08 * COALESCE(return_rate, 0), 0), 1) AS churn_risk,
         avg_discount, return_rate
  FROM rfm3"""),
]


@register("rfm_base", covers="R1-R4", r2=["monetary"], r4=["avg_discount"], sql="""
SELECT customer_id, last_purchase, recency_days, frequency, monetary, units, avg_discount, return_units FROM rfm0""")
def rfm_base(ctx):
    """Customer aggregate: last purchase, recency, distinct orders, value, units."""
    return customers.rfm_base(ctx.sales_clean).select(
        "customer_id", "last_purchase", "recency_days", "frequency", "monetary", "units", "avg_discount",
        "return_units")


@register("rfm_scores", covers="R5-R6", sql="SELECT customer_id, r_score, f_score, m_score, rfm_score FROM rfm3")
def rfm_scores(ctx):
    """Quintile scores from exact first-come ranks (distributed), composite score."""
    base = customers.rfm_base(ctx.sales_clean)
    return customers.rfm_scores(base).select("customer_id", "r_score", "f_score", "m_score", "rfm_score")


@register("customer_segments", covers="R1-R10", r2=["monetary"], r4=["churn_risk", "avg_discount", "return_rate"],
          sql="SELECT * FROM cust")
def customer_segments(ctx):
    """Segment labels, return rate and churn risk per customer."""
    return ctx.customers


@register("segment_summary", covers="P5", r2=["revenue"], r4=["avg_churn_risk"], sql="""
SELECT segment, COUNT(DISTINCT customer_id) AS customers, SUM(monetary) AS revenue, AVG(churn_risk) AS avg_churn_risk
FROM cust GROUP BY segment ORDER BY revenue DESC""")
def segment_summary(ctx):
    """Customers, revenue and mean churn per segment."""
    return (ctx.customers.groupBy("segment")
            .agg(F.countDistinct("customer_id").alias("customers"), F.sum("monetary").alias("revenue"),
                 F.avg("churn_risk").alias("avg_churn_risk"))
            .orderBy(F.desc("revenue")))
