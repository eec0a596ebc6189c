"""Customer recency / frequency / monetary segmentation.

The customer aggregate is one ``groupBy("customer_id")`` with partial
aggregation (the distinct order count is planned as a (customer, order)
pre-aggregation, so a customer with a third of all orders is still split
across tasks).  Global scalars (snapshot date, maxima, customer count) are
scalar subqueries.  Quintiles come from selected edge rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.functions.columns import clip01, safe_div
from stockpulse.functions.ranking import bucket_by_edges, qcut_ranks
from stockpulse.functions.selection import select_ranks
from stockpulse.session import materialize as materialize_table

SEGMENT_COLUMNS = ["customer_id", "recency_days", "frequency", "monetary", "units", "rfm_score", "segment",
                   "churn_risk", "avg_discount", "return_rate"]

# Churn weights.
W_RECENCY, W_FREQUENCY, W_DISCOUNT, W_RETURNS = 0.58, 0.22, 0.12, 0.08


def rfm_base(sales: DataFrame, materialize: bool = True) -> DataFrame:
    """Gate, snapshot date, customer aggregate, recency.

    One aggregate pass over the sales keeps the NULL-customer group, so the
    snapshot date (last sale + 1 day, over all rows) and the customer count
    of the gate are read from the small per-customer table instead of
    scanning the sales again.
    """
    if "customer_id" not in sales.columns:
        return _empty_base(sales)
    freq = (F.countDistinct("order_id") if "order_id" in sales.columns else F.count(F.lit(1)))
    agg = (sales.groupBy("customer_id")
                .agg(F.max("date").alias("last_purchase"),
                     freq.alias("frequency"),
                     # whole cents: the sum does not depend on the order of the rows
                     (F.sum(F.round(F.col("revenue") * 100).cast("bigint")) / 100).alias("monetary"),
                     F.sum("units_sold").alias("units"),
                     F.avg("discount_pct").alias("avg_discount"),
                     F.sum("return_units").alias("return_units")))
    if materialize:
        agg = materialize_table(agg, "customer-aggregate")
    g = agg.select(F.struct(F.date_add(F.max("last_purchase"), 1).alias("snap"),
                            F.count("customer_id").alias("n"))).scalar()
    return (agg.where(F.col("customer_id").isNotNull())
               .where(g["n"] > 1)                                               # R1 gate, lazy
               .withColumn("recency_days", F.datediff(g["snap"], F.col("last_purchase"))))


def _empty_base(sales: DataFrame) -> DataFrame:
    spark = sales.sparkSession
    return spark.createDataFrame([], "customer_id string, last_purchase date, frequency bigint, monetary double, "
                                     "units double, avg_discount double, return_units double, recency_days int")


def rfm_scores(base: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """First-come ranks cut into quintiles; composite score.

    A quintile is decided by four edge rows a measure.  They are selected
    (``functions.selection``) for all three measures from the same passes over
    narrow columns; no customer is ranked or rewritten, and labels are
    comparisons with the edges.
    """
    measures = {"r": "recency_days", "f": "frequency", "m": "monetary"}
    found = select_ranks(base.select("customer_id", *measures.values()), list(measures.values()), qcut_ranks, tie="customer_id")
    buckets = {name: bucket_by_edges(measure, "customer_id", found[measure]) for name, measure in measures.items()}
    df = base.withColumns({"r_score": (F.lit(6) - buckets["r"]).cast("int"), "f_score": buckets["f"], "m_score": buckets["m"]})
    return df.withColumn("rfm_score", (F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score")).cast("int"))


def segment_label():
    """First matching rule wins (labels and bounds are fixed values)."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
             .when((r >= 3) & (f >= 4), "Loyal Customers")
             .when((r >= 4) & (f <= 3), "Potential Loyalists")
             .when((r <= 2) & (f >= 3), "At Risk")
             .when((r <= 2) & (f <= 2), "Hibernating")
             .otherwise("Need Attention"))


def customer_segments(sales: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """The customer segment table (always the 10-column schema)."""
    base = rfm_base(sales)
    scored = rfm_scores(base, num_partitions)
    # maxima from the checkpointed scores: no second pass over the sales
    mx = scored.select(F.struct(F.max("recency_days").alias("r"), F.max("frequency").alias("f"))).scalar()
    max_rec, max_freq = mx["r"], mx["f"]
    df = scored.withColumns({
        "segment": segment_label(),
        "return_rate": F.col("return_units") / (F.col("units") + F.col("return_units") + 1),     # R8
    })
    churn = (F.lit(W_RECENCY) * F.coalesce(safe_div(F.col("recency_days"), max_rec), F.lit(0.0))
             + F.lit(W_FREQUENCY) * F.coalesce(F.lit(1.0) - safe_div(F.col("frequency"), max_freq), F.lit(0.0))
             + F.lit(W_DISCOUNT) * F.coalesce(F.col("avg_discount"), F.lit(0.0))
             + F.lit(W_RETURNS) * F.coalesce(F.col("return_rate"), F.lit(0.0)))
    df = df.withColumn("churn_risk", clip01(churn))                                               # R9
    return df.select(*SEGMENT_COLUMNS)                                                             # R10
