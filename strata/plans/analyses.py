"""Business reports over the gold star schema.

Each report aggregates as early as possible (partial aggregation before
every shuffle), joins dimensions after reducing the facts where the
grouping allows it, and only ever sorts or windows the final, small
group-level rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.aggregates import avg_rounded, pct_where, ratio_pct, safe_corr
from ..functions.columns import bucketize, round_half_up
from ..operators.metrics import frequency, share_of_total, top_k

# Fixed values of the retail model.
EXCLUDED_STATUSES = ("canceled", "unavailable")
DELIVERED = "delivered"
CARD = "credit_card"
UNDEFINED_PAYMENT = "not_defined"
DELAY_BANDS = [(0, "1. on time or early"), (3, "2. 1 to 3 days late"), (7, "3. 4 to 7 days late"),
               (14, "4. 8 to 14 days late")]
DELAY_ELSE = "5. 15+ days late"
VALUE_BANDS = [(50, "1. up to 50"), (100, "2. 50 to 100"), (200, "3. 100 to 200"), (500, "4. 200 to 500")]
VALUE_ELSE = "5. above 500"


def _sold(fact: DataFrame) -> DataFrame:
    # NOT IN: a NULL status is excluded too
    return fact.filter(~F.col("order_status").isin(*EXCLUDED_STATUSES))


def revenue_by_category(fact: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Top-k categories by revenue (item price, no freight): revenue,
    distinct orders and share of the revenue of *all* categories, largest
    first."""
    j = _sold(fact).select("product_id", "order_id", "item_price").join(
        products.select("product_id", "category"), "product_id")
    # one row per (category, order), from which both measures follow
    per_order = j.groupBy("category", "order_id").agg(F.sum("item_price").alias("value"))
    g = per_order.groupBy("category").agg(F.sum("value").alias("revenue"), F.count("order_id").alias("orders"))
    g = share_of_total(g, "revenue", "pct_revenue", 2)
    best = top_k(g, k, [F.col("revenue").desc(), F.col("category").asc()])
    return best.select("category", F.col("revenue").cast("decimal(22,2)").alias("revenue"),
                       "orders", "pct_revenue")


def monthly_top_categories(fact: DataFrame, products: DataFrame, dates: DataFrame, k: int = 5,
                           start: str = "1996-01-01", end: str = "1999-12-31") -> DataFrame:
    """Monthly revenue of the top-k categories (ranked over all time)
    between ``start`` and ``end``, ordered by month, then revenue.

    The facts meet the products in one shuffle, whose large partitions adaptive
    execution splits; few products sell twice on a day, so reducing them to
    (product, day) first would only shuffle them once more. Revenue per
    (category, day) feeds both the ranking and the monthly series, and its
    shuffle is reused."""
    j = _sold(fact).select("product_id", "purchase_date_key", "item_price").join(
        products.select("product_id", "category"), "product_id")
    daily = j.groupBy("category", "purchase_date_key").agg(F.sum("item_price").alias("revenue"))
    ranked = daily.groupBy("category").agg(F.sum("revenue").alias("total"))
    best = top_k(ranked, k, [F.col("total").desc(), F.col("category").asc()]).select("category")
    window = dates.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))) \
                  .select("date_key", "year_month")
    # ``best`` holds each category once and ``date_key`` is never NULL, so
    # these inner joins on null-safe keys keep exactly the wanted rows. A
    # semi join, or the not-NULL filters the optimizer infers from plain
    # equality, would be pushed below ``daily`` on this branch only; the two
    # uses of ``daily`` would then differ and the facts be scanned twice.
    best = best.withColumnRenamed("category", "__best")
    m = daily.join(best, daily["category"].eqNullSafe(best["__best"])).drop("__best") \
             .join(window, daily["purchase_date_key"].eqNullSafe(window["date_key"]))
    out = m.groupBy("year_month", "category").agg(F.sum("revenue").alias("revenue"))
    return out.select("year_month", "category", F.col("revenue").cast("decimal(22,2)").alias("revenue")) \
              .orderBy("year_month", F.col("revenue").desc(), "category")


def _delivered_reviewed_orders(fact: DataFrame) -> DataFrame:
    """Order grain: delay and score are order-level, so DISTINCT over
    (order, delay, score) yields one row per order."""
    return fact.filter((F.col("order_status") == DELIVERED) & F.col("delivered_at").isNotNull()
                       & F.col("review_score").isNotNull()) \
               .select("order_id", "delay_days", "review_score").distinct()


def delay_vs_score(fact: DataFrame) -> DataFrame:
    """Per delay band: orders, mean score, % of scores 1-2. A missing
    delay (no estimate) falls in the last band, as a searched CASE does."""
    o = _delivered_reviewed_orders(fact)
    band = bucketize("delay_days", DELAY_BANDS, DELAY_ELSE, inclusive=True, null_to_else=True)
    return o.groupBy(band.alias("delay_band")).agg(
        F.count(F.lit(1)).alias("orders"),
        avg_rounded("review_score", 2).alias("mean_score"),
        pct_where(F.col("review_score") <= 2, 1).alias("pct_low_scores")).orderBy("delay_band")


def delay_score_corr(fact: DataFrame) -> DataFrame:
    o = _delivered_reviewed_orders(fact)
    return o.agg(round_half_up(safe_corr("delay_days", "review_score"), 3).alias("corr_delay_score"),
                 pct_where(F.col("delay_days") > 0, 1).alias("pct_late_orders"))


def delivery_by_state(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer state and region: delivered orders, mean and median
    lead time, % late, freight as % of goods value.

    Items are first reduced to orders (grouped by order and customer), then
    orders to (customer, lead time): one counted row for each, so no customer
    is hot in the join with the customer dimension. Means, shares and the
    median all follow from counted rows. Slowest states come first."""
    delivered = fact.filter((F.col("order_status") == DELIVERED) & F.col("delivered_at").isNotNull())
    per_order = delivered.groupBy("order_id", "customer_id").agg(
        F.max("lead_time_days").alias("lead_time_days"),
        F.max(F.when(F.col("is_late"), F.lit(1)).otherwise(F.lit(0))).alias("late"),
        F.sum("item_price").alias("goods_value"),
        F.sum("freight_value").alias("freight_value"))
    per_customer = per_order.groupBy("customer_id", "lead_time_days").agg(
        F.count(F.lit(1)).alias("n"), F.sum("late").alias("late"), F.sum("goods_value").alias("goods_value"),
        F.sum("freight_value").alias("freight_value"))
    j = per_customer.join(customers.select("customer_id", "state", "region"), "customer_id")
    per_lead = j.groupBy("state", "region", "lead_time_days").agg(
        F.sum("n").alias("n"), F.sum("late").alias("late"), F.sum("goods_value").alias("goods_value"),
        F.sum("freight_value").alias("freight_value"))
    # the lead times of a state, with their counts: a row per day of delay
    by_state = Window.partitionBy("state", "region")
    upto = F.sum(F.when(F.col("lead_time_days").isNotNull(), F.col("n"))).over(
        by_state.orderBy(F.col("lead_time_days").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    known = F.sum(F.when(F.col("lead_time_days").isNotNull(), F.col("n"))).over(by_state)
    per_lead = per_lead.withColumn("middle", F.when(upto * 2 >= known, F.col("lead_time_days")))
    days = F.col("lead_time_days") * F.col("n")
    g = per_lead.groupBy("state", "region").agg(
        F.sum("n").alias("orders"),
        round_half_up(F.sum(days) / F.sum(F.when(F.col("lead_time_days").isNotNull(), F.col("n"))), 1).alias("mean_lead_days"),
        F.min("middle").cast("int").alias("median_lead_days"),
        round_half_up(F.sum("late") * F.lit(100.0) / F.sum("n"), 1).alias("pct_late"),
        ratio_pct("freight_value", "goods_value", 1).alias("freight_pct_of_value"))
    return g.select("state", "region", "orders", "mean_lead_days", "median_lead_days", "pct_late",
                    "freight_pct_of_value").orderBy(F.col("mean_lead_days").desc(), "state", "region")


def payment_mix(payments: DataFrame) -> DataFrame:
    per_order = payments.filter(F.col("payment_type") != UNDEFINED_PAYMENT).groupBy("payment_type", "order_id").agg(
        F.sum("payment_value").alias("value"))
    g = per_order.groupBy("payment_type").agg(F.count("order_id").alias("orders"), F.sum("value").alias("total_value"))
    g = share_of_total(g, "total_value", "pct_of_value", 1)
    return g.select("payment_type", "orders", F.col("total_value").cast("decimal(22,2)").alias("total_value"),
                    "pct_of_value").orderBy(F.col("total_value").desc(), "payment_type")


def instalments_by_value_band(payments: DataFrame) -> DataFrame:
    """Orders paid by card, per band of total order value (all payment
    types summed): count, mean card instalments, % paid in instalments."""
    per_order = payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("order_value"),
        F.max(F.when(F.col("payment_type") == CARD, F.col("installments"))).alias("card_installments"))
    card = per_order.filter(F.col("card_installments").isNotNull())
    band = bucketize("order_value", VALUE_BANDS, VALUE_ELSE, inclusive=False, null_to_else=True)
    return card.groupBy(band.alias("value_band")).agg(
        F.count(F.lit(1)).alias("card_orders"),
        avg_rounded("card_installments", 1).alias("mean_installments"),
        pct_where(F.col("card_installments") > 1, 1).alias("pct_in_installments")).orderBy("value_band")


def domain_frequency(orders_raw: DataFrame, payments_raw: DataFrame, customers_raw: DataFrame) -> DataFrame:
    """Observed domains of the categorical landing columns, each by
    descending frequency."""
    return frequency(orders_raw, "order_status") \
        .unionByName(frequency(payments_raw, "payment_type")) \
        .unionByName(frequency(customers_raw, "customer_state")) \
        .orderBy("domain", F.col("n").desc(), "value")
